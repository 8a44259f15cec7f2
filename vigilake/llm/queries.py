"""Named queries of the training-data operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.llm import components, history, mojibake, packing, survivors, tokens, truncation
from vigilake.tables import table


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """``(containers, tokens, bound, fill)``: how full the containers are, against the volume bound."""
    packed = packing.containers(tokens.lengths(table(spark, d, "documents")))
    sums = packed.agg(F.countDistinct("container").alias("containers"), F.sum("tokens").alias("tokens"))
    return sums.select("containers", "tokens", F.ceil(F.col("tokens") / packing.CAPACITY).alias("bound"), F.round(F.col("tokens") / (F.col("containers") * packing.CAPACITY), 6).alias("fill"))


def p6_sources(spark: SparkSession, d: str) -> DataFrame:
    """``(field, source, sensitivity, specificity)`` of each source."""
    records = table(spark, d, "issue_records")
    return survivors.quality(survivors.votes(records, survivors.stated(records, table(spark, d, "sources"))))[1]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": lambda s, d: mojibake.found(table(s, d, "signals")),
    "p2_restored": lambda s, d: mojibake.labelled(table(s, d, "signals")),
    "p3_found": lambda s, d: components.found(table(s, d, "merge_decisions")),
    "p4_found": lambda s, d: history.found(table(s, d, "signals")),
    "p4_recall": lambda s, d: history.recall(table(s, d, "signals")),
    "p6_found": lambda s, d: survivors.winners(table(s, d, "issue_records"), table(s, d, "sources")),
    "p6_records": lambda s, d: survivors.survivors(table(s, d, "issue_records"), table(s, d, "sources")),
    "p6_sources": p6_sources,
    "p6_tests": lambda s, d: survivors.tests(table(s, d, "issue_records"), table(s, d, "sources")),
    "p7_ids": lambda s, d: tokens.encode(table(s, d, "documents")),
    "p8_containers": lambda s, d: packing.containers(tokens.lengths(table(s, d, "documents"))),
    "p8_fill": p8_fill,
    "p9_found": lambda s, d: truncation.found(table(s, d, "documents")),
    "p9_rates": lambda s, d: truncation.rates(table(s, d, "documents")),
}

ORACLE: dict[str, str] = {
    "p3_found": """
        WITH RECURSIVE e AS (
            SELECT candidate_a AS a, candidate_b AS b FROM merge_decisions WHERE same_issue AND confidence >= 0.70 AND candidate_a <> candidate_b
            UNION SELECT candidate_b, candidate_a FROM merge_decisions WHERE same_issue AND confidence >= 0.70 AND candidate_a <> candidate_b),
        r(id, seen) AS (SELECT a, a FROM e UNION SELECT r.id, e.b FROM r JOIN e ON r.seen = e.a)
        SELECT min(seen) AS group_id, id AS issue_id FROM r GROUP BY id""",
}
