"""First-match joins, theta joins by grams, search and ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilake.functions import text as T
from vigilake.tables import cut, width


def first_match(issues: DataFrame, dimension: DataFrame, key: str = "cve") -> DataFrame:
    """``issues`` with the columns of the first of its candidates that ``dimension`` has: its own id, then its CVEs in order.

    The candidates are exploded with their position, equi-joined, and the least position wins by a partial minimum.
    """
    own = F.when(F.col("issue_id").startswith("CVE-"), F.array("issue_id")).otherwise(F.array().cast("array<string>"))
    tried = issues.select("issue_id", F.posexplode(F.array_distinct(F.concat(own, F.coalesce("cves", F.array().cast("array<string>"))))).alias("pos", key))
    fields = [c for c in dimension.columns if c != key]
    hit = tried.join(dimension, key).groupBy("issue_id").agg(F.min_by(F.struct(F.col(key).alias(f"matched_{key}"), *fields), "pos").alias("m"))
    return issues.join(hit, "issue_id", "left").select(*[issues[c] for c in issues.columns], "m.*")


def names_of(issues: DataFrame, column: str, dimension: DataFrame, key: str, name: str) -> DataFrame:
    """``(issue_id, names)``: names of the ids in an array column, in order; ids without a name are left out."""
    each = issues.select("issue_id", F.posexplode(column).alias("pos", key)).join(dimension.select(key, name), key)
    return each.groupBy("issue_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", name))), lambda x: x[name]), ";").alias("names"))


def contained(left: DataFrame, right: DataFrame, a: str, b: str, order: str, shortest: int = 4) -> DataFrame:
    """Each ``left`` row with the first ``right`` row (by ``order``) one of whose names contains the other, in lower case.

    A name contained in another has all its grams there: the shorter side is keyed by its first gram of ``shortest`` characters, the longer
    by every gram, so the containment test runs on an equi-join's result, not on all pairs. Names shorter than that never match.
    """
    l, r = F.lower(F.col(a)), F.lower(F.col(b))  # noqa: E741
    lhs = left.where(F.length(a) >= shortest).withColumn("__l", l)
    rhs = right.where(F.length(b) >= shortest).withColumn("__r", r)
    grams = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - shortest + 1), lambda i: F.substring(c, i, F.lit(shortest))))
    first = lambda c: F.substring(c, 1, shortest)
    ours, theirs = left.columns, [c for c in right.columns if c not in left.columns]
    inner = lhs.withColumn("__g", F.explode(grams(F.col("__l")))).join(rhs.withColumn("__g", first(F.col("__r"))), "__g").where(F.col("__l").contains(F.col("__r")))
    outer = lhs.withColumn("__g", first(F.col("__l"))).join(rhs.withColumn("__g", F.explode(grams(F.col("__r")))), "__g").where(F.col("__r").contains(F.col("__l")))
    hits = inner.select(*ours, *theirs).unionByName(outer.select(*ours, *theirs))
    return hits.groupBy(*ours).agg(F.min_by(F.struct(*theirs), order).alias("m")).select(*ours, "m.*")


def match_quality(query: list[str], field: Column) -> Column:
    """3 if the phrase stands in the field, 2 if all tokens do, 1 if any does, else 0."""
    there = T.words(field, 2)
    n = F.size(F.array_intersect(there, F.array(*map(F.lit, dict.fromkeys(query)))))
    return F.when(F.lower(field).contains(" ".join(query)), 3).when(n == len(set(query)), 2).when(n > 0, 1).otherwise(0)


def lookup(issues: DataFrame, query: str, top: int = 20) -> DataFrame:
    """The ``top`` issues that a name matches, by score, then quality: ``issue_id, quality, field, score``."""
    tokens = [t for t in "".join(c if c.isascii() and c.isalnum() else " " for c in query.lower()).split() if len(t) >= 2]
    best = F.greatest(*[F.struct(match_quality(tokens, F.coalesce(c, F.lit(""))).alias("q"), F.lit(-i).alias("i"), F.lit(c).alias("f")) for i, c in enumerate(("title", "summary", "issue_id"))])
    rows = issues.select("issue_id", "score", best.alias("b")).where("b.q > 0").select("issue_id", F.col("b.q").alias("quality"), F.col("b.f").alias("field"), "score")
    return rows.orderBy(F.desc("score"), F.desc("quality"), "issue_id").limit(top)


def relevant(issues: DataFrame, question: str, top: int = 10) -> DataFrame:
    """Context for a question: 2 per token in the title, else 1 per token in the summary; ``issue_id, relevance, score``."""
    tokens = [t for t in "".join(c if c.isascii() and c.isalnum() else " " for c in question.lower()).split() if len(t) >= 2]
    title, summary = T.words(F.col("title"), 2), T.words(F.col("summary"), 2)
    points = F.aggregate(F.array(*map(F.lit, tokens)), F.lit(0), lambda n, t: n + F.when(F.array_contains(title, t), 2).when(F.array_contains(summary, t), 1).otherwise(0)) if tokens else F.lit(0)
    rows = issues.select("issue_id", points.alias("relevance"), "score")
    rows = rows.where("relevance > 0") if tokens else rows
    return rows.orderBy(F.desc("relevance"), F.desc("score"), "issue_id").limit(top)


def richest(rows: DataFrame, group: str, text: str, key: str) -> DataFrame:
    """The row with the longest text of each group, the smallest key of equals: no window, one partial minimum."""
    best = F.min(F.struct((-F.length(F.coalesce(text, F.lit("")))).alias("n"), F.col(key).alias("k")))
    return rows.groupBy(group).agg(best.alias("b")).select(group, F.col("b.k").alias(key), (-F.col("b.n")).alias("n_chars"))


def percentiles(rows: DataFrame, column: str, shares: list[float]) -> DataFrame:
    """``(share, value)``: value at rank ``int(n * share)`` of the sorted column (from 0), one row per share; no row if there is no value.

    Values are counted and range partitioned; the partitions' totals (one row each on the driver) tell which of them hold a rank, and only those are ordered further.
    """
    spark = rows.sparkSession
    counts = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    placed = cut(counts.repartitionByRange(width(spark), "value").withColumn("part", F.spark_partition_id()))
    totals = sorted(tuple(r) for r in placed.groupBy("part").agg(F.sum("n")).collect())
    total, asked, before = sum(n for _, n in totals), [], 0
    for part, n in totals:
        ranks = [(s, min(int(total * s), total - 1)) for s in shares]
        asked += [(float(s), part, r - before) for s, r in ranks if before <= r < before + n]
        before += n
    wanted = F.array(*[F.struct(F.lit(s).alias("share"), F.lit(p).alias("p"), F.lit(r).alias("rank")) for s, p, r in asked]) if asked else F.array().cast("array<struct<share: double, p: int, rank: int>>")
    upto = placed.where(F.col("part").isin(*{p for _, p, _ in asked})).withColumn("upto", F.sum("n").over(Window.partitionBy("part").orderBy("value")))
    each = upto.withColumn("a", F.explode(F.filter(wanted, lambda x: x.p == F.col("part"))))
    return each.where((F.col("upto") > F.col("a.rank")) & (F.col("upto") - F.col("n") <= F.col("a.rank"))).select("a.share", "value")
