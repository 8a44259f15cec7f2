"""Sinks: lines, arrays, feeds, reports, indicator bundles; memoised hooks.

What is rendered on the driver is a limited report (top n rows); everything else is written by executors.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from pathlib import Path
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.functions import text as T

NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the registered name space of addresses


def lines(rows: DataFrame, path: str) -> None:
    """JSON lines with sorted keys."""
    rows.select(F.to_json(F.struct(*sorted(rows.columns))).alias("value")).write.mode("overwrite").text(path)


def table_csv(rows: DataFrame, path: str) -> None:
    """CSV with a header; arrays joined by ``;``."""
    flat = [F.array_join(c, ";").alias(c) if t.startswith("array") else F.col(c) for c, t in rows.dtypes]
    rows.select(*flat).write.mode("overwrite").csv(path, header=True)


def json_array(rows: DataFrame, path: str, top: int) -> int:
    """The first ``top`` rows as one JSON array; returns how many."""
    items = [json.loads(r[0]) for r in rows.limit(top).select(F.to_json(F.struct(*sorted(rows.columns)))).collect()]
    Path(path).write_text(json.dumps(items, ensure_ascii=False, sort_keys=True, indent=1), encoding="utf-8")
    return len(items)


def rss(rows: DataFrame, path: str, title: str, top: int = 50) -> int:
    """The first ``top`` rows ``(issue_id, title, summary, canonical_link, published)`` as RSS 2.0; descriptions cut at 500."""
    shown = rows.limit(top).select("issue_id", "title", F.substring("summary", 1, 500).alias("summary"), "canonical_link", T.rss_date(F.col("published")).alias("published")).collect()
    item = "<item><guid isPermaLink=\"false\">{0}</guid><title>{1}</title><description>{2}</description><link>{3}</link><pubDate>{4}</pubDate></item>"
    items = "".join(item.format(*(escape(str(v or "")) for v in r)) for r in shown)
    Path(path).write_text(f'<?xml version="1.0" encoding="UTF-8"?>\n<rss version="2.0"><channel><title>{escape(title)}</title>{items}</channel></rss>\n', encoding="utf-8")
    return len(shown)


def report(counters: DataFrame, path: str, title: str) -> None:
    """One row of counters as a Markdown table."""
    row = counters.first().asDict()
    Path(path).write_text(f"# {title}\n\n| counter | value |\n|-|-|\n" + "".join(f"| {k} | {v} |\n" for k, v in row.items()), encoding="utf-8")


def indicator_id(type_and_value: pd.Series) -> pd.Series:
    return type_and_value.map(lambda s: f"indicator--{uuid.uuid5(NAMESPACE, s)}")


def bundle(indicators: DataFrame) -> DataFrame:
    """``(object)``: one exchange object per indicator ``(type, value, pattern)``; ids follow from type and value, so repeats agree."""
    name = F.pandas_udf(indicator_id, "string")
    return indicators.where("pattern is not null").select(F.to_json(F.struct(F.lit("indicator").alias("type"), F.lit("2.1").alias("spec_version"), name(F.concat_ws(":", "type", "value")).alias("id"), F.col("pattern"), F.lit("stix").alias("pattern_type"))).alias("object"))


def tasks(packets: DataFrame) -> DataFrame:
    """``(packet_id, task_id, role, task)`` from child rows of ``tasks_by_role``: per packet the roles by name, their tasks in the order of the array.

    A packet's tasks are numbered by a window over the packet; rows of one ``rec_id`` are one packet.
    """
    from pyspark.sql import Window

    rows = packets.where((F.col("field") == "tasks_by_role") & F.col("subtype").isin("text", "task", "object") & ~F.col("path").contains(".depends_on"))
    role = F.regexp_extract("path", r"^tasks_by_role\.([^\[]+)\[", 1)
    task = F.when(F.col("subtype") == "text", F.col("value")).otherwise(F.get_json_object("value", "$.task"))
    # Numbers in a path are compared as numbers: [10] comes after [2].
    place = F.regexp_replace("path", r"\[(\d+)\]", "[000000000$1]")
    place = F.regexp_replace(place, r"\[0*(\d{9})\]", "[$1]")
    number = F.row_number().over(Window.partitionBy("rec_id").orderBy(place, "value"))
    return rows.select(F.col("rec_id").alias("packet_id"), F.format_string("%s-%03d", F.col("rec_id").cast("string"), number).alias("task_id"), role.alias("role"), task.alias("task"))


def memoised(rows: DataFrame, cache: DataFrame, key: list[str], call: Callable[[pd.DataFrame], pd.Series]) -> tuple[DataFrame, DataFrame]:
    """(``rows`` with ``result``, the new cache entries): ``call`` runs once per distinct content that ``cache`` ``(hash, result)`` lacks."""
    named = rows.withColumn("hash", F.sha2(F.to_json(F.struct(*sorted(key))), 256))
    missing = named.select("hash", *key).dropDuplicates(["hash"]).join(cache, "hash", "left_anti")
    fresh = missing.mapInPandas(lambda it: (pd.DataFrame({"hash": p["hash"], "result": call(p)}) for p in it), "hash string, result string")
    return named.join(cache.unionByName(fresh), "hash", "left"), fresh


def detection_rules(indicators: DataFrame) -> DataFrame:
    """``(kind, rule)``: for each address a block-list line, for each domain a rule of intrusion detection, numbered by the digest of its value."""
    number = (F.conv(F.substring(F.md5("value"), 1, 5), 16, 10).cast("long") + 1_000_000).cast("string")
    block = indicators.where("type = 'ip'").select(F.lit("acl").alias("kind"), F.concat(F.lit("deny ip host "), "value", F.lit(" any")).alias("rule"))
    query = indicators.where("type = 'domain'").select(F.lit("ids").alias("kind"), F.concat(F.lit('alert dns any any -> any any (msg:"indicator '), "value", F.lit('"; dns.query; content:"'), "value", F.lit('"; sid:'), number, F.lit("; rev:1;)")).alias("rule"))
    return block.unionByName(query)


def indicator_lines(indicators: DataFrame, folder: str) -> None:
    """Indicators as CSV files with a header, written by the executors."""
    indicators.select("type", "value").orderBy("type", "value").write.mode("overwrite").option("header", True).csv(folder)
