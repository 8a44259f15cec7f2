"""Named queries of feeds, records, streams, tasks and hooks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.functions import text as T
from vigilake.operators import facts, nested, publish
from vigilake.plans import sql as Q
from vigilake.plans.catalog import indicators, plain_issues, query, signals_of
from vigilake.sources import feeds, records
from vigilake.streaming import signals as streams
from vigilake.tables import table


def _xml(c: str) -> F.Column:
    s = F.coalesce(c, F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def _plain_signals(s: SparkSession, d: str) -> DataFrame:
    """Signals whose texts an XML document may hold."""
    return signals_of(s, d).where(~F.concat_ws("", "title", "link").rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x{fffe}\x{ffff}]"))


_KEPT = r"NOT regexp_matches(coalesce(title, '') || coalesce(link, ''), '[\x00-\x08\x0b\x0c\x0e-\x1f\x{fffe}\x{ffff}]')"


@query("feed_rss", f"SELECT row_id::VARCHAR AS guid, coalesce(nullif({Q.strip('title')}, ''), 'item') AS title, {Q.strip('link')} AS link FROM signals WHERE {_KEPT}")
def feed_rss(s: SparkSession, d: str) -> DataFrame:
    """Every signal as a feed of its own, written and parsed again."""
    item = F.concat(F.lit("<rss><channel><item><guid>"), F.col("row_id").cast("string"), F.lit("</guid><title>"), _xml("title"), F.lit("</title><link>"), _xml("link"), F.lit("</link><dc:date>2026-01-01</dc:date></item></channel></rss>"))
    rows = feeds.xml_feed(_plain_signals(s, d).select("source", item.alias("payload"), "fetched_at"))
    return rows.select("guid", "title", "link")


@query("feed_atom", f"SELECT row_id::VARCHAR AS guid, coalesce(nullif({Q.strip('title')}, ''), 'entry') AS title, '2026-02-02' AS published_date FROM signals WHERE {_KEPT}")
def feed_atom(s: SparkSession, d: str) -> DataFrame:
    entry = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><published>2026-02-02</published><updated>2026-03-03</updated><id>'), F.col("row_id").cast("string"), F.lit("</id><title>"), _xml("title"), F.lit('</title><link rel="self" href="x"/></entry></feed>'))
    return feeds.xml_feed(_plain_signals(s, d).select("source", entry.alias("payload"), "fetched_at")).select("guid", "title", "published_date")


_TEXTS = ("kev_vendor", "kev_product", "kev_required_action", "kev_due_date")


@query("feed_kev", f"SELECT 'CVE-2024-' || (100000 + row_id) AS guid, 'https://nvd.nist.gov/vuln/detail/CVE-2024-' || (100000 + row_id) AS link, {', '.join(f'nullif({Q.strip(c)}, {chr(39)}{chr(39)}) AS {c}' for c in _TEXTS)} FROM signals WHERE kev_vendor IS NOT NULL")
def feed_kev(s: SparkSession, d: str) -> DataFrame:
    v = F.struct(F.concat(F.lit("CVE-2024-"), (F.col("row_id") + 100000).cast("string")).alias("cveID"), F.col("kev_vendor").alias("vendorProject"), F.col("kev_product").alias("product"), F.col("kev_required_action").alias("requiredAction"), F.col("kev_due_date").alias("dueDate"))
    payload = F.to_json(F.struct(F.array(v).alias("vulnerabilities")))
    rows = feeds.kev_feed(signals_of(s, d).where("kev_vendor is not null").select("source", payload.alias("payload"), "fetched_at"))
    return rows.select("guid", "link", *_TEXTS)


@query("feed_json", f"SELECT row_id::VARCHAR AS guid, coalesce(nullif(trim(coalesce(title, '')), ''), 'item') AS title, trim(coalesce(summary, '')) AS summary FROM signals")
def feed_json(s: SparkSession, d: str) -> DataFrame:
    item = F.struct(F.col("row_id").cast("string").alias("id"), F.col("title").alias("title"), F.col("summary").alias("description"))
    payload = F.to_json(F.struct(F.array(item).alias("results")))
    return feeds.json_feed(signals_of(s, d).select("source", payload.alias("payload"), "fetched_at")).select("guid", "title", "summary")


@query("feed_nvd", "SELECT cve AS guid, 'https://nvd.nist.gov/vuln/detail/' || cve AS link, 'about ' || cve AS summary FROM (SELECT DISTINCT unnest(cves) AS cve FROM issues) WHERE cve IS NOT NULL")
def feed_nvd(s: SparkSession, d: str) -> DataFrame:
    ids = table(s, d, "issues").select(F.explode("cves").alias("cve")).where("cve is not null").distinct()
    text = F.array(F.struct(F.lit("de").alias("lang"), F.lit("x").alias("value")), F.struct(F.lit("en").alias("lang"), F.concat(F.lit("about "), "cve").alias("value")))
    payload = F.to_json(F.struct(F.lit("NVD_CVE").alias("format"), F.array(F.struct(F.struct(F.col("cve").alias("id"), text.alias("descriptions")).alias("cve"))).alias("vulnerabilities")))
    return feeds.nvd_feed(ids.select(F.lit("nvd").alias("source"), payload.alias("payload"), F.lit("").alias("fetched_at"))).select("guid", "link", "summary")


@query("record_vulnerabilities", "SELECT cve, CAST(right(cve, 1) AS INTEGER) * 1.0 AS score, CASE WHEN CAST(right(cve, 1) AS INTEGER) >= 9 THEN 'CRITICAL' WHEN CAST(right(cve, 1) AS INTEGER) >= 7 THEN 'HIGH' WHEN CAST(right(cve, 1) AS INTEGER) >= 4 THEN 'MEDIUM' ELSE 'LOW' END AS severity, 'CWE-1;CWE-20' AS cwe_ids FROM (SELECT DISTINCT unnest(cves) AS cve FROM issues) WHERE regexp_matches(cve, '[0-9]$')")
def record_vulnerabilities(s: SparkSession, d: str) -> DataFrame:
    ids = table(s, d, "issues").select(F.explode("cves").alias("cve")).where(F.col("cve").rlike("[0-9]$")).distinct()
    body = F.format_string('{"cve": {"id": "%s", "descriptions": [{"lang": "en", "value": "x"}], "metrics": {"cvssMetricV2": [{"cvssData": {"baseScore": %s.0}}]}, "weaknesses": [{"description": [{"value": "CWE-20"}, {"value": "CWE-1"}, {"value": "other"}]}, {"description": [{"value": "CWE-20"}]}]}}', "cve", F.substring("cve", -1, 1))
    return records.vulnerabilities(ids.select(body.alias("payload"))).select("cve", "score", "severity", F.array_join("cwe_ids", ";").alias("cwe_ids"))


@query("record_buckets", "SELECT cve, (CAST(regexp_extract(cve, 'CVE-[0-9]{4}-([0-9]+)', 1) AS BIGINT) // 1000)::VARCHAR || 'xxx' AS bucket FROM (SELECT DISTINCT unnest(cves) AS cve FROM issues) WHERE regexp_matches(cve, '^CVE-[0-9]{4}-[0-9]+$')")
def record_buckets(s: SparkSession, d: str) -> DataFrame:
    ids = table(s, d, "issues").select(F.explode("cves").alias("cve")).where(F.col("cve").rlike(r"^CVE-[0-9]{4}-[0-9]+$")).distinct()
    return ids.select("cve", records.bucket_of(F.col("cve")).alias("bucket"))


@query("recall_signals", "SELECT row_id AS guid, CASE WHEN p <> '' THEN p || ' recall' || CASE WHEN f <> '' THEN ' (' || f || ')' ELSE '' END WHEN f <> '' THEN f || ' recall' ELSE 'recall' END AS title FROM (SELECT row_id, " + f"{Q.strip('kev_product')} AS p, {Q.strip('kev_vendor')} AS f FROM signals WHERE kev_vendor IS NOT NULL)")
def recall_signals(s: SparkSession, d: str) -> DataFrame:
    rows = signals_of(s, d).where("kev_vendor is not null").select(F.col("row_id").alias("recall_number"), F.col("kev_vendor").alias("recalling_firm"), F.col("kev_product").alias("product_description"), F.col("kev_vulnerability_name").alias("reason_for_recall"), F.col("published_date").alias("report_date"))
    return records.recall_signal(rows).select("guid", "title")


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(s: SparkSession, d: str) -> DataFrame:
    return streams.finished(streams.once(streams.arriving(s, d, "events").select("user_id", "event_type"), ["user_id", "event_type"]))


@query("stream_issue_state", "SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS n FROM events GROUP BY user_id")
def stream_issue_state(s: SparkSession, d: str) -> DataFrame:
    return streams.finished(streams.seen_spans(streams.arriving(s, d, "events"), "user_id", "ts"), "complete")


@query("stream_windows", "SELECT date_trunc('day', ts)::TIMESTAMP AS start, event_type AS kind, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY ALL")
def stream_windows(s: SparkSession, d: str) -> DataFrame:
    return streams.finished(streams.windows(streams.arriving(s, d, "events"), "ts"), "complete")


@query("stream_new_items", "SELECT DISTINCT source, guid FROM signals WHERE guid IS NOT NULL")
def stream_new_items(s: SparkSession, d: str) -> DataFrame:
    rows = streams.arriving(s, d, "signals").where("guid is not null").select("source", "guid")
    return streams.finished(streams.once(rows, ["source", "guid"]))


@query(
    "task_rows",
    """WITH p AS (SELECT packet_id, payload FROM remediation_packets WHERE json_valid(payload) AND json_type(payload, '$.tasks_by_role') = 'OBJECT'),
    r AS (SELECT packet_id, payload, unnest(json_keys(payload, '$.tasks_by_role')) AS role FROM p), a AS (SELECT packet_id, role, json_extract(payload, '$.tasks_by_role."' || role || '"') AS v FROM r),
    e AS (SELECT packet_id, role, unnest(CASE json_type(v) WHEN 'ARRAY' THEN json_extract(v, '$[*]') ELSE [v] END) AS x, 0 AS pos FROM a),
    k AS (SELECT packet_id, role, pos, x, CASE json_type(x) WHEN 'VARCHAR' THEN x ->> '$' ELSE x ->> '$.task' END AS task FROM e WHERE NOT (json_type(x) = 'NULL' OR (json_type(x) = 'VARCHAR' AND trim(x ->> '$') = '') OR x::VARCHAR IN ('{}', '[]')))
    SELECT role, task, count(*) AS n FROM k GROUP BY role, task""",
)
def task_rows(s: SparkSession, d: str) -> DataFrame:
    """Tasks of the packets that are plain JSON with a map of roles; wrapped payloads are read too, but SQL can't."""
    packets = table(s, d, "remediation_packets")
    plain = packets.where(F.try_parse_json("payload").isNotNull() & F.get_json_object("payload", "$.tasks_by_role").startswith("{") & ~F.coalesce(F.get_json_object("payload", "$.tasks_by_role.tasks"), F.get_json_object("payload", "$.tasks_by_role.role"), F.lit("")).startswith("["))
    return publish.tasks(nested.child_rows(plain, "packet_id", "packet")).groupBy("role", "task").agg(F.count("*").alias("n"))


@query("task_numbers")
def task_numbers(s: SparkSession, d: str) -> DataFrame:
    return publish.tasks(nested.child_rows(table(s, d, "remediation_packets"), "packet_id", "packet"))


@query("exchange_objects")
def exchange_objects(s: SparkSession, d: str) -> DataFrame:
    found = indicators(s, d).select("type", "value").distinct()
    return publish.bundle(found.withColumn("pattern", facts.stix_pattern(F.col("type"), F.col("value"))))


def _hook(rows: pd.DataFrame) -> pd.Series:
    """The offline stand-in for a model call: a rule on the text."""
    return rows["title"].str.contains("pump|ventilator|monitor", case=False).map({True: "medical_device", False: "other"})


@query("cached_hook", "SELECT issue_id, CASE WHEN regexp_matches(coalesce(title, ''), '(?i)pump|ventilator|monitor') THEN 'medical_device' ELSE 'other' END AS result FROM issues")
def cached_hook(s: SparkSession, d: str) -> DataFrame:
    cache = s.createDataFrame([], "hash string, result string")
    return publish.memoised(plain_issues(s, d).select("issue_id", "title"), cache, ["title"], _hook)[0].select("issue_id", "result")


@query("eval_rollup", "SELECT model, count(*) AS n, round(avg(CASE WHEN same_issue = (similarity_score >= 0.7) THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM merge_decisions WHERE same_issue IS NOT NULL AND similarity_score IS NOT NULL GROUP BY model")
def eval_rollup(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "merge_decisions").where("same_issue is not null and similarity_score is not null")
    return rows.groupBy("model").agg(F.count("*").alias("n"), F.round(F.avg((F.col("same_issue") == (F.col("similarity_score") >= 0.7)).cast("double")), 6).alias("accuracy"))


@query("page_join", f"SELECT row_id, doc_id FROM (SELECT row_id, {Q.strip('link')} AS l FROM signals) a JOIN (SELECT doc_id, url FROM documents WHERE url IS NOT NULL AND url <> '') b ON a.l = b.url")
def page_join(s: SparkSession, d: str) -> DataFrame:
    """Pages of the links, joined by the digest that names them in the page store."""
    pages = table(s, d, "documents").where("url is not null and url <> ''").select("doc_id", F.sha2("url", 256).alias("page"))
    links = signals_of(s, d).select("row_id", F.sha2(T.text(F.col("link")), 256).alias("page"))
    return links.join(pages, "page").select("row_id", "doc_id")


@query("record_advisories", f"SELECT issue_id AS advisory_id, coalesce(title, '') AS title, array_to_string(list_sort(list_distinct(list_filter(coalesce(cves, []), lambda x: coalesce(x, '') <> ''))), ';') AS cves, 2 AS n_remediations FROM issues WHERE issue_id IS NOT NULL")
def record_advisories(s: SparkSession, d: str) -> DataFrame:
    """Every issue as a document of the common advisory format, written and parsed again."""
    fixes = F.array(*[F.struct(F.lit(x).alias("details")) for x in ("patch", "isolate", "patch")])
    body = F.struct(
        F.struct(F.col("title"), F.struct(F.col("issue_id").alias("id")).alias("tracking")).alias("document"),
        F.concat(F.transform(F.coalesce("cves", F.array().cast("array<string>")), lambda c: F.struct(c.alias("cve"), fixes.alias("remediations"))), F.array(F.struct(F.lit(None).cast("string").alias("cve"), fixes.alias("remediations")))).alias("vulnerabilities"),
    )
    rows = records.advisories(table(s, d, "issues").where("issue_id is not null").select(F.to_json(body).alias("payload")))
    return rows.select("advisory_id", "title", F.array_join("cves", ";").alias("cves"), F.size("remediations").alias("n_remediations"))


@query("record_overlay", "SELECT i.issue_id, CASE WHEN r.title <> '' THEN r.title ELSE i.title END AS title FROM issues i LEFT JOIN (SELECT issue_id, min(title) AS title FROM issue_records WHERE title IS NOT NULL GROUP BY issue_id) r USING (issue_id)")
def record_overlay(s: SparkSession, d: str) -> DataFrame:
    detail = table(s, d, "issue_records").where("title is not null").groupBy("issue_id").agg(F.min("title").alias("title"))
    return records.overlaid(table(s, d, "issues").select("issue_id", "title"), detail, "issue_id", [], [])
