"""Named queries of publishers' records, enrichment and what one run leaves to the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.operators import enrich, facts, issues, publish, rules, state
from vigilake.plans import sql as Q
from vigilake.plans.catalog import ORACLE, correlated, healthcare_category, indicators, plain_issues, query, scored, signals_of
from vigilake.sources import connectors
from vigilake.streaming import signals as streams
from vigilake.tables import shared_folder, table

_SIG = "guid, title, link, published_date, summary"


def _text(c: str) -> str:
    return f"trim(coalesce({c}, ''))"


def _plain(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def _ascii_blanks(s: SparkSession, d: str) -> DataFrame:
    """Signals with no blank but the space around their texts: trimming differs for others between engines, and isn't what these queries compare."""
    return signals_of(s, d).select("row_id", "source", *[F.regexp_replace(c, r"[\s\p{Z}]+", " ").alias(c) for c in ("guid", "title", "link", "published_date", "summary")])


_S = "s AS (SELECT row_id, source, " + ", ".join(f"regexp_replace({c}, '[\\s\\p{{Z}}]+', ' ', 'g') AS {c}" for c in ("guid", "title", "link", "published_date", "summary")) + " FROM signals)"


# --- records of single publishers


@query(
    "feed_vuldb",
    f"""WITH {_S} SELECT coalesce(nullif({_text('guid')}, ''), 'CVE-2024-' || row_id) AS guid, coalesce(nullif({_text('title')}, ''), nullif({_text('guid')}, ''), 'VulDB entry') AS title,
    coalesce(nullif({_text('link')}, ''), 'https://nvd.nist.gov/vuln/detail/CVE-2024-' || row_id) AS link, {_text('published_date')} AS published_date, {_text('summary')} AS summary FROM s WHERE row_id % 10 <> 0""",
)
def feed_vuldb(s: SparkSession, d: str) -> DataFrame:
    """Every signal as a response of its own; a tenth of the responses report a failure and give nothing."""
    entry = F.struct(F.col("guid").alias("id"), F.col("title"), F.col("summary"), F.struct(F.concat(F.lit("CVE-2024-"), F.col("row_id").cast("string")).alias("cve_id")).alias("cve"), F.col("published_date").alias("timestamp"), F.col("link").alias("href"))
    payload = F.to_json(F.struct(F.struct(F.when(F.col("row_id") % 10 == 0, "401").otherwise("200").alias("status")).alias("response"), F.array(F.struct(entry.alias("entry"))).alias("result")))
    return connectors.vuldb(_ascii_blanks(s, d).select(payload.alias("payload")))


@query(
    "feed_icsma",
    """SELECT 'ICSMA-' || issue_id AS guid, coalesce(nullif(trim(coalesce(title, '')), ''), 'ICSMA-' || issue_id) AS title, 'https://www.cisa.gov/news-events/ics-medical-advisories/icsma-' || lower(issue_id) AS link, '2024-01-02' AS published_date,
    array_to_string(list_filter([coalesce(nullif(trim(min_summary), ''), 'Acme Pump'), CASE WHEN len(c) > 0 THEN 'CVEs: ' || array_to_string(c, ', ') END], lambda x: x IS NOT NULL), ' | ') AS summary
    FROM (SELECT i.issue_id, replace(replace(i.title, chr(160), ' '), chr(9), ' ') AS title, list_filter(coalesce(i.cves, []), lambda x: starts_with(x, 'CVE-')) AS c, r.s AS min_summary
        FROM issues i LEFT JOIN (SELECT issue_id, min(replace(replace(summary, chr(160), ' '), chr(9), ' ')) AS s FROM issue_records WHERE summary IS NOT NULL GROUP BY issue_id) r USING (issue_id))""",
)
def feed_icsma(s: SparkSession, d: str) -> DataFrame:
    """Every issue as a line of the advisory project's CSV, joined with the text of its documents."""
    flat = lambda c: F.translate(c, " \t", "  ")
    listed = F.array_join("cves", ", ")
    lines = table(s, d, "issues").select(
        F.concat(F.lit(" ICSMA-"), "issue_id").alias("ICS-CERT_Number"), flat("title").alias("ICS-CERT_Advisory_Title"), F.lit("Acme").alias("Vendor"), F.lit("Pump ").alias("Product"), F.lit("2024-01-02").alias("Original_Release_Date"),
        F.concat_ws(",", listed, F.lit("none")).alias("CVE_Number"), F.lit("CWE-20, x").alias("CWE_Number"), F.lit("7.5").alias("Cumulative_CVSS"), F.lit("High").alias("CVSS_Severity"),
    )
    documents = table(s, d, "issue_records").where("summary is not null").select(F.concat(F.lit("ICSMA-"), "issue_id").alias("advisory_id"), flat("summary").alias("description"))
    return connectors.icsma_signals(connectors.with_descriptions(connectors.icsma_advisories(lines), documents))


@query(
    "feed_mhra",
    f"""WITH {_S}, n AS (SELECT *, coalesce(nullif(list_last(string_split({_text('link')}, '/')), ''), left({_text('title')}, 80)) AS name FROM s),
    g AS (SELECT *, regexp_replace(trim(name), '[^a-zA-Z0-9_-]', '_', 'g') AS guid2 FROM n)
    SELECT guid2 AS guid, coalesce(nullif({_text('title')}, ''), guid2) AS title, CASE WHEN {_text('link')} <> '' AND NOT starts_with({_text('link')}, 'http') THEN 'https://www.gov.uk' || {_text('link')} ELSE {_text('link')} END AS link,
    {_text('published_date')} AS published_date, coalesce(nullif({_text('summary')}, ''), {_text('title')}) AS summary FROM g WHERE guid2 <> ''""",
)
def feed_mhra(s: SparkSession, d: str) -> DataFrame:
    payload = F.to_json(F.struct("title", F.col("summary").alias("description"), "link", F.col("published_date").alias("public_timestamp")))
    return connectors.mhra_signals(_ascii_blanks(s, d).select(payload.alias("payload")))


@query(
    "feed_index",
    """WITH e AS (SELECT issue_id, trim(coalesce(regexp_replace(title, '[\\s\\p{Z}]+', ' ', 'g'), '')) AS t, hash FROM (SELECT issue_id, title, length(issue_id) % 3 AS hash FROM issues))
    SELECT upper(issue_id) AS advisory_id, coalesce(nullif(t, ''), issue_id) AS title, '2024-05-06' AS published,
    CASE hash WHEN 0 THEN 'https://x.example/' || issue_id || '.json' WHEN 1 THEN 'https://self.example/' || issue_id ELSE 'https://cert-portal.siemens.com/productcert/csaf/' || lower(issue_id) || '.json' END AS url FROM e""",
)
def feed_index(s: SparkSession, d: str) -> DataFrame:
    """Every issue as an index of its own, in three forms: a feed object with links, a list whose entries are named by their file, entries without address."""
    title = F.to_json(F.struct(F.regexp_replace("title", r"[\s\p{Z}]+", " ").alias("title"), F.lit("2024-05-06").alias("updated")))
    body = F.expr("substring(t, 2, length(t) - 2)")
    named, address = F.concat(F.lit('"id": "'), "issue_id", F.lit('", ')), F.concat(F.lit('"url": "https://x.example/'), "issue_id", F.lit('.json", '))
    links = F.concat(F.lit('"link": [{"rel": "alternate", "href": "https://y.example"}, {"rel": "self", "href": "https://self.example/'), "issue_id", F.lit('"}], '))
    form = F.length("issue_id") % 3
    one = F.when(form == 0, F.concat(F.lit("[{"), address, body, F.lit("}]"))).when(form == 1, F.concat(F.lit('{"feed": {"entry": [{'), named, links, body, F.lit("}]}}"))).otherwise(F.concat(F.lit('{"advisories": [{'), named, body, F.lit("}]}")))
    return connectors.index_entries(table(s, d, "issues").withColumn("t", title).select(one.alias("payload")))


@query(
    "feed_index_signals",
    """SELECT issue_id AS guid, coalesce(nullif(trim(t), ''), issue_id) AS title, '' AS link, '' AS published_date, coalesce(nullif(trim(u), ''), nullif(trim(t), ''), issue_id) || CASE WHEN len(c) > 0 THEN ' | CVEs: ' || array_to_string(c[1:5], ', ') ELSE '' END AS summary
    FROM (SELECT issue_id, regexp_replace(title, '[\\s\\p{Z}]+', ' ', 'g') AS t, regexp_replace(summary, '[\\s\\p{Z}]+', ' ', 'g') AS u, list_filter(coalesce(cves, []), lambda x: x IS NOT NULL) AS c FROM issues)""",
)
def feed_index_signals(s: SparkSession, d: str) -> DataFrame:
    flat = lambda c: F.regexp_replace(c, r"[\s\p{Z}]+", " ")
    rows = table(s, d, "issues").select(F.col("issue_id").alias("advisory_id"), flat("title").alias("title"), flat("summary").alias("description"), F.array_compact(F.coalesce("cves", F.array().cast("array<string>"))).alias("cves"), F.lit("").alias("url"), F.lit("").alias("published"))
    return connectors.index_signals(rows)


@query(
    "recalls_recent",
    f"""WITH {_S} SELECT row_id::VARCHAR AS recall_id, {_text('title')} AS title, CASE WHEN row_id % 2 = 0 THEN strftime(make_timestamp(1700000000000000 + row_id * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') ELSE {_text('published_date')} END AS date_published, {_text('link')} AS url
    FROM s WHERE row_id % 5 <> 0 AND (row_id % 2 = 0 OR NOT regexp_matches({_text('published_date')}, '^\\d+$'))""",
)
def recalls_recent(s: SparkSession, d: str) -> DataFrame:
    """Every signal as a response with the same recall in two lists; a fifth are of another category."""
    rows = _ascii_blanks(s, d).where((F.col("row_id") % 2 == 0) | ~F.coalesce(F.trim("published_date").rlike(r"^\d+$"), F.lit(False)))
    date = F.when(F.col("row_id") % 2 == 0, (F.lit(1700000000000) + F.col("row_id") * 1000).cast("string")).otherwise(F.col("published_date"))
    item = lambda t: F.struct(F.col("row_id").cast("string").alias("recallId"), t.alias("title"), date.alias("date_published"), F.when(F.col("row_id") % 5 == 0, F.array(F.lit("1"))).otherwise(F.array(F.lit("2"), F.lit("3"))).alias("category"), F.col("link").alias("url"))
    payload = F.to_json(F.struct(F.struct(F.array(item(F.col("title"))).alias("ALL"), F.array(item(F.lit("again"))).alias("HEALTH")).alias("results")))
    return connectors.recent_recalls(rows.select(payload.alias("payload")))


@query(
    "recalls_detail",
    f"""WITH {_S}, t AS (SELECT row_id, {_text('title')} AS t, {_text('summary')} AS u, {_text('link')} AS l, {_text('published_date')} AS p FROM s)
    SELECT row_id::VARCHAR AS guid, coalesce(nullif(t, ''), row_id::VARCHAR) AS title, CASE WHEN l <> '' AND NOT starts_with(l, 'http') THEN 'https://healthycanadians.gc.ca' || l ELSE l END AS link, p AS published_date,
    CASE WHEN u <> '' AND NOT contains(t, u) THEN t || ' | ' || u ELSE t || ' | return it' END AS summary FROM t""",
)
def recalls_detail(s: SparkSession, d: str) -> DataFrame:
    rows = _ascii_blanks(s, d).select(F.col("row_id").cast("string").alias("recall_id"), "title", F.col("link").alias("url"), F.col("published_date").alias("date_published"), F.col("summary").alias("issue"), F.lit("return it").alias("what_you_should_do"))
    return connectors.recall_signals(rows)


# --- enrichment


@query("page_texts", r"SELECT doc_id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&nbsp;', ' '), '&amp;', '&'), '[\s\x{a0}]{3,}', ' ', 'g'), ' ' || chr(160) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS text FROM documents WHERE text IS NOT NULL".replace('\\"', '"'))
def page_texts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").where("text is not null").select("doc_id", enrich.page_text(F.col("text")).alias("text"))


@query("issue_urls", f"WITH {Q.ISSUES} SELECT issue_id, u AS url, pos FROM (SELECT issue_id, unnest(us) AS u, unnest(range(len(us))) AS pos FROM (SELECT issue_id, CASE WHEN starts_with(canonical_link, 'http') THEN [canonical_link] ELSE [] END || list_filter(coalesce(links, []), lambda x: starts_with(x, 'http') AND x <> canonical_link) AS us FROM iss))")
def issue_urls(s: SparkSession, d: str) -> DataFrame:
    return correlated(s, d).select("issue_id", F.posexplode(enrich.urls(F.col("canonical_link"), F.col("links"))).alias("pos", "url"))


@query("needs_extraction", "SELECT row_id FROM signals WHERE lower(trim(coalesce(title, ''))) IN ('', 'item', 'items', 'entry', 'untitled') OR trim(coalesce(kev_vendor, '')) = '' OR trim(coalesce(kev_product, '')) = '' OR trim(coalesce(kev_vulnerability_name, '')) = ''")
def needs_extraction(s: SparkSession, d: str) -> DataFrame:
    products = F.filter(F.array("kev_product"), lambda x: F.trim(x) != "")
    return signals_of(s, d).where(enrich.needs_extraction(F.col("title"), F.col("kev_vendor"), products, F.col("kev_vulnerability_name"))).select("row_id")


def _starts(*prefixes: str) -> str:
    return "len(list_filter(ws, lambda w: " + " OR ".join(f"starts_with(w, {Q.q(p)})" for p in prefixes) + ")) > 0"


@query(
    "reason_categories",
    f"WITH {Q.scored(2)}, w AS (SELECT issue_id, string_split(why, ';') AS ws FROM scored) SELECT issue_id, {_starts(*enrich.KNOWN_BY_RULE)} AS known, CASE WHEN {_starts(*enrich.DEVICE_REASONS)} THEN 'medical_device' WHEN {_starts('device: EHR/EMR')} THEN 'healthcare_it' "
    f"WHEN {_starts(*enrich.CLINICAL_REASONS)} THEN 'medical_device' WHEN {_starts('device: healthcare context')} THEN 'healthcare_it' ELSE 'not_healthcare' END AS category FROM w",
)
def reason_categories(s: SparkSession, d: str) -> DataFrame:
    why = F.split("why", ";")
    return scored(s, d).select("issue_id", enrich.known_by_rule(why).alias("known"), enrich.category_of_reasons(why).alias("category"))


_LIST = "array_to_string(list_sort(list_filter(coalesce({0}, []), lambda x: x IS NOT NULL)), ',')"


@query("issue_fingerprints", f"SELECT issue_id, sha256(issue_id || chr(10) || {_LIST.format('cves')} || chr(10) || left(coalesce(title, ''), 200) || chr(10) || left(coalesce(summary, ''), 400) || chr(10) || {_LIST.format('sources')}) AS fingerprint FROM issues")
def issue_fingerprints(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "issues").select("issue_id", enrich.fingerprint(table(s, d, "issues")).alias("fingerprint"))


@query(
    "filled_issues",
    """SELECT i.issue_id, CASE WHEN trim(coalesce(i.title, '')) = '' THEN coalesce(r.title, i.title) ELSE i.title END AS title, coalesce(r.summary, i.summary) AS summary FROM issues i LEFT JOIN
    (SELECT issue_id, min(title) FILTER (trim(title) <> '') AS title, max(summary) FILTER (trim(summary) <> '') AS summary FROM issue_records WHERE issue_id IS NOT NULL GROUP BY issue_id) r USING (issue_id)""",
)
def filled_issues(s: SparkSession, d: str) -> DataFrame:
    """Issues with empty titles filled from their records, and summaries taken over wherever a record has one."""
    said = lambda f, c: f(F.when(F.trim(c) != "", F.col(c))).alias(c)
    better = table(s, d, "issue_records").where("issue_id is not null").groupBy("issue_id").agg(said(F.min, "title"), said(F.max, "summary"))
    return enrich.filled(table(s, d, "issues").select("issue_id", "title", "summary"), better, "issue_id", ["title", "summary"], ("summary",))


@query("severity_backfill", "SELECT row_id, CASE WHEN trim(coalesce(kev_due_date, '')) = '' THEN lower(kev_vendor) ELSE kev_due_date END AS severity FROM signals")
def severity_backfill(s: SparkSession, d: str) -> DataFrame:
    """The rule on stand-in columns: the tables hold no severities."""
    return signals_of(s, d).select("row_id", enrich.severity_backfilled(F.col("kev_due_date"), F.col("kev_vendor")).alias("severity"))


@query(
    "best_sources",
    f"WITH {Q.ISSUES}, e AS (SELECT issue_id, unnest(sources) AS source, unnest(range(len(sources))) AS pos FROM iss) SELECT issue_id, first(source ORDER BY coalesce(tier, 5), pos) AS best_source, min(coalesce(tier, 5)) AS best_tier FROM e LEFT JOIN sources ON source_id = source GROUP BY issue_id",
)
def best_sources(s: SparkSession, d: str) -> DataFrame:
    return enrich.best_sources(correlated(s, d), table(s, d, "sources"))


@query(
    "source_citations",
    f"WITH {Q.ISSUES} SELECT i.issue_id, i.source, coalesce(f.l, i.canonical_link, '') AS url, coalesce(f.g, i.issue_id) AS citation FROM (SELECT issue_id, canonical_link, unnest(sources) AS source FROM iss) i LEFT JOIN "
    "(SELECT issue_id, source, first(link ORDER BY row_id) FILTER (link <> '') AS l, first(guid ORDER BY row_id) FILTER (guid <> '') AS g FROM ided GROUP BY issue_id, source) f USING (issue_id, source)",
)
def source_citations(s: SparkSession, d: str) -> DataFrame:
    return enrich.cited(correlated(s, d), issues.keyed(signals_of(s, d)))


@query("set_members_unknown", "SELECT DISTINCT source AS source_id FROM issue_records WHERE source IS NOT NULL AND source NOT IN (SELECT source_id FROM sources)")
def set_members_unknown(s: SparkSession, d: str) -> DataFrame:
    return enrich.unknown_members(table(s, d, "issue_records").select(F.col("source").alias("source_id")), table(s, d, "sources"))


@query("trust_union", "SELECT i.issue_id, array_to_string(list_distinct(coalesce(i.sources, [])), ';') IS NOT NULL AS ok, len(list_distinct(coalesce(i.sources, []) || coalesce(r.s, []))) AS n_sources FROM issues i LEFT JOIN (SELECT issue_id, list(DISTINCT source) FILTER (source IS NOT NULL) AS s FROM issue_records GROUP BY issue_id) r USING (issue_id)")
def trust_union(s: SparkSession, d: str) -> DataFrame:
    more = table(s, d, "issue_records").groupBy("issue_id").agg(F.collect_set("source").alias("more"))
    rows = table(s, d, "issues").select("issue_id", "sources").join(more, "issue_id", "left")
    return rows.select("issue_id", F.lit(True).alias("ok"), F.size(F.filter(enrich.list_union(F.col("sources"), F.col("more")), lambda x: x.isNotNull())).alias("n_sources"))


@query("set_with_candidates", "SELECT source_id, 'validated' AS status FROM sources WHERE medical UNION ALL SELECT source_id, 'candidate' FROM sources WHERE NOT medical")
def set_with_candidates(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "sources")
    return rows.where("medical").select("source_id", F.lit("validated").alias("status")).unionByName(rows.where("not medical").select("source_id", F.lit("candidate").alias("status")))


@query("source_table", "SELECT source_id, name, tier, row_number() OVER (ORDER BY lower(name), source_id) AS pos FROM sources")
def source_table(s: SparkSession, d: str) -> DataFrame:
    """The registry in the order of its names; it is a list of some dozens."""
    from pyspark.sql import Window

    return table(s, d, "sources").select("source_id", "name", "tier", F.row_number().over(Window.orderBy(F.lower("name"), "source_id")).alias("pos"))


@query(
    "required_actions",
    f"""WITH {Q.KEYED}, k AS (SELECT i.issue_id, first(s.kev_required_action ORDER BY s.row_id) FILTER (trim(coalesce(s.kev_required_action, '')) <> '') AS required FROM ided i JOIN signals s USING (row_id) GROUP BY i.issue_id)
    SELECT issue_id, required AS steps FROM k WHERE required IS NOT NULL""",
)
def required_actions(s: SparkSession, d: str) -> DataFrame:
    """Steps of issues whose catalogue demands an action: the first that any of the issue's signals states goes before all guidance."""
    said = signals_of(s, d).where("trim(coalesce(kev_required_action, '')) <> ''").select("row_id", "kev_required_action")
    keyed = issues.keyed(signals_of(s, d)).select("issue_id", "row_id").join(said, "row_id")
    first = keyed.groupBy("issue_id").agg(F.min_by("kev_required_action", "row_id").alias("required"))
    return first.select("issue_id", facts.remediation(F.col("required"), F.lit("")).alias("steps"))


@query("pass_rates", "SELECT source, round(avg(CASE WHEN trim(coalesce(title, '')) <> '' AND trim(coalesce(summary, '')) <> '' THEN 1.0 ELSE 0.0 END), 6) AS rate, count(*) AS n FROM signals GROUP BY source")
def pass_rates(s: SparkSession, d: str) -> DataFrame:
    ok = (F.trim(_plain("title")) != "") & (F.trim(_plain("summary")) != "")
    return signals_of(s, d).groupBy("source").agg(F.round(F.avg(ok.cast("double")), 6).alias("rate"), F.count("*").alias("n"))


# --- rules on invented makers: the tables name none of the fixed ones


@query(
    "maker_categories",
    """SELECT row_id::VARCHAR AS issue_id, CASE row_id % 4 WHEN 0 THEN 'medical_device' WHEN 1 THEN 'medical_device' WHEN 2 THEN 'not_healthcare' ELSE 'medical_device' END AS category FROM signals""",
)
def maker_categories(s: SparkSession, d: str) -> DataFrame:
    """The rungs of makers, one a row: named in the title; named as the vendor; within another word, which is none; within a longer vendor's name of a KEV source."""
    k = F.col("row_id") % 4
    title = F.when(k == 0, "Update for Mindray units").when(k == 2, "Update for embdzollar units").otherwise("Update for units")
    vendor = F.when(k == 1, "Philips").when(k == 3, "Masimolabs").otherwise("")
    rows = signals_of(s, d).select(F.col("row_id").cast("string").alias("issue_id"), title.alias("title"), F.lit("").alias("summary"), vendor.alias("vendor"), F.when(k == 3, F.array(F.lit("some-kev"))).otherwise(F.array(F.lit("other"))).alias("sources"), F.lit(False).alias("medical"), F.lit(None).cast("string").alias("fda_risk_class"))
    return rules.categorised(rows).select("issue_id", "category")


# --- what one run leaves to the next


@query("state_new_rows", "SELECT min(row_id) AS row_id, guid FROM signals WHERE guid IS NOT NULL AND guid <> '' GROUP BY guid HAVING min(batch_no) > 3")
def state_new_rows(s: SparkSession, d: str) -> DataFrame:
    """What the last two batches bring that the run over the others hasn't seen."""
    log = state.Log(s, shared_folder(s, "seen"), "guid string")
    rows = signals_of(s, d).select("row_id", "guid", "batch_no")
    state.new_rows(rows.where("batch_no <= 3"), log, "guid", F.col("row_id"))
    return state.new_rows(rows.where("batch_no > 3"), log, "guid", F.col("row_id")).select("row_id", "guid")


@query(
    "state_changes",
    """WITH a AS (SELECT source, count(*) AS n, max(title) AS t FROM signals WHERE batch_no <= 3 AND source < 'q' GROUP BY source), b AS (SELECT source, count(*) AS n, max(title) AS t FROM signals WHERE source > 'c' GROUP BY source)
    SELECT coalesce(b.source, a.source) AS source, CASE WHEN a.source IS NULL THEN 'added' WHEN b.source IS NULL THEN 'removed' ELSE 'changed' END AS change, f.f AS field
    FROM a FULL JOIN b ON a.source = b.source, LATERAL (SELECT unnest(CASE WHEN a.source IS NULL OR b.source IS NULL THEN [NULL] ELSE list_filter([CASE WHEN a.n IS DISTINCT FROM b.n THEN 'n' END, CASE WHEN a.t IS DISTINCT FROM b.t THEN 't' END], lambda x: x IS NOT NULL) END) AS f) f""",
)
def state_changes(s: SparkSession, d: str) -> DataFrame:
    """The log of changes after two snapshots."""
    snapshots, log = state.Log(s, shared_folder(s, "snapshots"), "source string, n long, t string"), state.Log(s, shared_folder(s, "changes"), "source string, change string, field string")
    of = lambda rows: rows.groupBy("source").agg(F.count("*").alias("n"), F.max("title").alias("t"))
    rows = signals_of(s, d)
    state.changes(of(rows.where("batch_no <= 3 and source < 'q'")), snapshots, log, "source", ["n", "t"])
    state.changes(of(rows.where("source > 'c'")), snapshots, log, "source", ["n", "t"])
    return log.read()


@query("state_memo", "SELECT issue_id, coalesce(title, '') || '!' AS result, 0 AS n_calls_again FROM issues")
def state_memo(s: SparkSession, d: str) -> DataFrame:
    """A memoised call in two runs: the second meets only what the first knows, and calls nothing."""
    cache = state.Log(s, shared_folder(s, "memo"), "hash string, result string")
    rows = plain_issues(s, d).select("issue_id", "title")
    call = lambda missing: missing.select("hash", F.concat(F.coalesce("title", F.lit("")), F.lit("!")).alias("result"))
    state.remembered(rows, cache, ["title"], call)
    again = state.remembered(rows, cache, ["title"], call)
    return again.select("issue_id", "result", F.lit(cache.read(1).count()).alias("n_calls_again"))


@query("state_feedback", "SELECT issue_id, count(*) AS n FROM (SELECT issue_id FROM issues UNION ALL SELECT issue_id FROM issues WHERE length(issue_id) % 2 = 0) GROUP BY issue_id")
def state_feedback(s: SparkSession, d: str) -> DataFrame:
    """An append-only log after two runs, rolled up by issue."""
    log = state.Log(s, shared_folder(s, "feedback"), "issue_id string, kind string")
    rows = table(s, d, "issues").select("issue_id", F.lit("useful").alias("kind"))
    log.append(rows)
    log.append(rows.where(F.length("issue_id") % 2 == 0))
    return log.read().groupBy("issue_id").agg(F.count("*").alias("n"))


@query("stream_twice", "SELECT DISTINCT user_id FROM events")
def stream_twice(s: SparkSession, d: str) -> DataFrame:
    """A stream that is run again over its own state: the second run brings nothing, the first everything."""
    folder = shared_folder(s, "stream")
    rows = lambda: streams.once(streams.arriving(s, d, "events").select("user_id"), ["user_id"])
    streams.finished(rows(), folder=folder)
    return streams.finished(rows(), folder=folder)


# --- slices and rules


_DISTINCT = "i AS (SELECT DISTINCT type, value FROM (" + ORACLE["indicators"] + "))"


@query(
    "indicator_rules",
    f"""WITH {_DISTINCT} SELECT 'acl' AS kind, 'deny ip host ' || value || ' any' AS rule FROM i WHERE type = 'ip'
    UNION ALL SELECT 'ids', 'alert dns any any -> any any (msg:"indicator ' || value || '"; dns.query; content:"' || value || '"; sid:' || (('0x' || left(md5(value), 5))::BIGINT + 1000000) || '; rev:1;)' FROM i WHERE type = 'domain'""",
)
def indicator_rules(s: SparkSession, d: str) -> DataFrame:
    return publish.detection_rules(indicators(s, d).select("type", "value").distinct())


@query("healthcare_slice", f"WITH {Q.AUTHORITY}, c AS ({Q.category()} FROM known) SELECT issue_id FROM c WHERE category = 'medical_device'")
def healthcare_slice(s: SparkSession, d: str) -> DataFrame:
    return healthcare_category(s, d).where("category = 'medical_device'").select("issue_id")
