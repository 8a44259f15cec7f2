"""Named queries of the core and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.functions import text as T
from vigilake.operators import facts, issues, lookups, nested, rules, similarity, timestamps
from vigilake.plans import sql as Q
from vigilake.tables import shared_folder, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers a query and, where SQL can say the same, its SQL."""

    def keep(f: Query) -> Query:
        QUERIES[name] = f
        if oracle:
            ORACLE[name] = oracle
        return f

    return keep


def text_of(c: str) -> F.Column:
    return F.array_join(c, ";").alias(c)


def signals_of(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "signals")


def correlated(s: SparkSession, d: str) -> DataFrame:
    return issues.correlated(signals_of(s, d))


def known(s: SparkSession, d: str) -> DataFrame:
    """Issues with the authority of their sources and a class by the last digit of their id (the tables hold no register of classes)."""
    rows = issues.with_authority(correlated(s, d), table(s, d, "sources"))
    last = F.substring("issue_id", -1, 1)
    return rows.withColumn("fda_risk_class", F.when(last.isin("1", "2", "3"), last))


def scored(s: SparkSession, d: str, version: int = 2) -> DataFrame:
    return rules.scored(known(s, d), version)


def plain_issues(s: SparkSession, d: str) -> DataFrame:
    """The issues table with empty texts and arrays for nulls."""
    empty = F.array().cast("array<string>")
    return table(s, d, "issues").select("issue_id", "issue_type", *[F.coalesce(c, empty).alias(c) for c in ("cves", "sources", "published_dates")], *[F.coalesce(c, F.lit("")).alias(c) for c in ("title", "summary", "canonical_link")], "last_seen_at")


PLAIN = "plain AS (SELECT issue_id, issue_type, coalesce(cves, []) AS cves, coalesce(sources, []) AS sources, coalesce(published_dates, []) AS published_dates, coalesce(title, '') AS title, coalesce(summary, '') AS summary, coalesce(canonical_link, '') AS canonical_link, last_seen_at FROM issues)"
# A register of vulnerabilities made from the ids that the issues name: two thirds of them are in it.
SCORES = "epss AS (SELECT cve, CAST(right(cve, 3) AS INTEGER) / 1000.0 AS epss FROM (SELECT DISTINCT unnest(cves) AS cve FROM issues) WHERE regexp_matches(cve, '[0-9]{3}$') AND CAST(right(cve, 1) AS INTEGER) % 3 <> 0)"


def register(s: SparkSession, d: str) -> DataFrame:
    ids = table(s, d, "issues").select(F.explode("cves").alias("cve")).distinct().where(F.col("cve").rlike("[0-9]{3}$"))
    return ids.where(F.substring("cve", -1, 1).cast("int") % 3 != 0).select("cve", (F.substring("cve", -3, 3).cast("int") / 1000.0).alias("epss"))


# --- problems 1 and 5


@query("p1_found")
def p1_found(s: SparkSession, d: str) -> DataFrame:
    return timestamps.found(signals_of(s, d), table(s, d, "sources"))


@query("p1_zones")
def p1_zones(s: SparkSession, d: str) -> DataFrame:
    """The estimated offset history of each source beside the registered one."""
    return timestamps.agreement(signals_of(s, d), table(s, d, "sources"))


@query("p5_children")
def p5_children(s: SparkSession, d: str) -> DataFrame:
    return nested.flat_tables(table(s, d, "advisory_records"), table(s, d, "remediation_packets"))


def routed(s: SparkSession, d: str) -> str:
    return nested.route(p5_children(s, d), shared_folder(s, "subtypes"))


@query("p5_found")
def p5_found(s: SparkSession, d: str) -> DataFrame:
    return nested.supertype(s, routed(s, d)).select("kind", "rec_id", "parent_path", "path")


@query("p5_subtypes")
def p5_subtypes(s: SparkSession, d: str) -> DataFrame:
    """``(kind, subtype, n_rows)``: how many rows each typed table has."""
    return nested.supertype(s, routed(s, d)).groupBy("kind", "subtype").agg(F.count("*").alias("n_rows"))


@query("p5_versions")
def p5_versions(s: SparkSession, d: str) -> DataFrame:
    """One of the typed tables: versions with their fix, below record or product."""
    return nested.typed(s, routed(s, d), "version").select("rec_id", "parent_path", "path", "version", "fixed_in")


@query("p5_variants")
def p5_variants(s: SparkSession, d: str) -> DataFrame:
    """``(kind, field, subtype, variant, n_rows, n_states)``: the shapes that each subtype takes in."""
    return p5_children(s, d).groupBy("kind", "field", "subtype", "variant").agg(F.count("*").alias("n_rows"), F.countDistinct("state").alias("n_states"))


# --- signals


@query("signal_ids", f"WITH {Q.SIG} SELECT row_id, signal_id FROM sig")
def signal_ids(s: SparkSession, d: str) -> DataFrame:
    return issues.cleaned(signals_of(s, d)).select("row_id", "signal_id")


@query("signal_texts", f"WITH {Q.SIG} SELECT row_id, {Q.norm_title('title')} AS norm_title, regexp_replace(link, '[^A-Za-z0-9_-]', '_', 'g') AS stem, length(summary) // 4 AS tokens FROM sig")
def signal_texts(s: SparkSession, d: str) -> DataFrame:
    rows = issues.cleaned(signals_of(s, d))
    return rows.select("row_id", T.norm_title(F.col("title")).alias("norm_title"), T.safe_stem(F.col("link")).alias("stem"), T.token_estimate(F.col("summary")).alias("tokens"))


@query("signal_cves", f"WITH {Q.KEYED} SELECT row_id, issue_id, issue_type FROM ided")
def signal_cves(s: SparkSession, d: str) -> DataFrame:
    return issues.keyed(signals_of(s, d)).select("row_id", "issue_id", "issue_type")


@query("limit_per_source", "SELECT source, row_id, pos FROM (SELECT source, row_id, row_number() OVER (PARTITION BY source ORDER BY row_id) AS pos FROM signals) WHERE pos <= 20")
def limit_per_source(s: SparkSession, d: str) -> DataFrame:
    return issues.first_per_source(signals_of(s, d), 20).select("source", "row_id", "pos")


@query("early_stop_issues", f"WITH {Q.KEYED} SELECT issue_id, min(row_id) AS first_row FROM ided GROUP BY issue_id ORDER BY first_row, issue_id LIMIT 100")
def early_stop_issues(s: SparkSession, d: str) -> DataFrame:
    return issues.early_stop(signals_of(s, d), 100)


@query(
    "source_filter",
    f"""SELECT row_id FROM signals, (SELECT 1) WHERE (contains(lower({Q.strip('title')} || ' ' || {Q.strip('summary')}), 'firmware') OR contains(lower({Q.strip('title')} || ' ' || {Q.strip('summary')}), 'password'))
    AND contains(lower({Q.strip('title')} || ' ' || {Q.strip('summary')}), 'version') AND ({Q.strip('link')} = '' OR regexp_matches({Q.strip('link')}, '(?i)^https://')) AND ({Q.strip('link')} = '' OR NOT regexp_matches({Q.strip('link')}, '(?i)/view'))""",
)
def source_filter(s: SparkSession, d: str) -> DataFrame:
    return issues.filtered(signals_of(s, d), ["firmware", "password"], ["version"], r"^https://", r"/view").select("row_id")


@query(
    "new_items",
    f"""WITH {Q.SIG}, later AS (
        SELECT * FROM sig l WHERE batch_no > 2 AND NOT EXISTS (SELECT 1 FROM sig o WHERE o.batch_no <= 2 AND o.source = l.source AND o.guid = l.guid AND o.guid <> '')
        AND NOT EXISTS (SELECT 1 FROM sig o WHERE o.batch_no <= 2 AND o.source = l.source AND o.signal_id = l.signal_id AND o.signal_id <> '')),
    once AS (SELECT *, CASE WHEN guid = '' THEN 1 ELSE row_number() OVER (PARTITION BY source, guid ORDER BY row_id) END AS g, CASE WHEN signal_id = '' THEN 1 ELSE row_number() OVER (PARTITION BY source, signal_id ORDER BY row_id) END AS i FROM later)
    SELECT row_id, source FROM once WHERE g = 1 AND i = 1""",
)
def new_items(s: SparkSession, d: str) -> DataFrame:
    return issues.new_items(signals_of(s, d), 2).select("row_id", "source")


@query("kev_promotion", "SELECT row_id, coalesce(nullif(kev_vendor, ''), '') AS vendor, coalesce(nullif(kev_product, ''), '') AS product, coalesce(nullif(kev_required_action, ''), '') AS required FROM signals WHERE coalesce(kev_vendor, kev_product, kev_required_action, '') <> ''")
def kev_promotion(s: SparkSession, d: str) -> DataFrame:
    fields = {"vendor": "kev_vendor", "product": "kev_product", "required": "kev_required_action"}
    rows = signals_of(s, d).where(F.coalesce(*fields.values(), F.lit("")) != "")
    return rows.select("row_id", *[F.coalesce(T.some(F.col(c)), F.lit("")).alias(k) for k, c in fields.items()])


# --- issues and scores

_ISSUE = ["issue_id", "issue_type", "title", "summary", "canonical_link", "first_seen_at", "last_seen_at", "n_signals", "n_sources", "n_links"]


@query("correlate_issues", f"WITH {Q.ISSUES} SELECT {', '.join(_ISSUE[:8])}, len(coalesce(sources, [])) AS n_sources, len(coalesce(links, [])) AS n_links, {Q.joined('sources')} AS sources, {Q.joined('cves')} AS cves FROM (SELECT * REPLACE (coalesce(sources, []) AS sources, coalesce(cves, []) AS cves) FROM iss)")
def correlate_issues(s: SparkSession, d: str) -> DataFrame:
    return correlated(s, d).select(*_ISSUE, text_of("sources"), text_of("cves"))


@query("source_authority", f"WITH {Q.AUTHORITY} SELECT issue_id, best_source, tier, weight, coalesce(medical, false) AS medical FROM known")
def source_authority(s: SparkSession, d: str) -> DataFrame:
    return known(s, d).select("issue_id", "best_source", "tier", "weight", F.coalesce("medical", F.lit(False)).alias("medical"))


for _v in (1, 2):

    @query(f"score_v{_v}", f"WITH {Q.scored(_v)} SELECT issue_id, score, priority, {Q.actions('priority')} AS actions, why FROM scored")
    def _score(s: SparkSession, d: str, version: int = _v) -> DataFrame:
        return scored(s, d, version).select("issue_id", "score", "priority", "actions", "why")


@query("top_alerts", f"WITH {Q.scored(2)} SELECT issue_id, score, priority, title FROM scored WHERE score >= 60 ORDER BY score DESC, issue_id LIMIT 50")
def top_alerts(s: SparkSession, d: str) -> DataFrame:
    rows = scored(s, d).where(rules.priority_rank(F.col("priority")) >= 1)
    return rows.orderBy(F.desc("score"), "issue_id").limit(50).select("issue_id", "score", "priority", "title")


@query(
    "rescore_after_enrichment",
    f"""WITH {Q.scored(1)}, r AS (SELECT issue_id, score + CASE fda_risk_class WHEN '3' THEN 30 WHEN '2' THEN 10 ELSE 0 END + CASE WHEN contains(array_to_string(sources, ' '), 'kev') AND fda_risk_class IS NOT NULL THEN 40 ELSE 0 END AS score FROM scored)
    SELECT issue_id, score, {Q.priority('score')} AS priority FROM r""",
)
def rescore_after_enrichment(s: SparkSession, d: str) -> DataFrame:
    rows = scored(s, d, 1).withColumn("is_kev_medical", F.array_join("sources", " ").contains("kev") & F.col("fda_risk_class").isNotNull())
    return rules.rescored(rows).select("issue_id", "score", "priority")


_FLAGS = ["kev", "active_exploitation", "poc", "ransomware", "rce", "priv_esc", "auth_bypass", "data_exfil"]


@query(
    "tags",
    f"""WITH {Q.ISSUES}, t AS (SELECT issue_id, cves, lower(array_to_string(coalesce(sources, []), ' ')) AS src, lower(title || chr(10) || summary) AS body FROM iss), u AS (SELECT *, src || chr(10) || body AS x FROM t), v AS (
    SELECT issue_id, len(coalesce(cves, [])) > 0 OR regexp_matches({Q.latin("(issue_id || ' ' || body)")}, '(?i)\\bCVE-\\d{{4}}-\\d{{4,7}}\\b') AS has, contains(src, 'kev') OR contains(x, 'known exploited') AS kev, contains(x, 'actively exploited') OR contains(x, 'active exploitation') AS active_exploitation,
    contains(x, 'proof of concept') OR regexp_matches({Q.latin('x')}, '\\bpoc\\b') AS poc, contains(x, 'ransomware') AS ransomware, contains(body, 'code execution') OR regexp_matches({Q.latin('body')}, '\\brce\\b') AS rce,
    contains(body, 'privilege escalation') OR contains(body, 'priv esc') AS priv_esc, contains(body, 'authentication bypass') OR contains(body, 'auth bypass') AS auth_bypass, contains(body, 'exfiltration') AS data_exfil FROM u)
    SELECT issue_id, {', '.join(_FLAGS)}, round_even(least(1.0, 0.4 + CASE WHEN has THEN 0.2 ELSE 0 END + CASE WHEN kev THEN 0.3 ELSE 0 END + CASE WHEN active_exploitation THEN 0.1 ELSE 0 END)::DOUBLE, 2) AS confidence FROM v""",
)
def tags(s: SparkSession, d: str) -> DataFrame:
    return rules.tagged(correlated(s, d))


@query("healthcare_category", f"WITH {Q.AUTHORITY} {Q.category()} FROM known")
def healthcare_category(s: SparkSession, d: str) -> DataFrame:
    return rules.categorised(known(s, d))


@query("category_counts", f"WITH {Q.AUTHORITY}, c AS ({Q.category()} FROM known) SELECT category, count(*) AS n FROM c GROUP BY category")
def category_counts(s: SparkSession, d: str) -> DataFrame:
    return healthcare_category(s, d).groupBy("category").agg(F.count("*").alias("n"))


@query("cyber_relevance", f"SELECT row_id FROM signals WHERE regexp_matches(concat_ws(' ', coalesce(title, ''), coalesce(summary, ''), coalesce(kev_required_action, ''), coalesce(kev_vulnerability_name, '')), '(?i){'|'.join(rules.CYBER)}')")
def cyber_relevance(s: SparkSession, d: str) -> DataFrame:
    return signals_of(s, d).where(rules.cyber(*[F.col(c) for c in ("title", "summary", "kev_required_action", "kev_vulnerability_name")])).select("row_id")


# --- enrichment


@query(
    "epss_first_match",
    f"""WITH {PLAIN}, {SCORES}, c AS (SELECT issue_id, CASE WHEN starts_with(issue_id, 'CVE-') THEN list_distinct([issue_id] || cves) ELSE cves END AS cs, CASE WHEN starts_with(issue_id, 'CVE-') THEN [issue_id] || cves ELSE cves END AS o FROM plain),
    e AS (SELECT issue_id, unnest(o) AS cve, unnest(range(1, len(o) + 1)) AS pos FROM c), m AS (SELECT issue_id, first(cve ORDER BY pos) AS matched_cve, first(epss ORDER BY pos) AS epss FROM e JOIN epss USING (cve) GROUP BY issue_id)
    SELECT issue_id, matched_cve, epss FROM plain LEFT JOIN m USING (issue_id)""",
)
def epss_first_match(s: SparkSession, d: str) -> DataFrame:
    return lookups.first_match(plain_issues(s, d).select("issue_id", "cves"), register(s, d)).select("issue_id", "matched_cve", "epss")


@query("cwe_names", f"WITH {PLAIN}, {SCORES}, e AS (SELECT issue_id, unnest(cves) AS cve, unnest(range(1, len(cves) + 1)) AS pos FROM plain) SELECT issue_id, string_agg('E' || CAST(epss AS DECIMAL(4,3)), ';' ORDER BY pos) AS names FROM e JOIN epss USING (cve) GROUP BY issue_id")
def cwe_names(s: SparkSession, d: str) -> DataFrame:
    names = register(s, d).select("cve", F.concat(F.lit("E"), F.col("epss").cast("decimal(4,3)").cast("string")).alias("name"))
    return lookups.names_of(plain_issues(s, d), "cves", names, "cve", "name")


@query("source_class_exact", f"WITH {PLAIN}, e AS (SELECT DISTINCT issue_id, unnest(sources) AS source_id FROM plain) SELECT issue_id, source_id, tier, page_type FROM e JOIN sources USING (source_id)")
def source_class_exact(s: SparkSession, d: str) -> DataFrame:
    each = plain_issues(s, d).select("issue_id", F.explode("sources").alias("source_id")).distinct()
    return each.join(table(s, d, "sources").select("source_id", "tier", "page_type"), "source_id")


@query(
    "name_containment",
    """WITH p AS (SELECT kev_product AS product, min(row_id) AS ord FROM signals WHERE length(kev_product) >= 4 GROUP BY kev_product), t AS (SELECT row_id, title FROM signals WHERE length(title) >= 4 AND kev_product IS NULL),
    h AS (SELECT row_id, product, ord FROM t, p WHERE contains(lower(title), lower(product)) OR contains(lower(product), lower(title))) SELECT row_id, first(product ORDER BY ord) AS product, min(ord) AS ord FROM h GROUP BY row_id""",
)
def name_containment(s: SparkSession, d: str) -> DataFrame:
    rows = signals_of(s, d)
    products = rows.where(F.length("kev_product") >= 4).groupBy(F.col("kev_product").alias("product")).agg(F.min("row_id").alias("ord"))
    return lookups.contained(rows.where("kev_product is null").select("row_id", "title"), products, "title", "product", "ord").select("row_id", "product", "ord")


@query(
    "cross_source_mitigations",
    """WITH e AS (SELECT DISTINCT issue_id, unnest(cves) AS cve FROM issue_records), own AS (SELECT DISTINCT issue_id, source FROM issue_records WHERE source IS NOT NULL), donors AS (SELECT DISTINCT e.cve, own.source FROM e JOIN own USING (issue_id)),
    h AS (SELECT e.issue_id, d.source, e.cve FROM e JOIN donors d USING (cve) WHERE NOT EXISTS (SELECT 1 FROM own WHERE own.issue_id = e.issue_id AND own.source = d.source))
    SELECT issue_id, source || ' (via ' || min(cve) || ')' AS via FROM h GROUP BY issue_id, source""",
)
def cross_source_mitigations(s: SparkSession, d: str) -> DataFrame:
    """What sources of issues that share a CVE say and the issue's own sources don't."""
    own = table(s, d, "issue_records").select("issue_id", "source").where("source is not null").distinct()
    each = table(s, d, "issue_records").where("issue_id is not null").select("issue_id", F.explode("cves").alias("cve")).distinct()
    donors = each.join(own, "issue_id").select("cve", "source").distinct()
    lacking = each.join(donors, "cve").join(own, ["issue_id", "source"], "left_anti")
    return lacking.groupBy("issue_id", "source").agg(F.min("cve").alias("cve")).select("issue_id", F.concat("source", F.lit(" (via "), "cve", F.lit(")")).alias("via"))


# --- facts


@query(
    "source_facts",
    f"""WITH r AS (SELECT issue_id, source, {Q.latin("(coalesce(title, '') || ' ' || coalesce(summary, ''))")} AS t FROM issue_records WHERE issue_id IS NOT NULL AND source IS NOT NULL)
    SELECT DISTINCT issue_id, source, 'severity' AS kind, CASE lower(x) WHEN 'moderate' THEN 'medium' ELSE lower(x) END AS fact FROM (SELECT issue_id, source, unnest(regexp_extract_all(t, {Q.q(facts.SEVERITY)}, 1)) AS x FROM r)
    UNION SELECT DISTINCT issue_id, source, 'cve', upper(x) FROM (SELECT issue_id, source, unnest(regexp_extract_all(t, '(?i)\\bCVE-\\d{{4}}-\\d{{4,7}}\\b')) AS x FROM r)
    """
    + " ".join(f"UNION SELECT DISTINCT issue_id, source, '{'exploit' if k in ('actively_exploited', 'poc_available') else 'patch'}', '{k}' FROM r WHERE regexp_matches(t, {Q.q(p)})" for k, p in facts.STATEMENTS.items()),
)
def source_facts(s: SparkSession, d: str) -> DataFrame:
    return facts.source_facts(table(s, d, "issue_records"))


_FACTS = f"f AS ({ORACLE['source_facts'].replace('WITH r AS', 'WITH r AS', 1)}), sp AS (SELECT issue_id, kind, count(DISTINCT source) AS n_speaking FROM f GROUP BY issue_id, kind), tl AS (SELECT issue_id, kind, fact, count(DISTINCT source) AS n_sources FROM f GROUP BY issue_id, kind, fact)"


@query("consensus", f"WITH {_FACTS} SELECT issue_id, kind, fact, n_sources, n_speaking, CASE WHEN n_speaking = 1 THEN 'single' WHEN n_sources = n_speaking THEN 'agreed' WHEN n_sources = 1 THEN 'unique' ELSE 'disputed' END AS status FROM tl JOIN sp USING (issue_id, kind)")
def consensus(s: SparkSession, d: str) -> DataFrame:
    return facts.consensus(source_facts(s, d)).select("issue_id", "kind", "fact", "n_sources", "n_speaking", "status")


@query("consensus_conflicts", f"WITH {_FACTS} SELECT issue_id, kind, count(DISTINCT fact) AS n_values, count(DISTINCT source) AS n_sources FROM f WHERE kind IN ('severity', 'patch') GROUP BY issue_id, kind HAVING count(DISTINCT fact) > 1 AND count(DISTINCT source) > 1")
def consensus_conflicts(s: SparkSession, d: str) -> DataFrame:
    return facts.conflicts(source_facts(s, d))


@query("remediation_steps", f"WITH {Q.ISSUES}, w AS (SELECT issue_id, {Q.weakness('title || chr(32) || summary')} AS kind FROM iss) SELECT issue_id, kind, {Q.steps('kind')} AS steps FROM w")
def remediation_steps(s: SparkSession, d: str) -> DataFrame:
    hay = F.concat_ws(" ", "title", "summary")
    return correlated(s, d).select("issue_id", facts.weakness(hay).alias("kind"), facts.remediation(F.lit(None).cast("string"), hay).alias("steps"))


@query("summary_sentences")
def summary_sentences(s: SparkSession, d: str) -> DataFrame:
    return correlated(s, d).select("issue_id", facts.own_sentences(F.col("summary"), F.col("issue_id")).alias("summary"))


_HAY = "coalesce(title, '') || ' ' || coalesce(summary, '') || ' ' || coalesce(guid, '') || ' ' || coalesce(link, '')"


@query(
    "indicators",
    f"""WITH t AS (SELECT row_id, {_HAY} AS t, {Q.latin(_HAY)} AS w FROM signals), a AS (
    SELECT row_id, 'cve' AS type, upper(unnest(regexp_extract_all(w, '(?i)\\bCVE-\\d{{4}}-\\d{{4,}}\\b'))) AS value FROM t
    UNION SELECT row_id, 'hash_sha256', lower(unnest(regexp_extract_all(w, {Q.q(facts.SHA256)}, 1))) FROM t UNION SELECT row_id, 'hash_sha1', lower(unnest(regexp_extract_all(w, {Q.q(facts.SHA1)}, 1))) FROM t
    UNION SELECT row_id, 'hash_md5', lower(unnest(regexp_extract_all(w, {Q.q(facts.MD5)}, 1))) FROM t UNION SELECT row_id, 'url', regexp_replace(unnest(regexp_extract_all(t, {Q.q(facts.URL)})), '[.,;:)]+$', '') FROM t
    UNION SELECT row_id, 'domain', lower(unnest(regexp_extract_all(t, {Q.q(facts.DOMAIN)}, 1))) FROM t UNION SELECT row_id, 'ip', unnest(regexp_extract_all(t, {Q.q(facts.IPV4)}, 1)) FROM t)
    SELECT row_id, type, value FROM a WHERE (type <> 'domain' OR (value NOT IN ({', '.join(map(Q.q, facts.NO_DOMAINS))}) AND regexp_matches(value, '\\.[a-z]{{2,}}$') AND NOT regexp_matches(value, '^\\d')))
    AND (type <> 'ip' OR (len(list_filter(string_split(value, '.'), lambda x: CAST(x AS INTEGER) > 255)) = 0 AND CAST(split_part(value, '.', 1) AS INTEGER) NOT IN (0, 127, 255) AND len(list_filter(string_split(value, '.'), lambda x: CAST(x AS INTEGER) >= 32)) > 0))""",
)
def indicators(s: SparkSession, d: str) -> DataFrame:
    rows = signals_of(s, d)
    return facts.indicators(rows, "row_id", F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("title", "summary", "guid", "link")]))


_NAMES = {"ip": "ipv4-addr:value", "domain": "domain-name:value", "url": "url:value", "cve": "vulnerability:name", "hash_sha256": "file:hashes.'SHA-256'", "hash_sha1": "file:hashes.'SHA-1'", "hash_md5": "file:hashes.'MD5'"}
_PATTERN = "CASE type " + " ".join(f"WHEN '{k}' THEN {Q.q('[' + n + ' = ' + chr(39))} || replace(value, chr(39), chr(92) || chr(39)) || chr(39) || ']'" for k, n in _NAMES.items()) + " END"


@query("stix_patterns", f"SELECT DISTINCT type, value, {_PATTERN} AS pattern FROM ({ORACLE['indicators']})")
def stix_patterns(s: SparkSession, d: str) -> DataFrame:
    return indicators(s, d).select("type", "value").distinct().select("type", "value", facts.stix_pattern(F.col("type"), F.col("value")).alias("pattern"))


# --- similarity and merging


def _jac(x: str) -> str:
    return f"CASE WHEN len(a.{x}) + len(b.{x}) = 0 THEN 0.0 ELSE len(list_intersect(a.{x}, b.{x}))::DOUBLE / (len(a.{x}) + len(b.{x}) - len(list_intersect(a.{x}, b.{x}))) END"


_PREP = f"""{PLAIN}, prep AS (SELECT issue_id, list_sort(list_distinct(cves)) AS c, list_sort({Q.tokens("title || ' ' || left(summary, 300)")}) AS v, list_sort({Q.tokens('summary')}) AS s,
    list_min(list_transform(published_dates, lambda x: TRY_CAST(nullif(regexp_extract(x, '\\d{{4}}-\\d{{2}}-\\d{{2}}'), '') AS DATE))) AS d FROM plain),
reps AS (SELECT min(issue_id) AS issue_id, c, v, s, d, count(*) AS members FROM prep GROUP BY c, v, s, d)"""
_PAIRS = f"""{_PREP}, sims AS (SELECT a.issue_id AS id_a, b.issue_id AS id_b, len(a.c) > 0 AS ca, len(b.c) > 0 AS cb, {_jac('c')} AS jc, {_jac('v')} AS jv, {_jac('s')} AS js,
    CASE WHEN a.d IS NULL OR b.d IS NULL THEN 0.5 WHEN abs(datediff('day', a.d, b.d)) <= 90 THEN 1.0 WHEN abs(datediff('day', a.d, b.d)) <= 180 THEN 1.0 - (abs(datediff('day', a.d, b.d)) - 90) / 90.0 ELSE 0.0 END AS dt FROM reps a JOIN reps b ON a.issue_id < b.issue_id),
pairs AS (SELECT id_a, id_b, round_even((CASE WHEN ca AND cb AND jc = 0 THEN 0.0 WHEN NOT ca AND NOT cb THEN 0.54 * jv + 0.36 * js + 0.1 * dt ELSE 0.4 * jc + 0.3 * jv + 0.2 * js + 0.1 * dt END)::DOUBLE, 4) AS score FROM sims)"""


@query("merge_candidates", f"WITH {_PAIRS} SELECT id_a, id_b, score FROM pairs WHERE score >= 0.6")
def merge_candidates(s: SparkSession, d: str) -> DataFrame:
    return similarity.merge_candidates(plain_issues(s, d))


@query("issue_classes", f"WITH {_PREP} SELECT issue_id, len(c) AS n_cves, len(v) AS n_vendor_tokens, len(s) AS n_summary_tokens, members FROM reps")
def issue_classes(s: SparkSession, d: str) -> DataFrame:
    return similarity.prepared(plain_issues(s, d)).select("issue_id", F.size("c").alias("n_cves"), F.size("v").alias("n_vendor_tokens"), F.size("s").alias("n_summary_tokens"), "members")


_ROOTS = """e AS (SELECT candidate_a AS a, candidate_b AS b FROM merge_decisions WHERE same_issue AND confidence >= 0.7 AND candidate_a <> candidate_b UNION SELECT candidate_b, candidate_a FROM merge_decisions WHERE same_issue AND confidence >= 0.7 AND candidate_a <> candidate_b),
r(id, seen) AS (SELECT a, a FROM e UNION SELECT r.id, e.b FROM r JOIN e ON r.seen = e.a), roots AS (SELECT id, first(seen ORDER BY NOT starts_with(seen, 'CVE-'), seen) AS root FROM r GROUP BY id)"""


def _merges(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "merge_decisions").where(F.col("same_issue") & (F.col("confidence") >= 0.7)).select(F.col("candidate_a").alias("a"), F.col("candidate_b").alias("b"))


@query("merge_components", f"WITH RECURSIVE {_ROOTS} SELECT id, root FROM roots")
def merge_components(s: SparkSession, d: str) -> DataFrame:
    return issues.merged_components(_merges(s, d)).select("id", F.col("root"))


@query(
    "merged_issues",
    f"""WITH RECURSIVE {_ROOTS}, {PLAIN}, m AS (SELECT p.*, coalesce(root, issue_id) AS root FROM plain p LEFT JOIN roots ON id = issue_id)
    SELECT root, count(*) AS n_issues, array_to_string(list_sort(list_distinct(flatten(list(cves)))), ';') AS cves, array_to_string(list_sort(list_distinct(flatten(list(sources)))), ';') AS sources, first(title ORDER BY length(title) DESC, title) FILTER (title <> '') AS title FROM m GROUP BY root""",
)
def merged_issues(s: SparkSession, d: str) -> DataFrame:
    rows = issues.merged(plain_issues(s, d), merge_components(s, d))
    return rows.select("root", "n_issues", text_of("cves"), text_of("sources"), "title")


# --- snapshots, feed, counters, search


def _cut(s: SparkSession, d: str, last: int) -> DataFrame:
    rows = issues.correlated(signals_of(s, d).where(F.col("batch_no") <= last))
    full = issues.with_authority(rows, table(s, d, "sources")).withColumn("fda_risk_class", F.lit(None).cast("string"))
    return rules.scored(full, 1)


@query("snapshot_changes")
def snapshot_changes(s: SparkSession, d: str) -> DataFrame:
    return issues.changes(_cut(s, d, 3), _cut(s, d, 5))


@query("snapshot_ids", f"WITH {Q.KEYED} SELECT issue_id, CASE WHEN min(batch_no) > 3 THEN 'new' ELSE 'kept' END AS state FROM ided GROUP BY issue_id")
def snapshot_ids(s: SparkSession, d: str) -> DataFrame:
    rows = issues.keyed(signals_of(s, d)).groupBy("issue_id").agg(F.min("batch_no").alias("b"))
    return rows.select("issue_id", F.when(F.col("b") > 3, "new").otherwise("kept").alias("state"))


@query(
    "feed_projection",
    f"""WITH {Q.scored(2)} SELECT issue_id, coalesce(nullif(title, ''), issue_id) AS title, score, priority, {Q.joined('coalesce(cves, [])')} AS cves, {Q.joined('coalesce(sources, [])')} AS sources, canonical_link, coalesce(last_seen_at, '') AS last_seen_at, coalesce(fda_risk_class, '') AS fda_risk_class,
    CASE WHEN tier <= 4 THEN tier ELSE 4 END AS tier, CAST(summary <> '' AS INTEGER) + CAST(len(coalesce(cves, [])) > 0 AS INTEGER) + CAST(canonical_link <> '' AS INTEGER) + CAST(len(coalesce(sources, [])) > 0 AS INTEGER) + CAST(len(coalesce(published_dates, [])) > 0 AS INTEGER) AS evidence FROM scored""",
)
def feed_projection(s: SparkSession, d: str) -> DataFrame:
    some = lambda c: (F.size(c) > 0).cast("int")
    evidence = (F.col("summary") != "").cast("int") + some("cves") + (F.col("canonical_link") != "").cast("int") + some("sources") + some("published_dates")
    return scored(s, d).select(
        "issue_id", F.coalesce(T.some(F.col("title")), F.col("issue_id")).alias("title"), "score", "priority", text_of("cves"), text_of("sources"), "canonical_link", F.coalesce("last_seen_at", F.lit("")).alias("last_seen_at"),
        F.coalesce("fda_risk_class", F.lit("")).alias("fda_risk_class"), F.when(F.col("tier") <= 4, F.col("tier")).otherwise(4).alias("tier"), evidence.alias("evidence"),
    )


@query("feed_latest", f"WITH {Q.scored(2)} SELECT issue_id, score, coalesce(last_seen_at, '') AS last_seen_at FROM scored ORDER BY score DESC, coalesce(last_seen_at, ''), issue_id LIMIT 200")
def feed_latest(s: SparkSession, d: str) -> DataFrame:
    rows = scored(s, d).select("issue_id", "score", F.coalesce("last_seen_at", F.lit("")).alias("last_seen_at"))
    return rows.orderBy(F.desc("score"), "last_seen_at", "issue_id").limit(200)


@query("feed_slices", f"WITH {Q.scored(2)}, c AS ({Q.category()} FROM known) SELECT issue_id, relevant AS healthcare, fda_risk_class = '3' AS class_three, priority IN ('P0', 'P1') AS urgent FROM (SELECT issue_id, priority, coalesce(fda_risk_class, '') AS fda_risk_class FROM scored) JOIN c USING (issue_id)")
def feed_slices(s: SparkSession, d: str) -> DataFrame:
    rows = scored(s, d).select("issue_id", (F.coalesce("fda_risk_class", F.lit("")) == "3").alias("class_three"), F.col("priority").isin("P0", "P1").alias("urgent"))
    return rows.join(healthcare_category(s, d).select("issue_id", F.col("relevant").alias("healthcare")), "issue_id").select("issue_id", "healthcare", "class_three", "urgent")


@query(
    "sanity_counters",
    f"""WITH {Q.scored(2)} SELECT count(*) AS n, count(*) FILTER (priority = 'P0') AS p0, count(*) FILTER (priority = 'P1') AS p1, count(*) FILTER (priority = 'P2') AS p2, count(*) FILTER (len(coalesce(sources, [])) >= 2) AS two_sources, count(*) FILTER (summary = '') AS no_summary,
    count(*) FILTER (canonical_link = '') AS no_link, max(last_seen_at) AS latest, floor(100 * count(*) FILTER (summary <> '') / count(*))::BIGINT AS summary_percent FROM scored""",
)
def sanity_counters(s: SparkSession, d: str) -> DataFrame:
    n = lambda c: F.count(F.when(c, 1))
    return scored(s, d).agg(
        F.count("*").alias("n"), *[n(F.col("priority") == p).alias(p.lower()) for p in ("P0", "P1", "P2")], n(F.size("sources") >= 2).alias("two_sources"), n(F.col("summary") == "").alias("no_summary"),
        n(F.col("canonical_link") == "").alias("no_link"), F.max("last_seen_at").alias("latest"), F.floor(100 * n(F.col("summary") != "") / F.count("*")).alias("summary_percent"),
    )


@query("score_percentiles", f"WITH {Q.scored(2)}, r AS (SELECT score, row_number() OVER (ORDER BY score) - 1 AS k, count(*) OVER () AS n FROM scored), p AS (SELECT unnest([0.25, 0.5, 0.75, 0.9, 0.99])::DOUBLE AS share) SELECT share, score AS value FROM p, r WHERE k = least(floor(n * share), n - 1)")
def score_percentiles(s: SparkSession, d: str) -> DataFrame:
    return lookups.percentiles(scored(s, d), "score", [0.25, 0.5, 0.75, 0.9, 0.99])


@query("score_histogram", f"WITH {Q.scored(2)} SELECT score // 25 AS bucket, count(*) AS n FROM scored GROUP BY 1")
def score_histogram(s: SparkSession, d: str) -> DataFrame:
    return scored(s, d).groupBy(F.floor(F.col("score") / 25).cast("int").alias("bucket")).agg(F.count("*").alias("n"))


@query("distribution_top", "SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 30")
def distribution_top(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source").limit(30)


@query("date_histogram", f"WITH {Q.SIG} SELECT regexp_extract(fetched_at, '^\\d{{4}}-\\d{{2}}') AS month, count(*) AS n FROM sig GROUP BY 1")
def date_histogram(s: SparkSession, d: str) -> DataFrame:
    return issues.cleaned(signals_of(s, d)).groupBy(F.regexp_extract("fetched_at", r"^\d{4}-\d{2}", 0).alias("month")).agg(F.count("*").alias("n"))


@query("category_samples", "SELECT doc_type, first(doc_id ORDER BY length(coalesce(text, '')) DESC, doc_id) AS doc_id, max(length(coalesce(text, ''))) AS n_chars FROM documents GROUP BY doc_type")
def category_samples(s: SparkSession, d: str) -> DataFrame:
    return lookups.richest(table(s, d, "documents"), "doc_type", "text", "doc_id")


def _quality(c: str, tokens: list[str]) -> str:
    got = f"len(list_intersect({Q.tokens(c, 2, False)}, {tokens}))"
    return f"CASE WHEN contains(lower({c}), '{' '.join(tokens)}') THEN 3 WHEN {got} = {len(tokens)} THEN 2 WHEN {got} > 0 THEN 1 ELSE 0 END"


_LOOK = ["infusion", "pump"]


@query(
    "product_lookup",
    f"""WITH {Q.scored(2)}, m AS (SELECT issue_id, score, {_quality('title', _LOOK)} AS qt, {_quality('summary', _LOOK)} AS qs, {_quality('issue_id', _LOOK)} AS qi FROM scored), b AS (SELECT *, greatest(qt, qs, qi) AS quality FROM m)
    SELECT issue_id, quality, CASE WHEN qt = quality THEN 'title' WHEN qs = quality THEN 'summary' ELSE 'issue_id' END AS field, score FROM b WHERE quality > 0 ORDER BY score DESC, quality DESC, issue_id LIMIT 20""",
)
def product_lookup(s: SparkSession, d: str) -> DataFrame:
    return lookups.lookup(scored(s, d), "Infusion pump", 20)


_ASK = ["sql", "injection", "ventilator"]


@query(
    "qa_context",
    f"WITH {Q.scored(2)}, m AS (SELECT issue_id, score, {' + '.join(f'CASE WHEN list_contains({Q.tokens("title", 2, False)}, {Q.q(t)}) THEN 2 WHEN list_contains({Q.tokens("summary", 2, False)}, {Q.q(t)}) THEN 1 ELSE 0 END' for t in _ASK)} AS relevance FROM scored) SELECT issue_id, relevance, score FROM m WHERE relevance > 0 ORDER BY relevance DESC, score DESC, issue_id LIMIT 10",
)
def qa_context(s: SparkSession, d: str) -> DataFrame:
    return lookups.relevant(scored(s, d), "SQL injection ventilator?", 10)


@query("dashboard_filter", f"WITH {Q.scored(2)} SELECT issue_id, score FROM scored WHERE contains(lower(title || ' ' || summary || ' ' || issue_id), 'ventilator') AND priority <> 'P3' AND len(coalesce(sources, [])) >= 2 ORDER BY lower(title), issue_id")
def dashboard_filter(s: SparkSession, d: str) -> DataFrame:
    rows = scored(s, d).where(F.lower(F.concat_ws(" ", "title", "summary", "issue_id")).contains("ventilator") & (F.col("priority") != "P3") & (F.size("sources") >= 2))
    return rows.orderBy(F.lower("title"), "issue_id").select("issue_id", "score")


@query("html_text")
def html_text(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", T.strip_html(F.col("text")).alias("line"), T.strip_html(F.col("text"), "\n").alias("lines"))


@query("prompt_sanitized", r"SELECT doc_id, length(regexp_replace(text, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g')) > 12000 AS was_cut FROM documents WHERE text IS NOT NULL")
def prompt_sanitized(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").where("text is not null").select("doc_id", T.sanitize_for_prompt(F.col("text")).endswith("[TRUNCATED]").alias("was_cut"))


@query("content_hashes", "SELECT doc_id, 'adv_' || left(sha256(text), 12) AS advisory_id FROM documents WHERE text IS NOT NULL")
def content_hashes(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").where("text is not null").select("doc_id", T.advisory_id(F.sha2("text", 256)).alias("advisory_id"))


@query("cost_model", "SELECT source, sum(length(text) // 4)::BIGINT AS tokens, round(sum(length(text) // 4) * 0.15 / 1000000, 9) AS cost FROM documents WHERE text IS NOT NULL GROUP BY source")
def cost_model(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "documents").where("text is not null").groupBy("source").agg(F.sum(T.token_estimate(F.col("text"))).alias("tokens"))
    return rows.withColumn("cost", F.round(F.col("tokens") * 0.15 / 1000000, 9))
