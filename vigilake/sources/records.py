"""Reference records (vulnerabilities, recalls, advisories, techniques) -> flat dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.functions import text as T

_METRIC = "array<struct<cvssData: struct<baseScore: double, vectorString: string, baseSeverity: string>>>"
NVD = f"""struct<cve: struct<id: string, descriptions: array<struct<lang: string, value: string>>, metrics: struct<cvssMetricV31: {_METRIC}, cvssMetricV30: {_METRIC}, cvssMetricV2: {_METRIC}>,
    weaknesses: array<struct<description: array<struct<value: string>>>>, configurations: array<struct<nodes: array<struct<cpeMatch: array<struct<criteria: string>>>>>>>>"""
STIX = "struct<objects: array<struct<type: string, name: string, description: string, external_references: array<struct<source_name: string, external_id: string, url: string>>, kill_chain_phases: array<struct<phase_name: string>>>>>"


def severity_band(score: Column) -> Column:
    """Severity of an old score without one."""
    return F.when(score >= 9, "CRITICAL").when(score >= 7, "HIGH").when(score >= 4, "MEDIUM").when(score.isNotNull(), "LOW")


def vulnerabilities(payloads: DataFrame) -> DataFrame:
    """``(cve, description, score, vector, severity, cwe_ids, products)`` of vulnerability records in ``payload``.

    English description else the first; the newest scoring there is; distinct sorted weaknesses; product names in order.
    """
    r = payloads.select(F.from_json("payload", NVD).getField("cve").alias("c")).where("c.id is not null")
    english = F.get(F.filter("c.descriptions", lambda x: x.lang.startswith("en")), F.lit(0)).getField("value")
    metric = F.coalesce(*[F.get(F.col(f"c.metrics.{m}"), F.lit(0)).getField("cvssData") for m in ("cvssMetricV31", "cvssMetricV30", "cvssMetricV2")])
    ids = F.array_sort(F.array_distinct(F.filter(F.flatten(F.transform("c.weaknesses", lambda w: F.transform(w.description, lambda d: d.value))), lambda v: v.rlike(r"^CWE-\d+$"))))
    names = F.flatten(F.flatten(F.transform("c.configurations", lambda k: F.transform(k.nodes, lambda n: F.transform(n.cpeMatch, lambda m: m.criteria)))))
    first = r.select(F.col("c.id").alias("cve"), T.text(F.coalesce(english, F.get("c.descriptions", F.lit(0)).getField("value"))).alias("description"), metric.alias("m"), ids.alias("cwe_ids"), F.array_distinct(names).alias("cpes"))
    return first.select("cve", "description", F.col("m.baseScore").alias("score"), F.col("m.vectorString").alias("vector"), F.coalesce(F.col("m.baseSeverity"), severity_band(F.col("m.baseScore"))).alias("severity"), "cwe_ids", "cpes")


def techniques(bundles: DataFrame) -> DataFrame:
    """``(id, name, description, tactics, url)`` of attack patterns in ``payload``: the first reference of the framework names them."""
    o = bundles.select(F.explode(F.from_json("payload", STIX).getField("objects")).alias("o")).where("o.type = 'attack-pattern'")
    ref = F.get(F.filter("o.external_references", lambda r: r.source_name.isin("mitre-attack", "mitre-ics-attack")), F.lit(0))
    rows = o.select(ref.alias("r"), "o.name", F.substring("o.description", 1, 500).alias("description"), F.array_join(F.transform("o.kill_chain_phases", lambda p: p.phase_name), ";").alias("tactics"))
    return rows.where("r.external_id is not null").select(F.col("r.external_id").alias("id"), "name", "description", "tactics", F.col("r.url").alias("url"))


def recall_class(payload: Column) -> Column:
    """Device class of a recall: its own, else that of its register entry; only 1, 2 and 3 count."""
    v = F.try_parse_json(payload)
    at = lambda p: F.coalesce(F.try_variant_get(v, f"{p}[0]", "string"), F.try_variant_get(v, p, "string"))
    c = F.coalesce(at("$.device_class"), at("$.openfda.device_class"))
    return F.when(c.isin("1", "2", "3"), c)


def bucket_of(cve: Column) -> Column:
    """Folder of a CVE in the catalogue: its thousands and ``xxx``."""
    return F.concat(F.floor(F.regexp_extract(cve, r"CVE-\d{4}-(\d+)", 1).cast("long") / 1000).cast("string"), F.lit("xxx"))


def recall_signal(recalls: DataFrame) -> DataFrame:
    """Signals of recall rows ``(recall_number, recalling_firm, product_description, reason_for_recall, report_date)``.

    "product recall (firm)" as title; the summary's parts are only appended where they aren't in it yet.
    """
    product, firm, reason = (T.text(F.col(c)) for c in ("product_description", "recalling_firm", "reason_for_recall"))
    title = F.when(product != "", F.concat(product, F.lit(" recall"), F.when(firm != "", F.concat(F.lit(" ("), firm, F.lit(")"))).otherwise(""))).when(firm != "", F.concat(firm, F.lit(" recall"))).otherwise("recall")
    summary = F.concat_ws(" | ", T.some(reason), F.when((firm != "") & ~F.lower(reason).contains(F.lower(firm)), firm))
    return recalls.select(F.col("recall_number").alias("guid"), title.alias("title"), summary.alias("summary"), F.col("report_date").alias("published_date"))


CSAF = """struct<document: struct<title: string, tracking: struct<id: string, initial_release_date: string, current_release_date: string>, notes: array<struct<category: string, text: string>>, references: array<struct<url: string>>>,
    vulnerabilities: array<struct<cve: string, cwe: struct<id: string>, scores: array<struct<cvss_v3: struct<baseScore: double, vectorString: string, baseSeverity: string>>>, remediations: array<struct<details: string>>>>,
    product_tree: struct<branches: array<struct<name: string, branches: array<struct<name: string>>>>>>"""
ADP = """struct<containers: struct<adp: array<struct<metrics: array<struct<cvssV3_1: struct<baseScore: double, baseSeverity: string>, other: struct<content: struct<options: array<map<string, string>>>>>>,
    problemTypes: array<struct<descriptions: array<struct<cweId: string>>>>>>>>"""


def advisories(payloads: DataFrame) -> DataFrame:
    """Flat advisories of CSAF documents in ``payload``: sorted CVEs and weaknesses, distinct remediations in order (20 at most is the
    format's own limit), largest base score, vector of the first score, first branch as vendor, its branches as products."""
    d = payloads.select(F.from_json("payload", CSAF).alias("d")).where("d.document.tracking.id is not null").select("d.*")
    v, text = F.coalesce("vulnerabilities", F.array()), lambda c: F.coalesce(c, F.lit(""))
    several = lambda c: F.array_distinct(F.filter(c, lambda x: text(x) != ""))
    scores = F.flatten(F.transform(v, lambda x: F.coalesce(F.transform(x.scores, lambda s: s.cvss_v3), F.array())))
    first = F.get(F.col("product_tree.branches"), F.lit(0))
    summary = F.get(F.filter("document.notes", lambda n: n.category.isin("summary", "description")), F.lit(0)).getField("text")
    return d.select(
        F.col("document.tracking.id").alias("advisory_id"), text(F.col("document.title")).alias("title"), text(summary).alias("summary"), F.col("document.tracking.initial_release_date").alias("published"),
        F.array_sort(several(F.transform(v, lambda x: x.cve))).alias("cves"), F.array_sort(several(F.transform(v, lambda x: x.cwe.id))).alias("cwe_ids"),
        F.slice(several(F.flatten(F.transform(v, lambda x: F.coalesce(F.transform(x.remediations, lambda r: r.details), F.array())))), 1, 20).alias("remediations"),
        F.array_max(F.transform(scores, lambda s: s.baseScore)).alias("score"), F.get(scores, F.lit(0)).getField("vectorString").alias("vector"), first.getField("name").alias("vendor"), F.transform(first.getField("branches"), lambda b: b.getField("name")).alias("products"),
    )


def decisions(payloads: DataFrame) -> DataFrame:
    """``(score, severity, exploitation, automatable, technical_impact, cwe_ids)`` that a coordinator added to records in ``payload``;
    of options given twice the last holds."""
    a = payloads.select(F.from_json("payload", ADP).getField("containers").getField("adp").alias("adp")).where("adp is not null")
    metrics = F.flatten(F.transform("adp", lambda x: F.coalesce(x.metrics, F.array())))
    options = F.flatten(F.transform(metrics, lambda m: F.coalesce(m.other.content.options, F.array())))
    given = lambda k: F.try_element_at(F.filter(F.transform("options", lambda o: F.try_element_at(o, F.lit(k))), lambda v: v.isNotNull()), F.lit(-1))
    cwes = F.flatten(F.transform("adp", lambda x: F.flatten(F.transform(F.coalesce(x.problemTypes, F.array()), lambda p: F.transform(p.descriptions, lambda d: d.cweId)))))
    rows = a.select(options.alias("options"), F.get(F.filter(F.transform(metrics, lambda m: m.cvssV3_1), lambda s: s.isNotNull()), F.lit(0)).alias("s"), F.array_sort(F.array_distinct(F.array_compact(cwes))).alias("cwe_ids"))
    return rows.select(F.col("s.baseScore").alias("score"), F.col("s.baseSeverity").alias("severity"), given("Exploitation").alias("exploitation"), given("Automatable").alias("automatable"), given("Technical Impact").alias("technical_impact"), "cwe_ids")


def overlaid(base: DataFrame, detail: DataFrame, key: str, united: list[str], largest: list[str]) -> DataFrame:
    """``base`` left-joined with ``detail``: its non-empty values win, lists of ``united`` are united and sorted, of ``largest`` the greater holds."""
    both = base.alias("b").join(detail.alias("d"), key, "left")

    def column(c: str) -> Column:
        if c == key or c not in detail.columns:
            return F.col(key) if c == key else F.col(f"b.{c}")
        b, d = F.col(f"b.{c}"), F.col(f"d.{c}")
        if c in united:
            none = F.array().cast(dict(base.dtypes)[c])
            return F.array_sort(F.array_union(F.coalesce(b, none), F.coalesce(d, none)))
        return F.greatest(b, d) if c in largest else F.coalesce(T.some(d) if dict(base.dtypes)[c] == "string" else d, b)

    return both.select(*[column(c).alias(c) for c in base.columns])


def overlaid_maps(a: Column, b: Column) -> Column:
    """Entries of both maps; of equal keys those of ``b``. Null maps count as empty."""
    kept = F.map_filter(a, lambda k, _: ~F.array_contains(F.map_keys(b), k))
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(F.map_concat(kept, b))
