"""Records of single publishers -> advisories and signals. One row per document or CSV line; everything is a JVM expression.

Each reader takes ``(payload)`` (the JSON text of a response or cached document) or a CSV's columns as text, keeps none of its other columns, and gives
``(guid, title, link, published_date, summary)``. Payloads that are null or no JSON give no row or a row of empty texts as the reader's docstring says; repeated rows each count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Where the publishers' pages lie.
NVD_PAGE, ICSMA_PAGE = "https://nvd.nist.gov/vuln/detail/", "https://www.cisa.gov/news-events/ics-medical-advisories/"
GOV_UK, CSAF_FILES, HEALTH_CANADA = "https://www.gov.uk", "https://cert-portal.siemens.com/productcert/csaf", "https://healthycanadians.gc.ca"
#: Panels of a recall that can serve as its summary, in order.
PANELS = ("issue", "what_you_should_do", "affected_products")


def _said(*choices: Column) -> Column:
    """The first of ``choices`` that isn't empty, trimmed; an empty text if all are."""
    return F.coalesce(*[F.when(F.trim(c) != "", F.trim(c)) for c in choices], F.lit(""))


def _absolute(link: Column, home: str) -> Column:
    return F.when((link != "") & ~link.startswith("http"), F.concat(F.lit(home), link)).otherwise(link)


def vuldb(rows: DataFrame) -> DataFrame:
    """Entries of responses whose status is 200; others, and what is no such response, give nothing. An entry without an id is named by its CVE, else by the digest of its text."""
    entry = "id string, title string, summary string, description string, cve struct<cve_id string>, `timestamp` string, `date` string, href string, url string"
    r = rows.select(F.from_json("payload", f"response struct<status string>, result array<struct<id string, entry struct<{entry}>>>").alias("r")).where("r.response.status = '200'")
    e = r.select(F.explode("r.result").alias("x")).where("x is not null")
    name, cve = _said(F.col("x.entry.id"), F.col("x.id")), _said(F.col("x.entry.cve.cve_id"))
    link = _said(F.col("x.entry.href"), F.col("x.entry.url"))
    return e.select(
        _said(name, cve, F.sha1(F.to_json("x"))).alias("guid"), _said(F.col("x.entry.title"), name, F.lit("VulDB entry")).alias("title"), F.when((link == "") & (cve != ""), F.concat(F.lit(NVD_PAGE), cve)).otherwise(link).alias("link"),
        _said(F.col("x.entry.timestamp"), F.col("x.entry.date")).alias("published_date"), _said(F.col("x.entry.summary"), F.col("x.entry.description")).alias("summary"),
    )


def icsma_advisories(lines: DataFrame) -> DataFrame:
    """Medical advisories of the project's CSV: ids with the prefix, CVE and CWE lists by comma, the score as a number (null if it is none)."""
    text = lambda c: F.trim(F.coalesce(F.col(f"`{c}`"), F.lit("")))
    listed = lambda c, prefix: F.filter(F.transform(F.split(text(c), ","), lambda x: F.trim(x)), lambda x: x.startswith(prefix))
    return lines.where(text("ICS-CERT_Number").startswith("ICSMA-")).select(
        text("ICS-CERT_Number").alias("advisory_id"), text("ICS-CERT_Advisory_Title").alias("title"), text("Vendor").alias("vendor"), text("Product").alias("product"), text("Original_Release_Date").alias("original_release_date"),
        listed("CVE_Number", "CVE-").alias("cves"), listed("CWE_Number", "CWE-").alias("cwes"), text("Cumulative_CVSS").try_cast("double").alias("cvss_score"), text("CVSS_Severity").alias("cvss_severity"),
    )


def with_descriptions(advisories: DataFrame, documents: DataFrame) -> DataFrame:
    """Advisories with the ``description`` of the document of the same ``advisory_id``, the first in order where there are several; null where there is none."""
    first = documents.where("advisory_id is not null").groupBy("advisory_id").agg(F.min("description").alias("description"))
    return advisories.drop("description").join(first, "advisory_id", "left")


def icsma_signals(advisories: DataFrame) -> DataFrame:
    """The summary is the description, else vendor and product, with the CVEs after a bar; the title if there is neither."""
    maker = F.trim(F.concat_ws(" ", F.coalesce("vendor", F.lit("")), F.coalesce("product", F.lit(""))))
    description = F.coalesce(F.nullif(F.trim("description"), F.lit("")), F.nullif(maker, F.lit("")))
    cves = F.when(F.size("cves") > 0, F.concat(F.lit("CVEs: "), F.array_join("cves", ", ")))
    title = F.coalesce(F.nullif(F.col("title"), F.lit("")), F.col("advisory_id"))
    summary = F.concat_ws(" | ", description, cves)
    return advisories.select(F.col("advisory_id").alias("guid"), title.alias("title"), F.concat(F.lit(ICSMA_PAGE), F.lower("advisory_id")).alias("link"), F.col("original_release_date").alias("published_date"), F.when(summary != "", summary).otherwise(title).alias("summary"))


def mhra_signals(rows: DataFrame) -> DataFrame:
    """Alerts: named by the last part of their link, else by the start of their title, other characters as underscores; documents without both give nothing."""
    r = rows.select(F.from_json("payload", "title string, description string, link string, public_timestamp string").alias("r"))
    title, link = _said(F.col("r.title")), _said(F.col("r.link"))
    named = _said(F.element_at(F.split(link, "/"), -1), F.substring(title, 1, 80))
    guid = F.regexp_replace(named, r"[^a-zA-Z0-9_\-]", "_")
    return r.select(guid.alias("guid"), _said(title, guid).alias("title"), _absolute(link, GOV_UK).alias("link"), _said(F.col("r.public_timestamp")).alias("published_date"), _said(F.col("r.description"), title).alias("summary")).where("guid <> ''")


def index_entries(rows: DataFrame) -> DataFrame:
    """``(advisory_id, title, published, url)`` of advisory indexes: entries of a feed object, of ``advisories``, ``items`` or ``entry``, or of a bare list.

    A link is a text, or the last ``self`` (else the first) address of a list of links; an entry without an id is named by its file, one without both is left out.
    """
    lists = F.coalesce(*[F.from_json(F.when(F.trim(F.get_json_object("payload", p)).startswith("["), F.get_json_object("payload", p)), "array<string>") for p in ("$.feed.entry", "$.advisories", "$.items", "$.entry", "$")])
    e = rows.select(F.explode(lists).alias("e")).where("e is not null")
    get = lambda k: F.get_json_object("e", f"$.{k}")
    raw = F.coalesce(*[F.when(~get(k).isin("", "[]"), get(k)) for k in ("link", "url", "href")])
    links = F.filter(F.from_json(F.when(raw.startswith("["), raw), "array<struct<href string, rel string>>"), lambda x: F.coalesce(x.href, F.lit("")) != "")
    own = F.filter(links, lambda x: x.rel == "self")
    url = F.when(raw.startswith("["), F.coalesce(F.when(F.size(own) > 0, F.element_at(own, -1).href), F.get(links, F.lit(0)).href)).otherwise(raw)
    url = F.coalesce(url, F.lit(""))
    name = _said(get("id"), get("name"), F.replace(F.element_at(F.split(url, "/"), -1), F.lit(".json"), F.lit("")))
    out = e.select(name.alias("name"), _said(get("title"), get("summary")).alias("title"), _said(get("published"), get("updated"), get("initial_release_date")).alias("published"), url.alias("url")).where("name <> ''")
    return out.select(F.upper("name").alias("advisory_id"), _said(F.col("title"), F.col("name")).alias("title"), "published", F.when(F.col("url") == "", F.concat(F.lit(CSAF_FILES + "/"), F.lower("name"), F.lit(".json"))).otherwise(F.col("url")).alias("url"))


def index_signals(advisories: DataFrame) -> DataFrame:
    """Signals of indexed advisories with ``description`` and ``cves``: the first five CVEs go into the summary."""
    title = _said(F.col("title"), F.col("advisory_id"))
    cves = F.when(F.size("cves") > 0, F.concat(F.lit("CVEs: "), F.array_join(F.slice("cves", 1, 5), ", ")))
    return advisories.select(F.col("advisory_id").alias("guid"), title.alias("title"), F.coalesce("url", F.lit("")).alias("link"), F.col("published").alias("published_date"), F.concat_ws(" | ", _said(F.col("description"), title), cves).alias("summary"))


def recent_recalls(rows: DataFrame, category: str = "3") -> DataFrame:
    """``(recall_id, title, date_published, url)`` of the lists of a response, merged: each recall once, as the first list that has it says.

    Only recalls of ``category``, or without any, remain. Dates in milliseconds become ISO texts in UTC.
    """
    # The lists are of one response: what is collected is as long as the response itself.
    lists = F.flatten(F.map_values(F.from_json(F.coalesce(F.get_json_object("payload", "$.results"), F.col("payload")), "map<string, array<struct<recallId string, title string, date_published string, category array<string>, url string>>>")))
    e = rows.select(F.monotonically_increasing_id().alias("n"), lists.alias("lists")).select("n", F.posexplode("lists").alias("pos", "x")).where("x is not null").select("n", "pos", "x.*")
    e = e.withColumn("recall_id", _said(F.col("recallId"))).where("recall_id <> ''")
    first = e.groupBy("n", "recall_id").agg(F.min_by(F.struct("title", "date_published", "category", "url"), "pos").alias("x"))
    kept = first.select("recall_id", "x.*").where(F.col("category").isNull() | (F.size("category") == 0) | F.array_contains("category", category))
    millis = F.col("date_published").rlike(r"^\d+$")
    iso = F.concat(F.date_format(F.timestamp_millis(F.when(millis, F.col("date_published")).try_cast("long")), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    return kept.select("recall_id", _said(F.col("title")).alias("title"), F.when(millis, iso).otherwise(_said(F.col("date_published"))).alias("date_published"), _said(F.col("url")).alias("url"))


def recall_signals(details: DataFrame) -> DataFrame:
    """Signals of recalls with their panels as columns: the first panel that says more than the title follows it after a bar."""
    title = _said(F.col("title"))
    panels = [F.coalesce(F.col(p), F.lit("")) if p in details.columns else F.lit("") for p in PANELS]
    more = F.coalesce(*[F.when((F.trim(p) != "") & ~title.contains(F.trim(p)), F.trim(p)) for p in panels])
    return details.select("recall_id", title.alias("t"), _absolute(_said(F.col("url")), HEALTH_CANADA).alias("link"), _said(F.col("date_published")).alias("published_date"), F.concat_ws(" | ", title, more).alias("summary")).select(
        F.col("recall_id").alias("guid"), _said(F.col("t"), F.col("recall_id")).alias("title"), "link", "published_date", "summary"
    )
