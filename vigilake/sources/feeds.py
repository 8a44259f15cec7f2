"""Feeds in their delivered forms -> signals.

Payloads are rows ``(source, payload, fetched_at)`` of text, as a crawler lands them; every parser is a narrow transformation, so a scan of
payloads splits freely. JSON shapes are read by the JVM with explicit schemas or as variants; XML keeps the order of its elements, which the
JVM's reader loses, and is read by an Arrow function.
"""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from vigilake.functions import text as T

SIGNAL = "source string, guid string, title string, link string, published_date string, summary string, fetched_at string"
_ORDER = [c.split()[0] for c in SIGNAL.split(", ")]
# Name spaces that feeds use without declaring them.
NAMESPACES = {
    "media": "http://search.yahoo.com/mrss/", "dc": "http://purl.org/dc/elements/1.1/", "content": "http://purl.org/rss/1.0/modules/content/", "atom": "http://www.w3.org/2005/Atom",
    "slash": "http://purl.org/rss/1.0/modules/slash/", "wfw": "http://wellformedweb.org/CommentAPI/", "sy": "http://purl.org/rss/1.0/modules/syndication/", "georss": "http://www.georss.org/georss", "itunes": "http://www.itunes.com/dtds/podcast-1.0.dtd",
}


def _root(payload: str) -> ET.Element | None:
    """Root element; undeclared known prefixes are declared and parsing is tried once more; None if the text is no XML."""
    try:
        return ET.fromstring(payload)
    except ET.ParseError:
        used = {p for p in re.findall(r"</?([A-Za-z]\w*):", payload) if p in NAMESPACES and f"xmlns:{p}=" not in payload}
        if not used:
            return None
        names = "".join(f' xmlns:{p}="{NAMESPACES[p]}"' for p in sorted(used))
        try:
            return ET.fromstring(re.sub(r"<([A-Za-z][\w:.-]*)(?=[\s>])", lambda m: m.group(0) + names, payload, count=1))
        except ET.ParseError:
            return None


def _name(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""


def _text(e: ET.Element, *names: str) -> str:
    """Text of the first child, in document order, with one of ``names``; empty if there is none."""
    return next(("".join(c.itertext()).strip() for c in e if _name(c) in names), "")


def _entries(payload: str) -> Iterator[tuple[str, str, str, str, str]]:
    """(guid, title, link, date, summary) of each RSS item or Atom entry."""
    root = _root(payload)
    for e in root.iter() if root is not None else ():
        if _name(e) == "item":
            title, link = _text(e, "title") or "item", _text(e, "link")
            yield _text(e, "guid") or link or title, title, link, _text(e, "pubDate", "date"), _text(e, "description", "encoded")
        elif _name(e) == "entry":
            title = _text(e, "title") or "entry"
            link = next((c.get("href", "") for c in e if _name(c) == "link" and c.get("rel", "alternate") in ("alternate", "") and c.get("href")), "")
            yield _text(e, "id") or link or title, title, link, _text(e, "updated", "published"), _text(e, "summary", "content")


def xml_feed(payloads: DataFrame) -> DataFrame:
    """Signals of RSS and Atom payloads; HTML in descriptions becomes text. A payload that is no XML gives nothing."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(s, *e, f) for s, p, f in zip(pdf["source"], pdf["payload"], pdf["fetched_at"], strict=True) if p for e in _entries(p)]
            yield pd.DataFrame(rows, columns=_ORDER)

    parsed = payloads.select("source", "payload", "fetched_at").mapInPandas(run, SIGNAL)
    return parsed.withColumn("summary", T.strip_html(F.col("summary")))


_KEV = "struct<vulnerabilities: array<struct<cveID: string, vulnerabilityName: string, dateAdded: string, shortDescription: string, vendorProject: string, product: string, requiredAction: string, dueDate: string>>>"
_NVD = "struct<vulnerabilities: array<struct<cve: struct<id: string, published: string, lastModified: string, descriptions: array<struct<lang: string, value: string>>, references: array<struct<url: string>>>>>>"


def kev_feed(payloads: DataFrame) -> DataFrame:
    """Signals of a catalogue of exploited vulnerabilities, with its own five columns (null where empty)."""
    rows = payloads.select("source", "fetched_at", F.explode(F.from_json("payload", _KEV).getField("vulnerabilities")).alias("v"))
    cve, vendor, product = T.text(F.col("v.cveID")), T.text(F.col("v.vendorProject")), T.text(F.col("v.product"))
    title = F.coalesce(T.some(cve), T.some(T.text(F.col("v.vulnerabilityName"))), F.lit("KEV item"))
    summary = F.concat_ws(" | ", T.some(T.text(F.col("v.shortDescription"))), T.some(F.trim(F.concat_ws(" ", vendor, product))))
    return rows.select(
        "source", F.coalesce(T.some(cve), F.sha1(F.to_json("v"))).alias("guid"), title.alias("title"), T.nvd_link(cve).alias("link"), T.text(F.col("v.dateAdded")).alias("published_date"), summary.alias("summary"), "fetched_at",
        T.some(T.text(F.col("v.requiredAction"))).alias("kev_required_action"), T.some(T.text(F.col("v.dueDate"))).alias("kev_due_date"), T.some(vendor).alias("kev_vendor"), T.some(product).alias("kev_product"), T.some(T.text(F.col("v.vulnerabilityName"))).alias("kev_vulnerability_name"),
    )


def nvd_feed(payloads: DataFrame) -> DataFrame:
    """Signals of vulnerability records: first English description, first reference as link, else the record's page."""
    rows = payloads.select("source", "fetched_at", F.explode(F.from_json("payload", _NVD).getField("vulnerabilities")).alias("v"))
    cve = T.text(F.col("v.cve.id"))
    english = F.get(F.filter("v.cve.descriptions", lambda x: x.lang == "en"), F.lit(0)).getField("value")
    link = F.get(F.filter("v.cve.references", lambda x: F.coalesce(x.url, F.lit("")) != ""), F.lit(0)).getField("url")
    date = F.coalesce(T.some(T.text(F.col("v.cve.published"))), T.text(F.col("v.cve.lastModified")))
    return rows.select("source", F.coalesce(T.some(cve), F.sha1(F.to_json("v"))).alias("guid"), F.coalesce(T.some(cve), F.lit("NVD CVE")).alias("title"), F.coalesce(link, T.nvd_link(cve)).alias("link"), date.alias("published_date"), T.text(english).alias("summary"), "fetched_at")


def _pick(v: Column, *keys: str) -> Column:
    """First non-empty scalar of a variant among ``keys``."""
    return F.coalesce(*[T.some(F.trim(F.try_variant_get(v, f"$.{k}", "string"))) for k in keys], F.lit(""))


# Where items stand in a payload of unknown shape, and under which keys their fields go.
LISTS = ("results", "items", "data", "result")
KEYS = {
    "guid": ("guid", "id", "recall_number", "res_event_number", "event_id", "url", "link"), "title": ("title", "name", "headline", "product_description", "recalling_firm"), "link": ("link", "url", "href", "source_url"),
    "published_date": ("published_date", "published", "date_published", "pubDate", "date", "report_date", "recall_initiation_date", "event_date_posted"), "summary": ("summary", "description", "content", "reason_for_recall", "root_cause_description"),
}


def json_feed(payloads: DataFrame) -> DataFrame:
    """Signals of JSON of any shape: a root list, or the first of ``results``, ``items``, ``data``; fields by the first of their usual keys."""
    v = F.try_parse_json("payload")
    items = F.coalesce(*[F.try_variant_get(v, f"$.{k}", "array<variant>") for k in LISTS], F.try_variant_get(v, "$", "array<variant>"))
    rows = payloads.select("source", "fetched_at", F.explode(items).alias("v"))
    fields = {k: _pick(F.col("v"), *keys) for k, keys in KEYS.items()}
    guid = F.coalesce(T.some(fields["guid"]), T.some(fields["link"]), F.sha1(F.to_json("v")))
    return rows.select("source", guid.alias("guid"), F.coalesce(T.some(fields["title"]), F.lit("item")).alias("title"), *[fields[k].alias(k) for k in ("link", "published_date", "summary")], "fetched_at").select(*_ORDER)


def read_csv_feed(spark: SparkSession, path: str, source: str, fetched_at: str) -> DataFrame:
    """Signals of CSV files (also gzipped) with a header and ``#`` comments: rows with a ``cve`` or ``cveID`` column, or title, link and the like."""
    rows = spark.read.csv(path, header=True, comment="#", multiLine=True, escape='"')
    names = {c.lower(): c for c in rows.columns}
    have = lambda *cs: F.coalesce(*[T.some(T.text(F.col(f"`{names[c]}`"))) for c in cs if c in names], F.lit(""))
    cve = have("cve", "cveid", "cve_id")
    notes = [F.when(have(c) != "", F.concat(F.lit(f"{c}="), have(c))) for c in ("epss", "percentile")]
    title = F.coalesce(T.some(cve), T.some(have("title", "name", "vulnerabilityname")), F.lit("item"))
    link = F.coalesce(T.some(have("link", "url")), T.nvd_link(cve))
    summary = F.concat_ws(" | ", T.some(have("summary", "description", "shortdescription")), *notes)
    return rows.select(F.lit(source).alias("source"), F.coalesce(T.some(cve), T.some(have("guid", "id")), T.some(link), title).alias("guid"), title.alias("title"), link.alias("link"), have("published_date", "published", "date", "dateadded").alias("published_date"), summary.alias("summary"), F.lit(fetched_at).alias("fetched_at"))


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """JSON lines; tolerant reading drops lines that are no object of the schema, strict reading fails on them."""
    if strict:
        return spark.read.schema(schema).json(path, mode="FAILFAST")
    line = F.from_json("value", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    rows = spark.read.text(path).where(F.trim("value") != "").select(line.alias("j")).where("j is not null and j._corrupt_record is null")
    return rows.select("j.*").drop("_corrupt_record")


def read_envelope(spark: SparkSession, path: str, item: str) -> DataFrame:
    """The ``items`` of whole-file JSON envelopes."""
    return spark.read.schema(f"items array<struct<{item}>>").json(path, multiLine=True).select(F.explode("items").alias("i")).select("i.*")


class PagedReader(DataSourceReader):
    """One partition per landed page; pages outside ``start``..``end`` (dates in their names) are never opened."""

    def __init__(self, options: dict):
        self.folder, self.start, self.end = options["path"], options.get("start", ""), options.get("end", "9999")

    def partitions(self) -> list[InputPartition]:
        import os

        pages = sorted(p for p in os.listdir(self.folder) if p.endswith(".json"))
        day = lambda p: (re.search(r"\d{4}-\d{2}-\d{2}", p) or [""])[0]
        return [InputPartition(p) for p in pages if not day(p) or self.start <= day(p) <= self.end] or [InputPartition("")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import os

        if partition.value:
            with open(os.path.join(self.folder, partition.value), encoding="utf-8") as f:
                page = json.load(f)
            for i, row in enumerate(page.get("results", page) if isinstance(page, dict) else page):
                yield partition.value, i, json.dumps(row, ensure_ascii=False, sort_keys=True)


class PagedSource(DataSource):
    """``spark.read.format("advisory_pages").load(folder)``: pages as a connector lands them, one row per record."""

    @classmethod
    def name(cls) -> str:
        return "advisory_pages"

    def schema(self) -> str:
        return "page string, pos int, record string"

    def reader(self, schema: object) -> DataSourceReader:
        return PagedReader(dict(self.options))
