"""Filling rows from other rows: issues from their signals and sources, published rows from enriched ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Titles that say nothing; beginnings of reasons that tell a category; a tier for sources without one.
NO_TITLES = ("", "item", "items", "entry", "untitled")
KNOWN_BY_RULE = ("device:", "clinical:", "source-authority:")
DEVICE_REASONS = ("device: infusion/drug pump", "device: ventilator/life-support", "device: cardiac implant/defibrillator", "device: patient monitor", "device: medical imaging/PACS")
CLINICAL_REASONS = ("clinical: life-sustaining", "clinical: patient safety", "clinical: ICU", "clinical: PHI")
LAST_TIER = 5


def empty(c: Column) -> Column:
    return F.coalesce(F.trim(c) == "", F.lit(True))


def page_text(html: Column) -> Column:
    """The text of a page: tags as blanks, the five common entities decoded, three or more blanks in a row as one."""
    text = F.regexp_replace(html, "<[^>]+>", " ")
    for entity, character in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(character))
    return F.regexp_replace(F.regexp_replace(text, r"[\s ]{3,}", " "), r"^[\s ]+|[\s ]+$", "")


def urls(canonical: Column, links: Column) -> Column:
    """The addresses of an issue in order, each once: the canonical link, then the others; what doesn't begin with http is none."""
    every = F.transform(F.concat(F.array(F.coalesce(canonical, F.lit(""))), F.coalesce(links, F.array().cast("array<string>"))), lambda u: F.trim(u))
    return F.array_distinct(F.filter(every, lambda u: u.startswith("http")))


def needs_extraction(title: Column, vendor: Column, products: Column, severity: Column) -> Column:
    """Whether a row lacks what a reader of its text could fill in."""
    return F.lower(F.trim(F.coalesce(title, F.lit("")))).isin(*NO_TITLES) | empty(vendor) | F.coalesce(F.size(products) <= 0, F.lit(True)) | empty(severity)


def known_by_rule(why: Column) -> Column:
    """Whether a rule has told the category already (``why`` are reasons as an array)."""
    return F.exists(why, lambda w: F.greatest(*[w.startswith(p) for p in KNOWN_BY_RULE], F.lit(False)))


def category_of_reasons(why: Column) -> Column:
    """The category that the reasons of a score tell, by precedence."""
    some = lambda *starts: F.exists(why, lambda w: F.greatest(*[w.startswith(p) for p in starts], F.lit(False)))
    out = F.when(some(*DEVICE_REASONS), "medical_device").when(some("device: EHR/EMR"), "healthcare_it").when(some(*CLINICAL_REASONS), "medical_device")
    return out.when(some("device: healthcare context"), "healthcare_it").otherwise("not_healthcare")


def fingerprint(rows: DataFrame) -> Column:
    """Digest of the fields that tell an issue, texts cut to 200 and 400 characters, lists sorted."""
    text = lambda c, n: F.substring(F.coalesce(F.col(c), F.lit("")), 1, n)
    listed = lambda c: F.array_join(F.array_sort(F.coalesce(F.col(c), F.array().cast("array<string>"))), ",")
    return F.sha2(F.concat_ws("\n", F.coalesce("issue_id", F.lit("")), listed("cves"), text("title", 200), text("summary", 400), listed("sources")), 256)


def filled(rows: DataFrame, better: DataFrame, key: str, fields: list[str], overwrite: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with each empty one of ``fields`` taken from the row of ``better`` with the same ``key``; those in ``overwrite`` are taken whenever there is such a row with a value.

    ``better`` has a unique key. Other columns of ``better`` are left out, also if they clash.
    """
    other = better.select(F.col(key).alias("__k"), *[F.col(f).alias(f"__{f}") for f in fields])
    joined = rows.join(other, rows[key] == other["__k"], "left")
    value = lambda f: F.coalesce(F.col(f"__{f}"), F.col(f)) if f in overwrite else F.when(empty(F.col(f)), F.coalesce(F.col(f"__{f}"), F.col(f))).otherwise(F.col(f))
    return joined.select(*[value(c).alias(c) if c in fields else F.col(c) for c in rows.columns])


def severity_backfilled(severity: Column, cvss_severity: Column) -> Column:
    return F.when(empty(severity), F.lower(cvss_severity)).otherwise(severity)


def best_sources(issues: DataFrame, sources: DataFrame) -> DataFrame:
    """``(issue_id, best_source, best_tier)``: of an issue's sources the one of the lowest tier (none: 5), the first in order among equals."""
    one = issues.select("issue_id", F.posexplode("sources").alias("pos", "source"))
    tiers = sources.select(F.col("source_id").alias("source"), "tier").where("source is not null").groupBy("source").agg(F.min("tier").alias("tier"))
    tiered = one.join(tiers, "source", "left").withColumn("tier", F.coalesce("tier", F.lit(LAST_TIER)))
    return tiered.groupBy("issue_id").agg(F.min(F.struct("tier", "pos", "source")).alias("b")).select("issue_id", F.col("b.source").alias("best_source"), F.col("b.tier").alias("best_tier"))


def cited(issues: DataFrame, signals: DataFrame) -> DataFrame:
    """``(issue_id, source, url, citation)`` for each source of each issue: link and guid of the source's first signal that has one, else the issue's canonical link and id.

    ``signals`` has ``issue_id, source, row_id, link, guid``. One aggregation; no signals of an issue are collected.
    """
    one = issues.select("issue_id", "canonical_link", F.explode("sources").alias("source"))
    has = lambda c: F.min(F.when(~empty(F.col(c)), F.struct("row_id", F.col(c).alias("v")))).alias(c)
    first = signals.groupBy("issue_id", "source").agg(has("link"), has("guid"))
    joined = one.join(first, ["issue_id", "source"], "left")
    return joined.select("issue_id", "source", F.coalesce("link.v", "canonical_link", F.lit("")).alias("url"), F.coalesce("guid.v", "issue_id").alias("citation"))


def unknown_members(members: DataFrame, sources: DataFrame) -> DataFrame:
    """``(source_id)`` of a set that the registry lacks; a valid set has none."""
    return members.select("source_id").where("source_id is not null").distinct().join(sources.select("source_id"), "source_id", "left_anti")


def list_union(a: Column, b: Column) -> Column:
    """``a`` with what ``b`` adds to it, in order, each once; null lists are empty."""
    none = F.array().cast("array<string>")
    return F.array_union(F.coalesce(a, none), F.coalesce(b, none))


def fresh(cached: DataFrame, now: Column, days: int = 90) -> DataFrame:
    """Cached rows that were fetched at most ``days`` ago; rows without ``fetched_at`` are stale."""
    return cached.where(F.col("fetched_at") >= now - F.make_dt_interval(F.lit(days)))
