"""Signals -> issues, merging of issues, new items, limits and snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilake.functions import text as T
from vigilake.tables import cut

SIGNAL_TEXTS = ("source", "guid", "title", "link", "published_date", "summary", "fetched_at", "signal_id")


def cleaned(signals: DataFrame) -> DataFrame:
    """Signals with stripped texts, empty for null, and a ``signal_id`` where there was none."""
    rows = signals.select("row_id", "batch_no", *[T.text(F.col(c)).alias(c) for c in SIGNAL_TEXTS])
    made = T.signal_id(F.col("source"), F.col("guid"), F.col("link"), F.col("title"))
    return rows.withColumn("signal_id", F.coalesce(T.some(F.col("signal_id")), made, F.lit("")))


def keyed(signals: DataFrame) -> DataFrame:
    """One row per signal and CVE it names; signals without one get ``UNK-`` and a digest of source, normalised title and date."""
    rows = cleaned(signals)
    found = T.cves(F.col("guid"), F.col("title"), F.col("summary"), F.col("link"))
    unknown = F.concat(F.lit("UNK-"), F.substring(F.sha2(F.concat_ws("|", "source", T.norm_title(F.col("title")), "published_date"), 256), 1, 16))
    rows = rows.withColumn("cves", found).withColumn("cve", F.explode_outer("cves"))
    return rows.withColumn("issue_id", F.coalesce("cve", unknown)).withColumn("issue_type", F.when(F.col("cve").isNull(), "unknown").otherwise("cve"))


def longest(c: str) -> Column:
    """The longest value of a group, the smallest of equally long ones."""
    return F.min(F.when(F.col(c) != "", F.struct((-F.length(c)).alias("n"), F.col(c).alias("v")))).getField("v")


def correlated(signals: DataFrame) -> DataFrame:
    """One row per issue. All aggregates are partial, so a CVE named by a third of all signals is reduced where it is read.

    Titles: of a CVE the smallest that names it, else its id; otherwise the longest. Summary: the longest. Link: the smallest NVD page, else
    the smallest. Times: smallest and largest non-empty text. Empty arrays where nothing was given.
    """
    rows = keyed(signals)
    words = lambda c: F.array_sort(F.collect_set(T.some(F.col(c))))
    naming = F.min(F.when(F.upper("title").contains(F.upper("issue_id")), F.col("title")))
    page = F.min(F.when(F.col("link").contains("nvd.nist.gov/vuln/detail/"), F.col("link")))
    out = rows.groupBy("issue_id", "issue_type").agg(
        words("cve").alias("cves"), naming.alias("naming"), longest("title").alias("longest"), longest("summary").alias("summary"),
        F.coalesce(page, F.min(T.some(F.col("link"))), F.lit("")).alias("canonical_link"), words("link").alias("links"), words("source").alias("sources"), words("published_date").alias("published_dates"),
        F.min(T.some(F.col("fetched_at"))).alias("first_seen_at"), F.max(T.some(F.col("fetched_at"))).alias("last_seen_at"), F.count("*").alias("n_signals"),
    )
    title = F.when(F.col("issue_type") == "cve", F.coalesce("naming", "issue_id")).otherwise(F.coalesce("longest", F.lit("")))
    return out.select(
        "issue_id", "issue_type", "cves", title.alias("title"), F.coalesce("summary", F.lit("")).alias("summary"), "canonical_link", "links", "sources", "published_dates",
        "first_seen_at", "last_seen_at", "n_signals", F.size("sources").alias("n_sources"), F.size("links").alias("n_links"),
    )


def with_authority(issues: DataFrame, sources: DataFrame) -> DataFrame:
    """``issues`` with weight and tier of the best source (first of equals), its name, and whether any source is medical.

    Sources are exploded and joined, so the registry may be of any size; issues without a known source keep nulls.
    """
    registry = sources.select(F.col("source_id").alias("__s"), "weight", "tier", "medical").dropDuplicates(["__s"])
    known = issues.select("issue_id", F.explode("sources").alias("__s")).join(registry, "__s")
    best = known.groupBy("issue_id").agg(F.min(F.struct((-F.col("weight")).alias("w"), F.col("__s").alias("s"), F.col("tier").alias("t"))).alias("b"), F.max("medical").alias("medical"))
    return issues.join(best.select("issue_id", (-F.col("b.w")).alias("weight"), F.col("b.s").alias("best_source"), F.col("b.t").alias("tier"), "medical"), "issue_id", "left")


def first_per_source(signals: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of each source in file order."""
    return signals.withColumn("pos", F.row_number().over(Window.partitionBy("source").orderBy("row_id"))).where(F.col("pos") <= n)


def early_stop(signals: DataFrame, n: int) -> DataFrame:
    """The ``n`` issues that a reader in file order meets first, with the position at which it does."""
    first = keyed(signals).groupBy("issue_id").agg(F.min("row_id").alias("first_row"))
    return first.orderBy("first_row", "issue_id").limit(n)


def new_items(signals: DataFrame, seen_batch: int) -> DataFrame:
    """Rows of later batches whose guid and signal_id no row up to ``seen_batch`` of the same source had, first occurrence only.

    An item is seen if either key is; the two keys are tried by one anti join each, which keeps them equi-joins.
    """
    rows = cleaned(signals)
    old, later = rows.where(F.col("batch_no") <= seen_batch), rows.where(F.col("batch_no") > seen_batch)
    for key in ("guid", "signal_id"):
        later = later.join(old.where(F.col(key) != "").select("source", key).distinct(), ["source", key], "left_anti")
    for key in ("guid", "signal_id"):
        # A row without the key is a group of its own, so blanks make no hot group.
        own = F.when(F.col(key) == "", F.col("row_id").cast("string")).otherwise(F.concat(F.lit("k"), F.col(key)))
        later = later.withColumn(f"__{key}", F.row_number().over(Window.partitionBy("source", own).orderBy("row_id")))
    return later.where("__guid = 1 and __signal_id = 1").drop("__guid", "__signal_id")


def filtered(signals: DataFrame, any_of: list[str], all_of: list[str], allow: str | None, deny: str | None) -> DataFrame:
    """Signals whose title or summary has one of ``any_of`` and all of ``all_of`` (any case) and whose link, if any, passes the patterns."""
    hay = F.lower(F.concat_ws(" ", T.text(F.col("title")), T.text(F.col("summary"))))
    link = T.text(F.col("link"))
    keep = F.lit(True)
    if any_of:
        keep = keep & F.array_contains(F.array(*[hay.contains(w.lower()) for w in any_of]), True)
    for w in all_of:
        keep = keep & hay.contains(w.lower())
    if allow:
        keep = keep & ((link == "") | link.rlike("(?i)" + allow))
    if deny:
        keep = keep & ((link == "") | ~link.rlike("(?i)" + deny))
    return signals.where(keep)


def merged_components(pairs: DataFrame) -> DataFrame:
    """``(id, root)`` for pairs ``(a, b)``: the root is the first CVE of the component, else its smallest id.

    Alternating large-star and small-star steps: each step is one aggregation and one join, a hub's neighbours are linked to its smallest
    neighbour rather than to each other, and the number of steps grows with the logarithm of the size.
    """
    order = lambda c: F.struct((~c.startswith("CVE-")).alias("k"), c.alias("v"))
    edges = pairs.where("a is not null and b is not null and a <> b").select(order(F.col("a")).alias("u"), order(F.col("b")).alias("v")).distinct()
    edges, mark = cut(edges), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        after = cut(small.where("u <> v").distinct())
        edges, before = after, mark
        mark = tuple(after.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())
        if mark == before:
            break
    roots = edges.select(F.col("u.v").alias("id"), F.col("v.v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("id"), "root")).distinct()


def merged(issues: DataFrame, components: DataFrame) -> DataFrame:
    """Issues of one component as one: united lists, extremes of times, counts anew, and which issues went in."""
    rows = issues.join(components.withColumnRenamed("id", "issue_id"), "issue_id", "left").withColumn("root", F.coalesce("root", "issue_id"))
    out = rows.groupBy("root").agg(longest("title").alias("title"), longest("summary").alias("summary"), F.max("last_seen_at").alias("last_seen_at"), F.count("*").alias("n_issues"))
    for c, each in (("cves", F.explode("cves")), ("sources", F.explode("sources")), ("merged_from", F.col("issue_id"))):
        # Distinct values are found before anything is collected: a list is as long as its values are many, not its rows.
        values = rows.select("root", each.alias("v")).where("v is not null").distinct().groupBy("root").agg(F.array_sort(F.collect_list("v")).alias(c))
        out = out.join(values, "root", "left").withColumn(c, F.coalesce(c, F.array().cast("array<string>")))
    return out


def patch_status(hay: Column) -> Column:
    """patch_available, no_patch, mixed or unknown."""
    # How texts speak of patches.
    there = hay.rlike(r"(?i)(?<!\bno )\bpatch(ed| available| released)\b|\bfix(ed| available| released)\b|\bupdate available\b")
    none = hay.rlike(r"(?i)\bno (available )?(patch|fix|update)\b|\bunpatched\b|\bno fix\b")
    return F.when(there & none, "mixed").when(there, "patch_available").when(none, "no_patch").otherwise("unknown")


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(issue_id, change, was, now)`` between two snapshots of scored issues (``issue_id, priority, sources, cves, title, summary``).

    One full outer join on the id; each pair of versions yields one row per kind of change.
    """
    side = lambda d, p: d.select("issue_id", *[F.col(c).alias(f"{p}_{c}") for c in ("priority", "sources", "cves")], patch_status(F.concat_ws(" ", "title", "summary")).alias(f"{p}_patch"), F.lit(True).alias(f"{p}_is"))
    both = side(before, "was").join(side(after, "now"), "issue_id", "full_outer")
    old, new = F.col("was_is").isNotNull(), F.col("now_is").isNotNull()
    row = lambda kind, when, was, now: F.when(when, F.struct(F.lit(kind).alias("change"), was.alias("was"), now.alias("now")))
    empty, none = F.array().cast("array<string>"), F.lit(None).cast("string")
    added = lambda c: F.array_join(F.array_sort(F.array_except(F.coalesce(f"now_{c}", empty), F.coalesce(f"was_{c}", empty))), ";")
    kinds = F.array(
        row("new_issue", ~old & new, none, F.col("now_priority")), row("removed_issue", old & ~new, F.col("was_priority"), none),
        row("priority_change", old & new & (F.col("was_priority") != F.col("now_priority")), F.col("was_priority"), F.col("now_priority")),
        row("source_added", old & new & (added("sources") != ""), none, added("sources")), row("cve_added", old & new & (added("cves") != ""), none, added("cves")),
        row("patch_status_change", old & new & (F.col("was_patch") != F.col("now_patch")), F.col("was_patch"), F.col("now_patch")),
    )
    return both.select("issue_id", F.explode(F.array_compact(kinds)).alias("c")).select("issue_id", "c.*")
