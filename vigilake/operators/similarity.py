"""Similarity of issues and the search for candidates to merge, without comparing all pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.functions import text as T
from vigilake.tables import cut

WEIGHTS = {"cve": 0.40, "vendor": 0.30, "summary": 0.20, "date": 0.10}
SLACK, BLOCK, UNKNOWN = 1e-4, 1 << 19, -(1 << 31)  # what rounding to four digits may add; pairs compared at once; no day


def earliest_day(dates: Column) -> Column:
    """First ISO day among texts."""
    return F.array_min(F.transform(dates, lambda d: F.try_to_date(F.regexp_extract(d, r"\d{4}-\d{2}-\d{2}", 0), "yyyy-MM-dd")))


def date_score(a: Column, b: Column, window: int = 90) -> Column:
    """1 within ``window`` days, falling to 0 at twice that; a half if a day is unknown."""
    gap = F.abs(F.datediff(a, b))
    return F.when(a.isNull() | b.isNull(), 0.5).when(gap <= window, 1.0).when(gap <= 2 * window, 1.0 - (gap - window) / window).otherwise(0.0)


def prepared(issues: DataFrame) -> DataFrame:
    """``issue_id, c, v, s, d, members``: CVEs, vendor and summary tokens, earliest day; equal issues once, under the smallest id."""
    empty = F.array().cast("array<string>")
    rows = issues.select(
        "issue_id", F.array_sort(F.array_distinct(F.coalesce("cves", empty))).alias("c"), F.array_sort(T.tokens(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.substring(F.coalesce("summary", F.lit("")), 1, 300)))).alias("v"),
        F.array_sort(T.tokens(F.col("summary"))).alias("s"), earliest_day(F.coalesce("published_dates", empty)).alias("d"),
    )
    return rows.groupBy("c", "v", "s", "d").agg(F.min("issue_id").alias("issue_id"), F.count("*").alias("members"))


def composite(a: str, b: str) -> Column:
    """Similarity of two prepared issues, four digits, half to even; 0 if both have CVEs and share none."""
    col = lambda p, c: F.col(f"{p}.{c}")
    cve, vendor, summary = (T.jaccard(col(a, c), col(b, c)) for c in "cvs")
    date = date_score(col(a, "d"), col(b, "d"))
    w = WEIGHTS
    both = (F.size(col(a, "c")) > 0) & (F.size(col(b, "c")) > 0)
    neither = (F.size(col(a, "c")) == 0) & (F.size(col(b, "c")) == 0)
    without = (w["vendor"] + 0.6 * w["cve"]) * vendor + (w["summary"] + 0.4 * w["cve"]) * summary + w["date"] * date
    score = F.when(both & (cve == 0), 0.0).when(neither, without).otherwise(w["cve"] * cve + w["vendor"] * vendor + w["summary"] * summary + w["date"] * date)
    return F.bround(score, 4)


def _buckets(c: str) -> list[Column]:
    """``c0, c1``: two words of 64 bits that say which of 128 buckets hold a token of the set ``c``."""
    of = lambda i: F.filter(F.transform(c, lambda t: F.xxhash64(t)), lambda h: F.pmod(F.shiftright(h, 6), F.lit(2)) == i)
    one = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(h, F.lit(64)).cast("int"))
    return [F.aggregate(of(i), F.lit(0).cast("long"), lambda acc, h: acc.bitwiseOR(one(h))).alias(f"{c}{i}") for i in range(2)]


def shares(threshold: float) -> tuple[float, float]:
    """How similar the vendor or the summary tokens of a pair that reaches ``threshold`` are at least: if neither has CVEs, if one has."""
    w, rest = WEIGHTS, threshold - SLACK - WEIGHTS["date"]
    return max(rest / (1 - w["date"]), 0.001), max(rest / (w["vendor"] + w["summary"]), 0.001)


def closest(threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``(a, b)`` of the pairs of a key whose score can reach ``threshold``; the input is sorted by key and size and holds the rows of a key together.

    ``kind`` is 0 or 1 for keys of issues without CVEs (vendor, summary), 2 or 3 for keys that pair those with others, 4 for CVEs. Pairs are compared if the smaller set has the
    key among its first (``leads``) and the larger one has ``most`` tokens at most. Two sets differ by as many tokens as buckets, which bounds the score from above.
    """
    neither_share, one_share = shares(threshold)

    def pairs(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        c = {name: table.column(name).to_numpy() for name in table.column_names}
        c |= {name: c[name].view(np.uint64) for name in ("v0", "v1", "s0", "s1")}  # of signed numbers, bits of the absolute value would count
        place = np.cumsum(np.concatenate(([0], c["key"][1:] != c["key"][:-1]))) << 32 | c["n"].astype(np.int64)
        lead = np.flatnonzero(c["leads"])
        many = np.searchsorted(place, (place[lead] >> 32 << 32) | c["most"][lead].astype(np.int64), "right") - lead - 1
        lead, many = lead[many > 0], many[many > 0]
        ends, at = np.cumsum(many), 0

        def most_alike(of: str, x: np.ndarray, y: np.ndarray) -> np.ndarray:
            sizes, low, high = c[f"n{of}"], c[f"{of}0"], c[f"{of}1"]
            a, b = sizes[x].astype(np.int64), sizes[y].astype(np.int64)
            both = np.minimum((a + b - np.bitwise_count(low[x] ^ low[y]) - np.bitwise_count(high[x] ^ high[y])) // 2, np.minimum(a, b))
            return both / np.maximum(a + b - both, 1)

        while at < len(lead):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK, "right")))
            some, n = lead[at:to], many[at:to]
            at = to
            x = np.repeat(some, n)
            y = np.arange(len(x)) - np.repeat(np.cumsum(n) - n - some - 1, n)
            kind = c["kind"][x]
            ok = (kind < 2) | (kind == 4) | ((c["nc"][x] > 0) != (c["nc"][y] > 0))
            x, y, kind = x[ok], y[ok], kind[ok]
            ok = kind == 4
            for k, (of, share) in enumerate((("v", neither_share), ("s", neither_share), ("v", one_share), ("s", one_share))):
                i = np.flatnonzero(kind == k)
                ok[i] = most_alike(of, x[i], y[i]) >= share - 1e-9
            x, y = x[ok], y[ok]
            nc, day = c["nc"].astype(np.int64), c["day"].astype(np.int64)
            neither, cve = (nc[x] == 0) & (nc[y] == 0), np.minimum(nc[x], nc[y]) / np.maximum(np.maximum(nc[x], nc[y]), 1)
            date = np.where((day[x] == UNKNOWN) | (day[y] == UNKNOWN), 0.5, np.clip(2 - np.abs(day[x] - day[y]) / 90, 0, 1))
            w = WEIGHTS
            score = (w["vendor"] + 0.6 * w["cve"] * neither) * most_alike("v", x, y) + (w["summary"] + 0.4 * w["cve"] * neither) * most_alike("s", x, y) + w["cve"] * cve + w["date"] * date
            ok = score >= threshold - SLACK
            a, b = c["rid"][x[ok]], c["rid"][y[ok]]
            yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[pa.RecordBatch] = []
        for batch in batches:
            key = batch.column("key").to_numpy()
            if not len(key) or open_ and open_[0].column("key")[0].as_py() == key[-1]:
                open_ += [batch] if len(key) else []
                continue
            last = int(np.searchsorted(key, key[-1]))
            if open_ or last:
                yield from pairs([*open_, batch.slice(0, last)])
            open_ = [batch.slice(last)]
        if open_:
            yield from pairs(open_)

    return run


def merge_candidates(issues: DataFrame, threshold: float = 0.6) -> DataFrame:
    """``(id_a, id_b, score)`` of distinct issues at or above ``threshold``, ``id_a < id_b``; equal issues stand for each other.

    If both have CVEs, a pair shares one. If not, one of its token sets overlaps by ``shares`` at least, so it shares a token among the rarest: of the larger set ``|x| - ceil(t |x|) + 1``, of the
    smaller one ``|x| - ceil(2t / (1 + t) |x|) + 1`` (prefix filter). Pairs of a key are compared where they meet, by sizes, days and buckets of tokens; only those whose score can reach
    the threshold leave the task, and the exact score decides. Lossless for thresholds above the date's weight.
    """
    rows = cut(prepared(issues).where("issue_id is not null").select(F.monotonically_increasing_id().alias("rid"), "*"))
    facts = rows.select("rid", *[F.size(c).alias(f"n{c}") for c in "cvs"], F.coalesce(F.unix_date("d"), F.lit(UNKNOWN)).alias("day"), *_buckets("v"), *_buckets("s"))
    # Tokens travel as hashes: two that share one only bring more candidates.
    hashed = lambda c: F.transform(c, lambda t: F.xxhash64(F.lit(c), t))
    sets = F.array(hashed("v"), hashed("s"))
    each = rows.select("rid", F.posexplode(sets).alias("kind", "hs")).select("rid", "kind", F.explode("hs").alias("h"))
    ordered = each.join(each.groupBy("h").agg(F.count("*").alias("f")), "h").groupBy("rid", "kind").agg(F.array_sort(F.collect_list(F.struct("f", "h"))).getField("h").alias("hs"))
    known = ordered.join(facts, "rid").withColumn("n", F.size("hs"))
    longest = lambda share: F.col("n") - F.ceil(share * F.col("n") - 1e-9) + 1

    def first(of: DataFrame, share: float, kind: int) -> DataFrame:
        at = of.select("*", F.posexplode(F.slice("hs", 1, longest(share).cast("int"))).alias("at", "h")).withColumn("kind", F.col("kind") + kind)
        return at.select(F.xxhash64("kind", "h").alias("key"), "kind", "n", F.floor(F.col("n") / share + 1e-9).cast("int").alias("most"), (F.col("at") < longest(2 * share / (1 + share))).alias("leads"), *facts.columns)

    by_cve = facts.join(rows.select("rid", F.explode("c").alias("cve")), "rid").where("cve is not null")
    keys = by_cve.select(F.xxhash64(F.lit(4), "cve").alias("key"), F.lit(4).alias("kind"), F.lit(0).alias("n"), F.lit(0).alias("most"), F.lit(True).alias("leads"), *facts.columns)
    for share, of, kind in zip(shares(threshold), (known.where("nc = 0"), known), (0, 2), strict=True):
        if share <= 1:
            keys = keys.unionByName(first(of, share, kind))
    pairs = keys.repartition("key").sortWithinPartitions("key", "n").mapInArrow(closest(threshold), "a long, b long").distinct()
    joined = pairs.join(rows.alias("a"), F.col("a") == F.col("a.rid")).join(rows.alias("b"), F.col("b") == F.col("b.rid")).where(F.col("a.issue_id") != F.col("b.issue_id"))
    return joined.select(F.least("a.issue_id", "b.issue_id").alias("id_a"), F.greatest("a.issue_id", "b.issue_id").alias("id_b"), composite("a", "b").alias("score")).where(F.col("score") >= threshold)
