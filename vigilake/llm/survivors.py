"""Best representative of each duplicate group: one surviving record per issue, field by field.

A latent two-sided quality model decides what may survive and what is kept of the fields that hold many values. Nobody tells which values are sound, only *witnesses* speak: tests of a value (read in a wrong
encoding, cut off by this or that sign) and the sources that state it or leave it out. A witness is as good as its sensitivity and its specificity, and both are inferred, together with the truth, by
expectation-maximisation.

*Soundness* (``soundness``): is a title or summary whole? (Whether it is readable the hidden Markov model of ``mojibake`` decides.) The witnesses are the prefix joins of ``truncation`` over titles, title patterns and sentences, marks of a break and missing ends; each source has its own share of cut values. Some
witnesses are weak (the pattern of a title is the beginning of another's now and then by chance); what they are worth, alone and together, the model learns. The counts of what the tests say, by field and source, are all that
the iteration needs: they are made in one pass, and the iteration runs on the driver over one row per field, source of the registry and combination of tests.

*Truth* (``quality``): of the values that the records of an issue claim for a field, which are true? A source that has the field states a value or leaves it out. Multi-valued fields (``cves``,
``titles``, ``summaries``, ``published_dates``) keep every value judged true, ``sources`` those that state one.

Among the sound values of a single-valued field (``title``, ``summary``, ``published_date``) the order that the data's owner states holds: the most trusted source's, then the latest, then the first record.

Votes are counted per issue, value and source before anything is joined, so an issue with a third of all rows has no more votes for a value than there are
sources; parameters of the sources are a small table, broadcast only if its size allows.
"""

from __future__ import annotations

import math
import re
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.llm import mojibake, truncation
from vigilake.operators.timestamps import instant
from vigilake.tables import cut, small

# What collectors write where there is nothing to say.
PLACEHOLDERS = (
    "- -- --- . .. ... ? n/a n.a. n.a na none null nil nan tbd tba tbc unknown untitled item entry title summary description pending test "
    "(none) (null) (empty) empty undefined".split()
    + ["(no title)", "no title", "(untitled)", "see link", "see advisory", "see above", "details to follow", "details to follow.", "no description available", "no description available."]
    + ["no summary available", "no summary available.", "no description", "no summary", "to be announced", "to be determined", "not available", "coming soon", "no title available", "lorem ipsum"]
)
FILLER_DAYS = ("1900-01-01", "1970-01-01", "0001-01-01", "9999-12-31", "2099-12-31")
_ENDED = r"(?<!\.\.)[.!?。！？][\"”’»)\]]*\s*(?:</\w+>\s*)*$"
FIELDS = ("title", "summary", "published_date")


def title_pattern(title: str) -> str:
    """Pattern of a title: codes as C, capitalised words as N, numbers as 0."""
    s = re.sub(r"[™®]", "", title)
    s = re.sub(r"\bCVE-\d+-\d+\b", "V", s)
    s = re.sub(r"\b[A-ZÀ-Þ]{1,5}-\d+\b", "C", s)
    s = re.sub(r"\d+", "0", s)
    s = re.sub(r"\b(?![CV]\b)[A-ZÀ-Þ][\w-]*", "N", s)
    return re.sub(r"\s+", " ", re.sub(r"N(?: N)+", "N", s)).strip()


def _nothing(value: Column) -> Column:
    """Whether a text says nothing: null, blank or a placeholder."""
    return value.isNull() | F.lower(F.trim(F.regexp_replace(value, r"[\s\p{Z}]+", " "))).isin("", *PLACEHOLDERS)


#: What the tests are, by field: bit i of ``said`` is test i.
TESTS = {"title": ("garbled", "marked", "prefix of a title", "prefix of a commoner pattern", "prefix of a pattern"), "summary": ("garbled", "prefix of a pattern", "open markup", "running text", "no closing mark")}


def _bit(field: str, test: str) -> Column:
    return F.lit(1 << TESTS[field].index(test))


def title_tests(records: DataFrame) -> DataFrame:
    """``(record_id, said)`` of titles with a sign of being cut off: a mark of a break, or a strict prefix of another title or title pattern."""

    def pattern(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["p"] = [title_pattern(t) for t in pdf["t"]]
            yield pdf

    titles = records.where(~_nothing(F.col("title"))).select("record_id", F.trim(F.regexp_replace("title", r"[\s\p{Z}]+", " ")).alias("t"))
    marks = r"\s*(?:…|\.\.\.|\[(?:…|\.\.\.|more)\]|\((?:…|\.\.\.)\))$"
    marked = titles.where(F.col("t").rlike(marks))
    plain = cut(titles.select("record_id", F.regexp_replace("t", marks, "").alias("t")).where("t <> ''").mapInPandas(pattern, "record_id long, t string, p string"))
    raw = truncation.strict_prefixes(plain.select("t").distinct(), "t").select("t", _bit("title", "prefix of a title").alias("said"))
    shape = truncation.strict_prefixes(plain, "p").select("p", (_bit("title", "prefix of a pattern") + F.when(F.col("longer") > F.col("n"), _bit("title", "prefix of a commoner pattern")).otherwise(0)).alias("said"))
    return marked.select("record_id", _bit("title", "marked").alias("said")).unionByName(plain.join(raw, "t").select("record_id", "said")).unionByName(plain.join(shape, "p").select("record_id", "said"))


def tested(records: DataFrame) -> DataFrame:
    """``(record_id, field, said)``: which tests speak against a title or summary; no row where none does."""
    garbled = mojibake.labelled(records, "record_id").select("record_id", "field", F.lit(1).alias("said"))
    texts = records.where(~_nothing(F.col("summary")))
    signs = (("longer", "prefix of a pattern"), ("markup", "open markup"), ("running", "running text"))
    ends = truncation.signs(texts, "record_id", "summary").select("record_id", sum((F.when(F.col(c), _bit("summary", t)).otherwise(0) for c, t in signs), F.lit(0)).alias("said"))
    # A summary is running text: it also needs the full stop that a title doesn't.
    unclosed = texts.where(~F.col("summary").rlike(_ENDED)).select("record_id", _bit("summary", "no closing mark").alias("said"))
    summaries = ends.unionByName(unclosed).select("record_id", F.lit("summary").alias("field"), "said")
    titles = title_tests(records).select("record_id", F.lit("title").alias("field"), "said")
    every = garbled.unionByName(summaries).unionByName(titles)
    return cut(every.groupBy("record_id", "field").agg(F.bit_or("said").alias("said")))


#: Tests that ask the same question are one witness, which may speak in several ways; a garbled value is judged by the hidden Markov model alone.
WITNESSES = {
    "title": {"mark": ("marked",), "longer copy": ("prefix of a title", "prefix of a commoner pattern", "prefix of a pattern")},
    "summary": {"longer copy": ("prefix of a pattern",), "stop": ("open markup", "running text"), "end": ("no closing mark",)},
}
GARBLED = 1  # bit 0 in both fields
#: How often a test errs, to start from: next to never, but for the pattern of a title, which is the beginning of another's by chance now and then.
WEAK = {("title", "prefix of a pattern")}
ERRS, WEAK_ERRS = 0.002, 0.1


def soundness(counts: list[tuple[str, str, int, int]], limit: int = 2000, close: float = 1e-6) -> tuple[dict[tuple[str, str, int], float], dict[tuple[str, str], tuple[float, float]]]:
    """(``{(field, source, said): probability that such a value is cut off}``, ``{(field, witness): (sensitivity, specificity)}``) by expectation-maximisation.

    ``counts`` has (field, source, said, number of values). Sensitivity is how often a witness speaks where the value is cut off, specificity how often it is silent where it is whole; that its weak tests
    speak alone has a rate of its own. Ends when no rate moves by more than ``close``, and with a warning after ``limit`` rounds. The iteration starts from
    the values of which a test that isn't ``WEAK`` speaks. The priors, a witness that sees half of what is cut off and errs as ``ERRS`` and ``WEAK_ERRS`` say, weigh as much as ten values, so one that hardly speaks stays near them.
    """
    chance: dict[tuple[str, str, int], float] = {}
    learned: dict[tuple[str, str], tuple[float, float]] = {}
    for field, witnesses in WITNESSES.items():
        rows = [(s, b, n) for f, s, b, n in counts if f == field]
        if not rows:
            continue
        sources = sorted({s for s, _, _ in rows})
        who = np.array([sources.index(s) for s, _, _ in rows])
        n = np.array([float(n) for _, _, n in rows])
        ways, says, starts = [], [], []
        weak = sum(1 << TESTS[field].index(t) for f, t in WEAK if f == field)
        for own in witnesses.values():
            bits = sum(1 << TESTS[field].index(t) for t in own)
            levels = np.array([2 if b & bits & ~weak else 1 if b & bits else 0 for _, b, _ in rows])
            ways.append(sorted({0, *levels.tolist()}))
            says.append(np.searchsorted(ways[-1], levels))
            errs = [WEAK_ERRS if way == 1 else ERRS for way in ways[-1][1:]]
            starts.append(np.array([[1 - sum(errs), *errs], [0.5 if errs else 1.0, *[0.5 / max(1, len(errs))] * len(errs)]]))
        p = np.array([1.0 if b & ~(weak | GARBLED) else 0.0 for _, b, _ in rows])
        rates, share = starts, np.full(len(sources), 0.05)
        for _ in range(limit):
            weight = np.stack([n * (1 - p), n * p])
            new = [np.stack([(np.bincount(s, w, len(x[0])) + 10 * x0) / (w.sum() + 10) for w, x0 in zip(weight, x, strict=True)]) for x, s in zip(starts, says, strict=True)]
            overall = (weight[1].sum() + 0.5) / (n.sum() + 10)
            new_share = (np.bincount(who, weight[1], len(sources)) + 10 * overall) / (np.bincount(who, n, len(sources)) + 10)
            log = np.stack([np.log(1 - new_share)[who], np.log(new_share)[who]]) + sum(np.log(r)[:, s] for r, s in zip(new, says, strict=True))
            p = 1 / (1 + np.exp(np.clip(log[0] - log[1], -60, 60)))
            moved = max(np.abs(new_share - share).max(), *(np.abs(x - y).max() for x, y in zip(new, rates, strict=True)))
            rates, share = new, new_share
            if moved < close:
                break
        else:
            warnings.warn(f"rates of {field} still move by {moved} after {limit} rounds", stacklevel=2)
        chance |= {(field, s, b): float(x) for (s, b, _), x in zip(rows, p, strict=True)}
        learned |= {(field, name): (float(1 - r[1, 0]), float(r[0, 0])) for name, r in zip(witnesses, rates, strict=True)}
    return chance, learned


def claimed(records: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``(record_id, issue_id, field, source, fetched_at, day, known, said)`` of each value that says something, ``(field, known, said, n)``).

    ``known`` is the source if the registry has it, else an empty string: sources without an entry are one.
    """
    spoken = tested(records)
    zones = sources.select(F.col("source_id").alias("source"), F.col("source_id").alias("known"), "feed_tz", "date_order").where("source is not null").dropDuplicates(["source"])
    rows = records.select("record_id", "issue_id", "source", "fetched_at", *FIELDS).where("issue_id is not null").join(F.broadcast(zones) if small(sources) else zones, "source", "left")
    micros = instant(F.col("published_date"), F.coalesce("feed_tz", F.lit("UTC")), F.col("date_order"))
    stamp = F.trim(F.substring("published_date", 1, 10))
    dated = ~_nothing(F.col("published_date")) & F.col("micros").isNotNull() & ~stamp.isin(*FILLER_DAYS)
    says = F.array(*[F.when(ok, F.lit(f)) for f, ok in (("title", ~_nothing(F.col("title"))), ("summary", ~_nothing(F.col("summary"))), ("published_date", dated))])
    long = rows.withColumn("micros", micros).select("record_id", "issue_id", "source", "fetched_at", F.to_date(F.timestamp_micros("micros")).cast("string").alias("day"), F.coalesce("known", F.lit("")).alias("known"), F.explode(F.array_compact(says)).alias("field"))
    values = cut(long.join(spoken, ["record_id", "field"], "left").withColumn("said", F.coalesce("said", F.lit(0))))
    return values, values.where(F.col("field").isin(*TESTS)).groupBy("field", "known", "said").agg(F.count("*").alias("n"))


def admissible(records: DataFrame, sources: DataFrame) -> DataFrame:
    """``(record_id, issue_id, field, source, fetched_at, day)`` of each value that says something and that the model takes for readable and whole."""
    values, counts = claimed(records, sources)
    # One row per field, source of the registry and combination of five tests: bounded by the registry.
    chance, _ = soundness([tuple(r) for r in counts.select("field", "known", "said", "n").collect()])
    judged = records.sparkSession.createDataFrame([(*k, x) for k, x in chance.items()], "field string, known string, said int, broken double")
    out = values.join(F.broadcast(judged) if len(chance) <= 100_000 else judged, ["field", "known", "said"], "left").where((F.coalesce("broken", F.lit(0.0)) < 0.5) & (F.col("said").bitwiseAND(GARBLED) == 0))
    return out.select("record_id", "issue_id", "field", "source", "fetched_at", "day")


def tests(records: DataFrame, sources: DataFrame) -> DataFrame:
    """``(field, witness, sensitivity, specificity)`` of each witness of a cut as the model learns them."""
    _, learned = soundness([tuple(r) for r in claimed(records, sources)[1].select("field", "known", "said", "n").collect()])
    return records.sparkSession.createDataFrame([(*k, round(x, 6), round(y, 6)) for k, (x, y) in sorted(learned.items())], "field string, witness string, sensitivity double, specificity double")


def winners(records: DataFrame, sources: DataFrame) -> DataFrame:
    """``(issue_id, field, record_id)``: for each issue of two or more rows and each field the record whose value survives.

    Lowest tier first (sources without one last), then the latest ``fetched_at`` (null last), then the smallest ``record_id``. No row if no
    value can survive. One partial minimum per issue and field: no group is collected.
    """
    tiers = sources.select(F.col("source_id").alias("source"), "tier").groupBy("source").agg(F.min("tier").alias("tier"))
    several = records.where("issue_id is not null").groupBy("issue_id").agg(F.count("*").alias("rows")).where("rows >= 2").select("issue_id")
    ranked = admissible(records, sources).join(F.broadcast(tiers) if small(sources) else tiers, "source", "left")
    order = F.struct(F.coalesce("tier", F.lit(2**31 - 1)).alias("t"), F.coalesce(-F.unix_micros("fetched_at"), F.lit(2**62)).alias("f"), F.col("record_id").alias("r"))
    best = ranked.groupBy("issue_id", "field").agg(F.min(order).alias("o"))
    return best.join(several, "issue_id", "left_semi").select("issue_id", "field", F.col("o.r").alias("record_id"))


VALUES = ("title", "summary", "published_date", "cves")


def stated(records: DataFrame, sources: DataFrame) -> DataFrame:
    """``(issue_id, source, record_id, field, value)``: the sound values of each record; dates as days, repeated CVEs once. Records without a source have the source ''."""
    sound = admissible(records, sources).select("record_id", "field", "day").distinct()
    text = records.select("record_id", "issue_id", F.coalesce("source", F.lit("")).alias("source"), "title", "summary").dropDuplicates(["record_id"])
    value = F.when(F.col("field") == "published_date", F.col("day")).otherwise(F.trim(F.regexp_replace(F.when(F.col("field") == "title", F.col("title")).otherwise(F.col("summary")), r"[\s\p{Z}]+", " ")))
    single = text.join(sound, "record_id").select("issue_id", "source", "record_id", "field", value.alias("value"))
    cves = records.where("issue_id is not null").select("issue_id", F.coalesce("source", F.lit("")).alias("source"), "record_id", F.lit("cves").alias("field"), F.explode(F.array_distinct(F.filter("cves", lambda v: v.isNotNull() & (F.trim(v) != "")))).alias("value"))
    return cut(single.unionByName(cves))


def votes(records: DataFrame, values: DataFrame) -> DataFrame:
    """``(issue_id, field, value, source, yes, no)`` of values as ``stated`` gives them: how many rows of each source state a value, or have the field and leave it out.

    An empty list of CVEs leaves out every CVE; a missing one says nothing.
    """
    listed = records.where("issue_id is not null and cves is not null").select("issue_id", F.coalesce("source", F.lit("")).alias("source"), F.lit("cves").alias("field"), "record_id")
    has = values.where("field <> 'cves'").select("issue_id", "source", "field", "record_id").unionByName(listed)
    asked = has.groupBy("issue_id", "field", "source").agg(F.count("*").alias("rows"))
    yes = values.groupBy("issue_id", "field", "value", "source").agg(F.count("*").alias("yes"))
    pairs = yes.select("issue_id", "field", "value").distinct().join(asked, ["issue_id", "field"]).join(yes, ["issue_id", "field", "value", "source"], "left")
    return pairs.select("issue_id", "field", "value", "source", F.coalesce("yes", F.lit(0)).alias("yes"), F.greatest(F.col("rows") - F.coalesce("yes", F.lit(0)), F.lit(0)).alias("no"))


def quality(claims: DataFrame, limit: int = 60, close: float = 0.002, prior: float = 0.6) -> tuple[DataFrame, DataFrame]:
    """(``(issue_id, field, value, truth)``, ``(field, source, sensitivity, specificity)``) by expectation-maximisation from ``votes``.

    Each round is one aggregation over the votes per value and one per source. It ends when no source's sensitivity or specificity moves by more than ``close``, and with a warning after ``limit`` rounds. Beta priors keep
    a source with few votes near 0.8 and 0.8; an empty table gives empty results.
    """
    # Texts are long and every round joins on them: the rounds carry a hash of issue, field and value.
    claims = cut(claims.withColumn("fact", F.xxhash64("issue_id", "field", "value")))
    votes_ = cut(claims.select("fact", "field", "source", "yes", "no"))
    who = votes_.select("field", "source").distinct().select("field", "source", F.lit(0.8).alias("sensitivity"), F.lit(0.8).alias("specificity"))
    truth = None
    for _ in range(limit):
        told = votes_.join(F.broadcast(who) if small(who, 1 << 20) else who, ["field", "source"])
        evidence = F.col("yes") * F.log(F.col("sensitivity") / (1 - F.col("specificity"))) + F.col("no") * F.log((1 - F.col("sensitivity")) / F.col("specificity"))
        odds = F.sum(evidence) + math.log(prior / (1 - prior))
        truth = told.groupBy("fact").agg((1 / (1 + F.exp(-F.least(F.greatest(odds, F.lit(-40.0)), F.lit(40.0))))).alias("truth"))
        judged = votes_.join(truth, "fact")
        t, f = F.col("truth"), 1 - F.col("truth")
        sums = judged.groupBy("field", "source").agg(F.sum(t * F.col("yes")).alias("ty"), F.sum(t * F.col("no")).alias("tn"), F.sum(f * F.col("yes")).alias("fy"), F.sum(f * F.col("no")).alias("fn"))
        sensitivity = (F.col("ty") + 8) / (F.col("ty") + F.col("tn") + 10)
        specificity = (F.col("fn") + 8) / (F.col("fy") + F.col("fn") + 10)
        # Hardly two sources word a title or summary alike, so nothing there tells liars: that a source states one never speaks against it.
        specificity = F.when(F.col("field").isin("title", "summary"), F.greatest(specificity, 1.05 - sensitivity)).otherwise(specificity)
        new = cut(sums.select("field", "source", sensitivity.alias("sensitivity"), F.least(specificity, F.lit(0.999)).alias("specificity")))
        old = who.select("field", "source", F.col("sensitivity").alias("s0"), F.col("specificity").alias("p0"))
        moved = new.join(old, ["field", "source"]).agg(F.max(F.greatest(F.abs(F.col("sensitivity") - F.col("s0")), F.abs(F.col("specificity") - F.col("p0"))))).first()[0]
        who = new
        if (moved or 0) <= close:
            break
    else:
        warnings.warn(f"sources still move by {moved} after {limit} rounds", stacklevel=2)
    return claims.select("issue_id", "field", "value", "fact").distinct().join(truth, "fact").drop("fact"), who


def survivors(records: DataFrame, sources: DataFrame) -> DataFrame:
    """One record per issue: the winning value of each single-valued field, and every value judged true of ``cves``, ``titles``, ``summaries`` and ``published_dates``, with the ``sources`` that state one; all sorted.

    Lists are as long as an issue has distinct true values.
    """
    best = winners(records, sources)
    values = records.select("record_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("v")) for f in FIELDS])).alias("x")).select("record_id", "x.field", "x.v")
    chosen = best.join(values, ["record_id", "field"]).groupBy("issue_id").agg(*[F.min(F.when(F.col("field") == f, F.col("v"))).alias(f) for f in FIELDS])
    said = stated(records, sources)
    truth, _ = quality(votes(records, said))
    true = cut(truth.where("truth >= 0.5").select("issue_id", "field", "value"))
    names = {"cves": "cves", "title": "titles", "summary": "summaries", "published_date": "published_dates"}
    kept = true.groupBy("issue_id").agg(*[F.array_sort(F.collect_set(F.when(F.col("field") == f, F.col("value")))).alias(n) for f, n in names.items()])
    trusted = said.join(true, ["issue_id", "field", "value"], "left_semi").where("source <> ''").select("issue_id", "source").distinct().groupBy("issue_id").agg(F.array_sort(F.collect_set("source")).alias("sources"))
    every = records.where("issue_id is not null").groupBy("issue_id").agg(F.count("*").alias("n_records"), F.countDistinct("source").alias("n_sources"))
    return every.join(chosen, "issue_id", "left").join(kept, "issue_id", "left").join(trusted, "issue_id", "left")
