"""Text cut off by field limits: a self-join by prefix over what the texts end with.

A text that lost its end stops within a sentence, line or markup that other texts carry on. Feeds phrase alike, so the join runs on *patterns*: sentences and lines with names, numbers
and codes masked. All distinct patterns of the corpus are sorted (range partitioned, so that a common beginning is spread over tasks); the
successor of a pattern in that order starts with it exactly if some longer pattern does, which finds every strict prefix without comparing pairs. The last
pattern of a text that is a strict prefix of a longer one is a candidate; the exact check on the ending follows: a complete sentence, a heading, title, list
item, table line, signature, link, reference or deliberate dots isn't cut.

Marks that feeds set after the break ("...", "[more]", "Read more") and end marks ("***", "-- end --") are taken off first. A break within markup
(an open tag, entity or link) and one within a line that already holds a full sentence need no longer copy.

The sorted patterns go through ``spark.checkpoint.dir``; what the driver sees is, for each partition (a number that the session sets), the first and last pattern and
those that are prefixes of the last.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.tables import cut, width

# What stands after a break or an end in the six languages of the feeds.
_MORE = r"continued|more|read more|continue reading|mehr|weiterlesen|weiter lesen|suite|lire la suite|la suite|más|leer más|sigue|mais|leia mais|ler mais|continua|続く|続き|続きを読む|truncated|snip|cut"
_AFTER = re.compile(rf"(?:\s*(?:…|\.{{3,}}|\[\s*(?:\.\.\.|…|&hellip;|{_MORE})\s*(?:…|\.\.\.)?\]|[(（]\s*(?:\.\.\.|…|{_MORE})\s*(?:…|\.\.\.)?[)）]|(?<=[\s….])(?:{_MORE})(?:…|\.\.\.|»|>>|→)?(?=\s*$)|&hellip;|»|>>|→))+\s*$", re.I)
_ENDMARK = re.compile(r"(?:\s*\n\s*(?:\*{3,}|#{3,}|-{3,}|={3,}|_{3,}|\[(?:EOF|end)\]|-+ ?end ?-+))+\s*$", re.I)
_BORDERS = ("\r", "\n", "</p>", "</li>", "<p>", "<li>")
_MARKUP = re.compile(r"(?:<[^<>\n]{0,400}|&#?\w{0,9}|!?\[[^\]\n]{0,200}\]\([^)\n]{0,400}|(?<!\w)\[[^\]\n]{0,120})$")
_MARKUP_LENGTH = 700  # no match of the pattern is longer
_TAG = re.compile(r"<[^<>]*>")
_SPLIT = re.compile(r"(?<=[.!?])\s+(?=\S)|(?<=[。！？])|[\r\n]+|</?(?:p|li|ul|ol|div|h\d|tr|td|table|br)\b[^<>]*>", re.I)
_BLOCK_TAG = re.compile(r"</?(?:p|li|ul|ol|div|h\d|tr|td|table|br)\b[^<>]*>", re.I)
_SENTENCE = re.compile(r"(?<=[.!?])\s+(?=\S)|(?<=[。！？])|[\r\n]+")
_WHOLE = re.compile(r"[.!?。！？][\"”’»)\]*_]*$")
_SENTENCE_BEFORE = re.compile(r"(?:[^\W\d_]{4,}|\d)[\"”’»)]*\.\s+[\w\"“„«‘¿¡]|。.")
#: A piece longer than any heading, list item or signature of the feeds is running text.
LONG_PIECE = 160


def _masked(s: str) -> str:
    s = s.replace("™", "").replace("®", "")
    s = re.sub(r"\b(?=[0-9a-f]*\d)[0-9a-f]{8}\b", "H", s)
    s = re.sub(r"\d+", "0", s)
    s = re.sub(r"(?<![0-9A-Za-zÀ-ÿ_])[A-ZÀ-Þ][0-9A-Za-zÀ-ÿ_-]*", "N", s)
    return re.sub(r"N(?:[ -]+N)+", "N", s)


def mask(text: str) -> str:
    """Pattern of a sentence or line: digits as 0, eight-digit codes and capitalised words as N, marks of ownership dropped."""
    return " ".join(_masked(_TAG.sub("", text)).split())


def pieces(text: str) -> list[str]:
    """Sentences and lines of a text."""
    return [s for x in _SPLIT.split(text) if x and (s := x.strip())]


def masks(text: str) -> set[str]:
    """The patterns of all sentences and lines of a text. Masks reach across no border, so the text is masked as a whole."""
    plain = _TAG.sub("", _BLOCK_TAG.sub("\n", text) if "<" in text else text)
    return {m for x in _SENTENCE.split(_masked(plain)) if x and (m := " ".join(x.split()))}


def _trimmed(text: str, pattern: re.Pattern) -> tuple[str, str]:
    """(text before what ``pattern`` takes off its end, what that is). The search starts near the end and goes back as far as the marks go."""
    back = 400
    while True:
        at = max(0, len(text) - back)
        m = pattern.search(text, at)
        if not m:
            return text, ""
        if m.start() > at + 100 or not at:  # no single mark is longer
            return text[: m.start()].rstrip(), m.group().strip()
        back *= 4


def _last_piece(body: str) -> str:
    """The last sentence or line: of the end of the text, or of all of it where that holds no border."""
    back = 300
    while True:
        near = pieces(body[-back:])
        if len(near) > 1 or back >= len(body):
            return near[-1] if near else ""
        back *= 4


def _last_line(body: str) -> str:
    """What follows the last border of lines, paragraphs and list items."""
    return body[max(body.rfind(b) + len(b) if b in body else 0 for b in _BORDERS) :].strip()


def before(text: str) -> tuple[str, str]:
    """(text before end marks and what follows a break, the mark that follows a break)."""
    body = _trimmed(text.rstrip(), _ENDMARK)[0]
    # No mark that follows a break ends in a single full stop.
    return (body, "") if body.endswith((".", "!", "?", "。", "！", "？")) and not body.endswith("...") else _trimmed(body, _AFTER)


def closed(body: str) -> tuple[str, bool]:
    """(``body`` without markup that is broken off at its end, whether there was any). What stands before it stops there as well, and is what a longer copy carries on."""
    m = _MARKUP.search(body, max(0, len(body) - _MARKUP_LENGTH))
    return (body[: m.start()].rstrip() or body, True) if m else (body, False)


def ending(text: str) -> tuple[str, str, bool, str, bool]:
    """(text before end marks and what follows a break, last piece, within markup, the mark that follows a break, last piece is whole)."""
    body, mark = before(text)
    low = body.lower()
    plain, broken = closed(body)
    last = _last_piece(plain)
    whole = bool(_WHOLE.search(_TAG.sub("", last).rstrip())) or bool(re.search(r"</\w+>$", body))
    return body, last, broken or low.rfind("<p>") > low.rfind("</p>"), mark, whole


def scan(text: str) -> tuple[str, bool, bool, bool]:
    """(pattern of the ending, within markup, last piece is whole, running text that stops).

    Dots alone after a phrase say nothing: they may be deliberate. Their pattern is compared without them, as in ``patterns``, so that
    a phrase that feeds always follow by dots is no prefix of itself.
    """
    body, last, markup, mark, whole = ending(text)
    plain = _TAG.sub("", _last_line(body))
    running = bool(_SENTENCE_BEFORE.search(plain)) or len(plain) > LONG_PIECE or bool(mark)
    dots = bool(re.fullmatch(r"(?:\.{3,}|…{2,}|[\s.]+)", mark))
    more = bool(re.search(r"\w", mark))  # a mark in words is set where a text was cut, also after a full stop
    return mask(last), markup, whole and (not mark or dots), more or (running and not whole and not dots)


def patterns(documents: DataFrame, text: str) -> DataFrame:
    """Distinct ``(m)``: every pattern of the corpus, those of endings with the marks taken off."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen: set[str] = set()
            for t in pdf["t"]:
                seen |= masks(closed(before(t)[0])[0])
            yield pd.DataFrame({"m": pd.Series(list(seen), dtype=object)})

    rows = documents.select(F.col(text).alias("t")).where(F.col("t").isNotNull())
    return rows.mapInPandas(run, "m string").distinct()


def strict_prefixes(values: DataFrame, column: str) -> DataFrame:
    """``(column, n, longer)`` of the values that are a strict prefix of a longer one: one sort, no pairs.

    ``n`` is how many rows have the value, ``longer`` how many rows (at least one) have a value that carries it on, in whatever partitions
    they are: each counts for the prefixes that earlier ones left open. Nulls are left out; an empty table gives an empty result.
    """
    parts = width(values.sparkSession)
    counted = values.select(F.col(column).alias("m")).where(F.col("m").isNotNull()).groupBy("m").agg(F.count("*").alias("n"))
    ordered = cut(counted.repartitionByRange(parts, "m").sortWithinPartitions("m"))

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head, last, chain = None, None, []
        for pdf in batches:
            for m in pdf["m"]:
                head = m if head is None else head
                while chain and not m.startswith(chain[-1]):
                    chain.pop()
                chain.append(last := m)
        if chain:
            yield pd.DataFrame({"p": [TaskContext.get().partitionId()], "first": [head], "last": [last], "chain": [chain]})

    # Per partition the values of earlier ones that its first value carries on.
    before: dict[int, list[str]] = {}
    chain: list[str] = []
    for r in sorted(ordered.mapInPandas(ends, "p int, first string, last string, chain array<string>").collect()):
        before[r["p"]] = [m for m in chain if r["first"].startswith(m)]
        chain = [m for m in before[r["p"]] if r["last"].startswith(m)] + r["chain"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Values met so far that are prefixes of the current one: [value, its rows here, rows of longer values here].
        open_: list[list] = [[m, 0, 0] for m in before.get(TaskContext.get().partitionId(), [])]

        def close(upto: str) -> list[list]:
            done = []
            while open_ and not upto.startswith(open_[-1][0]):
                x = open_.pop()
                if x[2]:
                    done.append(x)
            return done

        for pdf in batches:
            out = []
            for m, n in zip(pdf["m"], pdf["n"], strict=True):
                out += close(m)
                for x in open_:
                    x[2] += n
                open_.append([m, n, 0])
            yield pd.DataFrame(out, columns=["m", "n", "longer"]).astype({"m": object, "n": "int64", "longer": "int64"})
        yield pd.DataFrame(open_, columns=["m", "n", "longer"]).astype({"m": object, "n": "int64", "longer": "int64"})

    counts = ordered.mapInPandas(run, "m string, n long, longer long").groupBy("m").agg(F.sum("n").alias("n"), F.sum("longer").alias("longer"))
    return counts.where("longer > 0").withColumnRenamed("m", column)


def signs(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, longer, markup, running)`` of each text with a sign of a lost end: a longer copy of its last pattern, broken markup, a line that stops.

    ``longer`` counts where the last piece isn't a whole sentence, or stops within a number. Null, empty and blank texts never come out; repeated rows each do.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, *scan(t)) for k, t in zip(pdf[key], pdf["t"], strict=True) if t.strip()]
            yield pd.DataFrame(rows, columns=[key, "m", "markup", "whole", "running"])

    kind = dict(documents.dtypes)[key]
    ends = documents.select(key, F.col(text).alias("t")).where(F.col("t").isNotNull()).mapInPandas(run, f"{key} {kind}, m string, markup boolean, whole boolean, running boolean")
    longer = strict_prefixes(patterns(documents, text), "m").select("m", F.lit(True).alias("carried"))
    joined = ends.join(longer, "m", "left").withColumn("carried", F.coalesce("carried", F.lit(False)))
    stops = F.col("carried") & (~F.col("whole") | F.col("m").rlike(r"(^|[^0.])0\.(0\.)?$") | F.col("markup") | F.col("running"))
    return joined.select(key, stops.alias("longer"), "markup", "running").where("longer or markup or running")


def found(documents: DataFrame) -> DataFrame:
    """``(doc_id)`` of each document whose text lacks its end."""
    return signs(documents).select("doc_id")


def rates(documents: DataFrame) -> DataFrame:
    """``(source, n_docs, n_cut, share)``: how often each source truncates, over all its documents with a text."""
    marked = documents.select("doc_id", "source", "text").join(signs(documents).select("doc_id").distinct().withColumn("is_cut", F.lit(1)), "doc_id", "left")
    some = marked.where(F.col("text").rlike(r"\S"))
    return some.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum(F.coalesce("is_cut", F.lit(0))).alias("n_cut")).withColumn("share", F.round(F.col("n_cut") / F.col("n_docs"), 6))
