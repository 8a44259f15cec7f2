"""Encoding of the whole corpus with a public byte-level BPE vocabulary, by dynamic programming over prefixes.

The encoding of a piece of text (the splitting pattern's pieces are encoded apart) is a path of tokens in which every two
neighbours are *compatible*: encoding their concatenation gives the pair back. For each prefix of a piece there is exactly
one token that can be last in the prefix's encoding: among the vocabulary entries that end there (the automaton over the
vocabulary yields all suffixes of the prefix that are entries, longest first), the first that is compatible with the last token
of the prefix before it. Storing that token for every prefix and following the back-pointers from the end emits the exact ids in
time linear in the piece, whatever its length; no merge queue is kept.

Compatibility needs the two parts each token was last merged from and the rank of each pair that merges: both are tables
of the vocabulary (about 50,000 entries), derived once on the driver and broadcast. The pieces of a corpus repeat, so a worker keeps the ids of those it has met.
"""

from __future__ import annotations

import base64
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = os.environ.get("VIGILAKE_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: the pattern that splits text before merging, as published with the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEPT = 400_000

_loaded: dict[str, Tables] = {}


class Tables:
    """What the dynamic programme needs of a rank file: entries, merging pairs, the parts of each token."""

    def __init__(self, raw: bytes):
        self.raw = raw
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
        self.left, self.right = array("i", [0]) * len(ranks), array("i", [0]) * len(ranks)
        for entry, t in sorted(ranks.items(), key=lambda x: x[1]):
            self.left[t], self.right[t] = self._parts(entry, t, ranks)

    @staticmethod
    def _parts(entry: bytes, t: int, ranks: dict[bytes, int]) -> tuple[int, int]:
        """The two tokens that the merge of rank ``t`` joins: merge the bytes by all lower ranks until two are left."""
        parts = [entry[i : i + 1] for i in range(len(entry))]
        if len(parts) == 1:
            return t, t
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: r if (r := ranks.get(parts[i] + parts[i + 1])) is not None and r < t else 1 << 30)
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return ranks[parts[0]], ranks[parts[1]]


class Encoder:
    """Exact encoder of one vocabulary: ``ids(text)``."""

    def __init__(self, raw: bytes, left: array, right: array):
        import ahocorasick
        import regex

        self.split = regex.compile(PATTERN).findall
        self.left, self.right = left.tolist(), right.tolist()
        self.merged = {(a, b): t for t, (a, b) in enumerate(zip(self.left, self.right, strict=True)) if a != t}
        self.automaton = ahocorasick.Automaton()
        for line in raw.splitlines():
            entry, rank = line.split()
            entry = base64.b64decode(entry).decode("latin-1")
            self.automaton.add_word(entry, (len(entry), int(rank)))
        self.automaton.make_automaton()
        self.met: dict[str, tuple[int, ...]] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether the encoding of the text of ``a`` followed by that of ``b`` is the pair ``a, b``.

        It is unless some merge across the border comes first. The tokens at the border are undone from the last merge backwards: at
        each point only a pair that would have merged earlier than what has been undone so far can break the border.
        """
        left, right, merged, limit = self.left, self.right, self.merged, 1 << 30
        while True:
            t = merged.get((a, b))
            if t is not None and t < limit:
                return False
            # Undo the later of the two merges; an unmerged byte can't be undone, then the other one is.
            whole_a, whole_b = left[a] == a, left[b] == b
            if whole_a and whole_b:
                return True
            if not whole_a and (whole_b or a > b):
                limit, a = a, right[a]
            else:
                limit, b = b + 1, left[b]
            # A merge of the undone rank is on its own side already, hence "< limit" for the left and "<= b" for the right.

    def piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece: last token of every prefix, then the back-pointers."""
        text = piece.encode("utf-8", "surrogatepass").decode("latin-1")
        n = len(text)
        last = [-1] * (n + 1)
        size = [0] * (n + 1)
        ends: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, entry in self.automaton.iter(text):
            ends[end].append(entry)
        for end in range(n):
            for length, t in sorted(ends[end], reverse=True):
                start = end + 1 - length
                if start == 0 or (last[start] >= 0 and self.compatible(last[start], t)):
                    last[end + 1], size[end + 1] = t, length
                    break
        out = []
        while n:
            out.append(last[n])
            n -= size[n]
        return tuple(reversed(out))

    def extend(self, out: array, text: str) -> None:
        """Appends the ids of ``text`` to ``out``."""
        met = self.met
        for p in self.split(text):
            ids = met.get(p)
            if ids is None:
                ids = self.piece(p)
                if len(p) < 64:
                    if len(met) >= KEPT:
                        met.clear()
                    met[p] = ids
            out.extend(ids)

    def ids(self, text: str | None) -> list[int]:
        """Ids of a text; the empty and the null text have none."""
        out = array("i")
        if text:
            self.extend(out, text)
        return out.tolist()


def tables(path: str = VOCABULARY) -> Tables:
    if path not in _loaded:
        with open(path, "rb") as f:
            _loaded[path] = Tables(f.read())
    return _loaded[path]


def _encoder_source(df: DataFrame, path: str):
    """A function for the workers that gives the encoder, built once per worker process."""
    t = tables(path)
    shared = df.sparkSession.sparkContext.broadcast((t.raw, t.left, t.right))  # the vocabulary: a fixed size

    def encoder() -> Encoder:
        import sys

        # Globals of a pickled function are made anew for each task; a module lasts as long as the worker process.
        kept = sys.modules.setdefault("_vigilake_encoders", type(sys)("_vigilake_encoders")).__dict__
        if path not in kept:
            kept[path] = Encoder(*shared.value)
        return kept[path]

    return encoder


def encode(documents: DataFrame, path: str = VOCABULARY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, ids)``: the ids of each row's text without special tokens, whose strings are ordinary text.

    Empty and null texts both have an empty list. One row per input row, also for repeated ones.
    """
    encoder = _encoder_source(documents, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):  # bounds what is in memory at once by 512 texts
                part = batch.slice(at, 512)
                flat, ends = array("i"), [0]
                for t in part.column(1):
                    if s := t.as_py():
                        enc.extend(flat, s)
                    ends.append(len(flat))
                lists = pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), pa.array(np.frombuffer(flat, np.int32) if flat else np.empty(0, np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[key, "ids"])

    kind = dict(documents.dtypes)[key]
    return documents.select(key, text).mapInArrow(run, f"{key} {kind}, ids array<int>")


def lengths(documents: DataFrame, path: str = VOCABULARY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n)``: the number of tokens of each row's text; 0 for empty and null texts."""
    encoder = _encoder_source(documents, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder()
        for batch in batches:
            sizes = []
            for t in batch.column(1):
                flat = array("i")
                if s := t.as_py():
                    enc.extend(flat, s)
                sizes.append(len(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32())], names=[key, "n"])

    kind = dict(documents.dtypes)[key]
    return documents.select(key, text).mapInArrow(run, f"{key} {kind}, n int")
