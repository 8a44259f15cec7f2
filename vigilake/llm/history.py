"""Deduplicating new batches against all history with an index that lasts.

Rows report the same item by key (source and guid, or signal_id, apart from spelling), by text (title and summary of one source the same but
for small edits; the entry of another catalogue is another item) or by a chain of such links.

``Index`` is a folder. A batch is *accepted* once: it is searched against what is there, and what it adds is written as new files; no raw row
of an earlier batch is read again. The folder holds

* ``keys``: one row per key, the first row that had it;
* ``segments``: one per batch, filed by shard and way as parquet. A task that searches a shard loads the texts of that shard only. Beyond ``MAX_SEGMENTS`` the two smallest are
  compacted into one;
* ``links``: what each batch was linked to, and a manifest.

A text is reduced to its set of words, a 128-bit sketch of it and its codes (tokens with numbers) in one fixed order, the longest, hence rarest, first. It is filed in the shards of the first
codes in that order: as many as it takes for any two texts whose codes have a similarity of ``SAME_CODES`` to have one in common (a prefix filter, so
no accepted pair is lost in routing); texts without a code by their words in the same way. Which shard a route leads to is a *version* of the routing: the number of shards grows with the texts, and routes that too many texts take are split
by a second word in common, again by a prefix filter. So a pair meets however many texts there are. Segments keep the version they were written in until they are compacted.

In a shard a text is compared with all texts of its way (a route, or a route and a second word): those within ``NEAR_BITS`` are reranked exactly on the word sets. No bound of the search depends on
how many texts there are. (``Graph``, a small-world graph whose tuned beam did depend on it, isn't used by the index any more.)

Copies (equal word sets) are collapsed where they are read and where they meet. Pairs already linked aren't reranked, so a cluster costs about as many comparisons as it has texts.
"""

from __future__ import annotations

import json
import math
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.llm.components import components
from vigilake.operators.timestamps import let
from vigilake.tables import checkpoint_dir, cut, small, width

SHIFT = 48  # an id is the batch number above SHIFT bits of row_id, so ids sort as (batch_no, row_id) do
SHARD, SPLIT = 24_000, 4_000  # texts a shard holds on average at most; texts from which a route is split
MAX_SEGMENTS, BEAM, WIDEST, HOPS, PROBES, RECALL, EXACT, EXHAUSTIVE = 3, 12, 48, 1, 48, 0.99, 256, 65_536
PAIRS = 1 << 18  # compared at once
NEAR_BITS = 46  # of 128: farther sketches are not reranked
SAME_WORDS, SAME_CODES = 0.75, 0.6
_WORD = re.compile(r"[a-z0-9]+|[぀-ヿ一-鿿]{2}")
_TAG = re.compile(r"<[^<>]*>|&[a-z]+;")

def guid_key(guid: Column) -> Column:
    """A guid without what is spelling: case, blanks, dashes, prefixes; for addresses scheme, www, default port, doubled and closing
    slashes, index page, fragment, escapes, order of parameters and tracking parameters. Null if nothing is left.
    """

    def address(g: Column) -> Column:
        url = F.regexp_replace(F.regexp_replace(g, "&amp;", "&"), r"#.*$", "")
        url = F.when(url.contains("%"), F.lower(F.coalesce(F.try_url_decode(F.regexp_replace(url, r"\+", "%2B")), url))).otherwise(url)
        url = F.regexp_replace(F.regexp_replace(url, r"^[a-z]+:/+(?:www\.)?", ""), r"^([^/?]*):(?:443|80)(?=[/?]|$)", "$1")
        return let(url, parts)

    def parts(url: Column) -> Column:
        path, query = F.split_part(url, F.lit("?"), F.lit(1)), F.regexp_extract(url, r"\?(.*)$", 1)
        path = F.regexp_replace(F.regexp_replace(F.regexp_replace(path, r"/\.?(?=/)", ""), r"/(?:index|default)\.(?:html?|php|aspx?)$", ""), r"/+$", "")
        query = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(?:utm_\w+|fbclid|gclid|mc_cid|mc_eid)(?:=|$)"))), "&")
        return let(query, lambda q: F.concat(path, F.when(q != "", F.concat(F.lit("?"), q)).otherwise("")))

    def code(g: Column) -> Column:
        g = F.regexp_replace(F.regexp_replace(g, r"^urn:[a-z]+:|^(?:guid|uuid|id):|^#", ""), r"[\s\p{Pd}_]+", "")
        g = F.when(g.rlike(r"^\d{1,3}(?:,\d{3})+$"), F.regexp_replace(g, ",", "")).otherwise(g)
        return F.regexp_replace(F.regexp_replace(g, r"^(\d+)\.0+$", "$1"), r"^0+(?=\d+$)", "")

    def key(g: Column) -> Column:
        plain = F.when(g.rlike(r"^https://(?!www\.)[a-z][a-z.-]*[a-z](?:/[a-z0-9-]+)+$") & ~g.endswith("/index"), F.substring(g, 9, 1 << 30))
        plain = plain.when(g.rlike(r"^[a-z1-9][a-z0-9-]*$"), F.translate(g, "-", ""))
        # The usual forms need none of the rewriting; the rest is cleaned of all that is spelling.
        bare = F.regexp_replace(F.regexp_replace(g, r"[\s\p{Z}]+", " "), r"^[\s\"'<{(]+|[\s\"'>})]+$", "")
        return plain.otherwise(let(bare, lambda x: F.when(x.rlike(r"^[a-z]+://"), address(x)).otherwise(code(x))))

    named = let(F.lower(F.trim(guid)), key)
    return let(named, lambda k: F.when(~k.isin("", "null", "none", "n/a", "na", "nan", "unknown"), k))


def signal_key(signal_id: Column) -> Column:
    """A signal_id without case, blanks and the name of the digest; null if blank."""
    bare = F.regexp_replace(F.lower(F.regexp_replace(signal_id, r"[\s\p{Z}]+", "")), r"^(?:sha-?256[:=]|0x)", "")
    usual = F.when(signal_id.rlike("^[0-9a-f]{64}$"), signal_id)
    return usual.otherwise(let(bare, lambda k: F.when(~k.isin("", "null", "none", "n/a", "na", "nan", "unknown"), k)))


def with_ids(signals: DataFrame) -> DataFrame:
    """``signals`` with ``id``: ``batch_no`` above ``row_id``; a row without batch counts as history."""
    return signals.select(F.shiftleft(F.coalesce("batch_no", F.lit(0)).cast("long"), SHIFT).bitwiseOR(F.col("row_id")).alias("id"), "source", "guid", "signal_id", "title", "summary")


def keyed(rows: DataFrame) -> DataFrame:
    """``(id, k)``: the keys of each row. A source without a guid, and a guid without a source, are no key."""
    guid = F.when(F.col("source").isNotNull(), let(guid_key(F.col("guid")), lambda k: F.when(k.isNotNull(), F.xxhash64(F.lit("g"), "source", k))))
    signal = let(signal_key(F.col("signal_id")), lambda k: F.when(k.isNotNull(), F.xxhash64(F.lit("s"), k)))
    return rows.select("id", F.explode(F.array_compact(F.array(guid, signal))).alias("k"))


def tokens(title: str | None, summary: str | None) -> set[str]:
    """Words of a text as they survive wrong encodings, case, markup and order: ASCII words and pairs of Japanese characters."""
    text = f"{title or ''} {summary or ''}".lower()
    return set(_WORD.findall(_TAG.sub(" ", text) if "<" in text or "&" in text else text))


def is_code(token: str) -> bool:
    """Tokens with three digits or more: numbers of models, lots, notices and vulnerabilities."""
    return len(token) >= 3 and sum(c.isdigit() for c in token) >= 3


def prefix(n: np.ndarray, share: float) -> np.ndarray:
    """How many of the first of ``n`` tokens it takes so that any two sets of similarity ``share`` have one in common."""
    return np.where(n > 0, n - np.ceil(share * n - 1e-9) + 1, 0).astype(np.int64)


def _mix(h: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of each hash (the finaliser of a public splittable generator)."""
    with np.errstate(over="ignore"):
        z = h.astype(np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


#: Each byte as eight counters: of 8 bits in one word, of 16 bits in two.
_BYTE = np.array([sum(((v >> (7 - lane)) & 1) << (8 * lane) for lane in range(8)) for v in range(256)], np.uint64)
_PAIR = np.array([[sum(((v >> (7 - 4 * half - lane)) & 1) << (16 * lane) for lane in range(4)) for half in range(2)] for v in range(256)], np.uint64)


def sketches(flat: np.ndarray, weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``(n, 2)`` words per stretch of ``flat``: bit i is the sign of the weighted sum of the tokens' bits i. The weights of a stretch sum up to less than 65,536; up to 255 takes half the work."""
    raw = np.stack([_mix(flat, 1), _mix(flat, 2)], axis=1).view(np.uint8)
    total = np.add.reduceat(weight.astype(np.int64), starts)[:, None]
    small = total.max() < 256
    lanes = _BYTE[raw] if small else _PAIR[raw].reshape(len(flat), 32)
    ones = np.add.reduceat(lanes * weight.astype(np.uint64)[:, None], starts, axis=0).view(np.uint8 if small else np.uint16)
    return np.packbits(2 * ones.astype(np.int64) > total, axis=1).view(np.uint64)


TEXT = "id long, src int, bag long, k1 long, s0 long, s1 long, codes int, words binary"
FILED = f"{TEXT}, routes array<long>, twin long"
NODE = f"shard long, node int, sub int, pos int, route long, way long, {TEXT}, o0 int, hits array<long>"
_LONG, _INT = pa.int64(), pa.int32()
_KINDS = {"long": _LONG, "int": _INT, "binary": pa.binary(), "array<long>": pa.list_(_LONG)}
CODE = 1 << 40


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _lists(flat: np.ndarray, size: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), pa.array(flat, kind))


def _blobs(flat: np.ndarray, size: np.ndarray) -> pa.Array:
    """Stretches of 32-bit numbers as bytes: one value to move, however many words a text has."""
    ends = np.concatenate(([0], np.cumsum(size * 4))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(flat))])


def _unblobbed(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of all values one after another, how many each has)."""
    parts, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
    for c in column.chunks:
        ends = np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1] if len(c) else np.zeros(1, np.int32)
        if ends[-1] > ends[0]:
            parts.append(np.frombuffer(c.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.uint32))
        sizes.append(np.diff(ends).astype(np.int64) // 4)
    return np.concatenate(parts), np.concatenate(sizes)


def _halves(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A sort key of the upper halves of two hashes."""
    return (a & np.uint64(0xFFFFFFFF00000000)) | (b >> np.uint64(32))


def filed(rows: DataFrame) -> DataFrame:
    """Each text once per task as it is filed: word set (codes first), sketch, sort keys and routes; repeats of a word set only name their first row (``twin``).

    Texts without a word, and titles alone that have no code or fewer than four words, are no evidence and are left out. Everything but the words is mixed
    with the source, so texts of two sources have nothing in common. Rows without a source are one source.
    """
    schema = _schema(FILED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        known: dict[str, int] = {}

        def value(w: str) -> int:
            h = known[w] = zlib.crc32(w.encode()) | (15 - min(len(w), 15)) << 33 | (0 if is_code(w) else CODE)  # codes sort first, then the longest
            return h

        def some(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            ids, src, lists = [], [], []
            for i, o, t, s in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                h = [known.get(w) or value(w) for w in tokens(t, s)]
                if h and (s and not s.isspace() or len(h) >= 4 and min(h) < CODE):
                    h.sort()
                    ids.append(i)
                    src.append(zlib.crc32(o.encode()) if o is not None else 0)
                    lists.append(h)
            if len(known) > 400_000:
                known.clear()
            if len(seen) > 300_000:
                seen.clear()
            if not ids:
                return None
            size = np.array([len(h) for h in lists])
            starts = np.concatenate(([0], np.cumsum(size)[:-1]))
            flat = np.array([x for h in lists for x in h], np.int64)
            code = flat < CODE
            codes = np.add.reduceat(code.astype(np.int64), starts)
            words = (flat & 0xFFFFFFFF).astype(np.uint32)
            own = words.astype(np.uint64) | np.repeat(np.array(src, np.uint64), size) << np.uint64(32)
            bags = ((np.bitwise_xor.reduceat(_mix(own, 5), starts) ^ size.astype(np.uint64)) >> np.uint64(1)).astype(np.int64)
            first = np.fromiter((seen.setdefault(b, i) for b, i in zip(bags.tolist(), ids, strict=True)), np.int64, len(ids))
            new = first == np.array(ids)
            low = [np.minimum.reduceat(_mix(own, seed), starts) for seed in (21, 22)]
            route = _mix(own, 11)
            sketch = sketches(own, np.where(code, 3, 1).astype(np.int8), starts).view(np.int64)
            taken = np.where(codes > 0, prefix(codes, SAME_CODES), prefix(size, SAME_WORDS)) * new
            place = np.arange(len(flat)) - np.repeat(starts, size)
            kept = np.repeat(new, size)
            return pa.record_batch([
                pa.array(ids, _LONG), pa.array(np.array(src, np.uint32).view(np.int32)), pa.array(bags), pa.array(_halves(low[0], low[1]).view(np.int64)), pa.array(sketch[:, 0]), pa.array(sketch[:, 1]),
                pa.array(codes.astype(np.int32)), _blobs(words[kept], size * new), _lists(route.view(np.int64)[place < np.repeat(taken, size)], taken, _LONG), pa.array(first, _LONG, mask=new),
            ], schema=schema)

        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                if (out := some(whole.slice(at, 500))) is not None:
                    yield out

    return rows.select("id", "source", "title", "summary").where("title is not null or summary is not null").mapInArrow(run, FILED)


class Graph:
    """Navigable small-world graph over the sketches of one segment in one shard."""

    def __init__(self, keys: list[np.ndarray], sketch: np.ndarray, orders: list[np.ndarray] | None = None):
        """``keys``: what the nodes are sorted by besides the sketch; ``orders``: the sort orders where they are known already."""
        self.sketch, self.n = sketch, len(sketch)
        self.keys = [*keys, sketch[:, 0], sketch[:, 1]]
        self.orders = orders or [np.argsort(k, kind="stable").astype(np.int32) for k in self.keys]
        self.sorted = [k[o] for k, o in zip(self.keys, self.orders, strict=True)]
        self.beam: int | None = None
        self._links: np.ndarray | None = None

    @property
    def links(self) -> np.ndarray:
        """The neighbours of each node: two on either side in each order and in a random one."""
        if self._links is None:
            out = []
            for o in [*self.orders, np.random.default_rng(self.n).permutation(self.n)]:
                place = np.empty(self.n, np.int64)
                place[o] = np.arange(self.n)
                out += [o[np.clip(place + step, 0, self.n - 1)] for step in (-2, -1, 1, 2)]
            self._links = np.stack(out, axis=1).astype(np.int64)
        return self._links

    def enter(self, keys: list[np.ndarray]) -> np.ndarray:
        """Where the queries would stand in each order: the nodes around it."""
        out = []
        for k, s, o in zip(keys, self.sorted, self.orders, strict=True):
            at = np.searchsorted(s, k)
            out += [o[np.clip(at + step, 0, self.n - 1)] for step in (-2, -1, 0, 1)]
        return np.stack(out, axis=1).astype(np.int64)

    def ranked(self, sketch: np.ndarray, ids: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, distances) of the nearest ``beam`` of each query's nodes, each node once."""
        x, y = self.sketch[:, 0][ids] ^ sketch[:, :1], self.sketch[:, 1][ids] ^ sketch[:, 1:]
        both = (np.bitwise_count(x).astype(np.int64) + np.bitwise_count(y)) << 32 | ids
        both.sort(axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = 999 << 32
        both.partition(min(beam, both.shape[1]) - 1, axis=1)
        both = both[:, :beam]
        return both & 0xFFFFFFFF, both >> 32

    def reach(self, keys: list[np.ndarray], beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, distances) of the best ``beam`` nodes that each query reaches, for all queries at once; ``keys`` end with the sketch."""
        sketch = np.stack(keys[-2:], axis=1)
        top, dist = self.ranked(sketch, self.enter(keys), beam)
        for _ in range(HOPS):
            top, dist = self.ranked(sketch, np.concatenate([top, self.links[top].reshape(len(top), -1)], axis=1), beam)
        return top, dist

    def every(self, sketch: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, node) of all pairs within ``bits``, exhaustively and in blocks of bounded size."""
        a, b = np.ascontiguousarray(self.sketch[:, 0]), np.ascontiguousarray(self.sketch[:, 1])
        step = max(1, (1 << 18) // max(1, self.n))
        for at in range(0, len(sketch), step):
            q = sketch[at : at + step]
            hit = np.flatnonzero(np.bitwise_count(a ^ q[:, :1]) + np.bitwise_count(b ^ q[:, 1:]) <= bits)
            x, y = np.divmod(hit, self.n)
            yield x + at, y

    def near(self, keys: list[np.ndarray], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, node) of the pairs within ``bits`` that the tuned search reaches, in blocks."""
        if not self.beam:
            yield from self.every(np.stack(keys[-2:], axis=1), bits)
            return
        for at in range(0, len(keys[0]), 2048):
            found, dist = self.reach([k[at : at + 2048] for k in keys], self.beam)
            x, y = np.nonzero(dist <= bits)
            yield x + at, found[x, y]

    def tune(self, keys: list[np.ndarray], accept: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> float:
        """Widens the beam until the probes find ``RECALL`` of what exhaustive search finds, and returns the recall; a beam of 0 is exhaustive search.

        Probes are queries for which exhaustive search brings a node that ``accept`` (the exact rerank of pairs of queries and nodes, of other texts only) takes.
        """
        self.beam = 0 if self.n <= EXHAUSTIVE else WIDEST
        if self.n <= EXACT:
            return 1.0
        sketch = np.stack(keys[-2:], axis=1)
        order = np.random.default_rng(len(sketch)).permutation(len(sketch))
        xs, ys, probes = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
        for at in range(0, len(order), 256):
            q, before = order[at : at + 256], len(xs)
            for x, y in self.every(sketch[q], NEAR_BITS):
                ok = accept(q[x], y)
                xs.append(q[x[ok]])
                ys.append(y[ok])
            probes += len(np.unique(np.concatenate(xs[before:])))
            if probes >= PROBES:
                break
        if probes < PROBES:
            return 1.0
        pick, x = np.unique(np.concatenate(xs), return_inverse=True)
        y = np.concatenate(ys)
        wanted = np.bincount(x, minlength=len(pick))
        recall, beam = 0.0, BEAM
        while beam <= WIDEST:
            top, _ = self.reach([k[pick] for k in keys], beam)
            hit = (top[x] == y[:, None]).any(axis=1)
            # A query with more near texts than the beam holds needs only as many: the rest hang together.
            recall = float(np.minimum(np.bincount(x, hit, len(pick)), beam).sum() / np.minimum(wanted, beam).sum())
            if recall >= RECALL:
                self.beam = beam
                break
            beam *= 2
        return recall


class Texts:
    """Columns of texts as arrays."""

    def __init__(self, table: pa.Table):
        get = lambda c: table.column(c).combine_chunks().to_numpy(zero_copy_only=False)
        self.id, self.src, self.bag, self.codes = get("id"), get("src"), get("bag"), get("codes").astype(np.int64)
        self.s0, self.s1 = get("s0").view(np.uint64), get("s1").view(np.uint64)
        self.key = _halves(get("way").view(np.uint64), get("k1").view(np.uint64))  # texts of one way stand together, near ones mostly side by side
        self.flat, self.size = _unblobbed(table.column("words"))
        self.start = np.cumsum(self.size) - self.size

    def __len__(self) -> int:
        return len(self.id)

    def order(self) -> np.ndarray:
        return np.argsort(self.key, kind="stable").astype(np.int32)

    def tokens(self, rows: np.ndarray, codes: bool) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, how many each) of ``rows`` one after another: the codes alone, or all."""
        size = self.codes[rows] if codes else self.size[rows]
        ends = np.cumsum(size)
        at = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size, size) + np.repeat(self.start[rows], size)
        return self.flat[at], size


def same_text(a: Texts, x: np.ndarray, b: Texts, y: np.ndarray) -> np.ndarray:
    """Exact rerank of pairs of rows: of one source, most codes and most words in common."""
    ok = (a.src[x] == b.src[y]) & (np.minimum(a.size[x], b.size[y]) >= SAME_WORDS * np.maximum(a.size[x], b.size[y])) & (np.minimum(a.codes[x], b.codes[y]) >= SAME_CODES * np.maximum(a.codes[x], b.codes[y]))
    for codes, share in ((True, SAME_CODES), (False, SAME_WORDS)):
        at = np.flatnonzero(ok)
        (u, n), (v, m) = a.tokens(x[at], codes), b.tokens(y[at], codes)
        pair = np.arange(len(at), dtype=np.uint64)
        both = np.concatenate([np.repeat(pair, n) << np.uint64(32) | u, np.repeat(pair, m) << np.uint64(32) | v])
        both.sort()
        common = np.bincount((both[1:][both[1:] == both[:-1]] >> np.uint64(32)).astype(np.int64), minlength=len(at))
        ok[at] = common >= share * (n + m - common)
    return ok


def met(a: Texts, rows: np.ndarray, b: Texts, order: np.ndarray, after: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of ``a``, row of ``b``) of all pairs of one way whose sketches are within ``NEAR_BITS``, in blocks; ``after``: only what stands behind these places of ``order``."""
    way, ask = b.key[order] >> np.uint64(32), a.key[rows] >> np.uint64(32)
    first = np.searchsorted(way, ask) if after is None else after + 1
    many = np.searchsorted(way, ask, "right") - first
    ends, at = np.cumsum(many), 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        n = many[at:to]
        x = np.repeat(rows[at:to], n)
        y = order[np.arange(len(x)) - np.repeat(np.cumsum(n) - n - first[at:to], n)]
        near = np.bitwise_count(a.s0[x] ^ b.s0[y]) + np.bitwise_count(a.s1[x] ^ b.s1[y]) <= NEAR_BITS
        yield x[near], y[near]
        at = to


class Sets:
    """What is linked already: union of numbers that are met on the way."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def top(self, i: int) -> int:
        path = []
        while (j := self.up.get(i, i)) != i:
            path.append(i)
            i = j
        for p in path:
            self.up[p] = i
        return i

    def tops(self, ids: np.ndarray) -> np.ndarray:
        if not self.up:
            return ids
        some, back = np.unique(ids, return_inverse=True)
        return np.array([self.top(i) for i in some.tolist()], np.int64)[back] if len(some) else ids

    def join(self, i: int, j: int) -> bool:
        i, j = self.top(i), self.top(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
        return i != j


def _load(folder: str, shard: int) -> pa.Table | None:
    """The nodes of a segment in a shard, in the order of the graph; None if it has none there."""
    source, path = pafs.FileSystem.from_uri(f"{folder}/shard={shard}")
    files = [f.path for f in source.get_file_info(pafs.FileSelector(path, allow_not_found=True)) if f.path.endswith(".parquet")]
    columns = [c for c in (x.split()[0] for x in NODE.split(", ")) if c not in ("shard", "hits")]
    parts = [pq.ParquetFile(source.open_input_file(f)).read(columns) for f in files]
    if not parts:
        return None
    table = pa.concat_tables(parts)
    node = table.column("node").to_numpy()
    if (node < 0).any() or (np.diff(node) < 0).any():
        order = np.argsort(node, kind="stable")
        table = table.take(pa.array(order[node[order] >= 0]))
    return table if table.num_rows else None


def searcher(segments: list[str], build: bool):
    """Searches one shard's part of a batch in the stored graphs and, to ``build``, in its own, which comes out as nodes with what they are linked to (``hits``).

    Texts that are there already, word for word, only name the row that has them (``node`` -1).
    """
    schema = _schema(NODE)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        table = table.sort_by([("id", "ascending"), ("sub", "ascending")])
        batch, linked = Texts(table), Sets()
        hits: list[tuple[int, int]] = []
        fresh = np.ones(len(batch), bool)

        def twins(bags: np.ndarray, ids: np.ndarray) -> None:
            order = np.argsort(bags, kind="stable")
            at = np.searchsorted(bags[order], batch.bag)
            at = np.minimum(at, len(order) - 1)
            same = (bags[order][at] == batch.bag) & (ids[order][at] != batch.id)
            for i in np.flatnonzero(same & fresh).tolist():
                if linked.join(int(batch.id[i]), int(ids[order][at][i])):
                    hits.append((i, int(ids[order][at][i])))
            fresh[same] = False

        def verify(x: np.ndarray, other: Texts, y: np.ndarray) -> None:
            for at in range(0, len(x), 4096):
                i, j = x[at : at + 4096], y[at : at + 4096]
                open_ = linked.tops(batch.id[i]) != linked.tops(other.id[j])
                i, j = i[open_], j[open_]
                if len(i):
                    ok = same_text(batch, i, other, j)
                    for k, m in zip(i[ok].tolist(), other.id[j[ok]].tolist(), strict=True):
                        if linked.join(int(batch.id[k]), m):
                            hits.append((k, m))

        stored = [(t, t.column("o0").combine_chunks().to_numpy()) for f in segments if (t := _load(f, shard)) is not None]
        stored = [(Texts(t), order) for t, order in stored]
        for other, _ in stored:
            twins(other.bag, other.id)
        twins(batch.bag, batch.id)  # copies from other tasks
        rows = np.flatnonzero(fresh)
        for other, order in stored:
            for x, y in met(batch, rows, other, order):
                verify(x, other, y)
        new = Texts(table.take(pa.array(rows)))
        own = new.order()
        if len(rows):
            verify(rows[own[:-1]], batch, rows[own[1:]])  # neighbours are compared first, so clusters hang together and need no further check
            for x, y in met(new, own, new, own, np.arange(len(own))):
                verify(rows[x], batch, rows[y])
        found: dict[int, list[int]] = {}
        for i, other in hits:
            found.setdefault(i, []).append(other)
        lists = [found.get(i, []) for i in range(len(batch))]
        node = np.full(len(batch), -1, np.int32)
        node[rows] = np.arange(len(rows))
        order = np.full(len(batch), -1, np.int32)
        order[rows] = own
        keep = np.flatnonzero(fresh | (np.array([len(x) for x in lists]) > 0)) if build else np.array([i for i, x in enumerate(lists) if x], np.int64)
        bare = not build
        out = {
            "shard": pa.array(np.full(len(batch), shard, np.int64)), "node": pa.array(np.full(len(batch), -1, np.int32) if bare else node), **{c: table.column(c) for c in ("sub", "pos", "route", "way", *(x.split()[0] for x in TEXT.split(", ")))},
            "o0": pa.array(order), "hits": pa.array(lists, pa.list_(_LONG)),
        }
        return pa.table([out[f.name] for f in schema], schema=schema).take(pa.array(keep))

    return run


def rebuilt(key: tuple, table: pa.Table) -> pa.Table:
    """The graph over the nodes of two segments in one shard."""
    table = table.sort_by([("id", "ascending"), ("sub", "ascending"), ("route", "ascending")])
    texts = Texts(table)
    n = len(texts)
    out = {"shard": pa.array([key[0].as_py()] * n, _LONG), "node": pa.array(np.arange(n, dtype=np.int32)), "o0": pa.array(texts.order()), "hits": pa.nulls(n, pa.list_(_LONG))}
    schema = _schema(NODE)
    return pa.table([out[f.name] if f.name in out else table.column(f.name) for f in schema], schema=schema)


class Index:
    """The history index in a folder; ``path`` None makes one in the shared checkpoint folder."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        home = jvm.org.apache.hadoop.fs.Path(path or f"{checkpoint_dir(spark)}/history-{uuid.uuid4().hex}")
        self.fs = home.getFileSystem(conf)
        self.path = re.sub(r"^file:/+", "file:///", self.fs.makeQualified(home).toString())
        self.made: dict = {"next": 0, "segments": [], "versions": [], "texts": 0}
        if self.fs.exists(self._at("manifest.json")):
            self.made = json.loads(spark.read.text(f"{self.path}/manifest.json", wholetext=True).first()[0])

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _save(self) -> None:
        """The manifest is written last: a batch that failed halfway is accepted anew, over its own files."""
        out = self.fs.create(self._at("manifest.json"), True)
        out.write(bytearray(json.dumps(self.made).encode()))
        out.close()

    def drop(self) -> None:
        self.fs.delete(self._at(""), True)

    def _read(self, kind: str, schema: str) -> DataFrame:
        names = [f"{self.path}/{kind}/{n}" for n in range(self.made["next"])]
        return self.spark.read.schema(schema).parquet(*names) if names else self.spark.createDataFrame([], schema)

    def _version(self, texts: DataFrame, n: int) -> None:
        """A new version of the routing if the texts have outgrown the shards or routes have become hot."""
        now = self.made["versions"][-1] if self.made["versions"] else {"shards": 1, "hot": None}
        # Twice the shards that are needed now, and no more until the texts have outgrown those.
        shards = 1 << max(0, math.ceil(math.log2(max(1, 2 * (self.made["texts"] + n) / SHARD))) + (not self.made["versions"]))
        many = texts.select(F.explode("routes").alias("route")).groupBy("route").count().where(F.col("count") > SPLIT).select("route")
        if now["hot"]:
            many = many.unionByName(self.spark.read.parquet(now["hot"])).distinct()
        folder = f"{self.path}/hot/{len(self.made['versions'])}"
        many.coalesce(1).write.mode("overwrite").parquet(folder)
        hot, before = self.spark.read.parquet(folder).count(), now.get("n_hot", 0)
        if not self.made["versions"] or shards > now["shards"] or hot > before:
            self.made["versions"].append({"shards": max(shards, now["shards"]), "hot": folder if hot else None, "n_hot": hot})

    def _routed(self, texts: DataFrame, version: int, rows: int) -> DataFrame:
        """A row per shard that each text is filed in; texts come with ``routes``, nodes with one ``route``."""
        v = self.made["versions"][version]
        one = texts.select("*", F.posexplode("routes").alias("pos", "route")).drop("routes") if "routes" in texts.columns else texts
        one = one.withColumn("way", F.col("route")).withColumn("sub", F.lit(0))
        if v["hot"]:
            hot = self.spark.read.parquet(v["hot"]).withColumn("split", F.lit(True))
            # Hot routes are at most one in SPLIT texts; their list is broadcast only if its size allows.
            one = one.join(F.broadcast(hot) if small(hot) else hot, "route", "left")
            # Two texts of the route have the token it is from in common, and of n words at least ceil(0.75 n): so without that token one of the first n - ceil(0.75 n) + 1.
            n = F.floor(F.octet_length("words") / 4).cast("int")
            spare = (n - F.ceil(n * SAME_WORDS - 1e-9) + 1).cast("int")
            others = F.slice(F.filter(F.sequence(F.lit(0), F.least(spare, n - 1)), lambda i: i != F.col("pos")), 1, spare)
            ways = F.transform(others, lambda i, k: F.struct(k.alias("sub"), F.xxhash64("route", F.substring("words", 4 * i + 1, F.lit(4))).alias("way")))
            plain = F.array(F.struct(F.lit(0).alias("sub"), F.col("route").alias("way")))
            one = one.drop("way", "sub").withColumn("w", F.explode(F.when(F.col("split") & (n > 1), ways).otherwise(plain))).select("*", "w.sub", "w.way").drop("w", "split")
        tasks = max(width(self.spark), math.ceil(rows * 2.2 / SHARD))
        return one.withColumn("shard", F.pmod("way", F.lit(v["shards"]))).repartition(tasks, "shard")

    def accept(self, rows: DataFrame) -> None:
        """Takes a batch in: ``rows`` as ``with_ids`` gives them. Earlier batches' rows are not read; of the index, the keys and the shards that the batch leads to."""
        number = self.made["next"]
        staged, named = f"{self.path}/staged", f"{self.path}/named"
        keyed(rows).write.mode("overwrite").parquet(named)
        keys = self.spark.read.schema("id long, k long").parquet(named)
        keys.groupBy("k").agg(F.min("id").alias("first")).write.mode("overwrite").parquet(f"{self.path}/keys/{number}")
        known = self.spark.read.schema("k long, first long")
        mine = known.parquet(f"{self.path}/keys/{number}")
        # Of the history only what the batch's keys name; then each row of the batch is linked to the first row of its key.
        everything = known.parquet(*[f"{self.path}/keys/{n}" for n in range(number + 1)])
        earlier = everything.join(mine.select("k"), "k", "left_semi").groupBy("k").agg(F.min("first").alias("first")) if number else mine
        by_key = keys.join(earlier, "k").where(F.col("id") != F.col("first")).select(F.col("first").alias("a"), F.col("id").alias("b"))

        filed(rows).write.mode("overwrite").parquet(staged)
        new = self.spark.read.schema(FILED).parquet(staged)
        texts = new.where("twin is null").drop("twin")
        n = texts.count()
        self._version(texts, n)
        current = len(self.made["versions"]) - 1
        name = f"{self.path}/segments/{number}"
        for version in sorted({s["version"] for s in self.made["segments"]} | {current}, reverse=True):
            folders = [s["folder"] for s in self.made["segments"] if s["version"] == version]
            found = self._routed(texts, version, n).groupBy("shard").applyInArrow(searcher(folders, version == current), NODE)
            found.write.mode("overwrite" if version == current else "append").partitionBy("shard").parquet(name)
        nodes = self.spark.read.schema(NODE).parquet(name)
        twins = new.where("twin is not null").select(F.col("twin").alias("a"), F.col("id").alias("b"))
        by_text = nodes.where("size(hits) > 0").select(F.explode("hits").alias("a"), F.col("id").alias("b"))
        by_key.unionByName(twins).unionByName(by_text).write.mode("overwrite").parquet(f"{self.path}/links/{number}")
        self.made["segments"].append({"folder": name, "version": current, "nodes": n})
        self.made["texts"] += n
        self.made["next"] += 1
        done = self._compact(current) if len(self.made["segments"]) > MAX_SEGMENTS else []
        self._save()
        for folder in [staged, named, *done]:
            self.fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(folder), True)

    def _compact(self, version: int) -> list[str]:
        """Merges the two smallest segments into one of the current version; returns the folders that are done with."""
        old = sorted(self.made["segments"], key=lambda s: s["nodes"])[:2]
        one, two = (self.spark.read.schema(NODE).parquet(s["folder"]).where("node >= 0 and sub = 0").select("route", "pos", *(x.split()[0] for x in TEXT.split(", "))) for s in old)
        kept = one.unionByName(two)
        n = sum(s["nodes"] for s in old)
        name = f"{self.path}/segments/{self.made['next']}-compacted"
        self._routed(kept, version, n).groupBy("shard").applyInArrow(rebuilt, NODE).write.mode("overwrite").partitionBy("shard").parquet(name)
        self.made["segments"] = [s for s in self.made["segments"] if s not in old] + [{"folder": name, "version": version, "nodes": n}]
        return [s["folder"] for s in old]

    def links(self) -> DataFrame:
        """``(a, b)``: all that was linked so far."""
        return self._read("links", "a long, b long")


def replayed(signals: DataFrame, path: str | None = None) -> Index:
    """An index that has accepted the batches of ``signals`` one after another: rows without a batch number first, as history."""
    index = Index(signals.sparkSession, path)
    # Batch numbers are as many as deliveries.
    numbers = sorted(r[0] for r in signals.select(F.coalesce("batch_no", F.lit(0)).alias("b")).distinct().collect())
    for b in numbers:
        of = F.col("batch_no") == b
        index.accept(with_ids(signals.where(of | F.col("batch_no").isNull() if b == 0 else of)))
    return index


def items(signals: DataFrame) -> DataFrame:
    """``(id, group)``: rows linked to at least one other row with the first row of their item, both as ids."""
    index = replayed(signals)
    done = cut(components(index.links()))
    index.drop()
    return done


def found(signals: DataFrame) -> DataFrame:
    """``(first_row_id, row_id)`` of each row of a later batch that isn't the first of its item.

    Null guids, signal_ids and sources give no key, blank texts no text link; rows repeated exactly link to the first. ``row_id`` must be
    unique and below 2^48.
    """
    low = (1 << SHIFT) - 1
    later = items(signals).where((F.col("id") != F.col("group")) & (F.shiftright("id", SHIFT) >= 1))
    return later.select(F.col("group").bitwiseAND(low).alias("first_row_id"), F.col("id").bitwiseAND(low).alias("row_id"))


def recall(signals: DataFrame, every: int = 50) -> DataFrame:
    """``(queries, wanted, found, recall)``: of all texts that the rerank would accept for the rows whose row_id is divisible by ``every``, how many are in the same item.

    The exhaustive side compares, within a source, each query with every row that has a code (without codes: a word) in common with it; a pair
    without one can't be accepted.
    """
    rows = with_ids(signals)
    sets = cut(rows.select("id", "source", "title", "summary").where("title is not null or summary is not null").mapInArrow(_sets, "id long, src int, codes array<int>, words array<int>"))
    keyed_ = sets.select("id", "src", F.explode(F.when(F.size("codes") > 0, F.col("codes")).otherwise(F.col("words"))).alias("t"), (F.size("codes") > 0).alias("coded"))
    low = F.lit((1 << SHIFT) - 1)
    ask = keyed_.where(F.col("id").bitwiseAND(low) % every == 0).withColumnRenamed("id", "q")
    met = ask.join(keyed_, ["src", "t", "coded"]).where("q <> id").groupBy("q", "id").agg(F.count("*").alias("common"))
    a, b = sets.select(F.col("id").alias("q"), F.col("codes").alias("c1"), F.col("words").alias("w1")), sets.select("id", F.col("codes").alias("c2"), F.col("words").alias("w2"))

    def share(x: str, y: str) -> Column:
        common = F.size(F.array_intersect(x, y))
        return common / (F.size(x) + F.size(y) - common)

    # A shared token is not enough: the number in common rules most pairs out before the sets are joined.
    pairs = met.join(a, "q").where(F.when(F.size("c1") > 0, F.col("common") >= SAME_CODES * F.size("c1")).otherwise(F.col("common") >= SAME_WORDS * F.size("w1"))).join(b, "id")
    wanted = pairs.where((share("w1", "w2") >= SAME_WORDS) & ((F.size("c1") == 0) | (share("c1", "c2") >= SAME_CODES))).select("q", "id")
    item = items(signals)
    left, right = item.select(F.col("id").alias("q"), F.col("group").alias("g1")), item.select("id", F.col("group").alias("g2"))
    judged = wanted.join(left, "q", "left").join(right, "id", "left").agg(F.countDistinct("q").alias("queries"), F.count("*").alias("wanted"), F.sum(F.when(F.col("g1") == F.col("g2"), 1).otherwise(0)).alias("found"))
    return judged.select("queries", "wanted", F.coalesce("found", F.lit(0)).alias("found"), F.round(F.col("found") / F.col("wanted"), 6).alias("recall"))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("id", _LONG), ("src", _INT), ("codes", pa.list_(_INT)), ("words", pa.list_(_INT))])
    for batch in batches:
        out = []
        for i, o, t, s in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
            ws = tokens(t, s)
            cs = {w for w in ws if is_code(w)}
            if ws and (s and not s.isspace() or len(ws) >= 4 and cs):
                signed = lambda w: zlib.crc32(w.encode()) - ((zlib.crc32(w.encode()) >> 31) << 32)
                out.append((i, signed(o) if o is not None else 0, sorted(map(signed, cs)), sorted(map(signed, ws))))
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(list(zip(*out, strict=True)) or [[]] * 4, schema, strict=True)], schema=schema)
