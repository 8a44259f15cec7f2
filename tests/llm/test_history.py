import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigilake.llm import history as H

SIGNALS = "row_id long, batch_no int, source string, guid string, signal_id string, title string, summary string"
WORDS = "the pump monitor gateway device firmware update network access remote user may change settings when port is open and log shows unit version before release check".split()


def text(rng):
    return " ".join(rng.choice(WORDS) for _ in range(30)) + f" unit {rng.randint(100, 99999)} port {rng.randint(1000, 65000)} lot {rng.randint(10000, 99999)} id {rng.randint(100000, 999999)}"


@pytest.mark.parametrize(("a", "b"), [
    ("https://feeds.x.example/2024/fix-1", "http://www.FEEDS.x.example:443//2024/fix%2D1/?utm_source=a#top"), ("https://x.example/v?id=1&lang=en", "https://x.example/v?lang=en&amp;id=1"), ("https://x.example/a", " https://x.example/a/index.html\n"),
    ("AGRA-22-0000-015", "urn:advisory:agra_22 0000‑015"), ("0c6e6048-f5d7-42a9-a7d3-1761be7f8ac5", "{0C6E6048F5D742A9A7D31761BE7F8AC5}"), ("113491", "113,491"), ("104924", "#104924"), ("104924", "000104924.0"),
])
def test_guids_apart_from_spelling(spark, a, b):
    keys = [r.k for r in spark.createDataFrame([(a,), (b,)], "g string").select(H.guid_key(F.col("g")).alias("k")).collect()]
    assert keys[0] == keys[1] is not None


@pytest.mark.parametrize(("a", "b"), [("https://x.example/a-1", "https://x.example/a-2"), ("https://x.example/v?id=1", "https://x.example/v?id=2"), ("A-1", "A-2"), ("https://x.example/a", "https://y.example/a"), (None, ""), (" ", "n/a")])
def test_other_guids(spark, a, b):
    keys = [r.k for r in spark.createDataFrame([(a,), (b,)], "g string").select(H.guid_key(F.col("g")).alias("k")).collect()]
    assert keys[0] != keys[1] or keys[0] is None


def pairs(spark, rows, **more):
    """Links of rows by text alone, as pairs of row_ids."""
    index = H.replayed(spark.createDataFrame(rows, SIGNALS), **more)
    low = (1 << H.SHIFT) - 1
    got = {tuple(sorted((r.a & low, r.b & low))) for r in index.links().collect()}
    index.drop()
    return got


def test_keys_texts_and_chains(spark):
    rng = random.Random(2)
    t = [text(rng) for _ in range(6)]
    edited = t[2].replace("pump", "PUMP") + " [v2]"
    rows = [
        (1, 0, "s", "G-1", "A" * 64, "one", t[0]), (2, 1, "s", "g_1 ", None, "other", t[1]), (3, 1, "z", "G-1", None, "third", t[2]), (4, 2, "z", "new", None, "third", f"<p>{edited}</p>"), (5, 3, "z", "new", None, "fourth", t[3]),
        (6, 3, "q", None, "sha256:" + "a" * 64, None, None), (7, 3, None, None, None, None, None), (8, 3, "q", "", " ", "", " "), (9, 4, "w", None, None, "Weekly summary", None), (10, 4, "v", None, None, "Weekly summary", None), (11, None, "u", "k", None, "t", t[4]), (12, 1, "u", "k", None, "t", t[5]),
        (13, 4, "catalogue", None, None, "third", t[2]),
    ]
    got = {tuple(r) for r in H.found(spark.createDataFrame(rows, SIGNALS).selectExpr("*", "1 as id", "2 as k", "3 as shard")).collect()}
    assert got == {(1, 2), (1, 6), (3, 4), (3, 5), (11, 12)}  # 13: the entry of another catalogue is another item
    assert H.found(spark.createDataFrame([], SIGNALS)).count() == 0


@pytest.mark.parametrize("split", [4_000, 30])
def test_recall_against_exhaustive_search(spark, monkeypatch, split):
    monkeypatch.setattr(H, "SPLIT", split)
    rng = random.Random(3)
    rows, wanted = [], set()
    for i in range(400):
        base = text(rng).split() + ["CVE-2024-777777"] * (i % 3 == 0)
        rows.append((2 * i, rng.choice([0, 0, 1, 2]), "s", f"a{i}x", None, None, " ".join(base)))
        if i % 2:
            other = base.copy()
            other[rng.randrange(20)] = "edited"
            if i % 4 == 1:  # one code changed as well
                other[other.index("lot") + 1] = str(rng.randint(10**6, 10**7))
            rng.shuffle(other)
            rows.append((2 * i + 1, rng.choice([1, 2, 3]), "s", f"b{i}x", None, None, " ".join(other)))
    words = {r[0]: H.tokens(None, r[6]) for r in rows}
    codes = {k: {w for w in v if H.is_code(w)} for k, v in words.items()}
    ids = sorted(words)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if len(words[a] & words[b]) >= H.SAME_WORDS * len(words[a] | words[b]) and len(codes[a] & codes[b]) >= H.SAME_CODES * len(codes[a] | codes[b]):
                wanted.add((a, b))
    got = pairs(spark, rows)
    assert len(wanted) > 150 and len(got & wanted) >= 0.97 * len(wanted) and got <= wanted
    if split < 4_000:
        return
    row = H.recall(spark.createDataFrame(rows, SIGNALS), 2).first()
    assert row.wanted == 2 * sum(a % 2 == b % 2 == 0 for a, b in wanted) + sum(a % 2 != b % 2 for a, b in wanted) and row.recall >= 0.97


def test_recall_of_no_rows(spark):
    assert tuple(H.recall(spark.createDataFrame([], SIGNALS)).first()) == (0, 0, 0, None)


def test_index_lasts(spark, tmp_path):
    """A second session of work reads the folder: what came before isn't filed again, and compaction changes nothing."""
    rng = random.Random(11)
    base = [text(rng) for _ in range(60)]
    rows = [(i, 0, "s", f"g{i}x", None, None, t) for i, t in enumerate(base)]
    rows += [(100 * b + i, b, "s", f"g{b}{i}y", None, None, base[i].replace("pump", "device") + " [v2]") for b in range(1, 7) for i in range(10 * b - 10, 10 * b)]
    frame = spark.createDataFrame(rows, SIGNALS)
    folder = str(tmp_path / "index")
    for b in range(7):
        H.Index(spark, folder).accept(H.with_ids(frame.where(F.col("batch_no") == b)))
    index = H.Index(spark, folder)
    assert len(index.made["segments"]) == H.MAX_SEGMENTS and index.made["texts"] == 120
    low = (1 << H.SHIFT) - 1
    assert {(r.a & low, r.b & low) for r in index.links().collect()} == {(i, 100 * b + i) for b in range(1, 7) for i in range(10 * b - 10, 10 * b)}


def test_prefixes_meet():
    rng = random.Random(5)
    for _ in range(2000):
        a = set(rng.sample(range(14), rng.randint(1, 9)))
        b = set(rng.sample(sorted(a), max(1, len(a) - 2))) | set(rng.sample(range(14), 2))
        if len(a & b) >= H.SAME_CODES * len(a | b):
            first = [set(sorted(x)[: int(H.prefix(np.array([len(x)]), H.SAME_CODES)[0])]) for x in (a, b)]
            assert first[0] & first[1]


def graph(rng, n, groups=50):
    sketch = rng.integers(0, 2**63, (n, 2), dtype=np.int64).view(np.uint64)
    keys = [rng.integers(0, groups, n).astype(np.uint64) for _ in range(4)]
    return H.Graph(keys, sketch), keys


def test_graph_finds_near_sketches():
    rng = np.random.default_rng(4)
    segment, keys = graph(rng, 3000)
    near = segment.sketch[:300] ^ (np.uint64(1) << rng.integers(0, 64, (300, 2)).astype(np.uint64))
    queries = [*(k[:300] for k in keys), near[:, 0], near[:, 1]]
    assert segment.tune(queries, lambda x, y: x == y) >= H.RECALL and segment.beam
    hit = {(x, y) for i, j in segment.near(queries, H.NEAR_BITS) for x, y in zip(i.tolist(), j.tolist(), strict=True)}
    assert sum((i, i) in hit for i in range(300)) >= 0.97 * 300


def test_probes_are_not_their_own_neighbours(monkeypatch):
    segment, keys = graph(np.random.default_rng(8), 600)
    queries = [*keys, segment.sketch[:, 0], segment.sketch[:, 1]]
    segment.tune(queries, lambda x, y: x != y)
    assert segment.beam == 0  # no row has another near it: nothing is known of a beam
    monkeypatch.setattr(H, "EXHAUSTIVE", 500)
    segment.tune(queries, lambda x, y: x != y)
    assert segment.beam == H.WIDEST
    assert segment.links.shape[1] == 4 * 7 and segment.enter(queries).shape[1] == 4 * 6


def test_recall_on_one_hot_code(spark):
    rng = random.Random(7)
    vocabulary = [f"w{a}{b}{c}" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyz"]
    texts = [["lot", "777777", *rng.sample(vocabulary, 60)] for _ in range(10_000)]
    rows = [(i, 0, "s", f"g{i}x", None, None, " ".join(w)) for i, w in enumerate(texts)]
    for i in range(300):
        other = texts[i].copy()
        other[2 + rng.randrange(60)], other[2 + rng.randrange(60)] = "edited", "again"
        rng.shuffle(other)
        rows.append((10_000 + i, i % 2, "s", f"h{i}x", None, None, " ".join(other)))
    got = pairs(spark, rows)
    for batch in (0, 1):
        assert len(got & {(i, 10_000 + i) for i in range(batch, 300, 2)}) >= H.RECALL * 150


def test_hot_code_is_split_and_still_hangs_together(spark, monkeypatch):
    monkeypatch.setattr(H, "SPLIT", 20)
    monkeypatch.setattr(H, "SHARD", 40)
    rng = random.Random(5)
    base = text(rng).split()
    rows = [(i, i % 3, "s", f"g{i}x", None, None, " ".join([*base, rng.choice("abcdefgh") * 3, rng.choice("stuvwxyz") * 4])) for i in range(120)]
    got = H.items(spark.createDataFrame(rows, SIGNALS)).collect()
    assert len({r.id for r in got}) == 120 and len({r.group for r in got}) == 1


def test_links_do_not_depend_on_the_size_of_routes(spark, monkeypatch):
    """All pairs that the rerank accepts are linked, whether their route is split or not."""
    rng = random.Random(9)
    vocabulary = [f"w{a}{b}{c}" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyz"]
    rows = []
    for i in range(300):
        words = rng.sample(vocabulary, 13)
        other = [*words[:-2], f"x{i}y"[:3].replace("0", "q").replace("1", "r")]  # 12 of the 16 words of both
        rows += [(2 * i, 0, "s", f"g{i}x", None, None, " ".join(["777777", "zz", *words])), (2 * i + 1, i % 2, "s", f"h{i}x", None, None, " ".join(["777777", "zz", *other, "z"]))]
    sets = {r[0]: H.tokens(None, r[6]) for r in rows}
    wanted = {(2 * i, 2 * i + 1) for i in range(300) if len(sets[2 * i] & sets[2 * i + 1]) >= H.SAME_WORDS * len(sets[2 * i] | sets[2 * i + 1])}
    whole = pairs(spark, rows)
    monkeypatch.setattr(H, "SPLIT", 50)
    assert len(wanted) == 300 and pairs(spark, rows) >= wanted and whole >= wanted
