from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vigilake.llm import survivors as S
from vigilake.llm import truncation as X

WHOLE = [
    "The pump stopped answering after 5 packets. Version 1.2.3 removes the log viewer.", "The pump stopped answering after 7 packets.\n\nReferences: CVE-2024-1, std-3", "Text here.\n\n- require login for operators\n- move the unit", "Recall of Acme X-1 pump (L-2)",
    "Done well.\n\n***", "Fixed now. Further information will follow...", "Fixed soon. Further information will follow...", "<p>All good.</p>", "<p>Good.</p>\n\nRev. 5, Jan 2024", "# Heading\n\nText is whole.\n\n## Contact", "対象は三台です。", "A table.\n\nX-1 | 1.2.3 | abc12345", "See this.\nhttps://x.example/ref/12",
]
CUT = [
    "The pump stopped answering after 9 packets. Version 4.5.6 removes the log vie", "The pump stopped answering af", "The pump stopped answering after 9 packets. Version 4.5.6 removes the…", "Fixed now. The pump stopped answ [more]", "Fixed now. The pump stopped Read more", "<p>Good text. The pump sto",
    "Fixed. See the <a href=\"https://x", "Fixed. See &nbs", "Fixed. See [here](https://x.ex", "The pump stopped answering after 9 packets. Version 4.5.6 remov\n\n***",
]


def test_endings(spark):
    rows = [(i, t) for i, t in enumerate(WHOLE + CUT)] + [(90, None), (91, ""), (92, " \n")]
    got = {r.doc_id for r in X.found(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as m", "2 as longer")).collect()}
    assert got == set(range(len(WHOLE), len(WHOLE) + len(CUT)))
    assert X.found(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rates(spark):
    rows = [(1, "a", WHOLE[0]), (2, "a", CUT[0]), (3, "b", WHOLE[1]), (4, "b", None), (5, None, CUT[0]), (2, "a", CUT[0])]
    got = {r.source: (r.n_docs, r.n_cut) for r in X.rates(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert got == {"a": (3, 2), "b": (1, 0), None: (1, 1)}


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_strict_prefixes_equal_brute_force(spark, parts):
    values = ["", "a", "ab", "abc", "abd", "b", "ba", "a", None, "zz", "zzz" * 50] + [f"k{i:02d}" for i in range(40)] + ["k1"]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r.v for r in X.strict_prefixes(spark.createDataFrame([(v,) for v in values], "v string"), "v").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    known = {v for v in values if v is not None}
    assert got == {v for v in known if any(w != v and w.startswith(v) for w in known)}


@pytest.mark.parametrize("parts", [1, 3, 200])
def test_rows_of_longer_values_equal_brute_force(spark, parts):
    values = ["", "n", None, "z", "zz"] + [f"n {i:03d}" for i in range(300)] + [f"n 1{i % 10}" for i in range(25)] + ["n 299 x"] * 4
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {(r.v, r.n, r.longer) for r in X.strict_prefixes(spark.createDataFrame([(v,) for v in values], "v string"), "v").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    known = [v for v in values if v is not None]
    longer = {v: sum(w != v and w.startswith(v) for w in known) for v in known}
    assert got == {(v, known.count(v), k) for v, k in longer.items() if k}


RECORDS = "record_id long, issue_id string, source string, title string, summary string, published_date string, fetched_at timestamp, cves array<string>"
SOURCES = "source_id string, tier int, feed_tz string, date_order string"


def records(spark):
    t = lambda d: datetime(2024, 1, d)
    full = "The pump stopped answering after 9 packets."
    rows = [
        (1, "i", "low", "Recall of Acme X-1 pump", full, "2024-01-01", t(1), ["CVE-1", "CVE-2"]), (2, "i", "top", "TBD", "The pump stopped answ", "0000-00-00", t(2), ["CVE-1"]), (3, "i", "top", "Recall of Acme X-1 pu", "N/A", "1900-01-01", t(3), None),
        (4, "i", "gone", "Recall of Acme X-1 pump", full, "2024-01-02", t(9), ["CVE-1"]), (5, "i", "low", "Recall of Acme X-1 pump", full, "2024-01-03", t(1), ["CVE-1"]), (6, "single", "top", "Some title", full, "2024-01-01", t(1), None),
        (7, "none", "top", None, " ", "soon", t(1), None), (8, "none", "top", "-", "null", None, None, []), (9, None, "top", "Some title", full, None, None, None), (10, "twice", "top", "Some title", full, None, None, ["CVE-3"]), (10, "twice", "top", "Some title", full, None, None, ["CVE-3"]),
    ]
    return spark.createDataFrame(rows, RECORDS).selectExpr("*", "1 as tier", "2 as field")


def registry(spark):
    return spark.createDataFrame([("top", 1, "UTC", "dmy"), ("low", 4, "UTC", "dmy")], SOURCES)


def test_winners(spark):
    got = {(r.issue_id, r.field): r.record_id for r in S.winners(records(spark), registry(spark)).collect()}
    assert got == {("i", "title"): 1, ("i", "summary"): 1, ("i", "published_date"): 1, ("twice", "title"): 10, ("twice", "summary"): 10}


def test_survivors_and_quality(spark):
    got = {r.issue_id: r for r in S.survivors(records(spark), registry(spark)).collect()}
    assert got["i"].title == "Recall of Acme X-1 pump" and got["i"].cves == ["CVE-1"] and got["i"].sources == ["gone", "low", "top"] and got["i"].titles == ["Recall of Acme X-1 pump"] and got["none"].title is None and got["single"].n_records == 1
    assert S.survivors(records(spark).limit(0), registry(spark)).count() == 0


VOTES = "issue_id string, field string, value string, source string, yes long, no long"


def test_em_separates_good_from_bad_sources(spark):
    rows = []
    for i in range(60):
        rows += [(f"i{i}", "cves", "true", s, 1, 0) for s in ("good1", "good2", "good3")] + [(f"i{i}", "cves", "true", "bad", i % 2, (i + 1) % 2)]
        rows += [(f"i{i}", "cves", "false", s, 0, 1) for s in ("good1", "good2", "good3")] + [(f"i{i}", "cves", "false", "bad", 1, 0)]
    truth, who = S.quality(spark.createDataFrame(rows, VOTES))
    assert {(r.value, r.truth > 0.5) for r in truth.collect()} == {("true", True), ("false", False)}
    by = {r.source: r for r in who.collect()}
    assert by["good1"].specificity > 0.85 > 0.3 > by["bad"].specificity and by["good1"].sensitivity > by["bad"].sensitivity
    assert S.quality(spark.createDataFrame([], VOTES))[0].where(F.lit(True)).count() == 0


def test_soundness_learns_what_the_witnesses_are_worth():
    bit = lambda *names: sum(1 << S.TESTS["title"].index(n) for n in names)
    copy, strong = "prefix of a pattern", ("prefix of a commoner pattern", "prefix of a pattern")
    counts = [("title", s, 0, 900) for s in "ab"] + [("title", s, bit(copy), 100) for s in "ab"] + [("title", "b", bit("marked", *strong), 80), ("title", "b", bit(*strong), 20), ("title", "b", bit("marked"), 5), ("title", "a", bit("garbled"), 40)]
    chance, learned = S.soundness(counts)
    assert max(chance["title", s, b] for s in "ab" for b in (0, bit(copy))) < 0.05 and chance["title", "a", bit("garbled")] < 0.05
    assert min(chance["title", "b", b] for b in (bit(*strong), bit("marked"), bit("marked", *strong))) > 0.95
    sensitivity, specificity = learned["title", "mark"]
    assert 0.7 < sensitivity < 0.9 and specificity > 0.99 and learned["title", "longer copy"][1] < 0.93
    assert S.soundness([]) == ({}, {})


def test_endings_are_read_as_far_as_marks_go():
    text = "The pump stopped and the ward"
    assert X.before(text + " " + "[more] " * 300) == (text, ("[more] " * 300).strip())
    assert X.before(text + "\n" + "***\n" * 300)[0] == text
    assert X.closed("The pump <stron") == ("The pump", True) and X.closed("The pump.") == ("The pump.", False)
    for t in ("A b. C d\n<p>E f</p> G.", "Ä 12 CQ-9532 x! Y z 日本。次", "", "one\rtwo  three <b>Four</b> five. Six"):
        assert X.masks(t) == {m for p in X.pieces(t) if (m := X.mask(p))}
