import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vigilake.llm import packing as P
from vigilake.llm import tokens as K


@pytest.fixture(scope="module")
def pair():
    tokenizers = pytest.importorskip("tokenizers")
    t = K.tables()
    theirs = tokenizers.Tokenizer.from_file(K.VOCABULARY.replace(".tiktoken", ".json"))
    theirs.encode_special_tokens = True
    return K.Encoder(t.raw, t.left, t.right), theirs


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_ids_equal_the_library(pair, text):
    mine, theirs = pair
    assert mine.ids(text) == theirs.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["<|endoftext|>", "a" * 20_000, "=-" * 5_000, "é‍👩🏽‍⚕️", " \n\t ", "don't we'll I'd", "日本語" * 500, "\x00\x7f"])
def test_odd_texts(pair, text):
    mine, theirs = pair
    assert mine.ids(text) == theirs.encode(text, add_special_tokens=False).ids


def test_rows(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (3, "a b")], "doc_id long, text string").selectExpr("*", "1 as ids", "2 as n")
    assert sorted((r.doc_id, list(r.ids)) for r in K.encode(rows).collect()) == [(1, []), (2, []), (3, [64, 275]), (3, [64, 275])]
    assert sorted((r.doc_id, r.n) for r in K.lengths(rows).collect()) == [(1, 0), (2, 0), (3, 2), (3, 2)]
    assert K.encode(rows.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_completion_is_a_packing_no_worse_than_best_fit(sizes):
    bins = P.complete(sizes, 50)
    assert sorted(s for b in bins for s in b) == sorted(sizes) and all(sum(b) <= 50 for b in bins)
    assert math.ceil(sum(sizes) / 50) <= len(bins) <= len(P.best_fit(sizes, 50))


def test_completion_meets_the_bound():
    sizes = [7, 7, 6, 6, 5, 5, 4, 4, 3, 3]
    assert len(P.complete(sizes, 10)) == 5


def test_containers(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([0, 5, 30, 200, 900, 2048, 2049, 5000])) for i in range(3000)]
    got = P.containers(spark.createDataFrame(rows, "doc_id long, n int"), group=500).toPandas()
    assert got.groupby("doc_id").tokens.sum().to_dict() == dict(rows)
    fill = got.groupby("container").tokens.sum()
    assert fill.max() <= 2048 and len(fill) <= 1.01 * sum(n for _, n in rows) / 2048 + 1
    assert not got.duplicated(["container", "position"]).any()
    assert (got.groupby("doc_id").part.max() == [max(math.ceil(n / 2048) - 1, 0) for _, n in rows]).all()
    assert P.containers(spark.createDataFrame([], "doc_id long, n int")).count() == 0
