import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vigilake.llm import components as C


def brute(pairs):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return {(x, root(x)) for x in list(parent)}


def run(spark, pairs, **options):
    return {(r.id, r.group) for r in C.components(spark.createDataFrame(pairs, "a string, b string"), **options).collect()}


def test_shapes(spark):
    rng = random.Random(1)
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(150)]
    star = [("s000", f"s{i:03d}") for i in range(1, 200)]
    noise = [("x", "x"), (None, "y"), ("y", None), ("p", "q"), ("q", "p"), ("p", "q")]
    pairs = chain + star + noise
    rng.shuffle(pairs)
    assert run(spark, pairs) == brute(pairs)


def test_empty(spark):
    assert run(spark, []) == set()


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 30).map(str), st.integers(0, 30).map(str)), max_size=40), st.sampled_from([0.1, 1.0]), st.integers(1, 3))
def test_equals_brute_force(spark, pairs, beta, hops):
    assert run(spark, pairs, beta=beta, hops=hops) == brute(pairs)


def test_verdicts(spark):
    rows = [("a", "b", True, 0.7), ("b", "c", True, 0.69), ("b", "a", False, 0.9), ("d", "e", None, 0.9), ("d", "e", True, None), ("f", "f", True, 1.0), ("g", None, True, 1.0)]
    got = C.found(spark.createDataFrame(rows, "candidate_a string, candidate_b string, same_issue boolean, confidence double").selectExpr("*", "1 as a", "2 as id"))
    assert {tuple(r) for r in got.collect()} == {("a", "a"), ("a", "b")}
