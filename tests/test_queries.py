import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("VIGILAKE_TEST_DATA", "/root/testdata/sf0.001")
TABLES = "signals sources issues merge_decisions issue_records advisory_records remediation_packets documents events".split()


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("NaT", "<NA>"):
        return None
    return round(float(v), 6) if isinstance(v, (int, float)) or type(v).__name__.startswith(("int", "float", "bool")) else str(v)


def rows(frame):
    return sorted((tuple(map(plain, r)) for r in frame[sorted(frame.columns)].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.exists(DATA), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, DATA).toPandas()
    if name in entry.oracle_sql():
        wanted = duck.execute(entry.oracle_sql()[name]).fetchdf()
        assert sorted(got.columns) == sorted(wanted.columns)
        assert rows(got) == rows(wanted)


@pytest.mark.skipif(not os.path.exists(DATA), reason="no test tables here")
def test_entry(spark):
    assert entry.entry(spark).count() > 0
