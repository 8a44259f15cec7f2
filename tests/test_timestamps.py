from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from vigilake.operators import timestamps as T

SOURCES = "source_id string, feed_tz string, date_order string"
SIGNALS = "row_id long, source string, published_date string, fetched_at string"


def us(*parts, micro=0):
    return int(datetime(*parts, tzinfo=UTC).timestamp()) * 1_000_000 + micro


CASES = [
    ("2024-03-10T12:00:00.123456789Z", "UTC", "dmy", us(2024, 3, 10, 12, micro=123456)), ("2026-06-10t19:29:29z", "UTC", "dmy", us(2026, 6, 10, 19, 29, 29)), ("20120311T083256Z", "UTC", "dmy", us(2012, 3, 11, 8, 32, 56)),
    ("20120311T045617-0400", "UTC", "dmy", us(2012, 3, 11, 8, 56, 17)), ("20130331", "UTC", "dmy", us(2013, 3, 31)), ("1362895769", "UTC", "dmy", us(2013, 3, 10, 6, 9, 29)), ("1331446453042", "UTC", "dmy", us(2012, 3, 11, 6, 14, 13, micro=42000)),
    ("1509859057.563453", "UTC", "dmy", us(2017, 11, 5, 5, 17, 37, micro=563453)), ("1403809872529662", "UTC", "dmy", us(2014, 6, 26, 19, 11, 12, micro=529662)),
    ("Fri, 01 Apr 2022 13:02:19 GMT", "America/New_York", "mdy", us(2022, 4, 1, 13, 2, 19)), ("Mon, 01 Jul 22 04:07:20 BST", "Europe/London", "dmy", us(2022, 7, 1, 3, 7, 20)), ("Thu Apr  4 23:43:05 EDT 2024", "America/New_York", "mdy", us(2024, 4, 5, 3, 43, 5)),
    ("Fri Apr 11 02:58:42 2025", "America/New_York", "mdy", us(2025, 4, 11, 6, 58, 42)), ("01/02/2024", "UTC", "mdy", us(2024, 1, 2)), ("01/02/2024", "UTC", "dmy", us(2024, 2, 1)), ("2024/02/01", "UTC", "mdy", us(2024, 2, 1)), ("1/3/17", "UTC", "dmy", us(2017, 3, 1)),
    ("11.1.2020 06:21", "Europe/Berlin", "mdy", us(2020, 1, 11, 5, 21)), ("April 10, 2025 5:30 p.m. EDT", "America/New_York", "mdy", us(2025, 4, 10, 21, 30)), ("10 April 2025 12:50 AM", "UTC", "dmy", us(2025, 4, 10, 0, 50)), ("12. Mai 2026, 15:11 Uhr", "Europe/Berlin", "dmy", us(2026, 5, 12, 13, 11)),
    ("10 mars 2019 à 12h40", "Europe/Paris", "dmy", us(2019, 3, 10, 11, 40)), ("31 de octubre de 2025, 01:34", "UTC", "dmy", us(2025, 10, 31, 1, 34)), ("2020年01月23日 21時54分", "Asia/Tokyo", "dmy", us(2020, 1, 23, 12, 54)), ("2014-06-18 18:34:03 UTC-4", "UTC", "dmy", us(2014, 6, 18, 22, 34, 3)),
    ("2016-01-13 03:05:42 GMT+11:00", "UTC", "dmy", us(2016, 1, 12, 16, 5, 42)), ("2012-03-25T04:02:06+02:00[Europe/Berlin]", "UTC", "dmy", us(2012, 3, 25, 2, 2, 6)), ("2013-03-10 04:51:57 America/Los_Angeles", "UTC", "dmy", us(2013, 3, 10, 11, 51, 57)),
    ("2024-11-03 01:30:00", "America/New_York", "mdy", us(2024, 11, 3, 5, 30)), ("2024-03-10 02:30:00", "America/New_York", "mdy", us(2024, 3, 10, 7, 30)), ("15 Mar 2020 18:47:00 EST", "Australia/Sydney", "dmy", us(2020, 3, 15, 8, 47)),
    (" \t2024-01-02 ", "UTC", "dmy", us(2024, 1, 2)), ("2025-02-30", "UTC", "dmy", None), ("0000-00-00", "UTC", "dmy", None), ("13/32/2024", "UTC", "mdy", None), ("to be announced", "UTC", "dmy", None), ("", "UTC", "dmy", None), (None, "UTC", "dmy", None),
    ("2024-01-02 10:00:00 Europe/Nowhere", "UTC", "dmy", None), ("x" * 5000, "UTC", "dmy", None),
]


def test_instants(spark):
    rows = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(CASES)], "i int, v string, z string, o string")
    got = {r.i: r.u for r in rows.select("i", T.instant(F.col("v"), F.col("z"), F.col("o")).alias("u")).collect()}
    assert [(c[0], got[i]) for i, c in enumerate(CASES)] == [(c[0], c[3]) for c in CASES]


def test_canonical_values_are_no_cases_and_clashing_columns_do_no_harm(spark):
    sources = spark.createDataFrame([("a", "UTC", "mdy"), ("a", "UTC", "mdy"), (None, "UTC", "dmy")], SOURCES)
    signals = spark.createDataFrame([(1, "a", "2024-01-02T03:04:05Z", "2024-01-02T03:04:05.1234567Z", 7), (2, None, None, "20240102T030405Z", 7), (2, None, None, "20240102T030405Z", 7), (3, "b", "01/02/2024", None, 7)], SIGNALS + ", zone int")
    got = sorted(map(tuple, T.found(signals, sources).collect()))
    assert got == [(1, "fetched_at", us(2024, 1, 2, 3, 4, 5, micro=123456)), (2, "fetched_at", us(2024, 1, 2, 3, 4, 5)), (2, "fetched_at", us(2024, 1, 2, 3, 4, 5)), (3, "published_date", us(2024, 2, 1))]


def test_empty_tables(spark):
    assert T.found(spark.createDataFrame([], SIGNALS), spark.createDataFrame([], SOURCES)).count() == 0


def test_undeclared_zone_is_estimated_from_ingestion(spark):
    sources = spark.createDataFrame([("ny", "America/New_York", "mdy"), ("syd", "Australia/Sydney", "dmy"), ("new", None, "dmy")], SOURCES)
    # Published local Sydney time, fetched minutes later: read as UTC or New York time it would lie after the fetch.
    rows = [(i, "new", f"2024-06-{i:02d} 12:00:00", f"2024-06-{i:02d}T02:05:00Z") for i in range(1, 20)]
    got = {r.row_id: r.utc_micros for r in T.found(spark.createDataFrame(rows, SIGNALS), sources).where("field = 'published_date'").collect()}
    assert got == {i: us(2024, 6, i, 2) for i in range(1, 20)}


def test_zone_is_estimated_from_stated_offsets_and_other_deliveries(spark):
    sources = spark.createDataFrame([("a", "Europe/Berlin", "dmy"), ("b", "UTC", "dmy"), ("c", "Europe/London", "dmy"), ("new", None, "dmy"), (None, None, None)], SOURCES)
    rows = [(1, "new", "g1", "2024-07-01T10:00:00+02:00", None), (2, "new", "g2", "1 January 2024 10:00 CET", None), (3, "new", "g3", "2024-03-30 12:00", None), (4, "new", "g4", "2024-04-02 12:00", "2020-01-01T00:00:00Z"), (5, "new", None, None, None)]
    rows += [(10, "c", "h1", "2024-07-01 10:00:05", None), (11, "c", "h1", "2024-07-01T09:00:05Z", None), (12, "c", "h2", "2024-01-01 10:00", None), (13, "c", "h2", "2024-01-01T10:00:00Z", None)]
    rows += [(20 + i, "b", "same", "2024-07-01 10:00" if i % 2 else "2024-07-01T10:00:00Z", None) for i in range(40)]
    signals = spark.createDataFrame(rows, "row_id long, source string, guid string, published_date string, fetched_at string").selectExpr("*", "1 as zone", "2 as rank")
    got = {r.row_id: r.utc_micros for r in T.found(signals, sources).where("field = 'published_date'").collect()}
    assert got[3] == us(2024, 3, 30, 11) and got[4] == us(2024, 4, 2, 10)
    by = {r.source: r for r in T.agreement(signals, sources).collect()}
    assert by["c"].estimated == "Europe/London" and by["new"].estimated == "Europe/Berlin" and by["a"].estimated is None and by["b"].estimated == "UTC"
    assert T.agreement(signals.limit(0), sources).count() == 4


@pytest.mark.parametrize("value", ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05.1Z"])
def test_canonical_pattern(spark, value):
    assert spark.createDataFrame([(value,)], "v string").where(F.col("v").rlike(T.CANONICAL)).count() == 1
