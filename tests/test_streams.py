import __spark_entry__ as entry


def test_open_windows_and_late_rows_count(spark, tmp_path):
    rows = [("2024-01-01 10:00:00", "a"), ("2024-01-09 10:00:00", "a"), ("2024-01-09 23:59:59", "a"), ("2024-01-10 00:00:00", "b"), ("2024-01-01 11:00:00", "a"), (None, "a")]
    frame = spark.createDataFrame(rows, "t string, event_type string").selectExpr("cast(t as timestamp) as ts", "event_type")
    frame.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got = {(str(r.start)[:10], r.kind): r.n for r in entry.queries()["stream_windows"](spark, str(tmp_path)).collect()}
    assert got == {("2024-01-01", "a"): 2, ("2024-01-09", "a"): 2, ("2024-01-10", "b"): 1}
