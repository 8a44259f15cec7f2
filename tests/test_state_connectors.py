import json

import pytest
from pyspark.sql import functions as F

from vigilake.operators import enrich, lookups, publish, rules, state
from vigilake.sources import connectors


def payloads(spark, *objects):
    return spark.createDataFrame([(o if o is None or isinstance(o, str) else json.dumps(o), 1) for o in objects], "payload string, guid int")


def test_vuldb_statuses_and_fallbacks(spark):
    ok = lambda *rows: {"response": {"status": "200"}, "result": list(rows)}
    rows = payloads(spark, ok({"entry": {"id": "1", "title": "t", "cve": {"cve_id": "CVE-2024-1"}}}, {"id": "2", "entry": {"description": "d"}}, {}), {"response": {"status": "401"}, "result": [{"entry": {"id": "3"}}]}, None, "", "no json", {"result": []})
    got = connectors.vuldb(rows).collect()
    assert [(r.guid, r.title, r.link, r.summary) for r in got[:2]] == [("1", "t", "https://nvd.nist.gov/vuln/detail/CVE-2024-1", ""), ("2", "2", "", "d")]
    assert len(got) == 3 and len(got[2].guid) == 40 and got[2].title == "VulDB entry"


def test_icsma_lines(spark):
    columns = "`ICS-CERT_Number` string, `ICS-CERT_Advisory_Title` string, Vendor string, Product string, Original_Release_Date string, CVE_Number string, CWE_Number string, Cumulative_CVSS string, CVSS_Severity string"
    lines = spark.createDataFrame([(" ICSMA-1 ", "T", "V", "P", "d", "CVE-1, x,CVE-2", "CWE-3", "9.x", "High"), ("ICSA-2", *["x"] * 8), (None, *[None] * 8), ("ICSMA-3", *[None] * 8)], columns)
    advisories = connectors.icsma_advisories(lines)
    by = {r.advisory_id: r for r in advisories.collect()}
    assert set(by) == {"ICSMA-1", "ICSMA-3"} and by["ICSMA-1"].cves == ["CVE-1", "CVE-2"] and by["ICSMA-1"].cvss_score is None and by["ICSMA-3"].cves == []
    documents = spark.createDataFrame([("ICSMA-3", "text"), ("ICSMA-3", "words"), (None, "x")], "advisory_id string, description string")
    got = {r.guid: r.summary for r in connectors.icsma_signals(connectors.with_descriptions(advisories, documents)).collect()}
    assert got == {"ICSMA-1": "V P | CVEs: CVE-1, CVE-2", "ICSMA-3": "text"}


def test_alerts_indexes_and_recalls(spark):
    got = connectors.mhra_signals(payloads(spark, {"link": "/a/some alert", "title": " "}, {"title": "a b"}, {}, None)).collect()
    assert [(r.guid, r.title, r.link) for r in got] == [("some_alert", "some_alert", "https://www.gov.uk/a/some alert"), ("a_b", "a b", "")]
    index = payloads(spark, {"feed": {"entry": [{"id": "ssa-1", "title": "t", "link": [{"rel": "x", "href": "u"}, {"rel": "self", "href": "v"}]}, {"title": "none"}]}}, [{"url": "https://x/ssa-2.json"}, None], {"items": []}, "7", None)
    assert {tuple(r) for r in connectors.index_entries(index).collect()} == {("SSA-1", "t", "", "v"), ("SSA-2", "ssa-2", "", "https://x/ssa-2.json")}
    lists = {"results": {"ALL": [{"recallId": "1", "title": "a", "date_published": 1700000000000, "category": ["3"]}, {"recallId": "2", "category": ["1"]}, {"recallId": " "}], "HEALTH": [{"recallId": "1", "title": "b"}, {"recallId": "4", "date_published": "soon"}]}}
    assert {(r.recall_id, r.title, r.date_published) for r in connectors.recent_recalls(payloads(spark, lists, None, "{}")).collect()} == {("1", "a", "2023-11-14T22:13:20+00:00"), ("4", "", "soon")}


def test_state_over_runs(spark, tmp_path):
    log = state.Log(spark, str(tmp_path / "seen"), "k string")
    rows = lambda *ks: spark.createDataFrame([(k, i) for i, k in enumerate(ks)], "k string, i int")
    assert {tuple(r) for r in state.new_rows(rows("a", "b", "a", None, ""), log, "k", F.col("i")).collect()} == {("a", 0), ("b", 1)}
    assert {r.k for r in state.new_rows(rows("b", "c"), log, "k", F.col("i")).collect()} == {"c"}
    assert state.new_rows(rows("b", "c"), state.Log(spark, str(tmp_path / "seen"), "k string"), "k", F.col("i")).count() == 0
    log.reset()
    assert log.parts() == [] and log.read().count() == 0
    snapshots, changed = state.Log(spark, str(tmp_path / "s"), "k string, v int"), state.Log(spark, str(tmp_path / "c"), "k string, change string, field string")
    of = lambda *r: spark.createDataFrame(list(r), "k string, v int")
    assert state.changes(of(("a", 1), ("b", 2)), snapshots, changed, "k", ["v"]).count() == 0
    assert {tuple(r) for r in state.changes(of(("a", 1), ("b", None), ("c", 3)), snapshots, changed, "k", ["v"]).collect()} == {("b", "changed", "v"), ("c", "added", None)}
    assert {tuple(r) for r in state.changes(of(("b", None)), snapshots, changed, "k", ["v"]).collect()} == {("a", "removed", None), ("c", "removed", None)}
    assert changed.read().count() == 4


def test_filling_and_citing(spark):
    rows = spark.createDataFrame([("a", "", "s"), ("b", None, "s"), ("c", "t", "s"), (None, None, None)], "id string, title string, summary string")
    better = spark.createDataFrame([("a", "A", "x", 1), ("b", "B", None, 1), ("c", "C", "z", 1)], "id string, title string, summary string, other int")
    assert {tuple(r) for r in enrich.filled(rows, better, "id", ["title", "summary"], ("summary",)).collect()} == {("a", "A", "x"), ("b", "B", "s"), ("c", "t", "z"), (None, None, None)}
    html = spark.createDataFrame([("<p>a&amp;lt;b</p>   \n x",), (None,)], "h string").select(enrich.page_text(F.col("h")).alias("t")).collect()
    assert [r.t for r in html] == ["a&lt;b x", None]
    now = F.to_timestamp(F.lit("2024-05-01"))
    cached = spark.createDataFrame([("a", "2024-04-01"), ("b", "2023-04-01"), ("c", None)], "k string, f string").select("k", F.to_timestamp("f").alias("fetched_at"))
    assert [r.k for r in enrich.fresh(cached, now).collect()] == ["a"]


@pytest.mark.parametrize(("title", "vendor", "sources", "category"), [
    ("Mindray units", None, [], "medical_device"), ("x", "B. Braun AG", None, "medical_device"), ("x", "Masimolabs", ["some-kev"], "medical_device"), ("x", "Masimolabs", ["other"], "not_healthcare"), ("abduct", "", [], "not_healthcare"), ("sunscreen by Philips", "", [], "healthcare_adjacent"),
])
def test_makers(spark, title, vendor, sources, category):
    row = spark.createDataFrame([("i", title, None, vendor, sources, False, None)], "issue_id string, title string, summary string, vendor string, sources array<string>, medical boolean, fda_risk_class string")
    assert rules.categorised(row).first().category == category


def test_tasks_are_numbered_in_order(spark):
    rows = [(1, "tasks_by_role", f"tasks_by_role.it[{i}]", "text", f"t{i}") for i in (2, 10, 0, 1)] + [(1, "tasks_by_role", "tasks_by_role.it[2].depends_on[0]", "text", "x")]
    got = publish.tasks(spark.createDataFrame(rows, "rec_id long, field string, path string, subtype string, value string")).orderBy("task_id").collect()
    assert [r.task for r in got] == ["t0", "t1", "t2", "t10"] and got[0].task_id == "1-001"


@pytest.mark.parametrize("values", [[], [3], [1, 1, 2, None, 5, 5, 5, 9], list(range(1000))])
def test_percentiles(spark, values):
    known = sorted(v for v in values if v is not None)
    got = {r.share: r.value for r in lookups.percentiles(spark.createDataFrame([(v,) for v in values], "v int"), "v", [0.0, 0.5, 0.9, 1.0]).collect()}
    assert got == {s: known[min(int(len(known) * s), len(known) - 1)] for s in (0.0, 0.5, 0.9, 1.0) if known}
