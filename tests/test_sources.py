import json

from vigilake.sources import feeds, records
from vigilake.streaming import signals as streams

RSS = """<rss><channel><item><title>T &amp; x</title><link>l</link><description>&lt;p&gt;a&lt;/p&gt;b</description><media:thumbnail url="u"/><pubDate>d</pubDate></item><item></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>1</id><title>E</title><published>p</published><updated>u</updated><link rel="self" href="no"/><link href="yes"/><summary>s</summary></entry></feed>"""


def payloads(spark, *texts):
    return spark.createDataFrame([("s", t, "f") for t in texts], "source string, payload string, fetched_at string")


def test_xml_feeds(spark):
    got = sorted(tuple(r) for r in feeds.xml_feed(payloads(spark, RSS, ATOM, "no xml", "", None)).collect())
    assert got == [("s", "1", "E", "yes", "p", "s", "f"), ("s", "item", "item", "", "", "", "f"), ("s", "l", "T & x", "l", "d", "a b", "f")]


def test_json_feeds(spark):
    kev = json.dumps({"vulnerabilities": [{"cveID": "CVE-2024-1234", "shortDescription": "d", "vendorProject": "v", "product": "p", "requiredAction": " "}]})
    row = feeds.kev_feed(payloads(spark, kev)).first()
    assert (row.guid, row.summary, row.kev_required_action, row.kev_vendor) == ("CVE-2024-1234", "d | v p", None, "v")
    any_shape = [json.dumps([{"id": 7, "name": "n"}]), json.dumps({"items": [{"url": "u", "description": "x"}]}), "broken {", "{}"]
    got = sorted((r.guid, r.title, r.link, r.summary) for r in feeds.json_feed(payloads(spark, *any_shape)).collect())
    assert got == [("7", "n", "", ""), ("u", "item", "u", "x")]
    nvd = json.dumps({"format": "NVD_CVE", "vulnerabilities": [{"cve": {"id": "CVE-2024-1", "lastModified": "m", "descriptions": [{"lang": "fr", "value": "f"}, {"lang": "en", "value": "e"}], "references": [{"url": ""}, {"url": "r"}]}}]})
    row = feeds.nvd_feed(payloads(spark, nvd)).first()
    assert (row.guid, row.link, row.published_date, row.summary) == ("CVE-2024-1", "r", "m", "e")


def test_files(spark, tmp_path):
    (tmp_path / "f.csv").write_text("# note\ncve,epss,percentile\nCVE-2024-1,0.5,0.9\n")
    row = feeds.read_csv_feed(spark, str(tmp_path / "f.csv"), "s", "now").first()
    assert (row.guid, row.summary, row.link) == ("CVE-2024-1", "epss=0.5 | percentile=0.9", "https://nvd.nist.gov/vuln/detail/CVE-2024-1")
    (tmp_path / "x.jsonl").write_text('{"a": 1}\nbad\n')
    assert feeds.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a int").count() == 1
    (tmp_path / "e.json").write_text('{"items": [{"a": 1}, {"a": 2}]}')
    assert feeds.read_envelope(spark, str(tmp_path / "e.json"), "a: int").count() == 2


def test_paged_source_prunes_pages(spark, tmp_path):
    for day, n in (("2024-01-01", 2), ("2024-02-01", 3)):
        (tmp_path / f"page-{day}.json").write_text(json.dumps({"results": [{"n": i} for i in range(n)]}))
    spark.dataSource.register(feeds.PagedSource)
    read = lambda **o: spark.read.format("advisory_pages").options(**o).load(str(tmp_path)).count()
    assert (read(), read(start="2024-01-15"), read(start="2025-01-01")) == (5, 3, 0)


def test_records(spark):
    cve = {"cve": {"id": "CVE-2024-12345", "descriptions": [{"lang": "de", "value": "d"}], "metrics": {"cvssMetricV2": [{"cvssData": {"baseScore": 7.2}}]}, "configurations": [{"nodes": [{"cpeMatch": [{"criteria": "c1"}, {"criteria": "c1"}]}]}]}}
    row = records.vulnerabilities(payloads(spark, json.dumps(cve), "{}", None)).first()
    assert (row.cve, row.description, row.severity, row.cpes) == ("CVE-2024-12345", "d", "HIGH", ["c1"])
    stix = {"objects": [{"type": "attack-pattern", "name": "n", "description": "x" * 600, "external_references": [{"source_name": "o", "external_id": "0"}, {"source_name": "mitre-attack", "external_id": "T1", "url": "u"}], "kill_chain_phases": [{"phase_name": "p"}, {"phase_name": "q"}]}, {"type": "x"}]}
    row = records.techniques(payloads(spark, json.dumps(stix))).first()
    assert (row.id, len(row.description), row.tactics) == ("T1", 500, "p;q")
    classes = payloads(spark, '{"device_class": "2"}', '{"openfda": {"device_class": ["3"]}}', '{"device_class": "U"}', "bad").select(records.recall_class(__import__("pyspark").sql.functions.col("payload")).alias("c"))
    assert [r.c for r in classes.collect()] == ["2", "3", None, None]


def test_streams_equal_batches(spark, tmp_path):
    rows = spark.createDataFrame([(i % 5, f"2024-01-0{1 + i % 3} 00:00:00", "e") for i in range(30)], "user_id long, ts string, event_type string")
    rows.write.parquet(str(tmp_path / "events.parquet"))
    once = streams.finished(streams.once(streams.arriving(spark, str(tmp_path), "events").select("user_id"), ["user_id"]))
    assert sorted(r.user_id for r in once.collect()) == [0, 1, 2, 3, 4]
    spans = streams.finished(streams.seen_spans(streams.arriving(spark, str(tmp_path), "events"), "user_id", "ts"), "complete")
    assert {r.n for r in spans.collect()} == {6}


def test_advisories_and_decisions(spark):
    csaf = {
        "document": {"title": "t", "tracking": {"id": "A-1", "initial_release_date": "d"}, "notes": [{"category": "legal", "text": "no"}, {"category": "summary", "text": "s"}]},
        "vulnerabilities": [{"cve": "CVE-2", "cwe": {"id": "CWE-9"}, "scores": [{"cvss_v3": {"baseScore": 5.0, "vectorString": "v1"}}], "remediations": [{"details": "a"}, {"details": "b"}]}, {"cve": "CVE-1", "scores": [{"cvss_v3": {"baseScore": 9.0}}], "remediations": [{"details": "a"}]}],
        "product_tree": {"branches": [{"name": "vendor", "branches": [{"name": "p"}, {"name": "q"}]}]},
    }
    row = records.advisories(payloads(spark, json.dumps(csaf), "{}", None, "bad")).collect()
    assert len(row) == 1
    r = row[0]
    assert (r.advisory_id, r.summary, r.cves, r.cwe_ids, r.remediations, r.score, r.vector, r.vendor, r.products) == ("A-1", "s", ["CVE-1", "CVE-2"], ["CWE-9"], ["a", "b"], 9.0, "v1", "vendor", ["p", "q"])
    adp = {"containers": {"adp": [{"metrics": [{"other": {"content": {"options": [{"Exploitation": "none"}, {"Automatable": "no"}, {"Exploitation": "active"}]}}}, {"cvssV3_1": {"baseScore": 7.0, "baseSeverity": "HIGH"}}], "problemTypes": [{"descriptions": [{"cweId": "CWE-2"}, {"cweId": "CWE-2"}]}]}]}}
    r = records.decisions(payloads(spark, json.dumps(adp), "{}")).first()
    assert (r.score, r.severity, r.exploitation, r.automatable, r.technical_impact, r.cwe_ids) == (7.0, "HIGH", "active", "no", None, ["CWE-2"])


def test_overlays(spark):
    schema = "id string, title string, cves array<string>, score double"
    base = spark.createDataFrame([("a", "old", ["2"], 5.0), ("b", "old", None, None)], schema)
    detail = spark.createDataFrame([("a", "", ["1", "2"], 9.0)], schema)
    got = {r.id: (r.title, r.cves, r.score) for r in records.overlaid(base, detail, "id", ["cves"], ["score"]).collect()}
    assert got == {"a": ("old", ["1", "2"], 9.0), "b": ("old", [], None)}
    maps = spark.createDataFrame([({"x": "1", "y": "1"}, {"y": "2"}), (None, {"z": "3"}), ({"x": "1"}, None)], "a map<string,string>, b map<string,string>")
    from pyspark.sql import functions as F

    assert [r.m for r in maps.select(records.overlaid_maps(F.col("a"), F.col("b")).alias("m")).collect()] == [{"x": "1", "y": "2"}, {"z": "3"}, {"x": "1"}]
