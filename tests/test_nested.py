import json

from vigilake.operators import nested as N

ADVISORY = {
    "advisory_id": "A", "affected_versions": [{"version": "1", "builds": ["x", None, ""]}, "2", {}, None, " "], "mitigations": "do it",
    "products": [{"name": "p", "affected_versions": {"version": "3", "builds": "b"}}, {"name": "q"}, {"affected_versions": ["4"]}],
}
PACKET = {
    "issue_id": "I", "recommended_patterns": {"pattern_id": "a", "parameters": {"port": 1, "window": "", "contact": None, "x": "y"}, "side_effects": "slow"},
    "tasks_by_role": {"privacy office": ["t", {"task": "u", "depends_on": ["v"]}], "net": "single", "none": None, "empty": []},
}


def paths(record, kind):
    return {(p, q) for _, p, q, *_ in N.children(record, kind, N.DECLARED, N.Automaton())}


def test_advisory_paths():
    assert paths(ADVISORY, "advisory") == {
        ("", "affected_versions[0]"), ("affected_versions[0]", "affected_versions[0].builds[0]"), ("", "affected_versions[1]"), ("", "mitigations[0]"), ("products[0]", "products[0].affected_versions[0]"),
        ("products[0].affected_versions[0]", "products[0].affected_versions[0].builds[0]"), ("products[2]", "products[2].affected_versions[0]"),
    }


def test_packet_paths():
    first = "recommended_patterns[0]"
    assert paths(PACKET, "packet") == {
        ("", first), (first, f"{first}.parameters.port"), (first, f"{first}.parameters.x"), (first, f"{first}.side_effects[0]"), ("", "tasks_by_role.privacy office[0]"), ("", "tasks_by_role.privacy office[1]"),
        ("tasks_by_role.privacy office[1]", "tasks_by_role.privacy office[1].depends_on[0]"), ("", "tasks_by_role.net[0]"),
    }
    listed = {"issue_id": "I", "tasks_by_role": [{"role": "net", "tasks": ["a"]}]}
    assert paths(listed, "packet") == {("", "tasks_by_role[0]"), ("tasks_by_role[0]", "tasks_by_role[0].tasks[0]")}


def test_wrappings_are_read_and_broken_payloads_are_not():
    text = json.dumps(ADVISORY)
    for wrapped in (text, "﻿" + text, f"```json\n{text}\n```", f"Here it is:\n{text}\nMore?", json.dumps(text), json.dumps({"data": {"record": ADVISORY}}), json.dumps({"result": text}), f"[{text}]"):
        assert N.read_record(wrapped, "advisory") == ADVISORY
    for broken in (text[:-9], "", "  ", None, "{}", "null", "[]", "no json", "[" * 5000, '{"a": 1'):
        assert N.read_record(broken, "advisory") is None


def test_equal_shapes_have_equal_states():
    a = N.Automaton()
    one, same, other = a.read({"x": 1, "y": ["s"]}), a.read({"y": ["t", "u"], "x": 2}), a.read({"x": 1, "y": [1]})
    assert one.state == same.state != other.state and a.final[one.state] == "object"


def test_final_states():
    a = N.Automaton()
    for value, subtype in ((None, None), (" ", None), ({}, None), ([], None), ("x", "text"), (0, "number"), (False, "boolean"), ({"version": "1", "builds": []}, "version"), ({"role": "r", "details": "d"}, "step"), ({"role": "r", "tasks": []}, "role_tasks"), ({"task": None}, "task"), ({"q": 1}, "object"), (["x"], "array")):
        assert a.final[a.read(value).state] == subtype


def test_rows_count_by_themselves_and_types_split(spark, tmp_path):
    rows = spark.createDataFrame([(1, json.dumps(ADVISORY), 0), (1, json.dumps(ADVISORY), 0), (2, None, 0), (3, "{", 0)], "rec_id long, payload string, path int")
    got = N.child_rows(rows, "rec_id", "advisory")
    folder = N.route(got, str(tmp_path / "t"))
    everything = N.supertype(spark, folder)
    assert everything.count() == 14 and {r.rec_id for r in everything.collect()} == {1}
    versions = N.typed(spark, folder, "version").collect()
    assert sorted(r.version for r in versions) == ["1", "1", "3", "3"] and {r.parent_path for r in versions} == {"", "products[0]"}
    assert N.typed(spark, folder, "text").where("field = 'mitigations'").first().value == "do it"
    assert N.supertype(spark, N.route(N.child_rows(rows.limit(0), "rec_id", "advisory"), str(tmp_path / "e"))).count() == 0


def test_keys_made_per_record_are_not_collected(spark):
    rows = [(i, json.dumps({"advisory_id": "a", "mitigations": [{f"k{i}": ["t"]}]})) for i in range(50)]
    assert N.array_places(spark.createDataFrame(rows, "rec_id long, payload string"), "advisory") == N.DECLARED


def test_single_value_where_others_have_arrays_is_learned(spark):
    rows = [(1, json.dumps({"advisory_id": "a", "mitigations": [{"action": "x", "tags": ["t"]}]})), (2, json.dumps({"advisory_id": "b", "mitigations": [{"action": "x", "tags": "t"}]}))]
    got = N.child_rows(spark.createDataFrame(rows, "rec_id long, payload string"), "rec_id", "advisory")
    assert {(r.rec_id, r.path) for r in got.collect()} == {(k, p) for k in (1, 2) for p in ("mitigations[0]", "mitigations[0].tags[0]")}
