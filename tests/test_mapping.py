import json

from fixtures import document, structure, structures

from tidemark.operators import mapping

UUID = "aaaaaaaa-bbbb-cccc-ddddddddddddddAA"


def test_deep_tree_details_and_inheritance(spark):
    doc = {
        "controls": {"root": {
            "name": "Root", "type": "T", "room": "r", "cat": "c", "uuidAction": "act", "states": {"s": "st", "n": 5}, "details": {"nested": [UUID, "not-a-uuid"]},
            "subControls": {"root/AI5": {"name": "Kid", "subControls": {"deep": {"name": "Deep", "room": "q", "states": {"x": "y"}, "details": UUID}}}},
        }},
        "rooms": {"r": {"name": "Room"}, "q": {}}, "cats": {"c": {"name": "Cat"}}, "padding": "x" * 1000,
    }
    got = {(r["control_uuid"], r["mapping_source"], r["state_uuid"]): r for r in mapping.candidates(structures(spark, [structure("s", "2026-01-01", json.dumps(doc))])).collect()}
    assert set(got) == {
        ("root", "state", "st"), ("root", "details", UUID), ("root", "uuidAction", "act"), ("root", "controlKey", "root"),
        ("root/AI5", "controlKey", "root/AI5"), ("deep", "controlKey", "deep"), ("deep", "state", "y"), ("deep", "details", UUID)}
    assert got["root", "details", UUID]["state_name"] == "0" and got["deep", "details", UUID]["state_name"] is None
    kid, deep = got["root/AI5", "controlKey", "root/AI5"], got["deep", "state", "y"]
    assert (kid["room_name"], kid["category_name"], kid["control_path"]) == ("Room", "Cat", "$.controls.root.subControls.root/AI5")
    assert (deep["room_uuid"], deep["room_name"], deep["category_uuid"]) == ("q", None, "c")


def test_versions_and_validity(spark):
    short = '{"controls":{"a":{"name":"%s"}}}'
    exact = short % ("x" * (1000 - len(short) + 2))
    assert len(exact) == 1000
    rows = [structure("ok", "2026-01-01", document(), modified="2026-01-01 10:00:00"), structure("exact", "2026-01-01", exact), structure("empty", "2026-01-01", '{"controls":{},"p":"%s"}' % ("x" * 1100)), structure("odd", "2026-01-01", "no json" * 300, modified="")]
    s = mapping.valid(structures(spark, rows))
    found = mapping.controls(s)
    (v,) = mapping.structure_versions(s, mapping.candidates(s), found).collect()
    assert (v["structure_id"], v["control_count"], v["control_object_count"], v["room_count"], v["category_count"]) == ("ok", 1, 2, 1, 0)
    assert v["structure_last_modified"].hour == 10 and v["payload_bytes"] == len(document().encode())


def test_conflicts(spark):
    s = structures(spark, [structure("s", "2026-01-01", document(conflict=True))])
    rows = {r["state_uuid"]: r for r in mapping.conflicts(mapping.candidates(s)).collect()}
    assert len(rows) == 2
    (r,) = [r for r in rows.values() if "Other" in r["meanings"]]
    assert (r["distinct_meanings"], r["best_priority"], r["meanings"]) == (2, 1, "state:Meter.actual | state:Other.actual")


def test_no_documents(spark):
    assert mapping.candidates(structures(spark, [])).count() == 0
