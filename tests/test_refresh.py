"""End-to-end runs of the refresh on a store."""

import pytest
from fixtures import ACTION, STATE, at, document, message, messages, structure, structures

from tidemark.operators import marts
from tidemark.plans.refresh import Limits, Refresh
from tidemark.plans.store import ConcurrentCommit


class Home:
    """A store with Bronze rows that tests add to."""

    def __init__(self, spark, root, **limits):
        self.spark, self.m, self.s = spark, [], []
        self.refresh = Refresh(spark, str(root), lambda: messages(spark, self.m), lambda: structures(spark, self.s), Limits(**limits))

    def rows(self, *cols):
        return sorted(tuple(r) for r in self.refresh.store.events().select(*cols).collect())


@pytest.fixture
def home(spark, tmp_path):
    h = Home(spark, tmp_path / "store")
    h.s.append(structure("s1", "2026-09-02", document()))
    h.m += [message("m1", "2026-09-01", {STATE: 1}), message("m2", "2026-09-05", {STATE: 2})]
    return h


def test_fallback_asof_replay_and_late_rows(home):
    out = home.refresh.run()
    assert (out["status"], out["messages_processed"], out["structures_loaded"]) == ("succeeded", 2, 1)
    assert home.rows("message_id", "value_numeric", "control_name", "structure_resolution", "resolution_status") == [
        ("m1", 1.0, "Meter", "fallback_earliest", "resolved_state"), ("m2", 2.0, "Meter", "asof", "resolved_state")]
    child = home.refresh.store.read("state_uuid_map").where("control_uuid = 'named-child'").select("room_name").distinct().collect()
    assert [r[0] for r in child] == ["Plant"]
    assert home.refresh.run()["messages_processed"] == 0
    # a late structure replays exactly the messages that it explains
    home.s.append(structure("s2", "2026-09-04", document("New meter")))
    assert home.refresh.run()["messages_processed"] == 1
    assert home.rows("message_id", "control_name") == [("m1", "Meter"), ("m2", "New meter")]
    # a late upload
    home.m.append(message("m3", "2026-09-01", {STATE: 3}, ingested="2026-09-09"))
    assert home.refresh.run()["messages_processed"] == 1
    assert ("m3", "fallback_earliest") in home.rows("message_id", "structure_resolution")
    # compaction changes nothing that is visible
    before = home.rows("message_id", "control_name", "value_numeric")
    home.refresh.store.compact()
    assert home.rows("message_id", "control_name", "value_numeric") == before
    assert home.refresh.run()["messages_processed"] == 0


def test_values_ambiguity_and_other_sources(spark, tmp_path):
    h = Home(spark, tmp_path / "store")
    h.s += [structure("s1", "2026-09-01", document(conflict=True)), structure("bad", "2026-09-01", "{}")]
    h.m += [
        message("m1", "2026-09-02", '{"parsed": {"%s": 1, "%s": 2, "t": "ü \\" \\n", "o": {"nested": [1, 2]}, "n": null, "b": true, "big": 12345678901234567890}}' % (STATE, STATE)),
        message("m2", "2026-09-02", {STATE: 1}, source="other"), message("m3", "2026-09-02", {}), message("m4", "2026-09-02", '{"parsed": [1]}'),
        message("m5", "2026-09-02", '{"parsed": null}'), message("m6", "2026-09-02", {STATE: 1}, kind=90), message("m7", "2026-09-02", {ACTION: 5}),
    ]
    out = h.refresh.run()
    assert (out["structures_loaded"], out["messages_processed"]) == (1, 3)
    got = {(r["message_id"], r["state_uuid"]): r for r in h.refresh.store.events().collect()}
    r = got["m1", STATE]
    assert (r["value_numeric"], r["resolution_status"], r["competing_best_mappings"]) == (2.0, "ambiguous", 2)
    assert (got["m1", "t"]["value_text"], got["m1", "t"]["value_numeric"]) == ('ü " \n', None)
    assert (got["m1", "o"]["value_json"], got["m1", "o"]["value_text"]) == ('{"nested":[1,2]}', None)
    assert (got["m1", "n"]["value_json"], got["m1", "n"]["value_numeric"]) == ("null", None)
    assert (got["m1", "b"]["value_numeric"], got["m1", "big"]["value_numeric"]) == (1.0, 1.2345678901234567e19)
    assert (got["m2", STATE]["resolution_status"], got["m2", STATE]["structure_resolution"]) == ("unresolved", "no_valid_structure")
    # a source state outranks the action id and the control key
    assert (got["m7", ACTION]["resolution_status"], got["m7", ACTION]["control_uuid"]) == ("resolved_state", "named-child")


def test_bounds_and_counters(spark, tmp_path):
    h = Home(spark, tmp_path / "store", batch_size=2, max_batches=2)
    h.s.append(structure("s1", "2026-09-01", document()))
    h.m += [message(f"m{k}", "2026-09-02", {STATE: k}) for k in range(5)]
    first, second = h.refresh.run(), h.refresh.run()
    assert (first["status"], first["stop_reason"], first["messages_processed"], first["events_inserted"]) == ("partial", "batch_limit", 4, 4)
    assert (second["status"], second["messages_processed"]) == ("succeeded", 1)
    runs = h.refresh.store.read("load_runs").orderBy("started_at").collect()
    assert [r["status"] for r in runs] == ["partial", "succeeded"]
    with pytest.raises(ValueError):
        Limits(batch_size=0)


def test_structure_limit_comes_before_events(spark, tmp_path):
    h = Home(spark, tmp_path / "store", max_structures=1)
    h.s += [structure("s1", "2026-09-01", document()), structure("s2", "2026-09-02", document())]
    h.m.append(message("m1", "2026-09-03", {STATE: 1}))
    out = h.refresh.run()
    assert (out["status"], out["stop_reason"], out["messages_processed"]) == ("partial", "structure_limit", 0)


def test_a_failed_batch_leaves_no_trace_and_commits_are_exclusive(home, monkeypatch):
    home.refresh.run()
    home.m.append(message("m3", "2026-09-06", {STATE: 3}))
    commit = home.refresh.store.commit
    monkeypatch.setattr(home.refresh.store, "commit", lambda n, tables, **k: commit(n, tables, **k) if "load_runs" in tables else (_ for _ in ()).throw(OSError("disk")))
    with pytest.raises(OSError):
        home.refresh.run()
    monkeypatch.undo()
    assert home.rows("message_id") == [("m1",), ("m2",)]
    assert home.refresh.store.read("load_runs").where("status = 'failed' AND error_message = 'OSError'").count() == 1
    assert home.refresh.run()["messages_processed"] == 1
    n = home.refresh.store.next_number()
    home.refresh.store.commit(n, [])
    with pytest.raises(ConcurrentCommit):
        home.refresh.store.commit(n, [])


def test_missing_source_fails(spark, tmp_path):
    h = Home(spark, tmp_path / "store")
    h.refresh.messages = lambda: spark.read.parquet(str(tmp_path / "nowhere"))
    with pytest.raises(Exception):
        h.refresh.run()


def test_marts(home):
    home.m.append(message("m4", "2026-09-05", {"unknown": None, STATE: 3}))
    home.refresh.run()
    e = home.refresh.store.events()
    top = {r["state_uuid"]: r for r in marts.current_state(e).collect()}
    assert top[STATE]["value_numeric"] == 3.0 and top[STATE]["last_received_at"] == at("2026-09-05").replace(tzinfo=None)
    hours = {(r["state_uuid"], r["hour_utc"].day): r for r in marts.hourly_state(e).collect()}
    r = hours[STATE, 5]
    assert (r["event_count"], r["numeric_avg"], r["numeric_first"], r["numeric_last"]) == (2, 2.5, 2.0, 3.0)
    assert (hours["unknown", 5]["numeric_count"], hours["unknown", 5]["numeric_first"]) == (0, None)
    hint = {r["state_uuid"]: r["retention_class"] for r in marts.retention_hints(e).collect()}
    assert hint == {STATE: "live_value"}
    assert [r["state_uuid"] for r in marts.unresolved_states(e).collect()] == ["unknown"]
    from tidemark.operators.mapping import conflicts
    maps = home.refresh.store.read("state_uuid_map")
    q = {r["metric"]: r for r in marts.data_quality(e, conflicts(maps), home.refresh.store.read("structure_versions"), home.refresh.structures()).collect()}
    assert len(q) == 14
    assert (q["silver_events"]["value_numeric"], q["unresolved_events"]["value_numeric"], q["resolved_percent"]["value_numeric"]) == (4.0, 1.0, 75.0)
    assert q["max_event_time_utc"]["value_text"] == "2026-09-05 00:00:00+00"


def test_batches_look_at_what_is_new_only(spark, tmp_path):
    """After catching up, messages before the frontier are not looked at, but those
    of a source with a newer structure are."""
    h = Home(spark, tmp_path / "store", batch_size=3, max_batches=9, recheck=False, slack_seconds=1)
    h.s.append(structure("s1", "2026-09-01", document()))
    h.m += [message(f"m{k}", f"2026-09-{k + 2:02d}", {STATE: k}) for k in range(7)]
    assert h.refresh.run()["messages_processed"] == 7
    m = messages(spark, h.m)
    assert h.refresh.recent()(m).count() == 1 and h.refresh.recent(whole=True)(m).count() == 7
    h.m += [message("n", "2026-09-20", {STATE: 8}), message("old", "2026-09-02", {STATE: 9})]
    assert h.refresh.run()["messages_processed"] == 1  # the one that claims to be old waits for a look at everything
    h.refresh.limits = Limits(batch_size=3)
    assert h.refresh.run()["messages_processed"] == 1
    h.s.append(structure("s2", "2026-09-05", document("New")))
    h.s.append(structure("o1", "2026-09-05", document(), source="other"))
    h.refresh.limits = Limits(batch_size=3, recheck=False)
    assert h.refresh.run()["messages_processed"] == 5
    before = h.rows("message_id", "control_name")
    h.refresh.store.compact()
    assert h.refresh.store.vacuum() > 0
    assert h.rows("message_id", "control_name") == before and len(h.refresh.store.commits()) == 1
    assert h.refresh.run()["messages_processed"] == 0
    assert not [p for p in h.refresh.store.files.list(f"{h.refresh.store.root}/_batch")]
