from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import capture
from tidemark.functions import json_kind, local_time, number_of, object_size, string_of
from tidemark.operators import asof, keys, reports

T = lambda h: datetime(2026, 1, 1, h)


def test_asof_ties_fallback_and_both_ways(spark):
    dim = spark.createDataFrame([("a", T(2), "v1"), ("a", T(4), "v2"), ("a", T(4), "v3"), ("b", T(9), "w")], "k string, at timestamp, v string")
    facts = spark.createDataFrame([(1, "a", T(1)), (2, "a", T(2)), (3, "a", T(3)), (4, "a", T(4)), (5, "a", T(8)), (6, "b", T(1)), (7, "c", T(1)), (8, None, T(1)), (5, "a", T(8))], "i int, k string, t timestamp")
    want = [(1, "v1"), (2, "v1"), (3, "v1"), (4, "v3"), (5, "v3"), (5, "v3"), (6, "w"), (7, None), (8, None)]
    for f in (asof.asof, asof.merged):
        assert sorted((r["i"], r["v"]) for r in f(facts, dim, "k", "t", "at", "v", ["v"]).collect()) == want
    assert asof.asof(facts.limit(0), dim, "k", "t", "at", "v", ["v"]).count() == 0


def test_asof_forms_agree_on_number_ties_and_missing_times(spark):
    dim = spark.createDataFrame(
        [(7, T(2), 9), (7, T(2), 10), (7, None, 11), (8, T(3), 1), (9, None, 5), (6, T(1), None), (6, T(1), 2), (6, T(5), 100), (6, T(5), 20), (None, T(1), 77)],
        "k int, at timestamp, v int")
    times = [T(1), T(2), T(4), T(9), None]
    facts = spark.createDataFrame([(100 * k + n, k, t) for k in (5, 6, 7, 8, 9) for n, t in enumerate(times)] + [(1, None, T(3))], "i int, k int, t timestamp")
    want = {1: None} | {500 + n: None for n in range(5)} | dict(zip(range(600, 605), (None, None, None, 100, None)))
    want |= dict(zip(range(700, 705), (9, 10, 10, 10, None))) | {800 + n: 1 for n in range(5)} | {900 + n: 5 for n in range(5)}
    got = [{r["i"]: r["v"] for r in f(facts, dim, "k", "t", "at", "v", ["v"]).collect()} for f in (asof.asof, asof.merged)]
    assert got[0] == got[1] == want


def test_many_versions_of_a_key_are_merged(spark):
    at = F.timestamp_seconds(F.col("id") * 60)
    dim = spark.range(0, 100_000).select(F.lit("a").alias("k"), at.alias("at"), F.col("id").alias("v"))
    facts = spark.range(0, 100_000, 7).select(F.col("id").alias("i"), F.lit("a").alias("k"), F.timestamp_seconds(F.col("id") * 60 + 30).alias("t"))
    out = asof.asof(facts, dim, "k", "t", "at", "v", ["v"])
    assert out.where("v = i").count() == facts.count() == out.count()


def test_large_dimension_takes_the_merge(spark, monkeypatch):
    monkeypatch.setattr(asof, "BROADCAST_ROWS", 0)
    dim = spark.createDataFrame([("a", datetime(2026, 1, 1), "v1"), ("a", datetime(2026, 1, 3), "v2")], "k string, at timestamp, v string")
    facts = spark.createDataFrame([(n, "a", datetime(2025, 12, 30) + timedelta(days=n)) for n in range(8)], "i int, k string, t timestamp")
    assert sorted((r["i"], r["v"]) for r in asof.asof(facts, dim, "k", "t", "at", "v", ["v"]).collect()) == [(n, "v1" if n < 4 else "v2") for n in range(8)]


def test_keys(spark):
    d = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", None, "y"), (None, 3, "z"), (None, 1, "q")], "k string, n int, v string")
    assert sorted((str(r["k"]), r["v"]) for r in keys.newest(d, ["k"], ["n"]).collect()) == [("None", "z"), ("a", None), ("b", "y")]
    some = spark.createDataFrame([(None,), ("b",)], "k string")
    assert sorted(str(r["k"]) for r in keys.within(d, some, ["k"]).collect()) == ["None", "None", "b"]
    assert [r["k"] for r in keys.without(d, some, ["k"]).collect()] == ["a", "a"]
    new = spark.createDataFrame([("a", 9, "n"), ("c", 2, "late"), ("c", 1, "first")], "k string, n int, v string")
    assert [tuple(r) for r in keys.insert_or_ignore(d, new, ["k"], ["n"]).collect()] == [("c", 1, "first")]
    assert sorted((str(r["k"]), r["n"]) for r in keys.replace(d, new.where("k = 'a'"), ["k"]).collect() if r["k"]) == [("a", 9), ("b", None)]
    b = spark.createDataFrame([("m", 1, "old"), ("m", 2, "p"), ("m", 2, "q")], "k string, b int, v string")
    assert sorted(r["v"] for r in keys.newest_batches(b, ["k"], "b").collect()) == ["p", "q"]


def test_json_and_time(spark):
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    rows = [("1",), ("1.5",), ('"x"',), ("true",), ("null",), ("[1]",), ('{"a":1,"a":2}',), ("12345678901234567890",)]
    v = F.parse_json("t")
    got = [tuple(r) for r in spark.createDataFrame(rows, "t string").select(json_kind(v), number_of(v), string_of(v)).collect()]
    assert got == [("NUMBER", 1.0, None), ("NUMBER", 1.5, None), ("STRING", None, "x"), ("BOOLEAN", 1.0, None), ("VOID", None, None), ("ARRAY", None, None), ("OBJECT", None, None), ("NUMBER", 1.2345678901234567e19, None)]
    assert [r[0] for r in spark.createDataFrame([('{"c":{"a":1,"b":2}}',), ('{"c":[]}',), ("{}",), ("bad",), (None,)], "t string").select(object_size(F.col("t"), "$.c")).collect()] == [2, None, None, None, None]
    hours = spark.sql("SELECT explode(array(timestamp '2026-10-25 00:30:00Z', timestamp '2026-10-25 01:30:00Z', timestamp '2026-07-01 12:00:00Z')) AS t").select(local_time(F.col("t"))).collect()
    assert [str(r[0]) for r in hours] == ["2026-10-25 02:30:00", "2026-10-25 02:30:00", "2026-07-01 14:00:00"]


def test_report(spark):
    now = datetime(2026, 9, 22, 12, tzinfo=UTC)
    rows = [(now - timedelta(minutes=30), now - timedelta(minutes=5) if k < 100 else None) for k in range(120)]
    d = spark.createDataFrame(rows, "received_at timestamp, uploaded_at timestamp")
    r = reports.upload_report(d, now, 10)
    assert (r["pending"], r["uploaded"], r["received"], r["upload_per_second"], r["eta_hours"], r["catches_up_within_12h"]) == (20, 100, 0, 0.167, 0.03, True)
    assert reports.upload_report(d, now, 10, 323_000)["eta_hours"] is None
    assert reports.upload_report(d.where("uploaded_at IS NOT NULL"), now, 10)["eta_hours"] == 0.0
    status = reports.spool_status(d).first().asDict()
    assert (status["pending"], status["total"]) == (20, 120)


def test_health():
    now = datetime(2026, 9, 22, 12)
    ok = {"latest": now - timedelta(minutes=10), "pending": 100_000, "oldest_pending": now - timedelta(minutes=30)}
    assert reports.health(ok, now) == []
    assert reports.health(ok | {"latest": None}, now) == ["collector_stale"]
    bad = ok | {"pending": 100_001, "latest": now - timedelta(minutes=11)}
    assert reports.health(bad, now) == ["collector_stale", "upload_backlog"]
    assert reports.health(bad, now, check_backlog=False) == ["collector_stale"]


def test_capture():
    assert capture.compact_json({"b": b"\xff", "a": (1, {2: "ü"}), "t": b"x"}) == '{"a":[1,{"2":"ü"}],"b":{"__bytes_b64":"/w=="},"t":"x"}'
    now = datetime(2026, 1, 1, tzinfo=UTC)
    assert '"parsed"' in capture.envelope(b"x", 2, {"a": 1}, now) and '"parsed"' not in capture.envelope("x", 5, {"a": 1}, now)
    with pytest.raises(ValueError):
        capture.structure_row("home", "{}")
    text = '{"controls":{"a":{}},"lastModified":"","p":"%s"}' % ("x" * 1000)
    row = capture.structure_row("home", text, now=now)
    assert row["structure_id"].startswith("home:") and row["last_modified"] == "" and row["payload_json"] == text
    with pytest.raises(ValueError):
        capture.structure_row("home", text, status=500)
