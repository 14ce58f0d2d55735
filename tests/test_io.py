import json
import sqlite3
from datetime import datetime, timedelta

import pytest
from fixtures import STATE, at, document, message, messages, structure, structures

from tidemark import schemas
from tidemark.plans import retention
from tidemark.plans.publish import CorruptBatch, Outbox, Target, publish
from tidemark.plans.refresh import Refresh
from tidemark.sources import archived_messages, read_ndjson, read_spool, register, stream_ndjson, validated, write_archive
from tidemark.streaming.ingest import land, latest_snapshot, latest_stream


def test_exact_text_and_bad_rows(spark, tmp_path):
    text = '{\n "ü": "a\\"b", "n": 12345678901234567890, "z": null }'
    (tmp_path / "a.json").write_text(json.dumps({"message_id": "1", "payload_json": text, "last": ""}) + "\n" + json.dumps({"message_id": "2", "payload_json": None}) + "\n")
    d = validated(read_ndjson(spark, str(tmp_path / "a.json"), "message_id string, payload_json string, last string"))
    assert [tuple(r) for r in d.orderBy("message_id").collect()] == [("1", text, ""), ("2", None, None)]
    bad = spark.createDataFrame([("{",), ("{}",)], "payload_json string")
    with pytest.raises(Exception, match="invalid JSON"):
        validated(bad).collect()


def test_archive(spark, tmp_path):
    root = str(tmp_path / "archive")
    d = messages(spark, [message("a", "2026-01-01", {}), message("b", "2026-01-02", {})])
    one = write_archive(d, root, "ws_messages", 1, 2)
    assert (one["rows"], one["first"], one["last"]) == (2, 1, 2)
    assert write_archive(d.limit(0), root, "ws_messages", 1, 2) == one
    write_archive(messages(spark, [message("a", "2026-01-01", {"x": 1}, ingested="2026-02-01")]), root, "ws_messages", 3, 3)
    got = {r["message_id"]: r["payload_json"] for r in archived_messages(spark, root).collect()}
    assert set(got) == {"a", "b"} and "x" in got["a"]
    assert [r["message_id"] for r in archived_messages(spark, root, since="2026-01-02").collect()] == ["b"]


def _spool(path):
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE ws_messages(message_id TEXT PRIMARY KEY, received_at TEXT, payload_json TEXT)")
    con.executemany("INSERT INTO ws_messages VALUES (?,?,?)", [(f"m{k}", f"2026-01-01T00:00:{k:02d}+00:00", "{}") for k in range(7)])
    con.commit()
    con.close()


def test_spool_batch_and_stream(spark, tmp_path):
    _spool(tmp_path / "s.db")
    schema = "row_id long, message_id string, received_at timestamp, payload_json string"
    d = read_spool(spark, str(tmp_path / "s.db"), "ws_messages", schema, after=2)
    assert sorted(r["row_id"] for r in d.collect()) == [3, 4, 5, 6, 7]
    register(spark)
    s = spark.readStream.format("spool").schema(schema).option("path", str(tmp_path / "s.db")).option("table", "ws_messages").option("maxRows", "3").load()
    seen = []
    q = s.writeStream.foreachBatch(lambda b, n: seen.append(b.count())).option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert sum(seen) == 7 and max(seen) <= 3
    with pytest.raises(Exception):
        read_spool(spark, str(tmp_path / "none.db"), "ws_messages", schema).collect()
    assert not (tmp_path / "none.db").exists()


def test_landing_and_latest_streams(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    line = lambda i, v, t="2026-01-01T00:00:00Z": json.dumps({"message_id": i, "received_at": t, "payload_json": json.dumps({"v": v})})
    schema = "message_id string, received_at timestamp, payload_json string"
    root, ck = str(tmp_path / "bronze"), str(tmp_path / "ck")
    (src / "1.json").write_text(line("a", 1) + "\n" + line("a", 1) + "\n")
    for _ in range(2):
        land(stream_ndjson(spark, str(src), schema, 1), root, ck, ["message_id"]).awaitTermination()
        (src / "2.json").write_text(line("a", 2) + "\n" + line("b", 3, "2026-01-02T00:00:00Z") + "\n")
    got = {r["message_id"]: r["payload_json"] for r in spark.read.parquet(root).collect()}
    assert got == {"a": '{"v": 1}', "b": '{"v": 3}'}
    latest_stream(stream_ndjson(spark, str(src), schema, 1), str(tmp_path / "l"), str(tmp_path / "lc"), ["message_id"], ["received_at", "payload_json"]).awaitTermination()
    assert {r["message_id"]: r["payload_json"] for r in latest_snapshot(spark, str(tmp_path / "l")).collect()} == {"a": '{"v": 2}', "b": '{"v": 3}'}


def test_publish_replay_and_corruption(spark, tmp_path):
    ms, ss = [message("m1", "2026-09-03", {STATE: 1})], [structure("s1", "2026-09-01", document())]
    r = Refresh(spark, str(tmp_path / "store"), lambda: messages(spark, ms), lambda: structures(spark, ss))
    box, target = Outbox(spark, str(tmp_path / "out")), Target(spark, str(tmp_path / "pub"))

    def export(n, new):
        r.run()
        e = r.store.events()
        box.export(n, messages(spark, new), e.where(e.message_id.isin([m[0] for m in new])), e)

    export(1, ms)
    assert publish(box, target) == {"published": 1, "replayed": 0, "pending": 0}
    ms.append(message("m2", "2026-09-03", {STATE: 5}))
    export(2, ms[1:])
    keep = box.acknowledge
    box.acknowledge = lambda n: None  # the acknowledgement is lost
    publish(box, target)
    box.acknowledge = keep
    ms.append(message("m3", "2026-09-03", {STATE: 4}))
    export(3, ms[2:])
    assert publish(box, target) == {"published": 1, "replayed": 1, "pending": 0}
    assert [r_["value_numeric"] for r_ in target.table("current_state").collect()] == [4.0]
    assert target.table("state_events").count() == 3
    hour = target.table("hourly_state").collect()
    assert [(h["event_count"], h["numeric_last"]) for h in hour] == [(3, 4.0)]
    export(4, ms[2:])
    spark.createDataFrame([(1,)], "x int").write.mode("overwrite").parquet(f"{box.folder(4)}/messages")
    with pytest.raises(CorruptBatch):
        publish(box, target)


def test_retention(spark):
    now = datetime(2026, 1, 10)
    rows = [(k, now - timedelta(days=10 - k)) for k in range(1, 8)]
    d = spark.createDataFrame(rows, "row_id long, uploaded_at timestamp")
    stay = lambda *a: sorted(r["row_id"] for r in retention.prune_uploaded(d, now - timedelta(days=4), *a).collect())
    assert stay(2, [100, 100]) == [3, 4, 5, 6, 7]
    assert stay(100, [3, 100]) == [4, 5, 6, 7]
    assert stay(100, [100, None]) == [1, 2, 3, 4, 5, 6, 7]
    assert retention.checked_cursor(5, 3) == 5
    with pytest.raises(RuntimeError):
        retention.checked_cursor(3, 5)
    a = spark.createDataFrame([("h", "m1", now), ("h", "m2", now), ("h", "m3", now)], "source_id string, message_id string, received_at timestamp")
    done, queued = a.where("message_id <> 'm3'"), a.where("message_id = 'm2'")
    left = retention.prune_archive(a, now + timedelta(1), done, queued, 5, 5, 10)
    assert sorted(r["message_id"] for r in left.collect()) == ["m2", "m3"]
    assert retention.prune_archive(a, now + timedelta(1), done, queued, 4, 5, 10).count() == 3
    assert schemas.PROCESSED and at("2026-01-01")
