import json
import sqlite3

import pytest
from fixtures import at, document, message, messages, structure, structures

from tidemark import cli, sources
from tidemark.plans.upload import Uploader, UploadLimits


def test_batches_limits_and_idempotence(spark, tmp_path):
    rows = [message(f"m{k}", f"2026-01-0{k + 1}", {"x": k}) for k in range(5)]
    s = [structure("s1", "2026-01-01", document(), modified=""), structure("s2", "2026-01-02", document())]
    spools = {"ws_messages": lambda: messages(spark, rows).drop("ingested_at"), "structures": lambda: structures(spark, s)}
    up = Uploader(spark, str(tmp_path / "b"), spools, UploadLimits(batch_size=2, max_batches=3))
    assert up.run() == {"uploaded": {"ws_messages": 4, "structures": 2}, "batches": 3, "stop_reason": "batch_limit"}
    assert sorted(r["message_id"] for r in up.bronze("ws_messages").collect()) == ["m0", "m1", "m2", "m3"]
    rows.append(message("m0", "2026-02-01", {"x": "changed"}))
    assert up.run() == {"uploaded": {"ws_messages": 1, "structures": 0}, "batches": 1, "stop_reason": "caught_up"}
    got = {r["message_id"]: r for r in up.bronze("ws_messages").collect()}
    assert len(got) == 5 and got["m0"]["payload_json"] == json.dumps({"parsed": {"x": 0}}) and got["m0"]["ingested_at"]
    assert {r["last_modified"] for r in up.bronze("structures").collect()} == {"", None}


def test_an_invalid_row_stops_its_batch_whole(spark, tmp_path):
    rows = [message("a", "2026-01-01", {}), message("b", "2026-01-02", "{no json")]
    up = Uploader(spark, str(tmp_path / "b"), {"ws_messages": lambda: messages(spark, rows)})
    for n in (1, 2):
        with pytest.raises(Exception):
            up.run()
        told = json.loads(up.store.files.read(f"{up.store.root}/_failures.json"))
        assert told["attempts"] == n and "{" not in told["last_error"]
    assert up.bronze("ws_messages").count() == 0
    rows.pop()
    assert up.run()["uploaded"]["ws_messages"] == 1
    with pytest.raises(ValueError):
        UploadLimits(batch_size=0)


def spool(path, n=1, documents=0):
    con = sqlite3.connect(path)
    more = "upload_attempts INTEGER DEFAULT 0, last_upload_error TEXT"
    for table, ddl in (("ws_messages", cli.SPOOL), ("structures", cli.STRUCTURES + ", uploaded_at timestamp")):
        cols = [c.split()[0] for c in ddl.split(", ")]
        con.execute(f"CREATE TABLE {table}({', '.join(cols)}, {more})")
    for k in range(n):
        con.execute("INSERT INTO ws_messages VALUES (?,?,?,?,?,?,?,?,?,?,0,NULL)", (f"m{k}", "home", "r", at("2026-01-01").isoformat(), 2, "json", "{}" + " " * 98, "x", "1", None))
    for k in range(documents):
        con.execute("INSERT INTO structures VALUES (?,?,?,?,?,?,?,?,0,NULL)", (f"s{k}", "home", at("2026-01-01").isoformat(), None, document(), "x", "1", None))
    con.commit()
    return con


def test_command_line(spark, tmp_path, capsys):
    con, told = spool(tmp_path / "s.db", 1, 2), lambda: json.loads(capsys.readouterr().out.splitlines()[-1])
    path = str(tmp_path / "s.db")
    assert cli.main(["report", "--spool", path]) == 0
    assert told()["pending"] == 1
    assert cli.main(["health", "--spool", path]) == 1
    assert cli.main(["health", "--spool", str(tmp_path / "none.db")]) == 2
    assert cli.main(["upload", "--spool", path, "--store", str(tmp_path / "bronze")]) == 0
    assert told()["uploaded"] == {"ws_messages": 1, "structures": 2}
    assert con.execute("SELECT count(*) FROM structures WHERE uploaded_at IS NULL").fetchone()[0] == 0
    assert cli.main(["archive", "--spool", path, "--archive", str(tmp_path / "archive")]) == 0
    assert told() == {"structures": {"archived_upto": 2, "batches": 1}, "ws_messages": {"archived_upto": 1, "batches": 1}}
    assert cli.identifier("ok_1") == "ok_1"
    with pytest.raises(ValueError):
        cli.identifier("a; drop")


def test_outcomes_by_row(spark, tmp_path):
    con, path = spool(tmp_path / "s.db", 600), str(tmp_path / "s.db")
    ids = [f"m{k}" for k in range(600)]
    assert sources.note_failed(path, "ws_messages", "message_id", ids[:300], "x" * 3000) == 300
    assert sources.note_uploaded(path, "ws_messages", "message_id", ids[:10]) == 10
    assert sources.note_failed(path, "ws_messages", "message_id", ids[:20], "again") == 10
    got = dict(con.execute("SELECT upload_attempts, count(*) FROM ws_messages GROUP BY 1").fetchall())
    assert got == {0: 300, 1: 290, 2: 10}
    assert con.execute("SELECT max(length(last_upload_error)) FROM ws_messages").fetchone()[0] == 2000
    seen = []
    up = Uploader(spark, str(tmp_path / "b"), {"ws_messages": lambda: messages(spark, [message("a", "2026-01-01", {}), message("b", "2026-01-02", "{no")])}, outcome=lambda *x: seen.append(x))
    with pytest.raises(Exception):
        up.run()
    assert [(t, sorted(k)) for t, k, _ in seen] == [("ws_messages", ["a", "b"])] and "{" not in seen[0][2]


def test_batches_are_bounded_by_bytes(spark, tmp_path):
    spool(tmp_path / "s.db", 10)
    path, schema = str(tmp_path / "s.db"), "row_id long, message_id string, payload_json string"
    sources.register(spark)
    s = spark.readStream.format("spool").schema(schema).option("path", path).option("table", "ws_messages").option("maxBytes", "350").load()
    sizes = []
    q = s.writeStream.foreachBatch(lambda b, n: sizes.append(b.count())).option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert sum(sizes) == 10 and max(sizes) == 3
    rows = lambda after: sources.read_spool(spark, path, "ws_messages", f"{schema}, received_at timestamp", after)
    root = str(tmp_path / "archive")
    assert sources.archive_spool(rows, root, "ws_messages", "received_at", max_bytes=450, max_batches=2) == {"batches": 2, "archived_upto": 8}
    assert sources.archive_spool(rows, root, "ws_messages", "received_at", max_bytes=1) == {"batches": 2, "archived_upto": 10}
    # a damaged file is found by its digest
    manifest = json.loads(next((tmp_path / "archive/_manifests").glob("*8.json")).read_text())
    assert not sources.damaged(spark, manifest)
    part = tmp_path / "archive" / "ws_messages" / manifest["path"].rsplit("/", 1)[-1] / manifest["files"][0]["name"]
    part.write_bytes(part.read_bytes()[:-1] + b"?")
    assert sources.damaged(spark, manifest)
