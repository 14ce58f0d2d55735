"""Queries that run whole flows on the driver tables: sources and sinks written
and read back, the refresh, the upload, the outbox and its publication. Each has
the SQL of the rows that must come out. Flows write below the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from datetime import UTC, datetime
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import Files
from ..operators import marts
from ..operators.keys import expired
from ..sources import archived_messages, read_ndjson, stream_ndjson, write_archive
from ..streaming.ingest import hourly_stream, land
from .publish import Outbox, Target, publish
from .queries import query, t
from .refresh import Limits, Refresh
from .retention import prune_archive, prune_uploaded
from .store import Store
from .upload import Uploader, UploadLimits


def folder(spark: SparkSession, name: str) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="tidemark-flow-")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def _iso(c: str):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def _messages(spark: SparkSession, d: str) -> DataFrame:
    """A message per event: its payload has one state, its kind, given twice."""
    number = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    payload = F.concat(
        F.lit('{"parsed":{"s-'), "event_type", F.lit('":'), number(-F.col("event_id")), F.lit(',"s-'), F.col("event_type"), F.lit('":'), number(F.col("event_id")), F.lit(',"extra":{"a":['), number(F.col("user_id")), F.lit("]}}}")
    )
    at = F.col("ts").cast("timestamp")
    return t(spark, d, "events").select(
        F.col("event_id").cast("string").alias("message_id"), F.concat(F.lit("src"), (F.col("user_id") % 7).cast("string")).alias("source_id"), F.lit("run").alias("run_id"), at.alias("received_at"),
        F.when(F.col("event_id") % 10 == 0, 90).otherwise(2).alias("message_type"), F.lit("json").alias("payload_format"), payload.alias("payload_json"), F.sha2(payload, 256).alias("payload_sha256"), F.lit("1").alias("collector_version"), at.alias("ingested_at"),
    )


def _structures(spark: SparkSession, d: str) -> DataFrame:
    """Documents of six sources: two versions each, the second naming all states
    anew; one of them is too short to be valid."""
    kinds = [F.concat(F.lit(f'"c-{k}":{{"name":"{k} '), "v", F.lit(f'","type":"T","states":{{"value":"s-{k}"}}}}')) for k in ("click", "error", "purchase", "view")]
    body = F.concat(F.lit('{"controls":{'), F.concat_ws(",", *kinds), F.lit('},"rooms":{},"cats":{},"padding":"'), F.when(F.col("n") == 5, "").otherwise("x" * 1100), F.lit('"}'))
    two = t(spark, d, "region").select(F.col("r_regionkey").alias("n")).unionByName(spark.range(5, 6).select(F.col("id").alias("n"))).withColumn("v", F.explode(F.array(F.lit("one"), F.lit("two"))))
    at = F.when(F.col("v") == "one", F.lit("2024-01-05")).otherwise(F.lit("2024-01-15")).cast("timestamp")
    return two.select(
        F.concat("v", F.lit("-"), F.col("n").cast("string")).alias("structure_id"), F.concat(F.lit("src"), F.col("n").cast("string")).alias("source_id"), at.alias("captured_at"), F.lit(None).cast("string").alias("last_modified"),
        body.alias("payload_json"), F.sha2(body, 256).alias("payload_sha256"), F.lit("1").alias("collector_version"), at.alias("ingested_at"),
    )


#: What a refresh over these messages and documents must yield: eligible messages,
#: the version of their time or else the first, names for four of five states.
_EVENTS = """SELECT event_id::VARCHAR AS message_id, 'src' || (user_id % 7) AS source_id, 's-' || event_type AS state_uuid, event_id::DOUBLE AS value_numeric, ts AS received_at,
  CASE WHEN user_id % 7 < 5 THEN CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN 'two' ELSE 'one' END || '-' || (user_id % 7) END AS structure_id,
  CASE WHEN user_id % 7 >= 5 THEN 'no_valid_structure' WHEN ts < TIMESTAMP '2024-01-05' THEN 'fallback_earliest' ELSE 'asof' END AS structure_resolution,
  CASE WHEN user_id % 7 < 5 AND event_type <> 'signup' THEN event_type || CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN ' two' ELSE ' one' END END AS control_name,
  CASE WHEN user_id % 7 < 5 AND event_type <> 'signup' THEN 'resolved_state' ELSE 'unresolved' END AS resolution_status
FROM events WHERE event_id % 10 <> 0"""
_COLS = ["message_id", "source_id", "state_uuid", "value_numeric", "received_at", "structure_id", "structure_resolution", "control_name", "resolution_status"]


def _naive(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def _once(flow):
    """A flow that queries only read from runs once in an application."""
    kept = {}

    @wraps(flow)
    def run(spark: SparkSession, d: str):
        key = (spark.sparkContext.applicationId, d)
        if key not in kept or not Files(spark).exists(kept[key].root):
            kept[key] = flow(spark, d)
        return kept[key]

    return run


def _refresh(spark: SparkSession, d: str, batches: int = 3) -> Store:
    """The refresh of all messages in a few batches, run until it has caught up;
    structures' second versions come late and replay what they explain."""
    m, s = _messages(spark, d), _structures(spark, d)
    size = max(1, -(-m.count() // batches))
    now = {"structures": s.where("structure_id LIKE 'one%'")}
    r = Refresh(spark, folder(spark, "store"), lambda: m, lambda: now["structures"], Limits(batch_size=size, max_batches=batches + 2, structures_per_batch=4))
    r.run()
    now["structures"] = s
    r.run()
    return r.store


_refreshed = _once(_refresh)


@query(_EVENTS)
def refresh_events(spark, d):
    """Bounded batches, late structures and replay; of repeated keys the last counts."""
    e = _refreshed(spark, d).events().where("state_uuid <> 'extra'")
    return _naive(e.select(*_COLS), "received_at")


@query("""SELECT 'succeeded' AS status, count(*)::BIGINT AS messages, (count(*) * 2)::BIGINT AS events, 5::BIGINT AS structures, 20::BIGINT AS mappings, max(ts) AS top FROM events WHERE event_id % 10 <> 0
UNION ALL SELECT 'succeeded', count(*), count(*) * 2, 5, 20, max(ts) FROM events WHERE event_id % 10 <> 0 AND user_id % 7 < 5 AND ts >= TIMESTAMP '2024-01-15'""")
def refresh_runs(spark, d):
    """The runs' own log: what each processed, loaded and reached. Every control
    gives two meanings, its state and its key."""
    runs = _refreshed(spark, d).read("load_runs")
    return _naive(runs.select(
        "status", F.col("messages_processed").alias("messages"), F.col("events_inserted").alias("events"), F.col("structures_loaded").alias("structures"),
        (F.col("mappings_loaded") / 2).cast("long").alias("mappings"), F.col("source_max_ingested_at").alias("top")), "top")


@query(f"""SELECT source_id, message_id, structure_id FROM ({_EVENTS})""")
def refresh_ledger(spark, d):
    """The ledger after compaction and the removal of what it replaced."""
    store = _refresh(spark, d)
    store.compact()
    store.vacuum()
    return store.ledger().select("source_id", "message_id", "structure_id")


@query("SELECT event_id::VARCHAR AS message_id, 'src' || (user_id % 7) AS source_id, ts AS received_at, 2::BIGINT AS version FROM events WHERE event_id % 3 = 0 UNION ALL SELECT event_id::VARCHAR, 'src' || (user_id % 7), ts, 1 FROM events WHERE event_id % 3 <> 0")
def archive_round_trip(spark, d):
    """An archive in two batches, the second with newer ingestions of a third of the
    messages; a batch written again changes nothing."""
    root, m = folder(spark, "archive"), _messages(spark, d).withColumn("collector_version", F.lit("1"))
    again = m.where(F.col("message_id").cast("long") % 3 == 0).withColumns({"collector_version": F.lit("2"), "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 DAY")})
    write_archive(m, root, "ws_messages", 1, 10)
    write_archive(again, root, "ws_messages", 11, 20)
    write_archive(again.limit(0), root, "ws_messages", 11, 20)
    return _naive(archived_messages(spark, root).select("message_id", "source_id", "received_at", F.col("collector_version").cast("long").alias("version")), "received_at")


@query("SELECT event_id, user_id, ts AS at, event_type AS kind, value FROM events")
def ndjson_round_trip(spark, d):
    path = folder(spark, "ndjson")
    e = t(spark, d, "events").select("event_id", "user_id", F.col("ts").alias("at"), F.col("event_type").alias("kind"), "value")
    e.withColumn("at", _iso("at")).write.json(path)
    return read_ndjson(spark, path, "event_id long, user_id long, at timestamp_ntz, kind string, value double")


@query("SELECT event_id::VARCHAR AS message_id, 'src' || (user_id % 7) AS source_id, sha256('{\"parsed\":{\"s-' || event_type || '\":' || (-event_id) || ',\"s-' || event_type || '\":' || event_id || ',\"extra\":{\"a\":[' || user_id || ']}}}') AS sha FROM events")
def upload_bronze(spark, d):
    """A spool uploaded in bounded batches, twice; the text is kept byte for byte."""
    m = _messages(spark, d)
    size = max(1, -(-m.count() // 3))
    up = Uploader(spark, folder(spark, "bronze"), {"ws_messages": lambda: m}, UploadLimits(batch_size=size, max_batches=2))
    while up.run()["stop_reason"] != "caught_up":
        pass
    up.run()
    return up.bronze("ws_messages").select("message_id", "source_id", F.sha2("payload_json", 256).alias("sha"))


@_once
def _published(spark: SparkSession, d: str) -> Target:
    """Three outbox batches, the last of which replaces a fifth of the messages, are
    published together, then once more."""
    e = _refreshed(spark, d).events().where("state_uuid <> 'extra'")
    number = F.col("message_id").cast("long")
    first, second = e.where(number % 2 == 0), e.where(number % 2 == 1)
    changed = e.where(number % 5 == 0).withColumns({"value_numeric": -F.col("value_numeric"), "loaded_at": F.col("loaded_at") + F.expr("INTERVAL 1 DAY")})
    rest = e.where(number % 5 != 0)
    out, target = Outbox(spark, folder(spark, "outbox")), Target(spark, folder(spark, "target"))
    keys = ["source_id", "message_id"]
    for n, (new, known) in enumerate(((first, first), (second, e), (changed, rest.unionByName(changed))), 1):
        out.export(n, new.select(*keys).distinct(), new, known)
    publish(out, target, max_batches=2)
    publish(out, target)
    publish(out, target)
    return target


_PUBLISHED = f"SELECT * REPLACE (CASE WHEN message_id::BIGINT % 5 = 0 THEN -value_numeric ELSE value_numeric END AS value_numeric) FROM ({_EVENTS})"


@query(f"SELECT message_id, source_id, state_uuid, value_numeric, resolution_status FROM ({_PUBLISHED})")
def publish_events(spark, d):
    return _published(spark, d).table("state_events").select("message_id", "source_id", "state_uuid", "value_numeric", "resolution_status")


@query(f"""SELECT source_id, state_uuid, received_at AS last_received_at, value_numeric FROM ({_PUBLISHED})
QUALIFY row_number() OVER (PARTITION BY source_id, state_uuid ORDER BY received_at DESC, message_id DESC) = 1""")
def publish_current(spark, d):
    return _naive(_published(spark, d).table("current_state").select("source_id", "state_uuid", "last_received_at", "value_numeric"), "last_received_at")


@query(f"""SELECT source_id, state_uuid, date_trunc('hour', received_at)::TIMESTAMP AS hour_utc, count(*) AS event_count, min(value_numeric) AS numeric_min, max(value_numeric) AS numeric_max FROM ({_PUBLISHED}) GROUP BY ALL""")
def publish_hours(spark, d):
    return _naive(_published(spark, d).table("hourly_state").select("source_id", "state_uuid", "hour_utc", "event_count", "numeric_min", "numeric_max"), "hour_utc")


@query("SELECT event_id, user_id, ts FROM events")
def stream_landing(spark, d):
    """A stream lands the table's rows twice from two files; each stays once."""
    root = folder(spark, "landing")
    e = t(spark, d, "events").select("event_id", "user_id", "ts")
    for part in ("a", "b"):
        e.withColumn("ts", _iso("ts")).repartition(2).write.mode("append").json(f"{root}/in")
    stream = stream_ndjson(spark, f"{root}/in", "event_id long, user_id long, ts timestamp_ntz", files_per_trigger=2)
    land(stream, f"{root}/out", f"{root}/ckpt", ["event_id"], at="ts").awaitTermination()
    return spark.read.schema("event_id long, user_id long, ts timestamp_ntz").parquet(f"{root}/out").select("event_id", "user_id", "ts")


@query("""SELECT * FROM (SELECT user_id, date_trunc('hour', ts)::TIMESTAMP AS hour_utc, count(*) AS event_count, count(value) AS numeric_count FROM events GROUP BY 1, 2)
WHERE hour_utc + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)""")
def stream_hours(spark, d):
    """Final hours of a stream, those that the watermark has passed."""
    root = folder(spark, "hours")
    schema = t(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d).withColumn("ts", F.col("ts").cast("timestamp"))
    q = hourly_stream(stream, ["user_id"], "ts", "value").writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start()
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    return _naive(out.select("user_id", "hour_utc", "event_count", "numeric_count"), "hour_utc")


@query("""SELECT event_id FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-10' AND event_id % 4 <> 0 AND event_id % 5 <> 0)""")
def archive_retention(spark, d):
    """What stays of an archive: young rows, those not processed, those queued."""
    e = t(spark, d, "events").select("event_id", F.col("event_id").cast("string").alias("message_id"), F.lit("s").alias("source_id"), F.col("ts").cast("timestamp").alias("received_at"))
    n = e.count()
    return prune_archive(e, utc("2024-01-10"), e.where("event_id % 4 <> 0"), e.where("event_id % 5 = 0"), n, n, n).select("event_id")


@query("""SELECT event_id FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-10' AND event_id % 5 <> 0 AND event_id <= 4000)""")
def spool_retention(spark, d):
    """What stays of a spool: rows not uploaded, young ones, those beyond a
    checkpoint."""
    at = F.col("ts").cast("timestamp")
    e = t(spark, d, "events").select("event_id", F.col("event_id").alias("row_id"), F.when(F.col("event_id") % 5 != 0, at).alias("uploaded_at"))
    return prune_uploaded(e, utc("2024-01-10"), e.count(), [4000, 9000]).select("event_id")


@query("SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-10' AND event_id % 4 <> 0 AND event_id % 5 <> 0")
def store_delete_expired(spark, d):
    """The rows that a stored table loses when the expired are deleted from it."""
    root = folder(spark, "expire")
    store = Store(spark, root, {"rows": "source_id string, message_id string, event_id long, received_at timestamp"})
    e = t(spark, d, "events").select(F.lit("s").alias("source_id"), F.col("event_id").cast("string").alias("message_id"), "event_id", F.col("ts").cast("timestamp").alias("received_at"))
    for part in (0, 1):
        n = store.next_number()
        store.write(n, "rows", e.where(F.col("event_id") % 2 == part))
        store.commit(n, ["rows"])
    gone = expired(store.read("rows"), "received_at", F.lit(utc("2024-01-10")), e.where("event_id % 4 <> 0"), e.where("event_id % 5 = 0"), ["source_id", "message_id"])
    store.delete("rows", gone, ["source_id", "message_id"])
    return e.join(store.read("rows").select("event_id"), "event_id", "left_anti").select("event_id")


@query("SELECT unnest(['current_state', 'data_quality', 'hourly_state', 'mapping_conflicts', 'retention_hints', 'state_events', 'unresolved_states']) AS view, unnest([17, 3, 10, 6, 7, 27, 7])::BIGINT AS columns")
def registered_views(spark, d):
    """The views that a SQL user finds, with their numbers of columns."""
    store = _refreshed(spark, d)
    names = marts.register_views(spark, store.events(), store.read("state_uuid_map"), store.read("structure_versions"), _structures(spark, d), "tm_")
    known = {x.name for x in spark.catalog.listTables()}
    return spark.createDataFrame([(n.removeprefix("tm_"), len(spark.table(n).columns)) for n in names if n in known], "view string, columns long")


@query("SELECT count(*) AS events, (SELECT count(*) FROM events) AS rows_read, 1::BIGINT AS files FROM events")
def file_digests(spark, d):
    """A manifest names each file with its SHA-256, which is checked on reading."""
    root = folder(spark, "digests")
    e = t(spark, d, "events").withColumn("received_at", F.lit("2024-01-01").cast("timestamp"))
    m = write_archive(e.coalesce(1), root, "ws_messages", 1, 2)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(m["path"]).select(F.sha2("content", 256).alias("sha"))
    same = files.where(F.col("sha").isin([f["sha256"] for f in m["files"]])).count()
    assert Files(spark).exists(m["path"])
    return spark.range(1).select(F.lit(m["rows"]).cast("long").alias("events"), F.lit(e.count()).alias("rows_read"), F.lit(same).cast("long").alias("files"))
