"""The query catalogue: every operator applied to the driver tables, each with
the SQL that gives the same rows. In ``events``, event_id is the message, user_id
the source, event_type the state and value the number; a user's ``signup`` events
stand for configuration versions."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import cast_naive, floor_naive, json_kind, local_time, seconds_between, utc_text
from ..operators import mapping, marts
from ..operators.asof import asof, merged, resolution
from ..operators.keys import expired, insert_or_ignore, newest, newest_batches, replace, unprocessed, within, without
from ..operators.reports import lag_quantiles, spool_status
from ..session import configure
from ..streaming.ingest import latest_snapshot, latest_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str, f=f) -> DataFrame:
            return f(configure(spark), sf_dir)

        QUERIES[f.__name__] = run
        SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _versions(spark, d):
    return t(spark, d, "events").where("event_type = 'signup'").select("user_id", F.col("ts").alias("v_at"), F.col("event_id").alias("v_id"))


_ASOF = """WITH v AS (SELECT user_id, ts AS v_at, event_id AS v_id,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to
  FROM events WHERE event_type = 'signup')
SELECT e.event_id, e.user_id, v.v_id, v.v_at, CASE WHEN v.v_id IS NULL THEN 'no_valid_structure' WHEN e.ts < v.v_at THEN 'fallback_earliest' ELSE 'asof' END AS resolution
FROM events e LEFT JOIN v ON v.user_id = e.user_id AND (v.rn = 1 OR e.ts >= v.v_at) AND (v.valid_to IS NULL OR e.ts < v.valid_to)"""


@query(_ASOF)
def asof_resolution(spark, d):
    out = asof(t(spark, d, "events").select("event_id", "user_id", "ts"), _versions(spark, d), "user_id", "ts", "v_at", "v_id", ["v_id", "v_at"])
    return out.select("event_id", "user_id", "v_id", "v_at", resolution("v_id", "ts", "v_at").alias("resolution"))


@query(_ASOF)
def asof_merged(spark, d):
    out = merged(t(spark, d, "events").select("event_id", "user_id", "ts"), _versions(spark, d), "user_id", "ts", "v_at", "v_id", ["v_id", "v_at"])
    return out.select("event_id", "user_id", "v_id", "v_at", resolution("v_id", "ts", "v_at").alias("resolution"))


_LATEST = "SELECT user_id, event_type, event_id, ts, value, props FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"


@query(_LATEST)
def latest_state(spark, d):
    e = t(spark, d, "events").select("user_id", "event_type", "event_id", "ts", "value", "props")
    return newest(e, ["user_id", "event_type"], ["ts", "event_id"])


@query(_LATEST)
def stream_foreachbatch_latest(spark, d):
    """The same by a stream over the table's file."""
    schema = t(spark, d, "events").schema
    root = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="tidemark-stream-")
    import uuid

    root = f"{root}/latest-{uuid.uuid4().hex}"
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    q = latest_stream(stream.select("user_id", "event_type", "event_id", "ts", "value", "props"), f"{root}/data", f"{root}/ckpt", ["user_id", "event_type"], ["ts", "event_id"])
    q.awaitTermination()
    return latest_snapshot(spark, f"{root}/data").select("user_id", "event_type", "event_id", "ts", "value", "props")


@query("""SELECT user_id, event_type, date_trunc('hour', ts)::TIMESTAMP AS hour_utc, count(*) AS event_count, count(x) AS numeric_count,
  round(min(x), 6) AS numeric_min, round(max(x), 6) AS numeric_max, round(avg(x), 6) AS numeric_avg,
  round(arg_min(x, (ts, event_id)), 6) AS numeric_first, round(arg_max(x, (ts, event_id)), 6) AS numeric_last
FROM (SELECT *, CASE WHEN event_id % 7 <> 0 THEN value END AS x FROM events) GROUP BY ALL""")
def hourly_state(spark, d):
    e = t(spark, d, "events").withColumn("x", F.when(F.col("event_id") % 7 != 0, F.col("value")))
    out = marts.hourly_state(e, ("user_id", "event_type"), "ts", "x", ("event_id",))
    num = [F.round(c, 6).alias(c) for c in ("numeric_min", "numeric_max", "numeric_avg", "numeric_first", "numeric_last")]
    return out.select("user_id", "event_type", F.col("hour_utc").cast("timestamp_ntz").alias("hour_utc"), "event_count", "numeric_count", *num)


@query("""SELECT user_id, event_type, date_trunc('hour', ts)::TIMESTAMP AS hour_utc, count(*) AS n FROM events e
WHERE (user_id, event_type, date_trunc('hour', ts)) IN (SELECT user_id, event_type, date_trunc('hour', ts) FROM events WHERE event_id % 50 = 0) GROUP BY ALL""")
def hourly_touched(spark, d):
    e = t(spark, d, "events").withColumn("hour_utc", floor_naive("hour", F.col("ts")))
    new = e.where(F.col("event_id") % 50 == 0)
    return within(e, new, ["user_id", "event_type", "hour_utc"]).groupBy("user_id", "event_type", "hour_utc").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT e.event_id, j.key AS state, CASE WHEN j.type IN ('UBIGINT','BIGINT','DOUBLE') THEN 'NUMBER' WHEN j.type = 'VARCHAR' THEN 'STRING' ELSE j.type END AS kind,
  CASE WHEN j.type IN ('DOUBLE','BIGINT','UBIGINT','BOOLEAN') THEN try_cast(j.value AS DOUBLE) END AS value_numeric,
  CASE WHEN j.type = 'VARCHAR' THEN json_extract_string(j.value, '$') END AS value_text
FROM events e, json_each(e.props) j""")
def json_explode_typed(spark, d):
    e = t(spark, d, "events").select("event_id", "props")
    x = spark.sql("SELECT b.event_id, e.key AS state, e.value AS v FROM {b} b, LATERAL variant_explode(try_parse_json(b.props)) e", b=e)
    from ..functions import number_of, string_of

    v = F.col("v")
    return x.select("event_id", "state", json_kind(v).alias("kind"), number_of(v).alias("value_numeric"), string_of(v).alias("value_text"))


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, json_type(props, '$.none') AS none, len(json_keys(props))::BIGINT AS n_keys, json_valid(props) AS ok,
  (json_type(props) = 'OBJECT' AND len(json_keys(props)) > 0) AS eligible FROM events""")
def json_paths(spark, d):
    from ..functions import has_keys, is_valid_json, object_size

    p = F.col("props")
    return t(spark, d, "events").select(
        "event_id", F.get_json_object(p, "$.k").alias("k"), F.get_json_object(p, "$.none").alias("none"), object_size(p, "$").cast("long").alias("n_keys"),
        is_valid_json(p).alias("ok"), has_keys(p, "$").alias("eligible"))


@query("""SELECT l_returnflag, round(quantile_cont(s, 0.5), 3) AS p50, round(quantile_cont(s, 0.95), 3) AS p95, max(s)::BIGINT AS worst
FROM (SELECT l_returnflag, date_diff('second', o_orderdate, l_shipdate) AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY 1""")
def quantile_lag(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_orderdate")
    s = t(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_shipdate").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("l_returnflag", seconds_between(F.col("o_orderdate"), F.col("l_shipdate")).alias("s"))
    return lag_quantiles(s, ["l_returnflag"], "s")


@query("SELECT user_id, count(*) AS n, count(DISTINCT event_type) AS kinds, string_agg(DISTINCT event_type, ' | ' ORDER BY event_type) AS names FROM events GROUP BY 1 HAVING count(DISTINCT event_type) > 1")
def ordered_string_agg(spark, d):
    return t(spark, d, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("event_type").alias("kinds"),
        F.array_join(F.sort_array(F.collect_set("event_type")), " | ").alias("names")).where("kinds > 1")


@query("""WITH p AS (SELECT DISTINCT l_orderkey AS k, CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE 'O' END AS v FROM lineitem WHERE l_orderkey % 2 = 0)
SELECT o_orderkey, o_custkey FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS v FROM orders) o
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.k = o.o_orderkey AND p.v IS NOT DISTINCT FROM o.v)""")
def ledger_anti_nullsafe(spark, d):
    key = F.col("l_orderkey")
    ledger = t(spark, d, "lineitem").where(key % 2 == 0).select(key.alias("o_orderkey"), F.when(key % 3 != 0, "O").alias("v"))
    o = t(spark, d, "orders").withColumn("v", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")))
    return unprocessed(o, ledger, ["o_orderkey"], "v").select("o_orderkey", "o_custkey")


_MAP_SQL = """SELECT l_partkey % 50 AS structure_id, l_partkey::VARCHAR AS state_uuid, p_brand AS state_name, s_suppkey::VARCHAR AS control_uuid, s_name AS control_name,
  CASE l_linenumber WHEN 1 THEN 'state' WHEN 2 THEN 'details' WHEN 3 THEN 'uuidAction' ELSE 'controlKey' END AS mapping_source, least(l_linenumber, 4) AS mapping_priority
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"""


def _mappings(spark, d):
    li = t(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber")
    p = t(spark, d, "part").select("p_partkey", "p_brand")
    s = t(spark, d, "supplier").select("s_suppkey", "s_name")
    n = F.col("l_linenumber")
    none = F.lit(None).cast("string")
    return li.join(p, F.col("l_partkey") == F.col("p_partkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(
        (F.col("l_partkey") % 50).alias("structure_id"), F.col("l_partkey").cast("string").alias("state_uuid"), F.col("p_brand").alias("state_name"),
        F.col("s_suppkey").cast("string").alias("control_uuid"), F.col("s_name").alias("control_name"),
        *[none.alias(c) for c in ("control_type", "room_uuid", "room_name", "category_uuid", "category_name")],
        F.when(n == 1, "state").when(n == 2, "details").when(n == 3, "uuidAction").otherwise("controlKey").alias("mapping_source"),
        F.least(n, F.lit(4)).alias("mapping_priority"))


@query(f"""WITH m AS (SELECT DISTINCT * FROM ({_MAP_SQL})), best AS (SELECT * FROM m QUALIFY mapping_priority = min(mapping_priority) OVER (PARTITION BY structure_id, state_uuid))
SELECT structure_id, state_uuid, state_name, control_uuid, control_name, mapping_source, mapping_priority::BIGINT AS mapping_priority, (count(*) OVER (PARTITION BY structure_id, state_uuid))::BIGINT AS competing
FROM best QUALIFY row_number() OVER (PARTITION BY structure_id, state_uuid ORDER BY control_uuid, state_name, mapping_source, control_name) = 1""")
def mapping_best_meaning(spark, d):
    return mapping.best_meaning(_mappings(spark, d)).select("structure_id", "state_uuid", "state_name", "control_uuid", "control_name", "mapping_source", F.col("mapping_priority").cast("long").alias("mapping_priority"), F.col("competing_best_mappings").cast("long").alias("competing"))


@query(f"""SELECT structure_id, state_uuid, count(*) AS mapping_count, count(DISTINCT control_uuid || '|' || coalesce(state_name, '') || '|' || mapping_source) AS distinct_meanings, min(mapping_priority)::BIGINT AS best_priority,
  string_agg(mapping_source || ':' || coalesce(control_name, '?') || '.' || coalesce(state_name, '?'), ' | ' ORDER BY mapping_priority, control_name, state_name) AS meanings
FROM ({_MAP_SQL}) GROUP BY 1, 2 HAVING count(DISTINCT control_uuid || '|' || coalesce(state_name, '') || '|' || mapping_source) > 1""")
def mapping_conflicts(spark, d):
    return mapping.conflicts(_mappings(spark, d)).withColumn("best_priority", F.col("best_priority").cast("long"))


_EV_SQL = """SELECT e.event_id, e.ts AS received_at, e.user_id AS source_id, e.event_id::VARCHAR AS message_id, e.event_type AS state_uuid,
  CASE WHEN c.c_custkey IS NULL THEN 'unresolved' WHEN e.user_id % 4 = 0 THEN 'ambiguous' WHEN e.event_type = 'click' THEN 'resolved_state' WHEN e.event_type = 'view' THEN 'resolved_details' ELSE 'resolved_control' END AS resolution_status,
  CASE WHEN c.c_custkey IS NULL AND e.event_id % 2 = 0 THEN 'no_valid_structure' WHEN e.event_id % 3 = 0 THEN 'fallback_earliest' ELSE 'asof' END AS structure_resolution,
  CASE e.event_type WHEN 'click' THEN 'TotalDay' WHEN 'view' THEN 'actual' ELSE e.event_type END AS state_name, c.c_name AS control_name, CASE WHEN e.event_type = 'error' THEN 'Switch' ELSE c.c_mktsegment END AS control_type
FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id AND c.c_custkey % 5 <> 0"""


def _explained(spark, d):
    c = t(spark, d, "customer").where("c_custkey % 5 <> 0").select("c_custkey", "c_name", "c_mktsegment")
    e = t(spark, d, "events").join(c, F.col("user_id") == F.col("c_custkey"), "left")
    kind = F.col("event_type")
    status = (F.when(F.col("c_custkey").isNull(), "unresolved").when(F.col("user_id") % 4 == 0, "ambiguous").when(kind == "click", "resolved_state").when(kind == "view", "resolved_details").otherwise("resolved_control"))
    how = F.when(F.col("c_custkey").isNull() & (F.col("event_id") % 2 == 0), "no_valid_structure").when(F.col("event_id") % 3 == 0, "fallback_earliest").otherwise("asof")
    return e.select(
        "event_id", F.col("ts").alias("received_at"), F.col("user_id").alias("source_id"), F.col("event_id").cast("string").alias("message_id"), kind.alias("state_uuid"), status.alias("resolution_status"),
        how.alias("structure_resolution"), F.when(kind == "click", "TotalDay").when(kind == "view", "actual").otherwise(kind).alias("state_name"), F.col("c_name").alias("control_name"),
        F.when(kind == "error", "Switch").otherwise(F.col("c_mktsegment")).alias("control_type"))


@query(f"SELECT resolution_status, structure_resolution, count(*) AS n FROM ({_EV_SQL}) GROUP BY ALL")
def resolution_status_case(spark, d):
    return _explained(spark, d).groupBy("resolution_status", "structure_resolution").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT *, CASE retention_class WHEN 'meter_counter' THEN '{marts.GUIDANCE["meter_counter"]}' WHEN 'live_value' THEN '{marts.GUIDANCE["live_value"]}' WHEN 'discrete_state' THEN '{marts.GUIDANCE["discrete_state"]}' ELSE '{marts.GUIDANCE["unclassified"]}' END AS gold_guidance
FROM (SELECT *, CASE WHEN lower(state_name) IN ('total','totalday') THEN 'meter_counter' WHEN lower(state_name) IN ('actual','gpwr') THEN 'live_value' WHEN lower(control_type) IN ('switch','alarm') THEN 'discrete_state' ELSE 'unclassified' END AS retention_class
FROM (SELECT source_id, state_uuid, min(state_name) AS state_name, min(control_name) AS control_name, min(control_type) AS control_type FROM ({_EV_SQL}) WHERE resolution_status LIKE 'resolved_%' GROUP BY 1, 2))""")
def retention_hints(spark, d):
    return marts.retention_hints(_explained(spark, d))


@query(f"""SELECT source_id, state_uuid, min(received_at) AS first_seen, max(received_at) AS last_seen, count(*) AS event_count, count(DISTINCT message_id) AS message_count,
  count(*) FILTER (WHERE structure_resolution = 'no_valid_structure') AS events_without_valid_structure FROM ({_EV_SQL}) WHERE resolution_status = 'unresolved' GROUP BY 1, 2""")
def unresolved_states(spark, d):
    return marts.unresolved_states(_explained(spark, d))


@query(f"""WITH e AS ({_EV_SQL}), c AS (SELECT structure_id, state_uuid FROM ({_MAP_SQL}) GROUP BY 1, 2 HAVING count(DISTINCT control_uuid || '|' || coalesce(state_name, '') || '|' || mapping_source) > 1)
SELECT 'silver_events' AS metric, count(*)::DOUBLE AS value_numeric, NULL::VARCHAR AS value_text FROM e
UNION ALL SELECT 'resolved_events', (count(*) FILTER (WHERE resolution_status LIKE 'resolved_%'))::DOUBLE, NULL FROM e
UNION ALL SELECT 'ambiguous_events', (count(*) FILTER (WHERE resolution_status = 'ambiguous'))::DOUBLE, NULL FROM e
UNION ALL SELECT 'unresolved_events', (count(*) FILTER (WHERE resolution_status = 'unresolved'))::DOUBLE, NULL FROM e
UNION ALL SELECT 'resolved_percent', round(100.0 * (count(*) FILTER (WHERE resolution_status LIKE 'resolved_%')) / nullif(count(*), 0), 9), NULL FROM e
UNION ALL SELECT 'unresolved_percent', round(100.0 * (count(*) FILTER (WHERE resolution_status = 'unresolved')) / nullif(count(*), 0), 9), NULL FROM e
UNION ALL SELECT 'duplicate_message_state_pairs', coalesce(sum(c - 1), 0)::DOUBLE, NULL FROM (SELECT count(*) AS c FROM e GROUP BY source_id, message_id, state_uuid HAVING count(*) > 1)
UNION ALL SELECT 'events_without_valid_structure', (count(*) FILTER (WHERE structure_resolution = 'no_valid_structure'))::DOUBLE, NULL FROM e
UNION ALL SELECT 'events_using_earliest_structure_fallback', (count(*) FILTER (WHERE structure_resolution = 'fallback_earliest'))::DOUBLE, NULL FROM e
UNION ALL SELECT 'mapping_conflict_uuids', count(*)::DOUBLE, NULL FROM c
UNION ALL SELECT 'valid_structures', count(*)::DOUBLE, NULL FROM documents WHERE length(text) > 1000
UNION ALL SELECT 'invalid_structures_excluded', ((SELECT count(*) FROM documents) - count(*))::DOUBLE, NULL FROM documents WHERE length(text) > 1000
UNION ALL SELECT 'min_event_time_utc', NULL, strftime(min(received_at), '%Y-%m-%d %H:%M:%S') || '+00' FROM e
UNION ALL SELECT 'max_event_time_utc', NULL, strftime(max(received_at), '%Y-%m-%d %H:%M:%S') || '+00' FROM e""")
def dq_summary(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "text")
    whole = _explained(spark, d).withColumn("received_at", F.date_trunc("second", "received_at"))
    out = marts.data_quality(whole, mapping.conflict_keys(_mappings(spark, d)), docs.where(F.length("text") > mapping.LEAST_LENGTH), docs)
    return out.withColumn("value_numeric", F.round("value_numeric", 9))


@query("SELECT event_id, user_id, event_type FROM events WHERE (user_id, event_type) IN (SELECT DISTINCT user_id, event_type FROM events WHERE event_id % 97 = 0)")
def semi_touched_keys(spark, d):
    e = t(spark, d, "events").select("event_id", "user_id", "event_type")
    return within(e, e.where(F.col("event_id") % 97 == 0), ["user_id", "event_type"])


@query("""SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
  AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'O')""")
def semi_anti_expire(spark, d):
    li = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag", "l_linestatus")
    o = t(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return expired(o, "o_orderdate", F.lit("1996-01-01").cast("timestamp_ntz"), li.where("l_returnflag = 'R'"), li.where("l_linestatus = 'O'"), ["o_orderkey"]).select("o_orderkey")


@query(f"""WITH a AS ({_ASOF}), p AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE v_id END AS v_id FROM a)
SELECT a.event_id, p.v_id AS was, a.v_id AS now FROM p JOIN a USING (event_id) WHERE p.v_id IS DISTINCT FROM a.v_id""")
def remap_discovery(spark, d):
    a = asof_resolution(spark, d).select("event_id", F.col("v_id").alias("now"))
    p = a.select("event_id", F.when(F.col("event_id") % 5 != 0, F.col("now")).alias("was"))
    return p.join(a, "event_id").where(~F.col("was").eqNullSafe(F.col("now")))


@query("""SELECT l_orderkey, l_linenumber, round(l_quantity, 2) AS q FROM lineitem WHERE l_orderkey % 10 <> 0
UNION ALL SELECT l_orderkey, l_linenumber, round(l_quantity * 2, 2) FROM lineitem WHERE l_orderkey % 10 = 0 AND l_linenumber <= 2""")
def replace_by_message(spark, d):
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round("l_quantity", 2).alias("q"))
    batch = t(spark, d, "lineitem").where("l_orderkey % 10 = 0").select("l_orderkey", "l_linenumber", F.round(F.col("l_quantity") * 2, 2).alias("q"))
    return replace(li, batch.where("l_linenumber <= 2"), ["l_orderkey"], touched=batch)


@query("""WITH b AS (SELECT user_id, event_type, event_id, 'out/' || printf('%020d', event_id % 6) || '/part.parquet' AS filename FROM events),
top AS (SELECT user_id, event_type, max(regexp_extract(filename, '([0-9]{20})/[^/]+$', 1)) AS seq FROM b GROUP BY 1, 2)
SELECT b.user_id, b.event_type, b.event_id, top.seq FROM b JOIN top ON b.user_id = top.user_id AND b.event_type = top.event_type AND regexp_extract(b.filename, '([0-9]{20})/[^/]+$', 1) = top.seq""")
def combine_batches(spark, d):
    name = F.concat(F.lit("out/"), F.lpad((F.col("event_id") % 6).cast("string"), 20, "0"), F.lit("/part.parquet"))
    b = t(spark, d, "events").select("user_id", "event_type", "event_id", F.regexp_extract(name, r"([0-9]{20})/[^/]+$", 1).alias("seq"))
    return newest_batches(b, ["user_id", "event_type"], "seq")


@query("""SELECT user_id, event_type, event_id, f FROM (SELECT user_id, event_type, event_id, 'batch-' || (event_id % 4) AS f FROM events)
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY f DESC, event_id DESC) = 1""")
def newest_file_per_key(spark, d):
    e = t(spark, d, "events").select("user_id", "event_type", "event_id", F.concat(F.lit("batch-"), (F.col("event_id") % 4).cast("string")).alias("f"))
    return newest(e, ["user_id", "event_type"], ["f", "event_id"])


@query("""SELECT event_id, user_id, ingested FROM (SELECT event_id, user_id, 1 AS ingested FROM events UNION ALL SELECT event_id, user_id, 2 FROM events WHERE event_id % 3 = 0)
QUALIFY row_number() OVER (PARTITION BY event_id, user_id ORDER BY ingested DESC) = 1""")
def archive_dedupe(spark, d):
    e = t(spark, d, "events").select("event_id", "user_id")
    both = e.withColumn("ingested", F.lit(1)).unionByName(e.where("event_id % 3 = 0").withColumn("ingested", F.lit(2)))
    return newest(both, ["event_id", "user_id"], ["ingested"])


@query("SELECT event_id, user_id, ts FROM events ORDER BY ts, user_id, event_id LIMIT 500")
def topn_batch_pick(spark, d):
    return t(spark, d, "events").select("event_id", "user_id", "ts").orderBy("ts", "user_id", "event_id").limit(500)


@query("""SELECT a.event_id, a.ts FROM (SELECT event_id, user_id, ts FROM events) a JOIN (SELECT user_id, event_id FROM events ORDER BY user_id, event_id LIMIT 300) q USING (user_id, event_id)""")
def queue_slice(spark, d):
    e = t(spark, d, "events").select("event_id", "user_id", "ts")
    slice_ = e.select("user_id", "event_id").orderBy("user_id", "event_id").limit(300)
    return e.join(F.broadcast(slice_), ["user_id", "event_id"]).select("event_id", "ts")  # 300 rows


@query("""SELECT event_id, timezone('Europe/Berlin', (ts + INTERVAL 9 MONTH)::TIMESTAMPTZ) AS berlin FROM (SELECT event_id, ts AT TIME ZONE 'UTC' AS ts FROM events)""")
def berlin_time(spark, d):
    return t(spark, d, "events").select("event_id", local_time(F.col("ts").cast("timestamp") + F.expr("INTERVAL 9 MONTH")).alias("berlin"))


@query("""SELECT o_orderkey, try_cast(x AS TIMESTAMP) AS at FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'no date' WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS x FROM orders)""")
def try_cast_timestamp(spark, d):
    k, at = F.col("o_orderkey") % 4, F.col("o_orderdate")
    x = F.when(k == 0, "").when(k == 1, "no date").when(k == 2, F.date_format(at, "yyyy-MM-dd")).otherwise(F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
    return t(spark, d, "orders").select("o_orderkey", cast_naive(x).alias("at"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || '+00' AS text, date_trunc('hour', ts)::TIMESTAMP AS hour FROM events")
def utc_texts(spark, d):
    return t(spark, d, "events").select("event_id", utc_text(F.date_trunc("second", "ts")).alias("text"), floor_naive("hour", F.col("ts")).alias("hour"))


@query("""SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY x ASC, event_id) AS up, row_number() OVER (PARTITION BY user_id ORDER BY x DESC, event_id) AS down
FROM (SELECT event_id, user_id, CASE WHEN event_id % 4 <> 0 THEN event_type END AS x FROM events)""")
def null_order(spark, d):
    x = F.when(F.col("event_id") % 4 != 0, F.col("event_type"))
    e = t(spark, d, "events").select("event_id", "user_id", x.alias("x"))
    w = Window.partitionBy("user_id")
    return e.select("event_id", F.row_number().over(w.orderBy(F.col("x").asc_nulls_last(), "event_id")).cast("long").alias("up"), F.row_number().over(w.orderBy(F.col("x").desc_nulls_last(), "event_id")).cast("long").alias("down"))


@query("""SELECT user_id, round(100.0 * count(*) FILTER (WHERE event_type = 'error') / nullif(count(*) FILTER (WHERE event_type <> 'view'), 0), 6) AS pct,
  greatest(NULL, max(value), 0.0) AS top, coalesce(max(CASE WHEN event_type = 'none' THEN value END), -1.0) AS missing FROM events GROUP BY 1""")
def safe_ratio(spark, d):
    kind = F.col("event_type")
    return t(spark, d, "events").groupBy("user_id").agg(
        F.round(F.try_divide(100.0 * F.count_if(kind == "error"), F.count_if(kind != "view")), 6).alias("pct"),
        F.greatest(F.lit(None).cast("double"), F.max("value"), F.lit(0.0)).alias("top"), F.coalesce(F.max(F.when(kind == "none", F.col("value"))), F.lit(-1.0)).alias("missing"))


@query("SELECT l_orderkey, l_partkey % 10 AS part, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def group_by_all_dupes(spark, d):
    return t(spark, d, "lineitem").groupBy("l_orderkey", (F.col("l_partkey") % 10).alias("part")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("""SELECT count(*) FILTER (WHERE u IS NULL) AS pending, min(ts) FILTER (WHERE u IS NULL) AS oldest_pending, max(ts) AS latest, count(*) AS total
FROM (SELECT ts, CASE WHEN event_id % 5 <> 0 THEN ts END AS u FROM events)""")
def pending_status(spark, d):
    e = t(spark, d, "events").select(F.col("ts").alias("received_at"), F.when(F.col("event_id") % 5 != 0, F.col("ts")).alias("uploaded_at"))
    return spool_status(e)


@query("""WITH c AS (SELECT max(ts) AS now FROM events), r AS (SELECT count(*) FILTER (WHERE event_id % 5 = 0) AS pending, count(*) FILTER (WHERE event_id % 5 <> 0 AND ts >= now - INTERVAL 10 DAY) AS uploaded, count(*) FILTER (WHERE ts >= now - INTERVAL 10 DAY) AS received FROM events, c)
SELECT pending, uploaded, received, round(uploaded / 864000.0, 6) AS rate, round(greatest(received / 864000.0, 0.0001), 6) AS ingress,
  CASE WHEN pending = 0 THEN 0.0 WHEN uploaded / 864000.0 > greatest(received / 864000.0, 0.0001) THEN round(pending / (uploaded / 864000.0 - greatest(received / 864000.0, 0.0001)) / 3600, 2) END AS eta_hours,
  uploaded / 864000.0 >= greatest(received / 864000.0, 0.0001) + pending / 43200.0 AS catches_up FROM r""")
def eta_report(spark, d):
    e = t(spark, d, "events").select("event_id", "ts")
    now = e.agg(F.max("ts").alias("now"))
    new = F.col("ts") >= F.col("now") - F.expr("INTERVAL 10 DAY")
    r = e.crossJoin(F.broadcast(now)).agg(  # one row
        F.count_if(F.col("event_id") % 5 == 0).alias("pending"), F.count_if((F.col("event_id") % 5 != 0) & new).alias("uploaded"), F.count_if(new).alias("received"))
    rate, ingress = F.col("uploaded") / 864000.0, F.greatest(F.col("received") / 864000.0, F.lit(0.0001))
    eta = F.when(F.col("pending") == 0, 0.0).when(rate > ingress, F.round(F.try_divide(F.col("pending"), rate - ingress) / 3600, 2))
    return r.select("pending", "uploaded", "received", F.round(rate, 6).alias("rate"), F.round(ingress, 6).alias("ingress"), eta.alias("eta_hours"), (rate >= ingress + F.col("pending") / 43200.0).alias("catches_up"))


@query("SELECT page_id, length(html) AS chars, octet_length(encode(html)) AS bytes, length(html) > 1000 AS long_enough, sha256(html) AS sha FROM pages")
def structure_validity(spark, d):
    h = F.col("html")
    return t(spark, d, "pages").select("page_id", F.length(h).cast("long").alias("chars"), F.octet_length(h).cast("long").alias("bytes"), (F.length(h) > mapping.LEAST_LENGTH).alias("long_enough"), F.sha2(h, 256).alias("sha"))


@query("""SELECT id, regexp_full_match(x, '(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{16}') AS is_id FROM (SELECT event_id AS id,
  CASE event_id % 3 WHEN 0 THEN substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 16) WHEN 1 THEN upper(substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 16)) ELSE h END AS x
  FROM (SELECT event_id, sha256(event_id::VARCHAR) AS h FROM events))""")
def regex_uuid_filter(spark, d):
    h = F.sha2(F.col("event_id").cast("string"), 256)
    ident = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 16))
    x = F.when(F.col("event_id") % 3 == 0, ident).when(F.col("event_id") % 3 == 1, F.upper(ident)).otherwise(h)
    return t(spark, d, "events").select(F.col("event_id").alias("id"), x.rlike(mapping.STATE_ID).alias("is_id"))


@query("""SELECT user_id, event_type, min(event_id) AS event_id FROM events WHERE (user_id, event_type) NOT IN (SELECT user_id, event_type FROM events WHERE event_id < 40) GROUP BY 1, 2""")
def insert_if_absent(spark, d):
    e = t(spark, d, "events").select("user_id", "event_type", "event_id")
    return insert_or_ignore(e.where("event_id < 40"), e, ["user_id", "event_type"], first_by=["event_id"])


@query("""WITH RECURSIVE tree AS (SELECT r_regionkey AS k, 'r' || r_regionkey AS key, '$.controls.r' || r_regionkey AS path, r_name AS name, 'room' || r_regionkey AS room FROM region),
kids AS (SELECT n_regionkey AS k, 'n' || n_nationkey AS key, '$.controls.r' || n_regionkey || '.subControls.n' || n_nationkey AS path, n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'own' || n_nationkey ELSE 'room' || n_regionkey END AS room FROM nation),
c AS (SELECT * FROM tree UNION ALL SELECT * FROM kids)
SELECT key AS control_uuid, path AS control_path, name AS control_name, room AS room_uuid, 'Room ' || room AS room_name, 'state' AS mapping_source, 1::BIGINT AS mapping_priority, 'value' AS state_name, 's-' || key AS state_uuid FROM c
UNION ALL SELECT key, path, name, room, 'Room ' || room, 'controlKey', 4, 'control', key FROM c
UNION ALL SELECT key, path, name, room, 'Room ' || room, 'details', 2, '0', '00000000-0000-0000-' || lpad(k::VARCHAR, 16, '0') FROM tree""")
def recursive_controls(spark, d):
    """A document built from regions and nations, mapped by the tree operators."""
    n = t(spark, d, "nation")
    room = F.concat(F.lit("own"), "n_nationkey")
    child = F.concat(F.lit('"n'), "n_nationkey", F.lit('":{"name":"'), "n_name", F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit('","room":"'), room)).otherwise(F.lit("")), F.lit('","states":{"value":"s-n'), "n_nationkey", F.lit('"}}'))
    kids = n.groupBy("n_regionkey").agg(F.array_join(F.collect_list(child), ",").alias("kids"), F.array_join(F.collect_list(F.concat(F.lit('"'), room, F.lit('":{"name":"Room '), room, F.lit('"}'))), ",").alias("rooms"))
    r = t(spark, d, "region").join(kids, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    k = F.col("r_regionkey").cast("string")
    part = F.concat(F.lit('"r'), k, F.lit('":{"name":"'), "r_name", F.lit('","room":"room'), k, F.lit('","states":{"value":"s-r'), k, F.lit('","n":7},"details":{"ids":["00000000-0000-0000-'), F.lpad(k, 16, "0"), F.lit('","no id"]},"subControls":{'), F.coalesce("kids", F.lit("")), F.lit("}}"))
    rooms = F.concat_ws(",", F.concat(F.lit('"room'), k, F.lit('":{"name":"Room room'), k, F.lit('"}')), "rooms")
    doc = r.agg(F.array_join(F.collect_list(part), ",").alias("c"), F.array_join(F.collect_list(rooms), ",").alias("r"))  # one small document
    structures = doc.select(
        F.lit("doc").alias("structure_id"), F.lit("home").alias("source_id"), F.lit("2024-01-01").cast("timestamp").alias("captured_at"), F.lit(None).cast("string").alias("last_modified"),
        F.concat(F.lit('{"controls":{'), "c", F.lit('},"rooms":{'), "r", F.lit('},"cats":{},"padding":"'), F.lit("x" * 1000), F.lit('"}')).alias("payload_json"))
    out = mapping.candidates(mapping.valid(structures))
    return out.select("control_uuid", "control_path", "control_name", "room_uuid", "room_name", "mapping_source", F.col("mapping_priority").cast("long").alias("mapping_priority"), "state_name", "state_uuid")


@query("""SELECT o_orderkey, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS lines, (SELECT count(*) FROM orders) - o_orderkey AS rest FROM orders""")
def scalar_counts(spark, d):
    li = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    o = t(spark, d, "orders").select("o_orderkey")
    return o.join(li, "o_orderkey", "left").crossJoin(F.broadcast(o.agg(F.count(F.lit(1)).alias("all")))).select(  # one row
        "o_orderkey", F.coalesce("n", F.lit(0)).alias("lines"), (F.col("all") - F.col("o_orderkey")).alias("rest"))


@query("SELECT coalesce(max(event_id), 0) + 1 AS next, coalesce(sum(CASE WHEN event_type = 'none' THEN 1 END), 0)::BIGINT AS none, printf('%020d', max(event_id)) AS padded FROM events")
def next_sequence(spark, d):
    top = F.max("event_id")
    return t(spark, d, "events").agg((F.coalesce(top, F.lit(0)) + 1).alias("next"), F.coalesce(F.sum(F.when(F.col("event_type") == "none", 1)), F.lit(0)).alias("none"), F.lpad(top.cast("string"), 20, "0").alias("padded"))


@query("SELECT * EXCLUDE (props, value) REPLACE (event_type || '!' AS event_type) FROM events WHERE event_type LIKE 'v_e%' AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'")
def project_and_filter(spark, d):
    e = t(spark, d, "events").where(F.col("event_type").like("v_e%") & F.col("ts").between(F.lit("2024-01-05").cast("timestamp_ntz"), F.lit("2024-01-20").cast("timestamp_ntz")))
    return e.drop("props", "value").withColumn("event_type", F.concat("event_type", F.lit("!")))


@query("SELECT event_id, user_id FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-10' AND event_id <= 5000 ORDER BY ts, event_id LIMIT 200)")
def bounded_retention(spark, d):
    e = t(spark, d, "events").select("event_id", "user_id", "ts")
    old = e.where((F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")) & (F.col("event_id") <= 5000)).orderBy("ts", "event_id").limit(200)
    return without(e, old, ["event_id"]).select("event_id", "user_id")


@query("SELECT event_id, user_id, NULL::VARCHAR AS note, 1::BIGINT AS part FROM events WHERE event_id % 2 = 0 UNION ALL SELECT event_id, user_id, event_type, 2 FROM events WHERE event_id % 2 = 1")
def union_by_name(spark, d):
    e = t(spark, d, "events")
    a = e.where("event_id % 2 = 0").select("event_id", "user_id", F.lit(1).cast("long").alias("part"))
    b = e.where("event_id % 2 = 1").select(F.lit(2).cast("long").alias("part"), F.col("event_type").alias("note"), "user_id", "event_id")
    return a.unionByName(b, allowMissingColumns=True)


def queries() -> dict[str, Query]:
    from . import flows  # noqa: F401  adds its own

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)
