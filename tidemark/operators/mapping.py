"""From configuration documents to what each state id means.

A document is a tree of controls. Every control gives four sorts of meanings,
by falling priority: the ids in its ``states``, id-shaped texts anywhere in its
``details``, its action id, and its own key. Rooms and categories are inherited
from the parent control and named by the document's dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cast_naive, has_keys, object_size
from ..session import configure

#: Fixed: documents must be longer than this many characters.
LEAST_LENGTH = 1000
#: Fixed: shape of a state id.
STATE_ID = r"^(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{16}$"

_CONTROLS = """
WITH RECURSIVE controls(structure_id, control_key, obj, control_path, room_uuid, category_uuid) AS (
  SELECT s.structure_id, e.key, to_json(e.value), concat('$.controls.', e.key),
         try_variant_get(e.value, '$.room', 'string'), try_variant_get(e.value, '$.cat', 'string')
  FROM {docs} s, LATERAL variant_explode(try_variant_get(try_parse_json(s.payload_json), '$.controls', 'variant')) e
  WHERE startswith(schema_of_variant(e.value), 'OBJECT')
  UNION ALL
  SELECT c.structure_id, e.key, to_json(e.value), concat(c.control_path, '.subControls.', e.key),
         coalesce(try_variant_get(e.value, '$.room', 'string'), c.room_uuid),
         coalesce(try_variant_get(e.value, '$.cat', 'string'), c.category_uuid)
  FROM controls c, LATERAL variant_explode(try_variant_get(try_parse_json(c.obj), '$.subControls', 'variant')) e
  WHERE startswith(schema_of_variant(e.value), 'OBJECT')
)
SELECT * FROM controls
"""

_DETAILS = """
WITH RECURSIVE leaves(structure_id, control_path, k, v) AS (
  SELECT c.structure_id, c.control_path, CAST(NULL AS STRING), to_json(try_variant_get(try_parse_json(c.obj), '$.details', 'variant'))
  FROM {controls} c
  UNION ALL
  SELECT l.structure_id, l.control_path, coalesce(e.key, cast(e.pos AS STRING)), to_json(e.value)
  FROM leaves l, LATERAL variant_explode(try_parse_json(l.v)) e
  WHERE l.v IS NOT NULL
)
SELECT structure_id, control_path, k, try_variant_get(try_parse_json(v), '$', 'string') AS leaf
FROM leaves WHERE startswith(v, '"')
"""


def valid(structures: DataFrame) -> DataFrame:
    return structures.where((F.length("payload_json") > LEAST_LENGTH) & has_keys(F.col("payload_json"), "$.controls"))


def controls(structures: DataFrame) -> DataFrame:
    """One row per control at any depth. A recursion's row limit is lifted: depth
    is what ends it, and documents are finite."""
    spark = configure(structures.sparkSession)
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    return spark.sql(_CONTROLS, docs=structures.select("structure_id", "payload_json"))


def _names(structures: DataFrame, part: str, ident: str, name: str) -> DataFrame:
    spark = structures.sparkSession
    q = f"""SELECT s.structure_id, e.key AS {ident}, try_variant_get(e.value, '$.name', 'string') AS {name}
    FROM {{docs}} s, LATERAL variant_explode(try_variant_get(try_parse_json(s.payload_json), '$.{part}', 'variant')) e"""
    return spark.sql(q, docs=structures.select("structure_id", "payload_json"))


def candidates(structures: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """state_uuid_map rows (without loaded_at) of valid documents."""
    spark = configure(structures.sparkSession)
    c = controls(structures) if found is None else found
    v = F.try_parse_json("obj")
    get = lambda path: F.try_variant_get(v, path, "string")
    described = (
        c.select("*", get("$.name").alias("control_name"), get("$.type").alias("control_type"))
        .join(_names(structures, "rooms", "room_uuid", "room_name"), ["structure_id", "room_uuid"], "left")
        .join(_names(structures, "cats", "category_uuid", "category_name"), ["structure_id", "category_uuid"], "left")
        .join(structures.select("structure_id", F.col("captured_at").alias("structure_captured_at"), F.col("last_modified").alias("structure_last_modified")), "structure_id")
    )
    states = spark.sql(
        """SELECT c.structure_id, c.control_path, e.key AS state_name, try_variant_get(e.value, '$', 'string') AS state_uuid
        FROM {c} c, LATERAL variant_explode(try_variant_get(try_parse_json(c.obj), '$.states', 'variant')) e
        WHERE schema_of_variant(e.value) = 'STRING'""", c=c)
    details = spark.sql(_DETAILS, controls=c).where(F.col("leaf").rlike(STATE_ID)).select("structure_id", "control_path", F.col("k").alias("state_name"), F.col("leaf").alias("state_uuid"))
    actions = c.select("structure_id", "control_path", F.lit("uuidAction").alias("state_name"), get("$.uuidAction").alias("state_uuid"))
    own = c.select("structure_id", "control_path", F.lit("control").alias("state_name"), F.col("control_key").alias("state_uuid"))
    meanings = None
    for k, (source, d) in enumerate((("state", states), ("details", details), ("uuidAction", actions), ("controlKey", own)), 1):
        d = d.withColumn("mapping_source", F.lit(source)).withColumn("mapping_priority", F.lit(k))
        meanings = d if meanings is None else meanings.unionByName(d)
    return meanings.where("state_uuid IS NOT NULL").join(described, ["structure_id", "control_path"]).select(
        "structure_id", "structure_captured_at", "structure_last_modified", "state_uuid", "state_name",
        F.col("control_key").alias("control_uuid"), "control_name", "control_type", "room_uuid", "room_name",
        "category_uuid", "category_name", "mapping_source", "mapping_priority", "control_path",
    ).distinct()


def structure_versions(structures: DataFrame, mappings: DataFrame, found: DataFrame) -> DataFrame:
    """One row per valid document with its counts."""
    count = lambda d, name: d.groupBy("structure_id").agg(F.count(F.lit(1)).alias(name))
    p = F.col("payload_json")
    return structures.join(count(found, "control_object_count"), "structure_id", "left").join(count(mappings, "state_mapping_count"), "structure_id", "left").select(
        "structure_id", "source_id", F.col("captured_at").alias("structure_captured_at"),
        F.col("last_modified").alias("structure_last_modified_raw"), cast_naive(F.col("last_modified")).alias("structure_last_modified"),
        "payload_sha256", "collector_version", "ingested_at", F.octet_length(p).cast("long").alias("payload_bytes"),
        object_size(p, "$.controls").cast("long").alias("control_count"),
        F.coalesce("control_object_count", F.lit(0)).cast("long").alias("control_object_count"),
        F.coalesce("state_mapping_count", F.lit(0)).cast("long").alias("state_mapping_count"),
        object_size(p, "$.rooms").cast("long").alias("room_count"), object_size(p, "$.cats").cast("long").alias("category_count"),
    )


def best_meaning(mappings: DataFrame) -> DataFrame:
    """One meaning per (structure, state): the best priority, the number of
    different meanings that share it, and the first of them in order. Only rows of
    the best priority, found by a partial aggregation, are sorted."""
    cols = ["state_name", "control_uuid", "control_name", "control_type", "room_uuid", "room_name", "category_uuid", "category_name", "mapping_source", "mapping_priority"]
    key = ["structure_id", "state_uuid"]
    w = Window.partitionBy(*key)
    order = [F.col(c).asc_nulls_last() for c in ("control_uuid", "state_name", "mapping_source", "control_name", "control_type", "room_uuid", "category_uuid")]
    top = mappings.groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(F.min("mapping_priority").alias("_top"))
    cond = F.col("mapping_priority") == F.col("_top")
    for k in key:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_{k}"))
    best = mappings.select(*key, *cols).join(top, cond, "left_semi").distinct()
    return (
        best.withColumn("competing_best_mappings", F.count(F.lit(1)).over(w).cast("int"))
        .withColumn("_n", F.row_number().over(w.orderBy(*order))).where("_n = 1").drop("_n")
    )


def _meaning():
    return F.concat("control_uuid", F.lit("|"), F.coalesce("state_name", F.lit("")), F.lit("|"), "mapping_source")


def conflict_keys(mappings: DataFrame) -> DataFrame:
    """(structure, state) with more than one meaning; meanings are compared by
    their hashes, in one partial aggregation."""
    h = F.when(_meaning().isNotNull(), F.xxhash64(_meaning()))
    return mappings.groupBy("structure_id", "state_uuid").agg(F.min(h).alias("lo"), F.max(h).alias("hi")).where("lo <> hi").select("structure_id", "state_uuid")


def conflicts(mappings: DataFrame) -> DataFrame:
    """States with more than one meaning in a structure, meanings in order of
    priority, control and state name, NULLs last. Every key's rows are wanted, so
    they are dealt once by key and gathered there; texts are built for the keys
    that stay, meanings compared by their hashes."""
    key = ["structure_id", "state_uuid"]
    item = F.struct(
        F.col("mapping_priority").alias("p"), F.col("control_name").isNull().alias("cn"), F.col("control_name").alias("c"), F.col("state_name").isNull().alias("sn"),
        F.col("state_name").alias("s"), F.col("mapping_source").alias("m"), F.when(_meaning().isNotNull(), F.xxhash64(_meaning())).alias("h"),
    )
    rows = mappings.select(*key, item.alias("_i")).repartition(*key).groupBy(*key).agg(F.sort_array(F.collect_list("_i")).alias("_m"))
    kinds = F.array_distinct(F.filter(F.transform("_m", lambda x: x["h"]), lambda h: h.isNotNull()))
    text = lambda x: F.concat(x["m"], F.lit(":"), F.coalesce(x["c"], F.lit("?")), F.lit("."), F.coalesce(x["s"], F.lit("?")))
    many = rows.withColumn("distinct_meanings", F.size(kinds).cast("long")).where("distinct_meanings > 1")
    return many.select(
        *key, F.size("_m").cast("long").alias("mapping_count"), "distinct_meanings", F.array_min(F.transform("_m", lambda x: x["p"])).alias("best_priority"),
        F.array_join(F.transform("_m", text), " | ").alias("meanings"),
    )
