"""Messages to state events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import has_keys, local_time
from ..session import configure
from .asof import asof, resolution
from .mapping import best_meaning

#: Fixed: message types that carry state values.
VALUE_TYPES = (2, 3)


def eligible(messages: DataFrame) -> DataFrame:
    return messages.where(F.col("message_type").isin(*VALUE_TYPES) & has_keys(F.col("payload_json"), "$.parsed"))


def desired(messages: DataFrame, structure_versions: DataFrame) -> DataFrame:
    """Eligible messages with the structure that should explain them."""
    facts = eligible(messages).select("message_id", "source_id", "received_at", "message_type", "ingested_at", "payload_json")
    joined = asof(facts, structure_versions, "source_id", "received_at", "structure_captured_at", "structure_id", ["structure_id", "structure_captured_at", "structure_last_modified_raw"])
    return joined.withColumn("structure_resolution", resolution("structure_id", "received_at", "structure_captured_at"))


_EXPLODE = """
SELECT b.* EXCEPT (payload_json), e.key AS state_uuid, to_json(e.value) AS value_json,
  CASE WHEN schema_of_variant(e.value) RLIKE '^(BIGINT|DOUBLE|FLOAT|DECIMAL|BOOLEAN)' THEN try_variant_get(e.value, '$', 'double') END AS value_numeric,
  CASE WHEN schema_of_variant(e.value) = 'STRING' THEN try_variant_get(e.value, '$', 'string') END AS value_text
FROM {b} b, LATERAL variant_explode(try_variant_get(try_parse_json(b.payload_json), '$.parsed', 'variant')) e
"""


def state_events(batch: DataFrame, mappings: DataFrame) -> DataFrame:
    """One row per message and state id, typed and explained; of repeated keys
    the last counts."""
    spark = configure(batch.sparkSession)
    e = spark.sql(_EXPLODE, b=batch)
    m = best_meaning(mappings).withColumn("_mapped", F.lit(True))
    status = (
        F.when(F.col("_mapped").isNull(), "unresolved").when(F.col("competing_best_mappings") > 1, "ambiguous")
        .when(F.col("mapping_source") == "state", "resolved_state").when(F.col("mapping_source") == "details", "resolved_details")
        .when(F.col("mapping_source") == "uuidAction", "resolved_uuid_action").otherwise("resolved_control")
    )
    return e.join(m, ["structure_id", "state_uuid"], "left").select(
        "received_at", local_time(F.col("received_at")).alias("received_at_berlin"), "source_id", "message_id", "message_type",
        "state_uuid", "state_name", "control_uuid", "control_name", "control_type", "room_uuid", "room_name", "category_uuid",
        "category_name", "value_numeric", "value_text", "value_json", "structure_id", "structure_captured_at",
        F.col("structure_last_modified_raw").alias("structure_last_modified"), "structure_resolution", "mapping_source",
        "mapping_priority", F.coalesce("competing_best_mappings", F.lit(0)).alias("competing_best_mappings"),
        status.alias("resolution_status"), F.col("ingested_at").alias("bronze_ingested_at"), F.current_timestamp().alias("loaded_at"),
    )
