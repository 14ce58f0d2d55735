"""Tables and views served from state events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import utc_text
from ..schemas import CURRENT_STATE
from .keys import newest, within
from .mapping import conflict_keys, conflicts

#: Fixed: lower-case names that decide a state's retention class.
METER_NAMES = ("total", "totalday", "totalweek", "totalmonth", "totalyear", "totalneg", "totalnegday", "totalnegweek", "totalnegmonth", "totalnegyear")
LIVE_NAMES = ("actual", "conscurr", "gridcurr", "gpwr")
DISCRETE_TYPES = ("switch", "pushbutton", "infoonlydigital", "presence", "windowmonitor", "alarm", "timedswitch")
#: Fixed: advice by class.
GUIDANCE = {
    "meter_counter": "Candidate for 1-minute snapshots or threshold-based Gold aggregation",
    "live_value": "Retain at finer granularity in Gold",
    "discrete_state": "Model as true change events in Gold",
    "unclassified": "Inspect semantics before aggregation",
}


def current_state(events: DataFrame, by_load: bool = False) -> DataFrame:
    """The latest event of every (source, state); ties by message, and by load
    time where tables of several loads are merged."""
    top = newest(events, ["source_id", "state_uuid"], ["received_at", "message_id", *(["loaded_at"] if by_load else [])])
    return top.withColumnsRenamed({"received_at": "last_received_at", "received_at_berlin": "last_received_at_berlin"}).select(*CURRENT_STATE)


def hourly_state(events: DataFrame, keys: tuple[str, ...] = ("source_id", "state_uuid"), at: str = "received_at", value: str = "value_numeric", tie: tuple[str, ...] = ("message_id",)) -> DataFrame:
    """Per key and UTC hour: number of events and of numbers, and their minimum,
    maximum, mean, first and last, NULLs ignored."""
    x, known = F.col(value), F.col(value).isNotNull()
    order = F.when(known, F.struct(at, *tie))
    return events.groupBy(*keys, F.date_trunc("hour", at).alias("hour_utc")).agg(
        F.count(F.lit(1)).alias("event_count"), F.count(x).alias("numeric_count"), F.min(x).alias("numeric_min"),
        F.max(x).alias("numeric_max"), F.avg(x).alias("numeric_avg"),
        F.min_by(x, order).alias("numeric_first"), F.max_by(x, order).alias("numeric_last"),
    )


def register_views(spark, events: DataFrame, mappings: DataFrame, structure_versions: DataFrame, structures: DataFrame, prefix: str = "") -> list[str]:
    """Makes the served tables temporary views, for SQL and the catalog; their
    names."""
    views = {
        "state_events": events, "current_state": current_state(events), "hourly_state": hourly_state(events), "mapping_conflicts": conflicts(mappings), "retention_hints": retention_hints(events),
        "unresolved_states": unresolved_states(events), "data_quality": data_quality(events, conflict_keys(mappings), structure_versions, structures),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{name}" for name in views]


def touched_hours(events: DataFrame, new: DataFrame) -> DataFrame:
    """Events of the (source, state, hour) that new events fall into."""
    hour = lambda d: d.withColumn("_hour", F.date_trunc("hour", "received_at"))
    return within(hour(events), hour(new), ["source_id", "state_uuid", "_hour"]).drop("_hour")


def retention_hints(events: DataFrame) -> DataFrame:
    """Class and advice per resolved state; of several names the smallest counts,
    so that the result does not depend on order."""
    e = events.where(F.col("resolution_status").like("resolved_%")).groupBy("source_id", "state_uuid").agg(*[F.min(c).alias(c) for c in ("state_name", "control_name", "control_type")])
    kind = (
        F.when(F.lower("state_name").isin(*METER_NAMES), "meter_counter").when(F.lower("state_name").isin(*LIVE_NAMES), "live_value")
        .when(F.lower("control_type").isin(*DISCRETE_TYPES), "discrete_state").otherwise("unclassified")
    )
    advice = F.create_map(*[F.lit(x) for kv in GUIDANCE.items() for x in kv])
    return e.withColumn("retention_class", kind).withColumn("gold_guidance", F.element_at(advice, F.col("retention_class")))


def unresolved_states(events: DataFrame) -> DataFrame:
    return events.where("resolution_status = 'unresolved'").groupBy("source_id", "state_uuid").agg(
        F.min("received_at").alias("first_seen"), F.max("received_at").alias("last_seen"), F.count(F.lit(1)).alias("event_count"),
        F.countDistinct("message_id").alias("message_count"),
        F.count_if(F.col("structure_resolution") == "no_valid_structure").alias("events_without_valid_structure"),
    )


def data_quality(events: DataFrame, mapping_conflicts: DataFrame, structure_versions: DataFrame, structures: DataFrame) -> DataFrame:
    """Fourteen (metric, value_numeric, value_text) rows from one pass over the
    events and one aggregation for repeats."""
    s = F.col("resolution_status")
    n = F.count(F.lit(1))
    share = lambda c: F.try_divide(100.0 * F.count_if(c), n)
    one = events.agg(
        n.alias("silver_events"), F.count_if(s.like("resolved_%")).alias("resolved_events"), F.count_if(s == "ambiguous").alias("ambiguous_events"),
        F.count_if(s == "unresolved").alias("unresolved_events"), share(s.like("resolved_%")).alias("resolved_percent"), share(s == "unresolved").alias("unresolved_percent"),
        F.count_if(F.col("structure_resolution") == "no_valid_structure").alias("events_without_valid_structure"),
        F.count_if(F.col("structure_resolution") == "fallback_earliest").alias("events_using_earliest_structure_fallback"),
        utc_text(F.min("received_at")).alias("min_event_time_utc"), utc_text(F.max("received_at")).alias("max_event_time_utc"),
    )
    repeats = events.groupBy("source_id", "message_id", "state_uuid").count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicate_message_state_pairs"))
    size = lambda d, name: d.agg(F.count(F.lit(1)).alias(name))
    # one row each
    row = one.crossJoin(repeats).crossJoin(size(mapping_conflicts, "mapping_conflict_uuids")).crossJoin(size(structure_versions, "valid_structures")).crossJoin(size(structures, "_all"))
    row = row.withColumn("invalid_structures_excluded", F.col("_all") - F.col("valid_structures"))
    numbers = (
        "silver_events", "resolved_events", "ambiguous_events", "unresolved_events", "resolved_percent", "unresolved_percent",
        "duplicate_message_state_pairs", "events_without_valid_structure", "events_using_earliest_structure_fallback",
        "mapping_conflict_uuids", "valid_structures", "invalid_structures_excluded",
    )
    item = lambda m, x, t: F.struct(F.lit(m).alias("metric"), x.cast("double").alias("value_numeric"), t.cast("string").alias("value_text"))
    items = [item(m, F.col(m), F.lit(None)) for m in numbers] + [item(m, F.lit(None), F.col(m)) for m in ("min_event_time_utc", "max_event_time_utc")]
    return row.select(F.explode(F.array(*items)).alias("i")).select("i.*")
