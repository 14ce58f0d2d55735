"""Streams: landing Bronze, refreshing on arrival, and latest values by key.

Lateness is handled by the ledger, not by watermarks: nothing late is dropped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..files import Files
from ..operators.keys import insert_or_ignore, newest, replace
from ..sources.ndjson import validated


def land(stream: DataFrame, root: str, checkpoint: str, keys: list[str], at: str = "received_at") -> StreamingQuery:
    """Appends what is new to date partitions: valid JSON, first row of a key.
    Batches are idempotent: each overwrites its own folder and a replay looks only
    at the others."""

    def write(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        own = f"{root}/batch={n}"
        others = [p for p in Files(spark).list(root) if p.rsplit("/", 1)[-1].startswith("batch=") and not p.endswith(f"batch={n}")]
        new = validated(batch) if "payload_json" in batch.columns else batch
        # only keys are read of what is stored
        stored = spark.read.schema(batch.schema).parquet(*others).select(*keys) if others else spark.createDataFrame([], batch.select(*keys).schema)
        fresh = insert_or_ignore(stored, new, keys)
        fresh.withColumn("date", F.to_date(at)).write.mode("overwrite").partitionBy("date").option("compression", "zstd").parquet(own)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def refresh_stream(stream: DataFrame, checkpoint: str, run: Callable[[], dict]) -> StreamingQuery:
    """Runs a refresh after each arrival of Bronze files."""
    return stream.writeStream.foreachBatch(lambda _batch, _n: run()).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_stream(stream: DataFrame, root: str, checkpoint: str, keys: list[str], by: list[str]) -> StreamingQuery:
    """Keeps each key's newest row as a snapshot per batch; snapshot n is made of
    n - 1 and the batch, so a replayed batch gives the same one."""

    def merge(batch: DataFrame, n: int) -> None:
        spark: SparkSession = batch.sparkSession
        top = newest(batch, keys, by)
        if n and Files(spark).exists(f"{root}/v={n - 1}"):
            old = spark.read.schema(batch.schema).parquet(f"{root}/v={n - 1}")
            top = replace(old, newest(top.unionByName(old), keys, by), keys)
        top.write.mode("overwrite").parquet(f"{root}/v={n}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_snapshot(spark: SparkSession, root: str) -> DataFrame:
    versions = [int(p.rsplit("=", 1)[1]) for p in Files(spark).list(root) if "v=" in p.rsplit("/", 1)[-1]]
    return spark.read.parquet(f"{root}/v={max(versions)}")


def hourly_stream(stream: DataFrame, keys: list[str], at: str, value: str, late: str = "1 day") -> DataFrame:
    """Append-only hourly counts and bounds for consumers that want final hours;
    here, and only here, rows later than ``late`` are dropped."""
    x = F.col(value)
    return stream.withWatermark(at, late).groupBy(*keys, F.window(at, "1 hour")).agg(
        F.count(F.lit(1)).alias("event_count"), F.count(x).alias("numeric_count"), F.min(x).alias("numeric_min"), F.max(x).alias("numeric_max"),
    ).withColumn("hour_utc", F.col("window.start")).drop("window")
