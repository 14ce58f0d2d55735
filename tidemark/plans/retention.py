"""Retention gated by acknowledgements."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import expired, without


def prune_uploaded(spool: DataFrame, before: datetime, limit: int, checkpoints: list[int | None], at: str = "uploaded_at") -> DataFrame:
    """Rows that stay: the oldest ``limit`` uploaded before ``before`` go, never
    one beyond any checkpoint, nor the newest row. A missing checkpoint keeps
    everything."""
    if any(c is None for c in checkpoints) or not checkpoints:
        return spool
    gate = min(checkpoints)
    top = spool.agg(F.max("row_id")).first()[0]
    old = spool.where((F.col(at) < F.lit(before)) & (F.col("row_id") <= gate) & (F.col("row_id") < F.lit(top))).orderBy(at, "row_id").limit(limit)
    return without(spool, old, ["row_id"])


def prune_archive(archive: DataFrame, before: datetime, processed: DataFrame, queued: DataFrame, archived_upto: int, imported_upto: int, limit: int) -> DataFrame:
    """Rows that stay: processed, unqueued and older than ``before`` go, and only
    once the Parquet archive is as far as the import."""
    if archived_upto < imported_upto:
        return archive
    keys = ["source_id", "message_id"]
    old = expired(archive, "received_at", F.lit(before), processed, queued, keys).orderBy("received_at", *keys).limit(limit)
    return without(archive, old, keys)


def checked_cursor(stored: int, acknowledged: int) -> int:
    """The cursor to go on from. A store behind what it acknowledged has lost
    rows: fail instead of skipping them; a lagging acknowledgement is mended."""
    if stored < acknowledged:
        raise RuntimeError(f"the store ends at {stored} but {acknowledged} was acknowledged")
    return stored
