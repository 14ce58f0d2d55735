"""Bounded upload of a spool into Bronze.

A row is uploaded when a committed Bronze batch holds its key, so there is no
acknowledgement to lose: a batch that was committed is never sent again, and one
that was not is sent whole. Failures leave only the exception's class and a count;
``outcome`` is told the keys of every batch and what became of it, for spools that
keep attempts by row."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.keys import insert_or_ignore, without
from ..sources.ndjson import validated
from .store import ConcurrentCommit, Store

PAUSE_S = 0.2
TABLES = {"ws_messages": (schemas.MESSAGES, "message_id", "received_at"), "structures": (schemas.STRUCTURES, "structure_id", "captured_at")}


@dataclass(frozen=True)
class UploadLimits:
    batch_size: int = 5000
    max_batches: int = 12
    max_seconds: float = 240

    def __post_init__(self):
        if min(self.batch_size, self.max_batches, self.max_seconds) < 1:
            raise ValueError("limits must be at least 1")


class Uploader:
    """``spools`` gives the spool of each table; columns that it lacks are NULL,
    ``ingested_at`` is the upload's time."""

    def __init__(self, spark: SparkSession, root: str, spools: dict[str, Callable[[], DataFrame]], limits: UploadLimits = UploadLimits(), clock: Callable[[], float] = time.monotonic, outcome: Callable[[str, list[str], str | None], object] | None = None):
        self.spark, self.spools, self.limits, self.clock, self.outcome = spark, spools, limits, clock, outcome
        self.store = Store(spark, root, {t: TABLES[t][0] for t in spools})

    def bronze(self, table: str) -> DataFrame:
        return self.store.read(table)

    def pending(self, table: str) -> DataFrame:
        key = TABLES[table][1]
        return without(self.spools[table](), self.bronze(table).select(key), [key])

    def upload_batch(self, table: str) -> int:
        """Rows of the oldest pending batch that are now in Bronze."""
        schema, key, at = TABLES[table]
        picked = self.pending(table).orderBy(F.col(at).asc_nulls_last(), key).limit(self.limits.batch_size)
        n = self.store.next_number()
        names = [f.name for f in self.spark.createDataFrame([], schema).schema]
        have = picked.columns
        row = picked.select(*[F.current_timestamp().alias(c) if c == "ingested_at" else F.col(c) if c in have else F.lit(None).alias(c) for c in names])
        keys = [] if self.outcome is None else [r[0] for r in picked.select(key).collect()]  # of a batch
        try:
            done = self.store.write(n, table, insert_or_ignore(self.bronze(table).select(key), validated(row), [key], [at]))
            count = done.count()
            if count:
                self.store.commit(n, [table], rows=count)
        except ConcurrentCommit:
            raise
        except Exception as e:
            if keys:
                self.outcome(table, keys, type(e).__name__)
            raise
        if keys:
            self.outcome(table, keys, None)
        return count

    def run(self) -> dict:
        """Structures first, then messages; stops at a limit or when caught up."""
        began, out, batches = self.clock(), {t: 0 for t in self.spools}, 0
        reason = "caught_up"
        try:
            for t in sorted(self.spools, reverse=False, key=lambda t: t != "structures"):
                while True:
                    if self.clock() - began >= self.limits.max_seconds:
                        reason = "time_limit"
                        break
                    if batches >= self.limits.max_batches:
                        reason = "batch_limit"
                        break
                    try:
                        count = self.upload_batch(t)
                    except ConcurrentCommit:
                        batches += 1  # another uploader took the number; look again a little later
                        time.sleep(PAUSE_S)
                        continue
                    if not count:
                        break
                    out[t] += count
                    batches += 1
        except Exception as e:
            path = f"{self.store.root}/_failures.json"
            old = json.loads(self.store.files.read(path)) if self.store.files.exists(path) else {"attempts": 0}
            self.store.files.replace(path, json.dumps({"attempts": old["attempts"] + 1, "last_error": type(e).__name__}))
            raise
        return {"uploaded": out, "batches": batches, "stop_reason": reason}
