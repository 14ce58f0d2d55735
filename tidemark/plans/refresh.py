"""The incremental refresh: bounded batches, structures before events, replay by
ledger, one commit per batch.

A batch looks only at what may be new: messages ingested from the frontier on, up to
which all are processed, and those of sources whose structures came after it. As an
ingestion may become visible late, a run that finds nothing there looks at all
messages once, unless ``recheck`` is off."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import events as ev
from ..operators import mapping as mp
from ..operators.keys import newest_batches, unprocessed, without
from ..session import configure
from .store import KEYS, Store

SCHEMAS = {
    "state_uuid_map": schemas.STATE_UUID_MAP, "structure_versions": schemas.STRUCTURE_VERSIONS,
    "state_events": schemas.STATE_EVENTS, "processed_messages": f"{schemas.PROCESSED}, ingested_at timestamp", "load_runs": schemas.LOAD_RUNS,
}


@dataclass(frozen=True)
class Limits:
    """Bounds of a run; the deadline is looked at between batches."""

    batch_size: int = 5000
    max_batches: int = 12
    max_structures: int = 12
    structures_per_batch: int = 1
    max_seconds: float = 600
    slack_seconds: float = 3600
    recheck: bool = True

    def __post_init__(self):
        for name in ("batch_size", "max_batches", "max_structures", "structures_per_batch", "max_seconds"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")


class Refresh:
    """Refreshes a store from Bronze, given as functions that read its tables."""

    def __init__(self, spark: SparkSession, root: str, messages: Callable[[], DataFrame], structures: Callable[[], DataFrame], limits: Limits = Limits(), clock: Callable[[], float] = time.monotonic):
        self.spark, self.messages, self.structures = configure(spark), messages, structures
        self.store, self.limits, self.clock = Store(spark, root, SCHEMAS), limits, clock

    def preflight(self) -> None:
        """Raises if a source table or one of its columns cannot be read."""
        self.messages().select("message_id", "source_id", "received_at", "message_type", "ingested_at", "payload_json").limit(0).collect()
        self.structures().select("structure_id", "source_id", "captured_at", "last_modified", "payload_json", "payload_sha256", "collector_version", "ingested_at").limit(0).collect()
        self.store.probe()

    def sync_structures(self, run_id: str | None = None) -> dict:
        """Maps the oldest structures that are new; counts, 0 if there is none."""
        fresh = without(mp.valid(self.structures()), self.store.read("structure_versions"), ["structure_id"])
        picked = fresh.orderBy(F.col("captured_at").asc_nulls_last(), "structure_id").limit(self.limits.structures_per_batch)
        n = self.store.next_number()
        docs = self.store.write(n, "_structures", picked)
        count = docs.count()
        if not count:
            self.store.drop(n, "_structures")
            return {"structures": 0, "mappings": 0}
        found = mp.controls(docs)
        found = self.store.write(n, "_controls", found)
        maps = self.store.write(n, "state_uuid_map", mp.candidates(docs, found).withColumn("loaded_at", F.current_timestamp()))
        self.store.write(n, "structure_versions", mp.structure_versions(docs, maps, found))
        mappings = maps.count()
        self.store.commit(n, ["state_uuid_map", "structure_versions"], run_id=run_id, structures=count, mappings=mappings)
        self.store.drop(n, "_structures", "_controls")
        return {"structures": count, "mappings": mappings}

    def recent(self, whole: bool = False) -> Callable[[DataFrame], DataFrame]:
        """A filter of messages, and of the ledger, to what a batch has to look at:
        ingested from the frontier on, or of a source with newer structures."""
        frontier, seen = self.store.note("frontier"), self.store.note("seen")
        if whole or frontier is None:
            return lambda df: df
        since = datetime.fromisoformat(frontier) - timedelta(seconds=self.limits.slack_seconds)
        fresh = self.store.batches("structure_versions").where(F.col("batch") > seen)
        sources = [r[0] for r in fresh.select("source_id").distinct().collect()]  # of a few new structures
        at = F.col("ingested_at")
        return lambda df: df.where(at.isNull() | (at >= F.lit(since)) | F.col("source_id").isin(sources))

    def process_batch(self, run_id: str | None = None, whole: bool = False) -> dict:
        """Explains the next messages that are new or whose structure changed."""
        newest = max((c["batch"] for c in self.store.commits() if "structure_versions" in c["tables"]), default=0)
        recent = self.recent(whole)
        want = ev.desired(recent(self.messages()), self.store.read("structure_versions"))
        ledger = newest_batches(recent(self.store.batches("processed_messages")), KEYS, "batch")
        todo = unprocessed(want, ledger, ["source_id", "message_id"], "structure_id")
        picked = todo.orderBy(F.col("ingested_at").asc_nulls_last(), "source_id", "message_id").limit(self.limits.batch_size)
        n = self.store.next_number()
        batch = self.store.write(n, "_batch", picked)
        row = batch.agg(F.count(F.lit(1)).alias("n"), F.max("ingested_at").alias("top")).first()
        if not row["n"]:
            self.store.drop(n, "_batch")
            return {"messages": 0, "events": 0, "source_max_ingested_at": None}
        done = self.store.write(n, "state_events", ev.state_events(batch, self.store.read("state_uuid_map")))
        self.store.write(n, "processed_messages", batch.select("source_id", "message_id", "structure_id", "ingested_at"))
        events = done.count()
        # All that was ingested before the last one picked is processed now.
        top = None if row["top"] is None else batch.agg(F.date_format(F.max("ingested_at"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")).first()[0]
        old, caught_up = self.store.note("frontier"), row["n"] < self.limits.batch_size
        moved = {}
        if old is None or top is None or top >= old or caught_up:
            moved = {"frontier": max(filter(None, (old, top)), default=None), "seen": newest}
        self.store.commit(n, ["state_events", "processed_messages"], run_id=run_id, messages=row["n"], events=events, **moved)
        self.store.drop(n, "_batch")
        return {"messages": row["n"], "events": events, "source_max_ingested_at": row["top"]}

    def run(self) -> dict:
        """Structures until none is new, then messages; stops at a limit."""
        self.preflight()
        run_id, started, began = uuid.uuid4().hex, datetime.now(UTC), self.clock()
        out = {"load_run_id": run_id, "started_at": started, "structures_loaded": 0, "mappings_loaded": 0, "messages_processed": 0, "events_inserted": 0, "source_max_ingested_at": None, "error_message": None}
        late = lambda: self.clock() - began >= self.limits.max_seconds
        try:
            reason = "structure_limit"
            for _ in range(self.limits.max_structures):
                if late():
                    reason = "time_limit"
                    break
                got = self.sync_structures(run_id)
                if not got["structures"]:
                    reason = ""
                    break
                out["structures_loaded"] += got["structures"]
                out["mappings_loaded"] += got["mappings"]
            if not reason:
                reason = "batch_limit"
                for _ in range(self.limits.max_batches):
                    if late():
                        reason = "time_limit"
                        break
                    got = self.process_batch(run_id)
                    if not got["messages"] and self.limits.recheck:
                        got = self.process_batch(run_id, whole=True)
                    if not got["messages"]:
                        reason = "caught_up"
                        break
                    out["messages_processed"] += got["messages"]
                    out["events_inserted"] += got["events"]
                    out["source_max_ingested_at"] = max(filter(None, (out["source_max_ingested_at"], got["source_max_ingested_at"])), default=None)
            out |= {"status": "succeeded" if reason == "caught_up" else "partial", "stop_reason": reason}
        except Exception as e:
            self._log(out | {"status": "failed", "error_message": type(e).__name__})
            raise
        self._log(out)
        return out

    def _log(self, out: dict) -> None:
        row = out | {"finished_at": datetime.now(UTC)}
        names = [f.name for f in self.spark.createDataFrame([], schemas.LOAD_RUNS).schema]
        df = self.spark.createDataFrame([tuple(row.get(c) for c in names)], schemas.LOAD_RUNS)
        n = self.store.next_number()
        self.store.write(n, "load_runs", df)
        self.store.commit(n, ["load_runs"], run_id=out["load_run_id"])
