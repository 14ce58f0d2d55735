"""Outbox of batches and their publication.

An outbox batch is a folder with four tables and a manifest of their row counts
and checksums, written last. Publishing checks the manifests, skips batches that
the ledger knows, combines the rest so that the newest batch wins, and replaces
messages' events, current states and hours; the ledger row comes with the commit,
so a retry after a lost acknowledgement changes nothing."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import Files
from ..operators import marts
from ..operators.keys import newest_batches, replace, within

KEYS = {
    "messages": ("source_id", "message_id"), "state_events": ("source_id", "message_id"),
    "current_state": ("source_id", "state_uuid"), "hourly_state": ("source_id", "state_uuid", "hour_utc"),
}


class CorruptBatch(RuntimeError):
    """A batch's rows differ from its manifest."""


def _checksum(df: DataFrame) -> dict:
    # a sum, as equal rows would cancel each other under XOR
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")).cast("string").alias("h")).first()
    return {"rows": r["n"], "hash": r["h"]}


class Outbox:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    def folder(self, n: int) -> str:
        return f"{self.root}/batch-{n:020d}"

    def export(self, n: int, messages: DataFrame, new_events: DataFrame, all_events: DataFrame) -> dict:
        """Writes a batch with the states and hours that its events touch."""
        touched = within(all_events, new_events, ["source_id", "state_uuid"])
        tables = {
            "messages": messages, "state_events": new_events, "current_state": marts.current_state(touched, by_load=True),
            "hourly_state": marts.hourly_state(marts.touched_hours(touched, new_events)),
        }
        manifest: dict = {"batch": n, "tables": {}}
        for t, df in tables.items():
            path = f"{self.folder(n)}/{t}"
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
            manifest["tables"][t] = _checksum(self.spark.read.parquet(path))
        manifest["bytes"] = sum(self.files.size(f"{self.folder(n)}/{t}") for t in tables)
        self.files.create(f"{self.folder(n)}/_manifest.json", json.dumps(manifest, sort_keys=True))
        return manifest

    def pending(self) -> list[int]:
        """Batches with a manifest and no acknowledgement, oldest first."""
        out = []
        for p in self.files.list(self.root):
            name = p.rsplit("/", 1)[-1]
            if name.startswith("batch-") and self.files.exists(f"{p}/_manifest.json") and not self.files.exists(f"{p}/_ack.json"):
                out.append(int(name[6:]))
        return out

    def bytes(self, n: int) -> int:
        return json.loads(self.files.read(f"{self.folder(n)}/_manifest.json"))["bytes"]

    def read(self, n: int) -> dict[str, DataFrame]:
        """Tables of a batch, checked against its manifest."""
        manifest = json.loads(self.files.read(f"{self.folder(n)}/_manifest.json"))
        out = {}
        for t, want in manifest["tables"].items():
            try:
                df = self.spark.read.parquet(f"{self.folder(n)}/{t}")
                got = _checksum(df)
            except Exception as e:
                raise CorruptBatch(f"batch {n}, {t}") from e
            if got != want:
                raise CorruptBatch(f"batch {n}, {t}: {got} instead of {want}")
            out[t] = df
        return out

    def acknowledge(self, n: int) -> None:
        """Marks a batch as published and drops its data; the manifest stays."""
        self.files.create(f"{self.folder(n)}/_ack.json", json.dumps({"batch": n, "at": time.time()}))
        for t in KEYS:
            self.files.delete(f"{self.folder(n)}/{t}")


def combine(batches: dict[int, dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """One batch of several: of each message, state and hour the newest batch's
    rows. Events follow their message's newest batch, also when it has none."""
    joined: dict[str, DataFrame] = {}
    for t in KEYS:
        for n, tables in sorted(batches.items()):
            d = tables[t].withColumn("_batch", F.lit(n))
            joined[t] = joined[t].unionByName(d) if t in joined else d
    out = {t: newest_batches(joined[t], KEYS[t], "_batch").drop("_batch") for t in ("messages", "current_state", "hourly_state")}
    top = newest_batches(joined["messages"], KEYS["messages"], "_batch").select(*KEYS["messages"], "_batch").distinct()
    out["state_events"] = joined["state_events"].join(top, [*KEYS["messages"], "_batch"], "left_semi").drop("_batch")
    return out


class Target:
    """Published tables: whole snapshots and a pointer to the current one."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    def commits(self) -> list[dict]:
        return [json.loads(self.files.read(p)) for p in self.files.list(f"{self.root}/_commits")]

    def known(self) -> set[int]:
        return {n for c in self.commits() for n in c["batches"]}

    def table(self, name: str) -> DataFrame | None:
        log = self.commits()
        return self.spark.read.parquet(f"{self.root}/{name}/v={log[-1]['version']:020d}") if log else None

    def publish(self, batches: list[int], tables: dict[str, DataFrame]) -> None:
        log = self.commits()
        v = log[-1]["version"] + 1 if log else 1
        touched = {"state_events": tables["messages"].select(*KEYS["messages"])}
        for t in ("state_events", "current_state", "hourly_state"):
            old, new = self.table(t), tables[t]
            df = new if old is None else replace(old, new, KEYS[t], touched.get(t))
            df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/{t}/v={v:020d}")
        if not self.files.create(f"{self.root}/_commits/{v:020d}.json", json.dumps({"version": v, "batches": batches})):
            raise RuntimeError(f"version {v} is taken")


def publish(outbox: Outbox, target: Target, max_batches: int = 100, max_seconds: float = 180, max_bytes: int = 16 << 20, clock=time.monotonic) -> dict:
    """Publishes pending batches, combined, the first one and as many more as
    ``max_bytes`` of files hold; those known already are only acknowledged."""
    began, known = clock(), target.known()
    todo = outbox.pending()[:max_batches]
    replayed = [n for n in todo if n in known]
    fresh: dict[int, dict[str, DataFrame]] = {}
    size = 0
    for n in todo:
        if n not in known:
            size += outbox.bytes(n)
            if fresh and (size > max_bytes or clock() - began >= max_seconds):
                break
            fresh[n] = outbox.read(n)
    if fresh:
        target.publish(sorted(fresh), combine(fresh))
    for n in [*replayed, *fresh]:
        outbox.acknowledge(n)
    return {"published": len(fresh), "replayed": len(replayed), "pending": len(outbox.pending())}
