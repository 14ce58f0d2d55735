"""Versioned tables on plain Parquet: append-only batches and a commit log.

A batch writes its tables under ``<table>/batch=<n>`` and becomes visible when
``_commits/<n>.json`` is created, which only one writer can do. Readers take, for
every message, the rows of its newest committed batch, so a replay replaces a
message's earlier rows without rewriting them; a replay that yields no rows hides
the old ones. A crash before the commit leaves an invisible folder that the next
attempt overwrites. ``compact`` rewrites what is visible into one batch, from
which on the log is read; ``vacuum`` deletes what came before."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..files import Files
from ..operators.keys import newest_batches, without

KEYS = ("source_id", "message_id")


class ConcurrentCommit(RuntimeError):
    """Another writer committed the same batch number first."""


def _number(path: str) -> int:
    return int(path.rsplit("/", 1)[-1].split(".")[0])


class Store:
    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, str]):
        self.spark, self.root, self.schemas, self.files = spark, root.rstrip("/"), schemas, Files(spark)

    def commits(self) -> list[dict]:
        """The log from the last compaction on."""
        names = self.files.list(f"{self.root}/_commits")
        if not names:
            return []
        last = json.loads(self.files.read(names[-1]))
        return [json.loads(self.files.read(p)) for p in names[:-1] if _number(p) >= last["start"]] + [last]

    def next_number(self) -> int:
        names = self.files.list(f"{self.root}/_commits")
        return _number(names[-1]) + 1 if names else 1

    def path(self, table: str, n: int) -> str:
        return f"{self.root}/{table}/batch={n:020d}"

    def write(self, n: int, table: str, df: DataFrame) -> DataFrame:
        """A batch's table, written and reread; still invisible."""
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(table, n))
        return self.spark.read.schema(df.schema).parquet(self.path(table, n))

    def commit(self, n: int, tables: list[str], **info) -> None:
        live = [c for c in self.commits()]
        start = info.pop("start", live[-1]["start"] if live else 1)
        body = json.dumps({"batch": n, "tables": tables, "start": start, **info}, sort_keys=True, default=str)
        if not self.files.create(f"{self.root}/_commits/{n:020d}.json", body):
            raise ConcurrentCommit(f"batch {n} is taken")

    def batches(self, table: str) -> DataFrame:
        """Committed rows with their batch number."""
        log = self.commits()
        start = log[-1]["start"] if log else 1
        paths = [self.path(table, c["batch"]) for c in log if table in c["tables"] and c["batch"] >= start]
        schema = f"{self.schemas[table]}, batch long"
        if not paths:
            return self.spark.createDataFrame([], schema)
        d = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(*paths)
        return d

    def read(self, table: str) -> DataFrame:
        return self.batches(table).drop("batch")

    def ledger(self) -> DataFrame:
        """The newest structure under which each message was processed."""
        return newest_batches(self.batches("processed_messages"), KEYS, "batch").drop("batch")

    def note(self, name: str):
        """The newest value that a commit has of a name, or None."""
        return next((c[name] for c in reversed(self.commits()) if c.get(name) is not None), None)

    def drop(self, n: int, *tables: str) -> None:
        """Deletes a batch's working tables, which no commit names."""
        for t in tables:
            self.files.delete(self.path(t, n))

    def probe(self) -> None:
        """Raises if the store cannot be written: a file is made and taken back."""
        path = f"{self.root}/_probe/{id(self)}"
        if not self.files.create(path, ""):
            raise PermissionError(path)
        self.files.delete(path)

    def events(self) -> DataFrame:
        """Events of each message's newest batch, by the ledger's batch number."""
        return newest_batches(self.batches("state_events"), KEYS, "batch", of=self.batches("processed_messages")).drop("batch")

    def compact(self, lost: dict[str, DataFrame] | None = None) -> int:
        """Rewrites what is visible, less the rows by key that ``lost`` names for a
        table, as one batch; earlier ones are then unused."""
        n, log = self.next_number(), self.commits()
        tables = [t for t in self.schemas if any(t in c["tables"] for c in log)]
        for t in tables:
            df = self.events() if t == "state_events" else self.ledger() if t == "processed_messages" else self.read(t)
            if lost and t in lost:
                df = without(df, lost[t], lost[t].columns)
            seen = Observation()
            rows = self.write(n, t, df.observe(seen, F.count(F.lit(1)).alias("n"))).count()
            if rows != seen.get["n"]:  # never make a snapshot visible that lost rows
                raise RuntimeError(f"compaction of {t} kept {rows} rows")
        notes = {k: v for c in log for k, v in c.items() if k not in ("batch", "tables", "start")}
        self.commit(n, tables, **notes | {"start": n, "compacted": True})
        return n

    def delete(self, table: str, rows: DataFrame, keys: list[str]) -> int:
        """Deletes the rows of these keys from a table."""
        return self.compact({table: rows.select(*keys).distinct()})

    def vacuum(self) -> int:
        """Deletes the batches and commits that the last compaction has replaced;
        how many. Readers that began before it must have ended."""
        log, gone = self.commits(), 0
        start = log[-1]["start"] if log else 0
        for t in [p for p in self.files.list(self.root) if not p.rsplit("/", 1)[-1].startswith("_commits")]:
            for p in self.files.list(t):
                if "batch=" in p.rsplit("/", 1)[-1] and int(p.rsplit("batch=", 1)[1]) < start:
                    self.files.delete(p)
                    gone += 1
        for p in self.files.list(f"{self.root}/_commits"):
            if _number(p) < start:
                self.files.delete(p)
        return gone
