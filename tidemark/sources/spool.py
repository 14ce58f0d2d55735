"""SQLite spools as a data source, batch and streaming, by row-id ranges.

Reads are read-only and never create a file. The streaming reader's offset is
the highest row id; a batch is bounded by rows and by bytes of its largest column,
one row at least. Outcomes of an upload are noted in chunks of rows. SQLite is a local file, so this
source is for the machine that captures; a cluster reads what it lands."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType, TimestampType


#: Fixed: bytes of a batch, rows noted at once, characters of an error that are kept.
MOST_BYTES, CHUNK, ERROR_CHARS = 32 << 20, 250, 2000


def _connect(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True, timeout=10)


def _value(x, is_time: bool):
    if x is None or not is_time:
        return x
    t = datetime.fromisoformat(x)
    return t if t.tzinfo else t.replace(tzinfo=UTC)


def _rows(path: str, table: str, schema: StructType, after: int, upto: int) -> Iterator[tuple]:
    times = [isinstance(f.dataType, TimestampType) for f in schema.fields]
    cols = ", ".join("rowid" if f.name == "row_id" else f'"{f.name}"' for f in schema.fields)
    con = _connect(path)
    try:
        for r in con.execute(f'SELECT {cols} FROM "{table}" WHERE rowid > ? AND rowid <= ? ORDER BY rowid', (after, upto)):
            yield tuple(_value(x, t) for x, t in zip(r, times))
    finally:
        con.close()


class Range(InputPartition):
    def __init__(self, after: int, upto: int):
        self.after, self.upto = after, upto


class _Batch(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.table, self.schema = options["path"], options["table"], schema
        self.after, self.parts = int(options.get("after", 0)), int(options.get("partitions", 4))

    def partitions(self):
        con = _connect(self.path)
        try:
            top = con.execute(f'SELECT coalesce(max(rowid), 0) FROM "{self.table}"').fetchone()[0]
        finally:
            con.close()
        step = max(1, -(-(top - self.after) // self.parts))
        return [Range(a, min(a + step, top)) for a in range(self.after, top, step)] or [Range(self.after, self.after)]

    def read(self, partition: Range):
        return _rows(self.path, self.table, self.schema, partition.after, partition.upto)


class _Stream(SimpleDataSourceStreamReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.table, self.schema = options["path"], options["table"], schema
        self.start, self.most = int(options.get("after", 0)), int(options.get("maxrows", options.get("maxRows", 1000)))
        self.most_bytes = int(options.get("maxbytes", options.get("maxBytes", MOST_BYTES)))
        self.sized = "payload_json" if "payload_json" in schema.fieldNames() else None

    def initialOffset(self):
        return {"rowid": self.start}

    def read(self, start: dict):
        con = _connect(self.path)
        try:
            size = f'coalesce(length(CAST("{self.sized}" AS BLOB)), 0)' if self.sized else "0"
            q = f'SELECT rowid, {size} FROM "{self.table}" WHERE rowid > ? ORDER BY rowid LIMIT ?'
            top, total = None, 0
            for row, n in con.execute(q, (start["rowid"], self.most)):
                total += n
                if top is not None and total > self.most_bytes:
                    break
                top = row
        finally:
            con.close()
        end = start["rowid"] if top is None else top
        return iter(list(_rows(self.path, self.table, self.schema, start["rowid"], end))), {"rowid": end}

    def readBetweenOffsets(self, start: dict, end: dict):
        return _rows(self.path, self.table, self.schema, start["rowid"], end["rowid"])


class SpoolDataSource(DataSource):
    """Options: path, table, after (row id), partitions or maxRows. A column
    row_id in the schema holds the row id."""

    @classmethod
    def name(cls) -> str:
        return "spool"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Batch(dict(self.options), schema)

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
        return _Stream(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SpoolDataSource)


def tables(path: str) -> list[str]:
    """Names of a spool's tables."""
    con = _connect(path)
    try:
        return [r[0] for r in con.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name")]
    finally:
        con.close()


def read_spool(spark: SparkSession, path: str, table: str, schema: str, after: int = 0) -> DataFrame:
    register(spark)
    return spark.read.format("spool").schema(schema).option("path", path).option("table", table).option("after", after).load()


def _noted(path: str, table: str, key: str, ids: list[str], assignments: str, values: tuple) -> int:
    con, n = sqlite3.connect(path, timeout=10), 0
    try:
        for a in range(0, len(ids), CHUNK):
            part = ids[a : a + CHUNK]
            with con:  # a chunk is a transaction
                n += con.execute(f'UPDATE "{table}" SET {assignments} WHERE "{key}" IN ({", ".join("?" * len(part))}) AND uploaded_at IS NULL', (*values, *part)).rowcount
    finally:
        con.close()
    return n


def note_uploaded(path: str, table: str, key: str, ids: list[str], now: datetime | None = None) -> int:
    """Marks rows of a batch as uploaded, once; how many were not."""
    return _noted(path, table, key, ids, "uploaded_at = ?, last_upload_error = NULL", ((now or datetime.now(UTC)).isoformat(),))


def note_failed(path: str, table: str, key: str, ids: list[str], error: str) -> int:
    """Counts an attempt of rows that are not uploaded, and keeps the error."""
    return _noted(path, table, key, ids, "upload_attempts = upload_attempts + 1, last_upload_error = ?", (error[:ERROR_CHARS],))
