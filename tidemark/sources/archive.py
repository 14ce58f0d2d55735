"""Immutable Parquet archive in date partitions, with a manifest per batch, which
names every file with its SHA-256."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import Files
from ..operators.keys import bounded, newest

MANIFEST_VERSION = 1


def write_archive(batch: DataFrame, root: str, table: str, first: int, last: int, at: str = "received_at") -> dict:
    """Appends a batch under ``date=`` partitions, then its manifest. A batch is
    known by its row bounds: writing it again changes nothing."""
    spark = batch.sparkSession
    files = Files(spark)
    stem = f"local-{first:020d}-{last:020d}"
    manifest = f"{root}/_manifests/{table}-{stem}.json"
    if files.exists(manifest):
        return json.loads(files.read(manifest))
    work = f"{root}/{table}/batch={stem}"
    batch.withColumn("date", F.to_date(at)).write.mode("overwrite").partitionBy("date").option("compression", "zstd").parquet(work)
    stored = spark.read.parquet(work)
    row = stored.agg(F.count(F.lit(1)).alias("rows"), F.min(at).cast("string").alias("lo"), F.max(at).cast("string").alias("hi")).first()
    made = file_digests(spark, work)
    out = {
        "version": MANIFEST_VERSION, "table": table, "path": work, "rows": row["rows"], "first": first, "last": last,
        "min": row["lo"], "max": row["hi"], "files": made, "sha256": hashlib.sha256("".join(f["sha256"] for f in made).encode()).hexdigest(),
    }
    files.create(manifest, json.dumps(out, sort_keys=True))
    return out


def archive_spool(rows: Callable[[int], DataFrame], root: str, table: str, at: str, max_rows: int = 1000, max_bytes: int = 32 << 20, max_batches: int = 4) -> dict:
    """Archives a spool from the last row archived on, in batches bounded by rows
    and bytes; ``rows`` gives what comes after a row id, with the ids in row_id."""
    done, top = 0, 0
    while done < max_batches:
        spark = rows(0).sparkSession
        files = Files(spark)
        names = [p for p in files.list(f"{root}/_manifests") if p.rsplit("/", 1)[-1].startswith(f"{table}-local-")]
        top = json.loads(files.read(names[-1]))["last"] if names else 0
        batch = bounded(rows(top), ["row_id"], max_rows, max_bytes, "payload_json")
        r = batch.agg(F.min("row_id").alias("lo"), F.max("row_id").alias("hi")).first()
        if r["hi"] is None:
            break
        top = write_archive(batch.drop("row_id"), root, table, r["lo"], r["hi"], at)["last"]
        done += 1
    return {"batches": done, "archived_upto": top}


def file_digests(spark: SparkSession, folder: str) -> list[dict]:
    """Path below the folder, bytes and SHA-256 of every file of a batch, which is
    of bounded size; hashed by the executors."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder)
    got = files.select(F.substring_index("path", folder.rstrip("/").rsplit("/", 1)[-1] + "/", -1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")).orderBy("name").collect()
    return [r.asDict() for r in got]


def damaged(spark: SparkSession, manifest: dict) -> bool:
    """Whether a batch's files differ from its manifest, or cannot be read."""
    try:
        return file_digests(spark, manifest["path"]) != manifest["files"]
    except Exception:
        return True


def _stored(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """Rows of all batches with a manifest, columns united by name."""
    files = Files(spark)
    paths = [json.loads(files.read(p))["path"] for p in files.list(f"{root}/_manifests") if p.rsplit("/", 1)[-1].startswith(f"{table}-local-")]
    if not paths:
        return None
    return spark.read.option("mergeSchema", "true").option("basePath", f"{root}/{table}").parquet(*paths).drop("batch")


def archived_messages(spark: SparkSession, root: str, since: str | None = None) -> DataFrame | None:
    """Messages, the newest ingestion of each; ``since`` prunes date partitions."""
    d = _stored(spark, root, "ws_messages")
    if d is None:
        return None
    if since:
        d = d.where(F.col("date") >= F.lit(since).cast("date"))
    return newest(d.drop("date"), ["source_id", "message_id"], ["ingested_at"])


def archived_structures(spark: SparkSession, root: str) -> DataFrame | None:
    d = _stored(spark, root, "structures")
    return None if d is None else newest(d.drop("date"), ["structure_id"], ["captured_at", "ingested_at"])
