"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed: the word pattern of the contracts (runs without ASCII white space).
SPACE = r"[\x20\x09-\x0D]+"
BATCH_ROWS = 1000

#: What a worker process remembers from task to task, by operator.
_memories: dict[str, dict] = {}


def memory(operator: str) -> dict:
    """An operator's memory in this worker; those of others are given up, as a
    worker may serve several operators in turn."""
    for other in [k for k in _memories if k != operator]:
        _memories.pop(other).clear()
    return _memories.setdefault(operator, {})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; one of our own only where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def saved(df: DataFrame, tag: str, by: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and reread: it cuts the lineage,
    survives lost executors and is read by column, and by parts of column ``by``."""
    spark = df.sparkSession
    # whole texts may be long: fewer rows at once between the JVM and Python
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    out = df.write.option("compression", "zstd")
    (out.partitionBy(by) if by else out).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._saved_at = path
    return back


def forget(*tables: DataFrame, parts: tuple[str, ...] = ("",)) -> None:
    """Deletes tables that ``saved`` wrote, or parts of them, and nothing reads any
    more."""
    for t in tables:
        for part in parts:
            jvm = t.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(f"{t._saved_at}/{part}")
            where.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def cleared(spark: SparkSession) -> None:
    """Shuffle files of steps that are saved go with their last reference."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def words_col(text: Column) -> Column:
    """Words of a text as an array; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where the
    optimizer would copy it into every place that uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def crc_mod(doc_id: Column, m: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(m))


def lower_words(text: str | None) -> list[bytes]:
    """Words after lower-casing A-Z only; bytes.lower and bytes.split treat
    exactly the ASCII letters and \\x20 \\x09-\\x0D."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []
