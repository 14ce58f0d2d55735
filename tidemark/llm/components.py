"""Connected components of a table of links."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


LOCAL_LINKS = 200_000  # links (16 bytes each) that one task may join up


def _union_find(batches):
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            x, y = root(x), root(y)
            up[max(x, y)] = min(x, y)
    ids = list(up)
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([root(x) for x in ids], pa.int64())], ["id", "component"])


def components(links: DataFrame, local_links: int = LOCAL_LINKS) -> DataFrame:
    """``links(a, b)`` -> ``(id, component)`` for every linked id, component
    being the smallest id reachable.

    Up to ``local_links`` links, counted first, are joined up by one task. More
    take rounds of large-star and small-star steps; each round is two
    aggregations and joins over the links, written to the shared folder, and a
    hub's rows are pre-aggregated, never gathered. Results are the same.

    No links give an empty result; self links and repeats are harmless; null
    ends are ignored."""
    e = saved(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    if e.count() <= local_links:
        return saved(e.coalesce(1).mapInArrow(_union_find, "id long, component long"), "components")
    before = None
    while True:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u")
        nxt = (
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low2.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct()
        )
        e = saved(nxt, "links")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    ends = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return ends.unionByName(roots)
