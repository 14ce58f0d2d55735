"""As-of join of facts to the version of a dimension valid at their time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000
VERSIONS_OF_KEY = 64  # of a broadcast dimension: a fact looks at all versions of its key


def versions(dim: DataFrame, key: str, at: str, tie: str) -> DataFrame:
    """Adds rn and valid_to: versions of a key in order of time. Of versions with
    equal times all but the last are valid for no time at all."""
    w = Window.partitionBy(key).orderBy(F.col(at).asc_nulls_last(), F.col(tie).asc_nulls_last())
    return dim.withColumn("rn", F.row_number().over(w)).withColumn("valid_to", F.lead(at).over(w))


def asof(facts: DataFrame, dim: DataFrame, key: str, fact_at: str, dim_at: str, tie: str, take: list[str]) -> DataFrame:
    """facts with ``take`` of the version whose time is the latest not after the
    fact's, or else of the earliest version; NULL without any version. Every fact
    stays exactly once.

    Of versions with equal times the one of the last ``tie`` counts, by the tie's
    own type; versions without a time count only where a key has no others. A fact
    without a time has the version of a key with one version only, a fact without
    a key none.

    A dimension counted to be small, in all and by key, is broadcast with its
    validity intervals, so the facts are not shuffled. Any other is merged by time:
    both sides are sorted by key and time and the last version seen is carried
    along. Results are the same."""
    ver = versions(dim.select(key, dim_at, tie, *[c for c in take if c not in (key, dim_at, tie)]), key, dim_at, tie)
    size = dim.groupBy(key).count().agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.coalesce(F.max("count"), F.lit(0)).alias("most")).first()
    if size["n"] <= BROADCAST_ROWS and size["most"] <= VERSIONS_OF_KEY:
        return _matched(facts, F.broadcast(_prefixed(ver)), key, fact_at, dim_at, take)
    return merged(facts, dim, key, fact_at, dim_at, tie, take)


def _prefixed(ver: DataFrame) -> DataFrame:
    return ver.select(*[F.col(c).alias(f"_v_{c}") for c in ver.columns])


def _matched(facts: DataFrame, v: DataFrame, key: str, fact_at: str, dim_at: str, take: list[str]) -> DataFrame:
    """facts with the version whose interval holds their time."""
    cond = (
        (facts[key] == v[f"_v_{key}"])
        & ((v["_v_rn"] == 1) | (facts[fact_at] >= v[f"_v_{dim_at}"]))
        & (v["_v_valid_to"].isNull() | (facts[fact_at] < v["_v_valid_to"]))
    )
    return facts.join(v, cond, "left").select(*[facts[c] for c in facts.columns], *[v[f"_v_{c}"].alias(c) for c in take])


def merged(facts: DataFrame, dim: DataFrame, key: str, fact_at: str, dim_at: str, tie: str, take: list[str]) -> DataFrame:
    """The same by one sort: no join on times, for dimensions of any size. Time is
    split into day slices per key, so that a key with very many facts is not one
    task; the version open at a slice's start is carried in from the versions
    alone."""
    ver = versions(dim.where(F.col(key).isNotNull()).select(key, dim_at, tie, *[c for c in take if c not in (key, dim_at, tie)]), key, dim_at, tie)
    whole = F.col(key).isNotNull() & F.col(fact_at).isNotNull()
    # a fact without a time can have an only version, at most one row a key
    odd = _matched(facts.where(~whole), _prefixed(ver.where("rn = 1 AND valid_to IS NULL")), key, fact_at, dim_at, take)
    payload = F.struct(*[F.col(c).alias(c) for c in take])
    d = ver.where(F.col(dim_at).isNotNull() | (F.col("rn") == 1)).select(F.col(key).alias("_k"), F.col(dim_at).alias("_at"), F.col("rn").alias("_n"), payload.alias("_p"))
    f = facts.where(whole).select(F.col(key).alias("_k"), F.col(fact_at).alias("_at"), F.struct(*[F.col(c).alias(c) for c in facts.columns]).alias("_f"))
    slices = f.select("_k", F.date_trunc("day", "_at").alias("_day")).distinct()
    no_version = [F.lit(None).cast("int").alias("_n"), F.lit(None).cast(d.schema["_p"].dataType).alias("_p")]
    # versions and slice starts, a few rows per key and day
    w = Window.partitionBy("_k").orderBy(F.col("_at").asc_nulls_first(), "_o", "_n")
    marks = slices.select("_k", F.col("_day").alias("_at"), F.lit(1).alias("_o"), *no_version, F.lit(True).alias("_mark"))
    line = d.select("_k", "_at", F.lit(0).alias("_o"), "_n", "_p", F.lit(False).alias("_mark")).unionByName(marks)
    first = F.first("_p", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    carried = line.withColumn("_open", F.coalesce(F.last("_p", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), first))
    opening = carried.where("_mark").select("_k", F.col("_at").alias("_day"), F.col("_at"), F.lit(-1).alias("_o"), F.lit(None).cast("int").alias("_n"), F.col("_open").alias("_p"))
    inside = d.where("_at IS NOT NULL").select("_k", F.date_trunc("day", "_at").alias("_day"), "_at", F.lit(0).alias("_o"), "_n", "_p")
    nothing = F.lit(None).cast(f.schema["_f"].dataType).alias("_f")
    events = f.select("_k", F.date_trunc("day", "_at").alias("_day"), "_at", F.lit(1).alias("_o"), *no_version, "_f")
    both = events.unionByName(inside.unionByName(opening).select("*", nothing))
    v = Window.partitionBy("_k", "_day").orderBy("_at", "_o", "_n")
    done = both.withColumn("_p", F.last("_p", ignorenulls=True).over(v.rowsBetween(Window.unboundedPreceding, 0))).where("_f IS NOT NULL")
    return done.select("_f.*", *[F.col(f"_p.`{c}`").alias(c) for c in take]).unionAll(odd)


def resolution(version: str, fact_at: str, version_at: str):
    """How a fact got its version."""
    return (
        F.when(F.col(version).isNull(), "no_valid_structure")
        .when(F.col(fact_at) < F.col(version_at), "fallback_earliest").otherwise("asof")
    )
