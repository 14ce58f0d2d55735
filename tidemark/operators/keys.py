"""Operators on keys: newest rows, replacement, idempotent insert, ledgers.

None of them gathers a key's rows in one place: newest rows are a partial
aggregation, the others joins whose skewed sides adaptive execution splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(df: DataFrame, keys: Sequence[str], by: Sequence[str | Column]) -> DataFrame:
    """One row per key, the largest by ``by`` (NULL smallest). The order must be
    total for a defined result. Combined map-side, so a hot key costs a row per
    task."""
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*[(F.col(b) if isinstance(b, str) else b).alias(f"o{k}") for k, b in enumerate(by)])
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.`{c}`").alias(c) for c in rest]).select(*df.columns)


def bounded(df: DataFrame, order: Sequence[str], rows: int, size: int, column: str) -> DataFrame:
    """The first rows in order, at most ``rows``, and of these as many as hold
    ``size`` bytes of a column, one at least."""
    w = Window.partitionBy().orderBy(*order)  # over ``rows`` rows
    total = F.sum(F.coalesce(F.octet_length(column), F.lit(0))).over(w)
    first = df.orderBy(*order).limit(rows).withColumns({"_total": total, "_n": F.row_number().over(w)})
    return first.where((F.col("_n") == 1) | (F.col("_total") <= size)).drop("_total", "_n")


def _on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    other = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys]).distinct()
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(other[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return other, cond


def within(df: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys_of``; NULL keys match each other."""
    return df.join(*_on(df, keys_of, keys), "left_semi")


def without(df: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``keys_of``; NULL keys match each other."""
    return df.join(*_on(df, keys_of, keys), "left_anti")


def insert_or_ignore(stored: DataFrame, new: DataFrame, keys: Sequence[str], first_by: Sequence[str] = ()) -> DataFrame:
    """The new rows to append: keys not stored, the first row of each."""
    fresh = without(new, stored, keys)
    if not first_by:
        return fresh.dropDuplicates(list(keys))
    rest = [c for c in new.columns if c not in keys]
    first = fresh.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*first_by)).alias("_first"))
    return first.select(*keys, *[F.col(f"_first.`{c}`").alias(c) for c in rest]).select(*new.columns)


def replace(stored: DataFrame, new: DataFrame, keys: Sequence[str], touched: DataFrame | None = None) -> DataFrame:
    """stored with all rows of the touched keys (those of ``new`` by default)
    replaced by ``new``."""
    return without(stored, new if touched is None else touched, keys).unionByName(new, allowMissingColumns=True)


def unprocessed(desired: DataFrame, ledger: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Rows that the ledger has not seen, or has seen under another version;
    a NULL version equals a NULL version."""
    return without(desired, ledger, [*keys, version])


def newest_batches(df: DataFrame, keys: Sequence[str], batch: str, of: DataFrame | None = None) -> DataFrame:
    """All rows of each key's newest batch, of a key's several rows in it too;
    the newest batch of a key may be told by another table."""
    top = (df if of is None else of).groupBy(*[F.col(k).alias(f"_r_{k}") for k in keys]).agg(F.max(batch).alias("_top"))
    cond = F.col(batch) == F.col("_top")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return df.join(top, cond, "left_semi")


def expired(df: DataFrame, at: str, before, processed: DataFrame, queued: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows older than ``before`` that are processed and no longer queued."""
    return without(within(df.where(F.col(at) < before), processed, keys), queued, keys)
