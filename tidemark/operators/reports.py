"""Status of a spool of pending uploads: health and catch-up reports."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STALE, OLDEST, MOST_PENDING = timedelta(minutes=10), timedelta(minutes=30), 100_000
CATCH_UP_S = 12 * 3600


def spool_status(spool: DataFrame, at: str = "received_at") -> DataFrame:
    """pending, oldest_pending, latest and total in one pass."""
    waiting = F.col("uploaded_at").isNull()
    return spool.agg(
        F.count_if(waiting).alias("pending"), F.min(F.when(waiting, F.col(at))).alias("oldest_pending"),
        F.max(at).alias("latest"), F.count(F.lit(1)).alias("total"),
    )


def lag_quantiles(lags: DataFrame, keys: list[str], seconds: str) -> DataFrame:
    """Median, 95th percentile and worst of whole seconds by key: exact, over
    counts of equal values, so that a group sends its distinct values only."""
    counted = lags.groupBy(*keys, seconds).agg(F.count(F.lit(1)).alias("_n"))
    q = F.percentile(seconds, [0.5, 0.95], F.col("_n"))
    out = counted.groupBy(*keys).agg(q.alias("_q"), F.max(seconds).alias("worst"))
    return out.select(*keys, F.round(F.get("_q", F.lit(0)), 3).alias("p50"), F.round(F.get("_q", F.lit(1)), 3).alias("p95"), "worst")


def health(status: dict, now: datetime, check_backlog: bool = True, stale: timedelta = STALE, oldest: timedelta = OLDEST, most: int = MOST_PENDING) -> list[str]:
    """Problems of a status row; limits themselves are healthy."""
    out = []
    if status["latest"] is None or now - status["latest"] > stale:
        out.append("collector_stale")
    first = status["oldest_pending"]
    if check_backlog and (status["pending"] > most or first is not None and now - first > oldest):
        out.append("upload_backlog")
    return out


def upload_report(spool: DataFrame, now: datetime, window_minutes: float, ingress_per_day: float = 0.0) -> dict:
    """Rates of the last window and when the backlog will be gone."""
    if window_minutes <= 0:
        raise ValueError("the window must be positive")
    since = now - timedelta(minutes=window_minutes)
    inside = lambda c: F.count_if(F.col(c).between(F.lit(since), F.lit(now)))
    row = spool.agg(
        F.count_if(F.col("uploaded_at").isNull()).alias("pending"), inside("uploaded_at").alias("uploaded"), inside("received_at").alias("received"),
        F.min(F.when(F.col("uploaded_at").isNull(), F.col("received_at"))).alias("oldest_pending"),
        F.max("received_at").alias("latest_received"), F.max("uploaded_at").alias("latest_uploaded"),
    ).first().asDict()
    seconds = window_minutes * 60
    rate, measured = row["uploaded"] / seconds, row["received"] / seconds
    ingress = max(measured, ingress_per_day / 86400)
    net = rate - ingress
    eta = 0.0 if not row["pending"] else round(row["pending"] / net / 3600, 2) if net > 0 else None
    required = ingress + row["pending"] / CATCH_UP_S
    return row | {
        "upload_per_second": round(rate, 3), "ingress_per_second": round(measured, 3), "assumed_ingress_per_second": round(ingress, 3),
        "net_per_second": round(net, 3), "eta_hours": eta, "required_per_second_12h": round(required, 3), "catches_up_within_12h": rate >= required,
    }
