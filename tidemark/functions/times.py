"""Time functions with one meaning in every session time zone setting of UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_time(ts: Column, zone: str = "Europe/Berlin") -> Column:
    """Naive local time of an instant; both hours of an autumn change read alike."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))


def floor_naive(unit: str, ts: Column) -> Column:
    """date_trunc that stays a naive timestamp."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def cast_naive(text: Column) -> Column:
    """Naive timestamp of a text, an offset being dropped; NULL if it is none."""
    return text.try_cast("timestamp_ntz")


def seconds_between(a: Column, b: Column) -> Column:
    """Second boundaries between two instants, as a count from a to b."""
    return F.unix_seconds(b.cast("timestamp")) - F.unix_seconds(a.cast("timestamp"))


def utc_text(ts: Column) -> Column:
    """2026-07-01 12:00:00+00, with a fraction only if there is one."""
    t = ts.cast("timestamp")
    whole = F.date_format(t, "yyyy-MM-dd HH:mm:ss")
    micros = F.regexp_replace(F.date_format(t, ".SSSSSS"), r"\.?0+$", "")
    return F.concat(whole, micros, F.lit("+00"))


def iso_micros(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
