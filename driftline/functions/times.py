"""Times: days of zones, boundary counts, buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_between(a: Column, b: Column) -> Column:
    """Second boundaries between two times (not whole seconds elapsed)."""
    return F.unix_seconds(b.cast("timestamp")) - F.unix_seconds(a.cast("timestamp"))


def zone_day(ts: Column, zone: str = "UTC") -> Column:
    """The day on which a UTC time falls in a zone."""
    return F.to_date(F.from_utc_timestamp(ts, zone))


def bucket_start(ts: Column, unit: str) -> Column:
    return F.date_trunc(unit, ts)


def epoch_seconds(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)


def days_between(a: Column, b: Column) -> Column:
    return F.datediff(b, a)


def parse_time(c: Column) -> Column:
    """An ISO time, or null; without a zone it is UTC (the session's)."""
    return F.try_to_timestamp(c)
