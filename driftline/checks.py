"""Gates: grains, contracts, completeness of loads, and served values derived again from their source."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import joins


class GateFailed(AssertionError):
    pass


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of more than one row; null keys count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def assert_grain(df: DataFrame, keys: Sequence[str]) -> None:
    bad = duplicates(df, keys).take(3)
    if bad:
        raise GateFailed(f"not one row per {', '.join(keys)}: {bad}")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key).distinct(), key, "left_anti")


def reconcile(source: DataFrame, served: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys of either side whose values differ."""
    return joins.full_outer_diff(source, served, keys, values)


@dataclass(frozen=True)
class Window:
    """Closed hours to check: [lo, hi), and where the watermark goes when they agree."""

    lo: dt.datetime
    hi: dt.datetime
    watermark: dt.datetime


def value_window(watermark: dt.datetime, now: dt.datetime, tail_h: int = 6, chunk_days: int = 2) -> Window | None:
    """From the watermark less a tail for late rows, up to the last closed hour, a chunk at most; None when nothing is closed."""
    closed = now.replace(minute=0, second=0, microsecond=0)
    hi = min(closed, watermark + dt.timedelta(days=chunk_days))
    if hi <= watermark:
        return None
    return Window(watermark - dt.timedelta(hours=tail_h), hi, hi)


def value_gate(source: DataFrame, served: DataFrame, keys: Sequence[str], values: Sequence[str], hour: str, window: Window) -> dt.datetime:
    """The new watermark, if the window's values agree exactly; a difference fails and moves nothing."""
    inside = lambda df: df.where((F.col(hour) >= F.lit(window.lo)) & (F.col(hour) < F.lit(window.hi)))
    bad = reconcile(inside(source), inside(served), [hour, *keys], values).take(5)
    if bad:
        raise GateFailed(f"served values differ: {bad}")
    return window.watermark


def fresh(df: DataFrame, ts: str, now: dt.datetime, lag_s: int) -> bool:
    newest = df.agg(F.max(ts)).first()[0]
    return newest is not None and (now - newest).total_seconds() <= lag_s


def completeness(source: DataFrame, loaded: DataFrame, by: str) -> DataFrame:
    """Per group: rows of the source and of the load, and the share loaded."""
    a, b = (df.groupBy(by).agg(F.count("*").alias(n)) for df, n in ((source, "expected"), (loaded, "loaded")))
    j = a.join(b, by, "full").fillna(0, ["expected", "loaded"])
    return j.withColumn("share", F.when(F.col("expected") > 0, F.col("loaded") / F.col("expected")))


def unknown_keys(df: DataFrame, json: str, known: Sequence[str]) -> DataFrame:
    """(key, n): JSON fields that nobody listed."""
    return df.select(F.explode(F.json_object_keys(json)).alias("key")).where(~F.col("key").isin(*known)).groupBy("key").agg(F.count("*").alias("n"))
