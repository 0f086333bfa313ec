"""Sequences by key: sessions, islands, chains, resampling, gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import seconds_between


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str], prefix: str = "prev_") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({f"{prefix}{c}": F.lag(c).over(w) for c in columns})


def break_sessions(df: DataFrame, keys: Sequence[str], order: Sequence[Column], breaks: Column, session: str = "session_id") -> DataFrame:
    """Numbers sessions from 1: a row where ``breaks`` holds (a null does not) or the first of its key opens one. ``breaks`` may use ``prev_`` columns made before."""
    w = Window.partitionBy(*keys).orderBy(*order)
    flag = F.when(F.row_number().over(w) == 1, 1).when(F.coalesce(breaks, F.lit(False)), 1).otherwise(0)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("_flag", flag).withColumn(session, F.sum("_flag").over(running)).drop("_flag")


def sessionize(df: DataFrame, key: str, ts: str, label: str, tie: str, gap_s: int, flip_gap_s: int, session: str = "session_id") -> DataFrame:
    """A session ends at a gap of over ``gap_s``, or at a change of label with a gap of over ``flip_gap_s``."""
    order = [F.col(ts), F.col(tie)]
    rows = with_previous(df, [key], order, [ts, label])
    gap = seconds_between(F.col(f"prev_{ts}"), F.col(ts))
    flip = F.col(label).isNotNull() & F.col(f"prev_{label}").isNotNull() & (F.col(label) != F.col(f"prev_{label}"))
    return break_sessions(rows, [key], order, (gap > gap_s) | (flip & (gap > flip_gap_s)), session).drop(f"prev_{ts}", f"prev_{label}")


def dominant_value(df: DataFrame, keys: Sequence[str], value: str, ts: str, out: str = "dominant") -> DataFrame:
    """The most frequent non-null value of each key; ties go to the one seen first, then to the smaller."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"), F.min(ts).alias("_first"))
    best = F.min_by(F.struct(F.col(value).alias("v"), F.col("_n").alias("n")), F.struct(-F.col("_n"), F.col("_first"), F.col(value)))
    return counted.groupBy(*keys).agg(best.alias("_b")).select(*keys, F.col("_b.v").alias(out), F.col("_b.n").alias(f"{out}_n"))


def first_last(df: DataFrame, keys: Sequence[str], ts: str, tie: str, columns: Sequence[str]) -> DataFrame:
    """First and last values of each key in the order of (ts, tie)."""
    at = F.struct(ts, tie)
    aggs = [f(F.struct(*columns), at).alias(name) for f, name in ((F.min_by, "_f"), (F.max_by, "_l"))]
    got = df.groupBy(*keys).agg(F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts"), F.count("*").alias("n"), *aggs)
    return got.select(*keys, "start_ts", "end_ts", "n", *[F.col(f"_f.{c}").alias(f"first_{c}") for c in columns], *[F.col(f"_l.{c}").alias(f"last_{c}") for c in columns])


def islands(df: DataFrame, key: str, start: str, end: str, tie: str, slack_s: int = 0, island: str = "island") -> DataFrame:
    """Numbers groups of overlapping windows: one opens where a start is more than ``slack_s`` after every end before."""
    order = [F.col(start), F.col(end), F.col(tie)]
    before = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_reach", F.max(end).over(before))
    return break_sessions(rows, [key], order, seconds_between(F.col("_reach"), F.col(start)) > slack_s, island).drop("_reach")


def islands_two_stage(df: DataFrame, key: str, start: str, end: str, label: str, tie: str, slack_s: int = 0, island: str = "island", part: str = "part") -> DataFrame:
    """Islands, cut again where the label differs from the last one established in the island (nulls carry it on)."""
    one = islands(df, key, start, end, tie, slack_s, island)
    order = [F.col(start), F.col(end), F.col(tie)]
    before = Window.partitionBy(key, island).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = one.withColumn("_known", F.last(label, ignorenulls=True).over(before))
    return break_sessions(rows, [key, island], order, F.col(label) != F.col("_known"), part).drop("_known")


def chain_breaks(df: DataFrame, key: str, start: str, end: str, tie: str, speed: Column | None = None, band: tuple[float, float] | None = None, max_gap_s: int = 3600, ground: str | None = None, chain: str = "chain") -> DataFrame:
    """Numbers chains of segments. A link breaks at the first row, a gap that isn't positive, one over ``max_gap_s``, after a segment that ended on the ground, or where the speed implied between
    the segments (an expression over ``prev_`` columns) is outside the band."""
    order = [F.col(start), F.col(tie)]
    rows = with_previous(df, [key], order, [c for c in df.columns if c != key])
    gap = seconds_between(F.col(f"prev_{end}"), F.col(start))
    breaks = (gap <= 0) | (gap > max_gap_s)
    if ground:
        breaks = breaks | F.coalesce(F.col(f"prev_{ground}"), F.lit(False))
    if speed is not None and band:
        breaks = breaks | ~speed.between(*band)
    return break_sessions(rows, [key], order, breaks, chain).drop(*[f"prev_{c}" for c in df.columns])


def max_gap(df: DataFrame, keys: Sequence[str], ts: str, out: str = "max_gap_s") -> DataFrame:
    """The longest time between neighbours, 0 for one row."""
    rows = with_previous(df, keys, [F.col(ts)], [ts])
    return rows.groupBy(*keys).agg(F.coalesce(F.max(seconds_between(F.col(f"prev_{ts}"), F.col(ts))), F.lit(0)).alias(out))


def observed_fraction(n: Column, window_s: Column, cadence_s: float = 1.0) -> Column:
    """The share of a window that fixes cover, in [0, 1]; 0 for an empty window."""
    return F.when(window_s <= 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), n * cadence_s / window_s)))


def resample_locf(df: DataFrame, key: str, ts: str, tie: str, values: Sequence[str], step_s: int, stale_s: int, carried: Sequence[str] = ()) -> DataFrame:
    """At every multiple of ``step_s`` between a key's first and last row, its last row at or before, unless that is older than ``stale_s``. ``carried``
    columns keep their last known value. A row serves the boundaries up to the next row, so none are joined."""
    at = F.unix_seconds(F.col(ts).cast("timestamp"))
    w = Window.partitionBy(key).orderBy(F.col("_t"), F.col(tie))
    rows = df.withColumn("_t", at).withColumn("_next", F.lead("_t").over(w))
    rows = rows.withColumns({c: F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) for c in carried})
    first = F.ceil(F.col("_t") / step_s) * step_s
    # the last row of a key ends at itself; one that a later row of the same second replaces serves none
    until = F.least(F.col("_t") + stale_s, F.coalesce(F.col("_next") - 1, F.col("_t")))
    grid = F.when(first <= until, F.sequence(first.cast("long"), until.cast("long"), F.lit(step_s).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    out = rows.select(key, F.explode(grid).alias("boundary"), F.col("_t").alias("source_t"), *values, *[c for c in carried if c not in values])
    return out


def contiguous_run(days: DataFrame, day: str) -> DataFrame:
    """The oldest run of days without a hole."""
    w = Window.orderBy(day)
    rows = days.select(day).distinct().withColumn("_rn", F.row_number().over(w)).withColumn("_d0", F.min(day).over(Window.partitionBy()))
    return rows.where(F.datediff(day, "_d0") == F.col("_rn") - 1).select(day)


def modal_trailing(df: DataFrame, key: str, day: str, value: str, days: int, least: int, share: float) -> DataFrame:
    """For each key and day, the most frequent value of the ``days`` days before it, with its support: only where it has ``least`` rows and ``share`` of them. Ties go to the larger value."""
    daily = df.groupBy(key, day, value).agg(F.count("*").alias("n"))
    a, b = daily.select(key, day).distinct().alias("a"), daily.alias("b")
    near = (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.col(f"b.{day}") < F.col(f"a.{day}")) & (F.col(f"b.{day}") >= F.date_sub(F.col(f"a.{day}"), days))
    hits = a.join(b, near).groupBy(F.col(f"a.{key}").alias(key), F.col(f"a.{day}").alias(day), F.col(f"b.{value}").alias(value)).agg(F.sum("n").alias("n"))
    best = hits.groupBy(key, day).agg(F.max(F.struct("n", value)).alias("_b"), F.sum("n").alias("total"))
    return best.select(key, day, F.col(f"_b.{value}").alias("modal"), F.col("_b.n").alias("support"), "total").where((F.col("support") >= least) & (F.col("support") >= share * F.col("total")))
