"""Traces to segments and paths: breaks of a trace are told by a fix and the one before it, so a window does what a walk would."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import haversine
from ..functions.identity import zone_of

C = F.col
# Seconds, feet and kilometres an hour that end a segment.
LONG_GAP_S, LOW_GAP_S, LOW_FT, SLOW_GAP_S, SLOW_FT, SLOW_KMH = 5400, 2700, 984.0, 1800, 9843.0, 100.0
_UNKNOWN_FT = 99999.0
KEY = ["icao24", "base_ts"]


def fixes(points: DataFrame) -> DataFrame:
    """Points of traces that are positions of their own: with a place, and not the last one repeated. ``t`` is in seconds since the epoch."""
    repeated = F.coalesce("flags", F.lit(0)).bitwiseAND(F.lit(1)) == 1
    return points.where(C("base_ts").isNotNull() & C("dt_s").isNotNull() & C("lat").isNotNull() & C("lon").isNotNull() & ~repeated).withColumn("t", C("base_ts") + C("dt_s"))


def slow_gap(t: Column, before: Column, alt: Column, alt_before: Column, *place: Column) -> Column:
    """A silence below the cruise that was crossed too slowly to have stayed in the air; on whole seconds, as paths are kept."""
    gap = F.floor(t) - F.floor(before)
    low = F.least(F.coalesce(alt, F.lit(_UNKNOWN_FT)), F.coalesce(alt_before, F.lit(_UNKNOWN_FT)))
    return (gap >= SLOW_GAP_S) & (low < SLOW_FT) & (haversine(*place) / (gap / 3600.0) < SLOW_KMH)


def grouped(points: DataFrame) -> DataFrame:
    """The fixes of each trace with ``group``, counted from 1, and ``seg_start``, the whole second at which it begins."""
    order = Window.partitionBy(*KEY).orderBy("i")
    before = lambda c: F.lag(c).over(order)
    gap = C("t") - before("t")
    low = F.least(F.coalesce("alt_ft", F.lit(_UNKNOWN_FT)), F.coalesce(before("alt_ft"), F.lit(_UNKNOWN_FT)))
    landed = C("ground") & ~before("ground")
    slow = slow_gap(C("t"), before("t"), C("alt_ft"), before("alt_ft"), before("lat"), before("lon"), C("lat"), C("lon"))
    breaks = F.coalesce((gap > LONG_GAP_S) | landed | ((gap >= LOW_GAP_S) & (low < LOW_FT)) | slow, F.lit(True))
    rows = fixes(points).withColumn("_break", breaks)
    rows = rows.withColumn("group", F.sum(C("_break").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_break")
    begin = F.first("t").over(Window.partitionBy(*KEY, "group").orderBy("i"))
    return rows.withColumn("seg_start", F.floor(begin).cast("long"))


def trace_segments(points: DataFrame, day: Column) -> DataFrame:
    """Flown segments: at least two fixes, one in the air; with the callsign most fixes have (ties to the smaller) and both ends."""
    rows = grouped(points)
    key = [*KEY, "group"]
    end = lambda f, c: f(C(c), C("i"))
    ends = rows.groupBy(*key).agg(
        F.min("seg_start").alias("seg_start"), F.floor(F.max_by("t", "i")).cast("long").alias("seg_end"), F.count("*").alias("num_fixes"), F.count_if(~C("ground")).alias("_air"),
        *[end(f, c).alias(f"{p}_{n}") for p, f in (("first", F.min_by), ("last", F.max_by)) for c, n in (("lat", "lat"), ("lon", "lon"), ("alt_ft", "alt_ft"), ("ground", "on_ground"))],
    ).where("num_fixes >= 2 and _air > 0")
    said = rows.where("callsign is not null").groupBy(*key, "callsign").agg(F.count("*").alias("_n"))
    named = said.groupBy(*key).agg(F.min_by("callsign", F.struct(-C("_n"), C("callsign"))).alias("callsign"))
    sides = [f"{p}_{n}" for p in ("first", "last") for n in ("lat", "lon", "alt_ft", "on_ground")]
    return ends.join(named, key, "left").select("icao24", "callsign", "seg_start", "seg_end", "num_fixes", *sides, day.alias("trace_day"), F.lit("adsblol").alias("source"))


def trace_paths(points: DataFrame, day: Column) -> DataFrame:
    """The fixes of flown segments, by the same groups."""
    rows = grouped(points)
    whole = Window.partitionBy(*KEY, "seg_start")
    flown = rows.withColumn("_n", F.count("*").over(Window.partitionBy(*KEY, "group"))).withColumn("_air", F.count_if(~C("ground")).over(Window.partitionBy(*KEY, "group")))
    # groups that begin in one second share their key
    kept = flown.withColumn("_kept", F.max((C("_n") >= 2) & (C("_air") > 0)).over(whole)).where("_kept")
    return kept.select("icao24", "seg_start", F.floor("t").cast("long").alias("ts"), "lat", "lon", "alt_ft", C("ground").alias("on_ground"), "gs_kt", C("track").alias("track_deg"), day.alias("trace_day"), F.lit("adsblol").alias("source"))


def affected_pairs(stored: DataFrame) -> DataFrame:
    """(icao24, trace_day) of stored paths that a slow gap would cut anew."""
    order = Window.partitionBy("icao24", "trace_day", "seg_start").orderBy("ts")
    before = lambda c: F.lag(c).over(order)
    hit = slow_gap(C("ts"), before("ts"), C("alt_ft"), before("alt_ft"), before("lat"), before("lon"), C("lat"), C("lon"))
    return stored.withColumn("_hit", hit).where("_hit").select(F.lower("icao24").alias("icao24"), "trace_day").distinct()


def dense_points(points: DataFrame, day_start: int, zones: Mapping[str, tuple[float, float, float, float]]) -> DataFrame:
    """Fixes of one day inside the zones, with the first zone that holds each; callsign and squawk as last said before."""
    said = Window.partitionBy(*KEY).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = points.withColumns({c: F.last(c, ignorenulls=True).over(said) for c in ("callsign", "squawk")})
    inside = fixes(known).where((C("t") >= day_start) & (C("t") < day_start + 86400)).withColumn("zone", zone_of(C("lat"), C("lon"), zones))
    return inside.where("zone is not null").withColumn("ts", F.floor("t").cast("long"))


# What to fetch


def route_targets(flights: DataFrame, day) -> DataFrame:
    """Airframes of the flights that start or end on a day."""
    on = (F.to_date("start_time") == F.lit(day)) | (F.to_date("end_time") == F.lit(day))
    return flights.where(on & (C("icao24") != "")).select(F.lower("icao24").alias("icao24")).distinct()


def rooftop_cohort(adsb: DataFrame, day) -> DataFrame:
    """Valid addresses heard on a day."""
    heard = F.to_date(F.timestamp_seconds("capture_ts")) == F.lit(day)
    return adsb.where(heard).select(F.lower("hex").alias("icao24")).where("icao24 rlike '^[0-9a-f]{6}$'").distinct()


def unresolved_targets(flights: DataFrame) -> DataFrame:
    """Airframes and days of flights that lack an end."""
    return flights.where("icao24 is not null and (origin_icao is null or dest_icao is null)").select(F.lower("icao24").alias("icao24"), F.to_date("start_time").alias("day")).distinct()
