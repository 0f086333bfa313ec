"""Flight paths: fusion of three sources, the days to build, a summary, and the scoring of estimates against later truth."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CONFIG, Config
from ..functions import scalars
from ..functions.geo import haversine
from ..operators import aggs, sequences

C = F.col
FIX = ["lat", "lon", "alt_ft", "gs_kt", "track_deg", "on_ground"]


def fixes(adsb: DataFrame, traces: DataFrame, states: DataFrame) -> DataFrame:
    """Positions of the three sources in one shape, the best source first, at whole seconds."""
    second = lambda c: F.timestamp_seconds(F.floor(c).cast("long"))
    a = adsb.where("capture_ts is not null").select(F.lit("adsb").alias("source"), F.lit(1).alias("src_rank"), F.lower("hex").alias("icao24"), second(C("capture_ts")).alias("ts"), "lat", "lon", scalars.sentinel_numeric(C("alt_baro")).alias("alt_ft"), (F.coalesce("alt_baro", F.lit("")) == "ground").alias("on_ground"), C("gs").alias("gs_kt"), C("track").alias("track_deg"))
    b = traces.where("ts is not null").select(F.lit("adsblol").alias("source"), F.lit(2).alias("src_rank"), F.lower("icao24").alias("icao24"), F.date_trunc("second", "ts").alias("ts"), "lat", "lon", "alt_ft", F.coalesce("on_ground", F.lit(False)).alias("on_ground"), "gs_kt", "track_deg")
    at = F.coalesce("time_position", "snapshot_time")
    # Metres to feet and metres a second to knots.
    c = states.where(at.isNotNull()).select(F.lit("opensky").alias("source"), F.lit(3).alias("src_rank"), F.lower("icao24").alias("icao24"), F.date_trunc("second", at).alias("ts"), C("latitude").alias("lat"), C("longitude").alias("lon"), (C("baro_altitude") * 3.28084).alias("alt_ft"), F.coalesce("on_ground", F.lit(False)).alias("on_ground"), (C("velocity") * 1.94384).alias("gs_kt"), C("true_track").alias("track_deg"))
    return a.unionByName(b).unionByName(c).where("lat is not null and lon is not null")


def days_to_build(flights: DataFrame, newest_trace: dt.date, oldest_source: dt.date, built: DataFrame | None = None, repair: Sequence[dt.date] = (), cfg: Config = CONFIG) -> list[dt.date]:
    """The days of one run, ``path_chunk_days`` at most: a contiguous repair list; else the oldest run of days with flights that are gone; else new days, or the last ones again when none is left behind."""
    if repair:
        if built is None:
            raise ValueError("repair needs a table that was built")
        days: list[dt.date] = []
        for d in sorted(repair):
            if len(days) < cfg.path_chunk_days and (not days or (d - days[-1]).days == 1):
                days.append(d)
        return days
    day = F.to_date("start_time")
    hi, lo = newest_trace - dt.timedelta(cfg.path_lag_days), oldest_source - dt.timedelta(1)
    eligible = sorted(r[0] for r in flights.where(day.between(F.lit(lo), F.lit(hi))).select(day).distinct().collect())  # a row per day
    if built is None:
        return eligible[: cfg.path_chunk_days]
    known = flights.select(day.alias("day_key")).distinct()
    gone = built.join(flights.select("flight_id"), "flight_id", "left_anti").join(known, "day_key", "left_semi").select("day_key")
    orphans = sorted(r[0] for r in sequences.contiguous_run(gone, "day_key").collect())
    if orphans:
        return orphans[: cfg.path_chunk_days]
    done = built.agg(F.max("day_key")).first()[0]
    if not eligible or (done is not None and eligible[-1] <= done):
        return []
    if done is None or (eligible[-1] - done).days > cfg.path_chunk_days:
        return [d for d in eligible if done is None or d > done][: cfg.path_chunk_days]
    return [d for d in eligible if d >= eligible[-1] - dt.timedelta(cfg.path_chunk_days - 1)]


def fct_flight_path(all_fixes: DataFrame, flights: DataFrame, days: Sequence[dt.date] | None = None, cfg: Config = CONFIG) -> DataFrame:
    """One fix per (flight, second) of the flights that start on ``days`` (all, where None). A fix that lies in several padded windows belongs to the one whose middle is nearest;
    flights around the chunk take part in that contest, so a chunk's result is that of a single run."""
    pad = cfg.path_pad_min * 60
    s, e = F.unix_seconds("start_time"), F.unix_seconds("end_time")
    spine = flights.select("flight_id", F.lower("icao24").alias("icao24"), (s - pad).alias("_s"), (e + pad).alias("_e"), F.floor((s + e) / 2).alias("_mid"), F.to_date("start_time").alias("day_key"))
    spine = spine.withColumn("_in", C("day_key").isin(*days) if days is not None else F.lit(True))
    t = F.unix_seconds("ts")
    if days is not None:
        lo, hi = F.lit(min(days)), F.lit(max(days))
        chunk = spine.where("_in").agg(F.min("_s").alias("a"), F.max("_e").alias("b")).first()
        if chunk.a is None:
            return all_fixes.limit(0).select(F.lit(0).cast("long").alias("flight_id"), "ts", *FIX, "source", lo.alias("day_key")).where(hi.isNull())
        all_fixes = all_fixes.where(t.between(chunk.a, chunk.b))
        spine = spine.where((C("_e") >= chunk.a) & (C("_s") <= chunk.b))
    # windows meet fixes by hour, so that a busy airframe is not one key
    windows = spine.withColumn("_h", F.explode(F.sequence(F.floor(C("_s") / 3600), F.floor(C("_e") / 3600))))
    hits = all_fixes.withColumn("_h", F.floor(t / 3600)).join(windows, ["icao24", "_h"]).where(t.between(C("_s"), C("_e")))
    content = ["source", "src_rank", "icao24", "ts", *FIX]
    own = hits.groupBy(*content).agg(F.min(F.struct(F.abs(t - C("_mid")).alias("d"), "flight_id", "day_key", "_in")).alias("_b")).where("_b._in")
    rows = own.select("_b.flight_id", "_b.day_key", *content)
    present = [F.struct(C(c).isNull(), C(c)).alias(f"k{i}") for i, c in enumerate(["lat", "lon", "alt_ft", "gs_kt", "track_deg", "on_ground"])]
    best = rows.groupBy("flight_id", "day_key", "ts").agg(F.min_by(F.struct(*FIX, "source"), F.struct("src_rank", *present)).alias("_b"))
    return best.select("flight_id", "ts", *[C(f"_b.{c}").alias(c) for c in [*FIX, "source"]], "day_key")


def fct_flight_path_summary(path: DataFrame, flights: DataFrame) -> DataFrame:
    """What each path holds: fixes by source, its longest gap, and the share of the window's seconds with a fix."""
    j = path.select("flight_id", "ts", "source").join(flights.select("flight_id", "start_time", "end_time"), "flight_id")
    gaps = sequences.max_gap(path.select("flight_id", "ts"), ["flight_id"], "ts", "largest_gap_s")
    w = F.unix_seconds("end_time") - F.unix_seconds("start_time")
    n = j.groupBy("flight_id", "start_time", "end_time").agg(
        F.count("*").alias("n_points"), *[F.count_if(C("source") == s).alias(f"n_{s}") for s in ("adsb", "adsblol", "opensky")], F.min("ts").alias("first_fix_ts"), F.max("ts").alias("last_fix_ts"), F.count_if(C("ts").between(C("start_time"), C("end_time"))).alias("_n")
    )
    return n.join(gaps, "flight_id").select("flight_id", "n_points", "n_adsb", "n_adsblol", "n_opensky", "first_fix_ts", "last_fix_ts", "largest_gap_s", w.alias("window_s"), sequences.observed_fraction(C("_n"), w).alias("observed_fraction"))


def fct_est_settlement(estimates: DataFrame, flights: DataFrame, path: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """Served gap estimates against the fixes that came later: the flight is found by airframe and time, or by what passed both ends; with three fixes inside, errors are scored."""
    pad = cfg.path_pad_min * 60
    head = ["estimate_id", "seg_idx"]
    g = estimates.where("producer <> 'test' and kind = 'gap' and flight_id is not null").select(
        *head, "producer", "method_version", "config_hash", "input_fingerprint", "uncertainty_bin", C("uncertainty_p50_km").alias("served_p50_km"), C("uncertainty_p90_km").alias("served_p90_km"), "computed_at", "input_provisional",
        F.coalesce("icao24", F.lit("")).alias("_hex"), "points", F.get("points", F.lit(0)).alias("_a"), F.element_at("points", -1).alias("_z"),
    )
    by_hex = g.where("_hex <> ''").join(flights.select(F.lower("icao24").alias("_hex"), C("flight_id").alias("_fid"), F.unix_seconds("start_time").alias("_s"), F.unix_seconds("end_time").alias("_e")), "_hex").where((C("_s") - pad <= C("_z.ts")) & (C("_e") + pad >= C("_a.ts"))).select(*head, "_fid").distinct()
    end = lambda side, p: F.struct(F.lit(side).alias("side"), C(f"{p}.ts").alias("t"), C(f"{p}.lat").alias("la"), C(f"{p}.lon").alias("lo"))
    ends = g.where("_hex = ''").select(*head, F.explode(F.array(end("entry", "_a"), end("exit", "_z"))).alias("_k")).select(*head, "_k.*").withColumn("_m", F.explode(F.sequence(F.floor(C("t") / 60) - 2, F.floor(C("t") / 60) + 2)))
    days = ends.select(F.to_date(F.timestamp_seconds("t")).alias("_d")).distinct()
    near_days = days.select(F.explode(F.array(F.date_sub("_d", 1), "_d", F.date_add("_d", 1))).alias("day_key")).distinct()
    scan = path.select(C("flight_id").alias("_fid"), F.unix_seconds("ts").alias("_ts"), C("lat").alias("_la"), C("lon").alias("_lo"), "day_key").join(near_days, "day_key", "left_semi").withColumn("_m", F.floor(C("_ts") / 60))
    passed = ends.join(scan, "_m").where((F.abs(C("_ts") - C("t")) <= 90) & (haversine(C("la"), C("lo"), C("_la"), C("_lo")) < 5.0))
    by_ends = passed.groupBy(*head, "_fid").agg(F.count_distinct("side").alias("_n")).where("_n = 2").select(*head, "_fid")
    found = by_hex.unionByName(by_ends).groupBy(*head).agg(F.count("*").alias("n_cand"), F.min("_fid").alias("_fid"))
    rekeyed = g.join(found, head, "left").withColumn("n_cand", F.coalesce("n_cand", F.lit(0))).withColumn("matched_flight_id", F.when(C("n_cand") == 1, C("_fid")))
    truth = path.select(C("flight_id").alias("matched_flight_id"), F.unix_seconds("ts").alias("_t"), C("lat").alias("_tla"), C("lon").alias("_tlo"))
    inside = rekeyed.where("n_cand = 1").select(*head, "matched_flight_id", "points", "_a", "_z").join(truth, "matched_flight_id").where((C("_t") > C("_a.ts") + 60) & (C("_t") < C("_z.ts") - 60))
    after = F.get(F.filter("points", lambda p: p["ts"] > C("_t")), F.lit(0))
    upto = F.filter("points", lambda p: p["ts"] <= C("_t"))
    legs = inside.withColumn("_q", F.coalesce(after, C("_z"))).withColumn("_p", F.coalesce(F.element_at(F.when(F.size(upto) > 0, upto), -1), C("_a")))
    part = F.when(C("_q.ts") == C("_p.ts"), 0.0).otherwise((C("_t") - C("_p.ts")) / (C("_q.ts") - C("_p.ts")))
    raw = C("_q.lon") - C("_p.lon")
    wrap = lambda x: x - 360 * F.round(x / 360)
    err = haversine(C("_p.lat") + part * (C("_q.lat") - C("_p.lat")), wrap(C("_p.lon") + part * wrap(raw)), C("_tla"), C("_tlo"))
    scored = legs.select(*head, err.alias("_err"), (F.abs(raw) > 180).alias("_wrap")).groupBy(*head).agg(F.count("*").alias("truth_pts"), F.count_if("_wrap").alias("wrap_pts"), aggs.quantile_floor("_err", 0.5).alias("_p50"), aggs.quantile_floor("_err", 0.9).alias("_p90"), F.max("_err").alias("_max"), F.array_sort(F.collect_list(C("_err").cast("float"))).alias("errs_km"))
    out = rekeyed.join(scored, head, "left").withColumn("truth_pts", F.coalesce("truth_pts", F.lit(0))).withColumn("settled", (C("truth_pts") >= 3).cast("int"))
    settled = lambda c, name: F.when(C("settled") == 1, C(c)).alias(name)
    return out.select(
        *head, "producer", "method_version", "config_hash", "input_fingerprint", "uncertainty_bin", "served_p50_km", "served_p90_km", "computed_at", "input_provisional", F.when(C("_hex") != "", "icao24").otherwise("anchor").alias("match_via"), "matched_flight_id", "n_cand",
        "truth_pts", F.coalesce("wrap_pts", F.lit(0)).alias("wrap_pts"), "settled", (C("n_cand") > 1).cast("int").alias("skip_ambiguous"), settled("_p50", "err_p50_km"), settled("_p90", "err_p90_km"), settled("_max", "err_max_km"), F.coalesce("errs_km", F.array().cast("array<float>")).alias("errs_km"),
    )
