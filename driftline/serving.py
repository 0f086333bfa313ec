"""Serving queries over the marts, a function each. Days are Japan's unless said otherwise; only filters that are given are applied."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions.times import seconds_between, zone_day
from .models import paths
from .operators import aggs, dedup

C = F.col
#: Lower edges of the histogram of the largest gaps, seconds.
GAP_EDGES = [0, 60, 300, 900, 3600, 10800, 21600, 43200]


def _origin() -> Column:
    return F.coalesce(C("origin_iata"), C("origin_icao"))


def _dest() -> Column:
    return F.coalesce(C("dest_iata"), C("dest_icao"))


def _day() -> Column:
    return zone_day(C("start_time"), "Asia/Tokyo")


def in_days(df: DataFrame, first: dt.date, last: dt.date, day: Column | None = None) -> DataFrame:
    return df.where((_day() if day is None else day).between(F.lit(first), F.lit(last)))


def with_tier(flights: DataFrame, tiers: DataFrame | None) -> DataFrame:
    """Adds tier (``unknown`` where the mart has none), effective_gap_s, n_points, is_military."""
    if tiers is None:
        return flights.withColumns({"tier": F.lit("unknown"), "effective_gap_s": F.lit(None).cast("long"), "n_points": F.lit(None).cast("long"), "is_military": F.lit(0)})
    t = tiers.select("flight_id", "tier", "effective_gap_s", "n_points", "is_military")
    return flights.join(t, "flight_id", "left").withColumn("tier", F.coalesce("tier", F.lit("unknown"))).withColumn("is_military", F.coalesce("is_military", F.lit(0)))


def _filters(callsign=None, airline=None, hex=None, reg=None, airport=None, type=None, od=None, military=False) -> list[Column]:
    out = []
    if callsign:
        out.append(F.upper(F.trim("callsign")) == callsign.upper())
    if airline:
        out.append(C("airline_name") == airline)
    if hex:
        out.append(F.lower("icao24") == hex.lower())
    if reg:
        out.append(F.upper("registration") == reg.upper())
    if airport:
        out.append(F.array_contains(F.array_compact(F.array(*[F.upper(c) for c in ("origin_icao", "origin_iata", "dest_icao", "dest_iata")])), airport.upper()))
    if type:
        out.append(C("typecode") == type)
    if od:
        out += [_origin() == od[0]] if od[0] else []
        out += [_dest() == od[1]] if od[1] else []
    if military:
        out.append(C("is_military") == 1)
    return out


_INSTANCE = ["flight_id", "day", "start_time", "end_time", "icao24", "registration", "typecode", "callsign", "airline", "origin_icao", "origin_iata", "origin_city", "dest_icao", "dest_iata", "dest_city", "tier", "effective_gap_s", "n_points", "is_military"]


def _instance(df: DataFrame, *more: str) -> DataFrame:
    # ids go out as text: readers of JSON lose the low bits of 64-bit numbers
    return df.withColumn("day", _day()).withColumn("airline", C("airline_name")).withColumn("icao24", F.lower("icao24")).withColumn("flight_id", C("flight_id").cast("string")).select(*_INSTANCE, *more)


def _selected(flights, tiers, first, last, **filters) -> DataFrame:
    df = in_days(with_tier(flights, tiers), first, last)
    for f in _filters(**filters):
        df = df.where(f)
    return df


def instances(flights: DataFrame, tiers: DataFrame | None, first: dt.date, last: dt.date, limit: int = 50, offset: int = 0, ascending: bool = False, **filters) -> DataFrame:
    order = [C("start_time").asc_nulls_last(), C("flight_id")] if ascending else [C("start_time").desc_nulls_last(), C("flight_id").desc()]
    return _instance(dedup.page(_selected(flights, tiers, first, last, **filters), order, limit, offset))


def instances_count(flights, tiers, first, last, **filters) -> DataFrame:
    return _selected(flights, tiers, first, last, **filters).agg(F.count("*").alias("n"))


def od_breakdown(flights, tiers, first, last, k: int = 8, **filters) -> DataFrame:
    filters.pop("od", None)
    df = _selected(flights, tiers, first, last, **filters).select(_origin().alias("o"), _dest().alias("d")).where("o is not null and d is not null")
    return dedup.top_k(df.groupBy("o", "d").agg(F.count("*").alias("n")), [C("n").desc(), C("o"), C("d")], k)


def _flagged(flags, flights, first, last) -> DataFrame:
    return in_days(flights.join(flags.select("flight_id", "flag_class", "detail"), "flight_id"), first, last)


def flag_feed(flags, flights, tiers, first, last, flag_class=None, limit=50, offset=0) -> DataFrame:
    df = with_tier(_flagged(flags, flights, first, last), tiers)
    df = df.where(C("flag_class") == flag_class) if flag_class else df
    return _instance(dedup.page(df, [C("start_time").desc_nulls_last(), C("flight_id").desc(), C("flag_class")], limit, offset), "flag_class", "detail")


def flag_classes(flags, flights, first, last) -> DataFrame:
    return _flagged(flags, flights, first, last).groupBy("flag_class").agg(F.count("*").alias("n")).orderBy("flag_class")


def _tier_mix() -> list[Column]:
    return [F.count_if(C("tier") == t).alias(f"tier_{t}") for t in ("settled", "estimated", "provisional")] + [F.count_if(C("tier").isin("none", "unknown")).alias("tier_none")]


def airlines(flights, tiers, q: str = "", limit=50, offset=0) -> DataFrame:
    df = with_tier(flights, tiers).where(F.contains(F.lower("airline_name"), F.lit(q.lower())))
    out = df.groupBy(C("airline_name").alias("name")).agg(F.count("*").alias("n_flights"), F.count_distinct("callsign").alias("n_services"), F.min(_day()).alias("first_day"), F.max(_day()).alias("last_day"), *_tier_mix())
    return dedup.page(out, [C("n_flights").desc(), C("name")], limit, offset)


def services(flights, tiers, airline: str = "", q: str = "", limit=50, offset=0) -> DataFrame:
    """Callsigns of an airline, or by their start; each with its three most frequent pairs of ends."""
    df = with_tier(flights, tiers).where("callsign <> ''")
    df = df.where(C("airline_name") == airline) if airline else df.where(F.upper(F.trim("callsign")).startswith(q.upper()))
    out = dedup.page(df.groupBy("callsign").agg(F.count("*").alias("n_instances"), F.min(_day()).alias("first_day"), F.max(_day()).alias("last_day"), *_tier_mix()), [C("n_instances").desc(), C("callsign")], limit, offset)
    pairs = df.join(out.select("callsign"), "callsign", "left_semi").select("callsign", _origin().alias("o"), _dest().alias("d")).where("o is not null and d is not null").groupBy("callsign", "o", "d").agg(F.count("*").alias("n"))
    top = dedup.top_per_key(pairs, ["callsign"], [C("n").desc(), C("o"), C("d")], 3, "rn").groupBy("callsign").agg(F.array_sort(F.collect_list(F.struct("rn", "o", "d", "n"))).alias("top_od"))
    return out.join(top, "callsign", "left")


def unique_inputs(settlement: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Scored segments, one of those with the same input."""
    df = in_days(settlement.where("skip_ambiguous = 0 and settled = 1 and err_p50_km is not null"), first, last, zone_day(C("computed_at"), "Asia/Tokyo"))
    return dedup.limit_by(df, ["input_fingerprint", "seg_idx"], [C("computed_at"), C("estimate_id")])


def summary(flights, first, last, prev_first, prev_last, flags=None, tiers=None, settlement=None) -> DataFrame:
    """(sect, k, k2, v1, v2): totals, days, movers, and, where their marts exist, flags, tiers and errors, in one shape."""
    w = in_days(flights, first, last).withColumn("jday", _day())
    row = lambda df, sect, k, v1, k2=F.lit(""), v2=F.lit(0.0): df.select(F.lit(sect).alias("sect"), k.alias("k"), k2.alias("k2"), v1.cast("double").alias("v1"), v2.cast("double").alias("v2"))
    totals = w.agg(F.count("*").alias("flights"), F.count_distinct("icao24").alias("aircraft"), F.count_distinct(F.when(C("callsign") != "", C("callsign"))).alias("services"))
    out = row(totals.select(F.explode(F.create_map(*[x for c in ("flights", "aircraft", "services") for x in (F.lit(c), C(c))])).alias("k", "n")), "total", C("k"), C("n"))
    out = out.unionByName(row(w.groupBy("jday").agg(F.count("*").alias("n")), "daily", C("jday").cast("string"), C("n")))
    route = F.concat(_origin(), F.lit("-"), _dest())
    pairs = flights.where("origin_icao is not null and dest_icao is not null").withColumn("route", route)
    moved = aggs.trend(pairs, "route", _day().between(F.lit(first), F.lit(last)), _day().between(F.lit(prev_first), F.lit(prev_last))).where("n > 0")
    out = out.unionByName(row(dedup.top_k(moved, [C("n").desc(), C("route")], 5), "mover", C("route"), C("n"), v2=C("n_prev")))
    if flags is not None:
        f = flags.join(w.select("flight_id"), "flight_id")
        out = out.unionByName(row(f.groupBy("flag_class").agg(F.count("*").alias("n")), "flag", C("flag_class"), C("n"))).unionByName(row(f.agg(F.count_distinct("flight_id").alias("n")), "flagged", F.lit(""), C("n")))
    if tiers is not None:
        t = with_tier(w, tiers)
        out = out.unionByName(row(t.groupBy("tier").agg(F.count("*").alias("n")), "tier", C("tier"), C("n"))).unionByName(row(t.groupBy("jday", "tier").agg(F.count("*").alias("n")), "tier_daily", C("jday").cast("string"), C("n"), C("tier")))
    if settlement is not None:
        s = unique_inputs(settlement, first, last).withColumn("jday", zone_day(C("computed_at"), "Asia/Tokyo").cast("string"))
        for sect, key in (("est", F.lit("p50")), ("est_daily", C("jday"))):
            pool = s.select(key.alias("k"), F.explode("errs_km").alias("e")).groupBy("k").agg(aggs.quantile_nearest_rank("e", 0.5).alias("p"))
            n = s.groupBy(key.alias("k")).agg(F.count("*").alias("n"))
            out = out.unionByName(row(n.join(pool, "k", "left"), sect, C("k"), F.coalesce("p", F.lit(-1.0)), v2=C("n")))
    return out


def estimate_percentiles(settlement, first, last, daily: bool = False) -> DataFrame:
    """Errors of unique inputs pooled by configuration (and day): n, p50, p90; -1 for an empty pool."""
    s = unique_inputs(settlement, first, last).withColumn("day", zone_day(C("computed_at"), "Asia/Tokyo")).withColumn("cfg", C("config_hash").cast("string"))
    keys = ["day", "cfg"] if daily else ["cfg"]
    pool = s.select(*keys, F.explode("errs_km").alias("e")).groupBy(*keys).agg(aggs.quantile_nearest_rank("e", 0.5).alias("p50"), aggs.quantile_nearest_rank("e", 0.9).alias("p90"))
    n = s.groupBy(*keys).agg(F.count("*").alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day")) if not daily else s.groupBy(*keys).agg(F.count("*").alias("n"))
    return n.join(pool, keys, "left").fillna(-1.0, ["p50", "p90"])


def estimate_mix(breakdown, first, last) -> DataFrame:
    """UTC days, as the mart has them."""
    return in_days(breakdown, first, last, C("day")).groupBy("dimension", "value", "producer").agg(F.sum("n").alias("n"))


def estimate_outcomes(settlement, first, last) -> DataFrame:
    """Of the raw rows, not the unique inputs."""
    s = in_days(settlement, first, last, zone_day(C("computed_at"), "Asia/Tokyo"))
    return s.agg(F.count_if(C("settled") == 1).alias("n_settled"), F.count_if((C("settled") == 0) & (C("skip_ambiguous") == 0)).alias("n_awaiting"), F.count_if(C("skip_ambiguous") == 1).alias("n_ambiguous"), F.count_if(C("input_provisional") == 1).alias("n_input_provisional"), F.count_if(C("input_provisional") == 0).alias("n_input_settled"))


def coverage_daily(flights, tiers, first, last) -> DataFrame:
    return in_days(with_tier(flights, tiers), first, last).groupBy(_day().alias("day"), "tier").agg(F.count("*").alias("n"))


def coverage_gaps(flights, tiers, first, last) -> DataFrame:
    return aggs.fixed_bins(in_days(flights, first, last).join(tiers.select("flight_id", "largest_gap_s"), "flight_id"), "largest_gap_s", GAP_EDGES, "ge")


def coverage_observed(flights, tiers, first, last) -> DataFrame:
    df = in_days(flights, first, last).join(tiers.select("flight_id", "observed_fraction"), "flight_id").where("observed_fraction is not null")
    return df.groupBy(_day().alias("day")).agg(aggs.quantile_floor("observed_fraction", 0.5).alias("med"), F.count("*").alias("n"))


def trends(flights, dim: str, first, last, prev_first, prev_last, limit=50, offset=0) -> DataFrame:
    """By route, airline or airport: n, distinct_aircraft, prev_n. A flight counts once for an airport at which it starts and ends."""
    key = {"route": F.concat(_origin(), F.lit("-"), _dest()), "airline": C("airline_name"), "airport": F.explode(F.array_distinct(F.array_compact(F.array(_origin(), _dest()))))}[dim]
    df = flights.withColumn("_d", _day()).select("icao24", "_d", key.alias("k")).where("k is not null")
    now, before = C("_d").between(F.lit(first), F.lit(last)), C("_d").between(F.lit(prev_first), F.lit(prev_last))
    out = df.where(now | before).groupBy("k").agg(F.count_if(now).alias("n"), F.count_distinct(F.when(now, C("icao24"))).alias("distinct_aircraft"), F.count_if(before).alias("prev_n")).where("n > 0")
    return dedup.page(out, [C("n").desc(), C("k")], limit, offset)


def search(flights, airports, q: str, limit: int = 10) -> dict[str, DataFrame]:
    """Airlines, services, airframes and airports that a text finds."""
    up, low = q.strip().upper(), q.strip().lower()
    found = lambda c: F.contains(F.lower(c), F.lit(low))
    a = flights.where(found("airline_name")).groupBy(C("airline_name").alias("name")).agg(F.count("*").alias("n_flights"))
    s = flights.where((C("callsign") != "") & F.upper(F.trim("callsign")).startswith(up)).groupBy("callsign").agg(F.min("airline_name").alias("airline"), F.count("*").alias("n_instances"))
    reg = F.upper(F.replace(F.coalesce("registration", F.lit("")), F.lit("-"), F.lit("")))
    f = flights.where(F.lower("icao24").startswith(low) | reg.startswith(up.replace("-", ""))).groupBy(F.lower("icao24").alias("icao24")).agg(F.min("registration").alias("registration"), F.min("typecode").alias("typecode"), F.count("*").alias("n_instances"))
    p = airports.where(F.upper("icao").startswith(up) | F.upper(F.coalesce("iata", F.lit(""))).startswith(up) | found("name") | found("city")).select("icao", "iata", "name", "city")
    return {
        "airlines": dedup.top_k(a, [C("n_flights").desc(), C("name")], limit), "services": dedup.top_k(s, [C("n_instances").desc(), C("callsign")], limit),
        "airframes": dedup.top_k(f, [C("n_instances").desc(), C("icao24")], limit), "airports": dedup.top_k(p, [C("name"), C("icao")], limit),
    }


def recent_routes(flights, as_of, days: int = 7) -> DataFrame:
    """The latest known route of each callsign within some days of a time."""
    known = flights.where((C("callsign") != "") & C("origin_icao").isNotNull() & C("dest_icao").isNotNull() & (C("end_time") > F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))))
    return dedup.latest_per_key(known.select("callsign", "end_time", "origin_icao", "dest_icao"), ["callsign"], "end_time")


def drop_private(live: DataFrame, ladd: DataFrame, as_of: dt.date) -> DataFrame:
    """Live rows (hex, callsign) without those on the privacy list, by airframe or callsign, on a day."""
    valid = ladd.where((C("valid_to").isNull()) | (C("valid_to") >= F.lit(as_of)))
    by_hex = valid.select(F.lower("icao24").alias("_h")).where("_h is not null").distinct()
    by_call = valid.select(F.upper(F.trim("callsign")).alias("_c")).where("_c <> ''").distinct()
    return live.join(by_hex, F.lower("hex") == C("_h"), "left_anti").join(by_call, F.upper(F.trim("callsign")) == C("_c"), "left_anti")


def flight_seconds(flights: DataFrame) -> DataFrame:
    return flights.select("flight_id", seconds_between(C("start_time"), C("end_time")).alias("seconds"))


# Live reads


def aircraft_snapshot(current: DataFrame, routes: DataFrame, private: DataFrame | None = None, as_of: dt.date | None = None) -> DataFrame:
    """What the map shows now: rows with a position, the callsign trimmed (blank is null), the latest route of the callsign, and ``nav_modes`` as a list (null where it is none). Airframes on the privacy list, or marked so, are left out where the list is given."""
    shown = current.where("lat is not null and lon is not null").withColumn("flight", F.nullif(F.trim("flight"), F.lit("")))
    if private is not None:
        shown = drop_private(shown.where(~F.coalesce("is_ladd", F.lit(False))).withColumn("callsign", C("flight")), private, as_of).drop("callsign")
    known = routes.select(C("callsign").alias("_cs"), F.struct("origin_icao", "dest_icao").alias("route"))
    out = shown.join(known, C("flight") == F.trim("_cs"), "left").drop("_cs", "is_ladd")
    return out.withColumn("nav_modes", F.from_json("nav_modes", "array<string>"))


def track(positions: DataFrame, hex: str, as_of: float, seconds: int = 1800, private: DataFrame | None = None) -> DataFrame:
    """The trail of an airframe in the seconds before a time, oldest first; none for an airframe on the privacy list."""
    trail = positions.where((F.lower("hex") == hex.strip().lower()) & (C("capture_ts") > as_of - seconds) & (C("capture_ts") <= as_of) & C("lat").isNotNull() & C("lon").isNotNull())
    if private is not None:
        trail = drop_private(trail.withColumn("callsign", F.lit(None).cast("string")), private, dt.datetime.fromtimestamp(as_of, dt.timezone.utc).date())
    return trail.select("lon", "lat", "capture_ts", "alt_baro").orderBy("capture_ts")


def flight_paths(requests: DataFrame, flights: DataFrame, path: DataFrame, fixes: DataFrame, private: DataFrame | None = None, as_of: dt.date | None = None) -> DataFrame:
    """(flight_id, status, points) for requested ids (``flight_id`` as text): the rungs of a ladder.

    ``settled``: the path that was built. ``settled_empty``: its day has been built, and there is none. ``provisional``: the day is yet to come, so the fixes are fused now, in a contest with the airframe's other
    flights. ``denied``: no such id, a flight without a window or on the privacy list, or no path at all to tell how far the build has come; it has the same empty shape.
    """
    asked = requests.select(C("flight_id").alias("request")).distinct().withColumn("flight_id", F.when(C("request").rlike("^-?[0-9]+$"), C("request").try_cast("long")))
    known = flights.select("flight_id", F.lower("icao24").alias("hex"), F.trim("callsign").alias("callsign"), "start_time", "end_time", F.coalesce(C("is_ladd"), F.lit(0)).alias("_listed"))
    if private is not None:
        known = drop_private(known.where("_listed = 0"), private, as_of)
    head = path.agg(F.max("day_key").alias("_head"))  # one row
    j = asked.join(known, "flight_id", "left").crossJoin(F.broadcast(head))
    point = F.struct(F.unix_seconds("ts").alias("ts"), "lat", "lon", "alt_ft", "on_ground", "gs_kt", "track_deg", "source")
    wanted = j.select("flight_id").where("flight_id is not null").distinct()
    built = path.join(wanted, "flight_id", "left_semi").groupBy("flight_id").agg(F.array_sort(F.collect_list(point)).alias("_settled"))
    j = j.join(built, "flight_id", "left")
    late = C("hex").isNotNull() & C("_settled").isNull() & (F.to_date("start_time") > C("_head")) & C("end_time").isNotNull()
    open_ = j.where(late).select("flight_id", "hex")
    rivals = flights.join(open_.select(C("hex").alias("_hex")).distinct(), F.lower("icao24") == C("_hex"), "left_semi")
    seen = fixes.join(open_.select(C("hex").alias("icao24")).distinct(), "icao24", "left_semi")
    fused = paths.fct_flight_path(seen, rivals).join(open_.select("flight_id").distinct(), "flight_id", "left_semi")
    now = fused.groupBy("flight_id").agg(F.array_sort(F.collect_list(point)).alias("_now"))
    none = F.array().cast(built.schema["_settled"].dataType)
    served = F.when(C("hex").isNull(), "denied").when(C("_settled").isNotNull(), "settled").when(C("start_time").isNull() | C("_head").isNull(), "denied").when(F.to_date("start_time") <= C("_head"), "settled_empty").when(C("end_time").isNull(), "denied").otherwise("provisional")
    out = j.join(now, "flight_id", "left").withColumn("status", served)
    return out.select(C("request").alias("flight_id"), "status", F.when(C("status") == "settled", C("_settled")).when(C("status") == "provisional", F.coalesce("_now", none)).otherwise(none).alias("points"))
