"""Domain models over tables made from ``events``, ``orders`` and ``customer``, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import identity
from ..models import marts, paths, reconcile, segments, silver
from .bindings import ORACLE_SQL, QUERIES, query

__all__ = ["ORACLE_SQL", "QUERIES"]

C = F.col
T0 = 1_704_067_200


def _hex(c):
    return F.lower(F.lpad(F.hex(c), 6, "0"))


# A state vector for each event, ten seconds apart.
STATES = f"""
    ev AS (SELECT *, make_timestamp(({T0} + event_id * 10) * 1000000) AS seen FROM events),
    raw AS (SELECT printf('%06x', user_id) AS icao24, CASE WHEN event_type = 'click' THEN '' ELSE ' ANA' || (user_id % 50) || ' ' END AS callsign, 'C' || (user_id % 7) AS origin_country, seen AS time_position,
        120 + (event_id * 7 % 3000) / 100::DOUBLE AS longitude, CASE WHEN event_type <> 'signup' THEN 18 + (event_id * 13 % 3000) / 100::DOUBLE END AS latitude, CASE WHEN event_type <> 'error' THEN value * 40 - 600 END AS baro_altitude,
        value < 5 AS on_ground, value * 0.9::DOUBLE - 2 AS velocity, date_trunc('minute', seen) AS snapshot_time, seen AS ingested_at FROM ev),
    stg AS (SELECT * EXCLUDE (callsign), nullif(trim(callsign), '') AS callsign FROM raw WHERE latitude BETWEEN 20 AND 50 AND longitude BETWEEN 122 AND 165
        QUALIFY row_number() OVER (PARTITION BY icao24, snapshot_time ORDER BY ingested_at DESC) = 1)"""


def _at():
    return F.timestamp_seconds(C("event_id") * 10 + T0)


def _states(t) -> DataFrame:
    none = lambda kind: F.lit(None).cast(kind)
    return t("events").select(
        _hex("user_id").alias("icao24"), F.when(C("event_type") == "click", "").otherwise(F.concat(F.lit(" ANA"), (C("user_id") % 50).cast("string"), F.lit(" "))).alias("callsign"), F.concat(F.lit("C"), (C("user_id") % 7).cast("string")).alias("origin_country"),
        _at().alias("time_position"), _at().alias("last_contact"), (120 + (C("event_id") * 7 % 3000) / 100.0).alias("longitude"), F.when(C("event_type") != "signup", 18 + (C("event_id") * 13 % 3000) / 100.0).alias("latitude"),
        F.when(C("event_type") != "error", C("value") * 40 - 600).alias("baro_altitude"), (C("value") < 5).alias("on_ground"), (C("value") * 0.9 - 2).alias("velocity"), C("value").alias("true_track"), F.lit(0.0).alias("vertical_rate"), none("double").alias("geo_altitude"),
        none("string").alias("squawk"), F.lit(False).alias("spi"), F.lit(0).alias("position_source"), F.date_trunc("minute", _at()).alias("snapshot_time"), F.lit("japan").alias("region"), _at().alias("ingested_at"),
    )


@query(f"WITH {STATES} SELECT icao24, callsign, origin_country, longitude, latitude, baro_altitude AS baro_altitude_m, on_ground, velocity AS velocity_mps, snapshot_time, time_position FROM stg")
def model_stg_states(t):
    return silver.stg_states(_states(t)).select("icao24", "callsign", "origin_country", "longitude", "latitude", "baro_altitude_m", "on_ground", "velocity_mps", "snapshot_time", "time_position")


@query(f"WITH {STATES} SELECT icao24, snapshot_time, callsign, longitude, latitude, on_ground, date_trunc('hour', snapshot_time) AS snapshot_hour FROM stg")
def model_fact_state_snapshots(t):
    return silver.fact_state_snapshots(silver.stg_states(_states(t))).select("icao24", "snapshot_time", "callsign", "longitude", "latitude", "on_ground", "snapshot_hour")


@query(f"""WITH {STATES} SELECT icao24, snapshot_time, CASE WHEN baro_altitude > 15000 THEN 'altitude_too_high' WHEN baro_altitude < -500 THEN 'altitude_below_sea_level' WHEN velocity > 350 THEN 'velocity_too_high' WHEN velocity < 0 THEN 'negative_velocity' END AS anomaly_type
    FROM stg WHERE anomaly_type IS NOT NULL""")
def model_anomalies(t):
    return marts.anomalies(silver.stg_states(_states(t))).select("icao24", "snapshot_time", "anomaly_type")


@query(f"""WITH {STATES}, recent AS (SELECT * FROM stg WHERE snapshot_time >= (SELECT max(snapshot_time) FROM stg) - INTERVAL 5 MINUTE AND NOT on_ground QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY snapshot_time DESC) = 1)
    SELECT origin_country, count(*) AS airborne_aircraft, round(avg(velocity * 3.6::DOUBLE), 1) AS avg_speed_kmh, max(snapshot_time) AS snapshot_ts FROM recent GROUP BY origin_country""")
def model_agg_country_traffic(t):
    out = marts.agg_country_traffic(silver.stg_states(_states(t)))
    return out.select("origin_country", "airborne_aircraft", F.round(C("avg_speed_kmh").cast("double"), 1).alias("avg_speed_kmh"), "snapshot_ts")


@query(f"""WITH {STATES}, m AS (SELECT date_trunc('hour', snapshot_time) AS hour, icao24, max(velocity) AS v FROM raw WHERE latitude IS NOT NULL GROUP BY ALL)
    SELECT hour, count(*) AS aircraft, round(avg(v), 6) AS avg_velocity FROM m GROUP BY hour""")
def model_hourly_traffic(t):
    # a batch that comes twice changes nothing
    state = marts.hourly_traffic_state(_states(t))
    return marts.hourly_traffic(state.unionByName(state)).select("hour", "aircraft", F.round("avg_velocity", 6).alias("avg_velocity"))


@query(f"""WITH {STATES}, blank AS (SELECT DISTINCT printf('%06x', user_id) AS hex, {T0} + event_id * 10 + (event_id % 10) / 10::DOUBLE AS capture_ts FROM events WHERE event_type IN ('view', 'error')),
    known AS (SELECT icao24 AS hex, epoch(snapshot_time) AS t, min(trim(callsign)) AS c FROM raw WHERE trim(callsign) <> '' GROUP BY ALL)
    SELECT hex, capture_ts, c AS filled_callsign FROM blank JOIN known USING (hex) WHERE abs(t - capture_ts) <= 600 QUALIFY row_number() OVER (PARTITION BY hex, capture_ts ORDER BY abs(t - capture_ts), t DESC) = 1""")
def model_int_adsb_callsign_from_opensky(t):
    flight = F.when(C("event_type").isin("view", "error"), " ").otherwise("ANA1")
    adsb = t("events").select(_hex("user_id").alias("hex"), (C("event_id") * 10 + T0 + (C("event_id") % 10) / 10.0).alias("capture_ts"), flight.alias("flight"))
    return silver.int_adsb_callsign_from_opensky(adsb, _states(t)).select("hex", "capture_ts", "filled_callsign")


# A flight for each order, with ends of which some are unknown.
CODES = ["RJTT", "RJOO", "PANC", "ROAH", "RJAA", "KLAX"]
_PICK = "CASE {} " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CODES)) + " END"
FLIGHTS = f"""
    flights AS (SELECT o_orderkey AS flight_id, printf('%06x', o_custkey % 500) AS icao24, CASE WHEN o_orderkey % 11 > 0 THEN 'ANA' || (o_custkey % 40) END AS callsign,
        o_orderdate + to_minutes(o_orderkey * 37 % 1440) AS start_time, o_orderdate + to_minutes(o_orderkey * 37 % 1440 + o_orderkey * 91 % 1500 + 10) AS end_time,
        {_PICK.format('o_custkey % 40 % 7')} AS origin_icao, {_PICK.format('(o_custkey % 40 + CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 2 END) % 7')} AS dest_icao, 'R' || (o_custkey % 500) AS registration,
        CASE WHEN o_custkey % 5 > 0 THEN ' Air' || (o_custkey % 9) || ' ' END AS airline_name, (1 + o_orderkey % 3)::INT AS n_sources, 'adsblol' AS anchor_source, CASE WHEN o_orderkey % 13 = 0 THEN 'tiebreak' ELSE 'majority' END AS origin_agreement,
        'majority' AS dest_agreement, (o_orderkey % 17 = 0)::INT AS feasibility_gated FROM orders),
    aircraft AS (SELECT printf('%06x', c_custkey) AS icao24, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS operator, 'M' || (c_custkey % 4) AS model FROM customer WHERE c_custkey < 500)"""


def _pick(c):
    return F.get(F.array(*[F.lit(x) for x in CODES]), c.cast("int"))


def _flights(t) -> DataFrame:
    k, u = C("o_orderkey"), C("o_custkey")
    at = lambda minutes: C("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"))
    begin = k * 37 % 1440
    base = t("orders").select(
        k.alias("flight_id"), _hex(u % 500).alias("icao24"), F.when(k % 11 > 0, F.concat(F.lit("ANA"), (u % 40).cast("string"))).alias("callsign"), at(begin).alias("start_time"), at(begin + k * 91 % 1500 + 10).alias("end_time"),
        _pick(u % 40 % 7).alias("origin_icao"), _pick((u % 40 + F.when(k % 9 == 0, 1).otherwise(2)) % 7).alias("dest_icao"), F.concat(F.lit("R"), (u % 500).cast("string")).alias("registration"),
        F.when(u % 5 > 0, F.concat(F.lit(" Air"), (u % 9).cast("string"), F.lit(" "))).alias("airline_name"), (1 + k % 3).cast("int").alias("n_sources"), F.lit("adsblol").alias("anchor_source"),
        F.when(k % 13 == 0, "tiebreak").otherwise("majority").alias("origin_agreement"), F.lit("majority").alias("dest_agreement"), (k % 17 == 0).cast("int").alias("feasibility_gated"),
    )
    for p in ("origin", "dest"):
        base = base.withColumns({f"{p}_name": F.concat(F.lit("N"), f"{p}_icao"), f"{p}_city": F.concat(F.lit("T"), f"{p}_icao"), f"{p}_lat": F.length(f"{p}_icao").cast("double"), f"{p}_lon": F.lit(1.0)})
    return base


def _aircraft(t) -> DataFrame:
    k = C("c_custkey")
    return t("customer").where(k < 500).select(_hex("c_custkey").alias("icao24"), F.when(k % 3 == 0, "").otherwise(C("c_mktsegment")).alias("operator"), F.concat(F.lit("M"), (k % 4).cast("string")).alias("model"))


@query(f"""WITH {FLIGHTS}, m AS (SELECT icao24, origin_icao AS airport_icao, 'departure' AS direction, start_time AS t FROM flights UNION ALL SELECT icao24, dest_icao, 'arrival', end_time FROM flights)
    SELECT airport_icao, direction, (t + INTERVAL 9 HOUR)::DATE AS traffic_day, count(*) AS flights, count(DISTINCT icao24) AS unique_aircraft FROM m WHERE regexp_matches(airport_icao, '^(RJ|RO)') GROUP BY ALL""")
def model_agg_airport_daily(t):
    return marts.agg_airport_daily(_flights(t))


@query(f"""WITH {FLIGHTS} SELECT origin_icao || '-' || dest_icao AS route_inferred, 'N' || dest_icao AS dest_name, count(*) AS flight_count, count(DISTINCT icao24) AS distinct_aircraft, max(end_time) AS last_seen FROM flights WHERE origin_icao <> dest_icao GROUP BY ALL""")
def model_agg_route_traffic(t):
    return marts.agg_route_traffic(_flights(t)).select("route_inferred", "dest_name", "flight_count", "distinct_aircraft", "last_seen")


@query(f"""WITH {FLIGHTS}, n AS (SELECT f.icao24, start_time, trim(coalesce(nullif(operator, ''), airline_name)) AS operator_name FROM flights f LEFT JOIN aircraft a ON a.icao24 = f.icao24)
    SELECT operator_name, count(*) AS flight_count, count(DISTINCT icao24) AS distinct_aircraft, max(start_time) AS last_flight FROM n WHERE operator_name <> '' GROUP BY operator_name""")
def model_agg_operator_traffic(t):
    return marts.agg_operator_traffic(_flights(t), _aircraft(t))


@query(f"""WITH {FLIGHTS}, r AS (SELECT start_time::DATE AS flight_day, callsign, f.icao24, model, start_time AS first_seen, date_diff('second', start_time, end_time) AS flight_duration_seconds FROM flights f LEFT JOIN aircraft a ON a.icao24 = f.icao24
        WHERE origin_icao <> dest_icao AND flight_duration_seconds BETWEEN 1 AND 86400)
    SELECT *, row_number() OVER (PARTITION BY flight_day ORDER BY flight_duration_seconds DESC, first_seen, icao24, callsign NULLS LAST)::INT AS day_rank FROM r QUALIFY day_rank <= 10""")
def model_longest_flights(t):
    return marts.longest_flights(_flights(t), _aircraft(t)).select("flight_day", "callsign", "icao24", "model", "first_seen", "flight_duration_seconds", "day_rank")


@query(f"""WITH {FLIGHTS},
    whole AS (SELECT flight_id, upper(callsign) AS cs, origin_icao AS org, dest_icao AS dest, start_time::DATE AS d FROM flights WHERE regexp_matches(callsign, '^[A-Z]{{3}}[0-9]') AND origin_icao IS NOT NULL AND dest_icao IS NOT NULL),
    daily AS (SELECT cs, org, d, dest, count(*) AS n FROM whole GROUP BY ALL), days AS (SELECT DISTINCT cs, org, d FROM whole),
    win AS (SELECT a.cs, a.org, a.d, b.dest, sum(b.n) AS n FROM days a JOIN daily b ON a.cs = b.cs AND a.org = b.org AND b.d <= a.d AND b.d > a.d - 90 GROUP BY ALL),
    modal AS (SELECT cs, org, d, arg_max(dest, (n, dest)) AS usual, max(n) AS most, sum(n) AS support FROM win GROUP BY cs, org, d),
    j AS (SELECT f.*, usual, most, support FROM flights f LEFT JOIN whole w USING (flight_id) LEFT JOIN modal m ON m.cs = w.cs AND m.org = w.org AND m.d = w.d),
    flags AS (SELECT flight_id, 'tiebreak_endpoint' AS flag_class FROM j WHERE origin_agreement = 'tiebreak' UNION ALL SELECT flight_id, 'single_source' FROM j WHERE n_sources = 1
        UNION ALL SELECT flight_id, 'one_sided_intl' FROM j WHERE (origin_icao IS NULL) <> (dest_icao IS NULL) UNION ALL SELECT flight_id, 'feasibility_snap' FROM j WHERE feasibility_gated = 1
        UNION ALL SELECT flight_id, 'diversion' FROM j WHERE most >= 5 AND most / support >= 0.6 AND dest_icao <> usual AND origin_icao <> dest_icao
        UNION ALL SELECT flight_id, 'same_endpoint' FROM j WHERE origin_icao = dest_icao UNION ALL SELECT flight_id, 'military' FROM j WHERE flight_id % 19 = 0)
    SELECT flight_id, flag_class FROM flags""")
def model_fct_flight_flags(t):
    flights = _flights(t)
    return reconcile.fct_flight_flags(flights, flights.select("flight_id", (C("flight_id") % 19 == 0).cast("int").alias("is_military"))).select("flight_id", "flag_class")


# Fixes of two sources, and windows of airframes that overlap when padded.
FIXES = f"""
    ev AS (SELECT printf('%06x', user_id % 30) AS icao24, make_timestamp(({T0} + event_id * 10) * 1000000) AS ts, event_id, event_type FROM events),
    fixes AS (SELECT 'adsb' AS source, 1 AS src_rank, icao24, ts, event_id % 90 AS lat FROM ev WHERE event_type IN ('view', 'click') UNION ALL SELECT 'opensky', 3, icao24, ts, event_id % 90 + 0.5 FROM ev),
    windows AS (SELECT row_number() OVER (ORDER BY icao24, b) AS flight_id, icao24, s AS start_time, e AS end_time FROM (SELECT icao24, event_id // 700 AS b, min(ts) AS s, max(ts) AS e FROM ev GROUP BY ALL)),
    hits AS (SELECT f.*, w.flight_id, w.start_time::DATE AS day_key FROM fixes f JOIN windows w ON f.icao24 = w.icao24 AND f.ts BETWEEN w.start_time - INTERVAL 10 MINUTE AND w.end_time + INTERVAL 10 MINUTE
        QUALIFY row_number() OVER (PARTITION BY f.icao24, f.ts, f.source ORDER BY abs(epoch(f.ts)::BIGINT - (epoch(w.start_time)::BIGINT + epoch(w.end_time)::BIGINT) // 2), w.flight_id) = 1),
    path AS (SELECT flight_id, ts, lat::DOUBLE AS lat, source, day_key FROM hits QUALIFY row_number() OVER (PARTITION BY flight_id, ts ORDER BY src_rank) = 1)"""


def _fixes_windows(t) -> tuple[DataFrame, DataFrame]:
    from pyspark.sql import Window

    ev = t("events").select(_hex(C("user_id") % 30).alias("icao24"), _at().alias("ts"), "event_id", "event_type")
    none = F.lit(None).cast("double")
    fix = lambda df, source, rank, lat: df.select(F.lit(source).alias("source"), F.lit(rank).alias("src_rank"), "icao24", "ts", lat.cast("double").alias("lat"), F.lit(0.0).alias("lon"), none.alias("alt_ft"), F.lit(False).alias("on_ground"), none.alias("gs_kt"), none.alias("track_deg"))
    fixes = fix(ev.where("event_type in ('view', 'click')"), "adsb", 1, C("event_id") % 90).unionByName(fix(ev, "opensky", 3, C("event_id") % 90 + 0.5))
    w = ev.groupBy("icao24", F.floor(C("event_id") / 700).alias("b")).agg(F.min("ts").alias("start_time"), F.max("ts").alias("end_time"))
    return fixes, w.select(F.row_number().over(Window.orderBy("icao24", "b")).cast("long").alias("flight_id"), "icao24", "start_time", "end_time")  # a row for each window


@query(f"WITH {FIXES} SELECT flight_id, ts, lat, source, day_key FROM path")
def model_fct_flight_path(t):
    return paths.fct_flight_path(*_fixes_windows(t)).select("flight_id", "ts", "lat", "source", "day_key")


@query(f"""WITH {FIXES}, g AS (SELECT *, date_diff('second', lag(ts) OVER (PARTITION BY flight_id ORDER BY ts), ts) AS gap FROM path)
    SELECT flight_id, count(*) AS n_points, count(*) FILTER (source = 'adsb') AS n_adsb, count(*) FILTER (source = 'opensky') AS n_opensky, min(ts) AS first_fix_ts, max(ts) AS last_fix_ts, coalesce(max(gap), 0) AS largest_gap_s,
        any_value(epoch(end_time)::BIGINT - epoch(start_time)::BIGINT) AS window_s FROM g JOIN windows USING (flight_id) GROUP BY flight_id""")
def model_fct_flight_path_summary(t):
    fixes, windows = _fixes_windows(t)
    out = paths.fct_flight_path_summary(paths.fct_flight_path(fixes, windows), windows)
    return out.select("flight_id", "n_points", "n_adsb", "n_opensky", "first_fix_ts", "last_fix_ts", F.coalesce("largest_gap_s", F.lit(0)).alias("largest_gap_s"), "window_s")


@query("""SELECT count(*) AS flights, count(*) FILTER (o_orderkey % 3 > 0) AS hex_resolved, count(*) FILTER (o_orderkey % 5 = 0) AS hex_ambiguous, count(*) FILTER (o_orderstatus = 'F') AS dep_airport, count(*) FILTER (o_orderstatus = 'O') AS dep_non_airport,
    count(*) FILTER (o_orderstatus = 'P') AS dep_kind_unknown, count(*) FILTER (o_orderstatus = 'O') AS arr_airport, count(*) FILTER (o_orderstatus = 'F') AS arr_non_airport, count(*) FILTER (o_orderstatus = 'P') AS arr_kind_unknown FROM orders""")
def model_int_swim_diagnostics(t):
    kind = lambda a, b: F.when(C("o_orderstatus") == a, "airport").when(C("o_orderstatus") == b, "fix")
    k = C("o_orderkey")
    rows = t("orders").select(F.when(k % 3 > 0, "x").alias("icao24"), (k % 5 == 0).cast("int").alias("hex_ambiguous"), kind("F", "O").alias("dep_point_kind"), kind("O", "F").alias("arr_point_kind"))
    return silver.int_swim_diagnostics(rows)


@query("""WITH e AS (SELECT o_orderkey // 3 AS estimate_id, (o_orderkey % 3)::INT AS seg_idx, CASE WHEN (o_orderkey // 3) % 5 = 0 THEN 'test' ELSE 'live' END AS producer, CASE WHEN (o_orderkey // 3) % 4 > 0 THEN o_orderkey // 3 END AS flight_id,
        ((o_orderkey // 3) % 7 = 0)::INT AS input_provisional, o_orderdate AS computed_at, (o_orderkey // 30)::VARCHAR AS subject_key FROM orders),
    one AS (SELECT estimate_id, min(computed_at)::DATE AS day, min(producer) AS producer, CASE WHEN min(flight_id) IS NULL THEN 'live' WHEN max(input_provisional) = 1 THEN 'provisional' ELSE 'settled' END AS arm, min(subject_key) AS subject_key, count(*) FILTER (seg_idx > 0) AS segments
        FROM e WHERE producer <> 'test' GROUP BY estimate_id)
    SELECT day, producer, arm, count(*) AS requests, count(*) FILTER (segments > 0) AS served, count(*) FILTER (segments = 0) AS all_skipped, sum(segments)::BIGINT AS segments, count(DISTINCT subject_key) AS subjects FROM one GROUP BY ALL""")
def model_agg_est_usage_daily(t):
    n = F.floor(C("o_orderkey") / 3)
    rows = t("orders").select(
        n.alias("estimate_id"), (C("o_orderkey") % 3).cast("int").alias("seg_idx"), F.when(n % 5 == 0, "test").otherwise("live").alias("producer"), F.when(n % 4 > 0, n).alias("flight_id"), (n % 7 == 0).cast("int").alias("input_provisional"),
        C("o_orderdate").alias("computed_at"), F.floor(C("o_orderkey") / 30).cast("string").alias("subject_key"),
    )
    return marts.agg_est_usage_daily(rows)


# Traces: a point for each event, hours apart between groups of events, some on the ground.
TRACES = f"""
    pts AS (SELECT printf('%06x', user_id % 25) AS icao24, event_id AS i, ({T0} + event_id * 60)::DOUBLE AS t, (event_id % 40) / 10::DOUBLE AS lat, 139::DOUBLE AS lon, CASE WHEN event_type = 'signup' THEN 0 WHEN event_type <> 'error' THEN value * 60 END AS alt_ft, event_type = 'signup' AS ground,
        CASE WHEN event_type = 'click' THEN 'ANA' || (user_id % 3) END AS callsign FROM events WHERE event_id % 17 > 0),
    lagged AS (SELECT *, lag(t) OVER w AS pt, lag(ground) OVER w AS pg, lag(lat) OVER w AS plat, least(coalesce(alt_ft, 99999), coalesce(lag(alt_ft) OVER w, 99999)) AS low FROM pts WINDOW w AS (PARTITION BY icao24 ORDER BY i)),
    flagged AS (SELECT *, (pt IS NULL OR t - pt > 5400 OR (ground AND NOT pg) OR (t - pt >= 2700 AND low < 984) OR (t - pt >= 1800 AND low < 9843 AND 2 * 6371.0 * asin(sqrt(pow(sin(radians(lat - plat) / 2), 2))) / ((t - pt) / 3600.0) < 100))::INT AS b FROM lagged),
    grouped AS (SELECT *, sum(b) OVER (PARTITION BY icao24 ORDER BY i) AS g FROM flagged)"""


def _points(t) -> DataFrame:
    kind = C("event_type")
    return t("events").select(
        _hex(C("user_id") % 25).alias("icao24"), F.lit(float(T0)).alias("base_ts"), C("event_id").alias("i"), (C("event_id") * 60).cast("double").alias("dt_s"), ((C("event_id") % 40) / 10.0).alias("lat"), F.lit(139.0).alias("lon"),
        F.when(kind == "signup", 0.0).when(kind != "error", C("value") * 60).alias("alt_ft"), (kind == "signup").alias("ground"), F.lit(1.0).alias("gs_kt"), F.lit(2.0).alias("track"), F.when(C("event_id") % 17 == 0, 1).otherwise(0).alias("flags"),
        F.when(kind == "click", F.concat(F.lit("ANA"), (C("user_id") % 3).cast("string"))).alias("callsign"), F.lit(None).cast("string").alias("squawk"),
    )


@query(f"""WITH {TRACES}, votes AS (SELECT icao24, g, callsign AS cs, count(*) AS n FROM grouped WHERE callsign IS NOT NULL GROUP BY icao24, g, callsign),
    said AS (SELECT icao24, g, cs FROM votes QUALIFY row_number() OVER (PARTITION BY icao24, g ORDER BY n DESC, cs) = 1)
    SELECT icao24, any_value(cs) AS callsign, min(t)::BIGINT AS seg_start, max(t)::BIGINT AS seg_end, count(*) AS num_fixes, arg_min(lat, i) AS first_lat, arg_max(lat, i) AS last_lat, arg_min(ground, i) AS first_on_ground, arg_max(ground, i) AS last_on_ground
    FROM grouped LEFT JOIN said USING (icao24, g) GROUP BY icao24, g HAVING count(*) >= 2 AND count(*) FILTER (NOT ground) > 0""")
def trace_segments(t):
    out = segments.trace_segments(_points(t), F.lit("2024-01-01").cast("date"))
    return out.select("icao24", "callsign", "seg_start", "seg_end", "num_fixes", "first_lat", "last_lat", "first_on_ground", "last_on_ground")


@query(f"""WITH {TRACES}, kept AS (SELECT icao24, g, min(t)::BIGINT AS seg_start FROM grouped GROUP BY icao24, g HAVING count(*) >= 2 AND count(*) FILTER (NOT ground) > 0)
    SELECT icao24, seg_start, t::BIGINT AS ts, lat, ground AS on_ground FROM grouped JOIN kept USING (icao24, g)""")
def trace_paths(t):
    return segments.trace_paths(_points(t), F.lit("2024-01-01").cast("date")).select("icao24", "seg_start", "ts", "lat", "on_ground")


@query(f"""WITH {TRACES}, l AS (SELECT icao24, t, lag(t) OVER w AS pt, lat, lag(lat) OVER w AS plat, least(coalesce(alt_ft, 99999), coalesce(lag(alt_ft) OVER w, 99999)) AS low FROM pts WINDOW w AS (PARTITION BY icao24, floor(t / 86400) ORDER BY t))
    SELECT DISTINCT icao24, floor(t / 86400)::BIGINT AS trace_day FROM l WHERE t - pt >= 1800 AND low < 9843 AND 2 * 6371.0 * asin(sqrt(pow(sin(radians(lat - plat) / 2), 2))) / ((t - pt) / 3600.0) < 100""")
def affected_pairs(t):
    stored = segments.fixes(_points(t)).select("icao24", F.floor(C("t") / 86400).alias("trace_day"), F.lit(0).alias("seg_start"), C("t").cast("long").alias("ts"), "lat", "lon", "alt_ft")
    return segments.affected_pairs(stored)


@query("""WITH p AS (SELECT event_id, (event_id % 40) / 10::DOUBLE AS lat, (event_id % 70) / 10::DOUBLE AS lon FROM events) SELECT event_id, CASE WHEN lat BETWEEN 1 AND 2 AND lon BETWEEN 1 AND 4 THEN 'inner' WHEN lat BETWEEN 0 AND 3 AND lon BETWEEN 0 AND 5 THEN 'outer' END AS zone FROM p""")
def zone_first_match(t):
    return t("events").select("event_id", identity.zone_of((C("event_id") % 40) / 10.0, (C("event_id") % 70) / 10.0, {"inner": (1, 1, 2, 4), "outer": (0, 0, 3, 5)}).alias("zone"))


@query("""SELECT o_orderkey, printf('%06x', 10485761 + o_orderkey * 61 % 915399) AS address FROM orders""")
def registration_round_trip(t):
    there = identity.registration_of(F.lower(F.lpad(F.hex(F.lit(10485761) + C("o_orderkey") * 61 % 915399), 6, "0")))
    return t("orders").select("o_orderkey", identity.address_of(there).alias("address"))


@query("""WITH r AS (SELECT o_orderkey, o_orderkey * 7 % 95 AS a, o_orderkey * 11 % 70 AS am, o_orderkey * 13 % 185 AS o, o_orderkey * 17 % 70 AS om FROM orders)
    SELECT o_orderkey, CASE WHEN am < 60 AND om < 60 AND a + am / 60::DOUBLE <= 90 AND o + om / 60::DOUBLE <= 180 THEN 1 ELSE 0 END AS n, CASE WHEN n = 1 THEN round(0 - (a + am / 60::DOUBLE), 6) END AS lat, CASE WHEN n = 1 THEN round(o + om / 60::DOUBLE, 6) END AS lon FROM r""")
def route_coordinates(t):
    k = C("o_orderkey")
    part = lambda m, base, width: F.lpad((k * m % base).cast("string"), width, "0")
    text = F.concat(F.lit("DCT "), part(7, 95, 2), part(11, 70, 2), F.lit("S/"), part(13, 185, 3), part(17, 70, 2), F.lit("E NAT"))
    points = identity.route_points(text)
    return t("orders").select("o_orderkey", F.size(points).alias("n"), F.round(F.get(points, F.lit(0))["lat"], 6).alias("lat"), F.round(F.get(points, F.lit(0))["lon"], 6).alias("lon"))
