"""Staging and silver models: states, airframes, legs, segments, chains, schedules. Optional inputs may be None."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CONFIG, Config
from ..functions import scalars
from ..functions.geo import haversine, wrap_lon
from ..functions.times import epoch_seconds, seconds_between
from ..operators import dedup, joins, sequences

C = F.col
#: bronze name -> staged name, where they differ.
RENAMED = {"baro_altitude": "baro_altitude_m", "velocity": "velocity_mps", "true_track": "track_deg", "vertical_rate": "vertical_rate_mps", "geo_altitude": "geo_altitude_m"}
STATE_COLUMNS = ["icao24", "callsign", "origin_country", "time_position", "last_contact", "longitude", "latitude", "baro_altitude_m", "on_ground", "velocity_mps", "track_deg", "vertical_rate_mps", "geo_altitude_m", "squawk", "spi", "position_source", "snapshot_time", "region", "ingested_at"]


def stage_states(raw: DataFrame, where: Column, extra: tuple[str, ...] = ()) -> DataFrame:
    """Typed names and units; of the copies of (icao24, snapshot_time) the one ingested last, by a total order of content."""
    typed = raw.where(where).withColumnsRenamed(RENAMED).withColumn("callsign", scalars.blank_null(C("callsign"))).select(*STATE_COLUMNS, *extra)
    tail = [c for c in [*STATE_COLUMNS, *extra] if c not in ("icao24", "snapshot_time", "ingested_at")]
    return dedup.top_per_key(typed, ["icao24", "snapshot_time"], [C("ingested_at").desc_nulls_last(), *[C(c).asc_nulls_last() for c in tail]])


def stg_states(raw: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    return stage_states(raw, scalars.in_box(C("latitude"), C("longitude"), cfg.box))


def stg_states_adsblol(raw: DataFrame) -> DataFrame:
    return stage_states(raw, C("region") == "japan", ("source",))


def stg_flight_segments_adsblol(bronze: DataFrame) -> DataFrame:
    latest = dedup.latest_per_key(bronze, ["trace_day", "icao24", "seg_start"], "ingested_at")
    grounded = lambda c: F.coalesce(C(c), F.lit(False)).alias(c)
    return latest.select(
        F.lower("icao24").alias("icao24"), scalars.blank_null(C("callsign")).alias("callsign"), C("seg_start").alias("seg_start_time"), C("seg_end").alias("seg_end_time"), "num_fixes",
        "first_lat", "first_lon", scalars.feet_to_metres(C("first_alt_ft")).alias("first_alt_m"), grounded("first_on_ground"), "last_lat", "last_lon", scalars.feet_to_metres(C("last_alt_ft")).alias("last_alt_m"), grounded("last_on_ground"), "trace_day",
    )


def fact_state_snapshots(stg: DataFrame) -> DataFrame:
    keep = ["icao24", "snapshot_time", "region", "callsign", "origin_country", "longitude", "latitude", "baro_altitude_m", "velocity_mps", "track_deg", "vertical_rate_mps", "on_ground"]
    return stg.where("latitude is not null and longitude is not null").select(*keep, F.date_trunc("hour", "snapshot_time").alias("snapshot_hour"))


def int_adsb_callsign_from_opensky(adsb: DataFrame, states: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """(hex, capture_ts, filled_callsign): the callsign of the nearest snapshot on either side of a blank frame, the later of two as near."""
    blank = adsb.where(scalars.blank_null(C("flight")).isNull()).select("hex", "capture_ts").distinct()
    # seconds since the epoch with a fraction: as-of over numbers, no key's rows paired
    known = states.where(scalars.blank_null(C("callsign")).isNotNull()).select(C("icao24").alias("hex"), epoch_seconds(C("snapshot_time")).alias("capture_ts"), F.trim("callsign").alias("callsign"))
    one = known.groupBy("hex", "capture_ts").agg(F.min("callsign").alias("callsign"))
    both = blank.select("hex", "capture_ts", F.lit(None).cast("string").alias("callsign")).unionByName(one)
    w = Window.partitionBy("hex").orderBy("capture_ts")
    hit = F.when(C("callsign").isNotNull(), F.struct(C("capture_ts").alias("t"), "callsign"))
    before = F.last(hit, ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.first(hit, ignorenulls=True).over(w.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    near = both.withColumn("b", before).withColumn("a", after).where("callsign is null")
    db, da = C("capture_ts") - C("b.t"), C("a.t") - C("capture_ts")
    inside = lambda d: F.coalesce(d <= cfg.backfill_window_s, F.lit(False))
    pick = F.when(inside(da) & (~inside(db) | (da <= db)), C("a.callsign")).when(inside(db), C("b.callsign"))
    return near.select("hex", "capture_ts", pick.alias("filled_callsign")).where("filled_callsign is not null")


def with_country(df: DataFrame, address: str, ranges: DataFrame, out: str) -> DataFrame:
    """Adds the country of a hexadecimal address; null outside the ranges or for what is no address."""
    numbered = df.withColumn("_n", scalars.hex_to_number(F.lower(address)))
    named = ranges.select(C("block_lo").alias("_lo"), C("block_hi").alias("_hi"), C("country").alias(out))
    return joins.range_lookup(numbered, "_n", named, "_lo", "_hi", out, 4096).drop("_n")


def dim_aircraft_registry(registry: DataFrame, ranges: DataFrame, community: DataFrame | None = None) -> DataFrame:
    """The newest snapshot of each airframe, filled from the community registry where there is one."""
    def newest(df):
        rest = [c for c in df.columns if c not in ("icao24", "as_of_date", "committed_at")]
        return dedup.top_per_key(df, ["icao24"], [C("as_of_date").desc_nulls_last(), C("committed_at").desc_nulls_last(), *[C(c).asc_nulls_last() for c in rest]])

    main = newest(registry).select("icao24", "registration", C("manufacturername").alias("manufacturer"), "model", "typecode", "icaoaircrafttype", "operator", "operatorcallsign", "operatoricao", "owner", "as_of_date")
    if community is not None:
        blank = lambda c: F.nullif(C(c), F.lit("")).alias(c)
        main = main.select(*[blank(c) if c in ("registration", "manufacturer", "model", "typecode", "owner") else c for c in main.columns])
        more = newest(community).select("icao24", "registration", "manufacturer", "model", C("icaotype").alias("typecode"), C("ownop").alias("owner"), "as_of_date")
        main = joins.full_outer_fill(main, more, ["icao24"]).select(main.columns)
    return with_country(main, "icao24", ranges, "country_of_registration")


def dim_aircraft(adsb: DataFrame, registry: DataFrame, types: DataFrame, ranges: DataFrame) -> DataFrame:
    last = lambda c: dedup.argmax(C(c), C("capture_ts"))
    seen = adsb.where("hex is not null").groupBy(F.lower("hex").alias("icao24")).agg(last("r").alias("_reg"), last("t").alias("_type"), last("desc").alias("aircraft_desc"), last("category").alias("category"), last("ownOp").alias("operator_raw"))
    r = registry.select("icao24", "registration", C("typecode").alias("_rtype"), "operator", "owner", C("model").alias("_model"), "manufacturer")
    joined = seen.join(r, "icao24", "left").withColumn("typecode", F.coalesce("_rtype", "_type"))
    typed = joined.join(types.select("typecode", "model_name"), "typecode", "left")
    out = typed.select("icao24", F.coalesce("registration", "_reg").alias("registration"), "typecode", "aircraft_desc", "category", "operator_raw", "operator", "owner", F.coalesce("_model", "model_name").alias("model"), "manufacturer")
    return with_country(out, "icao24", ranges, "country_of_registration")


def fct_adsb_state(adsb: DataFrame, backfill: DataFrame, aircraft: DataFrame, airlines: DataFrame, ranges: DataFrame) -> DataFrame:
    """Bronze rows, as many as there are, decoded and enriched."""
    own = scalars.blank_null(C("flight"))
    base = adsb.select("capture_ts", "hex", "flight", "lat", "lon", "alt_baro", "gs", "track", "db_flags").join(backfill, ["hex", "capture_ts"], "left")
    base = base.withColumn("callsign_filled", F.coalesce(own, "filled_callsign")).withColumn("callsign_source", F.when(own.isNotNull(), "adsb").when(C("filled_callsign").isNotNull(), "opensky_backfill"))
    flags = {"is_military": 1, "is_interesting": 2, "is_pia": 4, "is_ladd": 8}
    base = base.withColumns({k: scalars.bit_flag(C("db_flags"), b) for k, b in flags.items()}).withColumn("icao24", F.lower("hex"))
    base = base.withColumn("_airline", F.when(scalars.airline_shaped(C("callsign_filled")), F.substring(F.trim("callsign_filled"), 1, 3)))
    out = base.join(aircraft.select("icao24", "registration", "typecode", "category"), "icao24", "left").join(airlines.select(C("icao").alias("_airline"), C("name").alias("airline_name"), C("country").alias("airline_country")), "_airline", "left")
    cols = ["capture_ts", "hex", "flight", "callsign_filled", "callsign_source", "lat", "lon", "alt_baro", "gs", "track", *flags, "registration", "typecode", "category", "airline_name", "airline_country"]
    return with_country(out.select(cols), "hex", ranges, "reg_country")


def int_jet_airframes(registry: DataFrame, aircraft: DataFrame, types: DataFrame) -> DataFrame:
    """Jets: by the type designator where there is one, else by body class, without the military turboprops."""
    blank = lambda c: F.nullif(C(c), F.lit(""))
    r = registry.select(F.lower("icao24").alias("icao24"), blank("icaoaircrafttype").alias("designator"), blank("typecode").alias("typecode"))
    frames = joins.full_outer_fill(r, aircraft.select(F.lower("icao24").alias("icao24"), blank("typecode").alias("typecode")), ["icao24"])
    classed = frames.join(types.select("typecode", "body_class"), "typecode", "left")
    jet = F.when(C("designator").isNotNull(), C("designator").rlike("^L[0-9]J$")).otherwise(C("body_class").isin("narrowbody", "widebody", "quad") & ~C("typecode").isin("C130", "C30J"))
    return classed.where(jet).select("icao24").distinct()


def snap_endpoint(ends: DataFrame, airports: DataFrame, keys: list[str], prefix: str, cfg: Config = CONFIG, prefer_iata: bool = False) -> DataFrame:
    """keys and the nearest usable airport of each endpoint (lat, lon, shaped, jet): scheduled fields for airline callsigns, none that a jet cannot use. With
    ``prefer_iata`` a field with an IATA code wins when it is very near."""
    cell = F.floor("_lat").cast("int")
    points = ends.where("_lat is not null and _lon is not null").withColumn("_cell", F.explode(F.sequence(cell - 1, cell + 1)))
    a = airports.select(C("icao").alias("_icao"), C("iata").alias("_iata"), C("name").alias("_name"), C("lat").alias("_alat"), C("lon").alias("_alon"), C("scheduled_service").alias("_sched"), C("airport_type").alias("_kind"), C("runway_length_ft").alias("_runway"), F.floor("lat").cast("int").alias("_cell"))
    near = (F.abs(C("_alat") - C("_lat")) <= cfg.snap_km / 110.574) & (F.abs(wrap_lon(C("_alon") - C("_lon"))) <= cfg.snap_km / (111.32 * F.greatest(F.cos(F.radians("_lat")), F.lit(0.01))))
    usable = (~C("_shaped") | C("_sched")) & ~scalars.jet_infeasible(C("_shaped"), C("_jet"), C("_runway"), C("_kind"), cfg.jet_min_runway_ft)
    hits = points.join(a, "_cell").where(near & usable).withColumn("_d", haversine(C("_lat"), C("_lon"), C("_alat"), C("_alon"))).where(C("_d") <= cfg.snap_km)
    first = F.when((C("_iata") != "") & (C("_d") <= cfg.iata_pref_km), 0).otherwise(1) if prefer_iata else F.lit(0)
    best = F.min_by(F.struct("_icao", "_name", "_alat", "_alon"), F.struct(first, "_d", "_icao"))
    return hits.groupBy(*keys).agg(best.alias("_b")).select(*keys, *[C(f"_b.{c}").alias(f"{prefix}_{n}") for c, n in (("_icao", "icao"), ("_name", "name"), ("_alat", "lat"), ("_alon", "lon"))])


def _jet_flag(df: DataFrame, jets: DataFrame) -> DataFrame:
    return df.join(jets.select(C("icao24").alias("_j")).distinct(), F.lower("icao24") == C("_j"), "left").withColumn("_jet", C("_j").isNotNull()).drop("_j")


def int_flight_legs_opensky(snapshots: DataFrame, airports: DataFrame, jets: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """Airborne legs of each airframe with the airports at their low ends."""
    order = [C("snapshot_time")]
    rows = sequences.with_previous(snapshots, ["icao24"], order, ["snapshot_time", "on_ground", "callsign"])
    gap = seconds_between(C("prev_snapshot_time"), C("snapshot_time"))
    breaks = (gap > cfg.legs_gap_min * 60) | F.coalesce(C("on_ground") & ~C("prev_on_ground"), F.lit(False)) | F.coalesce((C("callsign") != C("prev_callsign")) & (gap > cfg.legs_turnaround_min * 60), F.lit(False))
    air = sequences.break_sessions(rows, ["icao24"], order, breaks, "leg_id").where("not on_ground")
    key = ["icao24", "leg_id"]
    at = C("snapshot_time")
    ends = air.groupBy(*key).agg(
        F.min(at).alias("start_time"), F.max(at).alias("end_time"), F.count("*").alias("num_fixes"),
        *[f(C(c), at).alias(f"{p}_{n}") for p, f in (("first", F.min_by), ("last", F.max_by)) for c, n in (("latitude", "lat"), ("longitude", "lon"), ("baro_altitude_m", "alt_m"))],
    )
    named = ends.join(sequences.dominant_value(air, key, "callsign", "snapshot_time", "callsign").drop("callsign_n"), key, "left")
    marked = _jet_flag(named, jets).withColumn("_shaped", scalars.airline_shaped(C("callsign")))
    for side, prefix in (("first", "origin"), ("last", "dest")):
        low = marked.where(C(f"{side}_alt_m") < cfg.cruise_alt_m).select(*key, C(f"{side}_lat").alias("_lat"), C(f"{side}_lon").alias("_lon"), "_shaped", "_jet")
        named = named.join(snap_endpoint(low, airports, key, prefix, cfg), key, "left")
    return named


def int_flight_routes_adsblol(segments: DataFrame, airports: DataFrame, jets: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    key = ["icao24", "seg_start_time"]
    marked = _jet_flag(segments, jets).withColumn("_shaped", scalars.airline_shaped(C("callsign")))
    out = segments.select("icao24", "callsign", "seg_start_time", "seg_end_time", "num_fixes", "trace_day")
    for side, prefix in (("first", "origin"), ("last", "dest")):
        low = marked.where(C(f"{side}_on_ground") | (C(f"{side}_alt_m") < cfg.cruise_alt_m)).select(*key, C(f"{side}_lat").alias("_lat"), C(f"{side}_lon").alias("_lon"), "_shaped", "_jet")
        out = out.join(snap_endpoint(low, airports, key, prefix, cfg, prefer_iata=True), key, "left")
    return out


def int_flight_chains_adsblol(segments: DataFrame, routes: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """Segments that are one flight, joined over coverage gaps: no ground, no stop that the gap could hide, a plausible speed between."""
    places = [f"{p}_{c}" for p in ("origin", "dest") for c in ("icao", "name", "lat", "lon")]
    rows = segments.where("icao24 is not null and seg_start_time is not null").join(routes.select("icao24", "seg_start_time", *places), ["icao24", "seg_start_time"], "left")
    order = [C("seg_start_time"), C("seg_end_time")]
    rows = sequences.with_previous(rows, ["icao24"], order, ["seg_end_time", "last_lat", "last_lon", "last_on_ground", "last_alt_m"])
    gap = seconds_between(C("prev_seg_end_time"), C("seg_start_time"))
    speed = haversine(C("prev_last_lat"), C("prev_last_lon"), C("first_lat"), C("first_lon")) / F.when(gap > 0, gap / 3600.0)
    high = F.greatest(F.coalesce("prev_last_alt_m", F.lit(0.0)), F.coalesce("first_alt_m", F.lit(0.0)))
    low = F.least(F.coalesce("prev_last_alt_m", F.lit(99999.0)), F.coalesce("first_alt_m", F.lit(99999.0)))
    arms = [
        gap <= 0, F.coalesce("prev_last_on_ground", F.lit(True)) | C("first_on_ground"),
        (gap >= cfg.chain_stop_gap_h * 3600) & (high >= cfg.chain_stop_alt_m) & (speed < cfg.chain_stop_speed_kmh),
        (gap >= cfg.chain_low_fix_gap_min * 60) & (low < cfg.chain_low_fix_alt_m), ~speed.between(*cfg.chain_speed_kmh),
    ]
    breaks = F.lit(False)
    for a in arms:
        breaks = breaks | F.coalesce(a, F.lit(False))
    chained = sequences.break_sessions(rows, ["icao24"], order, breaks, "chain_seq")
    key = ["icao24", "chain_seq"]
    first, last = (F.struct(*[C(c) for c in places if c.startswith(p)]) for p in ("origin", "dest"))
    chains = chained.groupBy(*key).agg(
        F.min("seg_start_time").alias("chain_start"), F.max("seg_end_time").alias("chain_end"), F.count("*").alias("num_segments"), F.sum("num_fixes").alias("num_fixes"),
        (F.count_distinct("callsign") <= 1).alias("callsign_consistent"), F.min_by(first, "seg_start_time").alias("_o"), F.max_by(last, "seg_end_time").alias("_d"),
    )
    weights = chained.where("callsign is not null").groupBy(*key, "callsign").agg(F.sum("num_fixes").alias("_n"), F.min("seg_start_time").alias("_t"))
    named = weights.groupBy(*key).agg(F.min_by("callsign", F.struct(-C("_n"), C("_t"), C("callsign"))).alias("callsign"))
    return chains.join(named, key, "left").select("icao24", "callsign", "chain_start", "chain_end", "num_segments", "num_fixes", "callsign_consistent", "_o.*", "_d.*")


def int_swim_flight(messages: DataFrame, airports: DataFrame, states: DataFrame, adsb: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """The latest amendment of each filed flight, with the airframe that most sightings of its callsign point to; a lead of one or less is ambiguous."""
    key = F.coalesce("gufi", "flight_ref", F.concat("acid", F.lit("|"), F.coalesce("computer_id", F.lit("")), F.lit("|"), F.to_date("filed_departure_time").cast("string")))
    fields = ["dep_point", "dep_point_kind", "arr_point", "arr_point_kind", "filed_departure_time", "filed_arrival_time", "acid"]
    latest = messages.where(scalars.blank_null(C("acid")).isNotNull()).groupBy(key.alias("flight_key")).agg(F.max_by(F.struct(*fields), F.struct("msg_timestamp", "_dedup_fp")).alias("_m")).select("flight_key", "_m.*")
    codes = airports.where("iata <> ''").groupBy("iata").agg(F.min("icao").alias("_icao"))
    flat = latest
    for point, out in (("dep_point", "origin_icao"), ("arr_point", "dest_icao")):
        flat = flat.join(codes.select(C("iata").alias("_lid"), C("_icao").alias(f"_{out}")), (F.length(point) == 3) & (C(point) == C("_lid")), "left").drop("_lid").withColumn(out, F.coalesce(f"_{out}", point))
    flat = flat.select("flight_key", "origin_icao", "dep_point_kind", "dest_icao", "arr_point_kind", C("filed_departure_time").alias("win_start"), F.coalesce("filed_arrival_time", C("filed_departure_time") + F.make_dt_interval(F.lit(0), F.lit(cfg.swim_max_flight_hours))).alias("win_end"), F.upper(F.trim("acid")).alias("callsign"))
    plain = lambda c: F.upper(F.trim(c))
    obs = states.where(scalars.blank_null(C("callsign")).isNotNull() & C("icao24").isNotNull()).select(F.lit("os").alias("lane"), plain("callsign").alias("callsign"), C("icao24").alias("hex"), epoch_seconds(C("snapshot_time")).alias("epoch"))
    obs = obs.unionByName(adsb.where(scalars.blank_null(C("flight")).isNotNull() & C("hex").isNotNull()).select(F.lit("adsb").alias("lane"), plain("flight").alias("callsign"), "hex", C("capture_ts").alias("epoch")))
    pad = cfg.backfill_window_s
    inside = C("epoch").between(F.unix_seconds("win_start") - pad, F.unix_seconds("win_end") + pad)
    scored = flat.join(obs, "callsign").where(inside).groupBy("flight_key", "hex").agg(F.count_distinct(F.struct("lane", "epoch")).alias("score"))
    w = Window.partitionBy("flight_key").orderBy(C("score").desc(), C("hex"))
    best = scored.withColumn("_second", F.lead("score").over(w)).withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    close = F.coalesce(C("score") - C("_second") <= 1, F.lit(False))
    resolved = best.select("flight_key", F.when(~close, C("hex")).alias("icao24"), C("score").alias("hex_score"), close.cast("int").alias("hex_ambiguous"))
    return flat.join(resolved, "flight_key", "left").select("flight_key", "icao24", "win_start", "win_end", "callsign", "origin_icao", "dest_icao", "dep_point_kind", "arr_point_kind", F.coalesce("hex_score", F.lit(0)).alias("hex_score"), F.coalesce("hex_ambiguous", F.lit(0)).alias("hex_ambiguous"))


def int_swim_diagnostics(flights: DataFrame) -> DataFrame:
    kinds = [(F.count_if(test).alias(f"{p}_{name}")) for p in ("dep", "arr") for name, test in (("airport", C(f"{p}_point_kind") == "airport"), ("non_airport", C(f"{p}_point_kind") != "airport"), ("kind_unknown", C(f"{p}_point_kind").isNull()))]
    return flights.agg(F.count("*").alias("flights"), F.count("icao24").alias("hex_resolved"), F.count_if(C("hex_ambiguous") == 1).alias("hex_ambiguous"), *kinds)


def _in_box(airports: DataFrame, cfg: Config) -> DataFrame:
    return airports.where(scalars.in_box(C("lat"), C("lon"), cfg.box)).select(C("icao").alias("_box")).distinct()


def int_swim_opinion(flights: DataFrame, airports: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    ok = flights.where("icao24 is not null and hex_ambiguous = 0 and (origin_icao is not null or dest_icao is not null)")
    box = _in_box(airports, cfg)
    seen = ok.join(box, C("origin_icao") == C("_box"), "left").withColumnRenamed("_box", "_o").join(box, C("dest_icao") == C("_box"), "left")
    return seen.where("_o is not null or _box is not null").select(F.lit("swim").alias("source"), "icao24", "win_start", "win_end", "callsign", "origin_icao", "dest_icao")


def stg_vrs_routes(routes: DataFrame | None, airports: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """Legs of scheduled routes that touch the box, for the first spelling of each normalised callsign."""
    if routes is None:
        return airports.sparkSession.createDataFrame([], "callsign string, callsign_norm string, leg_idx int, origin_icao string, dest_icao string, n_box_legs long")
    latest = dedup.latest_per_key(routes, ["callsign"], "ingested_at").where("callsign <> ''")
    hops = latest.select(F.upper(F.trim("callsign")).alias("callsign"), scalars.callsign_norm(C("callsign")).alias("callsign_norm"), F.split("airport_codes", "-").alias("h")).where(F.size("h") > 1)
    legs = hops.select("callsign", "callsign_norm", F.posexplode(F.arrays_zip(F.slice("h", 1, F.size("h") - 1).alias("o"), F.slice("h", 2, F.size("h") - 1).alias("d"))).alias("i", "leg")).select("callsign", "callsign_norm", (C("i") + 1).alias("leg_idx"), C("leg.o").alias("origin_icao"), C("leg.d").alias("dest_icao"))
    known = airports.select(C("icao").alias("_k"), F.coalesce(scalars.in_box(C("lat"), C("lon"), cfg.box), F.lit(False)).alias("_in"))
    gated = legs.where("origin_icao <> dest_icao").join(known, C("origin_icao") == C("_k")).drop("_k").withColumnRenamed("_in", "_oin").join(known, C("dest_icao") == C("_k")).where("_oin or _in")
    first = F.min("callsign").over(Window.partitionBy("callsign_norm"))
    picked = gated.withColumn("_first", first).where("callsign = _first")
    one = picked.groupBy("callsign_norm", "origin_icao", "dest_icao").agg(F.min("callsign").alias("callsign"), F.min("leg_idx").alias("leg_idx"))
    return one.withColumn("n_box_legs", F.count("*").over(Window.partitionBy("callsign_norm"))).select("callsign", "callsign_norm", "leg_idx", "origin_icao", "dest_icao", "n_box_legs")
