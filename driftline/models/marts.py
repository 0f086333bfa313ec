"""Gold marts over reconciled flights, states and estimates. The day of a mart is stated where it is made: UTC or Japan's."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CONFIG, Config
from ..functions import scalars
from ..functions.times import seconds_between, zone_day
from ..operators import aggs, dedup
from .silver import with_country

C = F.col


def fct_flight_legs(legs: DataFrame, aircraft: DataFrame, airlines: DataFrame, adsb_states: DataFrame, ranges: DataFrame) -> DataFrame:
    heard = adsb_states.groupBy(C("hex").alias("_hex")).agg(F.max("is_military").alias("_mil"))
    j = legs.withColumn("callsign", F.trim("callsign")).withColumn("_airline", F.when(scalars.airline_shaped(C("callsign")), F.substring("callsign", 1, 3)))
    j = j.join(aircraft.select(C("icao24").alias("_k"), "registration", "typecode"), F.lower("icao24") == C("_k"), "left").join(airlines.select(C("icao").alias("_airline"), C("name").alias("airline_name"), C("country").alias("airline_country")), "_airline", "left").join(heard, F.lower("icao24") == C("_hex"), "left")
    snap = lambda test: F.when(test, "snap")
    o, d = C("origin_icao").isNotNull(), C("dest_icao").isNotNull()
    out = j.select(
        "icao24", "leg_id", "callsign", "start_time", "end_time", F.floor(seconds_between(C("start_time"), C("end_time")) / 60).alias("duration_min"), "num_fixes", "first_lat", "first_lon", "first_alt_m", "last_lat", "last_lon", "last_alt_m",
        *[f"{p}_{c}" for p in ("origin", "dest") for c in ("icao", "name", "lat", "lon")], snap(o).alias("origin_source"), snap(d).alias("dest_source"), "registration", "typecode", "airline_name", "airline_country",
        F.coalesce("_mil", F.lit(False)).alias("is_military"), C("_hex").isNotNull().alias("crossed_antenna"), F.when(o & d, F.concat("origin_icao", F.lit("-"), "dest_icao")).alias("route_inferred"), snap(o | d).alias("route_source"),
    )
    return with_country(out, "icao24", ranges, "reg_country")


def agg_airport_daily(flights: DataFrame) -> DataFrame:
    """Movements at Japanese airports by the day in Japan."""
    moves = F.explode(F.array(F.struct(C("origin_icao").alias("airport_icao"), F.lit("departure").alias("direction"), C("start_time").alias("_t")), F.struct(C("dest_icao").alias("airport_icao"), F.lit("arrival").alias("direction"), C("end_time").alias("_t"))))
    m = flights.select("icao24", moves.alias("_m")).select("icao24", "_m.*").where("airport_icao rlike '^(RJ|RO)' and _t is not null")
    return m.groupBy("airport_icao", "direction", zone_day(C("_t"), "Asia/Tokyo").alias("traffic_day")).agg(F.count("*").alias("flights"), F.count_distinct("icao24").alias("unique_aircraft"))


def agg_country_traffic(stg_states: DataFrame) -> DataFrame:
    """What flew in the last five minutes of the data, by country."""
    newest = stg_states.agg(F.max("snapshot_time").alias("_m"))
    recent = stg_states.crossJoin(F.broadcast(newest)).where(C("snapshot_time") >= C("_m") - F.expr("INTERVAL 5 MINUTES")).where("on_ground = false and latitude is not null and longitude is not null")  # one row
    now = dedup.latest_per_key(recent.select("icao24", "snapshot_time", "origin_country", "velocity_mps", "baro_altitude_m"), ["icao24"], "snapshot_time")
    return now.groupBy("origin_country").agg(F.count("*").alias("airborne_aircraft"), F.avg(C("velocity_mps") * 3.6).cast("decimal(10,2)").alias("avg_speed_kmh"), F.avg("baro_altitude_m").cast("decimal(10,2)").alias("avg_altitude_m"), F.max("snapshot_time").alias("snapshot_ts"))


def agg_operator_traffic(flights: DataFrame, aircraft: DataFrame) -> DataFrame:
    j = flights.join(aircraft.select(C("icao24").alias("_k"), "operator"), F.lower("icao24") == C("_k"), "left")
    named = j.select("icao24", "start_time", F.trim(F.coalesce(F.nullif("operator", F.lit("")), "airline_name")).alias("operator_name")).where("operator_name <> ''")
    return named.groupBy("operator_name").agg(F.count("*").alias("flight_count"), F.count_distinct("icao24").alias("distinct_aircraft"), F.max("start_time").alias("last_flight"))


def agg_route_traffic(flights: DataFrame) -> DataFrame:
    ends = [f"{p}_{c}" for p in ("origin", "dest") for c in ("icao", "name", "lat", "lon")]
    return flights.where("origin_icao <> dest_icao").groupBy(F.concat("origin_icao", F.lit("-"), "dest_icao").alias("route_inferred"), *ends).agg(F.count("*").alias("flight_count"), F.count_distinct("icao24").alias("distinct_aircraft"), F.max("end_time").alias("last_seen"))


def longest_flights(flights: DataFrame, aircraft: DataFrame) -> DataFrame:
    """The ten longest flights between two airports of each UTC day, a day long at most. Ties go to the earlier start, then to the airframe."""
    s = seconds_between(C("start_time"), C("end_time"))
    j = flights.where("origin_icao <> dest_icao").where(s.between(1, 86400)).join(aircraft.select(C("icao24").alias("_k"), "operator", "model"), F.lower("icao24") == C("_k"), "left")
    rows = j.select(F.to_date("start_time").alias("flight_day"), "callsign", "icao24", "registration", "operator", "model", "origin_icao", "origin_city", "dest_icao", "dest_city", C("start_time").alias("first_seen"), s.alias("flight_duration_seconds"))
    return dedup.top_per_key(rows, ["flight_day"], [C("flight_duration_seconds").desc(), C("first_seen"), C("icao24"), C("callsign").asc_nulls_last()], 10, "day_rank")


def anomalies(stg_states: DataFrame) -> DataFrame:
    arms = [
        (C("baro_altitude_m") > 15000, "altitude_too_high"), (C("baro_altitude_m") < -500, "altitude_below_sea_level"), (C("velocity_mps") > 350, "velocity_too_high"), (C("velocity_mps") < 0, "negative_velocity"),
        (~C("latitude").between(-90, 90), "invalid_latitude"), (~C("longitude").between(-180, 180), "invalid_longitude"),
    ]
    keep = ["icao24", "callsign", "origin_country", "snapshot_time", "latitude", "longitude", "baro_altitude_m", "velocity_mps"]
    return stg_states.select(*keep, scalars.first_match(*arms).alias("anomaly_type")).where("anomaly_type is not null")


def agg_est_usage_daily(estimates: DataFrame) -> DataFrame:
    """Requests by UTC day, producer and arm; the first segment is a request's head."""
    one = estimates.where("producer <> 'test'").groupBy("estimate_id").agg(
        F.to_date(F.min("computed_at")).alias("day"), F.min("producer").alias("producer"), F.min("flight_id").alias("_f"), F.max("input_provisional").alias("_p"), F.min("subject_key").alias("subject_key"), F.count_if(C("seg_idx") > 0).alias("segments")
    )
    arm = F.when(C("_f").isNull(), "live").when(C("_p") == 1, "provisional").otherwise("settled")
    return one.groupBy("day", "producer", arm.alias("arm")).agg(F.count("*").alias("requests"), F.count_if(C("segments") > 0).alias("served"), F.count_if(C("segments") == 0).alias("all_skipped"), F.sum("segments").alias("segments"), F.count_distinct("subject_key").alias("subjects"))


def agg_est_breakdown_daily(estimates: DataFrame) -> DataFrame:
    """Long counts by UTC day: skips of heads, kinds and uncertainty bins of segments."""
    e = estimates.where("producer <> 'test'").withColumn("day", F.to_date("computed_at"))
    item = lambda d, v: F.struct(F.lit(d).alias("dimension"), v.alias("value"))
    skips = F.transform("skips", lambda s: item("skip", F.concat(s["kind"], F.lit(":"), s["reason"])))
    own = F.array(item("segment_kind", C("kind")), item("uncertainty_bin", C("uncertainty_bin")))
    items = F.when(C("seg_idx") == 0, F.coalesce(skips, F.array().cast("array<struct<dimension:string,value:string>>"))).otherwise(own)
    return e.select("day", "producer", F.explode(items).alias("_i")).groupBy("day", "producer", "_i.dimension", "_i.value").agg(F.count("*").alias("n"))


# Self-maintaining aggregates: states per hour and key, merged on read.


def hourly_traffic_state(states: DataFrame) -> DataFrame:
    """State of distinct airframes and their largest speed per hour, immune to rows that come again."""
    rows = states.where("icao24 is not null and latitude is not null and longitude is not null")
    return aggs.partials(rows, [], F.date_trunc("hour", "snapshot_time"), "icao24", C("velocity"))


def hourly_traffic(state: DataFrame) -> DataFrame:
    return aggs.merge_partials(state, ["bucket"], "icao24") if "bucket" not in state.columns else state.groupBy("bucket", "icao24").agg(F.max("value").alias("value")).groupBy(C("bucket").alias("hour")).agg(F.count("*").alias("aircraft"), F.avg("value").alias("avg_velocity"))


def airline_traffic_state(rows: DataFrame, airlines: DataFrame, callsign: str, member: str, ts) -> DataFrame:
    """State of distinct airframes by airline and hour, of airline-shaped callsigns of known airlines."""
    code = F.when(scalars.airline_shaped(C(callsign)), F.substring(F.trim(callsign), 1, 3))
    named = rows.withColumn("_code", code).join(airlines.select(C("icao").alias("_code"), C("name").alias("airline_name")), "_code")
    return aggs.partials(named, ["airline_name"], F.date_trunc("hour", ts), member)


def country_traffic_state(adsb: DataFrame, ranges: DataFrame, ts) -> DataFrame:
    """State of distinct airframes by country of their address and whether they are military; addresses outside all ranges have none."""
    named = with_country(adsb.withColumn("hex", F.lower("hex")), "hex", ranges, "reg_country").where("reg_country is not null").withColumn("is_military", scalars.bit_flag(C("db_flags"), 1))
    return aggs.partials(named, ["reg_country", "is_military"], F.date_trunc("hour", ts), "hex")


def distinct_members(state: DataFrame, keys: list[str], member: str, as_of=None, days: int = 90) -> DataFrame:
    """Exact distinct members over the hours of a state, of the last ``days`` where a time is given."""
    if as_of is not None:
        state = state.where(C("bucket") >= F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days)))
    return state.groupBy(*keys).agg(F.count_distinct(member).alias("aircraft"), F.max("bucket").alias("last_hour"))
