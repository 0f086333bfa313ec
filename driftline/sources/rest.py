"""Responses of the state and flight services, landed as documents, to typed rows. Fetching is not done here: a document comes with what was asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The positions of a state vector and their types; ``sensors`` is not kept.
STATE_FIELDS = [
    ("icao24", "string"), ("callsign", "string"), ("origin_country", "string"), ("time_position", "long"), ("last_contact", "long"), ("longitude", "double"), ("latitude", "double"), ("baro_altitude", "double"), ("on_ground", "boolean"), ("velocity", "double"),
    ("true_track", "double"), ("vertical_rate", "double"), ("sensors", None), ("geo_altitude", "double"), ("squawk", "string"), ("spi", "boolean"), ("position_source", "int"),
]
#: Fields of a flight summary and their names here.
FLIGHT_FIELDS = {"icao24": ("icao24", "string"), "callsign": ("callsign", "string"), "firstSeen": ("first_seen", "long"), "lastSeen": ("last_seen", "long"), "estDepartureAirport": ("est_departure_airport", "string"), "estArrivalAirport": ("est_arrival_airport", "string")}


def states(documents: DataFrame) -> DataFrame:
    """Rows of state vectors of documents (body, region, ingested_at): ``{"time": seconds, "states": [[...], ...]}``. A document without states, or that is no JSON, has no row; times are in seconds since the epoch."""
    parsed = documents.select(F.from_json("body", "time long, states array<array<string>>").alias("d"), "region", "ingested_at")
    each = parsed.select(F.col("d.time").alias("snapshot_time"), F.explode("d.states").alias("s"), "region", "ingested_at")
    columns = [F.get("s", F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(STATE_FIELDS) if kind]
    return each.select(*columns, "snapshot_time", "region", "ingested_at")


def flights(documents: DataFrame) -> DataFrame:
    """Rows of flight summaries of documents (status, body, airport, direction, window_kind): a JSON list. A status of 404 means none; summaries without ``firstSeen`` are left out."""
    schema = "array<struct<" + ", ".join(f"{k}: {kind}" for k, (_, kind) in FLIGHT_FIELDS.items()) + ">>"
    parsed = documents.where("status <> 404").select(F.explode(F.from_json("body", schema)).alias("f"), "airport", "direction", "window_kind")
    columns = [F.col(f"f.{k}").alias(name) for k, (name, _) in FLIGHT_FIELDS.items()]
    return parsed.select(*columns, F.col("airport").alias("captured_for_airport"), "direction", "window_kind").where("first_seen is not null")


def flight_windows(end: int, days: int = 86400) -> list[tuple[str, str, int, int]]:
    """(direction, kind, begin, end) to ask for at a time: what has settled two days ago, and the departures of the last day; none is longer than the service allows (two days)."""
    settled = (end - 3 * days, end - 2 * days)
    return [("arrival", "d2", *settled), ("departure", "d2", *settled), ("departure", "d0", end - days, end)]
