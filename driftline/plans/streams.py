"""Streaming operators over a replay of the events table, drained to its end, each with the batch SQL that says the same; and the estimator over trajectories made of events."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..models import estimate
from ..streaming import live

C = F.col
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder that driver and executors share."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or "file:///tmp/checkpoints"
    return f"{at.rstrip('/')}/driftline/{name}-{uuid.uuid4().hex}"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a pattern, which may match a file as well as a folder
    return live.file_stream(spark, f"{sf_dir}/events.parque[t]", EVENTS).withColumn("ts", C("ts").cast("timestamp"))


def _drained(df: DataFrame, name: str, mode: str) -> DataFrame:
    """The result as a table: a batch of it, as large as the result, is written for each trigger, the last of which counts in complete mode."""
    spark = df.sparkSession
    out = _scratch(spark, name)

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out if mode == "complete" else f"{out}/batch={batch_id}")

    live.drain(df, _scratch(spark, f"{name}-checkpoint"), each=put, mode=mode)
    return spark.read.parquet(out).select(*df.columns)


def streaming_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drained(live.counts(_events(spark, sf_dir), {"type": C("event_type"), "hour": F.hour("ts")}), "counts", "complete")


def streaming_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = live.windowed_counts(_events(spark, sf_dir), "ts", "6 hours", "3 hours", "1 hour", ["event_type"])
    got = _drained(w, "windows", "complete")
    return got.select(C("start").cast("timestamp_ntz").alias("start"), C("end").cast("timestamp_ntz").alias("end"), "event_type", "n")


def streaming_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest event of each user, kept by upserts."""
    out = _scratch(spark, "latest")
    stream = _events(spark, sf_dir).select("user_id", "ts", "event_id", "event_type")
    live.drain(stream, _scratch(spark, "latest-checkpoint"), each=live.upsert_latest(out, ["user_id"], "ts", ["event_id"]))
    return live.current_generation(spark, out, stream.schema).select("user_id", C("ts").cast("timestamp_ntz").alias("ts"), "event_id", "event_type")


def streaming_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct users by event type of mergeable hourly states."""
    out = _scratch(spark, "partials")
    live.drain(_events(spark, sf_dir), _scratch(spark, "partials-checkpoint"), each=live.append_partials(out, ["event_type"], F.date_trunc("hour", "ts"), "user_id", C("value")))
    return live.merged_partials(spark, out, ["event_type"], "user_id").select("event_type", "members", F.round("avg_value", 6).alias("avg_value"))


def streaming_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each (user, hour) once, whatever comes again."""
    keyed = _events(spark, sf_dir).select("user_id", F.date_trunc("hour", "ts").alias("hour"))
    return _drained(live.without_replays(keyed, "hour", ["user_id", "hour"], "365 days"), "replays", "append").select("user_id", C("hour").cast("timestamp_ntz").alias("hour"))


def estimator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments over paths along the equator, a flight per user and day, with holes where no event was."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.xxhash64("user_id", F.to_date("ts")).alias("flight_id"), C("ts").cast("timestamp").alias("ts"), "value")
    t = F.unix_seconds("ts") % 86400
    path = e.select("flight_id", "ts", (C("value") / 1000).alias("lat"), (t * 400 / 3600 / 60 - 80).alias("lon"), F.lit(30000.0).alias("alt_ft"), F.lit(False).alias("on_ground"), F.lit(400.0).alias("gs_kt"), F.lit(90.0).alias("track_deg"))
    ends = path.select("flight_id").distinct().select("flight_id", F.lit(0.0).alias("origin_lat"), F.lit(-90.0).alias("origin_lon"), F.lit(0.0).alias("dest_lat"), F.lit(100.0).alias("dest_lon"))
    return estimate.estimates(path, ends, columns=["flight_id", "seg_idx", "kind", "n_points", "uncertainty_bin", "capped"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (streaming_counts, streaming_windows, streaming_latest, streaming_partials, streaming_replays, estimator)}
ORACLE_SQL = {
    "streaming_counts": "SELECT 'type' AS dim, event_type AS val, count(*) AS n FROM events GROUP BY ALL UNION ALL SELECT 'hour', hour(ts)::VARCHAR, count(*) FROM events GROUP BY ALL",
    "streaming_windows": """WITH s AS (SELECT event_type, time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '2000-01-01') AS b FROM events), w AS (SELECT event_type, b AS start FROM s UNION ALL SELECT event_type, b - INTERVAL 3 HOUR FROM s)
        SELECT start, start + INTERVAL 6 HOUR AS "end", event_type, count(*) AS n FROM w GROUP BY ALL""",
    "streaming_latest": "SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id",
    "streaming_partials": "WITH h AS (SELECT event_type, date_trunc('hour', ts) AS b, user_id, max(value) AS v FROM events GROUP BY ALL) SELECT event_type, count(DISTINCT user_id) AS members, round(avg(v), 6) AS avg_value FROM h GROUP BY event_type",
    "streaming_replays": "SELECT DISTINCT user_id, date_trunc('hour', ts) AS hour FROM events",
}
