"""Live views over streams: latest row per key with expiry, counts, trails, incremental partials, replay-safe sinks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators import aggs, dedup


def file_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).load(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """Raw bytes and the broker's time; nothing is parsed at this point. Needs Spark's Kafka connector on the class path."""
    return spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", starting).load().select("value", "timestamp")


def decode_json(raw: DataFrame, schema: StructType | str, value: str = "value") -> DataFrame:
    """Late decoding: fields of the bytes' JSON beside the broker's time; malformed messages give nulls."""
    return raw.select(F.from_json(F.col(value).cast("string"), schema, {"mode": "PERMISSIVE"}).alias("_j"), *[c for c in raw.columns if c != value]).select("_j.*", *[c for c in raw.columns if c != value])


def alive(rows: DataFrame, ts: str, as_of, seconds: int) -> DataFrame:
    """What a view shows at a time: rows not older than ``seconds``. Reading filters, so rows leave without new input."""
    at = F.lit(as_of).cast(rows.schema[ts].dataType)
    return rows.where(F.col(ts) > at - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds)))


class LatestWithExpiry(StatefulProcessor):
    """The latest row of a key (ties to the larger content), emitted when it changes, and once more, with ``expired``, when ``ttl_ms`` of processing time pass without one."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("latest", StructType([StructField("ts", LongType()), StructField("row", StringType())]))

    def handleInputRows(self, key, rows, timerValues):
        best = tuple(self.state.get()) if self.state.exists() else None
        before = best
        for pdf in rows:
            for ts, row in zip(pdf["ts"], pdf["row"], strict=True):
                if best is None or (int(ts), row) > best:
                    best = (int(ts), row)
        if best != before:
            self.state.update(best)
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.ttl_ms)
            yield pd.DataFrame({"key": [key[0]], "ts": [best[0]], "row": [best[1]], "expired": [False]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.state.exists():
            ts, row = self.state.get()
            self.state.clear()
            yield pd.DataFrame({"key": [key[0]], "ts": [ts], "row": [row], "expired": [True]})

    def close(self) -> None:
        pass


def latest_with_expiry(stream: DataFrame, key: str, ts: str, ttl_s: int) -> DataFrame:
    """(key, ts in microseconds, row as JSON, expired): changes of the latest row per key. Needs the RocksDB state store."""
    rows = stream.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("key"), F.unix_micros(F.col(ts).cast("timestamp")).alias("ts"), F.to_json(F.struct(*stream.columns)).alias("row"))
    return rows.groupBy("key").transformWithStateInPandas(LatestWithExpiry(ttl_s * 1000), outputStructType="key string, ts long, row string, expired boolean", outputMode="Update", timeMode="ProcessingTime")


def upsert_latest(path: str, keys: Sequence[str], version: str, ties: Sequence[str] = (), expire_s: int | None = None, then: Callable[[DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that keeps the latest row per key as generations of a table: reads the last one, merges the batch, writes the next. Replays change nothing."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        held = [int(s.getPath().getName().removeprefix("gen=")) for s in fs.listStatus(fs_path) if s.getPath().getName().startswith("gen=")] if fs.exists(fs_path) else []
        rows = batch
        # a replayed batch finds its own generation and builds it again from the one before
        base = max((g for g in held if g < batch_id), default=-1)
        if base >= 0:
            rows = spark.read.schema(batch.schema).parquet(f"{path}/gen={base}").unionByName(batch)
        merged = dedup.latest_per_key(rows, keys, version, ties)
        if expire_s is not None:
            newest = merged.agg(F.max(version).alias("_m"))
            merged = merged.crossJoin(F.broadcast(newest)).where(F.unix_seconds(F.col(version).cast("timestamp")) > F.unix_seconds(F.col("_m").cast("timestamp")) - expire_s).drop("_m")
        merged.write.mode("overwrite").parquet(f"{path}/gen={batch_id}")
        if then:
            then(spark.read.schema(batch.schema).parquet(f"{path}/gen={batch_id}"), batch_id)
        for g in (g for g in held if g < base):  # the one superseded last
            fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/gen={g}"), True)

    return run


def enriched(stream: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """A stream with the columns of static tables: ``dims`` is column of the stream -> (table, its key). Each batch reads the tables as they are then; rows without a match keep nulls, keys of a table should be unique."""
    out = stream
    for column, (table, key) in dims.items():
        rest = [c for c in table.columns if c != key]
        out = out.join(table.select(F.col(key).alias(f"_{column}"), *rest), F.col(column) == F.col(f"_{column}"), "left").drop(f"_{column}")
    return out


def versioned(root: str, name: str, schema: StructType, logic: int) -> str:
    """Where a query keeps its checkpoint and state: a folder of its own for each schema and version of its logic, so a changed query starts anew beside the old one instead of failing on its state."""
    return f"{root}/{name}/v{logic}-{hashlib.sha256(schema.json().encode()).hexdigest()[:12]}"


def current_generation(spark: SparkSession, path: str, schema) -> DataFrame:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    last = max(int(s.getPath().getName().removeprefix("gen=")) for s in fs.listStatus(p) if s.getPath().getName().startswith("gen="))
    return spark.read.schema(schema).parquet(f"{path}/gen={last}")


def append_partials(path: str, keys: Sequence[str], bucket: Column, member: str, value: Column | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink of mergeable hourly states, a folder per batch: a replay overwrites its own."""

    def run(batch: DataFrame, batch_id: int) -> None:
        aggs.partials(batch, keys, bucket, member, value).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return run


def merged_partials(spark: SparkSession, path: str, keys: Sequence[str], member: str) -> DataFrame:
    return aggs.merge_partials(spark.read.parquet(path), keys, member)


def counts(stream: DataFrame, dims: Mapping[str, Column]) -> DataFrame:
    """Long (dim, val, n) counts of a stream, in complete mode."""
    return aggs.long_counts(stream, dims)


def windowed_counts(stream: DataFrame, ts: str, size: str, slide: str | None = None, delay: str = "0 seconds", by: Sequence[str] = ()) -> DataFrame:
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return stream.withWatermark(ts, delay).groupBy(w.alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")


def session_counts(stream: DataFrame, ts: str, gap: str, by: Sequence[str], delay: str = "0 seconds") -> DataFrame:
    return stream.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")


def without_replays(stream: DataFrame, ts: str, keys: Sequence[str], delay: str) -> DataFrame:
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, within: str, delay: str = "1 hour") -> DataFrame:
    """Pairs of two streams of one key whose times are within an interval; both sides' state is bounded by the watermarks."""
    a, b = left.withWatermark(left_ts, delay).alias("a"), right.withWatermark(right_ts, delay).alias("b")
    near = F.expr(f"b.{right_ts} BETWEEN a.{left_ts} - INTERVAL {within} AND a.{left_ts} + INTERVAL {within}")
    return a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & near)


def drain(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None] | None = None, table: str | None = None, mode: str = "append"):
    """Run a query over what is there now, to its end."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer = writer.foreachBatch(each) if each else writer.format("memory").queryName(table)
    q = writer.start()
    q.awaitTermination()
    return q
