"""Writing tables: whole, by day, by generation, by staged swap; ledgers, watermarks and retention."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def append(df: DataFrame, path: str, partition: str | None = None) -> None:
    w = df.write.mode("append")
    (w.partitionBy(partition) if partition else w).parquet(path)


def overwrite_days(df: DataFrame, path: str, day: str) -> None:
    """Replaces the days that ``df`` holds, and no others. Rows are dealt by day and a salt, so that a day is neither one task nor a file of every task."""
    salted = df.repartition(day, F.pmod(F.xxhash64(*[c for c in df.columns if c != day]), F.lit(8)))
    salted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def publish_generation(df: DataFrame, path: str, least_rows: int = 1) -> int:
    """Writes the next generation and then drops the older; too few rows are refused. Readers take the largest."""
    spark = df.sparkSession
    n = df.count()
    if n < least_rows:
        raise ValueError(f"{n} rows are too few to publish")
    old = generations(spark, path)
    gen = max(old, default=0) + 1
    df.write.parquet(f"{path}/gen={gen}")
    fs, _ = _fs(spark, path)
    for g in old:
        fs.delete(_fs(spark, f"{path}/gen={g}")[1], True)
    return gen


def generations(spark: SparkSession, path: str) -> list[int]:
    fs, p = _fs(spark, path)
    return sorted(int(s.getPath().getName()[4:]) for s in fs.listStatus(p) if s.getPath().getName().startswith("gen=")) if fs.exists(p) else []


def read_generation(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/gen={generations(spark, path)[-1]}")


def stage_and_swap(df: DataFrame, path: str) -> str:
    """Writes a version of the table and then points to it; an empty one is refused. The pointer is replaced in one step, so at any time, also after a crash, readers (``read_swapped``) see one whole version. The version
    before the last stays for readers that have begun; older ones go."""
    spark = df.sparkSession
    version = f"{path.rstrip('/')}/v={uuid.uuid4().hex}"
    df.write.parquet(version)
    fs, p = _fs(spark, version)
    if not spark.read.schema(df.schema).parquet(version).take(1):
        fs.delete(p, True)
        raise ValueError("an empty table is not swapped in")
    before = _pointed(spark, path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fresh, pointer = (jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}") for name in (f"_pointer-{uuid.uuid4().hex}", "_pointer"))
    out = fs.create(fresh)
    out.write(bytearray(version.encode()))
    out.close()
    overwrite_ = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite_[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri() if fresh.toUri().getScheme() else fs.getUri(), conf).rename(fresh, pointer, overwrite_)
    keep = {x.rsplit("/", 1)[-1] for x in (version, before or "")}
    for s in fs.listStatus(pointer.getParent()):
        if s.getPath().getName().startswith("v=") and s.getPath().getName() not in keep:
            fs.delete(s.getPath(), True)
    return version


def _pointed(spark: SparkSession, path: str) -> str | None:
    fs, pointer = _fs(spark, f"{path.rstrip('/')}/_pointer")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def read_swapped(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(_pointed(spark, path))


def replace_dedup(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """What a keep-latest table shows: replays collapse, the newest version of a key stays."""
    return dedup.latest_per_key(df, keys, version)


def expire(df: DataFrame, ts: str, as_of, months: int = 0, days: int = 0) -> DataFrame:
    return df.where(F.col(ts) >= F.lit(as_of).cast("timestamp") - F.make_ym_interval(F.lit(0), F.lit(months)) - F.make_dt_interval(F.lit(days)))


def without_superseded(df: DataFrame, keys: Sequence[str], batch: str, current) -> DataFrame:
    """Rows of re-keyed parts that an older batch left: keys that the current batch rebuilt keep only its rows."""
    rebuilt = df.where(F.col(batch) == F.lit(current)).select(*keys).distinct()
    old = df.where(F.col(batch) != F.lit(current)).join(rebuilt, list(keys), "left_anti")
    return df.where(F.col(batch) == F.lit(current)).unionByName(old.select(df.columns))


# Ledgers


def upsert_ledger(ledger: DataFrame, news: DataFrame, key: str, keep: Sequence[str], first_wins: bool = False) -> DataFrame:
    """One row per key. ``keep`` columns hold what was known unless the news has a value; with ``first_wins`` known rows stay as they are."""
    a, b = ledger.alias("a"), news.alias("b")
    known = F.col(f"a.{key}").isNotNull()
    j = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full")
    cols = []
    for c in ledger.columns:
        old, new = F.col(f"a.{c}"), F.col(f"b.{c}") if c in news.columns else F.lit(None)
        if first_wins or c == key:
            value = F.when(known, old).otherwise(new)
        elif c in keep:
            value = F.coalesce(new, old)
        else:
            value = F.when(F.col(f"b.{key}").isNotNull(), new).otherwise(old)
        cols.append(value.alias(c))
    return j.select(*cols)


def to_attempt(pairs: DataFrame, ledger: DataFrame, keys: Sequence[str], now, retry_error_s: int = 240, retry_missing_days: int = 7, most_missing: int = 2) -> DataFrame:
    """Pairs to fetch: new ones; errors after a while; missing ones once more when they have aged; landed ones never."""
    seen = ledger.select(*keys, "status", "attempts", "last_attempt")
    at = F.lit(now).cast("timestamp")
    age = F.unix_seconds(at) - F.unix_seconds("last_attempt")
    due = F.col("status").isNull() | ((F.col("status") == "error") & (age >= retry_error_s)) | ((F.col("status") == "missing") & (F.col("attempts") < most_missing) & (age >= retry_missing_days * 86400))
    return pairs.join(seen, list(keys), "left").where(due).select(pairs.columns)
