"""Bundles in a landing area: a manifest, its data file and sidecars. What is whole is found by joins of manifests with the names that are there."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import ContractError

MANIFEST = "stream string, filename string, complete boolean, process_uuid string, process_start_ts string"


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path) of all files below a folder; their content is not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")


def manifests(spark: SparkSession, path: str, suffix: str = ".manifest.json") -> DataFrame:
    """(manifest_path, and the fields of ``MANIFEST``); what is no JSON has null fields."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(path)
    return files.select(F.col("path").alias("manifest_path"), F.from_json(F.col("content").cast("string"), MANIFEST).alias("m")).select("manifest_path", "m.*")


def bundles(found: DataFrame, names: DataFrame, prefixes: Mapping[str, str], sidecars: Mapping[str, tuple[str, Sequence[str]]] | None = None) -> DataFrame:
    """(stream, filename, data_path, manifest_path, complete) of whole bundles: of a known stream, the data file and all its sidecars there, no file that is still written.

    Bundles that are not complete count once their writer is known to be gone: an other process, started later, has completed one of the stream. ``prefixes``: where the manifests of some streams must lie,
    and no others; a stray one raises. ``sidecars``: stream -> (suffix of the data file, suffixes that stand in its place).
    """
    owner: Column = F.lit(None).cast("string")
    for stream, prefix in prefixes.items():
        if prefix:
            owner = F.when(F.contains("manifest_path", F.lit(f"/{prefix.strip('/')}/")), F.lit(stream)).otherwise(owner)
    homes = [s for s, p in prefixes.items() if p]
    strayed = found.withColumn("_owner", owner).where((F.col("stream").isin(*homes) | F.col("_owner").isNotNull()) & ~F.col("_owner").eqNullSafe(F.col("stream")) & F.col("stream").isNotNull())
    if stray := strayed.select("manifest_path", "stream").first():
        raise ContractError(f"{stray[0]}: a manifest of {stray[1]} does not belong there")
    folder = F.regexp_replace("manifest_path", "/[^/]*$", "")
    known = found.where(F.col("stream").isin(*prefixes) & (F.col("filename") != "") & ~F.endswith("filename", F.lit(".inprogress"))).withColumn("data_path", F.concat(folder, F.lit("/"), "filename"))
    needed = F.array(F.col("data_path"))
    for stream, (suffix, others) in (sidecars or {}).items():
        stem = F.substring("data_path", F.lit(1), F.length("data_path") - len(suffix))
        needed = F.when(F.col("stream") == stream, F.concat(needed, F.array(*[F.concat(stem, F.lit(x)) for x in others]))).otherwise(needed)
    asked = known.withColumn("_need", needed).select("manifest_path", F.explode("_need").alias("path"))
    missing = asked.join(names, "path", "left_anti").select("manifest_path").distinct()
    whole = known.join(missing, "manifest_path", "left_anti")
    start = F.try_to_timestamp("process_start_ts")
    done = whole.where("complete")
    done_by = done.where("process_uuid <> ''").select(F.col("stream").alias("_s"), F.col("process_uuid").alias("_u"), start.alias("_t")).where("_t is not null").groupBy("_s", "_u").agg(F.max("_t").alias("_t"))
    part = whole.where("not coalesce(complete, false) and process_uuid <> ''").withColumn("_start", start)
    later = (F.col("stream") == F.col("_s")) & (F.col("process_uuid") != F.col("_u")) & (F.col("_t") > F.col("_start"))
    gone = part.join(done_by, later, "left_semi")
    keep = ["stream", "filename", "data_path", "manifest_path"]
    return done.select(*keep, F.lit(True).alias("complete")).unionByName(gone.select(*keep, F.lit(False).alias("complete")))


def footer_rows(spark: SparkSession, path: str) -> int:
    """Rows of Parquet files, from their footers: no column is read."""
    return spark.read.parquet(path).select(F.lit(1)).count()


def ingest_summary(results: Sequence[Mapping | BaseException]) -> dict[str, int]:
    """attempted, succeeded, with_data of a run's mapped fetches; raises only if there were some and all failed."""
    good = [r for r in results if not isinstance(r, BaseException)]
    if results and not good:
        raise RuntimeError(f"all {len(results)} fetches failed")
    return {"attempted": len(results), "succeeded": len(good), "with_data": sum(bool(r.get("rows")) for r in good)}


def stale(manifest: DataFrame, end: str, now, limit_s: int = 7200) -> DataFrame:
    """(newest, age_s, stale): whether the newest rotation has ended too long ago; an empty ledger is stale."""
    newest = manifest.agg(F.max(F.col(end).cast("timestamp")).alias("newest"))
    age = F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds("newest")
    return newest.select("newest", age.alias("age_s"), F.coalesce(age > limit_s, F.lit(True)).alias("stale"))
