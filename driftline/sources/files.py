"""Reading landed files: pinned schemas, contracts that fail loudly, ledgers of what was read, archives of traces."""

from __future__ import annotations

import csv
import gzip
import io
import json
import tarfile
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from xml.etree import ElementTree

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


class ContractError(ValueError):
    """Input that breaks what its reader was promised."""


def parquet_tree(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """All Parquet files under a path, with a pinned schema: an empty tree has no rows, a missing column is null."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(path)


def pending(found: DataFrame, ledger: DataFrame, key: str = "path", done: Sequence[str] = ("loaded", "archived")) -> DataFrame:
    """Files that the ledger does not have as done."""
    return found.join(ledger.where(F.col("status").isin(*done)).select(key), key, "left_anti")


def read_pending(spark: SparkSession, paths: Sequence[str], schema: StructType | str) -> DataFrame:
    """A bounded list of files; those gone meanwhile are passed over and stay pending."""
    reader = spark.read.schema(schema).option("ignoreMissingFiles", True)
    return reader.parquet(*paths) if paths else spark.createDataFrame([], schema)


def union_relaxed(*frames: DataFrame) -> DataFrame:
    """By name; columns that one lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def csv_checked(spark: SparkSession, path: str, schema: StructType, least_rows: int = 1) -> DataFrame:
    """A CSV file whose header is exactly the schema's and that has enough rows."""
    header = spark.read.text(path).first()
    if header is None or next(csv.reader([header[0].lstrip("﻿")])) != schema.fieldNames():
        raise ContractError(f"header of {path}: {header and header[0]}")
    df = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    n = df.count()
    if n < least_rows:
        raise ContractError(f"{path} has {n} rows, fewer than {least_rows}")
    return df


def seed_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A seed with forced types; blank text is null."""
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return df.select(*[F.nullif(F.trim(c), F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def sniff_columns(header: Sequence[str], aliases: Mapping[str, Sequence[str]]) -> dict[str, int]:
    """Positions of the wanted columns by any of their names, case and marks aside; a column that isn't there is missing."""
    plain = ["".join(ch for ch in h.lower() if ch.isalnum()) for h in header]
    out = {}
    for want, names in aliases.items():
        for n in names:
            key = "".join(ch for ch in n.lower() if ch.isalnum())
            if key in plain:
                out[want] = plain.index(key)
                break
    return out


def csv_sniffed(spark: SparkSession, lines: Sequence[str], aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """A small headed CSV as (wanted columns: string)."""
    rows = list(csv.reader(lines))
    at = sniff_columns(rows[0], aliases) if rows else {}
    if not at:
        raise ContractError("no known column in the header")
    body = [tuple(r[at[w]].strip() or None if w in at and at[w] < len(r) else None for w in aliases) for r in rows[1:] if any(x.strip() for x in r)]
    return spark.createDataFrame(body, ", ".join(f"{w} string" for w in aliases))


def identities(lines: Sequence[str]) -> list[str]:
    """One identity for each physical line; a line that is not exactly one CSV field fails with its number. Blank lines are passed over."""
    out = []
    for n, line in enumerate(lines, 1):
        if not line.strip():
            continue
        fields = next(csv.reader([line], strict=True), [])
        if len(fields) != 1 or not fields[0].strip():
            raise ContractError(f"line {n}: {line[:60]!r}")
        out.append(fields[0].strip())
    return out


def ndjson(spark: SparkSession, path: str, schema: StructType, required: Sequence[str], most_dropped: float = 0.01) -> DataFrame:
    """Lines of JSON of a schema. Malformed lines and such without a required field are dropped; more than a share of them fails."""
    whole = StructType([*schema.fields]).add("_corrupt", "string")
    df = spark.read.schema(whole).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    bad = F.col("_corrupt").isNotNull()
    for c in required:
        bad = bad | F.col(c).isNull()
    # Spark wants corrupt records kept before they are asked for alone
    seen = df.withColumn("_bad", bad).agg(F.count("*").alias("n"), F.count_if("_bad").alias("bad"), F.count("_corrupt")).first()
    if seen.n and seen.bad > most_dropped * seen.n:
        raise ContractError(f"{seen.bad} of {seen.n} lines are malformed")
    return df.where(~bad).drop("_corrupt")


def maybe_gzip(raw: bytes) -> bytes:
    return gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw


TRACE_POINT = "icao24 string, base_ts double, i int, dt_s double, lat double, lon double, alt_ft double, ground boolean, gs_kt double, track double, flags int, rate_fpm double, callsign string, squawk string, geom_ft double"


def trace_points(doc: dict) -> list[tuple]:
    """Points of a trace document: [seconds, lat, lon, altitude or "ground", speed, track, flags, rate, details, type, geometric altitude, ...]."""
    number = lambda x: float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else None
    out = []
    for i, p in enumerate(doc.get("trace") or []):
        p = list(p) + [None] * (11 - len(p))
        more = p[8] if isinstance(p[8], dict) else {}
        call = (more.get("flight") or "").strip() or None
        out.append((doc.get("icao"), number(doc.get("timestamp")), i, number(p[0]), number(p[1]), number(p[2]), 0.0 if p[3] == "ground" else number(p[3]), p[3] == "ground", number(p[4]), number(p[5]), int(p[6] or 0), number(p[7]), call, more.get("squawk"), number(p[10])))
    return out


def _points(docs: Iterator[bytes]) -> Iterator[pd.DataFrame]:
    """A frame for each document with points."""
    names = [f.split()[0] for f in TRACE_POINT.split(", ")]
    for raw in docs:
        try:
            rows = trace_points(json.loads(maybe_gzip(raw)))
        except (ValueError, OSError, EOFError):  # a corrupt member gives no points
            continue
        if rows:
            yield pd.DataFrame(rows, columns=names).astype({"i": "int32", "flags": "int32"})


def traces(spark: SparkSession, path: str) -> DataFrame:
    """Points of trace documents, plain or gzipped JSON, a file each."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("content")
    return files.mapInPandas(lambda it: (points for pdf in it for points in _points(bytes(c) for c in pdf["content"])), TRACE_POINT)


class _Chain(io.RawIOBase):
    """Several files as one stream; each is opened when the one before has ended."""

    def __init__(self, paths: Sequence[str]):
        self.rest, self.now = list(paths), None

    def readable(self) -> bool:
        return True

    def readinto(self, room) -> int:
        while self.now is not None or self.rest:
            if self.now is None:
                fs, path = pafs.FileSystem.from_uri(self.rest[0])
                self.now, self.rest = fs.open_input_stream(path, compression=None), self.rest[1:]
            if got := self.now.read(len(room)):
                room[: len(got)] = got
                return len(got)
            self.now.close()
            self.now = None
        return 0


def traces_tar(spark: SparkSession, path: str) -> DataFrame:
    """Points of the trace documents in tar files, an archive to a task. Parts of one archive (``x.tar.aa``, ``x.tar.ab``, ...) are one stream in the order of their names. Only a member is in memory at a time;
    corrupt ones are passed over, and an archive that breaks off gives the members before."""
    names = spark.read.format("binaryFile").load(path).select("path")
    stem = F.regexp_replace("path", r"(\.tar)\.[a-z]{2}$", "$1")
    archives = names.groupBy(stem.alias("archive")).agg(F.array_sort(F.collect_list("path")).alias("parts"))

    def run(it):
        for pdf in it:
            for parts in pdf["parts"]:
                try:
                    with tarfile.open(fileobj=io.BufferedReader(_Chain(list(parts)), 1 << 20), mode="r|*") as tar:
                        for m in tar:
                            if m.isfile():
                                yield from _points(iter([tar.extractfile(m).read()]))
                except tarfile.ReadError:
                    continue

    return archives.mapInPandas(run, TRACE_POINT)


def zip_csv(raw: bytes, member: str) -> list[dict[str, str]]:
    """Rows of a CSV in a small zip, names and values stripped."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z, z.open(member) as f:
        return [{(k or "").strip(): (v or "").strip() for k, v in r.items()} for r in csv.DictReader(io.TextIOWrapper(f, "utf-8-sig"))]


def xml_messages(df: DataFrame, xml: str, message: str, attributes: Mapping[str, str], texts: Mapping[str, str]) -> DataFrame:
    """A row for each ``message`` element of the XML text in a column, whatever its namespace: attributes, and texts of descendants by a path of local names. Blank is null; text that is no XML has no message."""
    names = [*attributes, *texts]

    def local(e) -> str:
        return e.tag.rpartition("}")[2]

    def text_of(e, path: list[str]) -> str | None:
        for step in path:
            e = next((x for x in e.iter() if local(x) == step), None) if e is not None else None
        return (e.text or "").strip() or None if e is not None else None

    def run(it):
        for pdf in it:
            rows = []
            for own, raw in zip(pdf.to_dict("records"), pdf[xml], strict=True):
                try:
                    root = ElementTree.fromstring(raw or "")
                except ElementTree.ParseError:
                    continue
                for m in (x for x in root.iter() if local(x) == message):
                    rows.append([*own.values(), *[m.get(a) or None for a in attributes.values()], *[text_of(m, t.split("/")) for t in texts.values()]])
            if rows:
                yield pd.DataFrame(rows, columns=[*pdf.columns, *names])

    schema = StructType([*df.schema.fields, *[StructField(n, StringType()) for n in names]])
    return df.mapInPandas(run, schema)
