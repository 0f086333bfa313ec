"""WARC: archives of captures, and transaction assembly.

A capture is three records: request, response (or revisit) and metadata. The latter two name the request in
``WARC-Concurrent-To``; assembly joins them by that id into one nested row per capture. Records are gzip members of their own.
Of captures with equal payloads of at least ``min_bytes``, the one with the largest id keeps the payload (response); the others
are revisit records of the identical-payload-digest profile, which refer to it and keep the HTTP headers.

The folder must be shared by driver and executors. Files are written under a name of their attempt and renamed.

What a revisit refers to is found by a join of ``WARC-Refers-To`` with the ids of the responses, so archives of other writers resolve as well.

Defined results: a null payload is empty, a null url is the empty string. Each row is a capture of its own, also where ids and payloads repeat: rows of
the largest id with a payload are all responses, and revisits refer to the first of them. A null id is smaller than any other; a row without id revisits the response
if there is an id with its payload, and is a response if not. A revisit whose response is in no archive has a null target. An empty table
gives no archive. Very long payloads are streamed record by record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import in_task, materialize, new_path, table
from .token_files import store

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The digest's agreement on a hot payload is dealt over so many parts.
SALTS = 16


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(capture: int | None, digest: str, ordinal: int, kind: str) -> str:
    """``ordinal`` tells rows of equal id and payload apart, from 1."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind}/{capture}/{digest}/{ordinal}')}>"


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of a file of gzip members."""
    pending, inflate, data = b"", zlib.decompressobj(31), bytearray()
    while pending or (pending := stream.read(1 << 20)):
        data += inflate.decompress(pending)
        pending = inflate.unused_data
        if inflate.eof:
            yield parse_record(bytes(data))
            inflate, data = zlib.decompressobj(31), bytearray()
    if data:
        raise ValueError("a WARC file ends inside a record")


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/1."):
        raise ValueError(f"not a WARC record: {first[:40]}")
    headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    return headers, rest[: int(headers["content-length"])]


def revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, sha, refers_to) of the ids and payloads that an other page with a larger id keeps. Groups are reduced before the shuffle; a hot payload's pages are dealt by a salt."""
    found = pages.where(F.octet_length("html") >= min_bytes).select("page_id", "sha")
    keepers = found.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null").select("sha", "refers_to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    return salted.join(keepers, ["sha", "salt"]).where("page_id is null or page_id < refers_to").select("page_id", "sha", "refers_to").distinct()


def write_warc(pages: DataFrame, path: str | None = None, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write three records for each page. Returns the files: path, records."""
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    schema = pa.schema([("path", pa.string()), ("records", pa.int64())])
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    keyed = rows.withColumn("_id", F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    kept = revisits(rows, min_bytes).select(F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("_id"), "sha", "refers_to")
    # rows of equal id and payload are numbered where the join has dealt them
    own = Window.partitionBy("_id", "sha").orderBy("url")
    referring = keyed.join(kept, ["_id", "sha"], "left").withColumn("ordinal", F.row_number().over(own))

    def run(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        fs, root = store(path)
        fs.create_dir(root, recursive=True)
        name = f"part-{context.partitionId():06d}.warc.gz"
        own, out, n = f"{root}/.{context.taskAttemptId()}-{name}", None, 0
        for b in batches:
            for r in b.to_pylist():
                out = out or fs.open_output_stream(own, compression=None)
                out.write(capture_records(r["page_id"], r["ordinal"], r["url"], r["html"].encode(), r["refers_to"], date))
                n += 3
        if out:
            out.close()
            fs.move(own, f"{root}/{name}")
            yield table(schema, path=[f"{path}/{name}"], records=[n])

    files = referring.select("page_id", "ordinal", "url", "html", "refers_to").mapInArrow(in_task(run), "path string, records long").collect()  # a row for each file
    return spark.createDataFrame(files, "path string, records long")


def capture_records(capture: int | None, ordinal: int, url: str, payload: bytes, refers_to: int | None, date: str) -> bytes:
    target = url.replace("\r", "").replace("\n", "")
    common = [("WARC-Target-URI", target), ("WARC-Date", date)]
    digest = digest32(payload)
    ids = {k: record_id(capture, digest, ordinal, k) for k in ("request", "response", "metadata")}
    linked = ("WARC-Concurrent-To", ids["request"])
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kept = [("WARC-Record-ID", ids["response"]), linked, *common, ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is None:
        answer = record("response", kept, http + payload)
    else:
        answer = record("revisit", [*kept, ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest, 1, "response"))], http)
    fields = f"page-id: {capture}\r\n" if capture is not None else "page-id:\r\n"
    return record("request", [("WARC-Record-ID", ids["request"]), *common, ("Content-Type", "application/http; msgtype=request")], f"GET {target} HTTP/1.1\r\n\r\n".encode()) + answer + record("metadata", [("WARC-Record-ID", ids["metadata"]), linked, *common, ("Content-Type", "application/warc-fields")], fields.encode())


_RECORD = "warc_type string, record_id string, concurrent_to string, refers_to string, target_uri string, date string, payload_digest string, computed_digest string, payload_bytes long, block binary"


def read_warc(spark: SparkSession, files: DataFrame, with_blocks: bool = True) -> DataFrame:
    """A row for each record. ``computed_digest`` is of the payload that the record holds (null for revisits). Without blocks only headers and digests leave the task."""
    names = [f.split()[0] for f in _RECORD.split(", ")]
    kinds = [pa.string()] * 8 + [pa.int64(), pa.binary()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def row(h: dict[str, str], block: bytes) -> dict:
        kind = h["warc-type"]
        size = computed = None
        if kind in ("response", "revisit"):
            http, _, payload = block.partition(b"\r\n\r\n")
            told = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode("latin-1").split("\r\n")[1:])}
            size = len(payload) if kind == "response" else int(told["content-length"])
            computed = digest32(payload) if kind == "response" else None
        keep = block if with_blocks or kind == "metadata" else None
        return dict(zip(names, [kind, h["warc-record-id"], h.get("warc-concurrent-to"), h.get("warc-refers-to"), h.get("warc-target-uri"), h.get("warc-date"), h.get("warc-payload-digest", "").removeprefix("sha1:") or None, computed, size, keep], strict=True))

    def run(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                fs, name = store(path)
                some: list[dict] = []
                size = 0
                with fs.open_input_stream(name, compression=None) as stream:
                    for h, block in read_records(stream):
                        some.append(row(h, block))
                        size += len(block)
                        if len(some) >= 2000 or size > 16 << 20:
                            yield pa.RecordBatch.from_pylist(some, schema=schema)
                            some, size = [], 0
                if some:
                    yield pa.RecordBatch.from_pylist(some, schema=schema)

    # ranges of names, about a file each
    dealt = files.select("path").repartitionByRange(max(1, min(files.count(), 10_000)), "path")
    return dealt.mapInArrow(in_task(run), _RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: request, response (also a revisit) and metadata, joined by the concurrent-to id. A request without answer keeps null structs."""
    keyed = records.withColumn("transaction", F.coalesce(F.when(F.col("warc_type") == "request", F.col("record_id")), F.col("concurrent_to"), F.col("record_id")))
    whole = F.struct(*[c for c in records.columns])

    def of(*kinds):
        return F.max_by(F.when(F.col("warc_type").isin(*kinds), whole), F.when(F.col("warc_type").isin(*kinds), F.col("record_id")))

    return keyed.groupBy("transaction").agg(of("request").alias("request"), of("response", "revisit").alias("response"), of("metadata").alias("metadata"))


def capture_digests(captures: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of assembled captures; a response's digest is computed from its payload and held against its header. ``refers_to`` is the page of the
    response that a revisit's ``WARC-Refers-To`` names; the responses that are named are dealt to all salts, as a hot one may have most revisits."""
    page = F.regexp_extract(F.col("metadata.block").cast("string"), r"(?m)^page-id: (-?\d+)", 1)
    digest = F.when(F.col("response.warc_type") == "response", F.when(F.col("response.computed_digest") == F.col("response.payload_digest"), F.col("response.computed_digest"))).otherwise(F.col("response.payload_digest"))
    told = captures.select(
        F.when(page != "", page.cast("long")).alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"), digest.alias("payload_digest"), F.col("response.warc_type").alias("record_type"),
        F.col("response.record_id").alias("_own"), F.col("response.refers_to").alias("_target"),
    )
    told = materialize(told, "captures")
    named = told.where("_target is not null").select("_target").distinct()
    targets = told.where("record_type = 'response'").select(F.col("_own").alias("_target"), F.col("page_id").alias("refers_to")).join(named, "_target")
    spread = targets.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = told.withColumn("_salt", F.pmod(F.xxhash64("_own"), F.lit(SALTS)).cast("int"))
    rest = salted.where("_target is null").select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    return rest.unionByName(salted.where("_target is not null").join(spread, ["_target", "_salt"], "left").select(*rest.columns))
