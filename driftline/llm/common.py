"""What the operators of this package share: the shared folder, written tables, Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A task works on so many bytes of a batch at a time (or one row), however long the texts are.
BATCH_BYTES = 8 << 20
#: Delete shuffle files when the action that made them ends.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see (``spark.checkpoint.dir``). Without the setting a local session uses a folder of its own; a cluster is refused, whose machines
    would each write to their own disk."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file:///tmp/checkpoints/driftline"
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/driftline/{label}-{uuid.uuid4().hex}"


@contextmanager
def _cleaning(spark: SparkSession):
    """Shuffle files of the actions inside go when each ends; the caller's setting comes back."""
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEAN)
        else:
            spark.conf.set(_CLEAN, before)


def materialize(df: DataFrame, label: str, held: list[str] | None = None) -> DataFrame:
    """Cut the lineage: write a table in the shared folder and read it again. Its path is added to ``held``, for ``remove`` when it has been read for the last time."""
    spark = df.sparkSession
    path = new_path(spark, label)
    with _cleaning(spark):
        df.write.option("compression", "zstd").parquet(path)
    give_back()
    if held is not None:
        held.append(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete intermediate tables in the shared folder, and empty the list."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        p = jvm.org.apache.hadoop.fs.Path(paths.pop())
        p.getFileSystem(conf).delete(p, True)


def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``BATCH_BYTES`` of text, of a row at least. An empty batch has none."""
    sizes = np.full(batch.num_rows, 64, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    if sizes.sum() <= BATCH_BYTES:
        if batch.num_rows:
            yield batch
        return
    group = (np.cumsum(sizes) - sizes) // BATCH_BYTES
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]])
    for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield batch.slice(a, z - a)


def in_task(run):
    """``run`` for ``mapInArrow``, over batches of bounded size. When the task ends, its memory goes back to the system: a Python worker serves one task after the other,
    also of other operators, and would keep what its largest one took."""

    def task(batches):
        try:
            yield from run(s for b in batches for s in cut(b))
        finally:
            give_back()

    return task


def give_back() -> None:
    """Memory that isn't in use goes from this process to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def collected(df: DataFrame):
    """A bounded result as a pandas frame, by way of Arrow: no object for each value crosses from the JVM."""
    return df.toArrow().to_pandas()


def in_fold(column: str, modulus: int, held_out: int):
    """crc32 of the id as text, by remainder: True for held-out rows. A null id is in no fold (False)."""
    return F.coalesce((F.crc32(F.col(column).cast("string").cast("binary")) % modulus) == held_out, F.lit(False))


def table(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A null text counts as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def chunked(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Texts cut at ASCII white space: (offsets, codes, distinct chunks). Text i has the chunks ``codes[offsets[i]:offsets[i + 1]]``, among which an empty one
    may stand at its ends. Arrow cuts and numbers; Python sees each distinct chunk once. A null text has no chunk. ``lower`` folds A-Z."""
    offsets, codes, chunks = coded_chunks(column, lower)
    return offsets, codes, chunks.to_pylist()


def coded_chunks(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The same with the distinct chunks as an Arrow array."""
    column = column.fill_null("")
    if lower:
        column = pc.ascii_lower(column)
    cut = pc.ascii_split_whitespace(column)
    coded = cut.flatten().dictionary_encode()
    offsets = cut.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


_WORD = re.compile(r"\w+")


def word_codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of word characters of each text, in lower case: (offsets, codes, hashes). Word i of all has the hash ``hashes[codes[i]]``; hashes are distinct and ascending. Python sees each distinct chunk once."""
    offsets, codes, chunks = chunked(column)
    found = [_WORD.findall(c.lower()) for c in chunks]
    size = np.fromiter(map(len, found), np.int64, len(found))
    hashes, flat = np.unique(np.fromiter((xxhash.xxh3_64_intdigest(w) for ws in found for w in ws), np.uint64, int(size.sum())), return_inverse=True)
    if not len(flat):
        return np.zeros(len(offsets), np.int64), flat.astype(np.int64), hashes
    own = size[codes]
    ends = np.concatenate([[0], np.cumsum(own)])
    first = np.cumsum(size) - size
    at = np.arange(ends[-1]) + np.repeat(first[codes] - ends[:-1], own)
    return ends[offsets], flat[at].astype(np.int64), hashes


def joined(values: list[bytes], offsets: np.ndarray, codes: np.ndarray) -> list[memoryview]:
    """For each text the concatenation of its chunks' values."""
    lengths = np.fromiter(map(len, values), np.int64, len(values))
    ends = np.concatenate([[0], np.cumsum(lengths[codes])])[offsets]
    whole = pa.array(values, pa.binary()).take(pa.array(codes)) if len(codes) else None
    data = memoryview(whole.buffers()[2] or b"") if whole is not None else memoryview(b"")
    return [data[a:z] for a, z in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def summed(values: np.ndarray, offsets: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """For each text the sum of its chunks' values (a row of numbers, or one number, each). A column at a time, which bounds the memory."""
    columns = values.reshape(len(values), -1)
    out = np.empty((len(offsets) - 1, columns.shape[1]))
    for k in range(columns.shape[1]):
        total = np.concatenate([[0.0], np.cumsum(columns[:, k][codes])])
        out[:, k] = total[offsets[1:]] - total[offsets[:-1]]
    return out.reshape(len(offsets) - 1, *values.shape[1:])


_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def flushing_counts(batches: Iterator, add, schema: pa.Schema, limit: int):
    """Counts of a partition, emitted whenever ``limit`` keys are held: ``add(batch, counts)`` fills a dict of key -> tuple or int."""
    counts: dict = {}
    for batch in batches:
        add(batch, counts)
        if len(counts) >= limit:
            yield from _emit(counts, schema)
            counts.clear()
    yield from _emit(counts, schema)


def _emit(counts: dict, schema: pa.Schema):
    if counts:
        keys = list(counts)
        if isinstance(keys[0], tuple):
            columns = [*zip(*keys, strict=True), tuple(counts.values())]
        else:
            columns = [keys, list(counts.values())]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
