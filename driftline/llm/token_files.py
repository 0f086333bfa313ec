"""Token-ID files: flat unsigned integers and 64-bit document offsets, memory-mapped for reading.

A part is three flat little-endian files: ``.bin`` (ids: unsigned 16-bit where the vocabulary fits, else 32-bit), ``.idx``
(64-bit offsets, one more than documents) and ``.doc`` (64-bit document ids). A part holds a range of ids in ascending order;
its base, the ids of all parts before it, is a prefix sum over the parts' totals, kept beside the parts in a manifest (``manifest/``,
Parquet), so parts are written independently and a later session reads them by the folder's name. Files are written under a name of their task attempt and then renamed: a task that runs twice,
or whose executor is lost, leaves one whole part.

The folder must be one that driver and executors share. A local (mounted) one is memory-mapped; another store is read by ranges.

Defined results: a null text is empty and gives only the end id. Repeated ids keep one document for each row, in the order
of (id, text). A null id sorts first and is stored as the smallest 64-bit integer. An empty table gives no part.
"""

from __future__ import annotations

import functools
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import ChunkEncoder, Pieces, Vocabulary, packer, text_chunks
from .common import in_task, joined, new_path, table

NULL_ID = -(2**63)
END_ID = 1
_MANIFEST = "part string, first_id long, n_docs long, n_tokens long"
_KEPT = f"{_MANIFEST}, base long, path string, width string"


def store(path: str, mmap: bool = False) -> tuple[pafs.FileSystem, str]:
    """A file system that executors can open, and the path in it."""
    if path.startswith("file:") or "://" not in path:
        return pafs.LocalFileSystem(use_mmap=mmap), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


def task_encoder(vocabulary: str, width: str) -> ChunkEncoder:
    """The encoder of this process, for all tasks that it serves: a file is read, and a chunk encoded, once. A file that has changed is read anew."""
    at = os.stat(vocabulary)
    return _kept_encoder(vocabulary, width, at.st_mtime_ns, at.st_size)


@functools.lru_cache(maxsize=1)
def _kept_encoder(vocabulary: str, width: str, *_: int) -> ChunkEncoder:
    return library_encoder(vocabulary, width)


def library_encoder(vocabulary: str, width: str) -> ChunkEncoder:
    """Ids by the ``tokenizers`` library, as bytes. Pieces are sent joined by spaces: each ends in a token that carries the end-of-word mark, where the ids are cut."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer, v = Tokenizer.from_file(vocabulary), Vocabulary(vocabulary)
    ends = np.zeros(v.size, bool)
    ends[[i for t, i in v.ids.items() if v.end and t.endswith(v.end)]] = True

    def encode(pieces: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        for at in range(0, len(pieces), 512):
            some = pieces[at : at + 512]
            ids = tokenizer.encode(" ".join(some), add_special_tokens=False).ids
            cuts = np.flatnonzero(ends[ids]) + 1 if ids else []
            if len(cuts) == len(some):
                out += [ids[a:b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=True)]
            else:
                out += [e.ids for e in tokenizer.encode_batch(some, add_special_tokens=False)]
        return out

    # room for the distinct chunks of several batches: the library's calls cost more than the memory
    return ChunkEncoder(Pieces(v), encode, packer("I" if width == "<u4" else "H"), room=6 << 20)


def id_width(vocabulary: str) -> str:
    return "<u2" if Vocabulary(vocabulary).size <= 1 << 16 else "<u4"


def write_token_files(docs: DataFrame, vocabulary: str, path: str | None = None, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """Encode, append ``end_id`` to each document and write the parts. Returns the manifest: part, first_id, n_docs, n_tokens, base, path, width."""
    spark = docs.sparkSession
    path = path or new_path(spark, "tokens")
    width = id_width(vocabulary)
    schema = pa.schema([("part", pa.string()), ("first_id", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        from pyspark import TaskContext

        encoder, size = task_encoder(vocabulary, width), np.dtype(width).itemsize
        end = np.array([end_id], width).tobytes()
        context = TaskContext.get()
        fs, root = store(path)
        part, attempt = f"part-{context.partitionId():06d}", context.taskAttemptId()
        fs.create_dir(root, recursive=True)
        names = {k: (f"{root}/.{part}-{attempt}.{k}", f"{root}/{part}.{k}") for k in ("bin", "idx", "doc")}
        first, docs_n, at = None, 0, 0
        files = {}
        for b in batches:
            if not b.num_rows:
                continue
            if not files:
                files = {k: fs.open_output_stream(own, compression=None) for k, (own, _) in names.items()}
                files["idx"].write(np.array([0], "<i8").tobytes())
            ids = [NULL_ID if i is None else i for i in b.column("doc_id").to_pylist()]
            first = ids[0] if first is None else first
            lengths = []
            starts, codes, chunks = text_chunks(b.column("text"), encoder.pieces.added)
            for own in joined(encoder(chunks), starts, codes):
                files["bin"].write(own.tobytes() + end)
                lengths.append(len(own) // size + 1)
            offsets = at + np.cumsum(np.array(lengths, "<i8"))
            files["idx"].write(offsets.astype("<i8").tobytes())
            files["doc"].write(np.array(ids, "<i8").tobytes())
            docs_n, at = docs_n + len(ids), int(offsets[-1])
        for f in files.values():
            f.close()
        if files:
            for own, final in names.values():
                fs.move(own, final)
            yield table(schema, part=[part], first_id=[first], n_docs=[docs_n], n_tokens=[at])

    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    parts = ranged.mapInArrow(in_task(run), _MANIFEST).collect()  # a row for each part
    base, out = 0, []
    for r in sorted(parts, key=lambda r: (r.first_id, r.part)):
        out.append((r.part, r.first_id, r.n_docs, r.n_tokens, base, path, width))
        base += r.n_tokens
    spark.createDataFrame(out, _KEPT).coalesce(1).write.parquet(f"{path}/manifest")
    return manifest(spark, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of token files: a row for each part, with its base. Any session that sees the folder can read it."""
    return spark.read.schema(_KEPT).parquet(f"{path}/manifest")


def open_part(path: str, part: str, width: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, offsets, document ids) of a part; views of the mapped files where the store is local."""
    fs, root = store(path, mmap=True)

    def flat(kind: str, dtype: str) -> np.ndarray:
        with fs.open_input_file(f"{root}/{part}.{kind}") as f:
            return np.frombuffer(f.read_buffer(), dtype)

    return flat("bin", width), flat("idx", "<i8"), flat("doc", "<i8")


def read_token_files(spark: SparkSession, manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids array<int>]) of each document, from the files alone. The checksum is over 32-bit little-endian ids."""
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids
    schema = pa.schema(fields)

    def run(batches):
        for b in batches:
            for m in b.to_pylist():
                ids, offsets, docs = open_part(m["path"], m["part"], m["width"])
                for s in range(0, len(docs), 2000):
                    cut = offsets[s : s + 2001]
                    each = [ids[a:z] for a, z in zip(cut[:-1], cut[1:], strict=True)]
                    more = {"ids": [e.astype(np.int32) for e in each]} if with_ids else {}
                    yield table(schema, doc_id=[None if d == NULL_ID else int(d) for d in docs[s : s + 2000]], start=m["base"] + cut[:-1], n_tokens=np.diff(cut), ids_crc32=[zlib.crc32(e.astype("<u4").tobytes()) for e in each], **more)

    # ranges of names, about a part each
    dealt = manifest.repartitionByRange(max(1, min(manifest.count(), 10_000)), "part")
    return dealt.mapInArrow(in_task(run), "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
