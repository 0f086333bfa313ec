"""Benchmark decontamination: rare n-gram seeds join passages to test items, then Smith-Waterman alignment.

1. One pass over the documents finds their word n-grams that some item has, by a bitmap of the items' n-grams (``FILTER_BITS``, of fixed size; where it is full it
   only lets more pass). Documents with such n-grams are written with them.
2. Their counts over all documents tell which n-grams are rare. Seeds of an item are all that occur at most ``rare`` times per document (100 times at least), and of each
   ``STRETCH`` neighbours the rarest, however frequent it is. So a copy of an item is met wherever it has ``SEED`` + ``STRETCH`` - 1 words in a row as they are, also one of a frequent
   item, and with ``SEED`` words for other items.
3. Seeds are joined with the documents' n-grams by equality, which gives pairs of a document and an item with the seeds' positions; texts and items join those.
4. A pair is aligned word by word, in windows around its seeds, unless a window shares too few words with the item, counted with repeats, to reach the threshold (an exact bound). The score is the
   alignment's, of what a perfect copy would get; ``threshold`` marks contamination, so edited and paraphrased copies count.

Neither side is collected or broadcast; Spark may broadcast a side that it has seen to be small, and splits skewed keys of the joins.

Defined results: null texts are empty; items without words match nothing; items with fewer words than a seed are one seed.
Repeated items match each for itself; a document's row is kept once per (document row, item) with its best window. A null id stays null.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .common import in_task, materialize, mix64, remove, word_codes

WORD = re.compile(r"\w+")
SEED, STRETCH = 3, 3
FILTER_BITS = 1 << 26
MATCH, MISMATCH, GAP = 2, -1, -1
_BUCKET = 1 << 15  # bits of one of Spark's bitmaps
_MUL = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def smith_waterman(a: list[str], b: list[str]) -> tuple[int, int, int]:
    """Best local alignment of word lists with linear gaps: score, and its span in ``b`` (start, end). A row at a time; gaps along a row by a running maximum."""
    if not a or not b:
        return 0, 0, 0
    number = {w: i for i, w in enumerate(dict.fromkeys(a))}
    x, y = np.array([number[w] for w in a]), np.array([number.get(w, -1) for w in b])
    ramp = np.arange(len(b) + 1) * -GAP
    row = np.zeros(len(b) + 1, np.int64)
    start = np.arange(len(b) + 1)
    best = (0, 0, 0)
    for w in x:
        step = np.where(y == w, MATCH, MISMATCH)
        diagonal, above = row[:-1] + step, row[1:] + GAP
        from_diagonal = diagonal >= above
        open_ = np.concatenate([[0], np.maximum(np.maximum(diagonal, above), 0)])
        begin = np.concatenate([[0], np.where(from_diagonal, start[:-1], start[1:])])
        begin = np.where(open_ == 0, np.arange(len(b) + 1), begin)
        run = open_ + ramp
        top = np.maximum.accumulate(run)
        at = np.maximum.accumulate(np.where(run == top, np.arange(len(run)), 0))
        row = top - ramp
        start = begin[at]
        dead = row <= 0
        row, start = np.where(dead, 0, row), np.where(dead, np.arange(len(b) + 1), start)
        k = int(row.argmax())
        if row[k] > best[0]:
            best = int(row[k]), int(start[k]), k
    return best


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes) of the words of each text."""
    offsets, codes, hashes = word_codes(column)
    return offsets, hashes[codes]


def ngram_hashes(offsets: np.ndarray, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the n-grams of ``n`` words that lie in one text."""
    if len(words) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = words[: len(words) - n + 1] + np.uint64(n)
    for k in range(1, n):
        h = mix64(h * _MUL) + words[k : len(words) - n + 1 + k]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.flatnonzero(text[: len(h)] == text[n - 1 :])
    return at, mix64(h[at]).view(np.int64)


def item_seeds(items: DataFrame) -> DataFrame:
    """(item, at, seed, length) of items (item, text): their n-grams of ``SEED`` words, or all their words where they have fewer."""
    schema = pa.schema([("item", pa.int64()), ("at", pa.int64()), ("seed", pa.int64()), ("length", pa.int32())])

    def run(batches):
        for b in batches:
            offsets, words = word_hashes(b.column("text"))
            sizes = np.diff(offsets)
            for n in range(1, SEED + 1):
                at, h = ngram_hashes(offsets, words, n)
                owner = np.searchsorted(offsets, at, "right") - 1
                use = sizes[owner] == n if n < SEED else np.ones(len(at), bool)
                rows = pa.array(owner[use])
                yield pa.RecordBatch.from_arrays([b.column("item").take(rows), pa.array(at[use] - offsets[owner[use]]), pa.array(h[use]), pa.array(np.full(use.sum(), n, np.int32))], schema=schema)

    return items.select("item", "text").mapInArrow(in_task(run), "item long, at long, seed long, length int")


def _filter(seeds: DataFrame) -> tuple[np.ndarray, list[int]]:
    """(bits, lengths): a bitmap of the seeds by their lowest bits, made on the cluster and of fixed size, and the seeds' lengths."""
    place = F.pmod("seed", F.lit(FILTER_BITS))
    parts = seeds.groupBy(F.shiftright(place, 15).alias("bucket")).agg(F.expr(f"bitmap_construct_agg(pmod(seed, {_BUCKET}))").alias("bits")).collect()
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for bucket, part in parts:
        bits[bucket * (_BUCKET // 8) : (bucket + 1) * (_BUCKET // 8)] = np.frombuffer(part, np.uint8)
    return bits, [r[0] for r in seeds.select("length").distinct().collect()]


def marked(docs: DataFrame, text: str, seeds: DataFrame, all_rows: bool) -> DataFrame:
    """``docs`` with ``_seeds`` and ``_at``: their n-grams that the items may have, with the positions in words. Without ``all_rows`` only rows that have some."""
    shared = docs.sparkSession.sparkContext.broadcast(_filter(seeds))

    def run(batches):
        bits, lengths = shared.value
        for b in batches:
            offsets, words = word_hashes(b.column(text))
            ats, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for n in lengths:
                at, h = ngram_hashes(offsets, words, n)
                place = (h & (FILTER_BITS - 1)).astype(np.int64)
                use = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                ats.append(at[use])
                hashes.append(h[use])
            at, h = np.concatenate(ats), np.concatenate(hashes)
            order = np.argsort(at, kind="stable")
            at, h = at[order], h[order]
            ends = np.searchsorted(at, offsets)
            at = at - offsets[np.searchsorted(offsets, at, "right") - 1]
            lists = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(x)) for x in (h, at)]
            out = pa.RecordBatch.from_arrays([*b.columns, *lists], names=[*b.schema.names, "_seeds", "_at"])
            yield out if all_rows else out.filter(pa.array(np.diff(ends) > 0))

    lists = ArrayType(LongType())
    found = docs.mapInArrow(in_task(run), StructType([*docs.schema.fields, StructField("_seeds", lists), StructField("_at", lists)]))
    return found.withColumn("_row", F.monotonically_increasing_id())


def rare_seeds(seeds: DataFrame, hits: DataFrame, documents: int, rare: float) -> DataFrame:
    """(seed, item): of the items' n-grams those that occur, as the module says."""
    counts = hits.groupBy("seed").agg(F.count("*").alias("n"))
    counted = seeds.join(counts, "seed", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    by_place = Window.partitionBy("item").orderBy("at")
    ahead, last = by_place.rowsBetween(0, STRETCH - 1), F.max("at").over(Window.partitionBy("item"))
    stretch = F.min(F.struct("n", "at")).over(ahead)["at"]
    # a stretch at the end that has fewer neighbours counts only if it is the item's first
    whole = counted.select("*", F.when((F.col("at") + STRETCH - 1 <= last) | (F.col("at") == 0), stretch).alias("_rarest"))
    least = whole.select("item", F.col("_rarest").alias("at")).distinct().withColumn("_least", F.lit(True))
    chosen = counted.join(least, ["item", "at"], "left").where((F.col("n") > 0) & (F.col("_least") | (F.col("n") <= max(100, rare * documents))))
    return chosen.select("seed", "item").distinct()


def _pairs(rows: DataFrame, items: DataFrame, seeds: DataFrame, documents: int, rare: float) -> DataFrame:
    """(_row, _items): for each row with candidates the items, with their texts and the positions of the seeds."""
    hits = rows.select("_row", F.explode(F.arrays_zip("_seeds", "_at")).alias("h")).select("_row", F.col("h._seeds").alias("seed"), F.col("h._at").alias("at"))
    met = hits.join(rare_seeds(seeds, hits, documents, rare), "seed")
    pairs = met.groupBy("_row", "item").agg(F.sort_array(F.collect_set("at")).alias("at"))
    told = pairs.join(items, "item").select("_row", F.struct("item_id", F.col("text").alias("item_text"), "at").alias("i"))
    return told.groupBy("_row").agg(F.collect_list("i").alias("_items"))


def _candidates(docs: DataFrame, text: str, benchmark: DataFrame, rare: float, all_rows: bool, held: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows as ``marked`` writes them, their candidate items)."""
    items = materialize(benchmark.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).where("text is not null"), "items", held)
    seeds = materialize(item_seeds(items), "seeds", held)
    rows = materialize(marked(docs, text, seeds, all_rows), "marked", held)
    return rows, _pairs(rows, items, seeds, docs.count(), rare)


def contamination(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, doc_id: str = "doc_id", text: str = "text", rare: float = 1e-4) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word, matched_text): the contaminated documents, by item."""
    held: list[str] = []
    rows, pairs = _candidates(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), "text", benchmark, rare, False, held)
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("matched_text", pa.string())])

    def run(batches):
        for b in batches:
            found = []
            for doc, t, items in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("_items").to_pylist(), strict=True):
                words = words_of(t)
                for i in items:
                    score, start, end = align(words, words_of(i["item_text"]), i["at"], threshold)
                    if score >= threshold:
                        found.append((doc, i["item_id"], min(1.0, score), start, end, " ".join(words[start:end])))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

    aligned = rows.select("_row", "doc_id", "text").join(pairs, "_row").select("doc_id", "text", "_items")
    out = materialize(aligned.mapInArrow(in_task(run), "doc_id long, item_id long, score double, start_word long, end_word long, matched_text string"), "contamination")
    remove(docs.sparkSession, held)
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, rare: float = 1e-4) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no test item."""
    held: list[str] = []
    rows, pairs = _candidates(docs, "text", benchmark, rare, True, held)
    columns = docs.columns

    def run(batches):
        for b in batches:
            keep = []
            for t, items in zip(b.column("text").to_pylist(), b.column("_items").to_pylist(), strict=True):
                words = words_of(t) if items else []
                keep.append(not any(align(words, words_of(i["item_text"]), i["at"], threshold)[0] >= threshold for i in items or ()))
            yield b.select(columns).filter(pa.array(keep, pa.bool_()))

    out = materialize(rows.join(pairs, "_row", "left").select(*columns, "_items").mapInArrow(in_task(run), docs.schema), "clean")
    remove(docs.sparkSession, held)
    return out


def align(words: list[str], own: list[str], hits: list[int], threshold: float) -> tuple[float, int, int]:
    """(score, start, end) of the best alignment of an item's words around its seeds' positions, of 0 if none can reach the threshold."""
    reach, best, counts = 2 * len(own), (0.0, 0, 0), Counter(own)
    start = end = None
    for h in [*hits, None]:
        if end is not None and (h is None or h - reach > end):
            window = words[max(0, start) : end]
            # an alignment cannot match more words than both sides share, with repeats
            if (counts & Counter(w for w in window if w in counts)).total() >= threshold * len(own):
                score, a, z = smith_waterman(own, window)
                share = score / (MATCH * len(own))
                if share > best[0]:
                    best = share, max(0, start) + a, max(0, start) + z
            start = end = None
        if h is not None:
            start = h - reach if start is None else start
            end = h + reach
    return best
