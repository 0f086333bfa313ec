"""I-Match fingerprints over randomised lexicons.

Terms are lower-cased runs of word characters. The lexicon is the band of terms whose share of documents lies in
[``min_share``, ``max_share``], that is, whose inverse document frequency is neither too low (common words) nor too high
(one-off strings). A share of at least ``min_share`` bounds the lexicon: it has at most (mean distinct terms of a
document) / ``min_share`` terms of eight bytes, whatever the corpus' size.

A fingerprint has one 64-bit hash for each of ``SUBSETS`` random subsets of the lexicon: a bag of terms drawn for itself, which keeps the
share of the lexicon that is stated with it. The hash runs over the sorted distinct terms of the text that the subset keeps. Subsets that keep half the lexicon are alike for
texts that differ in a term or two, those that keep little for texts that share a half; likeness is the best of these views.

Defined results: a null text is empty. A text with fewer than ``MIN_TERMS`` band terms uses all its terms, one without any
term its raw characters. Equal texts always have equal fingerprints. Ties and repeated ids are kept, each row for itself,
in the order of (id, text); a null id sorts first. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import collected, in_task, materialize, mix64, remove, table, texts, word_codes

#: (share of the lexicon that a subset keeps, number of such subsets)
SUBSETS = ((1 / 2, 8), (1 / 8, 16), (1 / 32, 32), (1 / 128, 48), (1 / 512, 48))
MIN_TERMS = 4
_ENDS = np.cumsum([k for _, k in SUBSETS])
WIDTH = int(_ENDS[-1])
_SALTS = mix64(np.arange(1, WIDTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: A term belongs to a subset if its salted hash is below this.
_BELOW = np.array([int(share * 2**64) for share, k in SUBSETS for _ in range(k)], np.uint64)
_TURN = np.uint64(0xD6E8FEB86659FD93)
NULL_ID = -(2**63)


def distinct_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, code, hashes): the distinct terms of each text, by text and then by hash."""
    offsets, codes, hashes = word_codes(column)
    width = max(1, len(hashes))
    keys = np.unique(np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)) * width + codes)
    return keys // width, keys % width, hashes


def term_frequencies(docs: DataFrame, text: str = "text") -> DataFrame:
    """(term, df): in how many rows each term occurs, over all rows; a term by its 64-bit hash. Counts are summed within a task before the shuffle."""
    schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush():
            terms, at = np.unique(np.concatenate([t for t, _ in held]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([n for _, n in held])).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(counts)], schema=schema)

        for b in batches:
            _, codes, hashes = distinct_terms(b.column(text))
            if len(hashes):
                held.append((hashes, np.bincount(codes, minlength=len(hashes))))
                size += len(hashes)
            if size > 1_000_000:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return docs.select(text).mapInArrow(in_task(run), "term long, n long").groupBy("term").agg(F.sum("n").alias("df"))


def lexicon(docs: DataFrame, text: str = "text", min_share: float = 1 / 1000, max_share: float = 0.1) -> np.ndarray:
    """The sorted hashes of the band's terms, on the driver."""
    held: list[str] = []
    n = docs.count()
    df = materialize(term_frequencies(docs, text), "terms", held)
    band = collected(df.where((F.col("df") >= min_share * n) & (F.col("df") <= max(max_share * n, 1))).select("term"))
    remove(docs.sparkSession, held)
    return np.sort(band["term"].to_numpy(np.int64).view(np.uint64))


class Fingerprinter:
    """Fingerprints of many texts at once: an array (texts, WIDTH) of 64-bit hashes, 0 for an empty subset."""

    def __init__(self, band: np.ndarray):
        self.band = band

    def hashes(self, column: pa.Array) -> np.ndarray:
        out = np.zeros((len(column), WIDTH), np.uint64)
        text, code, hashes = distinct_terms(column)
        inside = np.zeros(len(hashes), bool)
        if len(self.band) and len(hashes):
            inside = self.band[np.minimum(np.searchsorted(self.band, hashes), len(self.band) - 1)] == hashes
        few = np.bincount(text, weights=inside[code], minlength=len(column)) < MIN_TERMS
        use = inside[code] | few[text]
        text, terms = text[use], hashes[code[use]]
        bare = np.flatnonzero(np.bincount(text, minlength=len(column)) == 0)
        if len(bare):  # no term: the raw characters stand for one
            raw = [xxhash.xxh3_64_intdigest("\0" + (column[int(i)].as_py() or "")) for i in bare]
            text, terms = np.concatenate([text, bare]), np.concatenate([terms, np.array(raw, np.uint64)])
            order = np.argsort(text, kind="stable")
            text, terms = text[order], terms[order]
        kinds, at = np.unique(terms, return_inverse=True)
        value = mix64(kinds)
        turns = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(np.bincount(text).max()) if len(text) else 0, _TURN)]), dtype=np.uint64)
        for k in range(WIDTH):
            kept = np.flatnonzero((mix64(kinds ^ _SALTS[k]) < _BELOW[k])[at])
            if not len(kept):
                continue
            own = text[kept]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            rank = np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))
            # a polynomial of the sorted terms
            out[own[first], k] = mix64(np.add.reduceat(value[at[kept]] * turns[rank], first)) | np.uint64(1)
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of two arrays of fingerprints, row by row: the largest share, over the subsets of one size, of subsets filled in either that hash alike; 1 for equal ones."""
    same = (a == b) & (a != 0)
    filled = (a != 0) | (b != 0)
    best = np.zeros(len(a))
    for start, end in zip([0, *_ENDS[:-1]], _ENDS, strict=True):
        best = np.maximum(best, same[:, start:end].sum(1) / (filled[:, start:end].sum(1) + 1.0))
    return np.where((a == b).all(1), 1.0, best)


def _hex(prints: np.ndarray) -> list[str]:
    return [p.tobytes().hex() for p in prints.astype(">u8")]


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", band: np.ndarray | None = None, **kw) -> DataFrame:
    """(doc_id, fingerprint): hexadecimal, sixteen digits for each lexicon subset."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon(docs, text, **kw) if band is None else band)
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])

    def run(batches):
        prints = Fingerprinter(shared.value)
        for b in batches:
            yield table(schema, doc_id=b.column("doc_id"), fingerprint=_hex(prints.hashes(b.column("text"))))

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(in_task(run), "doc_id long, fingerprint string")


def in_ranges(rows: DataFrame, parts: int) -> DataFrame:
    """Rows (id, text) dealt by ranges of ids and sorted, each range followed by the first row of the next one (``head``; the last by that of the first): (part, id, text, head)."""
    cuts = rows.agg(F.percentile_approx("id", [k / parts for k in range(1, parts)] or [0.5], 100 * parts)).first()[0] or []
    bounds = F.array(*[F.lit(c).cast("long") for c in sorted(set(cuts))]) if cuts else F.array().cast("array<long>")
    placed = rows.select(F.size(F.filter(bounds, lambda c: c <= F.col("id"))).alias("part"), "id", "text")
    # a row for each range
    least = placed.groupBy("part").agg(F.min("id").alias("id"))
    heads = placed.join(F.broadcast(least), ["part", "id"]).groupBy("part", "id").agg(F.min("text").alias("text"))
    order = Window.orderBy("part")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    next_ = lambda c: F.coalesce(F.lead(c).over(order), F.first(c).over(whole)).alias(c)
    following = heads.select("part", next_("id"), next_("text"), F.lit(True).alias("head"))
    every = placed.withColumn("head", F.lit(False)).unionByName(following)
    return every.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "head", "id", "text")


def edit_sensitivity(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", band: np.ndarray | None = None, **kw) -> DataFrame:
    """How far fingerprints survive an edit: each text against itself with its second half replaced by the next document's start, and against the next document.

    Texts cross the network once, dealt by ranges of ids; a task compares neighbours as it streams its sorted ranges.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(lexicon(docs, text, **kw) if band is None else band)
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches):
        prints = Fingerprinter(shared.value)
        last: list[tuple] = []
        for b in batches:
            rows = last + list(zip(b.column("part").to_pylist(), b.column("id").to_pylist(), texts(b), b.column("head").to_pylist(), strict=True))
            last = rows[-1:]
            own, following = [t for _, _, t, _ in rows[:-1]], [t for _, _, t, _ in rows[1:]]
            edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(own, following, strict=True)]
            use = np.flatnonzero([not head for *_, head in rows[:-1]])  # a head ends its range
            mine = prints.hashes(pa.array([t for _, _, t, _ in rows], pa.string()))
            a, n, e = mine[:-1][use], mine[1:][use], prints.hashes(pa.array([edited[i] for i in use], pa.string()))
            yield table(
                schema, doc_id=[None if rows[i][1] == NULL_ID else rows[i][1] for i in use], n_chars=[len(own[i]) for i in use], edited_sha256=[hashlib.sha256(edited[i].encode()).hexdigest() for i in use],
                fingerprint=_hex(a), edited_fingerprint=_hex(e), near_edited=likeness(a, e), near_next=likeness(a, n),
            )

    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranged = in_ranges(rows, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return ranged.mapInArrow(in_task(run), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
