"""Quality classifier by co-training: a text-content view and a page-metadata view.

The content view reads the text alone: hashed word and character n-grams, and the make-up of words and lines. Each n-gram bucket has a log-odds weight of its counts in labelled good and other
rows; a text's mean weights of words, of word pairs and of character n-grams are features beside the shares of letters, signs and digits, repetition, and line shapes. The metadata view reads
what is known of a page without its text: source, language tag and declared length. The views share no column.

Each view is a logistic classifier. A round is one pass over all documents: where one view is sure (by ``sure`` in its calibrated probability), it labels the row for the other, and the tasks sum the
other's gradient and curvature over these rows. The driver adds the labelled rows', and takes a Newton step; sums have a fixed size, so every unlabelled document takes part at every size. Pseudo-labels weigh together at most ``part`` of
the labelled rows, times the share of the labels' uncertainty that their teacher takes away on the rows kept apart: a view that knows little teaches little. Platt scaling on labelled rows kept apart calibrates each view; the scores are combined in log-odds, weighted by how well each view does on those rows.

The labelled rows are a bounded sample: at most ``labelled``, by a hash of the id. All rows are unlabelled examples, and all are scored.

Defined results: a null or empty text scores 0 and is not kept. Null source, language and length are values of their own.
Conflicting labels of an id count as the lower. Without labelled rows of both kinds every text with words scores 0.5 and is kept.
Repeated rows are kept; extra columns are ignored. Ties of the sample's hash go by the id.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import coded_chunks, collected, in_task, materialize, mix64, remove, summed, table

SOURCES, LANGS, LENGTHS = 64, 16, 12
#: Buckets of hashed n-grams, of each of three kinds; characters of an n-gram.
BUCKETS, CHARS = 1 << 16, 3
_NEXT = np.uint64(0x9E3779B97F4A7C15)


class Content:
    """A batch of texts, cut: per word its chunk, per distinct chunk its make-up and n-gram buckets."""

    def __init__(self, column: pa.Array):
        offsets, codes, self.chunks = coded_chunks(column)
        # code points of all chunks, each with a mark before and behind it
        self.length = pc.utf8_length(self.chunks).to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = self.length + 2
        owner = np.repeat(np.arange(len(sizes)), sizes)
        first = np.cumsum(sizes) - sizes
        points = np.zeros(len(owner), np.uint32)
        points[first], points[first + sizes - 1] = 2, 3
        inner = np.ones(len(owner), bool)
        inner[first] = inner[first + sizes - 1] = False
        points[inner] = np.frombuffer("".join(_texts(self.chunks)).encode("utf-32-le", "surrogatepass"), np.uint32)
        filled = (self.length > 0)[codes] if len(codes) else np.zeros(0, bool)
        self.offsets, self.codes = np.concatenate([[0], np.cumsum(filled)])[offsets], codes[filled].astype(np.int64)
        self.n = np.diff(self.offsets)
        self.column = column
        place = np.arange(len(owner)) - np.repeat(first, sizes)
        hashes = mix64(np.add.reduceat(mix64(points.astype(np.uint64) + place.astype(np.uint64) * _NEXT), first)) if len(first) else np.zeros(0, np.uint64)
        self.words = (hashes % np.uint64(BUCKETS)).astype(np.int64)
        own = hashes[self.codes]
        self.pairs = (mix64(own[:-1] * _NEXT + own[1:]) % np.uint64(BUCKETS)).astype(np.int64) if len(own) else np.zeros(0, np.int64)
        grams = np.zeros(max(0, len(points) - CHARS + 1), np.uint64)
        for k in range(CHARS):
            grams = grams * _NEXT + points[k : len(points) - CHARS + 1 + k] if len(grams) else grams
        at = np.flatnonzero(owner[: len(grams)] == owner[CHARS - 1 :])
        self.grams, self.gram_owner = (mix64(grams[at]) % np.uint64(BUCKETS)).astype(np.int64), owner[at]
        kinds = _kinds(points)
        self.shape = np.column_stack([np.bincount(owner, weights=kinds == k, minlength=len(sizes)) for k in range(3)]) if len(sizes) else np.zeros((0, 3))

    def counts(self, rows: np.ndarray) -> np.ndarray:
        """(3, BUCKETS): of words, pairs and character n-grams in the texts ``rows``, each n-gram of a text by its share in the text."""
        use = np.zeros(len(self.n), bool)
        use[rows] = True
        weight = np.repeat(use / np.maximum(self.n, 1), self.n)
        per_chunk = np.bincount(self.codes, weights=weight, minlength=len(self.chunks))
        out = np.zeros((3, BUCKETS))
        out[0] = np.bincount(self.words, weights=per_chunk, minlength=BUCKETS)
        if len(self.pairs):
            out[1] = np.bincount(self.pairs, weights=np.where(self._inside(), weight[:-1], 0.0), minlength=BUCKETS)
        out[2] = np.bincount(self.grams, weights=per_chunk[self.gram_owner] / np.maximum(self.length[self.gram_owner], 1), minlength=BUCKETS)
        return out

    def _inside(self) -> np.ndarray:
        """Of neighbouring words, whether they are of one text."""
        text = np.repeat(np.arange(len(self.n)), self.n)
        return text[:-1] == text[1:]

    def features(self, weights: np.ndarray) -> np.ndarray:
        """(texts, features), given the n-gram buckets' log-odds."""
        k, texts = np.maximum(self.n, 1), np.repeat(np.arange(len(self.n)), self.n)
        by_gram = np.bincount(self.gram_owner, weights=weights[2][self.grams], minlength=len(self.chunks)) / np.maximum(self.length, 1)
        closed = pc.match_substring_regex(self.chunks, "[.!?]$").to_numpy(zero_copy_only=False).astype(float)
        upper = pc.utf8_is_upper(pc.utf8_slice_codeunits(self.chunks, 0, 1)).to_numpy(zero_copy_only=False).astype(float)
        no_letter = (self.shape[:, 0] == 0).astype(float)
        chunk_rows = np.column_stack([weights[0][self.words], by_gram, self.shape, self.length, closed, upper, no_letter])
        total = summed(chunk_rows, self.offsets, self.codes)
        size = np.maximum(total[:, 5], 1)
        inside = self._inside() if len(texts) else np.zeros(0, bool)
        pair = np.bincount(texts[:-1][inside], weights=weights[1][self.pairs[inside]], minlength=len(k)) if len(texts) else np.zeros(len(k))
        runs = np.bincount(texts[:-1][inside], weights=self.codes[:-1][inside] == self.codes[1:][inside], minlength=len(k)) if len(texts) else np.zeros(len(k))
        distinct, top = _repetition(texts, self.codes, len(k))
        text_lines, repeated, mean = _lines(self.column)
        return np.column_stack([
            total[:, 0] / k, pair / k, total[:, 1] / k, total[:, 2] / size, total[:, 3] / size, np.minimum(total[:, 4] / k, 3.0), np.minimum(total[:, 5] / k, 20.0) / 10, total[:, 6] / k, total[:, 7] / k, total[:, 8] / k,
            distinct / k, top / k, runs / k, np.log1p(self.n) / 10, np.log1p(text_lines) / 10, repeated, np.log1p(mean) / 10,
        ])


def _texts(column: pa.Array) -> list[str]:
    """The texts of an Arrow array in one piece."""
    data = pc.binary_join(pa.LargeListArray.from_arrays(pa.array([0, len(column)], pa.int64()), column), "") if len(column) else pa.array([""])
    return data.to_pylist()


def _kinds(points: np.ndarray) -> np.ndarray:
    """Of each code point: 0 for a letter, 1 for a digit, 2 for a sign that prose doesn't use, 3 for others."""
    low = np.minimum(points, len(_LOW) - 1)
    kind = _LOW[low]
    high = np.flatnonzero(points >= len(_LOW) - 1)
    if len(high):
        distinct, inverse = np.unique(points[high], return_inverse=True)
        kind = kind.copy()
        kind[high] = np.array([_kind(p) for p in distinct.tolist()], np.int8)[inverse]
    return kind


def _kind(point: int) -> int:
    c = chr(point)
    return 0 if c.isalpha() else 1 if c.isdigit() else 3 if c in "\x02\x03.,;:'\"()?!-" else 2


_LOW = np.array([_kind(p) for p in range(0x250)], np.int8)


def _repetition(texts: np.ndarray, codes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of each text, and how often its most frequent one occurs. ``texts`` ascends."""
    if not len(codes):
        return np.zeros(rows), np.zeros(rows)
    width = int(codes.max()) + 1
    keys = np.sort(texts * width + codes)
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    times = np.diff(np.append(start, len(keys)))
    owner, top = keys[start] // width, np.zeros(rows)
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    top[owner[first]] = np.maximum.reduceat(times, first)
    return np.bincount(owner, minlength=rows).astype(float), top


def _lines(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of each text, the share of its filled lines that repeat another, and the mean length of a line."""
    column = column.fill_null("")
    cut = pc.split_pattern(column, "\n")
    coded = cut.flatten().dictionary_encode()
    offsets = cut.offsets.to_numpy().astype(np.int64)
    n = np.diff(offsets)
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    filled = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False)[codes] > 0 if len(codes) else np.zeros(0, bool)
    texts = np.repeat(np.arange(len(n)), n)[filled]
    k = np.bincount(texts, minlength=len(n))
    distinct, _ = _repetition(texts, codes[filled], len(n))
    size = pc.utf8_length(column).to_numpy(zero_copy_only=False)
    return n.astype(float), (k - distinct) / np.maximum(k, 1), size / np.maximum(n, 1)


def meta_view(batch: pa.RecordBatch) -> np.ndarray:
    """(rows, features) of source, language tag and declared length; the text is not read."""
    out = np.zeros((batch.num_rows, SOURCES + LANGS + LENGTHS + 1))
    each = np.arange(batch.num_rows)
    for start, size, name in ((0, SOURCES, "source"), (SOURCES, LANGS, "lang")):
        coded = batch.column(name).dictionary_encode(null_encoding="encode")
        bucket = np.array([zlib.crc32(repr(v).encode()) % size for v in coded.dictionary.to_pylist()], np.int64)
        out[each, start + bucket[coded.indices.to_numpy(zero_copy_only=False)]] = 1.0
    length = batch.column("n_chars").fill_null(-1).to_numpy(zero_copy_only=False)
    size = np.log2(np.maximum(length, 0) + 1.0)
    out[each, SOURCES + LANGS + np.where(length < 0, 0, np.minimum(1 + size.astype(int), LENGTHS - 1))] = 1.0
    out[:, -1] = size / 10
    return out


class Logistic:
    """Standardised ridge logistic regression by Newton's method."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0):
        self.mean, self.sd = x.mean(0), x.std(0) + 1e-6
        z = self._z(x)
        weight = np.ones(len(y)) if weight is None else weight
        w = np.zeros(z.shape[1])
        penalty = np.full(z.shape[1], ridge)
        penalty[0] = 1e-6
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            h = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(h, z.T @ (weight * (y - p)) - penalty * w)
            w += np.clip(step, -3, 3)
            if abs(step).max() < 1e-6:
                break
        self.w = w

    def _z(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones(len(x)), np.clip((x - self.mean) / self.sd, -8, 8)])

    def sums(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and curvature of rows."""
        z = self._z(x)
        p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
        return z.T @ (y - p), (z * (p * (1 - p))[:, None]).T @ z

    def stepped(self, gradient: np.ndarray, curvature: np.ndarray, ridge: float = 1.0) -> Logistic:
        """The classifier after a Newton step on sums of rows."""
        penalty = np.full(len(self.w), ridge)
        penalty[0] = 1e-6
        new = object.__new__(Logistic)
        new.mean, new.sd = self.mean, self.sd
        new.w = self.w + np.clip(np.linalg.solve(curvature + np.diag(penalty), gradient - penalty * self.w), -3, 3)
        return new

    def odds(self, x: np.ndarray) -> np.ndarray:
        return self._z(x) @ self.w


@dataclass
class Model:
    #: log-odds of n-gram buckets
    weights: np.ndarray | None = None
    views: tuple[Logistic, Logistic] | None = None
    #: per view: slope, intercept, and its part in the sum
    scaling: tuple[tuple[float, float, float], ...] = ()
    #: per view: the share of the labels' uncertainty that it takes away
    trust: tuple[float, float] = (0.0, 0.0)

    def read(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(content features, metadata features, whether the text has words)."""
        content = Content(batch.column("text"))
        return content.features(self.weights), meta_view(batch), content.n > 0

    def log_odds(self, *views: np.ndarray) -> list[np.ndarray]:
        """Of each view, calibrated."""
        return [slope * v.odds(x) + shift for v, x, (slope, shift, _) in zip(self.views, views, self.scaling, strict=True)]

    def score(self, batch: pa.RecordBatch) -> np.ndarray:
        if self.views is None:
            return np.where(Content(batch.column("text")).n > 0, 0.5, 0.0)
        a, b, filled = self.read(batch)
        odds = sum(part * o for o, (_, _, part) in zip(self.log_odds(a, b), self.scaling, strict=True))
        return np.where(filled, 1 / (1 + np.exp(-np.clip(odds, -30, 30))), 0.0)


def calibrated(weights: np.ndarray, views: tuple[Logistic, Logistic], held: tuple[np.ndarray, np.ndarray], y: np.ndarray) -> Model:
    """Platt scaling and parts, by labelled rows kept apart."""
    scaling, gains = [], []
    for model, x in zip(views, held, strict=True):
        odds = model.odds(x)
        platt = Logistic(odds[:, None], y, ridge=0.01)
        slope = platt.w[1] / platt.sd[0]
        scaling.append((slope, platt.w[0] - slope * platt.mean[0]))
        p = np.clip(1 / (1 + np.exp(-platt.odds(odds[:, None]))), 1e-6, 1 - 1e-6)
        q = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        gains.append(max(1e-3, np.mean(y * np.log(p / q) + (1 - y) * np.log((1 - p) / (1 - q)))))
    # a view's part by its gain, the better one's is 1
    parts = np.array(gains) / max(gains)
    q = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    trust = np.clip(np.array(gains) / -(q * np.log(q) + (1 - q) * np.log(1 - q)), 0.0, 1.0)
    return Model(weights, views, tuple((s, i, float(w)) for (s, i), w in zip(scaling, parts, strict=True)), (float(trust[0]), float(trust[1])))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"))


def labelled_rows(docs: DataFrame, labels: DataFrame, labelled: int, held: list[str]) -> DataFrame:
    """The documents of at most ``labelled`` labelled ids, with their ``quality`` and ``fold`` (0 to 3, by a hash of the id)."""
    ids = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)  # a bounded table
    return materialize(_rows(docs).join(F.broadcast(chosen), "doc_id").select("*", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)).cast("int").alias("fold")).withColumn("quality", (F.col("quality") > 0).cast("int")), "labelled", held)


def ngram_weights(rows: DataFrame) -> list[np.ndarray] | None:
    """For each fold the (3, BUCKETS) log-odds of each bucket between good and other rows, by the other two of folds 0 to 2; for fold 3 by these three. Tasks send sums of fixed size."""
    schema = pa.schema([("fold", pa.int32()), ("good", pa.int32()), ("rows", pa.int64()), ("sums", pa.binary())])

    def run(batches):
        total, n = np.zeros((3, 2, 3, BUCKETS)), np.zeros((3, 2), np.int64)
        for b in batches:
            content, good, fold = Content(b.column("text")), np.array(b.column("quality").to_pylist()), np.array(b.column("fold").to_pylist())
            for f in range(3):
                for k in range(2):
                    own = np.flatnonzero((fold == f) & (good == k))
                    n[f, k] += len(own)
                    if len(own):
                        total[f, k] += content.counts(own)
        used = [(f, k) for f in range(3) for k in range(2) if n[f, k]]
        yield table(schema, fold=[f for f, _ in used], good=[k for _, k in used], rows=[int(n[x]) for x in used], sums=[total[x].astype("<f4").tobytes() for x in used])

    total, n = np.zeros((3, 2, 3, BUCKETS)), np.zeros((3, 2))
    # six rows at most for each task of the bounded sample
    for r in rows.where("fold < 3").coalesce(16).mapInArrow(in_task(run), "fold int, good int, rows long, sums binary").toLocalIterator():
        total[r.fold, r.good] += np.frombuffer(r.sums, "<f4").reshape(3, BUCKETS)
        n[r.fold, r.good] += r.rows
    out = []
    for f in range(4):
        others = [x for x in range(3) if x != f]
        t, k = total[others].sum(0), n[others].sum(0)
        if not k.all():
            return None
        # smoothed by what a bucket would have of its kind's whole
        prior = t.sum(0) / k.sum() + 1e-6
        out.append(np.log((t[1] + 3 * prior) / (k[1] + 3)) - np.log((t[0] + 3 * prior) / (k[0] + 3)))
    return out


def learn(docs: DataFrame, labels: DataFrame, labelled: int = 20_000, rounds: int = 2, sure: float = 0.95, part: float = 0.5) -> Model:
    """Folds 0 to 2 of the labelled rows fit the classifiers; their n-grams' log-odds come from the other folds, so that no row is read by weights that have counted it. Fold 3 calibrates."""
    held: list[str] = []
    rows = labelled_rows(docs, labels, labelled, held)
    weights = ngram_weights(rows)
    if weights is None:
        remove(docs.sparkSession, held)
        return Model()
    schema = pa.schema([("quality", pa.int32()), ("fold", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])

    def read(batches):
        for b in batches:
            for f in range(4):
                own = b.filter(pc.equal(b.column("fold"), f))
                x, z, _ = Model(weights[f]).read(own)
                yield table(schema, quality=own.column("quality"), fold=own.column("fold"), a=[r.tobytes() for r in x], b=[r.tobytes() for r in z])

    got = collected(rows.mapInArrow(in_task(read), "quality int, fold int, a binary, b binary"))
    remove(docs.sparkSession, held)
    y, apart = got["quality"].to_numpy(float), got["fold"].to_numpy() == 3
    x = tuple(np.frombuffer(b"".join(got[k]), float).reshape(len(y), -1) for k in "ab")
    if len(set(y[apart])) < 2 or len(set(y[~apart])) < 2:
        apart = np.ones(len(y), bool)
    fit = ~apart if not apart.all() else apart
    views = tuple(Logistic(v[fit], y[fit]) for v in x)
    held_out = tuple(v[apart] for v in x)
    for _ in range(rounds):
        model = calibrated(weights[3], views, held_out, y[apart])
        taught = _pseudo(docs, model, sure)
        views = tuple(_taught(view, v[fit], y[fit], *t, part * trust) for view, v, t, trust in zip(views, x, taught, model.trust[::-1], strict=True))
    return calibrated(weights[3], views, held_out, y[apart])


def _taught(view: Logistic, x: np.ndarray, y: np.ndarray, n: int, gradient: np.ndarray, curvature: np.ndarray, part: float) -> Logistic:
    g, h = view.sums(x, y)
    weight = min(1.0, part * len(y) / n) if n else 0.0
    return view.stepped(g + weight * gradient, h + weight * curvature)


def _pseudo(docs: DataFrame, model: Model, sure: float) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each view the rows that the other is sure of: their number, and the sums of the view's gradient and curvature. One pass over all documents; a task sends one row per view."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("view", pa.int32()), ("rows", pa.int64()), ("gradient", pa.list_(pa.float64())), ("curvature", pa.list_(pa.float64()))])
    limit = float(np.log(sure / (1 - sure)))

    def run(batches):
        model = shared.value
        total = [[0, 0.0, 0.0], [0, 0.0, 0.0]]
        for batch in batches:
            *x, filled = model.read(batch)
            odds = model.log_odds(*x)
            for k, view in enumerate(model.views):
                by_other = odds[1 - k]
                use = filled & (np.abs(by_other) >= limit)
                g, h = view.sums(x[k][use], (by_other[use] > 0).astype(float))
                total[k] = [total[k][0] + int(use.sum()), total[k][1] + g, total[k][2] + h]
        kept = [(k, n, g, h) for k, (n, g, h) in enumerate(total) if n]
        yield table(schema, view=[k for k, *_ in kept], rows=[n for _, n, *_ in kept], gradient=[g for *_, g, _ in kept], curvature=[h.ravel() for *_, h in kept])

    sent = _rows(docs).drop("doc_id").mapInArrow(in_task(run), "view int, rows long, gradient array<double>, curvature array<double>")
    # summed by the cluster, element by element; the number of rows goes first
    flat = sent.select("view", F.posexplode(F.concat(F.array(F.col("rows").cast("double")), "gradient", "curvature")))
    sums = collected(flat.groupBy("view", "pos").agg(F.sum("col").alias("s"))).sort_values("pos")
    out = []
    for k, view in enumerate(model.views):
        own, d = sums["s"][sums["view"] == k].to_numpy(), len(view.w)
        out.append((int(own[0]), own[1 : d + 1], own[d + 1 :].reshape(d, d)) if len(own) else (0, np.zeros(d), np.zeros((d, d))))
    return out


def keep_good(docs: DataFrame, model: Model, keep_at: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score at least ``keep_at``; filtered where they are read, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(shared.value.score(b) >= keep_at))

    return docs.mapInArrow(in_task(run), docs.schema)


def score(docs: DataFrame, model: Model, keep_at: float = 0.5) -> DataFrame:
    """(doc_id, score, keep) of all rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("keep", pa.bool_())])

    def run(batches):
        for b in batches:
            s = shared.value.score(b)
            yield table(schema, doc_id=b.column("doc_id").to_pylist(), score=s, keep=s >= keep_at)

    return _rows(docs).mapInArrow(in_task(run), "doc_id long, score double, keep boolean")
