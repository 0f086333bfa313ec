"""Toxicity: a learned, weighted lexicon matched by an Aho-Corasick automaton over folded text.

Folding: lower case, homoglyphs and digits to the Latin letters they stand for, accents kept, all else to spaces. Digits and signs
at a word's start or end may also stand for nothing: both readings are matched, and a word counts once. The lexicon
is learned from a bounded sample of labelled rows (``sample``, by a hash of the id): word stems (whole words and prefixes) whose
log-odds between toxic and other rows pass ``least_odds`` and whose counts are no chance; no stem is the prefix of another.
Words of two and three letters are stems as a whole. Counts are no chance by exact binomial tests with the sample's share of toxic
rows, of which a share of at most ``chance`` may be wrong (Benjamini and Hochberg), so the support needed doesn't follow the sample. Exception phrases are a stem's word
with a neighbour, seen at least as often in other rows as in toxic ones; a match inside one does not count. The weights of a
text's matches, whole and per hundred words, make its score by a logistic function fitted on the same sample.

Defined results: a null or empty text scores like any text without matches. Conflicting labels of an id count as toxic, null
labels not at all. Without labelled rows of both kinds every score is 0. Repeated rows are kept; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import collected, flushing_counts, in_task, materialize, table, texts

# Letters that look like Latin ones, and digits and signs that stand for letters.
HOMOGLYPHS = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ο": "o", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ⅼ": "l", "ɑ": "a", "ԁ": "d", "ɡ": "g", "һ": "h", "ո": "n", "ѵ": "v", "ԝ": "w"}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
MIN_WORD, MIN_STEM, MAX_STEM = 2, 4, 12


class _Folding(dict):
    """Of a translation table: what stands for a letter, letters as they are, all else a space."""

    def __missing__(self, code: int) -> int:
        c = chr(code)
        to = HOMOGLYPHS.get(c) or (c if c.isalpha() else " ")
        self[code] = to = ord(to)
        return to


_FOLD = _Folding()
#: Runs of digits and signs between letters, at a word's start and, up to the last that is no mark, at its end. Marks stay marks in longer runs of their own.
_INNER = r"(?<=[^\W\d_])(?!!!+[^\W\d_])[013457@8$!]+(?=[^\W\d_])"
_SIGNS = re.compile(_INNER + r"|(?:(?<![^\W_])[013457@8$]|(?<!\S)!)[013457@8$!]*(?=[^\W\d_])|(?<=[^\W\d_])[013457@8$!]*[013457@8$](?![^\W_])")
_INNER = re.compile(_INNER)


def _folded(low: str, signs: re.Pattern) -> str:
    return " " + signs.sub(lambda m: "".join([DIGITS[c] for c in m[0]]), low).translate(_FOLD) + " "


def fold(text: str) -> str:
    """Each run of digits and signs that touches a letter stands for letters."""
    low = text.lower()
    return _folded(low, _SIGNS) if any(d in low for d in DIGITS) else " " + low.translate(_FOLD) + " "


def readings(text: str) -> list[str]:
    """The folded text and, where it differs, the one whose digits and signs at a word's start or end stand for nothing; both have the same positions."""
    low = text.lower()
    if not any(d in low for d in DIGITS):
        return [" " + low.translate(_FOLD) + " "]
    return list(dict.fromkeys((_folded(low, _SIGNS), _folded(low, _INNER))))


def stems(word: str):
    """Prefixes of at least MIN_STEM letters, and the whole word closed by a space."""
    for k in range(MIN_STEM, min(len(word), MAX_STEM) + 1):
        yield word[:k]
    if MIN_WORD <= len(word) <= MAX_STEM:
        yield word + " "


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: set[str] = field(default_factory=set)
    #: intercept, weight of the sum, weight of the density
    line: tuple[float, float, float] | None = None

    def automaton(self) -> ahocorasick.Automaton | None:
        a = ahocorasick.Automaton()
        for stem, w in self.weights.items():
            a.add_word(" " + stem, (len(stem) + 1, w))
        for phrase in self.exceptions:
            a.add_word(phrase, (len(phrase), None))
        if not len(a):
            return None
        a.make_automaton()
        return a


def features(automaton, many: list[str]) -> np.ndarray:
    """(texts, 2): log of one plus the matches' weights, whole and per hundred words."""
    out = np.zeros((len(many), 2))
    if automaton is None:
        return out
    for i, t in enumerate(many):
        read = readings(t)
        hits = {(end - size + 1, end, w) for r in read for end, (size, w) in automaton.iter(r)}
        if hits:
            spared = [(s, e) for s, e, w in hits if w is None]
            found: dict[int, float] = {}  # a word counts once, however many readings match
            for s, e, w in hits:
                if w is not None and not any(a <= s and e <= z for a, z in spared):
                    found[s] = max(w, found.get(s, w))
            total = math.fsum(found.values())
            out[i] = math.log1p(total), math.log1p(100 * total / max(1, len(read[-1].split())))
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(text, toxic) of at most ``sample`` labelled ids, written to the shared folder; the ids' size bound allows the broadcast."""
    ids = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return materialize(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic")), "labelled")


def learn(docs: DataFrame, labels: DataFrame, sample: int = 30_000, least_odds: float = 3.0, chance: float = 0.01) -> Lexicon:
    rows = labelled_sample(docs, labels, sample)
    kinds = {bool(r[0]): r[1] for r in rows.groupBy(F.col("toxic") > 0).count().collect()}
    pos, neg = kinds.get(True, 0), kinds.get(False, 0)
    if not pos or not neg:
        return Lexicon()
    schema = pa.schema([("stem", pa.string()), ("toxic", pa.bool_()), ("n", pa.int64())])

    def counted(wanted: set[str] | None):
        def add(batch, counts):
            for t, y in zip(texts(batch), batch.column("toxic").to_pylist(), strict=True):
                for s in {s for w in {w for r in readings(t) for w in r.split()} for s in stems(w) if wanted is None or s in wanted}:
                    counts[s, y > 0] = counts.get((s, y > 0), 0) + 1

        return in_task(lambda it: flushing_counts(it, add, schema, 200_000))

    share = pos / (pos + neg)
    own = materialize(rows.where("toxic > 0").mapInArrow(counted(None), "stem string, toxic boolean, n long").groupBy("stem").agg(F.sum("n").alias("n")), "stems")
    sizes = sorted((r.n, r.stems) for r in own.groupBy("n").agg(F.count("*").alias("stems")).collect())
    tested = sum(k for _, k in sizes)
    # a stem with fewer toxic rows fails the tests even if no other row has it and all with as many pass
    able = (n for i, (n, _) in enumerate(sizes) if n * math.log(share) <= math.log(chance * sum(k for _, k in sizes[i:]) / tested))
    toxic = {r.stem: r.n for r in own.where(F.col("n") >= next(able, math.inf)).collect()}
    others = rows.where("toxic = 0").mapInArrow(counted(set(toxic)), "stem string, toxic boolean, n long").groupBy("stem").agg(F.sum("n").alias("n"))
    clean = {r.stem: r.n for r in others.collect()}
    odds = {s: math.log((n + 0.5) / (pos + 1)) - math.log((clean.get(s, 0) + 0.5) / (neg + 1)) for s, n in toxic.items()}
    tails = {s: _log_tail(toxic[s], clean.get(s, 0), share) for s, o in odds.items() if o >= least_odds}
    limit = max((t for k, t in enumerate(sorted(tails.values()), 1) if t <= math.log(chance * k / tested)), default=-math.inf)
    lexicon = Lexicon(_prefix_free({s: odds[s] for s, t in tails.items() if t <= limit}, toxic))
    lexicon.exceptions = _exceptions(rows, lexicon)
    x, y = _sampled_features(rows, lexicon)
    lexicon.line = _logistic(x, y)
    return lexicon


def _log_tail(n: int, other: int, share: float) -> float:
    """Logarithm of the chance that of n + other rows at least n are toxic."""
    size = n + other
    logs = [math.lgamma(size + 1) - math.lgamma(k + 1) - math.lgamma(size - k + 1) + k * math.log(share) + (size - k) * math.log1p(-share) for k in range(n, size + 1)]
    return max(logs) + math.log(math.fsum(math.exp(x - max(logs)) for x in logs)) if other else logs[0]


def _prefix_free(odds: dict[str, float], support: dict[str, int]) -> dict[str, float]:
    """Of each family of stems the longest with (nearly) the support of the shortest that passes. In alphabetical order a family follows its shortest stem."""
    out: dict[str, float] = {}
    families: list[list[str]] = []
    for s in sorted(odds):
        if families and s.startswith(families[-1][0]):
            families[-1].append(s)
        else:
            families.append([s])
    for first, *others in families:
        near = [t for t in others if support[t] >= 0.95 * support[first]]
        best = max([first, *near], key=lambda t: (len(t), t))
        out[best] = odds[best]
    return out


def _exceptions(rows: DataFrame, lexicon: Lexicon) -> set[str]:
    schema = pa.schema([("phrase", pa.string()), ("toxic", pa.bool_()), ("n", pa.int64())])
    stems_of = set(lexicon.weights)

    def add(batch, counts):
        for t, y in zip(texts(batch), batch.column("toxic").to_pylist(), strict=True):
            found = set()
            for words in map(str.split, readings(t)):
                for i, w in enumerate(words):
                    if any(s in stems_of for s in stems(w)):
                        found |= {f" {' '.join(words[a:b])} " for a, b in ((i - 1, i + 1), (i, i + 2)) if a >= 0 and b <= len(words)}
            for p in found:
                counts[p, y > 0] = counts.get((p, y > 0), 0) + 1

    got = rows.mapInArrow(in_task(lambda it: flushing_counts(it, add, schema, 200_000)), "phrase string, toxic boolean, n long").groupBy("phrase").agg(F.sum(F.when(~F.col("toxic"), F.col("n")).otherwise(0)).alias("clean"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("bad"))
    return {r.phrase for r in got.where("clean >= 3 and clean >= bad").collect()}


def _sampled_features(rows: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    schema = pa.schema([("a", pa.float64()), ("b", pa.float64()), ("y", pa.int32())])

    def run(batches):
        automaton = lexicon.automaton()
        for b in batches:
            x = features(automaton, texts(b))
            yield table(schema, a=x[:, 0], b=x[:, 1], y=b.column("toxic").to_pylist())

    got = collected(rows.mapInArrow(in_task(run), "a double, b double, y int"))
    return got[["a", "b"]].to_numpy(), (got["y"].to_numpy() > 0).astype(float)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Newton's method with a small ridge; weights of matches are not negative."""
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        ridge = np.diag([1e-6, 0.1, 0.1])
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -3, 3)
        if abs(step).max() < 1e-8:
            break
    return float(w[0]), max(0.0, float(w[1])), max(0.0, float(w[2]))


def score(docs: DataFrame, lexicon: Lexicon, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        lexicon = shared.value
        automaton = lexicon.automaton()
        for b in batches:
            x = features(automaton, texts(b))
            if lexicon.line is None:
                s = np.zeros(len(x))
            else:
                s = 1 / (1 + np.exp(-np.clip(lexicon.line[0] + x @ np.array(lexicon.line[1:]), -30, 30)))
            yield table(schema, doc_id=b.column("doc_id").to_pylist(), score=s)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(in_task(run), "doc_id long, score double")
