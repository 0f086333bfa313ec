"""BPE encoding by a pair occurrence index, and decoding.

Texts are cut at ASCII white space into chunks; each chunk is normalised and cut into pieces as the vocabulary file says
(NFC, white space, lower case, then a split pattern), and the pieces of a batch that no earlier batch had are encoded
together: an index maps each adjacent pair with a rank to all its positions in the batch, the active ranks are applied in
ascending order, each to all its positions at once, and after each the lists of the neighbouring pairs are updated. Chunks are remembered, so a text's
ids are joined from those of its chunks. A file with another normaliser, cut, model or decoder than these is refused, so ids are never silently others.

Defined results: a null or empty text has no ids and decodes to the empty string. Repeated rows and ids are kept, each row
for itself. Very long texts need no special case: memory follows the distinct chunks of a batch.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import string
import struct
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunked, in_task, joined, table

#: Characters of the chunks, and of the pieces, that a task remembers; at the limit its memory is emptied.
ROOM = 1 << 20
#: Ids that are spelled out at a time.
SAID = 1 << 16
#: Positions whose first pairs are looked up at a time.
NOTED = 1 << 20
#: The normaliser whose rules ``Pieces`` follows, as vocabulary files say it.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPACE = regex.compile(r"\s+")


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 bytes stand for themselves, the others for code points from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """What a vocabulary file of the ``tokenizers`` library holds: tokens, ranks, pattern, added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        cut = spec["pre_tokenizer"]["pretokenizers"] if (spec.get("pre_tokenizer") or {}).get("type") == "Sequence" else [{}]
        split, last = cut[0], {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
        known = {
            "normalizer": spec.get("normalizer") == NORMALIZER,
            "pre_tokenizer": len(cut) == 2 and split.get("type") == "Split" and (split.get("behavior"), split.get("invert")) == ("Removed", True) and "Regex" in split["pattern"] and cut[1].items() >= last.items(),
            "model": model["type"] == "BPE" and all(isinstance(m, list) for m in model["merges"][:1]) and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")),
            "decoder": spec.get("decoder") is None and spec.get("post_processor") is None,
            "added_tokens": not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")) and not any(_SPACE.search(t["content"]) for t in spec["added_tokens"]),
        }
        if not all(known.values()):
            raise ValueError(f"{path}: this encoder doesn't know the file's {', '.join(k for k, ok in known.items() if not ok)}")
        self.ids: dict[str, int] = dict(model["vocab"])
        self.end = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.ids | self.added).items()}
        self.size = max(self.tokens) + 1
        self.pattern = split["pattern"]["Regex"]
        #: (left, right, new) of each rank.
        self.merges = [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in model["merges"]]
        # a pair that stands twice has its first rank; the key behind the last is none of a pair
        keys, first = np.unique(np.array([a << 32 | b for a, b, _ in self.merges], np.int64), return_index=True)
        self._keys, self._ranks = np.append(keys, np.iinfo(np.int64).max), np.append(first, -1).astype(np.int32)
        letters = byte_alphabet()
        self.inner = np.array([self.ids[letters[b]] for b in range(256)], np.int32)
        self.last = np.array([self.ids[letters[b] + self.end] for b in range(256)], np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, -1 where it has none."""
        keys = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self._keys, keys)
        return np.where(self._keys[at] == keys, self._ranks[at], np.int32(-1))


class Pieces:
    """The pieces of a chunk: strings to encode, or ids of added tokens."""

    def __init__(self, vocabulary: Vocabulary):
        self.find = regex.compile(vocabulary.pattern).findall
        # words of letters, and runs of ASCII marks without an apostrophe, are one piece each where the pattern says so
        marks = string.punctuation.replace("'", "")
        self.plain = r"[\p{L}]+" in vocabulary.pattern and self.find(f"a{marks}") == ["a", marks]
        self.added = vocabulary.added
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None

    def of(self, chunk: str) -> list[str | int]:
        low = chunk.lower() if chunk.isascii() else self.normal(chunk)
        word = low.rstrip(string.punctuation)
        # a word, or one with a run of ASCII marks behind it, needs no pattern; the marks hold no added token if a letter is before them only
        if self.plain and word.isalpha() and (len(word) == len(low) or "'" not in low):
            return [word] if len(word) == len(low) else [word, low[len(word) :]]
        if self.special is None or not self.special.search(chunk):
            return self.find(low)
        out: list[str | int] = []
        at = 0
        for m in self.special.finditer(chunk):
            out += self.find(self.normal(chunk[at : m.start()]))
            out.append(self.added[m[0]])
            at = m.end()
        return out + self.find(self.normal(chunk[at:]))

    @staticmethod
    def normal(s: str) -> str:
        if s.isascii():
            return s.lower()
        # lower case code point by code point: no final sigma
        return _SPACE.sub(" ", unicodedata.normalize("NFC", s)).replace("Σ", "σ").lower()


def encode_pieces(vocabulary: Vocabulary, pieces: list[str]) -> list[list[int]]:
    """Ids of each piece, by one pair occurrence index over all of them. All positions of a rank are merged at once."""
    raw = [p.encode() for p in pieces]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    ends = np.cumsum(sizes)
    codes = np.frombuffer(b"".join(raw), np.uint8)
    n = len(codes)
    symbol = vocabulary.inner[codes]
    symbol[ends - 1] = vocabulary.last[codes[ends - 1]]
    following, previous = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
    following[ends - 1] = previous[ends - sizes] = -1
    # pair occurrence index: rank -> positions of the left symbol; a position may stand there twice, or no longer have the pair
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def note(at: np.ndarray) -> None:
        ranks = vocabulary.ranks(symbol[at], symbol[following[at]])
        hit = np.flatnonzero(ranks >= 0)
        order = hit[np.argsort(ranks[hit], kind="stable")]
        at, ranks = at[order], ranks[order]
        cuts = [0, *(np.flatnonzero(np.diff(ranks)) + 1).tolist(), len(at)] if len(at) else [0]
        for a, z, rank in zip(cuts[:-1], cuts[1:], ranks[cuts[:-1]].tolist(), strict=True):
            if (known := index.get(rank)) is None:
                index[rank] = [at[a:z]]
                heapq.heappush(active, rank)
            else:
                known.append(at[a:z])

    for s in range(0, n, NOTED):
        at = np.arange(s, min(s + NOTED, n), dtype=np.int32)
        note(at[following[at] >= 0])
    while active:
        rank = heapq.heappop(active)
        left, right, new = vocabulary.merges[rank]
        i = np.unique(np.concatenate(index.pop(rank)))
        j = following[i]
        there = (symbol[i] == left) & (j >= 0) & (symbol[j] == right)
        i, j = i[there], j[there]
        if left == right:  # of a run of the symbol, each second position from its left
            count = np.arange(len(i))
            first = np.maximum.accumulate(np.where(np.append(True, j[:-1] != i[1:])[: len(i)], count, 0))
            i, j = i[(count - first) % 2 == 0], j[(count - first) % 2 == 0]
        k = following[j]
        symbol[i], symbol[j] = new, -1
        following[i] = k
        inside = k >= 0
        previous[k[inside]] = i[inside]
        h = previous[i]
        note(np.concatenate([i[inside], h[h >= 0]]))
    stays = symbol >= 0
    ids, bounds = symbol[stays].tolist(), np.append(0, np.cumsum(stays))[np.append(0, ends)].tolist()
    return [ids[a:z] for a, z in zip(bounds[:-1], bounds[1:], strict=True)]


class ChunkEncoder:
    """Remembers chunks within a task. ``encode(pieces)`` gives the ids of pieces not seen before, ``make(ids)`` what a piece is worth, ``combine`` that of a chunk from its pieces' (several, or none)."""

    def __init__(self, pieces: Pieces, encode, make, combine=b"".join, room: int = ROOM):
        self.pieces, self.encode, self.make, self.combine, self.room = pieces, encode, make, combine, room
        self.known: dict[str, object] = {}
        self.made: dict[str | int, object] = {}
        self.held = 0

    def __call__(self, chunks: list[str]) -> list:
        """The values of distinct chunks."""
        if self.held > self.room:
            self.known.clear()
            self.made.clear()
            self.held = 0
        known, made = self.known, self.made
        fresh = [c for c in chunks if c not in known]
        if fresh:
            self.held += sum(map(len, fresh))
            split = list(map(self.pieces.of, fresh))
            wanted = list({p for ps in split for p in ps if p not in made})
            words = [p for p in wanted if p.__class__ is str]
            made.update(zip(words, map(self.make, self.encode(words)), strict=True))
            made.update((p, self.make([p])) for p in wanted if p.__class__ is int)
            for c, ps in zip(fresh, split, strict=True):
                known[c] = made[ps[0]] if len(ps) == 1 else self.combine([made[p] for p in ps])
        return list(map(known.__getitem__, chunks))


def text_chunks(column: pa.Array, added: dict[str, int]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Chunks of a batch; A-Z is folded beforehand where no text holds an added token, which has its case."""
    return chunked(column, lower=not (added and pc.any(pc.match_substring_regex(column, "|".join(map(regex.escape, added)))).as_py()))


def packer(code: str):
    return lambda ids: struct.pack(f"<{len(ids)}{code}", *ids)


def _encoder(path: str) -> tuple[ChunkEncoder, Vocabulary]:
    """One for each task."""
    v = Vocabulary(path)
    return ChunkEncoder(Pieces(v), lambda ps: encode_pieces(v, ps), packer("i")), v


def encode(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>)."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        encoder, v = _encoder(vocabulary)
        for b in batches:
            offsets, codes, chunks = text_chunks(b.column("text"), v.added)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), _lists(joined(encoder(chunks), offsets, codes))], schema=schema)

    return _rows(docs, doc_id, text).mapInArrow(in_task(run), "doc_id long, ids array<int>")


def _lists(each: list) -> pa.ListArray:
    """Arrow lists of 32-bit integers, without a Python object for each."""
    offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in each], dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(each), "<i4")))


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids): the vocabulary has no decoder, so tokens are joined by a space, special ones included. Null ids decode to the empty string."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        tokens = Vocabulary(vocabulary).tokens
        for b in batches:
            yield table(schema, doc_id=b.column("doc_id").to_pylist(), text=[" ".join(tokens[i] for i in ids or ()) for ids in b.column("ids").to_pylist()])

    return encoded.select("doc_id", "ids").mapInArrow(in_task(run), "doc_id long, text string")


def encode_digests(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids array<int>]): ids and decoded text are made by the operator and hashed in the task."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] + [("ids", pa.list_(pa.int32()))] * with_ids)

    def run(batches):
        encoder, v = _encoder(vocabulary)
        # ids and tokens are said with a space behind each, the last of which goes
        spoken = [pa.array([f"{i} ".encode() for i in range(v.size)]), pa.array([(v.tokens.get(i, "") + " ").encode() for i in range(v.size)])]

        def said(words: pa.Array, lists: pa.ListArray, start: int, end: int) -> str:
            """Digest of a text's ids, so many at a time."""
            digest = hashlib.sha256()
            for at in range(start, end, SAID):
                some = words.take(lists.values.slice(at, min(SAID, end - at)))
                size = int(np.frombuffer(some.buffers()[1], np.int32)[len(some)])
                digest.update(memoryview(some.buffers()[2])[: size - (at + SAID >= end)])
            return digest.hexdigest()

        for b in batches:
            offsets, codes, chunks = text_chunks(b.column("text"), v.added)
            lists = _lists(joined(encoder(chunks), offsets, codes))
            ends = lists.offsets.to_numpy().astype(np.int64)
            digests = [[said(words, lists, a, z) for a, z in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)] for words in spoken]
            columns = [b.column("doc_id"), pa.array(np.diff(ends)), *[pa.array(d, pa.string()) for d in digests]]
            yield pa.RecordBatch.from_arrays(columns + [lists] * with_ids, schema=schema)

    return _rows(docs, doc_id, text).mapInArrow(in_task(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
