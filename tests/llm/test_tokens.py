import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from driftline.llm import bpe, token_files
from driftline.llm.bpe import ChunkEncoder, Pieces, Vocabulary, encode_pieces, packer, text_chunks
from driftline.llm.common import joined

from .conftest import ODD


@pytest.fixture(scope="module")
def library(vocabulary):
    return Tokenizer.from_file(vocabulary)


def _texts():
    rng = random.Random(5)
    parts = ["the", "The", "running", "don't", "I'LL", "éa", "é", "ΑΣ", "Σ", "日本語", "%%%", "...", "12", "½", "٣", " ", " ", "\x1c", "\x85", "\t", "\n", " ", "<|endoftext|>", "<|startoftext|>", "<|", "'s", "''", "İ", "ß", "ﬁ", "🙂", "ǅ", "aaaaaaa", "_", "́", "x" * 50]
    return ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(0, 30))) for _ in range(400)]


def _encoded(encoder, many, width):
    offsets, codes, chunks = text_chunks(pa.array(many), encoder.pieces.added)
    return [np.frombuffer(m, width).tolist() for m in joined(encoder(chunks), offsets, codes)]


def test_pair_index_equals_the_library(library, vocabulary):
    v = Vocabulary(vocabulary)
    encoder = ChunkEncoder(Pieces(v), lambda ps: encode_pieces(v, ps), packer("i"))
    many = _texts() + ["only " + t.replace("<|", "") for t in _texts()]
    for k in (0, 400):  # with added tokens in the batch, and without
        _encoded(encoder, many[k : k + 400], "<i4")
    for t, ids in zip(many, _encoded(encoder, many[:400], "<i4") + _encoded(encoder, many[400:], "<i4")):
        assert ids == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_a_rank_is_merged_at_all_its_positions_at_once(library, vocabulary, monkeypatch):
    rng = random.Random(7)
    v = Vocabulary(vocabulary)
    pieces = sorted({"".join(rng.choices("aabbelnorst", k=rng.randrange(1, 40))) for _ in range(2000)} | {c * k for c in "aelos" for k in range(1, 70)})
    want = [e.ids for e in library.encode_batch(pieces, add_special_tokens=False)]
    asked = []
    monkeypatch.setattr(Vocabulary, "ranks", lambda self, left, right, of=Vocabulary.ranks: asked.append(len(left)) or of(self, left, right))
    assert encode_pieces(v, pieces) == want and encode_pieces(v, []) == []
    # a look-up of pairs for each rank, not for each position
    assert len(asked) < 2000 < sum(map(len, pieces)) / 10
    monkeypatch.setattr(bpe, "NOTED", 7)
    assert encode_pieces(v, pieces[:50]) == want[:50]


def test_library_encoder_joins_and_cuts(library, vocabulary):
    many = _texts()
    for t, ids in zip(many, _encoded(token_files.library_encoder(vocabulary, "<u2"), many, "<u2")):
        assert ids == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_encode_decode_and_digests(spark, odd, library, vocabulary):
    want = sorted((str(i), ids := library.encode(t or "", add_special_tokens=False).ids, library.decode(ids, skip_special_tokens=False)) for i, t, *_ in ODD)
    encoded = bpe.encode(odd, vocabulary)
    assert sorted((str(r.doc_id), r.ids) for r in encoded.collect()) == [(i, ids) for i, ids, _ in want]
    assert sorted((str(r.doc_id), r.text) for r in bpe.decode(encoded, vocabulary).collect()) == sorted((i, d) for i, _, d in want)
    got = bpe.encode_digests(odd, vocabulary, with_ids=True).collect()
    assert sorted((str(r.doc_id), r.ids) for r in got) == [(i, ids) for i, ids, _ in want]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted((i, len(ids), sha(" ".join(map(str, ids))), sha(d)) for i, ids, d in want)


def test_token_files_round_trip(spark, odd, library, vocabulary):
    manifest = token_files.write_token_files(odd, vocabulary)
    got = sorted(token_files.read_token_files(spark, manifest).collect(), key=lambda r: r.start)
    rows = sorted(((i, t or "") for i, t, *_ in ODD), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [r.doc_id for r in got] == [i for i, _ in rows]
    at = 0
    for r, (_, t) in zip(got, rows):
        ids = [*library.encode(t, add_special_tokens=False).ids, 1]
        assert (r.ids, r.start, r.n_tokens, r.ids_crc32) == (ids, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_parts_have_bases_by_prefix_sums(spark, sf, vocabulary):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    parts = sorted(token_files.write_token_files(docs, vocabulary).collect(), key=lambda r: r.first_id)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(parts) > 1
    for a, b in zip(parts, parts[1:]):
        assert b.base == a.base + a.n_tokens
    ids, offsets, doc_ids = token_files.open_part(parts[0].path, parts[0].part, parts[0].width)
    assert ids.dtype == np.uint16 and len(ids) == offsets[-1] and len(doc_ids) + 1 == len(offsets)


def test_empty(spark, none, vocabulary):
    assert token_files.read_token_files(spark, token_files.write_token_files(none, vocabulary)).count() == 0
    assert bpe.encode_digests(none, vocabulary).count() == 0


def test_a_later_session_reads_by_the_folder(spark, odd, vocabulary, tmp_path):
    path = f"file://{tmp_path}/tokens"
    written = token_files.read_token_files(spark, token_files.write_token_files(odd, vocabulary, path)).collect()
    other = spark.newSession()
    assert sorted(token_files.read_token_files(other, token_files.manifest(other, path)).collect(), key=str) == sorted(written, key=str)


def test_other_files_are_refused(vocabulary, tmp_path):
    import json

    with open(vocabulary, encoding="utf-8") as f:
        spec = json.load(f)
    for key, value in (("normalizer", None), ("decoder", {"type": "ByteLevel"}), ("model", spec["model"] | {"byte_fallback": True}), ("pre_tokenizer", {"type": "Whitespace"})):
        at = tmp_path / f"{key}.json"
        at.write_text(json.dumps(spec | {key: value}))
        with pytest.raises(ValueError, match=key):
            Vocabulary(str(at))


def test_long_texts_are_said_in_parts(spark, library, vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "SAID", 7)
    texts = ["the quick brown fox " * k for k in (0, 1, 2, 3, 7)]
    got = bpe.encode_digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), vocabulary).collect()
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())


def test_a_process_reads_a_vocabulary_once(vocabulary, tmp_path):
    import os
    import shutil

    at = str(tmp_path / "vocabulary.json")
    shutil.copy(vocabulary, at)
    one = token_files.task_encoder(at, "<u2")
    said = [bytes(x) for x in one(["some", "words"])]
    assert token_files.task_encoder(at, "<u2") is one and token_files.task_encoder(at, "<u4") is not one
    one = token_files.task_encoder(at, "<u2")
    os.utime(at, ns=(1, 1))
    assert token_files.task_encoder(at, "<u2") is not one and [bytes(x) for x in token_files.task_encoder(at, "<u2")(["some", "words"])] == said
