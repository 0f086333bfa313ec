import hashlib
import re

import numpy as np
import xxhash

from driftline.llm import fingerprints as fp
from driftline.llm.common import mix64
from driftline.llm.queries import op1_fingerprints

from .conftest import ODD


def test_edits_against_brute_force(spark, odd):
    rows = sorted(((i, t or "") for i, t, *_ in ODD), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = fp.edit_sensitivity(odd).collect()
    want = []
    for k, (i, t) in enumerate(rows):
        n = rows[(k + 1) % len(rows)][1]
        want.append((i, len(t), hashlib.sha256((t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode()).hexdigest()))
    key = lambda r: tuple(map(str, r))
    assert sorted([tuple(r)[:3] for r in got], key=key) == sorted(want, key=key)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_equal_texts_equal_prints_and_edges_cross_partitions(spark, sf):
    got = op1_fingerprints(spark, sf).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    of = {}
    for r in got:
        assert of.setdefault(docs[r.doc_id], r.fingerprint) == r.fingerprint
    ids = sorted(docs)
    for a, b in zip(ids, [*ids[1:], ids[0]]):
        r = next(r for r in got if r.doc_id == a)
        t = docs[a]
        assert r.edited_sha256 == hashlib.sha256((t[: len(t) - len(t) // 2] + docs[b][: len(t) // 2]).encode()).hexdigest()
    assert sum(r.near_edited > r.near_next for r in got) > 0.9 * len(got)


def test_lexicon_is_the_band(spark):
    docs = spark.createDataFrame([(i, f"common w{i % 5} once{i}") for i in range(50)], "doc_id long, text string")
    assert fp.lexicon(docs, min_share=0.1, max_share=0.5).tolist() == sorted(xxhash.xxh3_64_intdigest(f"w{k}") for k in range(5))


def _brute(text, band):
    """One 64-bit hash for each subset, over the sorted hashes of the distinct terms that it keeps."""
    mix = lambda x: int(mix64(np.array([x % 2**64], np.uint64))[0])
    own = {xxhash.xxh3_64_intdigest(w) for w in re.findall(r"\w+", text.lower())}
    kept = own & set(band.tolist())
    if len(kept) < fp.MIN_TERMS:
        kept = own or {xxhash.xxh3_64_intdigest("\0" + text)}
    out, k = [], 0
    for share, many in fp.SUBSETS:
        for _ in range(many):
            terms = [t for t in sorted(kept) if mix(t ^ mix((k + 1) * 0x9E3779B97F4A7C15)) < share * 2**64]
            total = sum(mix(t) * pow(0xD6E8FEB86659FD93, i, 2**64) for i, t in enumerate(terms))
            out.append(mix(total) | 1 if terms else 0)
            k += 1
    return out


def test_prints_and_likeness_equal_brute_force(spark, odd):
    rows = sorted(((i, t or "") for i, t, *_ in ODD), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    band = fp.lexicon(odd, min_share=0.2, max_share=0.9)
    got = {(str(r.doc_id), r.n_chars): r for r in fp.edit_sensitivity(odd, band=band).collect()}

    def like(a, b):
        best, start = 0.0, 0
        for _, many in fp.SUBSETS:
            x = [(p, q) for p, q in zip(a[start : start + many], b[start : start + many]) if p or q]
            best, start = max(best, sum(p == q for p, q in x) / (len(x) + 1.0)), start + many
        return 1.0 if a == b else best

    for k, (i, t) in enumerate(rows):
        n = rows[(k + 1) % len(rows)][1]
        edited = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        a, e, b = (_brute(x, band) for x in (t, edited, n))
        r = got[str(i), len(t)]
        assert r.fingerprint == "".join(f"{x:016x}" for x in a) and r.edited_fingerprint == "".join(f"{x:016x}" for x in e)
        if rows.count((i, t)) == 1:
            assert r.near_edited == like(a, e) and r.near_next == like(a, b)


def test_subsets_keep_their_share():
    terms = mix64(np.arange(20000, dtype=np.uint64))
    for k, share in zip(range(fp.WIDTH), [s for s, many in fp.SUBSETS for _ in range(many)]):
        kept = (mix64(terms ^ fp._SALTS[k]) < fp._BELOW[k]).mean()
        assert abs(kept - share) < 5 * (share / 20000) ** 0.5


def test_empty(none):
    assert fp.edit_sensitivity(none).count() == 0 and fp.fingerprints(none).count() == 0
