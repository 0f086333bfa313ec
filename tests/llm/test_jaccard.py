import random

import numpy as np
import pytest

from driftline.llm import jaccard
from driftline.llm.components import connected_components

from .conftest import ODD


def brute(rows, n, percent):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append((i, {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()))
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1 :]:
            if x and y and i is not None and j is not None and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(i), find(j)))
                parent[q] = p
    return sorted(((str(i), len(s), str(find(i) if i is not None else None)) for i, s in sets))


def random_docs(seed, n=260):
    """Groups of copies with edits, so that many pairs are near the threshold; chains that are no cliques; a common passage."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(40))
    passage = [word() for _ in range(30)]
    out = []
    while len(out) < n:
        base = [word() for _ in range(rng.randrange(1, 60))] + (passage if rng.random() < 0.4 else [])
        for _ in range(rng.choice([1, 1, 2, 5, 20])):
            base = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                base[rng.randrange(len(base))] = word()
            out.append(" ".join(base))
    return [(i * 3 + 1, t) for i, t in enumerate(out)]


@pytest.mark.parametrize(("n", "percent", "block", "most"), [(4, 85, 512, 512), (5, 80, 512, 3), (4, 85, 4, 2), (3, 60, 3, 512)])
def test_groups_equal_brute_force(spark, monkeypatch, n, percent, block, most):
    """Also with small tiles and short lists, so that all ways of dealing are taken."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "LIST", most)
    rows = random_docs(n * percent + block)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.near_duplicates(docs, n=n, percent=percent).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows, n, percent)


@pytest.mark.parametrize("most", [2, 512])
def test_hot_ngrams_are_dealt(spark, monkeypatch, most):
    """A passage that most documents share: the documents of its n-grams are dealt to parts, whose runs are tied."""
    monkeypatch.setattr(jaccard, "LIST", most)
    monkeypatch.setattr(jaccard, "LOCAL", 1)
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(30)]
    rows = [(i, " ".join(passage + [f"w{rng.randrange(6)}" for _ in range(rng.randrange(0, 9))])) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = jaccard.document_sets(docs, 4, 85).collect()
    assert (most > 200) != any(h.parts > 1 for r in sets for h in r.hot)
    got = jaccard.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows, 4, 85)


def test_long_documents_and_many_cells(spark, monkeypatch):
    """Tiles are bounded by n-grams too; a very long document meets its copy with an edit."""
    monkeypatch.setattr(jaccard, "CELLS", 300)
    rows = random_docs(11, 120)
    long = [f"v{i}" for i in range(300_000)]
    rows += [(10_001, " ".join(long)), (10_002, " ".join([*long[:150_000], "changed", *long[150_001:]])), (10_003, " ".join(long[:150_000]))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {int(i): (k, int(c)) for i, k, c in brute(rows[:-3], 4, 85)}
    assert {i: v for i, v in got.items() if i < 10_000} == want
    assert got[10_001] == (299_997, 10_001) and got[10_002] == (299_997, 10_001) and got[10_003] == (149_997, 10_003)


def test_forests_of_long_lists_equal_those_of_short_ones():
    rng = np.random.default_rng(8)
    base = [np.unique(rng.integers(-(2**63), 2**63 - 1, k)) for k in (40, 60, 1500, 3000)]
    sets = [np.unique(np.concatenate([b[int(0.03 * len(b)) * k :], rng.integers(-(2**63), 2**63 - 1, 2)])) for b in base for k in (0, 0, 1, 2, 9, 20)]
    rows = sorted((len(s), i, jaccard.parity_bits(s)) for i, s in enumerate(sets))

    def groups(pairs):
        root = {i: i for _, i, _ in rows}
        find = lambda x: x if root[x] == x else find(root[x])
        for a, b in pairs:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return [find(i) for i in range(len(rows))]

    every = [(x[1], y[1]) for k, x in enumerate(rows) for y in rows[k + 1 :] if 100 * x[0] >= 85 * y[0] and jaccard.may_link(x[0], x[2], y[0], y[2], 85)]
    assert groups(jaccard._long_forest(rows, 85)) == groups(every)


def test_repeated_ids_with_unlike_texts_stay(spark):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    docs = spark.createDataFrame([(1, a, "x"), (1, b, "y"), (1, a, "z"), (2, a, "x"), (3, b, "x"), (None, a, "x")], "doc_id long, text string, source string")
    got = jaccard.keep_one(docs).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(1, a), (1, b), (0, a)])
    again = jaccard.keep_one(docs.orderBy("source", ascending=False)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_odd_rows(odd, none):
    got = jaccard.near_duplicates(odd).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute([(i, t) for i, t, *_ in ODD], 4, 85)
    assert jaccard.near_duplicates(none).count() == 0
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, None, 7, 8, 9]))


def test_needed_overlap_is_exact():
    for x in range(1, 60):
        for y in range(1, 60):
            o = int(jaccard.needed(np.array([x]), np.array([y]), 85)[0])
            assert 100 * o >= 85 * (x + y - o) and not 100 * (o - 1) >= 85 * (x + y - o + 1)


def test_parity_maps_never_rule_out_a_link():
    rng = np.random.default_rng(2)
    for size in (1, 5, 300, 2000, 2100, 8100, 9000, 40000):
        x = np.unique(rng.integers(-(2**63), 2**63 - 1, size))
        for share in (0.0, 0.02, 0.07, 0.12):
            k = int(share * len(x))
            y = np.unique(np.concatenate([x[k:], rng.integers(-(2**63), 2**63 - 1, int(share * len(x) * rng.random()))]))
            o = len(np.intersect1d(x, y))
            linked = 100 * o >= 85 * (len(x) + len(y) - o)
            may = jaccard.may_link(len(x), jaccard.parity_bits(x), len(y), jaccard.parity_bits(y), 85)
            assert may or not linked
        other = rng.integers(-(2**63), 2**63 - 1, size)
        if size > 20:
            assert not jaccard.may_link(len(x), jaccard.parity_bits(x), size, jaccard.parity_bits(np.unique(other)), 85)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 4)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            p, q = sorted((find(a), find(b)))
            parent[q] = p
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in parent} and len(got) == len(parent)


def test_pairs_of_short_lists_come_once(spark):
    """However many n-grams two documents share, one row has them, and only where sizes may reach the threshold."""
    rows = [(g, r, n) for g in range(200) for r, n in ((1, 100), (2, 90), (3, 100))] + [(500, 4, 10), (500, 5, 100), (501, 6, 50), (501, 6, 50)]
    got = jaccard._list_pairs(spark.createDataFrame(rows, "gram long, rep long, n int"), 85)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 2), (1, 3), (2, 3)]
