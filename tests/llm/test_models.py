"""Language, toxicity, quality and decontamination: held-out accuracy and brute force."""

import math

import numpy as np
from pyspark.sql import functions as F

from driftline.llm import decontaminate, langid, quality, toxicity
from driftline.llm.common import in_fold


def test_language_held_out(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs.where(~in_fold("doc_id", 3, 1)))
    got = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(in_fold("doc_id", 3, 1))
    assert got.where("lang = lang_pred").count() > 0.98 * got.count()
    assert got.where("rejected").count() <= 0.01 * got.count()
    strange = spark.createDataFrame([(1, "ξψωζ βγδθ λμπσ"), (2, None), (3, "12 %%"), (4, ""), (5, "the and of with that")], "doc_id long, text string")
    out = {r.doc_id: r for r in langid.predict(strange, model).collect()}
    assert out[1].rejected and not out[5].rejected and out[5].lang_pred == "en"
    assert [out[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3 and all(out[i].rejected and out[i].score == 0 for i in (2, 3, 4))
    nothing = langid.fit(none)
    assert {r.lang_pred for r in langid.predict(odd, nothing).collect()} == {"und"} and langid.predict(none, model).count() == 0
    kept = langid.keep_named(odd, langid.fit(odd))
    assert kept.columns == odd.columns and not {2, 3, 9} & {r.doc_id for r in kept.collect()}


def _counts(spark, rows):
    return spark.createDataFrame(rows, "lang string, gram string, n long")


def test_kneser_ney_sums_to_one(spark):
    counts = [("x", g, n) for g, n in [("\x02\x02\x02a", 3), ("\x02\x02ab", 2), ("\x02\x02aa", 1), ("\x02ab\x03", 2), ("\x02aa\x03", 1)]]
    symbols = sorted({c for _, g, _ in counts for c in g}) + ["?"]
    for floor in (1000, 3, 1):  # also where the model is cut to size
        m = langid.kneser_ney(_counts(spark, counts), floor)
        for context in ("\x02\x02\x02", "\x02\x02a", "zzz"):
            grams = np.array([[ord(c) for c in context + s] for s in symbols], np.uint32)
            assert math.isclose(np.exp(m.log_probabilities(grams)).sum(), 1.0, rel_tol=1e-9)


TEXTS = [
    (1, "the cat sat on the mat with the other cat", "en"), (2, "der hund und die katze über den zaun", "de"), (3, "on the road again, the road goes on", "en"), (4, "die straße und der weg 123 ÄÖ", "de"), (5, "İstanbul 日本語 the", "xx"),
    (6, "", "en"), (7, None, "en"), (8, "no language", None),
]


def _brute_entropies(rows, text):
    """Interpolated Kneser-Ney by the textbook, with dicts: language -> cross-entropy of ``text``."""
    order, out = langid.ORDER, {}
    words = {k: [w for _, t, lang in rows if lang == k and t for w in langid.words_of(t)] for k in sorted({r[2] for r in rows if r[2] and r[1]})}
    levels = {}
    for k, own in words.items():
        level = {}
        for w in own:
            s = langid.START * (order - 1) + w + langid.STOP
            for i in range(len(s) - order + 1):
                level[s[i : i + order]] = level.get(s[i : i + order], 0) + 1
        for n in range(order, 0, -1):
            levels[k, n] = level
            lower = {}
            for g in level:
                lower.setdefault(g[1:], set()).add(g[0])
            level = {g: len(v) for g, v in lower.items()}
    symbols = {g for k in words for g in levels[k, 1]}
    for k in words:

        def p(g, k=k):
            if not g:
                return 1 / (len(symbols) + 2)
            level = levels[k, len(g)]
            n1, n2 = sum(v == 1 for v in level.values()), sum(v == 2 for v in level.values())
            d = min(max(n1 / (n1 + 2 * n2), 0.1), 0.95) if n1 + n2 else 0.5
            after = [v for h, v in level.items() if h[:-1] == g[:-1]]
            if not after:
                return p(g[1:])
            return max(level.get(g, 0) - d, 0) / sum(after) + d * len(after) / sum(after) * p(g[1:])

        grams = [s[i : i + order] for w in langid.words_of(text) for s in [langid.START * (order - 1) + w + langid.STOP] for i in range(len(s) - order + 1)]
        out[k] = -sum(math.log(p(g)) for g in grams) / len(grams)
    return out


def test_entropies_equal_brute_force(spark):
    rows = [r for r in TEXTS if r[2] != "xx"]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = ["the dog and the cat", "ΩΩ ψ", "über straße", "a", "日本 the" * 50, "x" * 3000]
    got = {r.doc_id: r for r in langid.predict(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), model).collect()}
    for i, t in enumerate(asked):
        want = _brute_entropies(rows, t)
        low = min(want.values())
        assert math.isclose(got[i].entropy, low, rel_tol=1e-9) and got[i].lang_pred == next(k for k in sorted(want) if want[k] <= low + 1e-12)


def test_a_model_beyond_the_floor_is_whole(spark):
    rows = [r for r in TEXTS if r[2] != "xx"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts = langid.gram_counts(docs.where("lang is not null and text is not null"))
    grams = np.array([[ord(c) for c in g] for (g,) in counts.select("gram").distinct().collect()], np.uint32)
    whole, dealt = langid.kneser_ney(counts), langid.kneser_ney(counts, 40)
    assert np.allclose(whole.log_probabilities(grams), dealt.log_probabilities(grams), rtol=1e-12)
    # in tasks as well
    asked = ["the dog and the cat", "über straße", "weg"]
    got = {r.doc_id: r.entropy for r in langid.predict(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), langid.fit(docs, 40)).collect()}
    assert all(math.isclose(got[i], min(_brute_entropies(rows, t).values()), rel_tol=1e-9) for i, t in enumerate(asked))


def test_a_corpus_repeated_as_a_whole_has_the_same_model(spark):
    counts = langid.gram_counts(spark.createDataFrame(TEXTS, "doc_id long, text string, lang string").where("lang is not null and text is not null"))
    one, many = langid.kneser_ney(counts), langid.kneser_ney(counts.withColumn("n", F.col("n") * 1000))
    grams = np.array([[ord(c) for c in g] for g in ("\x02\x02\x02t", "the\x03", "\x02deΩ", "zzzz")], np.uint32)
    assert np.allclose(one.log_probabilities(grams), many.log_probabilities(grams))


def test_ties_go_to_the_first_language_and_limits_are_quantiles(spark):
    rows = [(i, "same words here", k) for i in range(300) for k in ("b", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(docs)).collect()} == {"a"}
    mixed = spark.createDataFrame([(i, "common words of the tongue " * 3 if i % 100 else f"{chr(0x4E00 + i)}{chr(0x4F00 + i)}", "x") for i in range(2000)], "doc_id long, text string, lang string")
    strict, loose = langid.fit(mixed, false_rejection=0.02, margin=0.0), langid.fit(mixed, false_rejection=0.0, margin=0.0)
    assert langid.predict(mixed, strict).where("rejected").count() == 20 and langid.predict(mixed, loose).where("rejected").count() == 0


def _labelled(spark):
    docs = [(i, ("you are a l0ser and an id10t " if i % 4 == 0 else "clean class loserville is nice " if i % 4 == 1 else "") + f"some words number{i} of text " * (1 + i % 7)) for i in range(400)]
    labels = [(i, 0 if i % 4 == 0 else 1, 1 if i % 4 == 0 else 0) for i in range(400)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_learns_folded_words(spark, odd, none):
    docs, labels = _labelled(spark)
    lexicon = toxicity.learn(docs, labels.where("doc_id % 3 <> 0"))
    got = {r.doc_id: r.score for r in toxicity.score(docs, lexicon).collect()}
    assert all((got[i] >= 0.3) == (i % 4 == 0) for i in got)
    assert toxicity.fold("L0SER!!!").split() == ["loser"] and toxicity.fold("іdіоt").split() == ["idiot"] and toxicity.fold("of%%% 12").split() == ["of"]
    assert toxicity.score(odd, lexicon).count() == odd.count() and toxicity.score(none, lexicon).count() == 0
    nothing = toxicity.learn(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(odd, nothing).collect()} == {0.0}


def test_runs_of_substitutes_fold():
    for odd, plain in {"id10t": "idiot", "1d10t": "idiot", "l00k": "look", "tr4$h": "trash", "l053r": "loser", "a55hole": "asshole", "idio7": "idiot", "a$$": "ass", "idio7!!!": "idiot"}.items():
        assert toxicity.fold(odd).split() == [plain]
    assert toxicity.fold("wow!!!you 1920s 12 of").split() == ["wow", "you", "s", "of"]
    lexicon = toxicity.Lexicon({"idiot ": 3.0, "lose": 3.0})
    x = toxicity.features(lexicon.automaton(), ["idiot", "id10t", "1d10t", "idio7", "idiot5", "5idiot", "l053r", "loser55", "fine 55"])
    assert (x[:8, 0] == x[0, 0]).all() and x[0, 0] > 0 and x[8, 0] == 0


def test_toxicity_learns_short_and_rare_words(spark):
    # of 2,400 toxic rows 24 have each short word and 16 the rare one, under or at a hundredth; chance words of about four rows stay out
    word = lambda i: "zog" if i % 100 == 0 else "qy" if i % 100 == 1 else "grumble" if i % 150 == 2 else "scum"
    noise = np.random.default_rng(5).integers(0, 3000, 12000)
    rows = [(i, f"some {word(i) if i < 2400 else 'words'} of noise{n} text nx{chr(97 + n % 26)}{chr(97 + n // 26 % 26)}{chr(97 + n // 676)}", int(i < 2400)) for i, n in enumerate(noise)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([r[::2] for r in rows], "doc_id long, toxic int")
    lexicon = toxicity.learn(docs, labels)
    assert {"zog ", "qy "} <= set(lexicon.weights) and any("grumble ".startswith(s) for s in lexicon.weights)
    assert not [s for s in lexicon.weights if s.startswith(("noise", "nx"))]
    got = {r.doc_id: r.score for r in toxicity.score(docs, lexicon).collect()}
    assert min(got[i] for i in range(2400)) > 0.3 > max(got[i] for i in range(2400, 12000))


def test_exception_phrases_cancel(spark):
    lexicon = toxicity.Lexicon({"trash ": 3.0}, {" trash can "}, (-2.0, 2.0, 0.0))
    x = toxicity.features(lexicon.automaton(), ["take the trash can out", "you are trash", "trash can trash"])
    assert x[0, 0] == 0 and x[1, 0] > 0 and x[2, 0] == x[1, 0]


def test_quality_co_training(spark, odd, none):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.learn(docs, labels.where("doc_id % 3 <> 0"))
    got = quality.score(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    assert len(got) > 50 and sum(r.keep == bool(r.quality) for r in got) > 0.95 * len(got)
    out = {r.doc_id: r for r in quality.score(odd, model).collect()}
    assert out[2].score == 0 and not out[2].keep and not out[3].keep and quality.score(none, model).count() == 0
    kept = quality.keep_good(odd, model)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {i for i, r in out.items() if r.keep}
    nothing = quality.learn(docs, labels.limit(0))
    assert {r.score for r in quality.score(odd.where("doc_id = 1"), nothing).collect()} == {0.5}


def test_views_are_apart():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": ["good words here.", None, "x | y | z %%%"], "source": ["a", None, "a"], "lang": ["en", None, "en"], "n_chars": pa.array([16, None, 13], pa.int64())})
    other = batch.set_column(0, "text", pa.array(["", "entirely other", None]))
    assert (quality.meta_view(batch) == quality.meta_view(other)).all()
    content = quality.Content(batch.column("text"))
    x = content.features(np.zeros((3, quality.BUCKETS)))
    assert x.shape[0] == 3 and (x[1, :13] == 0).all()
    # words, neighbours and letters against plain counts
    assert x[0, 9] == 0 and math.isclose(x[2, 9], 3 / 6) and math.isclose(x[0, 10], 1.0) and math.isclose(x[2, 11], 2 / 6) and math.isclose(x[0, 3], 13 / 14)
    assert content.counts(np.array([0]))[0].sum() == 1.0 and content.counts(np.array([0]))[1].sum() * 3 == 2.0


def test_each_view_teaches_the_other(spark):
    """Sources tell the quality too, but only unlabelled rows show most of them: the content view has to say it."""
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(1500):
        good = i % 3 > 0
        source = f"{'fine' if good else 'poor'}{rng.integers(4)}" if i >= 300 else "any"
        words = " ".join(f"w{rng.integers(50)}" if good else f"w{rng.integers(50)}%%%" for _ in range(rng.integers(5, 30)))
        rows.append((i, words, source, "en", len(words)))
        if i < 300:
            labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    known = spark.createDataFrame(labels + [(0, 1), (None, 1), (5, None)], "doc_id long, quality int")
    alone, taught = (quality.learn(docs, known, rounds=k) for k in (0, 3))
    wrong = lambda m: sum(r.keep != (r.doc_id % 3 > 0) for r in quality.score(docs, m).collect())
    assert wrong(taught) == 0
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([dict(zip(("text", "source", "lang", "n_chars"), r[1:], strict=True)) for r in rows if r[0] >= 300])
    truth = np.array([r[0] % 3 > 0 for r in rows if r[0] >= 300])
    right = lambda m: ((m.log_odds(*m.read(batch)[:2])[1] > m.log_odds(*m.read(batch)[:2])[1].mean()) == truth).mean()
    assert right(taught) > 0.95 and right(taught) > right(alone) + 0.1


def smith_waterman(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


def test_alignment_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(150):
        a, b = ([str(x) for x in rng.integers(0, 6, rng.integers(0, 14))] for _ in range(2))
        score, start, end = decontaminate.smith_waterman(a, b)
        assert score == smith_waterman(a, b)
        assert smith_waterman(a, b[start:end]) == score


def test_edited_copies_are_found(spark, odd, none, monkeypatch):
    items = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short one"), (3, None), (4, ""), (5, "of the and of the and of the and of")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    words = items[0][1].split()
    rows = [
        (1, "noise " * 30 + items[0][1].upper() + " noise" * 30), (2, "x " + " ".join(words[:4] + ["changed"] + words[5:9] + words[10:]) + " y"), (3, "alpha beta gamma alone"),
        (4, "this is a Short ONE."), (5, "nothing of the sort"), (6, None), (7, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contamination(docs, benchmark).collect()}
    assert set(got) == {(1, 1), (2, 1), (4, 2)} and got[1, 1].score == 1.0 and got[2, 1].score < 1.0
    assert got[1, 1].matched_text == items[0][1]
    monkeypatch.setattr(decontaminate, "FILTER_BITS", 1 << 15)  # a full filter gives the same
    assert {(r.doc_id, r.item_id) for r in decontaminate.contamination(docs, benchmark).collect()} == set(got)
    assert {r.doc_id for r in decontaminate.keep_clean(docs, benchmark).collect()} == {3, 5, 6, 7}
    assert decontaminate.contamination(none, benchmark).count() == 0 and decontaminate.contamination(odd, benchmark.limit(0)).count() == 0


def test_cut_copies_of_frequent_items_are_found(spark):
    words = [f"w{i}" for i in range(38)]
    benchmark = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    held = {i: words if i % 100 == 0 else words[:23] if i % 100 == 1 else ["other"] for i in range(1000)}
    docs = spark.createDataFrame([(i, " ".join(["noise", *w, "noise"])) for i, w in held.items()], "doc_id long, text string")
    copies = {i for i in held if i % 100 < 2}
    assert {r.doc_id for r in decontaminate.contamination(docs, benchmark).collect()} == copies
    assert {r.doc_id for r in decontaminate.keep_clean(docs, benchmark).collect()} == set(held) - copies


def test_repeated_words_count_before_alignment(spark):
    item = ["x", "y"] * 12 + [f"w{i}" for i in range(8)]  # half its words are two of ten distinct ones
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    docs = spark.createDataFrame([(1, "noise " + " ".join(item[:24]) + " noise"), (2, "x y x noise")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in decontaminate.contamination(docs, benchmark).collect()}
    assert got == {1: 0.75}


def test_repetitive_items_and_one_word_items(spark):
    long = ["a"] * 90 + [f"w{i}" for i in range(40)]
    benchmark = spark.createDataFrame([(1, " ".join(long)), (2, "zebra"), (3, "a a a a"), (3, "a a a a")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a " * 90), (2, "the Zebra."), (2, "the Zebra."), (3, "a b a c"), (None, "zebra")], "doc_id long, text string")
    got = sorted(((r.doc_id or 0), r.item_id, round(r.score, 2)) for r in decontaminate.contamination(docs, benchmark).collect())
    assert got == [(0, 2, 1.0), (1, 1, 0.69), (1, 3, 1.0), (1, 3, 1.0), (2, 2, 1.0), (2, 2, 1.0)]


def test_contamination_equals_brute_force(spark):
    """All documents against all items, without seeds: an alignment of whole texts. Recall of the seeds is measured, and whole here."""
    docs, benchmark = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r.item_id, decontaminate.words_of(r.text)) for r in benchmark.collect()]
    want = set()
    for r in docs.collect():
        words = decontaminate.words_of(r.text or "")
        held = set(words)
        for item, own in items:
            if own and sum(w in held for w in own) >= 0.5 * len(own) and decontaminate.smith_waterman(own, words)[0] >= 0.5 * decontaminate.MATCH * len(own):
                want.add((r.doc_id, item))
    got = {(r.doc_id, r.item_id) for r in decontaminate.contamination(docs, benchmark).collect()}
    assert got == want and want


def test_frequent_items_keep_seeds_in_every_stretch(spark):
    items = spark.createDataFrame([(0, 0, "a b c d e f g h"), (1, 1, "x y")], "item long, item_id long, text string")
    seeds = decontaminate.item_seeds(items)
    hits = seeds.join(spark.range(500), how="cross").select("seed")  # all are frequent
    for documents, want in ((10, 6 // 3 + 1), (10**8, 7)):
        chosen = decontaminate.rare_seeds(seeds, hits, documents, 1e-4).collect()
        assert want <= len(chosen) <= 7 and any(r.item == 1 for r in chosen)


def test_automaton_equals_a_plain_search():
    """Matches, exceptions and sums against a search of every stem at every word of every reading."""
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abio0153!$ "), rng.integers(1, 6)))
    lexicon = toxicity.Lexicon({"abo": 2.0, "bo ": 1.5, "aa ": 3.0, "iob": 0.5, "oo": 1.0}, {" bo ab ", " aa bo "})
    many = ["", "bo", "bo ab", "aa bo", "AA b0!", *(" ".join(word() for _ in range(rng.integers(0, 25))) for _ in range(500))]
    got = toxicity.features(lexicon.automaton(), many)
    for t, x in zip(many, got, strict=True):
        found, spared = {}, []
        for r in toxicity.readings(t):
            for p in lexicon.exceptions:
                spared += [(i, i + len(p) - 1) for i in range(len(r)) if r.startswith(p, i)]
        for r in toxicity.readings(t):
            for stem, w in lexicon.weights.items():
                s = " " + stem
                for i in range(len(r)):
                    if r.startswith(s, i) and not any(a <= i and i + len(s) - 1 <= z for a, z in spared):
                        found[i] = max(w, found.get(i, w))
        total = sum(found.values())
        words = len(toxicity.readings(t)[-1].split())
        assert np.allclose(x, [math.log1p(total), math.log1p(100 * total / max(1, words))])


def test_toxicity_conflicts_and_families(spark):
    docs, labels = _labelled(spark)
    again = labels.unionByName(labels.where("toxic = 1").withColumn("toxic", F.lit(0))).unionByName(spark.createDataFrame([(1, 1, None), (None, 1, 1)], labels.schema))
    one, both = toxicity.learn(docs, labels), toxicity.learn(docs, again)  # conflicting labels count as toxic, nulls not at all
    assert one.weights == both.weights and one.line == both.line
    odds = {s: 4.0 for s in ("idio", "idiot", "idiots", "lose", "loser ")}
    assert set(toxicity._prefix_free(odds, {"idio": 100, "idiot": 99, "idiots": 20, "lose": 50, "loser ": 30})) == {"idiot", "lose"}
