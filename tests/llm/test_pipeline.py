import corpus_pipeline
from driftline.llm import bpe, decontaminate, jaccard, langid, quality


def test_stages_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert [k for k, _ in corpus_pipeline.STAGES] == ["language_id", "quality_classifier", "near_duplicates", "decontamination", "encoding"]
    rows = {r.doc_id: r.text for r in docs.collect()}
    named = {r.doc_id for r in langid.predict(docs, langid.fit(docs)).where("not rejected").collect()}
    one = corpus_pipeline.language_id(spark, docs, sf)
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == named
    two = corpus_pipeline.quality_classifier(spark, one, sf)
    good = {r.doc_id for r in quality.score(one, quality.learn(one, spark.read.parquet(f"{sf}/labels.parquet"))).where("keep").collect()}
    assert two.columns == docs.columns and {r.doc_id for r in two.collect()} == good
    three = corpus_pipeline.near_duplicates(spark, two, sf)
    from .test_jaccard import brute

    firsts = {int(c) for _, _, c in brute([(i, rows[i]) for i in good], 5, 80)}
    assert three.columns == docs.columns and {r.doc_id for r in three.collect()} == firsts
    four = corpus_pipeline.decontamination(spark, three, sf)
    leaked = {r.doc_id for r in decontaminate.contamination(three, benchmark).collect()}
    kept = {r.doc_id for r in four.collect()}
    assert four.columns == docs.columns and kept == firsts - leaked
    assert not any(b.text in rows[i] for b in benchmark.collect() for i in kept)
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, sf).collect()}
    from driftline.llm.queries import vocabulary

    want = {r.doc_id: r.ids for r in bpe.encode(four, vocabulary()).collect()}
    assert got == want and jaccard is not None
