import pytest

#: Nulls, empty and very long texts, ties and repeated rows, and columns that clash with names the operators use.
ODD = [
    (1, "the quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 68),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, "Ünïcode ΣΑΣ naïve don't 123 <|endoftext|>   x y é日本 İ ﬁ\x1c!?…", "fr", "b", 40),
    (5, "the quick brown fox jumps over the lazy dog near the river bank today", "en", None, 68),
    (5, "the quick brown fox jumps over the lazy dog near the river bank today", "en", None, 68),
    (None, "a row without id", "en", "b", 16),
    (7, "word " * 20000, "en", "c", 100000),
    (8, "un deux", "fr", "b", 7),
    (9, "... %%% 123", None, "b", 11),
]


@pytest.fixture(scope="session")
def odd(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    extra = {c: F.lit(0) for c in ("ids", "rep", "cluster", "tile", "edge", "stem", "score", "keep", "toxic_", "a", "b", "gram")}
    return df.withColumns(extra)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def vocabulary():
    from driftline.llm.queries import vocabulary

    return vocabulary()
