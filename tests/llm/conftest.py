import pytest

ODD = [
    (1, "", "en", "a"), (2, None, "en", "a"), (3, "   \n\t ", None, None), (4, "word", "en", "b"),
    (5, "word", "en", "b"), (5, "word", "en", "b"), (None, "word", "en", "b"), (None, "only here", None, None),
    (6, "the same line\nthe same line\n", "fr", "c"), (7, "x" * 50_000, "de", "c"),
    (8, "long words again " * 6_000, "en", "c"), (9, "été ñandú ß 漢字 😀 \x00 end", "es", "c"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns named like the operators' own."""
    rows = [(*r, len(r[1] or ""), "x", 1, b"y", 2) for r in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "fp string, node int, content binary, kept int").repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def small(spark):
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
