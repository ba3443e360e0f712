import pytest

ODD = [
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, "   ", None, "b"),
    (4, "one", "en", "a"),
    (5, "The same line of text that is long enough to count here.\nAnother line of text that is long enough to count.", "en", "a"),
    (6, "The same line of text that is long enough to count here.\nAnother line of text that is long enough to count!", "fr", "b"),
    (6, "The same line of text that is long enough to count here.\nAnother line of text that is long enough to count!", "fr", "b"),
    (7, "é" * 300 + " ünïcode 日本語 \U0001f600 <s> <|endoftext|> ▁x", "de", "b"),
    (8, "word " * 20000, "en", "a"),
    (None, "a row without an id and with some words in it, quite a few of them", "en", "c"),
    (9, "12345 !!! ???", "en", "c"),
    (9, "another text under the same id, with other words than before", "de", "c"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names clash."""
    rows = [(*r, "x", 1, 2.0, "y") for r in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size string, label int, score double, bucket string").repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
