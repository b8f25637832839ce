import pytest
from odd_tables import LONG, with_clashing

@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated ids and rows, ties, and columns
    with clashing names."""
    plain = "The quick brown fox jumps over the lazy dog and runs on to the far green hills. " * 8
    rows = [
        (1, plain, "en", "a", 5),
        (1, plain, "en", "a", 5),
        (2, plain, "en", "b", None),
        (3, None, "en", "a", 1),
        (4, "", None, None, 1),
        (5, "   \n\t ", "en", None, 1),
        (None, "no id here, but a text of some words and more", None, "c", 1),
        (None, None, None, None, None),
        (6, LONG, "en", "a", 1),
        (7, "Zeile eins\nZeile eins\nZeile eins # * $ %", "de", "b", 1),
        (7, "same id, other text", "de", "b", 1),
        (8, "a\u0000b \U0001f600 e\u0301 \u00e9 <|endoftext|> x", "xx", "\U0001f600", 1),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return with_clashing(spark.createDataFrame(rows, schema))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("1 = 0")


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(1, 1, 0), (1, 1, 1), (2, None, None), (None, 1, 1), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def odd_items(spark):
    rows = [(1, None), (2, ""), (3, "!!"), (None, "quick brown fox jumps over the lazy dog and runs"), (4, "dog")]
    return spark.createDataFrame(rows, "item_id long, text string")
