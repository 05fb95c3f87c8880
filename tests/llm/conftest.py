import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, row long, label string, key string, tokens long"


def messy_rows():
    """Nulls in any column, empty and blank texts, a very long one, repeated rows, clashing column names."""
    prose = "The Quick brown fox jumps over the lazy dog while seven wizards quietly brew strong coffee for everyone near"
    rows = [
        (None, prose, None, 1, "x", None, 5),
        (1, None, "en", None, None, "k", None),
        (2, "", "en", 3, "y", "k", 1),
        (3, " \t\n ", None, 3, "y", "k", 1),
        (4, prose, "en", 4, "z", "k", 1),
        (4, prose, "en", 4, "z", "k", 1),
        (5, prose.upper() + " river", "en", 9, "z", "k", 1),
        (6, "word", "fr", 9, "z", "k", 1),
        (7, "é ç ñ 漢字 😀 " * 30, "xx", 9, "z", "k", 1),
        (8, " ".join(f"w{i % 977}x{i % 13}" for i in range(20_000)), "en", 9, "z", "k", 1),
        (None, None, None, None, None, None, None),
    ]
    return rows


@pytest.fixture
def messy(spark):
    return spark.createDataFrame(messy_rows(), DOC_SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture
def label_frame(spark):
    rows = [(4, 1, 0), (6, 0, 1), (7, 1, None), (None, 1, 1), (8, None, 0), (4, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
