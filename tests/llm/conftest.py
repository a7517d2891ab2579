import pytest


@pytest.fixture(scope="session")
def docs_schema():
    return "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward_docs(spark, docs_schema):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"wörd{i % 977}" for i in range(30_000))
    rows = [
        (1, "One two three four five six seven.", "en", "a", 34), (2, None, "en", "a", None), (3, "", None, "a", 0),
        (4, " \t\n ", "en", None, 4), (5, long, "de", "b", len(long)), (6, long, "de", "b", len(long)),
        (None, "no id here at all", "en", "b", 17), (None, "no id here at all", "en", "b", 17),
        (7, "One two three four five six seven.", "en", "a", 34), (7, "One two three four five six seven.", "en", "a", 34),
        (8, "ONE TWO three four", "en", "c", 18), (9, "\x00  <|endoftext|> 東京 🙂 é", None, "c", 3),
    ]
    return spark.createDataFrame(rows, docs_schema)


@pytest.fixture(scope="session")
def no_docs(spark, docs_schema):
    return spark.createDataFrame([], docs_schema)
