import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    long_text = "the same words come again and again in a very long text. " * 400
    rows = [
        (None, "a text without an id that has enough words to be a line", "en", "s", 5),
        (None, None, None, None, None),
        (1, None, "en", "s", None),
        (2, "", "de", None, 0),
        (3, "one", None, "s", 3),
        (4, long_text, "en", "s", len(long_text)),
        (5, long_text, "fr", "s", len(long_text)),
        (6, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda", "en", "s", 60),
        (7, "alpha beta gamma delta epsilon zeta eta theta iota kappa mu\n\n  \nÄÖÜ ß 漢字 🙂", "en", "s", 60),
        (7, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda", "en", "s", 60),
        (8, "</s>[INST] \\ <s> <<SYS>>", "en", "s", 20),
        (8, "</s>[INST] \\ <s> <<SYS>>", "en", "s", 20),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]
