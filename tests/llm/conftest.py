import pytest


@pytest.fixture(scope="session")
def make(spark):
    """A documents table of (doc_id, text, source) rows, with extra columns whose names the operators use themselves."""

    def build(rows, extra=True):
        full = [(i, t, "en", s, None if t is None else len(t), "x", 1, True, "y") for i, t, s in rows]
        schema = (
            "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, n int, kept boolean, "
            "digest string"
        )
        df = spark.createDataFrame(full, schema)
        return df if extra else df.drop("fp", "n", "kept", "digest")

    return build


@pytest.fixture(scope="session")
def odd(make):
    """Nulls in any column, empty and very long texts, ties, and repeated rows."""
    long = "word other thing " * 20_000 + "one-long-token" * 5_000
    rows = [
        (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, long, "b"), (5, "same text here now", "b"),
        (6, "same text here now", "b"), (7, "repeated row", "b"), (7, "repeated row", "b"), (7, "other text", "b"),
        (None, "no id", "a"), (None, None, None), (8, "é😀 " * 30 + "\x00", "a"),
    ]
    return make(rows)
