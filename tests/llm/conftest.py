import pytest

CLASHING = {"id": "x", "n": "x", "digest": "x", "keys": "x", "score": "x", "n_words": "x", "spans": "x", "row": "x", "component_id": "x", "kept": "x", "words": "x"}


def clash(df):
    """Further columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    return df.withColumns({k: F.lit(v) for k, v in CLASHING.items() if k not in df.columns})


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def doc_rows(pairs, lang="en"):
    return [(i, t, lang, "s", len(t or "")) for i, t in pairs]


LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(60_000)) + " " + "z" * 200_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank, repeated and very long texts."""
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, " \n\t ", "xx", None, 4),
        (4, LONG, "en", "s", len(LONG)),
        (5, "one two", "en", "s", 7),
        (5, "one two", "en", "s", 7),
        (None, "one two", "en", "s", 7),
        (6, "one two", "en", "s", 7),
        (7, "퟿ é 日本 🦄 " * 40, None, "s", 40),
    ]
    return clash(spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return clash(spark.createDataFrame([], DOC_SCHEMA))
