import pytest

#: null and empty texts, white space only, repeated rows, a repeated id, a row without id, accents
ODD = [(1, None), (2, ""), (3, " \t\n "), (4, "été ÉTÉ Été"), (4, "été ÉTÉ Été"), (5, "one"), (5, "two"), (None, "no id here"), (None, None)]


@pytest.fixture(scope="session")
def documents(spark):
    """A table with the given (doc_id, text) rows and columns whose names clash with results."""
    from stallkeeper.llm.common import ship

    ship(spark)

    def make(rows):
        full = [(i, t, "xx", "s", len(t or ""), 1.0, "k", 7) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, score double, key string, size long")

    return make


@pytest.fixture(scope="session")
def odd():
    return list(ODD)
