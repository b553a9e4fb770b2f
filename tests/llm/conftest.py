import pytest

LOW = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="session")
def documents(spark):
    """Documents with columns whose names clash with those the operators make."""

    def make(rows):
        rows = [(i, t, s) for i, t, *rest in rows for s in (rest or ["a"])]
        schema = "doc_id long, text string, source string, lang string, n_chars long, size long, component_id string, ids string, hash int, key string, id string, n string"
        return spark.createDataFrame([(i, t, s, "en", len(t or ""), 7, "x", "y", 1, "k", "z", "n") for i, t, s in rows], schema)

    return make
