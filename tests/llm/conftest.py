import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Rows (doc_id, text) as documents, with the other columns and one more whose name clashes with an inner one."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "src0", len(t or ""), "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, n_words string")

    return make
