import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with the other columns filled."""

    def make(rows, **columns):
        full = [(i, t, columns.get("lang", "en"), "src0", len(t or "")) for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return make
