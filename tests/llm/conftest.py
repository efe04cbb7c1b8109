"""Fixtures of the training-data operators: small tables with awkward rows."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from a list of texts (ids from 0) or of (doc_id, text)."""
    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts, strict=True)], DOCS)
    return make


@pytest.fixture(scope="session")
def documents(spark):
    import duckdb
    rows = duckdb.connect().execute(
        "select doc_id, text from read_parquet('/root/testdata/sf0.001/documents.parquet') order by doc_id").fetchall()
    return rows
