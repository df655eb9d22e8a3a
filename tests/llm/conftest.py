import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text[, lang[, source]]) tuples, with columns of clashing names."""
    def make(rows):
        full = [(*r, *(None,) * (4 - len(r)), "x", 7) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, size string, n long").repartition(3)
    return make
