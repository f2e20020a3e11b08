import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    """Make a documents table from (doc_id, text) or (doc_id, text, source) rows, with a clashing extra column."""
    def make(rows):
        full = [(*r, *([None] * (3 - len(r))), 7) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, source string, n long")
    return make
