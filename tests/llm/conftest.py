import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table of (doc_id, text) with a clashing extra column; texts may be None."""

    def make(rows):
        return spark.createDataFrame([(i, t, "x", 1.0) for i, t in rows], "doc_id bigint, text string, spans string, score double")

    return make
