import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents of (doc_id, text) pairs, over three partitions."""

    def make(rows):
        rows = [(i, t, "en", "src0", len(t or "")) for i, t in rows]
        return spark.createDataFrame(rows, DOCS).repartition(3)

    return make
