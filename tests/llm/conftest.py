import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table (doc_id, text, lang, source) from rows that may stop early."""

    def make(rows):
        return spark.createDataFrame([(*row, None, None)[:4] for row in rows], "doc_id long, text string, lang string, source string")

    return make
