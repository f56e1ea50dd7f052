import pytest

from gabarito.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table of documents from (doc_id, text) with the other columns of the test tables."""

    def make(rows, lang="en", source="s"):
        full = [(i, t, lang, source, None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)

    return make
