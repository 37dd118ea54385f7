import duckdb
import pytest

from fieldmart.llm import catalog
from fieldmart.llm.common import Scratch


@pytest.fixture
def scratch(spark):
    made = Scratch(spark, "test")
    yield made
    made.drop()


@pytest.fixture
def documents(spark):
    """Documents out of (doc_id, text) pairs, over three partitions."""

    def make(rows, partitions=3):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, schema).repartition(partitions)

    return make


@pytest.fixture
def clash(documents):
    """The same documents with extra columns named like those the operators make."""

    def make(rows, *names):
        from pyspark.sql import functions as F

        return documents(rows).withColumns({n: F.lit("x") for n in names})

    return make


@pytest.fixture
def test_tables(spark, sf_dir):
    return lambda name: catalog.table(spark, sf_dir, name)


@pytest.fixture(scope="session")
def plain_duck():
    return duckdb.connect()
