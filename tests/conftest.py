import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from fieldmart.session import settings

    builder = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
    for key, value in settings(8).items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck(sf_dir):
    from checks.compare import connect

    return connect(sf_dir)


def rows(df):
    """Sorted rows, for comparing multisets."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
