from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def make_session() -> SparkSession:
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tiermill-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def let_go():
    """What a module has cached goes before the next one begins."""
    yield
    session = SparkSession.getActiveSession()
    if session is not None:
        session.catalog.clearCache()
