import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from dimweave.sources import statistics  # noqa: E402
from dimweave.sources.schemas import table_schema  # noqa: E402

statistics.FREQUENT_ROWS = 2  # sketches of small tables name their keys, as those of large ones do


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "8g").config("spark.default.parallelism", "4").config("spark.ui.enabled", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def table(spark):
    """Build a declared table from dictionaries; columns not given are NULL."""
    def build(name, rows=(), schema=None):
        schema = schema or table_schema(name)
        return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)

    return build


@pytest.fixture
def shuffled(monkeypatch):
    """Nothing is broadcast by size and hot keys are taken from all rows, as on large tables."""
    from dimweave.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(joins, "HOT_SAMPLE", 1.0)
    monkeypatch.setattr(joins, "HOT_SHARE", 0.02)
    monkeypatch.setattr(joins, "HOT_SAMPLE_ROWS", 3)
    return joins
