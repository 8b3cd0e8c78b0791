from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ridelake.session import tuned  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
    )
    session = tuned(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """rows(schema, *tuples) -> DataFrame."""

    def make(schema, *data):
        return spark.createDataFrame(list(data), schema)

    return make


@pytest.fixture
def value(spark):
    """value(x, kind, f): f applied to one value of SQL type `kind`."""

    def make(x, kind, f):
        from pyspark.sql import functions as F

        return spark.createDataFrame([(x,)], f"x {kind}").select(f(F.col("x"))).first()[0]

    return make
