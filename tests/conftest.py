import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Small literal frame: ``frame("k string, v double", rows)``."""

    def make(schema, rows):
        return spark.createDataFrame([tuple(r) for r in rows], schema)

    return make


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as sorted tuples."""

    def get(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(x) for x in picked.collect()), key=repr)

    return get
