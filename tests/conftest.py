from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lakestrata.session import SETTINGS  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.driver.extraJavaOptions", "-XX:TieredStopAtLevel=1")  # short runs
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """frame('id long, name string', (1, 'a'), ...)"""

    def make(ddl: str, *rows):
        return spark.createDataFrame(list(rows), ddl)

    return make


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, in the column order asked for."""

    def take(df, *columns):
        got = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(got, key=lambda r: tuple((v is not None, str(v)) for v in r))

    return take
