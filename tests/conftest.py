import sys
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pitlane.settings import HOT_GROUP_ROWS, PERCENTILE_ROWS, WARP_BLOCK


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def hot(spark):
    """`with hot(n):` treats every group above n rows as hot."""

    @contextmanager
    def limits(rows):
        keys = (HOT_GROUP_ROWS, PERCENTILE_ROWS, WARP_BLOCK)
        for key in keys:
            spark.conf.set(key, rows)
        try:
            yield
        finally:
            for key in keys:
                spark.conf.unset(key)

    return limits
