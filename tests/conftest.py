import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from gridwake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="gridwake-tests")
    yield s


def make_points(spark, rows):
    """rows: (id, seconds or None, lat or None, lon or None)."""
    df = spark.createDataFrame(rows, "id string, s long, lat double, lon double")
    return df.select("id", F.timestamp_seconds("s").alias("dt"), "lat", "lon")


@pytest.fixture
def points(spark):
    return lambda rows: make_points(spark, rows)
