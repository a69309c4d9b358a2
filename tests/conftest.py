import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tracklane.operators import skew  # noqa: E402
from tracklane.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def small_groups(spark):
    """Treat every key with more than 40 rows as hot."""
    spark.conf.set(skew.HOT_ROWS_KEY, "40")
    yield
    spark.conf.unset(skew.HOT_ROWS_KEY)


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, NULL first."""

    def collect(df, *names):
        picked = df.select(*names) if names else df
        return sorted(
            (tuple(r) for r in picked.collect()),
            key=lambda t: tuple((v is not None, v) for v in t),
        )

    return collect
