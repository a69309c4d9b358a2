"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_points
from checks import compare
from checks.queries import QUERIES as OWN

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")
QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(OWN) <= set(SQL) <= set(QUERIES)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[-2:] == ["season", "gameid"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(OWN))
def test_query(spark, con, name):
    ok, text = compare.compare(spark, con, QUERIES[name], SQL[name], SF_DIR)
    assert ok, text


# With these settings every group counts as large, so the same queries also go
# through the chunked forms and the counted broadcasts.
@pytest.mark.parametrize(
    "name",
    ["entity_distance", "closest_to_ball", "closest_flag", "possession_runs", "game_possession",
     "nearest_in_time", "team_shooting_side", "player_actions_all"],
)
def test_query_with_large_groups(spark, con, name):
    spark.conf.set("tracklane.skew.hotRows", "3")
    try:
        ok, text = compare.compare(spark, con, QUERIES[name], SQL[name], SF_DIR)
    finally:
        spark.conf.unset("tracklane.skew.hotRows")
    assert ok, text
