"""What the physical plans may and may not contain."""

import pytest
from pyspark.sql import functions as F

from tracklane.plans import closest, loads, shooting_side
from tracklane.plans.player_actions import player_actions
from tracklane.sources import readers, schemas, tracking


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    extra = ", season string, gameid string"
    pbp = schemas.PLAY_BY_PLAY.replace("game_id string, ", "") + extra
    found = {}
    for name, schema in {
        "positions": schemas.GAME_POSITION,
        "playbyplay": pbp,
        "codes": schemas.EVENT_CODES,
    }.items():
        path = str(root / name)
        fixed = {"season": "2015-2016", "gameid": "0000000001"}
        row = spark.range(1).select(
            *[F.lit(fixed.get(n)).cast(t).alias(n) for n, t in schemas.columns(schema)]
        )
        (row.write.partitionBy(*fixed) if "gameid" in row.columns else row.write).parquet(path)
        found[name] = readers.read_table(spark, path, schema)
    return found


def test_player_actions_do_not_shuffle_events(tables):
    text = plan(player_actions(tables["playbyplay"], tables["codes"]))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert text.count("FileScan") == 1 and "ExistingRDD[lookup" in text and "Python" not in text


def test_game_range_prunes_partitions(tables):
    text = plan(player_actions(tables["playbyplay"], tables["codes"], "2015-2016", (1, 9)))
    scan = next(x for x in text.splitlines() if "FileScan" in x and "eventnum" in x)
    filters = scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "season" in filters and "try_cast(gameid" in filters


def test_a_short_list_of_games_prunes_partitions(spark, tables):
    games = spark.createDataFrame([("0000000001",), ("0000000007",)], "gameid string")
    listed = loads.only_games(tables["positions"], games)
    scan = next(x for x in plan(listed).splitlines() if "FileScan" in x)
    assert "gameid" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    joined = loads.only_games(tables["positions"], games, list_up_to=1)
    assert "LeftSemi" in plan(joined) and listed.collect() == joined.collect()
    assert loads.only_games(tables["positions"], games.where("false")).count() == 0


def test_shooting_side_reads_only_the_ball_of_one_period(tables):
    text = plan(shooting_side.first_shot_side(tables["playbyplay"], tables["positions"]))
    scan = next(x for x in text.splitlines() if "FileScan" in x and "x_coordinate" in x)
    assert "EqualTo(playerid,-1)" in scan and "EqualTo(period,1)" in scan
    assert "y_coordinate" not in scan and "timestamp" not in scan


def test_possession_reads_few_columns(tables):
    legacy = tables["positions"].select(
        F.col("gameid").alias("game_id"),
        F.col("eventid").alias("event_id"),
        F.col("timestamp_utc").alias("time_stamp"),
        F.col("playerid").alias("player_id"),
        "x_coordinate",
        "y_coordinate",
    )
    # the closest rows are settled: one exchange makes them, another one the runs
    text = plan(closest.game_possession(legacy))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
    text = plan(closest.closest_flags(legacy).where("closest_to_ball"))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
    scan = next(x for x in text.splitlines() if "FileScan" in x)
    assert "z_coordinate" not in scan.split("ReadSchema")[1]


def test_flattening_has_no_exchange(spark, tmp_path):
    (tmp_path / "a.json").write_text("{}")
    docs = readers.read_tracking(spark, str(tmp_path))
    for flatten in (
        tracking.flatten_positions, tracking.flatten_players, tracking.flatten_teams,
        tracking.flatten_game,
    ):
        text = plan(flatten(docs))
        assert "Exchange" not in text and "Python" not in text
