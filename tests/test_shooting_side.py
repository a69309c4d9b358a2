from tracklane.plans.shooting_side import (
    first_scored_event,
    game_team_pairs,
    team_period_grid,
    team_shooting_side,
)

PBP = (
    "gameid string, period double, score string, player1_team_id double, pctimestring string, "
    "wctimestring string, eventnum double"
)
POSITIONS = (
    "season string, gameid string, eventid bigint, moment_num bigint, period bigint, "
    "periodclock double, playerid bigint, x_coordinate double"
)
LOG = "season string, gameid string, team_id bigint, team_abbreviation string, game_date string"


def tables(spark):
    pbp = [
        ("1", 1.0, None, 9.0, "12:00", "20:00:00", 0.0),
        # two scores in the same minute: the event number decides
        ("1", 1.0, "4 - 0", 11.0, "11:30", "20:01:00", 3.0),
        ("1", 1.0, "2 - 0", 10.0, "11:40", "20:01:00", 2.0),
        *[("1", float(p), None, 10.0, "1:00", "21:00:00", 10.0 + p) for p in (2, 3, 4, 5)],
        # nearest ball sample lies on the middle line
        ("2", 1.0, "0 - 2", 21.0, "11:00", "20:00:00", 1.0),
        # no score in the first period
        ("3", 1.0, None, 30.0, "11:00", "20:00:00", 1.0),
        ("3", 2.0, "0 - 2", 31.0, "11:00", "20:40:00", 5.0),
    ]
    positions = [
        ("s", "1", 2, 0, 1, 701.0, -1, 80.0),
        ("s", "1", 1, 5, 1, 699.0, -1, 20.0),   # as near, but earlier event
        ("s", "1", 1, 0, 1, 700.0, 77, 80.0),   # not the ball
        ("s", "1", 1, 0, 2, 700.0, -1, 80.0),   # another period
        ("s", "2", 1, 0, 1, 660.0, -1, 47.0),
        ("s", "3", 1, 0, 2, 661.0, -1, 60.0),
    ]
    log = [("s", g, int(g) * 10 + t, f"T{g}{t}", "2015-10-27") for g in "123" for t in (0, 1)]
    return (
        spark.createDataFrame(pbp, PBP),
        spark.createDataFrame(positions, POSITIONS),
        spark.createDataFrame(log, LOG),
    )


def test_first_score(spark, rows):
    pbp, _, _ = tables(spark)
    assert rows(first_scored_event(pbp)) == [("1", 1.0, 10.0, 700), ("2", 1.0, 21.0, 660)]
    assert rows(first_scored_event(pbp, None), "gameid", "period") == [
        ("1", 1.0), ("2", 1.0), ("3", 2.0),
    ]


def test_sides(spark, rows):
    pbp, positions, log = tables(spark)
    df = team_shooting_side(pbp, positions, log, loaded_at="now")
    side = {(r["gameid"], r["teamid"], r["period"]): r["shooting_side"] for r in df.collect()}
    first = {p: side["1", 10, float(p)] for p in range(1, 6)}
    other = {p: side["1", 11, float(p)] for p in range(1, 6)}
    assert first == {1: "left", 2: "left", 3: "right", 4: "right", 5: None}
    assert other == {1: "right", 2: "right", 3: "left", 4: "left", 5: None}
    assert side["2", 20, 1.0] is None and side["3", 31, 2.0] is None
    assert len(side) == 10 + 2 + 4
    assert set(rows(df, "lastupdate_dts", "game_date")) == {("now", "2015-10-27")}


def test_sides_with_any_period_and_band(spark):
    pbp, positions, log = tables(spark)
    df = team_shooting_side(pbp, positions, log, "now", period=None, tolerance=2)
    side = {(r["gameid"], r["teamid"], r["period"]): r["shooting_side"] for r in df.collect()}
    assert side["3", 31, 2.0] == "right" and side["3", 30, 2.0] == "left"
    far = positions.withColumn("periodclock", positions["periodclock"] + 10)
    none = team_shooting_side(pbp, far, log, "now", period=None, tolerance=2)
    assert {r["shooting_side"] for r in none.collect()} == {None}


def test_sides_with_counted_broadcasts(spark, rows, small_groups):
    pbp, positions, log = tables(spark)
    with_probe = rows(team_shooting_side(pbp, positions, log, loaded_at="now"))
    spark.conf.set("tracklane.broadcastBytes", "0")
    try:
        assert with_probe == rows(team_shooting_side(pbp, positions, log, loaded_at="now"))
    finally:
        spark.conf.unset("tracklane.broadcastBytes")


def test_grid_and_pairs(spark, rows):
    pbp, _, log = tables(spark)
    assert len(rows(team_period_grid(pbp, log))) == 16
    assert rows(game_team_pairs(log.unionAll(log), "gameid", "team_abbreviation")) == [
        ("1", "T10", "T11"), ("2", "T20", "T21"), ("3", "T30", "T31"),
    ]


def test_stamp_defaults_to_now(spark):
    from datetime import datetime, timedelta, timezone

    pbp, positions, log = tables(spark)
    stamp = team_shooting_side(pbp, positions, log).head()["lastupdate_dts"]
    then = datetime.strptime(stamp, "%Y-%m-%d %H:%M:%SZ").replace(tzinfo=timezone.utc)
    assert abs(datetime.now(timezone.utc) - then) < timedelta(minutes=5)
