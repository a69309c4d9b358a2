"""Which end of the court each team shoots at, per period.

The side comes from the ball's position when the first points of a game fall. The
scoring team shoots there in the first half and changes ends after it; the other
team does the opposite. Overtime periods have no side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklane.functions import clock_seconds, court_side
from tracklane.operators.firsts import first_per_group, nearest_in_group
from tracklane.operators.skew import bounded_broadcast

BALL = -1


def first_scored_event(playbyplay: DataFrame, period: int | None = 1) -> DataFrame:
    """First row with a score per game (and period), by wall clock.

    ``period=None`` looks at the whole game and keeps the period it finds.
    """
    scored = playbyplay.where(F.col("score").isNotNull())
    if period is not None:
        scored = scored.where(F.col("period") == period)
    group = ["gameid"] if period is None else ["gameid", "period"]
    first = first_per_group(
        scored.select(
            "gameid",
            "period",
            "wctimestring",
            "eventnum",
            F.col("player1_team_id").alias("teamid"),
            clock_seconds("pctimestring").alias("periodclock"),
        ),
        group,
        ["wctimestring", "eventnum"],
    )
    return first.select("gameid", "period", "teamid", "periodclock")


def first_shot_side(
    playbyplay: DataFrame,
    positions: DataFrame,
    period: int | None = 1,
    tolerance: float | None = None,
) -> DataFrame:
    """Side of the ball at the position sample nearest to the first score."""
    first = first_scored_event(playbyplay, period).select(
        "gameid", "period", "teamid", F.col("periodclock").alias("score_clock")
    )
    ball = positions.where(F.col("playerid") == BALL)
    if period is not None:
        ball = ball.where(F.col("period") == period)
    ball = ball.select(
        "season", "gameid", "period", "periodclock", "eventid", "moment_num", "x_coordinate"
    )
    near = nearest_in_group(
        first,
        ball,
        ["gameid", "period"],
        "score_clock",
        "periodclock",
        ["season", "gameid", "teamid"],
        ["eventid", "moment_num"],
        tolerance,
    )
    return near.select(
        "season", "gameid", "teamid", court_side("x_coordinate").alias("shooting_side")
    )


def team_period_grid(playbyplay: DataFrame, gamelog: DataFrame) -> DataFrame:
    """Distinct (game, period, team). Both inputs shrink before they meet."""
    periods = playbyplay.select("gameid", "period").distinct()
    teams = gamelog.select("gameid", F.col("team_id").alias("teamid")).distinct()
    return periods.join(teams, "gameid").select("gameid", "period", "teamid")


def team_shooting_side(
    playbyplay: DataFrame,
    positions: DataFrame,
    gamelog: DataFrame,
    loaded_at: str | None = None,
    period: int | None = 1,
    tolerance: float | None = None,
) -> DataFrame:
    """Side per team and period of every game.

    ``loaded_at`` fixes the load stamp; without it the current time (UTC) is used.
    """
    side = first_shot_side(playbyplay, positions, period, tolerance).select(
        "gameid", F.col("teamid").alias("first_team"), F.col("shooting_side").alias("first_side")
    )
    grid = team_period_grid(playbyplay, gamelog)
    # Few columns and one row per game and team: the join below stays narrow.
    games = gamelog.select(
        F.col("gameid").alias("log_gameid"),
        F.col("team_id").alias("log_team"),
        "game_date",
        "team_abbreviation",
        "season",
    )
    joined = grid.join(bounded_broadcast(side), "gameid", "left").join(
        games,
        (F.col("gameid") == F.col("log_gameid")) & (F.col("teamid") == F.col("log_team")),
        "left",
    )
    other_side = F.when(F.col("first_side") == "left", "right").when(
        F.col("first_side") == "right", "left"
    )
    # Same end as the first score: that team before the break, the other after it.
    same_team = F.col("teamid") == F.col("first_team")
    first_half, second_half = F.col("period").isin(1, 2), F.col("period").isin(3, 4)
    same_end = (same_team & first_half) | (~same_team & second_half)
    other_end = (same_team & second_half) | (~same_team & first_half)
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    stamp = F.date_format(now, "yyyy-MM-dd HH:mm:ss'Z'") if loaded_at is None else F.lit(loaded_at)
    return joined.select(
        "game_date",
        "teamid",
        "team_abbreviation",
        "period",
        F.when(same_end, F.col("first_side")).when(other_end, other_side).alias("shooting_side"),
        stamp.alias("lastupdate_dts"),
        "season",
        F.col("log_gameid").alias("gameid"),
    )


def game_team_pairs(rows: DataFrame, game: str, code: str, where=None) -> DataFrame:
    """The first two distinct team codes of each game, in alphabetical order."""
    data = rows if where is None else rows.where(where)
    codes = data.select(game, F.col(code).alias("_code")).dropna().distinct()
    number = F.row_number().over(Window.partitionBy(game).orderBy("_code"))
    return (
        codes.withColumn("_n", number)
        .where("_n <= 2")
        .groupBy(game)
        .agg(
            F.max(F.when(F.col("_n") == 1, F.col("_code"))).alias("team1"),
            F.max(F.when(F.col("_n") == 2, F.col("_code"))).alias("team2"),
        )
    )
