"""Players ranked by distance to the ball, and possession runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklane.operators.keyed import append_distinct
from tracklane.operators.nearest import entity_closest_flag, entity_distance, entity_distance_rank
from tracklane.operators.runs import runs
from tracklane.session import settle

BALL = -1
MOMENT = ["season", "gameid", "eventid", "moment_num"]
XY = ("x_coordinate", "y_coordinate")

CLOSEST_COLUMNS = [
    "eventid",
    "moment_num",
    "timestamp_dts",
    "timestamp_utc",
    "period",
    "periodclock",
    "shotclock",
    "teamid",
    "playerid",
    "x_coordinate",
    "y_coordinate",
    "z_coordinate",
    "distance_from_ball_sq",
    "closest_to_ball_rank",
    "season",
    "gameid",
]


def in_games(df: DataFrame, season=None, game_range=None) -> DataFrame:
    """Rows of one season and an inclusive range of game numbers.

    ``gameid`` is zero-padded text; both conditions stay partition filters.
    """
    if season is not None:
        df = df.where(F.col("season") == season)
    if game_range is not None:
        low, high = game_range
        df = df.where(F.col("gameid").try_cast("bigint").between(int(low), int(high)))
    return df


def ball_distance(positions: DataFrame, season=None, game_range=None, method="window") -> DataFrame:
    return entity_distance(
        in_games(positions, season, game_range),
        MOMENT,
        "playerid",
        BALL,
        XY,
        out="distance_from_ball_sq",
        method=method,
    )


def closest_to_ball(
    positions: DataFrame, season=None, game_range=None, method="window", split_large=True
) -> DataFrame:
    ranked = entity_distance_rank(
        in_games(positions, season, game_range),
        MOMENT,
        "playerid",
        BALL,
        XY,
        tie_break=["playerid"],
        out="distance_from_ball_sq",
        rank="closest_to_ball_rank",
        method=method,
        split_large=split_large,
    )
    return ranked.select(*CLOSEST_COLUMNS)


def closest_flags(positions: DataFrame) -> DataFrame:
    """Distance and closest flag per (game_id, event_id, time_stamp, player_id)."""
    flagged = entity_closest_flag(
        positions.select(
            "game_id", "event_id", "time_stamp", "player_id", "x_coordinate", "y_coordinate"
        ),
        ["game_id", "event_id", "time_stamp"],
        "player_id",
        BALL,
        XY,
        out="distance_to_ball_sq",
        flag="closest_to_ball",
    )
    return flagged.select(
        "game_id", "event_id", "time_stamp", "player_id", "distance_to_ball_sq", "closest_to_ball"
    )


def possession_runs(flags: DataFrame, has_ball_dist_sq: float = 4) -> DataFrame:
    """Runs of moments in which the same player is closest and within reach."""
    held = F.col("closest_to_ball") & (F.col("distance_to_ball_sq") < has_ball_dist_sq)
    found = runs(
        flags,
        ["game_id"],
        ["event_id", "time_stamp", "player_id"],
        "player_id",
        where=held,
        run_length="length_possession",
    )
    return found.select(
        "game_id",
        "event_id",
        "time_stamp",
        "player_id",
        F.col("distance_to_ball_sq").alias("minimum_distance_sq"),
        "length_possession",
    )


def game_possession(positions: DataFrame, has_ball_dist_sq: float = 4) -> DataFrame:
    # Looking for large games reads the rows several times. What the runs need of them,
    # at most some rows per moment, is kept instead of ranking all positions again.
    flags = settle(
        closest_flags(positions).where(
            F.col("closest_to_ball") & (F.col("distance_to_ball_sq") < has_ball_dist_sq)
        )
    )
    return possession_runs(flags, has_ball_dist_sq)


def merge_possession(existing: DataFrame, new: DataFrame) -> DataFrame:
    return append_distinct(existing, new)
