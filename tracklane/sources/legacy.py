"""Older table layouts: the same rows under different names and types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklane.functions import clock_seconds, score_pair

PRIMARY_KEYS = {
    "play_by_play": ["game_id", "event_id", "event_msg_type", "event_msg_action_type"],
    "box_score_traditional": ["game_id", "player_id"],
    "box_score_player_tracking": ["game_id", "player_id"],
    "games": ["id"],
    "players": ["id", "start_date"],
    "teams": ["id", "start_date"],
    "game_positions": ["game_id", "event_id", "time_stamp", "player_id"],
    "game_possession": ["game_id", "event_id", "time_stamp", "player_id"],
}

_BOX_HEAD = {
    "game_id": "game_id",
    "team_id": "team_id",
    "team_abbreviation": "team_abbreviation",
    "team_city": "team_city",
    "player_id": "player_id",
    "player_name": "player_name",
    "start_position": "start_position",
    "comment": "comment",
    "minutes": "minutes",
}
# Short stats names and the spelled-out legacy names.
_TRADITIONAL = {
    "fgm": "field_goal_made_2",
    "fga": "field_goal_attempts_2",
    "fg_pct": "field_goal_percent_2",
    "fg3m": "field_goal_made_3",
    "fg3a": "field_goal_attempts_3",
    "fg3_pct": "field_goal_percent_3",
    "ftm": "free_throw_made",
    "fta": "free_throw_attempts",
    "ft_pct": "free_throw_percent",
    "oreb": "offensive_rebound",
    "dreb": "defensive_rebound",
    "reb": "total_rebounds",
    "ast": "assists",
    "stl": "steals",
    "blk": "blocks",
    "to": "turnovers",
    "pf": "personal_fouls",
    "pts": "points",
    "plus_minus": "plus_minus",
}
_PLAYER_TRACKING = {
    "spd": "avg_speed_mph",
    "dist": "distance_mph",
    "orbc": "offensive_rebounds_chances",
    "drbc": "defensive_rebounds_chances",
    "rbc": "rebound_chances",
    "tchs": "touches",
    "sast": "secondary_assists",
    "ftast": "free_throw_assists",
    "passes": "passes",
    "ast": "assists",
    "cfgm": "contested_field_goals_made",
    "cfga": "contested_field_goals_attempted",
    "cfg_pct": "contested_field_goals_percent",
    "ufgm": "uncontested_field_goals_made",
    "ufga": "uncontested_field_goals_attempted",
    "ufg_pct": "uncontested_field_goals_percent",
    "fg_pct": "field_goal_percent",
    "dfgm": "field_goals_defended_at_rim_made",
    "dfga": "field_goals_defended_at_rim_attempted",
    "dfg_pct": "field_goals_defended_at_rim_percent",
}

BOX_SCORE_NAMES = {
    "traditional": {**_BOX_HEAD, **_TRADITIONAL},
    "player": {**_BOX_HEAD, **_PLAYER_TRACKING},
}


def legacy_play_by_play(df: DataFrame, wctime_format: str = "HH:mm:ss") -> DataFrame:
    """Play-by-play with the score split in two, the period clock in seconds and
    the wall clock as a timestamp."""
    visitor, home = score_pair("score")

    def whole(name: str, alias: str):
        return F.col(name).cast("int").alias(alias)

    players = []
    for i in (1, 2, 3):
        players += [
            whole(f"person{i}type", f"player{i}_type"),
            whole(f"player{i}_id", f"player{i}_id"),
            F.col(f"player{i}_name"),
            whole(f"player{i}_team_id", f"player{i}_team_id"),
        ]
    return df.select(
        "game_id",
        whole("eventnum", "event_id"),
        whole("eventmsgtype", "event_msg_type"),
        whole("eventmsgactiontype", "event_msg_action_type"),
        whole("period", "period"),
        F.try_to_timestamp("wctimestring", F.lit(wctime_format)).alias("wctimestring"),
        clock_seconds("pctimestring").cast("double").alias("pctimestring"),
        F.col("homedescription").alias("home_description"),
        F.col("neutraldescription").alias("neutral_description"),
        F.col("visitordescription").alias("visitor_description"),
        visitor.cast("double").alias("score_visitor"),
        home.cast("double").alias("score_home"),
        *players,
    )


def legacy_box_scores(df: DataFrame, kind: str = "traditional") -> DataFrame:
    """Box scores with spelled-out names and numeric minutes."""
    names = BOX_SCORE_NAMES[kind]
    return df.select(*[F.col(old).alias(new) for old, new in names.items()]).withColumn(
        "minutes", F.col("minutes").try_cast("double")
    )


def legacy_games(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("gameid").alias("id"),
        F.try_to_timestamp("gamedate").alias("start_time"),
        F.col("home_teamid").alias("home_team_id"),
        F.col("visitor_teamid").alias("visitor_team_id"),
    )


def _validity():
    return [F.to_date("startdate").alias("start_date"), F.to_date("enddate").alias("end_date")]


def legacy_players(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("playerid").alias("id"),
        F.col("lastname").alias("last_name"),
        F.col("firstname").alias("first_name"),
        F.col("teamid").alias("team_id"),
        F.col("jersey").try_cast("int").alias("jersey_number"),
        "position",
        *_validity(),
    )


def legacy_teams(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("teamid").alias("id"),
        "name",
        "conference",
        "division",
        "city",
        "state",
        F.lit(None).cast("int").alias("zipcode"),
        *_validity(),
    )


def legacy_game_positions(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("gameid").alias("game_id"),
        F.col("eventid").alias("event_id"),
        F.timestamp_millis("timestamp_utc").alias("time_stamp"),
        "period",
        F.col("periodclock").alias("period_clock"),
        F.col("shotclock").alias("shot_clock"),
        F.col("teamid").alias("team_id"),
        F.col("playerid").alias("player_id"),
        "x_coordinate",
        "y_coordinate",
        "z_coordinate",
    )


_VIEWS = {
    "play_by_play": legacy_play_by_play,
    "box_score_traditional": legacy_box_scores,
    "box_score_player_tracking": lambda df: legacy_box_scores(df, "player"),
    "games": legacy_games,
    "players": legacy_players,
    "teams": legacy_teams,
    "game_positions": legacy_game_positions,
}


def legacy_view(df: DataFrame, kind: str) -> DataFrame:
    """The legacy layout of one of the tables named in ``PRIMARY_KEYS``."""
    return _VIEWS[kind](df)
