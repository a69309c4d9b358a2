"""Tracking documents → game, team, player and position tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklane.functions import epoch_ms_text
from tracklane.sources import schemas

SEASON = "2015-2016"
# Validity dates are not known yet and carry this constant.
UNKNOWN_DATE = "1970-01-01"


def _typed(df: DataFrame, ddl: str) -> DataFrame:
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in schemas.columns(ddl)])


def document_heads(docs: DataFrame, *keep: str) -> DataFrame:
    """What the small tables need: ids and the two teams of the first event, plus
    the columns named in ``keep``."""
    first = F.get("events", F.lit(0))
    return docs.select(
        *keep, "gamedate", "gameid", first["home"].alias("home"), first["visitor"].alias("visitor")
    )


def _heads(docs: DataFrame) -> DataFrame:
    return docs if "home" in docs.columns else document_heads(docs)


def _stamped(season: str) -> list[Column]:
    return [
        F.lit(season).alias("season"),
        F.lit(UNKNOWN_DATE).alias("startdate"),
        F.lit(UNKNOWN_DATE).alias("enddate"),
    ]


def flatten_positions(docs: DataFrame, season: str = SEASON) -> DataFrame:
    """One row per event, moment and entity (ball and players)."""
    events = docs.select("gameid", F.explode("events").alias("e"))
    moments = events.select(
        "gameid",
        F.col("e.eventId").alias("eventid"),
        F.posexplode("e.moments").alias("moment_num", "m"),
    )

    def part(i: int) -> Column:
        return F.get("m", F.lit(i)).try_cast("double")

    entities = moments.select(
        "gameid",
        "eventid",
        "moment_num",
        part(0).alias("period"),
        part(1).cast("bigint").alias("timestamp_utc"),
        part(2).alias("periodclock"),
        part(3).alias("shotclock"),
        F.explode(F.from_json(F.get("m", F.lit(5)), "array<array<double>>")).alias("p"),
    )
    names = ("teamid", "playerid", "x_coordinate", "y_coordinate", "z_coordinate")
    rows = entities.select(
        F.lit(season).alias("season"),
        "gameid",
        "eventid",
        "moment_num",
        epoch_ms_text("timestamp_utc").alias("timestamp_dts"),
        "timestamp_utc",
        "period",
        "periodclock",
        "shotclock",
        *[F.get("p", F.lit(i)).alias(n) for i, n in enumerate(names)],
    )
    return _typed(rows, schemas.GAME_POSITION)


def _teams(docs: DataFrame) -> DataFrame:
    return _heads(docs).select("gameid", F.explode(F.array("home", "visitor")).alias("t"))


def flatten_players(docs: DataFrame, season: str = SEASON) -> DataFrame:
    """Both rosters of the first event."""
    players = _teams(docs).select("gameid", "t.teamid", F.explode("t.players").alias("p"))
    return _typed(
        players.select("gameid", "teamid", "p.*", *_stamped(season)), schemas.PLAYER_INFO
    )


def flatten_teams(docs: DataFrame, season: str = SEASON) -> DataFrame:
    """Home and visitor, with the descriptive columns still unknown."""
    unknown = [F.lit(None).alias(n) for n in ("conference", "division", "city", "state")]
    teams = _teams(docs).select("gameid", "t.teamid", "t.name", *unknown, *_stamped(season))
    return _typed(teams, schemas.TEAM_INFO)


def flatten_game(docs: DataFrame, season: str = SEASON) -> DataFrame:
    games = _heads(docs).select(
        F.lit(season).alias("season"),
        "gameid",
        "gamedate",
        F.col("home.teamid").alias("home_teamid"),
        F.col("visitor.teamid").alias("visitor_teamid"),
    )
    return _typed(games, schemas.GAME_INFO)
