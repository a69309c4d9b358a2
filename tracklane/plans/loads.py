"""Loads: landed documents → partitioned tables, and base tables → derived ones.

Each load handles all games at once. Broken documents do not stop it; they are
returned and flagged in the manifest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane.functions import matchup_teams, season_long
from tracklane.operators.firsts import first_per_group
from tracklane.operators.keyed import (
    append_distinct,
    append_manifest,
    insert_ignore,
    pending,
)
from tracklane.operators.skew import bounded_broadcast, hot_keys
from tracklane.plans.closest import closest_to_ball, in_games
from tracklane.plans.shooting_side import game_team_pairs
from tracklane.session import settle
from tracklane.sources import result_sets, schemas, tracking
from tracklane.sources.readers import (
    CORRUPT,
    read_csv_table,
    read_result_sets,
    read_table,
    read_tracking,
    usable,
)
from tracklane.sources.writers import (
    load_manifest,
    mark_emptied,
    record,
    write_table,
)

_TABLES = ("gameinfo", "gameposition", "playerinfo", "teaminfo")


def load_tracking(
    spark: SparkSession,
    source: str,
    target: str,
    manifest_path: str,
    loaded_at: str,
    season: str = tracking.SEASON,
    multiline: bool = True,
) -> DataFrame:
    """Tracking documents → gameinfo, gameposition, playerinfo, teaminfo.

    Returns the documents that could not be parsed as a whole or have no game id;
    they write no rows and are flagged 0. The documents are read twice:
    once for their short heads, from which the small tables are made, and once for
    the positions. With one document per file a task holds whole games, and the
    positions are written without a shuffle.
    """
    docs = read_tracking(spark, source, multiline)
    heads = settle(tracking.document_heads(docs, "input_filename", CORRUPT))
    fit = usable("gameid")
    good = heads.where(fit).drop(CORRUPT)
    positions = tracking.flatten_positions(docs.where(fit), season)
    write_table(positions, f"{target}/gameposition", rebalance=not multiline)
    write_table(tracking.flatten_game(good, season), f"{target}/gameinfo")
    write_table(tracking.flatten_players(good, season), f"{target}/playerinfo")
    write_table(tracking.flatten_teams(good, season), f"{target}/teaminfo")

    flag = F.when(fit, 1).otherwise(0)
    rows = heads.select(
        "input_filename",
        "gameid",
        *[flag.alias(f"{t}_uploadedFLG") for t in _TABLES],
        F.lit(loaded_at).alias("lastuploadDTS"),
    )
    record(rows, manifest_path, schemas.TRACKING_MANIFEST)
    return heads.where(~fit).select("input_filename", CORRUPT)


def _broken(docs: DataFrame) -> DataFrame:
    """Responses that could not be parsed as a whole: file name and text. All columns are
    read, as Spark only notices what is wrong in columns that it reads."""
    return settle(docs.where(~usable())).select("input_filename", CORRUPT)


def _as_game_table(df: DataFrame) -> DataFrame:
    """Stats responses say game_id and a short season; tables are laid out by
    gameid and the long season."""
    return df.withColumnRenamed("game_id", "gameid").withColumn("season", season_long("season"))


def load_gamelog(
    spark: SparkSession,
    source: str,
    target: str,
    manifest_path: str,
    loaded_at: str,
    season: str = result_sets.SEASON,
    base_url: str = "",
    params: str = "",
) -> DataFrame:
    """Game log responses → gamelog, with one manifest row per game and team.

    Returns the responses that could not be parsed as a whole; they write no rows, and
    each adds a manifest row without a game and with flag 0.
    """
    docs = read_result_sets(spark, source)
    log = result_sets.gamelog(docs.where(usable()), season)
    log = log.where(F.col("game_id").isNotNull())
    write_table(_as_game_table(log), f"{target}/gamelog")
    broken = _broken(docs)
    constants = {"lastuploadDTS": loaded_at, "base_url": base_url, "params": params}
    failed = broken.select(
        F.lit(season).alias("season"),
        *[F.lit(None).cast("string").alias(c) for c in ("game_date", "game_id", "team1", "team2")],
    )
    rows = spark.createDataFrame([], schemas.GAME_LOG_MANIFEST)
    rows = append_manifest(rows, gamelog_manifest_rows(log), gamelog_uploadedFLG=1, **constants)
    rows = append_manifest(rows, failed, gamelog_uploadedFLG=0, **constants)
    record(rows, manifest_path, schemas.GAME_LOG_MANIFEST)
    return broken


def gamelog_manifest_rows(log: DataFrame) -> DataFrame:
    """One row per game and team with the game's two teams, the same in both rows: those
    of its ``visitor @ home`` line, or of its first line in text order if it has none."""
    first = F.min(F.struct(~F.contains("matchup", F.lit("@")), F.col("matchup")))["matchup"]
    pairs = log.groupBy("game_id").agg(first.alias("pair"))
    team1, team2 = matchup_teams("pair")
    return log.select("season", "game_date", "game_id").join(
        pairs.select("game_id", team1.alias("team1"), team2.alias("team2")), "game_id"
    ).select("season", "game_date", "game_id", "team1", "team2")


def games_between(gamelog_manifest: DataFrame, start=None, end=None) -> DataFrame:
    """One row per game with a date in the range; open ends mean all dates.

    Dates are ISO text, which compares as text.
    """
    games = first_per_group(
        gamelog_manifest.select("season", "game_date", "game_id", "team1", "team2"),
        ["game_id"],
        ["game_date", "team1", "team2"],
    )
    if start is not None:
        games = games.where(F.col("game_date") >= start)
    if end is not None:
        games = games.where(F.col("game_date") <= end)
    return games


def season_bounds(gamelog: DataFrame) -> DataFrame:
    """First and last game date per season, printed MM/DD/YYYY."""
    us = "MM/dd/yyyy"
    return gamelog.groupBy("season").agg(
        F.date_format(F.min(F.to_date("game_date")), us).alias("first_date"),
        F.date_format(F.max(F.to_date("game_date")), us).alias("last_date"),
    )


def load_stats(
    spark: SparkSession,
    source: str,
    target: str,
    kind: str,
    games: DataFrame,
    manifest_path: str,
    loaded_at: str,
    season: str = result_sets.SEASON,
    base_url: str = "",
    params: str = "",
    multiline: bool = True,
) -> DataFrame:
    """Stats responses of one kind → its table. Returns the responses that could not be
    parsed as a whole; they write no rows.

    ``kind`` is playbyplay, boxscore_traditional or boxscore_player. ``games``
    (see ``games_between``) names the games to load and fills the manifest; a game
    without a usable response is flagged 0. The responses are read twice: once for the
    games that they name and what is broken, and once for their rows.
    """
    docs = read_result_sets(spark, source, multiline)
    # All columns are read, as Spark only notices what is wrong in columns that it reads.
    heads = settle(docs.select(
        "input_filename", CORRUPT, F.isnull("resource"),
        F.when(usable(), result_sets.game_ids()).alias("game_ids"),
    ))
    good = docs.where(usable())
    if kind == "playbyplay":
        rows = result_sets.play_by_play(good, season)
    else:
        rows = result_sets.boxscore(good, kind.removeprefix("boxscore_"), season)
    rows = rows.where(F.col("game_id").isNotNull())
    rows = rows.join(games.select("game_id"), "game_id", "left_semi")
    write_table(_as_game_table(rows), f"{target}/{kind}")

    named = heads.select(F.explode("game_ids").alias("game_id")).distinct()
    present = named.withColumn("_found", F.lit(1))
    done = games.join(present, "game_id", "left").select(
        "season",
        "game_date",
        "game_id",
        "team1",
        "team2",
        F.coalesce("_found", F.lit(0)).alias("fileuploadedFLG"),
        F.lit(loaded_at).alias("lastuploadDTS"),
        F.lit(base_url).alias("base_url"),
        F.lit(params).alias("params"),
    )
    record(done, manifest_path, schemas.STATS_MANIFEST)
    return heads.where(~usable()).select("input_filename", CORRUPT)


def insert_csv(
    spark: SparkSession, csv: str, table: str, schema: str, keys, order, partition_by=()
) -> None:
    """Append the CSV rows whose primary key the Parquet table does not have yet,
    one row per key."""
    new = read_csv_table(spark, csv, schema)
    existing = read_table(spark, table, schema)
    rows = insert_ignore(existing, new, keys, order)
    writer = rows.write.mode("append").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(table)


def append_csv_distinct(spark: SparkSession, csv: str, table: str, schema: str, target: str) -> None:
    """For tables without a key: the distinct rows of the table and the CSV rows,
    written as a new version of the table to ``target``."""
    new = read_csv_table(spark, csv, schema)
    rows = append_distinct(read_table(spark, table, schema), new)
    rows.write.mode("errorifexists").option("compression", "snappy").parquet(target)


def refresh_derived(
    derived: DataFrame,
    target: str,
    manifest_path: str,
    loaded_at: str,
    params: str = "",
    rebalance: bool = True,
    games: DataFrame | None = None,
) -> None:
    """Write a derived table (closest to ball, player actions, shooting side) for
    the games it holds and record them. Existing data of those games is replaced.

    ``games`` (season, gameid) names the games that were asked for; it may come straight
    from a partitioned base table. A game of these without rows is recorded like the
    others, and ``read_table`` leaves out the rows that it had before.
    """
    write_table(derived, target, rebalance=rebalance)
    made = settle(derived.select("season", "gameid").distinct())
    if games is None:
        mark_emptied(target, made, made)
    else:
        asked = settle(games.select("season", "gameid").distinct())
        mark_emptied(target, asked, made)
        made = asked
    rows = made.select(
        "season",
        "gameid",
        F.lit(params).alias("params"),
        F.lit(1).alias("uploadedFLG"),
        F.lit(loaded_at).alias("lastuploadDTS"),
    )
    record(rows, manifest_path, schemas.DERIVED_MANIFEST)


def only_games(rows: DataFrame, games: DataFrame, list_up_to: int = 1000) -> DataFrame:
    """Rows of the given games. A short list becomes a filter, so that a partitioned
    table is read only where those games lie; a long one becomes a join."""
    wanted = games.select("gameid").distinct()
    ids = [r["gameid"] for r in wanted.limit(list_up_to + 1).collect()]
    if len(ids) <= list_up_to:
        return rows.where(F.col("gameid").isin(ids))
    return rows.join(bounded_broadcast(wanted), "gameid", "left_semi").select(*rows.columns)


def refresh_closest_to_ball(
    positions: DataFrame,
    target: str,
    manifest_path: str,
    loaded_at: str,
    season=None,
    game_range=None,
    pending_only: bool = False,
) -> None:
    """Rank the positions of the given (or of all not yet recorded) games and write
    them by game.

    Unless some game is too large for one task, rows are brought together by game:
    that one exchange serves the ranking and the write.
    """
    rows = in_games(positions, season, game_range)
    if pending_only:
        manifest = load_manifest(positions.sparkSession, manifest_path, schemas.DERIVED_MANIFEST)
        todo = pending(rows, manifest, "gameid", done=F.col("uploadedFLG") == 1)
        rows = only_games(rows, todo)
    whole_games = hot_keys(rows, ["season", "gameid"]) is None
    by_game = rows.repartition("season", "gameid") if whole_games else rows
    ranked = closest_to_ball(by_game, split_large=not whole_games)
    refresh_derived(
        ranked, target, manifest_path, loaded_at, rebalance=not whole_games, games=rows
    )


def shooting_side_manifest(sides: DataFrame, loaded_at: str) -> DataFrame:
    """One manifest row per game of a shooting-side table, with both team codes."""
    pairs = game_team_pairs(sides, "gameid", "team_abbreviation", where="period = 1")
    games = first_per_group(
        sides.where("period = 1").select("season", "gameid", "game_date"),
        ["gameid"],
        ["season", "game_date"],
    )
    return games.join(pairs, "gameid").select(
        "season",
        "gameid",
        F.replace("game_date", F.lit("-"), F.lit("")).alias("gamedate"),
        F.col("team1").alias("teamid1"),
        F.col("team2").alias("teamid2"),
        F.lit(1).alias("uploadedFLG"),
        F.lit(loaded_at).alias("lastuploadDTS"),
    )
