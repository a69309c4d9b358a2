"""Stats responses (result sets with headers) → play-by-play, box score, game log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklane.functions import minutes_text, wall_clock_24h
from tracklane.sources import schemas

SEASON = "2015-16"


def _lowered(headers) -> Column:
    return F.transform(headers, lambda h: F.lower(h))


def game_ids(sets="resultSets") -> Column:
    """The distinct games that the rows of a response's sets name, without NULL."""

    def of_set(s: Column) -> Column:
        at = (F.array_position(_lowered(s["headers"]), F.lit("game_id")) - 1).cast("int")
        return F.transform(s["rowSet"], lambda row: F.get(row, at))

    # a set without rows or headers names none, and NULL would empty the whole list
    found = F.transform(sets, lambda s: F.coalesce(of_set(s), F.array().cast("array<string>")))
    return F.array_compact(F.array_distinct(F.flatten(found)))


def result_sets_to_df(docs: DataFrame, ddl: str, season: str = SEASON) -> DataFrame:
    """All result sets of all documents under one set of columns.

    Columns are matched by lower-cased header; a set that lacks one gives NULL.
    ``result_set`` says where a row comes from. Each set's header positions are
    found once, before its rows are expanded.
    """
    wanted = schemas.columns(ddl)
    hashed = docs.select(F.explode("resultSets").alias("s")).select(
        F.col("s.name").alias("result_set"),
        F.col("s.rowSet").alias("_rows"),
        F.col("s.headers").alias("_headers"),
        F.transform("s.headers", lambda h: F.xxhash64(F.lower(h))).alias("_hashes"),
    )

    # Numbers compare faster than texts, and most columns are missing in most sets: positions
    # are found by hash, and one that holds another text is looked for by the text itself.
    def place(name: str) -> Column:
        at = F.array_position("_hashes", F.xxhash64(F.lit(name)))
        same = F.lower(F.get("_headers", (at - 1).cast("int"))) == F.lit(name)
        by_text = F.array_position(_lowered("_headers"), F.lit(name))
        return (F.when((at == 0) | same, at).otherwise(by_text) - 1).cast("int")

    placed = hashed.select(
        "result_set", "_rows", F.array(*[place(n) for n, _ in wanted]).alias("_at")
    )
    rows = placed.select("result_set", "_at", F.explode("_rows").alias("_row"))

    def value(i: int, kind: str) -> Column:
        text = F.get("_row", F.get("_at", F.lit(i)))
        if kind == "bigint":  # also where a response writes 240 as 240.0
            return F.coalesce(text.try_cast(kind), text.try_cast("double").try_cast(kind))
        return text.try_cast(kind)

    return rows.select(
        *[value(i, kind).alias(name) for i, (name, kind) in enumerate(wanted)],
        F.lit(season).alias("season"),
        "result_set",
    )


def play_by_play(docs: DataFrame, season: str = SEASON, keep_video_row: bool = False) -> DataFrame:
    """Typed play-by-play with 24-hour wall clock.

    A response also carries a one-value video flag set. It shows up as a row
    without game id, which is dropped unless asked for.
    """
    ddl = f"{schemas.PLAY_BY_PLAY}, video_available_flag double"
    rows = result_sets_to_df(docs, ddl, season).drop("result_set")
    if not keep_video_row:
        rows = rows.where(F.col("game_id").isNotNull())
    return rows.withColumn("wctimestring", wall_clock_24h("wctimestring"))


def boxscore(docs: DataFrame, kind: str = "traditional", season: str = SEASON) -> DataFrame:
    """Box score rows of players, teams and starter/bench groups together.

    ``kind`` is ``traditional`` or ``player``. ``min`` becomes ``minutes`` with a
    point for the colon, ``pass`` becomes ``passes``.
    """
    ddl = {"traditional": schemas.BOX_SCORE_TRADITIONAL, "player": schemas.BOX_SCORE_PLAYER}[kind]
    rows = result_sets_to_df(docs, ddl, season).withColumn("min", minutes_text("min"))
    return rows.withColumnsRenamed({"min": "minutes", "pass": "passes"})


def gamelog(docs: DataFrame, season: str = SEASON) -> DataFrame:
    """Two rows per game, one for each team."""
    return result_sets_to_df(docs, schemas.GAME_LOG, season).drop("result_set")
