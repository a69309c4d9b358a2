"""Readers. All take explicit schemas: nothing is inferred."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane.functions import path_value
from tracklane.operators.keyed import latest_rows
from tracklane.sources import schemas

CORRUPT = "_corrupt_record"
GAME_PARTITION = ("season", "gameid")
#: Rows of a log tell when they were added; Spark's readers of a table skip this folder of it.
APPENDED, EMPTIED = "_appended", "_emptied"
_EMPTIED_LOG = f"season string, gameid string, emptied boolean, {APPENDED} timestamp"


def read_tracking(spark: SparkSession, path, multiline: bool = True) -> DataFrame:
    """Tracking documents, one JSON object per file, a whole directory at once.

    A file that is not valid JSON becomes a row with its text in
    ``_corrupt_record`` and NULL elsewhere; see ``split_corrupt``. One document is
    read by one task, so games should stay one per file; with
    ``multiline=False`` a file may hold one document per line and is split.
    """
    return _documents(spark, path, schemas.TRACKING_DOCUMENT, multiline)


def read_result_sets(spark: SparkSession, path, multiline: bool = True) -> DataFrame:
    """Stats responses with named result sets (headers and rows)."""
    return _documents(spark, path, schemas.RESULT_SET_DOCUMENT, multiline)


def _documents(spark, path, schema, multiline) -> DataFrame:
    return (
        spark.read.schema(f"{schema}, {CORRUPT} string")
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
        .withColumn("input_filename", F.col("_metadata.file_path"))
    )


def usable(*ids: str) -> Column:
    """The document could be parsed as a whole and has all of the ids."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ids], F.col(CORRUPT).isNull())


def split_corrupt(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good documents, broken ones as file name and text)."""
    bad = docs.where(F.col(CORRUPT).isNotNull()).select("input_filename", CORRUPT)
    return docs.where(F.col(CORRUPT).isNull()).drop(CORRUPT), bad


EVENT_ELEMENT = "_id int, _text string, detail array<struct<_id:int,_text:string,_VALUE:string>>"


def event_elements(elements: DataFrame) -> DataFrame:
    """Parsed <event> elements as (id, text, array of details)."""
    return elements.select(
        F.col("_id").alias("id"),
        F.col("_text").alias("text"),
        F.transform(
            "detail", lambda d: F.struct(d["_id"].alias("id"), d["_text"].alias("text"))
        ).alias("detail"),
    )


def read_event_codes(spark: SparkSession, path) -> DataFrame:
    """Event-code XML: one row per event with an array of details."""
    reader = spark.read.format("xml").option("rowTag", "event").schema(EVENT_ELEMENT)
    return event_elements(reader.load(path))


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of an append-only log; none of the given schema if nothing was ever added."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def emptied_games(spark: SparkSession, path) -> DataFrame:
    """Games (season, gameid) of a table that had rows once and have none now."""
    log = read_log(spark, f"{str(path).rstrip('/')}/{EMPTIED}", _EMPTIED_LOG)
    return latest_rows(log, GAME_PARTITION, [APPENDED]).where("emptied").select(*GAME_PARTITION)


def read_table(spark: SparkSession, path, schema: str) -> DataFrame:
    """A partitioned Parquet table without the games that have become empty. The schema
    also fixes the types of the partition columns, so zero-padded game ids stay text."""
    rows = spark.read.schema(schema).parquet(path)
    if not set(GAME_PARTITION) <= set(rows.columns):
        return rows
    gone = emptied_games(spark, path)
    if not gone.inputFiles():
        return rows
    return rows.join(gone, list(GAME_PARTITION), "left_anti").select(*rows.columns)


def read_csv_table(spark: SparkSession, path, schema: str) -> DataFrame:
    """CSV with a header; an empty field is NULL."""
    return spark.read.schema(schema).csv(path, header=True, nullValue="", emptyValue="")


def file_catalogue(paths: DataFrame, path_col: str) -> DataFrame:
    """Raw game archives among the given paths, with season and game date.

    Keeps keys that contain ``.7z`` and not ``Raw``. The season is the first path
    part, the date comes from ``.../rawdata/MM.dd.yyyy.<teams>``.
    """
    c = F.col(path_col)
    day = F.regexp_extract(c, r"./rawdata/(\d{1,2}\.\d{1,2}\.\d{4})\.[A-Za-z]", 1)
    return paths.where(c.contains(".7z") & ~c.contains("Raw")).select(
        c.alias("filename"),
        F.substring_index(c, "/", 1).alias("season"),
        F.to_date(F.try_to_timestamp(day, F.lit("M.d.yyyy"))).alias("gamedate"),
    )


def partition_keys(paths: DataFrame, path_col: str) -> DataFrame:
    """Season and game id named in ``season=.../gameid=...`` paths."""
    return paths.select(
        path_col,
        path_value(path_col, "season").alias("season"),
        path_value(path_col, "gameid").alias("gameid"),
    )
