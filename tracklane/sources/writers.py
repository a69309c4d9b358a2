"""Writers for partitioned Parquet tables, CSV and logs.

The state of tables is kept in logs that are only appended to. A manifest is the latest row
of each key of its log; games of a table that have become empty are listed in a log inside
the table's folder, and readers leave them out. So no file is ever deleted or replaced but by
Spark's own overwriting of partitions, and work per game is that of a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane.operators.keyed import check_columns, latest_batches, latest_rows
from tracklane.sources.readers import APPENDED, EMPTIED, GAME_PARTITION, emptied_games, read_log
from tracklane.sources.schemas import (
    DERIVED_MANIFEST,
    STATS_MANIFEST,
    TRACKING_MANIFEST,
    columns,
)

#: What a manifest has one row for; game log manifests keep every row.
MANIFEST_KEYS = {
    TRACKING_MANIFEST: "input_filename", STATS_MANIFEST: "game_id", DERIVED_MANIFEST: "gameid",
}


def _placed(df: DataFrame, partition_by, sort_by) -> DataFrame:
    # Rebalancing brings a partition's rows together but lets adaptive execution
    # cut a large one over several tasks and files, and merge small ones.
    placed = df.hint("rebalance", *[F.col(c) for c in partition_by])
    return placed.sortWithinPartitions(*partition_by, *sort_by) if sort_by else placed


def write_table(
    df: DataFrame,
    path: str,
    partition_by=GAME_PARTITION,
    sort_by=(),
    mode: str = "overwrite",
    rebalance: bool = True,
) -> None:
    """Write snappy Parquet by partition. Overwriting replaces only the partitions
    present in ``df``: re-running a game replaces that game.

    ``rebalance=False`` saves the shuffle where tasks already hold whole partitions.
    """
    placed = _placed(df, partition_by, sort_by) if rebalance else df
    (
        placed.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def create_table_as(df: DataFrame, name: str, path: str, partition_by=GAME_PARTITION) -> None:
    """Create an external partitioned Parquet table unless it exists already."""
    (
        _placed(df, partition_by, ())
        .write.format("parquet")
        .mode("ignore")
        .option("path", path)
        .option("compression", "snappy")
        .partitionBy(*partition_by)
        .saveAsTable(name)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def append_log(rows: DataFrame, path: str) -> None:
    """Add rows to a log: a Parquet table that is only ever appended to, with the time at
    which each batch was added. A batch that was not committed leaves nothing to read."""
    stamped = rows.withColumn(APPENDED, F.current_timestamp())
    stamped.write.mode("append").option("compression", "snappy").parquet(path)


def record(rows: DataFrame, path: str, schema: str) -> None:
    """Add rows to the log of a manifest."""
    names = [n for n, _ in columns(schema)]
    log = read_log(rows.sparkSession, path, schema)
    check_columns(log.drop(APPENDED), names)
    append_log(check_columns(rows, names), path)


def mark_emptied(path: str, asked: DataFrame, made: DataFrame) -> None:
    """Record which of the games (season, gameid) that were asked for have no rows any more;
    ``read_table`` leaves them out. Games that have rows again lose their mark."""
    keys = list(GAME_PARTITION)
    marks = emptied_games(asked.sparkSession, path)
    empty = asked.join(made, keys, "left_anti").select(*keys, F.lit(True).alias("emptied"))
    again = made.join(marks, keys, "left_semi").select(*keys, F.lit(False).alias("emptied"))
    append_log(empty.unionByName(again), f"{path.rstrip('/')}/{EMPTIED}")


def load_manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The manifest that the log at ``path`` amounts to: the latest row of each key, the latest
    load's rows of each tracking file, or all rows where a manifest has no key; empty if there is no log. Fails when the columns differ."""
    names = [n for n, _ in columns(schema)]
    log = read_log(spark, path, schema)
    if APPENDED not in log.columns:
        log = log.withColumn(APPENDED, F.lit(None).cast("timestamp"))
    check_columns(log.drop(APPENDED), names)
    if schema == TRACKING_MANIFEST:
        # a file of many documents has many rows
        return latest_batches(log, [MANIFEST_KEYS[schema]], [APPENDED, "lastuploadDTS"])
    key = MANIFEST_KEYS.get(schema)
    return latest_rows(log, [key], [APPENDED, "lastuploadDTS"]) if key else log.drop(APPENDED)
