"""Keeping tables current: deduplication, keyed inserts, manifests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklane.operators.firsts import first_per_group
from tracklane.operators.skew import counted


def dedupe_by_key(df: DataFrame, keys, order) -> DataFrame:
    """Keep one row per key, the first along ``order``."""
    return first_per_group(df, keys, order)


def insert_ignore(existing: DataFrame, new: DataFrame, keys, order) -> DataFrame:
    """The rows to append: ``new`` reduced to one row per key, without the keys
    that ``existing`` already has."""
    keys = list(keys)
    fresh, present = dedupe_by_key(new, keys, order), existing.select(*keys)
    # A table stays in place when the batch is small: only its keys that occur in the
    # batch go on to the join.
    batch, small = counted(fresh.select(*keys))
    if small:
        present = present.join(F.broadcast(batch), keys, "left_semi")
    return fresh.join(present, keys, "left_anti").select(*new.columns)


def append_distinct(existing: DataFrame, new: DataFrame) -> DataFrame:
    """New rows as they are, followed by the distinct existing rows."""
    return new.unionByName(existing.distinct())


def check_columns(df: DataFrame, columns) -> DataFrame:
    """Return ``df`` unchanged, or fail when its columns or their order differ."""
    if df.columns != list(columns):
        raise ValueError(f"column order differs: expected {list(columns)}, found {df.columns}")
    return df


def upsert_manifest(manifest: DataFrame, rows: DataFrame, keys, newest: str) -> DataFrame:
    """Replace manifest rows by key and add the keys it lacks.

    ``rows`` wins over ``manifest``; among several rows for one key the one with
    the greatest ``newest`` (text time stamps sort as text) wins.
    """
    both = manifest.withColumn("_rank", F.lit(1)).unionByName(rows.withColumn("_rank", F.lit(0)))
    rest = [c for c in manifest.columns if c != newest]
    window = Window.partitionBy(*keys).orderBy(
        F.col("_rank"), F.col(newest).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rest]
    )
    return (
        both.withColumn("_n", F.row_number().over(window)).where("_n = 1").select(*manifest.columns)
    )


def latest_rows(log: DataFrame, keys, newest) -> DataFrame:
    """The latest row of each key: that with the greatest ``newest`` columns, NULL last, and
    of equal ones the first by the other columns. The first of ``newest`` tells the batch and
    is dropped."""
    rest = [c for c in log.columns if c not in newest]
    window = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in newest], *[F.col(c).asc_nulls_last() for c in rest]
    )
    latest = log.withColumn("_n", F.row_number().over(window)).where("_n = 1")
    return latest.drop("_n", newest[0])


def latest_batches(log: DataFrame, keys, newest) -> DataFrame:
    """All rows that the latest batch has for each key. The first of ``newest`` tells the
    batch and is dropped."""
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in newest])
    latest = log.withColumn("_n", F.rank().over(window)).where("_n = 1")
    return latest.drop("_n", newest[0])


def append_manifest(manifest: DataFrame, rows: DataFrame, **constants) -> DataFrame:
    """Add ``rows`` to the manifest with constant columns (flag, time stamp, url,
    parameters) filled in from keyword arguments."""
    filled = reduce(lambda d, kv: d.withColumn(kv[0], F.lit(kv[1])), constants.items(), rows)
    return manifest.unionByName(filled.select(*manifest.columns))


def pending(source: DataFrame, manifest: DataFrame, key: str, done=None) -> DataFrame:
    """Distinct keys of ``source`` that the manifest does not list as done."""
    listed = manifest if done is None else manifest.where(done)
    return source.select(key).distinct().join(listed.select(key), key, "left_anti")
