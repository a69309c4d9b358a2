"""Ordered work over groups that may be too large for one task.

A window function keeps a whole group in one task. That is right for the usual
group (a moment has eleven rows, a game some hundred thousand) and wrong when one
key holds a large share of the table. The functions here find such keys and cut
their rows into chunks that follow the requested order, so that ranking and run
detection work per chunk and only one summary row per chunk meets in one task.

Nothing here changes a result: a chunk holds all rows between two places of the
order, wherever the border is, and borders are fixed before they are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklane.session import settle

# A key is hot when it holds more rows than this.
HOT_ROWS_KEY, HOT_ROWS = "tracklane.skew.hotRows", 5_000_000
# Small frames are broadcast only up to this many bytes.
BROADCAST_BYTES_KEY, BROADCAST_BYTES = "tracklane.broadcastBytes", 16 << 20
# Buckets of the first count of hot_keys, which rules out most keys.
_BUCKETS = 8192
# Rows drawn per chunk to find the borders between chunks.
_DRAWN = 128


def asc(columns) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def has_values(columns) -> Column:
    """All of the columns are set. Written out so that the scan can use it."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _setting(df: DataFrame, key: str, default: int) -> int:
    return int(df.sparkSession.conf.get(key, str(default)))


def counted(df: DataFrame) -> tuple[DataFrame, bool]:
    """``df`` computed once, and whether it is small enough to broadcast. Its size is
    measured, as JSON text, and not estimated."""
    done = settle(df)
    size = F.sum(F.length(F.to_json(F.struct("*"))).cast("bigint"))
    most = _setting(df, BROADCAST_BYTES_KEY, BROADCAST_BYTES)
    return done, (done.agg(size).first()[0] or 0) <= most


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """A derived frame, computed once and marked for broadcast if its size is within
    the bound; a larger one is returned unmarked and joins by shuffle."""
    done, small = counted(df)
    return F.broadcast(done) if small else done


def fits_one_task(df: DataFrame) -> bool:
    """The frame has no more rows than one key may have."""
    return df.count() <= _setting(df, HOT_ROWS_KEY, HOT_ROWS)


def hot_keys(df: DataFrame, keys) -> DataFrame | None:
    """Keys that hold so many rows that one task should not take them alone.

    A frame with no more rows than a key may have has no such key, and counting rows is
    all that is done for it; over a stored table that reads no column. In others rows
    are counted by a small hash of the key, which needs no shuffle worth mentioning and
    rules out nearly all keys: a hot key makes its bucket large. Only the keys in large
    buckets are then counted one by one. NULL keys are left out. None means there is no
    such key.
    """
    least = _setting(df, HOT_ROWS_KEY, HOT_ROWS)
    if fits_one_task(df):
        return None
    bucket = F.pmod(F.xxhash64(*keys), F.lit(_BUCKETS)).cast("int")
    bucketed = df.where(has_values(keys)).select(*keys, bucket.alias("_bucket"))
    sizes = bucketed.groupBy("_bucket").count().where(F.col("count") > least)
    large = [r[0] for r in sizes.collect()]
    if not large:
        return None
    hot = settle(
        bucketed.where(F.col("_bucket").isin(large))
        .groupBy(*keys)
        .count()
        .where(F.col("count") > least)
        .select(*keys)
    )
    return None if hot.isEmpty() else hot


def split_hot(df: DataFrame, keys, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot keys). ``hot`` comes from ``hot_keys``."""
    hot = bounded_broadcast(hot)
    return df.join(hot, list(keys), "left_anti"), df.join(hot, list(keys), "left_semi")


def _place(df: DataFrame, keys, order) -> Column:
    """The order columns, NULL last, as one comparable value. The other columns follow,
    so that rows which tie in the order can still be told apart."""
    skipped = {*keys, *order}
    orderable = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    rest = [c for c in orderable if c not in skipped]
    parts = []
    for i, name in enumerate([*order, *rest]):
        parts += [F.col(name).isNull().alias(f"n{i}"), F.col(name).alias(f"v{i}")]
    return F.struct(*parts)


def _borders(df: DataFrame, keys, place: Column) -> DataFrame:
    """Per key a sorted array of places that cut its rows into chunks of about half the
    limit. They are quantiles of drawn rows, settled once: they decide which task a row
    goes to, not what comes out."""
    half = max(1, _setting(df, HOT_ROWS_KEY, HOT_ROWS) // 2)
    share = min(1.0, _DRAWN / half)
    drawn = df.select(*keys, place.alias("_place"))
    drawn = drawn if share == 1.0 else drawn.sample(share, seed=17)
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("_place"))
    cuts = drawn.withColumn("_n", number).where(F.col("_n") % max(1, round(share * half)) == 0)
    return cuts.groupBy(*keys).agg(F.sort_array(F.collect_set("_place")).alias("_borders"))


def _chunk(borders: Column, place: Column) -> Column:
    """How many borders are not after the place: blocks of borders first, then one block."""
    width = F.ceil(F.sqrt(F.size(borders))).cast("int")

    def not_after(some: Column) -> Column:
        return F.size(F.filter(some, lambda b: b <= place))

    blocks = F.ceil(F.size(borders) / width).cast("int")
    firsts = F.transform(F.sequence(F.lit(0), blocks - 1), lambda i: F.get(borders, i * width))
    block = F.greatest(not_after(firsts) - 1, F.lit(0))
    return block * width + not_after(F.slice(borders, block * width + 1, width))


def ordered_chunks(df: DataFrame, keys, order) -> tuple[DataFrame, list[str]]:
    """Add a chunk column that splits every oversized group along ``order``. Keys must
    not be NULL; the chunk never is: 0 in groups that are not split, from 1 in others.

    Which groups are oversized comes out of the drawn rows, so all groups can be given,
    large and small. Sorting by (chunk, order) equals sorting by order. Borders are quantiles of the whole
    tuple of order columns, texts in full; rows that tie in it are cut by the other
    columns. Only rows that are equal in every column stay together in any number.
    """
    place = _place(df, keys, order)
    borders, small = counted(_borders(df, keys, place))
    if borders.isEmpty():
        return df, []
    joined = df.join(F.broadcast(borders) if small else borders, list(keys), "left")
    chunk = F.when(F.col("_borders").isNull(), F.lit(0)).otherwise(
        _chunk(F.col("_borders"), place) + 1
    )
    return joined.withColumn("_chunk0", chunk.cast("bigint")).drop("_borders"), ["_chunk0"]


def chunk_join(df: DataFrame, summary: DataFrame, by) -> DataFrame:
    """Join per-chunk values back onto the rows of the chunk."""
    done, small = counted(summary)
    return df.join(F.broadcast(done) if small else done, by, "left")


def chunked_row_number(df: DataFrame, keys, order, out: str) -> DataFrame:
    """``row_number`` per key for oversized groups: number within the chunk plus
    the size of the chunks before it."""
    df, chunks = ordered_chunks(df, keys, order)
    by = [*keys, *chunks]
    local = F.row_number().over(Window.partitionBy(*by).orderBy(*asc(order))).cast("bigint")
    if not chunks:
        return df.withColumn(out, local)
    earlier = Window.partitionBy(*keys).orderBy(*chunks).rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        df.groupBy(*by)
        .count()
        .select(*by, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        chunk_join(df.withColumn(out, local), sizes, by)
        .withColumn(out, F.col(out) + F.col("_before"))
        .drop("_before", *chunks)
    )
