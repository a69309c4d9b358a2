"""Distance to a reference entity (the ball) within each moment, and rank by it.

The default form computes everything with windows over the moment key, so a table
is exchanged once and never joined to itself. ``method="join"`` is the same
relation written as joins; it differs only when a moment holds several reference
rows (or an entity twice), where a join repeats rows and the window does not.

``split_large=False`` leaves out the search for moments too large for one task, for
callers that know there are none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklane.functions import squared_distance
from tracklane.operators.skew import asc, chunked_row_number, has_values, hot_keys, split_hot


def _is_entity(id_col, ref_id) -> Column:
    return F.coalesce(F.col(id_col) != ref_id, F.lit(False))


def _loose(keys, id_col, xy) -> Column:
    # Rows without a complete key belong to no moment. Spreading them by value
    # keeps them out of one common NULL group.
    return F.when(~has_values(keys), F.xxhash64(id_col, *xy))


def _reference(id_col, ref_id, xy) -> Column:
    x, y = xy
    return F.min(F.when(F.col(id_col) == ref_id, F.struct(F.col(x).alias("x"), F.col(y).alias("y"))))


def _with_distance(df: DataFrame, xy, out) -> DataFrame:
    return df.withColumn(out, squared_distance(xy[0], xy[1], "_ref.x", "_ref.y"))


def _reference_by_window(df, by, keys, id_col, ref_id, xy) -> DataFrame:
    """Add ``_ref``: the reference entity's position, NULL when there is none."""
    ref = _reference(id_col, ref_id, xy).over(Window.partitionBy(*by))
    return df.withColumn("_ref", F.when(has_values(keys), ref))


def _reference_by_lookup(df, keys, id_col, ref_id, xy) -> DataFrame:
    """The same for hot keys: one pre-aggregated row per key, joined back. There
    are as few of those as there are hot keys."""
    refs = df.groupBy(*keys).agg(_reference(id_col, ref_id, xy).alias("_ref"))
    return df.join(F.broadcast(refs), keys, "left").select(*df.columns, "_ref")


def entity_distance(
    df: DataFrame,
    moment_keys,
    id_col,
    ref_id,
    xy,
    out="distance_sq",
    method="window",
    split_large: bool = True,
) -> DataFrame:
    """Every row plus its squared distance to the reference entity of its moment."""
    keys, columns = list(moment_keys), [*df.columns, out]
    if method == "join":
        x, y = xy
        refs = df.where(F.col(id_col) == ref_id).select(
            *keys, F.struct(F.col(x).alias("x"), F.col(y).alias("y")).alias("_ref")
        )
        return _with_distance(df.join(refs, keys, "left"), xy, out).select(*columns)

    def by_window(part: DataFrame) -> DataFrame:
        part = part.withColumn("_loose", _loose(keys, id_col, xy))
        found = _reference_by_window(part, [*keys, "_loose"], keys, id_col, ref_id, xy)
        return _with_distance(found, xy, out).select(*columns)

    hot = hot_keys(df, keys) if split_large else None
    if hot is None:
        return by_window(df)
    rest, large = split_hot(df, keys, hot)
    found = _reference_by_lookup(large, keys, id_col, ref_id, xy)
    return by_window(rest).unionByName(_with_distance(found, xy, out).select(*columns))


def entity_distance_rank(
    df: DataFrame,
    moment_keys,
    id_col,
    ref_id,
    xy,
    tie_break=(),
    out="distance_sq",
    rank="rank",
    method="window",
    split_large: bool = True,
) -> DataFrame:
    """``entity_distance`` plus the rank of each entity, nearest first.

    The reference entity keeps a NULL rank. Without a reference in the moment all
    distances are NULL and the tie-break columns alone decide.
    """
    keys, order = list(moment_keys), [out, *(tie_break or [id_col])]
    columns = [*df.columns, out, rank]
    if method == "join":
        far = entity_distance(df, keys, id_col, ref_id, xy, out, "join")
        window = Window.partitionBy(*keys).orderBy(*asc(order))
        ranks = far.where(_is_entity(id_col, ref_id)).select(
            *keys, id_col, F.row_number().over(window).cast("bigint").alias(rank)
        )
        return far.join(ranks, [*keys, id_col], "left").select(*columns)

    def by_window(part: DataFrame) -> DataFrame:
        part = part.withColumn("_loose", _loose(keys, id_col, xy)).withColumn(
            "_entity", _is_entity(id_col, ref_id) & has_values(keys)
        )
        found = _reference_by_window(part, [*keys, "_loose"], keys, id_col, ref_id, xy)
        window = Window.partitionBy(*keys, "_loose", "_entity").orderBy(*asc(order))
        number = F.row_number().over(window).cast("bigint")
        return (
            _with_distance(found, xy, out)
            .withColumn(rank, F.when(F.col("_entity"), number))
            .select(*columns)
        )

    hot = hot_keys(df, keys) if split_large else None
    if hot is None:
        return by_window(df)
    rest, large = split_hot(df, keys, hot)
    far = _with_distance(_reference_by_lookup(large, keys, id_col, ref_id, xy), xy, out).drop("_ref")
    entity = _is_entity(id_col, ref_id)
    ranked = chunked_row_number(far.where(entity), keys, order, rank).select(*columns)
    others = far.where(~entity).withColumn(rank, F.lit(None).cast("bigint"))
    return by_window(rest).unionByName(ranked).unionByName(others)


def entity_closest_flag(
    df: DataFrame, moment_keys, id_col, ref_id, xy, out="distance_sq", flag="closest"
) -> DataFrame:
    """Distance plus whether it equals the moment's smallest entity distance.

    Moments without the reference, or without any other entity, are dropped. Ties
    give several TRUE rows; the reference itself is TRUE when the minimum is 0.
    """
    keys, columns = list(moment_keys), [*df.columns, out, flag]
    least = F.min(F.when(_is_entity(id_col, ref_id), F.col(out)))
    any_entity = F.max(_is_entity(id_col, ref_id))

    def finish(part: DataFrame) -> DataFrame:
        return part.where("_any").withColumn(flag, F.col("_least") == F.col(out)).select(*columns)

    def with_ball(part: DataFrame) -> DataFrame:
        return _with_distance(part.where(F.col("_ref").isNotNull()), xy, out)

    def by_window(part: DataFrame) -> DataFrame:
        moment = Window.partitionBy(*keys)
        part = with_ball(_reference_by_window(part, keys, keys, id_col, ref_id, xy))
        return finish(
            part.withColumns({"_least": least.over(moment), "_any": any_entity.over(moment)})
        )

    df = df.where(has_values(keys))
    hot = hot_keys(df, keys)
    if hot is None:
        return by_window(df)
    rest, large = split_hot(df, keys, hot)
    far = with_ball(_reference_by_lookup(large, keys, id_col, ref_id, xy))
    per_key = far.groupBy(*keys).agg(least.alias("_least"), any_entity.alias("_any"))
    return by_window(rest).unionByName(finish(far.join(F.broadcast(per_key), keys)))
