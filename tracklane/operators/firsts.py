"""First row per group and nearest row in time.

Both keep one row per group with ``row_number() = 1``. Spark limits each map task
to its own first row per group before the shuffle, so a group of any size sends
only a handful of rows to the task that decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklane.operators.skew import bounded_broadcast


def _sort_columns(order) -> list[Column]:
    return [c.asc_nulls_last() if isinstance(c, Column) else F.col(c).asc_nulls_last() for c in order]


def first_per_group(df: DataFrame, group, order, where: Column | None = None) -> DataFrame:
    """The first row of each group along ``order`` (names, or columns such as a
    negated key for descending order)."""
    data = df if where is None else df.where(where)
    window = Window.partitionBy(*group).orderBy(*_sort_columns(order))
    return data.withColumn("_n", F.row_number().over(window)).where("_n = 1").drop("_n")


def nearest_in_group(
    left: DataFrame,
    right: DataFrame,
    on,
    left_time: str,
    right_time: str,
    group,
    tie_break,
    tolerance: float | None = None,
    out: str = "time_diff",
) -> DataFrame:
    """For each group the pair of joined rows whose times differ least.

    ``left`` is the small side (one or a few rows per key), ``right`` the large
    one. With ``tolerance`` only pairs at most that far apart are considered.
    The two sides may share no column names other than ``on``.
    """
    joined = right.join(bounded_broadcast(left), list(on))
    if tolerance is not None:
        joined = joined.where(
            (F.col(right_time) >= F.col(left_time) - tolerance)
            & (F.col(right_time) <= F.col(left_time) + tolerance)
        )
    joined = joined.withColumn(out, F.abs(F.col(right_time) - F.col(left_time)))
    return first_per_group(joined, group, [out, *tie_break])
