"""Runs: stretches of consecutive rows with the same value.

One scan for groups of any size. Groups that are too large for one task are cut into ranges
of the order; runs are numbered and measured within a range, and of each range one summary
row (first and last value, number of runs, lengths of the two runs at its ends) is enough to
stitch them: summaries merge from left to right. Ordinary groups are one range and need no
summary, so these are few. The rows are exchanged once, by group and range, and the summaries
are made from the same exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklane.operators.skew import asc, fits_one_task, has_values, ordered_chunks


def _starts_run(previous: Column, value: Column) -> Column:
    """1 where a run starts. A NULL value never starts one by being different,
    and whatever follows a NULL value does."""
    return F.when(previous.isNull(), 1).when(previous != value, 1).otherwise(0)


def runs(
    df: DataFrame,
    partition,
    order,
    value: str,
    where: Column | None = None,
    run_id: str = "run_id",
    run_length: str = "run_length",
) -> DataFrame:
    """Number the runs of ``value`` along ``order`` in each partition (1, 2, ...)
    and give every row the number of rows in its run.

    Rows with a NULL partition value are left out. ``order`` has to be unique
    within a partition for the numbering to be well defined.
    """
    partition, order = list(partition), list(order)
    data = (df if where is None else df.where(where)).where(has_values(partition))
    if fits_one_task(data):
        return _in_one_window(data, partition, order, value, run_id, run_length)
    return _in_ranges(data, partition, order, value, run_id, run_length)


def _in_one_window(df, partition, order, value, run_id, run_length) -> DataFrame:
    ordered = Window.partitionBy(*partition).orderBy(*asc(order))
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = _starts_run(F.col("_previous"), F.col(value))
    return (
        df.withColumn("_previous", F.lag(value).over(ordered))
        .withColumn(run_id, F.sum(starts).over(running))
        .drop("_previous")
        .withColumn(run_length, F.count("*").over(Window.partitionBy(*partition, run_id)))
    )


def _in_ranges(df, partition, order, value, run_id, run_length) -> DataFrame:
    """The same where groups may be too large for one task."""
    columns = df.columns
    df, chunks = ordered_chunks(df, partition, order)
    if not chunks:
        return _in_one_window(df, partition, order, value, run_id, run_length)
    by = [*partition, *chunks]
    ordered = Window.partitionBy(*by).orderBy(*asc(order))
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = F.when(F.col("_first"), 0).otherwise(_starts_run(F.col("_previous"), F.col(value)))
    local = (
        df.withColumns(
            {"_first": F.row_number().over(ordered) == 1, "_previous": F.lag(value).over(ordered)}
        )
        .withColumn("_local", F.sum(starts).over(running))
        .drop("_previous")
        .withColumn("_length", F.count("*").over(Window.partitionBy(*by, "_local")))
    )

    # One row per range of a group that was cut: its first and last value, and the sizes
    # of the runs at its two ends. "_local" is 0 for the run at the start of the range.
    tail = F.max(F.struct(*[_sortable(c) for c in order], F.col(value).alias("_value")))
    summary = local.where(F.col(chunks[0]) > 0).groupBy(*by).agg(
        F.max(F.when(F.col("_first"), F.col(value))).alias("_head_value"),
        tail["_value"].alias("_tail_value"),
        F.max("_local").alias("_last"),
        F.max(F.when(F.col("_local") == 0, F.col("_length"))).alias("_head_length"),
        F.max(F.struct("_local", "_length"))["_length"].alias("_tail_length"),
    )
    along = Window.partitionBy(*partition).orderBy(*chunks)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    to_here = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summary = (
        summary.withColumn(
            "_opens", _starts_run(F.lag("_tail_value").over(along), F.col("_head_value"))
        )
        .withColumn(
            "_offset",
            F.sum("_opens").over(to_here) + F.coalesce(F.sum("_last").over(before), F.lit(0)),
        )
        .select(*by, "_last", "_offset", "_head_length", "_tail_length")
    )
    # Total length of the runs at the ends: a range adds its head to the run it
    # opens with and, when it holds several runs, its tail to the last one.
    ends = summary.select(
        *by,
        F.explode(
            F.array(
                F.struct(
                    F.lit(True).alias("head"),
                    F.col("_offset").alias("run"),
                    F.col("_head_length").alias("length"),
                ),
                F.struct(
                    F.lit(False).alias("head"),
                    (F.col("_offset") + F.col("_last")).alias("run"),
                    F.when(F.col("_last") > 0, F.col("_tail_length")).otherwise(0).alias("length"),
                ),
            )
        ).alias("_end"),
    )
    total = F.sum("_end.length").over(Window.partitionBy(*partition, "_end.run"))
    ends = (
        ends.withColumn("_total", total)
        .groupBy(*by)
        .agg(
            F.max(F.when(F.col("_end.head"), F.col("_end.run"))).alias("_offset"),
            F.max(F.when(~F.col("_end.head"), F.col("_end.run"))).alias("_last_run"),
            F.max(F.when(F.col("_end.head"), F.col("_total"))).alias("_head_total"),
            F.max(F.when(~F.col("_end.head"), F.col("_total"))).alias("_tail_total"),
        )
    )
    # Groups that were not cut have no summary: their numbers and lengths are right as they are.
    joined = local.join(ends, by, "left").withColumn(
        run_id, F.col("_local") + F.coalesce("_offset", F.lit(1))
    )
    length = (
        F.when(F.col("_local") == 0, F.coalesce("_head_total", "_length"))
        .when(F.col(run_id) == F.col("_last_run"), F.col("_tail_total"))
        .otherwise(F.col("_length"))
    )
    return joined.withColumn(run_length, length).select(*columns, run_id, run_length)


def _sortable(name: str) -> Column:
    """Ordering with NULL last, for use inside ``max(struct)``."""
    return F.struct(F.col(name).isNull(), F.col(name)).alias(f"_{name}")
