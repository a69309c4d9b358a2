"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order that depends on a seed and
the rows only, gone through up to ``max_passes`` times. A document's virtual finish time
is the number of its source's words up to its end, divided by the source's target. The
queues are merged by a global range sort on that time. All targets together are the
budget, so the whole budget has been served when the clock shows 1; there the queue is
truncated, and each document in service is cut to the words served.

The running sums over a queue are taken in two levels: sums per slice of the shuffled
order, then sums inside a slice. A source with a third of all rows is spread over as many
tasks as its slices. Only built-in functions are used.

Defined cases: a null text has no words; null is a source of its own, the last in order;
documents without words get a time but no words; a source without words has target 0;
rows that repeat are separate documents; an empty table gives an empty result. Other
columns are carried along, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklane.session import settle

#: Rows of a source that share a slice, on average, and the most slices of a source.
SLICE_ROWS = 4096
MAX_SLICES = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def measured(
    docs: DataFrame, carry: Column, id_col: str, text_col: str, source_col: str, seed: int
) -> DataFrame:
    """What the queues need of each document, beside the column ``carry``."""
    return docs.select(
        carry.alias("carry"),
        F.col(source_col).alias("source"),
        n_words(F.col(text_col)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("turn"),
        F.col(id_col).alias("turn_id"),
    )


def source_targets(
    sums: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    max_passes: int = 2,
) -> DataFrame:
    """source, source_size, target from ``sums`` (source, source_size), one row per source.

    Sources in code point order, null last, take the weights in turn. They share ``share``
    of all words by weight; what exceeds ``max_passes`` times a source's size goes to the
    others, again by weight. With sources ordered by size over weight, those at their
    limit come first, so one pass of running sums finds the common level.
    """
    everything = Window.partitionBy()
    order = everything.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights) + 1
    limits = sums.select(
        "source",
        "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn).alias("weight"),
        (F.col("source_size") * float(max_passes)).alias("limit"),
        (F.sum("source_size").over(everything) * share).alias("budget"),
    ).withColumn("ratio", F.col("limit") / F.col("weight"))
    by_ratio = everything.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum(
        "weight"
    ).over(onward)
    return limits.withColumn("level", level).select(
        "source",
        "source_size",
        # the level rises while sources are at their limit and falls after that
        F.least("limit", F.col("weight") * F.max("level").over(everything)).alias("target"),
    )


def _same(a: DataFrame, b: DataFrame, *names: str) -> Column:
    on = F.lit(True)
    for name in names:
        on = on & a[name].eqNullSafe(b[name])
    return on


def queued(
    rows: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    max_passes: int = 2,
) -> DataFrame:
    """Measured documents with source_size, target and, for each pass through the queue,
    ``passes``: an array of (pass, start, words, virtual_finish)."""
    # a slice is a range of the shuffled order: the highest bits of a document's turn
    many = rows.groupBy("source").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, min(MAX_SLICES, many / SLICE_ROWS)))))
    # shifts are taken modulo 64, hence the case of a single slice
    part = F.shiftright("turn", 64 - bits) if bits else F.lit(0).cast("long")
    rows = rows.withColumn("slice", part)
    slices = settle(rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size")))
    targets = source_targets(
        slices.groupBy("source").agg(F.sum("slice_size").alias("source_size")),
        weights, share, max_passes,
    )
    earlier = (
        Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = slices.select(
        "source", "slice", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)).alias("before")
    )
    known = settle(
        starts.join(targets, _same(starts, targets, "source"))
        .select(starts["source"], "slice", "before", "source_size", "target")
    )
    inside = (
        Window.partitionBy("source", "slice")
        .orderBy("turn", "turn_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = rows.withColumn("upto", F.sum("size").over(inside))
    placed = placed.join(known, _same(placed, known, "source", "slice")).select(
        *[placed[c] for c in placed.columns], "before", "source_size", "target"
    )
    end = F.col("before") + F.col("upto")

    def once(n: Column) -> Column:
        start = n * F.col("source_size") + end - F.col("size")
        served = F.floor(F.col("target")) - start
        words = F.greatest(F.lit(0), F.least(F.col("size"), served)).cast("long")
        return F.struct(
            n.alias("pass"), start.alias("start"), words.alias("words"),
            F.try_divide((start + F.col("size")).cast("double"), F.col("target"))
            .alias("virtual_finish"),
        )

    return placed.withColumn("passes", F.array(*[once(F.lit(n)) for n in range(max_passes)]))


def mix(queue: DataFrame) -> DataFrame:
    """The mix in order: one row per document and pass with its words, sorted by virtual
    finish time over all sources and truncated where the budget has been served."""
    return (
        queue.select("*", F.inline("passes"))
        .drop("passes")
        .where("words > 0")
        .orderBy("virtual_finish", F.col("source").asc_nulls_last(), "pass", "turn", "turn_id")
    )


def mix_documents(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    max_passes: int = 2,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Whole documents of the mix, with all columns, repeated as often as they are taken.

    A document that the end of the budget cuts stays if at least half of it is served.
    Documents without words are no part of a mix.
    """
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    rows = measured(docs, row, id_col, text_col, source_col, seed)
    taken = mix(queued(rows, weights, share, max_passes)).where("2 * words >= size")
    return taken.select(*[F.col(f"carry.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def words_taken(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    max_passes: int = 2,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken (its words in the mix)."""
    row = F.struct(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("seat"))
    rows = settle(measured(docs, row, id_col, text_col, source_col, seed))
    queue = queued(rows, weights, share, max_passes)
    served = served_in_budget(mix(queue)).groupBy("seat").agg(F.sum("words").alias("taken"))
    documents = queue.select("carry.*", "source", "size", "source_size", "target")
    return documents.join(served, "seat", "left").select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
    )


def served_in_budget(mixed: DataFrame) -> DataFrame:
    """seat, words of the sorted mix up to all targets together, its budget. The running sums
    have two levels: over the ranges of the sort, and inside each range."""
    ranges = settle(
        mixed.select(
            "carry.seat", "source", "target", "words", "virtual_finish", "pass", "turn", "turn_id",
            F.spark_partition_id().alias("range"),
        )
    )
    totals = ranges.groupBy("range").agg(F.sum("words").alias("n"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    budget = ranges.groupBy("source").agg(F.max("target").alias("target")).agg(
        F.floor(F.sum("target")).alias("budget")
    )
    inside = (
        Window.partitionBy("range")
        .orderBy("virtual_finish", F.col("source").asc_nulls_last(), "pass", "turn", "turn_id", "seat")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    upto = F.col("before") + F.col("inside") - F.col("words")
    return (
        ranges.withColumn("inside", F.sum("words").over(inside))
        .join(before.crossJoin(budget), "range")
        .select("seat", F.least("words", F.greatest(F.lit(0), F.col("budget") - upto)).alias("words"))
    )
