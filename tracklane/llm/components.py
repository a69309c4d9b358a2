"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklane.session import settle

#: Rows of a settled frame that one task writes; smaller frames need fewer tasks and files.
ROWS_PER_TASK = 100_000
#: Nodes whose neighbours are not brought to one task: the ones with the most, so many at most.
HUBS = 4096


def settle_small(df: DataFrame, most_rows: int) -> DataFrame:
    """``df`` settled by as many tasks as its rows need, of which there are ``most_rows`` at
    most. The rounds of an iteration leave a file for every task, so few rows should not
    keep the number of partitions that large tables have."""
    return settle(df.coalesce(max(1, -(-most_rows // ROWS_PER_TASK))))


def _with_least(edges: DataFrame, rows: int, itself: bool) -> DataFrame:
    """``edges`` (a, b; ``rows`` of them at most) with m, the least b of their a; with
    ``itself`` also a is looked at.

    A node with very many neighbours would bring them all to one task. Such nodes are few,
    as their degrees add up to the edges: they are broadcast, the others join by shuffle.
    So few edges that they are one task's work in any case need no exchange at all.
    """
    if rows <= 2 * ROWS_PER_TASK:
        least = F.min("b").over(Window.partitionBy("a"))
        return edges.withColumn("m", F.least(least, "a") if itself else least)
    least = F.least(F.min("b"), F.first("a")) if itself else F.min("b")
    known = edges.groupBy("a").agg(least.alias("m"), F.count("*").alias("degree"))
    many = F.col("degree") > rows // HUBS
    hubs = F.broadcast(known.where(many).select("a", "m"))
    others = edges.join(hubs, "a", "left_anti").join(known.where(~many).select("a", "m"), "a")
    return edges.join(hubs, "a").unionByName(others)


def _state(edges: DataFrame) -> tuple:
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (a, b); root is the smallest node reachable.

    Alternates large stars (link larger neighbours to the smallest one) and small stars
    (link smaller neighbours and the node itself to the smallest one) until the edges are
    stars around the roots. Both are a grouped minimum, made in the map tasks as far as
    possible, and a join that keeps the neighbours of hubs where they are.
    """
    current = settle(
        edges.where("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = _state(current)
    while before[0]:
        if before[0] <= ROWS_PER_TASK:
            # one partition needs no exchange for what follows, and edges only get fewer
            current = current.coalesce(1)
        ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
        both = current.select(F.inline(ways))
        large = _with_least(both, 2 * before[0], itself=True).where("b > a")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = settle_small(large.where("a != b").distinct(), before[0])
        if before[0] <= ROWS_PER_TASK:
            large = large.coalesce(1)
        small = _with_least(large, before[0], itself=False)
        small = small.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        current = settle_small(small.where("a != b").distinct(), 2 * before[0])
        after = _state(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
