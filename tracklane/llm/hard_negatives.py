"""Hard negatives of anchor vectors by a vertical scan (branch-and-bound on dimensions).

Vectors lie in blocks, each a matrix with one row for every dimension, and with the least and
greatest value of each. For an anchor the dimensions are read in the order of its falling
magnitudes. After every few of them a vector's score is known up to what the remaining
dimensions can add, between the sums of the anchor's components times the block's least and
greatest values. A vector stays in the candidate set only while that range can reach the
result; those still there when all dimensions are read have exact scores.

Two scans are made. The first finds for each anchor its positives, the best vectors of the
same label; what cannot reach the last of the best so far is dropped. The second finds for
each positive the best vectors of other labels with scores in a window around that of the
positive: ``low * positive <= 100 * score <= high * positive``. A vector is dropped as soon as
it can be in no window, or only below the last of the window's best so far.

The anchors are a stated set of queries and are dealt into groups of about
``ANCHORS_AT_ONCE``; each group is sent to all tasks and meets all blocks in one job. A group
is the only thing that goes through the driver, and that number bounds its size. A task
keeps the best rows for each anchor of the group, whatever the number of its vectors, and the
rest is a ranking by anchor. No pairs of rows are written.

Components are ``floor(256 * x)`` of the double value, cut at 2^26 to either side so that scores
of vectors of up to 2,048 dimensions fit in 64 bits. Rows with a null label, vector or
component, or one that is not finite, take no part. Vectors may differ in length: what is missing
counts as 0.

Defined cases: equal scores are ranked by id, null ids last, then by the place of the row in
the blocks; rows that repeat an id or a whole row are vectors of their own, and an anchor
that is repeated is an anchor each time (it is never its own positive, its copy may be);
null ids are no anchors; other columns play no part; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklane.session import scratch_path

#: Anchors that one job compares with all vectors, and vectors of a block.
ANCHORS_AT_ONCE = 8192
BLOCK = 8192
#: Dimensions that are read before the candidates are looked at again.
STEP = 16
SCALE, LARGEST = 256, 1 << 26

#: Ids are kept as numbers; null ids are marked aside.
_BLOCK_SCHEMA = (
    "block long, dims int, ids array<long>, nulls array<boolean>, labels array<long>, "
    "matrix binary"
)
_NONE, _ALL = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    relabel=None,
) -> DataFrame:
    """vec_id, label, components of the rows that take part. ``relabel`` maps the columns of
    id and label to the label that counts."""
    one, of, vector = (F.col(f"`{c}`") for c in (id_col, label_col, vector_col))
    numbers = F.transform(vector, lambda x: x.cast("double"))
    cut = F.transform(
        numbers,
        lambda x: F.greatest(
            F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(x * SCALE))
        ).cast("int"),
    )
    usable = of.isNotNull() & vector.isNotNull()
    finite = F.forall(
        numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    label = of if relabel is None else relabel(one, of)
    return df.where(usable).where(finite).select(
        one.cast("long").alias("vec_id"), label.cast("long").alias("label"), cut.alias("components")
    )


def _matrix(columns: list[np.ndarray], dims: int) -> np.ndarray:
    """Dimensions by vectors."""
    out = np.zeros((dims, len(columns)), np.int32)
    for i, x in enumerate(columns):
        out[: len(x), i] = x
    return out


def write_blocks(rows: DataFrame, path: str) -> DataFrame:
    """Write ``vectors`` dimension by dimension, in blocks; read them back.

    Tasks write blocks of their own rows, without a shuffle. A block's number is that of its
    task and its place in it; written once, it does not change.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []

        def block() -> pa.RecordBatch:
            ids, labels, columns = zip(*waiting, strict=True)
            waiting.clear()
            dims = max(map(len, columns))
            return pa.RecordBatch.from_pylist(
                [{
                    "dims": dims,
                    "ids": [i or 0 for i in ids],
                    "nulls": [i is None for i in ids],
                    "labels": list(labels),
                    "matrix": _matrix(columns, dims).tobytes(),
                }],
                schema=pa.schema([
                    ("dims", pa.int32()), ("ids", pa.list_(pa.int64())),
                    ("nulls", pa.list_(pa.bool_())), ("labels", pa.list_(pa.int64())),
                    ("matrix", pa.binary()),
                ]),
            )

        for batch in batches:
            parts = batch.column(2)
            values = parts.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(parts.value_lengths().to_numpy(zero_copy_only=False))
            columns = np.split(values, ends[:-1])
            ids, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row in zip(ids, labels, columns, strict=True):
                waiting.append(row)
                if len(waiting) == BLOCK:
                    yield block()
        if waiting:
            yield block()

    kind = _BLOCK_SCHEMA.partition(", ")[2]
    blocks = rows.select("vec_id", "label", "components").mapInArrow(build, kind)
    blocks.select(F.monotonically_increasing_id().alias("block"), "*").write.parquet(path)
    return rows.sparkSession.read.schema(_BLOCK_SCHEMA).parquet(path)


class _Block:
    def __init__(self, row: dict):
        self.number, self.dims = row["block"], row["dims"]
        self.ids, self.nulls = np.array(row["ids"], np.int64), np.array(row["nulls"], bool)
        self.labels = np.array(row["labels"], np.int64)
        flat = np.frombuffer(row["matrix"], np.int32)
        self.matrix = flat.reshape(self.dims, -1).astype(np.int64)
        self.least, self.greatest = self.matrix.min(axis=1), self.matrix.max(axis=1)


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Block(batch.slice(i, 1).to_pylist()[0])


class Best:
    """The best of some scores so far, by falling score, id (null last) and place."""

    def __init__(self, size: int):
        self.size, self.rows, self.limit = size, [], _NONE

    def add(self, block: _Block, at: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.limit
        at, scores = at[good], scores[good]
        if len(at) > self.size:
            # equal scores at the end of the list are told apart by id and place
            good = scores >= np.partition(scores, -self.size)[-self.size]
            at, scores = at[good], scores[good]
            order = np.lexsort((at, block.ids[at], block.nulls[at], -scores))[: self.size]
            at, scores = at[order], scores[order]
        new = [
            (-int(s), bool(block.nulls[i]), int(block.ids[i]), block.number, int(i))
            for i, s in zip(at, scores, strict=True)
        ]
        if new:
            self.rows = sorted(self.rows + new)[: self.size]
        if len(self.rows) == self.size:
            self.limit = -self.rows[-1][0]


def scan_block(
    block: _Block,
    anchor: np.ndarray,
    at: np.ndarray,
    floors: np.ndarray,
    ceilings: np.ndarray,
    bests: list[Best],
) -> None:
    """Add to the best of every window the vectors of the block that lie in it.

    ``at`` are the places of the vectors in question; a window goes from its floor to its
    ceiling, both included.
    """
    weights = np.zeros(block.dims, np.int64)
    weights[: len(anchor)] = anchor[: block.dims]
    order = np.argsort(-np.abs(weights), kind="stable")[: np.count_nonzero(weights)]
    ends = (weights * block.least)[order], (weights * block.greatest)[order]
    # what the dimensions from a place on can add
    low, high = (
        np.append(np.cumsum(x[::-1])[::-1], 0) for x in (np.minimum(*ends), np.maximum(*ends))
    )
    floors, ceilings, size = floors[:, None], ceilings[:, None], bests[0].size
    scores = np.zeros(len(at), np.int64)
    for done in range(0, len(order), STEP):
        dims, then = order[done : done + STEP], min(done + STEP, len(order))
        part = block.matrix[dims]
        scores = scores + weights[dims] @ (part if len(at) == part.shape[1] else part[:, at])
        least, most = scores + low[then], scores + high[then]
        limits = np.array([b.limit for b in bests])
        certain = (least >= floors) & (most <= ceilings)
        for k in np.flatnonzero(certain.sum(axis=1) >= size):
            limits[k] = max(limits[k], np.partition(least[certain[k]], -size)[-size])
        stays = (most >= np.maximum(floors, limits[:, None])) & (least <= ceilings)
        stays = stays.any(axis=0)
        at, scores = at[stays], scores[stays]
        if not len(at):
            return
    inside = (scores >= floors) & (scores <= ceilings)
    for mask, best in zip(inside, bests, strict=True):
        best.add(block, at[mask], scores[mask])


_ANCHOR = (
    "block long, place int, anchor_id long, label long, components array<int>"
)
_FOUND = "block long, place int, slot int, score long, no_id boolean, id long, of long, at int"
#: Rows of a result in their order.
_BEST_FIRST = (F.desc, "score"), (F.asc, "no_id"), (F.asc, "id"), (F.asc, "of"), (F.asc, "at")


def _scan(blocks: DataFrame, anchors: list, size: int, windows_of, places_of) -> DataFrame:
    """The best ``size`` rows of each (anchor, window) over all blocks, with their rank."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = []
        for a in anchors:
            slots, floors, ceilings = windows_of(a)
            if slots:
                vector = np.array(a["components"], np.int64)
                bests = [Best(size) for _ in slots]
                asked.append((a, slots, (vector, np.array(floors), np.array(ceilings), bests)))
        for block in _blocks_of(batches):
            for a, _, (vector, *windows) in asked:
                scan_block(block, vector, places_of(block, a), *windows)
        rows = [
            (a["block"], a["place"], slot, -score, none, i, of, at)
            for a, slots, (*_, bests) in asked
            for slot, best in zip(slots, bests, strict=True)
            for score, none, i, of, at in best.rows
        ]
        kinds = (
            pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(),
            pa.int32(),
        )
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
            names=["block", "place", "slot", "score", "no_id", "id", "of", "at"],
        )

    window = Window.partitionBy("block", "place", "slot").orderBy(*[f(c) for f, c in _BEST_FIRST])
    found = blocks.mapInArrow(scan, _FOUND).withColumn("rank", F.row_number().over(window))
    return found.where(F.col("rank") <= size).withColumn("id", F.expr("IF(no_id, NULL, id)"))


def anchors_of(blocks: DataFrame, every: int) -> DataFrame:
    """Anchors with their place in the blocks: those with an id divisible by ``every``."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks_of(batches):
            at = np.flatnonzero(~block.nulls & (block.ids % every == 0))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block.number] * len(at), pa.int64()),
                    pa.array(at, pa.int32()),
                    pa.array(block.ids[at], pa.int64()),
                    pa.array(block.labels[at], pa.int64()),
                    pa.array(list(block.matrix[:, at].T), pa.list_(pa.int32())),
                ],
                names=["block", "place", "anchor_id", "label", "components"],
            )

    return blocks.mapInArrow(pick, _ANCHOR)


def _same_label(block: _Block, a) -> np.ndarray:
    at = np.flatnonzero(block.labels == a["label"])
    return at[at != a["place"]] if a["block"] == block.number else at


def _other_label(block: _Block, a) -> np.ndarray:
    return np.flatnonzero(block.labels != a["label"])


_RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, "
    "positive_score long, negative_score long"
)


def mine(
    rows: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` come from ``vectors``. Anchors are those whose id is divisible by ``every``.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "negatives")
    blocks = write_blocks(rows, f"{path}/blocks")
    anchors_of(blocks, every).write.parquet(f"{path}/anchors")
    anchors = spark.read.schema(_ANCHOR).parquet(f"{path}/anchors")
    # dealt at random, half of what a group may hold on average
    groups = -(-2 * anchors.count() // ANCHORS_AT_ONCE)
    group = F.pmod(F.xxhash64("block", "place"), F.lit(max(groups, 1)))
    for g in range(groups):
        part = anchors.where(group == g)
        scan_path = f"{path}/positives-{g}"
        _positives(blocks, part, positives).write.parquet(scan_path)
        found = _negatives(blocks, part, spark.read.parquet(scan_path), negatives, low, high)
        found.write.mode("append").parquet(f"{path}/found")
    if not groups:
        return spark.range(0).select(F.from_json(F.lit("{}"), _RESULT).alias("r")).select("r.*")
    return spark.read.schema(_RESULT).parquet(f"{path}/found")


def _positives(blocks: DataFrame, anchors: DataFrame, size: int) -> DataFrame:
    return _scan(
        blocks, anchors.collect(), size, lambda a: ([0], [_NONE], [_ALL]), _same_label
    ).select("block", "place", "rank", "id", "score")


def _negatives(blocks, anchors, chosen, size: int, low: int, high: int) -> DataFrame:
    # as many of each anchor as positives were asked for
    lists = chosen.groupBy("block", "place").agg(
        F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("positives")
    )

    def windows(a) -> tuple:
        """The whole scores in question; none are when the positive's is negative."""
        some = [p for p in a["positives"] if low * p["score"] <= high * p["score"]]
        return (
            [p["rank"] for p in some],
            [-(-low * p["score"] // 100) for p in some],
            [high * p["score"] // 100 for p in some],
        )

    asked = anchors.join(lists, ["block", "place"])
    positive = chosen.join(anchors.select("block", "place", "anchor_id"), ["block", "place"]).select(
        "block", "place", "anchor_id", F.col("rank").alias("slot"),
        F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    found = _scan(blocks, asked.collect(), size, windows, _other_label)
    return found.join(positive, ["block", "place", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
