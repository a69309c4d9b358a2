"""Ranked lexical search by branch and bound in document trees (FP-trees).

Items ask for the documents with the highest scores. A score sums over the item's terms, once
each, ``w * ((10^9 * tf) div (1000 * tf + 8 * m))``: ``w`` falls with the number of documents
that hold the term, ``tf`` is how often the document holds it, and ``m`` grows with the
document's length. So a score rises with every tf and falls with m.

Documents are restricted to the terms of the items and become vectors, the terms in the order
of falling document frequency. A task puts its vectors into trees: documents with the same
first terms share a path, and unary steps are left out. Each subtree knows the greatest tf of
every term and the least m of its documents, and from these the greatest score that an item
can have in it. An item goes down depth first, the most promising child first, and leaves out
subtrees that cannot reach the last of its best so far; small subtrees are leaves, of
which all documents get their exact scores. The best carry over from tree to tree of a
task. What tasks found, at most ``size`` documents for each item, is ranked once more.

Statistics (documents with terms, all terms, document frequencies) cover all documents. The
items are a stated set of queries, dealt into passes of about ``TERMS_AT_ONCE`` terms; a pass
reads the documents once and its terms are all that is sent to tasks or comes to the driver.

Terms are runs of letters, digits and characters beyond ASCII; only A-Z are put in lower case.

Defined cases: a null text or item has no terms and no results, and such documents do not
count; equal scores are ranked by ascending id, null ids last; rows that repeat an id are
documents of their own; item rows with equal id and text are one item, other texts under
the same id are other items; other columns play no part; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklane.session import scratch_path

#: Terms of the items of one pass, on average at most.
TERMS_AT_ONCE = 1 << 15
#: Cells (documents times terms) of one tree in a task's memory.
CELLS = 1 << 24
#: Documents of a subtree that is not branched further, and children of a node.
LEAF, CHILDREN = 32, 32

_SPACE = bytes(
    ord(chr(b).lower()) if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(0x80)
) + bytes(range(0x80, 0x100))
_VECTOR = "doc_id long, n long, terms array<int>, tfs array<int>"
_FOUND = "item int, item_id long, doc_id long, score long"
_RESULT = "item_id long, rank int, doc_id long, score long"


def terms_of(text: str | None) -> list[bytes]:
    """All terms of a text in their order, in UTF-8."""
    # bytes have just the capital letters A-Z, and beyond ASCII every byte is part of a term
    return (text or "").encode("utf-8", "surrogatepass").translate(_SPACE).split()


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, text_key, terms (distinct, in order) of the items that have any."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(set(terms_of(t.as_py()))) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(terms, pa.list_(pa.binary()))],
                names=["item_id", "text_key", "terms"],
            )

    rows = items.select(
        F.col(f"`{id_col}`").cast("long").alias("item_id"), F.col(f"`{text_col}`").alias("text")
    ).distinct()
    rows = rows.select("item_id", F.sha2("text", 256).alias("text_key"), "text")
    found = rows.mapInArrow(split, "item_id long, text_key string, terms array<binary>")
    return found.where(F.size("terms") > 0)


def vectors(docs: DataFrame, terms: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """doc_id, n (all terms), and the numbers and counts of those of the given terms that the
    document holds; for documents with any term at all."""
    number = {t: i for i, t in enumerate(terms)}

    def restrict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, held, counts = [], [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                every = terms_of(text.as_py())
                if every:
                    known = Counter(map(number.get, every))
                    known.pop(None, None)
                    ids.append(i)
                    sizes.append(len(every))
                    held.append(list(known))
                    counts.append(list(known.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array(held, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32())),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )

    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    return rows.mapInArrow(restrict, _VECTOR)


def scores(weights: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Scores of rows of term counts."""
    tf = tf.astype(np.int64)
    return (weights * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[:, None]))).sum(axis=1)


class Node:
    """Ranges of a tree's documents, each a subtree: a node, or None for a leaf."""

    __slots__ = ("starts", "ends", "most", "least_m", "nodes")

    def __init__(self, tree: Tree, bounds: list[int]):
        self.starts, self.ends = bounds[:-1], bounds[1:]
        self.most = np.maximum.reduceat(tree.tf[: bounds[-1]], self.starts)
        self.least_m = np.minimum.reduceat(tree.m[: bounds[-1]], self.starts)
        self.nodes: list[Node | None] = [None] * len(self.starts)


class Tree:
    """The restricted vectors of some documents, of which those with the same first terms
    share paths. ``tf`` has a column for every term, by falling document frequency."""

    def __init__(self, tf: np.ndarray, m: np.ndarray, ids: np.ndarray, nulls: np.ndarray):
        held = np.packbits(tf > 0, axis=1)
        # as byte strings: documents that have the first term in which two differ come first
        order = np.argsort(np.ascontiguousarray(~held).view(f"V{held.shape[1]}").ravel(), kind="stable")
        self.tf, self.m, self.ids, self.nulls = tf[order], m[order], ids[order], nulls[order]
        held = held[order]
        apart = held[1:] ^ held[:-1]
        byte = (apart != 0).argmax(axis=1)
        first = apart[np.arange(len(apart)), byte].astype(np.int64)
        # the first term in which neighbours differ; none for equal vectors
        self.same = 8 * held.shape[1]
        place = byte * 8 + 7 - np.log2(np.maximum(first, 1)).astype(int)
        self.differ = np.where(first > 0, place, self.same)
        self.root = self._node(0, len(ids))
        todo = [self.root]
        while todo:
            node = todo.pop()
            for k, (lo, hi) in enumerate(zip(node.starts, node.ends, strict=True)):
                if hi - lo > LEAF and (below := self._node(lo, hi)) is not None:
                    node.nodes[k] = below
                    todo.append(below)

    def _node(self, lo: int, hi: int) -> Node | None:
        """Branch a range where its paths part first, then the largest of its branches."""
        ranges, whole = [(lo, hi)], []
        while ranges and len(ranges) + len(whole) < CHILDREN:
            ranges.sort(key=lambda r: r[1] - r[0])
            a, b = ranges.pop()
            if b - a <= LEAF:
                whole.append((a, b))
                break
            cut = a + int(self.differ[a : b - 1].argmin())
            if self.differ[cut] == self.same:
                # equal vectors are not told apart by terms, only cut
                ranges_of_equals = range(a, b, max(LEAF, -(-(b - a) // CHILDREN)))
                whole += [(s, min(s + ranges_of_equals.step, b)) for s in ranges_of_equals]
            else:
                ranges += [(a, cut + 1), (cut + 1, b)]
        every = sorted(ranges + whole)
        if len(every) == 1 and lo > 0:
            return None
        return Node(self, [a for a, _ in every] + [hi])


class Best:
    """The best documents so far, by falling score and id, null last."""

    def __init__(self, size: int):
        self.size, self.limit = size, 1
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.nulls = np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        good = scores >= self.limit
        if not good.any():
            return
        self.scores = np.concatenate([self.scores, scores[good]])
        self.ids = np.concatenate([self.ids, ids[good]])
        self.nulls = np.concatenate([self.nulls, nulls[good]])
        order = np.lexsort((self.ids, self.nulls, -self.scores))[: self.size]
        self.scores, self.ids, self.nulls = self.scores[order], self.ids[order], self.nulls[order]
        if len(order) == self.size:
            self.limit = int(self.scores[-1])


def search(tree: Tree, columns: np.ndarray, weights: np.ndarray, best: Best) -> int:
    """Add an item's best documents of a tree; return how many documents were scored."""
    todo = [(best.limit, tree.root)]
    scored = 0
    while todo:
        reach, node = todo.pop()
        if reach < best.limit:
            continue
        if isinstance(node, tuple):
            part = slice(*node)
            exact = scores(weights, tree.tf[part, columns], tree.m[part])
            best.add(exact, tree.ids[part], tree.nulls[part])
            scored += len(exact)
            continue
        reaches = scores(weights, node.most[:, columns], node.least_m)
        # the most promising child is taken next
        for k in np.argsort(reaches, kind="stable"):
            if reaches[k] >= best.limit:
                below = node.nodes[k]
                if below is None:
                    below = (node.starts[k], node.ends[k])
                todo.append((int(reaches[k]), below))
    return scored


def _pass(docs: DataFrame, items: list, size: int, id_col: str, text_col: str) -> DataFrame:
    """item, item_id, doc_id, score, rank of some items, collected."""
    spark = docs.sparkSession
    terms = sorted({t for item in items for t in item["terms"]})
    path = scratch_path(spark, "term-vectors")
    vectors(docs, terms, id_col, text_col).write.parquet(path)
    rows = spark.read.schema(_VECTOR).parquet(path)
    total = rows.agg(F.count("*"), F.sum("n")).first()
    with_terms, all_terms = total[0], total[1] or 0
    held = dict(map(tuple, rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect()))
    order = sorted(held, key=lambda t: (-held[t], t))
    column = {t: k for k, t in enumerate(order)}
    weight = [
        math.floor(1000 * math.log((2 * with_terms + 2) / (2 * held[t] + 1))) for t in order
    ]
    asked = []
    place = {t: i for i, t in enumerate(terms)}
    for item in items:
        own = sorted(column[place[t]] for t in item["terms"] if place[t] in column)
        own = [c for c in own if weight[c] > 0]
        asked.append((np.array(own, np.intp), np.array([weight[c] for c in own], np.int64)))
    ids = [item["item_id"] for item in items]
    at_once = max(LEAF, CELLS // max(1, len(order)))
    columns_of = np.array([column.get(t, -1) for t in range(len(terms))], np.intp)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bests = [Best(size) for _ in asked]
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                part = batch.slice(start, at_once)
                tree = _tree(part, columns_of, len(order), with_terms, all_terms)
                for (columns, weights), best in zip(asked, bests, strict=True):
                    if len(columns):
                        search(tree, columns, weights, best)
        rows = [
            (k, ids[k], None if none else int(i), int(score))
            for k, best in enumerate(bests)
            for score, i, none in zip(best.scores, best.ids, best.nulls, strict=True)
        ]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        kinds = pa.int32(), pa.int64(), pa.int64(), pa.int64()
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
            names=["item", "item_id", "doc_id", "score"],
        )

    order_by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = rows.where(F.size("terms") > 0).mapInArrow(find, _FOUND)
    return found.withColumn("rank", F.row_number().over(order_by)).where(F.col("rank") <= size)


def _tree(part: pa.RecordBatch, columns_of, width: int, with_terms: int, all_terms: int) -> Tree:
    held, counts = part.column(2), part.column(3)
    lengths = held.value_lengths().to_numpy(zero_copy_only=False)
    tf = np.zeros((part.num_rows, width), np.int32)
    rows = np.repeat(np.arange(part.num_rows), lengths)
    tf[rows, columns_of[held.flatten().to_numpy()]] = counts.flatten().to_numpy()
    n = part.column(1).to_numpy()
    m = 100 - 90 + (90 * n * with_terms) // all_terms
    ids = part.column(0)
    return Tree(
        tf, m, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
    )


def rank(
    docs: DataFrame,
    items: DataFrame,
    size: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``size`` best documents with a score above 0."""
    spark = docs.sparkSession
    path = scratch_path(spark, "ranked")
    item_terms(items, item_id_col, item_text_col).write.parquet(f"{path}/items")
    listed = spark.read.schema("item_id long, text_key string, terms array<binary>").parquet(
        f"{path}/items"
    )
    total = listed.agg(F.sum(F.size("terms"))).first()[0] or 0
    passes = -(-total // TERMS_AT_ONCE)
    if not passes:
        return spark.range(0).select(F.from_json(F.lit("{}"), _RESULT).alias("r")).select("r.*")
    dealt = F.pmod(F.xxhash64("item_id", "text_key"), F.lit(passes))
    for k in range(passes):
        some = listed.where(dealt == k).orderBy("item_id", "text_key").collect()
        if some:
            _pass(docs, some, size, id_col, text_col).select(
                "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"
            ).write.mode("append").parquet(f"{path}/found")
    return spark.read.schema(_RESULT).parquet(f"{path}/found")
