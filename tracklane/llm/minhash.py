"""Near duplicates by one-permutation hashing.

One hash orders all shingles of a text; the hash range is cut into bins and each bin keeps
its smallest shingle. Empty bins borrow from others by optimal densification (probe after
probe of a fixed random sequence of the bin, until one is filled), so that two texts agree
in a bin with the probability of their similarity. Bands of four bins name buckets.

Candidates come from buckets in two steps. Every bucket becomes a star around the member
that shares most buckets with others, so its pairs are as many as its members. Links are
confirmed on the full shingle sets and connected into groups; candidates, links or not, are
connected into families. What is left are pairs of one family in different groups. Each of
them is compared inside a cell of bounded size that only links leave: first by set sizes and
sketches of 1024 bits, then, if these allow a link, on the full sets, unless earlier pairs of
the cell have connected their groups. The number of pairs is
counted before: beyond ``COMPARED_PER_DOCUMENT`` times the documents, random members are
compared with all others of their families, as many as keep within it, and retire; this
repeats until no pair is left. So no pair of a bucket is lost, no pairs are written out, and
the work is done in steps of bounded size.

Texts with equal shingle sets are one document to all of this. Similar texts of at least
0.8 miss all 32 bands with probability (1 - 0.8^4)^32 = 5e-8; their sketches are further
apart than allowed (5 standard deviations) with probability 3e-7.

Defined cases: a null or empty text has no shingles and no links; null ids do not count
when the smallest id of a group is sought; rows that repeat an id are one document per
text; other columns play no part; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklane.llm.components import components, settle_small
from tracklane.llm.shingles import mixed, overlap, shingle_set
from tracklane.session import settle

BINS, BAND = 128, 4
#: Probes of the densification that are laid out in advance, for every bin.
PROBES = 4096
SKETCH_BITS, SKETCH_PROBES = 1024, 2048
#: Sketches that one step may compare, for each document that has candidates.
COMPARED_PER_DOCUMENT = 4096
#: Members of a family on either side of one group's comparisons, and the shingles they may have.
CELL = 2048
CELL_SHINGLES = 4 << 20
#: Rows of sketches that are held against a cell's other side at once.
BLOCK = 64
#: Most bytes of the list of documents with candidates that is sent to every task.
BROADCAST_BYTES = 8 << 20


_COMPARED = ("family", "node", "root", "sketch", "shingles")


class Bins:
    """Ranges of the hash, and for each the random sequence of bins it may borrow from."""

    def __init__(self, bins: int, probes: int):
        self.bits = bins.bit_length() - 1
        self.number = np.arange(bins, dtype=np.uint64)
        self.edges = self.number << np.uint64(64 - self.bits)
        order = mixed(np.arange(bins * probes, dtype=np.uint64)) >> np.uint64(64 - self.bits)
        self.probe = order.astype(np.uint16).reshape(bins, probes)


_FOR_BANDS = Bins(BINS, PROBES)
_FOR_SKETCHES = Bins(SKETCH_BITS, SKETCH_PROBES)


def signature(shingles: np.ndarray, bins: Bins = _FOR_BANDS) -> np.ndarray:
    """The densified bins of a set that is sorted and not empty."""
    # sorted shingles: the smallest of a bin is the first at or after the bin's edge
    at = np.searchsorted(shingles, bins.edges)
    first = shingles[np.minimum(at, len(shingles) - 1)]
    filled = (at < len(shingles)) & (first >> np.uint64(64 - bins.bits) == bins.number)
    out, empty, step = first.copy(), np.flatnonzero(~filled), 16
    for start in range(0, bins.probe.shape[1], step):
        if not len(empty):
            break
        probes = bins.probe[empty, start : start + step]
        good = filled[probes]
        found = good.any(axis=1)
        source = probes[found, good[found].argmax(axis=1)]
        out[empty[found]] = first[source]
        empty = empty[~found]
    # practically never: one filled bin and thousands of misses
    out[empty] = shingles[0]
    return out


def band_keys(bins: np.ndarray) -> np.ndarray:
    """One bucket name per band, different bands never on purpose alike."""
    rows = bins.reshape(-1, BAND)
    keys = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for k in range(BAND):
        keys = mixed(keys ^ rows[:, k])
    return keys


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def sketch(shingles: np.ndarray) -> np.ndarray:
    """One bit per bin, as 64-bit numbers. Bits agree with probability (1 + similarity) / 2."""
    bins = signature(shingles, _FOR_SKETCHES)
    return np.packbits(mixed(bins ^ _FOR_SKETCHES.edges) & np.uint64(1)).view(np.int64)


def _least_agreement(percent: int) -> int:
    p = (1 + percent / 100) / 2
    return int(SKETCH_BITS * p - 5 * (SKETCH_BITS * p * (1 - p)) ** 0.5)


def _sketches_agree(x: str, y: str, percent: int) -> Column:
    apart = [F.bit_count(F.get(x, k).bitwiseXOR(F.get(y, k))) for k in range(SKETCH_BITS // 64)]
    return SKETCH_BITS - reduce(add, apart) >= _least_agreement(percent)


def signed(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """doc_id, text_key, n_shingles, node (a 128-bit digest of the full set), bands."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, keys, bands = [], [], []
            for text in batch.column(1):
                shingles = shingle_set(text.as_py(), size)
                counts.append(len(shingles))
                if len(shingles):
                    keys.append(_digest(shingles))
                    bands.append(band_keys(signature(shingles)).view(np.int64))
                else:
                    keys.append(None)
                    bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(counts, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_key", "n_shingles", "node", "bands"],
            )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("text_key"),
    )
    return rows.mapInArrow(
        sign,
        "doc_id long, text_key long, n_shingles long, node binary, bands array<long>",
    )


def _full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int):
    """node, shingles, sketch for ``wanted`` (node, doc_id, text_key)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), size) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())),
                    pa.array([sketch(x) for x in sets], pa.list_(pa.int64())),
                ],
                names=["node", "shingles", "sketch"],
            )

    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("text_key"),
    )
    many = wanted.count()
    listed = F.broadcast(wanted) if many * 64 <= BROADCAST_BYTES else wanted
    at = texts.text_key == listed.text_key
    at = at & texts.doc_id.eqNullSafe(listed.doc_id)
    rows = texts.join(listed, at).select("node", "text")
    sets = settle(rows.mapInArrow(build, "node binary, shingles array<long>, sketch array<long>"))
    # rows repeated in full bring their set more than once
    if sets.count() > many:
        sets = settle(sets.dropDuplicates(["node"]))
    return sets


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (v.values.to_numpy().view(np.uint64) for v in (x, y))
                both = overlap(x, y)
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    right = right.join(pairs.select("b").distinct(), "b", "left_semi")
    return (
        pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b")
        .mapInArrow(confirm, "a binary, b binary")
    )


def _stars(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of every member a and the centre b of a bucket."""
    shared = members.groupBy("node").agg(F.sum("n_members").alias("weight"))
    centres = (
        members.join(shared, "node")
        .groupBy("bucket")
        .agg(F.max(F.struct("weight", "node")).alias("centre"))
        .select("bucket", F.col("centre.node").alias("b"))
    )
    return (
        members.join(centres, "bucket")
        .where(F.col("node") != F.col("b"))
        .select(F.col("node").alias("a"), "b")
        .distinct()
    )


def _may_link(n: tuple, sketches: tuple, percent: int) -> Column:
    """The sizes of two sets and their sketches allow a link."""
    fits = 100 * F.least(*n) >= percent * F.greatest(*n)
    return fits & _sketches_agree(*sketches, percent)


def _of_members(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    for side in ("a", "b"):
        known = sets.select(
            F.col("node").alias(side), F.size("shingles").alias(f"{side}_n"),
            F.col("sketch").alias(f"{side}_sketch"),
        )
        pairs = pairs.join(known, side)
    fits = _may_link(("a_n", "b_n"), ("a_sketch", "b_sketch"), percent)
    return pairs.where(fits).select("a", "b")


def _in_several_groups(nodes: DataFrame, links: DataFrame, most: int) -> DataFrame:
    """Nodes (node, family, n shingles) with their group, of the families that have more than
    one; and ``others``, the number of nodes of the family that are in other groups; and
    ``cells``, the parts that a large family is dealt into. There are ``most`` nodes at most."""
    roots = components(links)
    found = nodes.join(roots, "node", "left").select(
        "node", "family", "n", F.coalesce("root", "node").alias("root")
    )
    groups = found.groupBy("family", "root").agg(F.count("*").alias("own"), F.sum("n").alias("n"))
    families = groups.groupBy("family").agg(
        F.count("*").alias("groups"), F.sum("own").alias("all"), F.sum("n").alias("n")
    ).where("groups > 1")
    parts = F.greatest(F.ceil(F.col("all") / CELL), F.ceil(F.col("n") / CELL_SHINGLES))
    groups = groups.drop("n").join(families, "family").select(
        "family", "root", (F.col("all") - F.col("own")).alias("others"),
        parts.cast("int").alias("cells"),
    )
    return settle_small(found.join(groups, ["family", "root"]), most)


def _codes(x: pa.Table, y: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """A column of both tables as numbers, equal ones for equal values."""
    both = pa.chunked_array([*x[name].chunks, *y[name].chunks], x.schema.field(name).type)
    numbers = both.combine_chunks().dictionary_encode().indices.to_numpy()
    return numbers[: len(x)], numbers[len(x) :]


def _lists(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The lists of a column in one array, and where each of them starts and the last ends."""
    lists = table[name].combine_chunks()
    ends = np.append(0, np.cumsum(lists.value_lengths().to_numpy().astype(np.int64)))
    return lists.flatten().to_numpy().view(np.uint64), ends


def _overlaps(one: np.ndarray, values: np.ndarray, ends: np.ndarray, some: np.ndarray):
    """Sizes of the intersections of a sorted set with the sets ``some`` of those in ``values``."""
    size = ends[some + 1] - ends[some]
    starts = np.cumsum(size) - size
    of_some = values[np.arange(size.sum()) + np.repeat(ends[some] - starts, size)]
    at = np.minimum(np.searchsorted(one, of_some), len(one) - 1)
    return np.add.reduceat((one[at] == of_some).astype(np.int64), starts)


def _links_of_cell(x: pa.Table, y: pa.Table, percent: int, once: bool) -> pa.Table:
    """Links (a, b) between a row of ``x`` and one of ``y`` of the same family in different
    groups, as many as connect what all of them connect. With ``once`` both hold the same
    nodes, and every pair is looked at from one side."""
    a, b = [], []
    if len(x) and len(y):
        (x_family, y_family), (x_node, y_node) = _codes(x, y, "family"), _codes(x, y, "node")
        x_group, y_group = _codes(x, y, "root")
        joined = np.arange(max(x_group.max(), y_group.max()) + 1)
        (x_sets, x_ends), (y_sets, y_ends) = _lists(x, "shingles"), _lists(y, "shingles")
        x_size, y_size = np.diff(x_ends), np.diff(y_ends)
        x_bits = _lists(x, "sketch")[0].reshape(len(x), -1)
        y_bits = _lists(y, "sketch")[0].reshape(len(y), -1)
        most_apart = SKETCH_BITS - _least_agreement(percent)
        x_order, y_order = np.argsort(x_family), np.argsort(y_family)
        for family in np.unique(x_family):
            first, last = np.searchsorted(x_family, (family, family + 1), sorter=x_order)
            rows = x_order[first:last]
            first, last = np.searchsorted(y_family, (family, family + 1), sorter=y_order)
            others = y_order[first:last]
            for at in range(0, len(rows), BLOCK):
                block = rows[at : at + BLOCK, None]
                fits = 100 * np.minimum(x_size[block], y_size[others]) >= percent * np.maximum(
                    x_size[block], y_size[others]
                )
                fits &= x_group[block] != y_group[others]
                if once:
                    fits &= x_node[block] < y_node[others]
                apart = np.zeros(fits.shape, np.uint16)
                for k in range(SKETCH_BITS // 64):
                    apart += np.bitwise_count(x_bits[block, k] ^ y_bits[others, k])
                fits &= apart <= most_apart
                for i in np.flatnonzero(fits.any(axis=1)):
                    row, some = block[i, 0], others[fits[i]]
                    # what earlier pairs connect need not be connected again
                    some = some[joined[y_group[some]] != joined[x_group[row]]]
                    if not len(some):
                        continue
                    one = x_sets[x_ends[row] : x_ends[row + 1]]
                    both = _overlaps(one, y_sets, y_ends, some)
                    linked = 100 * both >= percent * (len(one) + y_size[some] - both)
                    for other in some[linked]:
                        old, new = joined[y_group[other]], joined[x_group[row]]
                        if old != new:
                            joined[joined == old] = new
                            a.append(row)
                            b.append(other)
    a, b = pa.array(a, pa.int64()), pa.array(b, pa.int64())
    return pa.table({"a": x["node"].take(a), "b": y["node"].take(b)})


def _between_groups(
    nodes: DataFrame, some: DataFrame, percent: int, both_ways: bool, buckets: int
) -> DataFrame:
    """Links (a, b) of one family, ``a`` a node and ``b`` one of ``some``, between groups, that
    connect what all such links connect; ``some`` are all nodes unless ``both_ways``.

    A large family is dealt to a grid: a node on the left goes to all cells of its row, one on
    the right to all of its column, so that every pair meets in one cell; of the same nodes on
    both sides, half of the grid is enough. Small families share ``buckets`` of one cell each.
    """
    own = F.pmod(F.xxhash64("node"), F.col("cells")).cast("int")
    last = F.col("cells") - 1
    after = F.sequence(F.lit(0) if both_ways else own, last)
    before = F.sequence(F.lit(0), last if both_ways else own)
    place = F.xxhash64("family")
    place = F.when(F.col("cells") > 1, place).otherwise(F.pmod(place, F.lit(buckets)))
    where = ("place", "row", "column")
    place = place.alias("place")
    x = nodes.select(*_COMPARED, place, own.alias("row"), F.explode(after).alias("column"))
    y = some.select(
        *[F.col(c).alias(f"of_{c}") for c in _COMPARED],
        place, F.explode(before).alias("row"), own.alias("column"),
    )

    def compare(key, left: pa.Table, right: pa.Table) -> pa.Table:
        same = key[1].as_py() == key[2].as_py()
        right = right.rename_columns([name.removeprefix("of_") for name in right.column_names])
        return _links_of_cell(left, right, percent, same and not both_ways)

    return (
        x.groupBy(*where).cogroup(y.groupBy(*where)).applyInArrow(compare, "a binary, b binary")
    )


def links_of(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) that connect what links between bucket members connect.

    ``members`` has bucket, node and n_members of buckets with two or more; ``sets`` node,
    shingles and sketch of their documents.
    """
    most = members.count()
    candidates = settle_small(_stars(members), most)
    families = components(candidates).select("node", F.col("root").alias("family"))
    sizes = sets.select("node", F.size("shingles").cast("long").alias("n"))
    likely = settle_small(_of_members(candidates, sets, percent), most)
    links = settle(_confirmed(likely, sets, percent))
    all_sets, shingles = sizes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    limit = COMPARED_PER_DOCUMENT * all_sets
    buckets = 1 + max(4 * all_sets // CELL, shingles // CELL_SHINGLES)
    nodes = families.join(sizes, "node")
    for step in range(1, 1 << 20):
        nodes = _in_several_groups(nodes, links, all_sets)
        # every pair is counted from both sides
        pairs = (nodes.agg(F.sum("others")).first()[0] or 0) // 2
        if not pairs:
            break
        full = nodes.join(sets, "node")
        if pairs <= limit:
            last = _between_groups(full, full, percent, False, buckets)
            return links.unionByName(settle(last))
        chosen = F.pmod(F.xxhash64(F.lit(step), "node"), F.lit(1 << 30)) < F.lit(
            max(1, int((1 << 30) * limit / (2 * pairs)))
        )
        new = _between_groups(full, full.where(chosen), percent, True, buckets)
        links = links.unionByName(settle(new))
        nodes = nodes.where(~chosen).select("node", "family", "n")
    return links


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 80,
) -> DataFrame:
    """Per row: doc_id, text_key, n_shingles, component_id, root (of its group; null without
    shingles). Groups connect texts of which the shingle sets of ``size`` words overlap in
    at least ``percent`` of their union; component_id is the group's smallest id."""
    rows = settle(signed(docs, id_col, text_col, size))
    nodes = settle(
        rows.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("one"),
            F.first("bands").alias("bands"),
        )
        .select("node", "one.doc_id", "one.text_key", "bands")
    )
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("n_members")).where("n_members > 1")
    members = settle(buckets.join(sizes, "bucket").select("bucket", "node", "n_members"))
    wanted = settle(
        nodes.select("node", "doc_id", "text_key")
        .join(members.select("node").distinct(), "node", "left_semi")
    )
    sets = _full_sets(docs, wanted, id_col, text_col, size)
    roots = components(links_of(members, sets, percent))
    nodes = nodes.select("node", "doc_id").join(roots, "node", "left")
    nodes = nodes.select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    groups = nodes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = nodes.select("node", "root").join(groups, "root")
    return rows.select("doc_id", "text_key", "n_shingles", "node").join(
        classes, "node", "left"
    ).select(
        "doc_id", "text_key", "n_shingles",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"),
        "root",
    )


def drop_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 80,
) -> DataFrame:
    """One document of each group, whole and with all columns: that of the smallest id.

    Documents without shingles all stay. Rows that repeat an id and a text are one document
    and stay or go together.
    """
    rows = near_classes(docs, id_col, text_col, size, percent)
    best = (
        rows.where("root IS NOT NULL")
        .groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("one"))
        .select("root", F.col("one.doc_id").alias("best_id"), F.col("one.text_key").alias("best"))
    )
    gone = (
        rows.join(best, "root")
        .where(~(F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("text_key") == F.col("best"))))
        .select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"))
    )
    return docs.join(
        gone,
        F.col(f"`{id_col}`").eqNullSafe(F.col("gone_id"))
        & (F.xxhash64(F.col(f"`{text_col}`")) == F.col("gone_key")),
        "left_anti",
    )
