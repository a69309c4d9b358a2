"""URL rules by a cascade of Bloom filters.

The keys of a URL are its host and parent domains, each followed by a beginning of its
path. All keys of the corpus, and those of the lists, form the key universe. For each list
the first filter holds its keys, the next one the universe's false positives of the first,
the next one the list's false positives of the second, and so on until none is left. Walking
down the levels gives exact membership for every key of the universe; URLs are judged
without a join with the lists.

Keys are dealt to shards of bounded size by their hash and a shard's levels are built in
one task. The finished levels are broadcast if their size, which is added up first, stays
within ``BROADCAST_BYTES``; otherwise the URLs are looked up in several passes, each with
as many shards as fit.

Defined cases: a URL that is null or without ``://`` has an empty host and path and meets
no rule; repeated rows are judged alike; an empty table or list gives an empty result or
no hits; columns of other names are carried along by ``look_up`` and ignored by ``judge``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklane.session import settle

SHARD_KEYS = 1_000_000
BROADCAST_BYTES = 32 << 20
#: Two keys that agree in 128 bits of hash cannot be told apart; no cascade ends for them.
MAX_LEVELS = 100

ALLOW, BLOCK, LISTED = 0, 1, 2
_LEVEL = "label int, shard long, level int, n_bits long, n_hashes int, bits binary"


# ---- Bloom filters over pairs of 64-bit hashes -------------------------------------


def _places(h1: np.ndarray, h2: np.ndarray, level: int, n_bits: int, n_hashes: int):
    step = h2 | np.uint64(1)
    at = h1 ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    at = (at ^ (at >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(n_hashes):
        yield ((at ^ (at >> np.uint64(29))) % np.uint64(n_bits)).astype(np.int64)
        at = at * np.uint64(0xBF58476D1CE4E5B9) + step


def bloom_filter(h1, h2, level: int, rate: float) -> tuple[int, int, np.ndarray]:
    """n_bits, n_hashes and the packed bits of a filter with about this false positive rate."""
    n_bits = max(64, math.ceil(len(h1) * math.log2(1 / rate) / math.log(2)))
    n_hashes = max(1, round(math.log2(1 / rate)))
    bits = np.zeros(n_bits, bool)
    for at in _places(h1, h2, level, n_bits, n_hashes):
        bits[at] = True
    return n_bits, n_hashes, np.packbits(bits)


def in_filter(bits: np.ndarray, h1, h2, level: int, n_bits: int, n_hashes: int) -> np.ndarray:
    found = np.ones(len(h1), bool)
    for at in _places(h1, h2, level, n_bits, n_hashes):
        found &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
    return found


def cascade_levels(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> list[tuple]:
    """(n_bits, n_hashes, bits) per level for a universe of keys and which of them are listed."""
    inside, outside, levels = np.flatnonzero(listed), np.flatnonzero(~listed), []
    rate = min(0.5, max(1e-6, math.sqrt(0.5) * len(inside) / max(1, len(outside))))
    while len(inside):
        if len(levels) == MAX_LEVELS:
            raise ValueError("a listed and an unlisted key have equal hashes")
        level = bloom_filter(h1[inside], h2[inside], len(levels), rate)
        hit = in_filter(level[2], h1[outside], h2[outside], len(levels), *level[:2])
        levels.append(level)
        inside, outside, rate = outside[hit], inside, 0.5
    return levels


def in_cascade(levels: list[tuple], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Membership of keys of the universe: the parity of the level at which a key drops out."""
    listed, left = np.zeros(len(h1), bool), np.arange(len(h1))
    for k, (n_bits, n_hashes, bits) in enumerate(levels):
        left = left[in_filter(bits, h1[left], h2[left], k, n_bits, n_hashes)]
        if k % 2 == 0:
            listed[left] = True
        else:
            listed[left] = False
    return listed


# ---- keys --------------------------------------------------------------------------


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(
        F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0
    )
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return low, path


def url_keys(host: Column, path: Column, path_lengths: Sequence[int]) -> Column:
    """All keys of a URL, the longest first."""
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    fitting = F.filter(
        F.array(*[F.lit(int(n)) for n in path_lengths]), lambda n: n <= F.length(path)
    )
    keys = F.flatten(
        F.transform(
            domains,
            lambda d: F.transform(fitting, lambda n: F.concat(d, F.substring(path, F.lit(1), n))),
        )
    )
    by_length = F.sort_array(
        F.transform(keys, lambda k: F.struct(F.length(k).alias("n"), k.alias("k"))), asc=False
    )
    return F.array_distinct(F.transform(by_length, lambda x: x["k"]))


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit("second"), key)


# ---- build and look up -------------------------------------------------------------


def build_cascades(universe: DataFrame, lists: DataFrame) -> DataFrame:
    """The levels of one cascade per label: label, shard, level, n_bits, n_hashes, bits.

    ``universe`` has a column key, ``lists`` key and label. A key with several labels has
    the smallest.
    """
    first, second = _hashes(F.col("key"))
    keys = settle(
        universe.select("key", F.lit(None).cast("int").alias("label"))
        .unionByName(lists.select("key", F.col("label").cast("int")))
        .groupBy("key")
        .agg(F.min("label").alias("label"))
        .select("label", first.alias("h1"), second.alias("h2"))
    )
    shards = max(1, math.ceil(keys.count() / SHARD_KEYS))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = (group[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
        labels = group["label"].to_numpy(float, na_value=np.nan)
        shard = int(group["shard"].iloc[0])
        return pd.DataFrame(
            [
                (int(label), shard, level, n_bits, n_hashes, bits.tobytes())
                for label in np.unique(labels[~np.isnan(labels)])
                for level, (n_bits, n_hashes, bits) in enumerate(
                    cascade_levels(h1, h2, labels == label)
                )
            ],
            columns=["label", "shard", "level", "n_bits", "n_hashes", "bits"],
        )

    return settle(
        keys.withColumn("shard", F.pmod("h1", F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(build, _LEVEL)
        .withColumn("shards", F.lit(shards))
    )


def _with_labels(rows: DataFrame, levels: dict, shards: int) -> DataFrame:
    """Fill ``labels`` (one per key) for keys of the shards in ``levels``."""
    schema = T.StructType(rows.schema.fields)
    place = rows.columns.index("labels")
    names = rows.columns

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = (
                batch.column(names.index(c)).flatten().to_numpy(zero_copy_only=False)
                for c in ("h1", "h2")
            )
            old = batch.column(place)
            labels = old.flatten().to_numpy(zero_copy_only=False).copy()
            shard = np.mod(h1, shards)
            for (label, s), cascade in levels.items():
                mine = np.flatnonzero(shard == s) if shards > 1 else np.arange(len(h1))
                hit = in_cascade(cascade, h1[mine].view(np.uint64), h2[mine].view(np.uint64))
                labels[mine[hit]] = label
            counts = np.concatenate([[0], np.cumsum(old.value_lengths().to_numpy(False))])
            filled = pa.ListArray.from_arrays(
                pa.array(counts, pa.int32()), pa.array(labels, pa.int32())
            )
            columns = [filled if i == place else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(fill, schema)


def look_up(rows: DataFrame, cascades: DataFrame, keys_col: str = "keys") -> DataFrame:
    """``rows`` with ``labels``: for each key its label, or -1 where no list has it."""
    rows = rows.select(
        "*",
        F.transform(keys_col, lambda k: _hashes(k)[0]).alias("h1"),
        F.transform(keys_col, lambda k: _hashes(k)[1]).alias("h2"),
        F.transform(keys_col, lambda k: F.lit(-1)).alias("labels"),
    )
    sizes = (
        cascades.groupBy("shard").agg(F.sum(F.length("bits")).alias("n"), F.max("shards"))
        .orderBy("shard").collect()
    )  # one row for a million keys
    shards = sizes[0][2] if sizes else 1
    passes: list[list[int]] = []
    room = 0
    for shard, n, _ in sizes:
        if not passes or n > room:
            passes.append([])
            room = BROADCAST_BYTES
        passes[-1].append(shard)
        room -= n
    for k, part in enumerate(passes):
        levels: dict = {}
        found = cascades.where(F.col("shard").isin(part)).orderBy("label", "shard", "level")
        for r in found.toLocalIterator():
            levels.setdefault((r.label, r.shard), []).append(
                (r.n_bits, r.n_hashes, np.frombuffer(r.bits, np.uint8))
            )
        rows = _with_labels(settle(rows) if k else rows, levels, shards)
    return rows.drop("h1", "h2")


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    listed_hosts: Sequence[str] = (),
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict.

    ``rules`` are (verdict, host, path); the longest that fits decides. Where none fits,
    a URL is blocked if its host or a parent domain is in ``listed_hosts``.
    """
    spark: SparkSession = pages.sparkSession
    named = {"allow": ALLOW, "block": BLOCK}
    entries = [(host + path, named[verdict]) for verdict, host, path in rules]
    entries += [(host, LISTED) for host in listed_hosts]
    lengths = sorted({len(path) for _, _, path in rules} | ({0} if listed_hosts else set()))
    lists = spark.createDataFrame(entries, "key string, label int")
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    urls = urls.withColumn("keys", url_keys(F.col("host"), F.col("path"), lengths))
    universe = urls.select(F.explode("keys").alias("key"))
    found = look_up(urls, build_cascades(universe, lists))
    hits = F.arrays_zip("keys", "labels")
    rule = F.get(F.filter(hits, lambda x: x["labels"].isin(ALLOW, BLOCK)), F.lit(0))
    listed = F.array_contains("labels", LISTED)
    return found.select(
        "page_id", "host", "path",
        rule["keys"].alias("rule"),
        F.when(rule["labels"] == ALLOW, "allow")
        .when(rule["labels"] == BLOCK, "block")
        .when(listed, "block")
        .otherwise("allow")
        .alias("verdict"),
    )
