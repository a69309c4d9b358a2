import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracklane.llm import hard_negatives
from tracklane.llm.hard_negatives import mine, vectors

NAN, INF = float("nan"), float("inf")


def relabel(i, label):
    return F.when(i % 7 == 0, (label + 1) % 10).otherwise(label)


def brute(rows, every=100, positives=5, negatives=10, low=30, high=90):
    data = []
    for i, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        data.append((i, [math.floor(256 * x) for x in vector], label))
    out = []
    for k, (i, vector, label) in enumerate(data):
        if i is None or i % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(vector, other[1], strict=False)), other[0] is None, other[0] or 0, j)
            for j, other in enumerate(data)
            if j != k
        ]
        scored.sort()
        for score, none, p, _ in [s for s in scored if data[s[3]][2] == label][:positives]:
            fit = [
                s for s in scored
                if data[s[3]][2] != label and -low * score <= -100 * s[0] <= -high * score
            ]
            for rank, (s, n_none, n, _) in enumerate(fit[:negatives], 1):
                out.append((i, None if none else p, rank, None if n_none else n, -score, -s))
    return sorted(out, key=str)


def found(df, **how):
    return sorted(map(tuple, mine(vectors(df, relabel=relabel), **how).collect()), key=str)


def plain(df):
    return [(r.vec_id, r.embedding, r.label) for r in df.collect()]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, odd components, other lengths, ties, repeated rows, and clashing names."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 256], i % 3) for i in range(90)]
    rows += [(0, [0.5, 0.25], 1), (0, [0.5, 0.25], 1), (None, [0.5, 0.25, 1.0], 1), (None, [0.5], 2)]
    rows += [(20, None, 1), (21, [1.0, None], 1), (22, [NAN], 1), (23, [INF, 1.0], 2), (30, [1.0], None)]
    rows += [(40, [], 1), (41, [0.25] * 9, 2), (41, [0.25] * 9, 2), (41, [0.25] * 9, 1)]
    return spark.createDataFrame(
        [(*r, "x", 1, 2) for r in rows],
        "vec_id long, embedding array<double>, label int, block string, place int, score int",
    ).repartition(5)


@pytest.mark.parametrize("how", [{"every": 10}, {"every": 1, "positives": 2, "negatives": 3},
                                 {"every": 5, "low": -50, "high": 100}])
def test_against_all_pairs(odd, how):
    want = brute(plain(odd), **how)
    assert want and found(odd, **how) == want


def test_the_table(table):
    df = table("embeddings")
    assert found(df) == brute(plain(df))
    assert found(df, every=25) == brute(plain(df), every=25)


def test_small_blocks_steps_and_groups(table, monkeypatch):
    df = table("embeddings")
    want = found(df, every=10)
    for name, value in (("BLOCK", 37), ("STEP", 3), ("ANCHORS_AT_ONCE", 16)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert found(df, every=10) == want


def test_nothing_to_mine(odd, spark):
    assert found(odd.where("false")) == []
    assert found(odd.where("vec_id = 7"), every=10) == []
    one = spark.createDataFrame([(100, [1.0], 1), (1, [1.0], 2)], "vec_id long, embedding array<float>, label int")
    assert found(one) == []
    assert mine(vectors(odd.where("false"))).columns == mine(vectors(odd), every=10).columns


def test_huge_components_do_not_overflow(spark):
    df = spark.createDataFrame(
        [(0, [1e300, -1e300], 1), (1, [1e300, -1e300], 1), (2, [1e5, 0.0], 2)],
        "vec_id long, embedding array<double>, label int",
    )
    top = 2 * hard_negatives.LARGEST**2
    got = mine(vectors(df), low=0, high=100).collect()
    assert [(r.positive_score, r.negative_score) for r in got] == [
        (top, hard_negatives.LARGEST * 25_600_000)
    ]


def _block(rng, dims, n):
    matrix = rng.integers(-40, 41, (dims, n)).astype(np.int32)
    return hard_negatives._Block(
        {"block": 0, "dims": dims, "ids": list(range(n)), "nulls": [False] * n,
         "labels": [0] * n, "matrix": matrix.tobytes()}
    )


def test_candidates_shrink_before_all_dimensions_are_read(monkeypatch):
    monkeypatch.setattr(hard_negatives, "STEP", 4)
    rng = np.random.default_rng(1)
    block = _block(rng, 64, 4000)
    anchor = (1000 * 0.7 ** np.arange(64)).astype(np.int64)
    read = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, tuple):
                read.append(len(key[1]))
            return super().__getitem__(key)

    exact = anchor @ block.matrix
    block.matrix = block.matrix.view(Watched)
    best = hard_negatives.Best(10)
    scan = (np.array([hard_negatives._NONE]), np.array([hard_negatives._ALL]), [best])
    hard_negatives.scan_block(block, anchor, np.arange(4000), *scan)
    order = sorted(range(4000), key=lambda i: (-exact[i], i))[:10]
    assert [r[4] for r in best.rows] == order
    assert read and read[-1] < 100
