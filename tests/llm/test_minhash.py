import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tracklane.llm import minhash
from tracklane.llm.components import components
from tracklane.llm.shingles import overlap, shingle_set


def shingles(text, size):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, size, percent=80):
    """(id, set size, smallest id of the group) from all pairs of different sets."""
    sets = [shingles(t, size) for _, t in rows]
    ids = defaultdict(list)
    for (i, _), s in zip(rows, sets, strict=True):
        ids[s].append(i)
    distinct = [s for s in ids if s]
    at = defaultdict(list)
    for k, s in enumerate(distinct):
        for x in s:
            at[x].append(k)
    root = list(range(len(distinct)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k, s in enumerate(distinct):
        shared = defaultdict(int)
        for x in s:
            for j in at[x]:
                shared[j] += j < k
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(distinct[j]) - n):
                root[find(k)] = find(j)
    least = defaultdict(list)
    for k, s in enumerate(distinct):
        least[find(k)] += [i for i in ids[s] if i is not None]
    group = {s: min(least[find(k)], default=None) for k, s in enumerate(distinct)}
    return sorted(
        ((i, len(s), group[s] if s else i) for (i, _), s in zip(rows, sets, strict=True)), key=str
    )


def found(df, size):
    rows = minhash.near_classes(df, size=size).select("doc_id", "n_shingles", "component_id")
    return sorted(map(tuple, rows.collect()), key=str)


@pytest.mark.parametrize("size", [4, 5])
def test_classes_against_all_pairs(docs, table, size):
    for df in (docs, table("documents")):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        assert found(df, size) == brute(rows, size)


def family(spark):
    """Chains and stars of edited texts: groups that no single centre reaches."""
    rng = np.random.default_rng(5)
    rows = []
    for g in range(6):
        text = [f"g{g}w{k}" for k in range(160)]
        for step in range(25):
            rows.append((len(rows), " ".join(text)))
            at = rng.choice(160, 1 + (g + step) % 5, replace=False)
            base = text if g % 2 else list(text)
            for k in at:
                base[k] = f"g{g}s{step}k{k}"
            if not g % 2:
                rows.append((len(rows), " ".join(base)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("allowed", [4096, 200])
def test_groups_without_one_centre(spark, monkeypatch, allowed):
    monkeypatch.setattr(minhash, "COMPARED_PER_DOCUMENT", allowed)
    df = family(spark)
    rows = [tuple(r) for r in df.collect()]
    assert found(df, 4) == brute(rows, 4)


def test_bins_agree_as_often_as_the_sets_are_similar():
    rng = np.random.default_rng(3)
    for n in (2, 10, 100, 2000):
        rates = []
        for _ in range(60):
            pool = np.unique(rng.integers(0, 2**63, 2 * n, np.uint64) * np.uint64(2))
            a, b = np.sort(pool[: n + n // 2]), np.sort(pool[n // 2 :])
            want = overlap(a, b) / (len(a) + len(b) - overlap(a, b))
            agree = (minhash.signature(a) == minhash.signature(b)).mean()
            rates.append(agree - want)
        assert abs(np.mean(rates)) < 0.06


def test_sketches_of_similar_sets_agree():
    rng = np.random.default_rng(4)
    for n in (5, 40, 400, 4000):
        for share in (0.8, 0.6):
            same = round(2 * n * share / (1 + share))
            agree = []
            for _ in range(20):
                pool = rng.integers(0, 2**64, 2 * n - same, np.uint64)
                a, b = np.sort(pool[:n]), np.sort(pool[n - same :])
                bits = minhash.sketch(a) ^ minhash.sketch(b)
                agree.append(1024 - sum(int(x).bit_count() for x in bits.view(np.uint64)))
            similar = same / (2 * n - same)
            assert abs(np.mean(agree) - 512 * (1 + similar)) < 16
            if similar >= 0.8:
                assert min(agree) >= minhash._least_agreement(80)


def test_shingles_of_short_texts_and_case():
    assert len(shingle_set("a b c", 4)) == 1
    assert (shingle_set("A B c", 4) == shingle_set("a b  C\n", 4)).all()
    assert len(shingle_set("É é", 1)) == 2 and len(shingle_set(None, 4)) == 0
    assert shingle_set("a b", 4) != shingle_set("b a", 4)


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 50)]
    edges += [(int(a), int(b)) for a, b in rng.integers(200, 400, (120, 2))] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {x: find(x) for x in list(root)}
    assert len(got) == len(root)


def test_drop_near_copies(docs, no_docs):
    kept = minhash.drop_near_copies(docs)
    assert kept.schema.names == docs.schema.names
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    # 1 and 2 are copies; 5 and 6 differ in one word; 4 comes twice without text
    assert ids == sorted([1, 3, 4, 4, 5, 7, None, 8, 9, 10], key=str)
    assert minhash.drop_near_copies(no_docs).count() == 0
    assert minhash.near_classes(no_docs).count() == 0
    assert kept.where(F.col("text").isNull()).count() == 1


@pytest.mark.parametrize("cell", [4, 25])
def test_large_families_are_dealt_to_cells(spark, monkeypatch, cell):
    monkeypatch.setattr(minhash, "CELL", cell)
    df = family(spark)
    rows = [tuple(r) for r in df.collect()]
    assert found(df, 4) == brute(rows, 4)


@pytest.mark.parametrize("rows_per_task", [100, 100_000])
def test_hubs_are_not_brought_to_one_task(spark, monkeypatch, rows_per_task):
    """Neighbours of hubs are joined by broadcast, and the components are the same, as in
    the single task that is enough for few edges."""
    monkeypatch.setattr("tracklane.llm.components.ROWS_PER_TASK", rows_per_task)
    edges = [(0, k) for k in range(1, 900)] + [(5000, k) for k in range(3000, 3600)]
    edges += [(5000, 7000), (7000, 7001)] + [(9000 + k, 9001 + k) for k in range(50)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    got = {r.node: r.root for r in components(df).collect()}
    want = dict.fromkeys(range(900), 0) | dict.fromkeys(range(3000, 3600), 3000)
    want |= dict.fromkeys((5000, 7000, 7001), 3000) | dict.fromkeys(range(9000, 9051), 9000)
    assert got == want


@pytest.mark.parametrize("block", [1, 64])
def test_links_of_one_cell(monkeypatch, block):
    """They connect what all links between groups of a family connect, and nothing else."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = np.random.default_rng(6)
    sets, rows = [], []
    for k in range(60):
        # two families; every third set is a slight change of an earlier one
        new = rng.integers(0, 2**63, 40 + k, np.uint64)
        if k % 3:
            new = sets[k - 1 - k % 2].copy()
            new[rng.choice(len(new), 3, replace=False)] += np.uint64(1)
        sets.append(np.unique(new))
        root = sets[k - k % 2].tobytes()[:16]
        rows.append((bytes([k % 2]), k.to_bytes(16), root, minhash.sketch(sets[k]), sets[k]))
    family, node, root, sketches, shingles_of = zip(*rows, strict=True)
    lists = pa.list_(pa.int64())
    x = pa.table({
        "family": pa.array(family, pa.binary()), "node": pa.array(node, pa.binary()),
        "root": pa.array(root, pa.binary()),
        "sketch": pa.array([v.tolist() for v in sketches], lists),
        "shingles": pa.array([v.view(np.int64).tolist() for v in shingles_of], lists),
    })

    def linked(i, j):
        both = overlap(sets[i], sets[j])
        return 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both)

    def groups(pairs):
        at = {r: r for r in root}
        for i, j in pairs:
            old, new = at[root[i]], at[root[j]]
            at = {r: new if v == old else v for r, v in at.items()}
        return {frozenset(r for r in at if at[r] == v) for v in at.values()}

    every = [
        (i, j) for i in range(60) for j in range(60)
        if family[i] == family[j] and root[i] != root[j] and linked(i, j)
    ]
    assert len(every) > 10
    for once in (True, False):
        found = minhash._links_of_cell(x, x, 80, once).to_pylist()
        pairs = [(int.from_bytes(r["a"]), int.from_bytes(r["b"])) for r in found]
        assert set(pairs) <= set(every) and len(pairs) < len(every)
        assert groups(pairs) == groups(every)
    assert len(minhash._links_of_cell(x, x.slice(0, 0), 80, False)) == 0


def test_cells_are_bounded_by_shingles(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CELL_SHINGLES", 3000)
    df = family(spark)
    rows = [tuple(r) for r in df.collect()]
    assert found(df, 4) == brute(rows, 4)
