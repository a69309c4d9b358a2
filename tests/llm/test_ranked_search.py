import math
import re
from collections import Counter

import numpy as np
import pytest

from tracklane.llm import ranked_search
from tracklane.llm.ranked_search import Best, Tree, rank, search, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def brute(docs, items, size=10):
    texts = [(i, Counter(plain_terms(t))) for i, t in docs]
    n_docs = sum(bool(t) for _, t in texts)
    n_terms = sum(sum(t.values()) for _, t in texts)
    df = Counter(term for _, t in texts for term in t)
    out = []
    for item, text in set(items):
        scored = []
        for i, t in texts:
            m = 10 + 90 * sum(t.values()) * n_docs // max(n_terms, 1)
            score = 0
            for term in set(plain_terms(text)):
                if t[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += w * (1_000_000_000 * t[term] // (1000 * t[term] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, k, i, -s) for k, (s, _, i) in enumerate(scored[:size], 1)]
    return sorted(out, key=str)


def found(docs, items, **how):
    return sorted(map(tuple, rank(docs, items, **how).collect()), key=str)


def pairs(df, i, t="text"):
    return [(r[i], r[t]) for r in df.collect()]


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "one TWO three"), (1, "one TWO three"), (1, "seven"), (2, None), (3, ""), (None, "a b z"),
            (4, "w1x1 w2x2 end end unknown"), (5, " x id É"), (6, "!!"), (7, "unknown")]
    return spark.createDataFrame(
        [(*r, 1, 2, "x") for r in rows], "item_id long, text string, doc_id long, score int, terms string"
    )


def test_terms():
    for text in ("Ab-c_D9éÉ \x7f\x80x[Z]^`{q}K", "", None, "   a\x1cb"):
        assert [t.decode() for t in terms_of(text)] == plain_terms(text)


@pytest.mark.parametrize("size", [10, 2])
def test_against_plain_scores(docs, items, size):
    want = brute(pairs(docs, "doc_id"), pairs(items, "item_id"), size)
    assert want and found(docs, items, size=size) == want


def test_the_tables(table):
    docs, items = table("documents"), table("benchmark")
    assert found(docs, items) == brute(pairs(docs, "doc_id"), pairs(items, "item_id"))


def test_small_trees_and_several_passes(table, monkeypatch):
    docs, items = table("documents").repartition(3), table("benchmark")
    want = brute(pairs(docs, "doc_id"), pairs(items, "item_id"))
    for name, value in (("TERMS_AT_ONCE", 300), ("CELLS", 4000), ("LEAF", 2), ("CHILDREN", 3)):
        monkeypatch.setattr(ranked_search, name, value)
    assert found(docs, items) == want


def test_empty_tables(docs, no_docs, items):
    assert found(no_docs, items) == [] and found(docs, items.where("false")) == []
    assert rank(no_docs, items).columns == rank(docs, items.where("false")).columns


def _random(rng, n, width, repeat):
    tf = rng.poisson(0.6 * 0.93 ** np.arange(width), (n, width)).astype(np.int32)
    tf = tf[rng.integers(0, n, n)] if repeat else tf
    m = rng.integers(10, 400, n)
    return tf, m, rng.permutation(n), np.zeros(n, bool)


@pytest.mark.parametrize("repeat", [False, True])
@pytest.mark.parametrize("leaf,children", [(1, 2), (4, 3), (16, 32)])
def test_trees_cover_all_and_bounds_hold(monkeypatch, repeat, leaf, children):
    monkeypatch.setattr(ranked_search, "LEAF", leaf)
    monkeypatch.setattr(ranked_search, "CHILDREN", children)
    tree = Tree(*_random(np.random.default_rng(leaf), 500, 40, repeat))
    seen, todo = [], [tree.root]
    while todo:
        node = todo.pop()
        for k, (lo, hi) in enumerate(zip(node.starts, node.ends)):
            assert (node.most[k] == tree.tf[lo:hi].max(axis=0)).all()
            assert node.least_m[k] == tree.m[lo:hi].min()
            below = node.nodes[k]
            if below is None:
                seen += range(lo, hi)
            else:
                assert (below.starts[0], below.ends[-1]) == (lo, hi)
                todo.append(below)
    assert sorted(seen) == list(range(500))
    # documents of a subtree share their first terms: neighbours in order of presence
    held = [tuple(row) for row in tree.tf > 0]
    assert held == sorted(held, reverse=True)


def test_search_leaves_out_subtrees():
    rng = np.random.default_rng(9)
    tf, m, ids, nulls = _random(rng, 6000, 60, False)
    # two languages, and a few documents that hold far more of the item's terms
    tf[:3000, 1::2] = 0
    tf[3000:, ::2] = 0
    tf[:20, :30:2] += 5
    tree, columns = Tree(tf, m, ids, nulls), np.arange(0, 30, 2)
    weights = np.sort(rng.integers(1, 5000, len(columns)))
    best = Best(10)
    scored = search(tree, columns, weights, best)
    exact = ranked_search.scores(weights, tf[:, columns], m)
    order = np.lexsort((ids, -exact))[:10]
    assert best.ids.tolist() == ids[order].tolist()
    assert best.scores.tolist() == exact[order].tolist()
    assert scored < 3000
