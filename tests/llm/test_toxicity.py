import zlib

import numpy as np
import pytest

from tracklane.llm import toxicity as tox


@pytest.fixture(scope="module")
def small_net():
    texts = ["you bad idiot go", "kind words here", "an idiot again", "nice and kind", "plain"] * 6
    return tox.train(texts, [1, 0, 1, 0, 0] * 6, epochs=3)


def test_gradients_against_differences():
    rng = np.random.default_rng(2)
    net = tox.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = tox.Words([b"alpha", b"be", b"gamma", b"", b"delta"])
    ids = rng.integers(0, 5, (4, 6))
    ids[1, 3:] = -1
    lengths, target = np.array([6, 3, 6, 0]), np.array([1.0, 0.0, 1.0, 0.0])

    def loss():
        x = net.forward(net.projected(net.inputs(words))[ids], lengths)
        return np.mean(np.log1p(np.exp(-np.where(target == 1, x, -x))))

    grads = net.gradients(words, ids, lengths, target)
    for name, grad in grads.items():
        flat = net.p[name].reshape(-1)
        for k in np.argsort(-np.abs(grad.reshape(-1)))[:4]:
            old, step = flat[k], 1e-3
            flat[k] = old + step
            up = loss()
            flat[k] = old - step
            down = loss()
            flat[k] = old
            assert grad.reshape(-1)[k] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=2e-5)


def test_windows_overlap_and_cover():
    for n in (0, 1, 24, 47, 48, 49, 72, 73, 1000):
        ids, lengths = tox.windows_of(np.arange(n))
        seen = [set(row[:k]) for row, k in zip(ids, lengths, strict=True)]
        assert set().union(*seen) == set(range(n))
        for a, b in zip(seen, seen[1:], strict=False):
            assert len(a & b) == tox.WINDOW - tox.STRIDE
        assert (ids[np.arange(tox.WINDOW) >= lengths[:, None]] == -1).all()


def test_ngrams_of_words():
    words = tox.Words([b"ab", b"", b"abcdef", b"ab"])
    by = [set(words.grams[words.owner == k]) for k in range(4)]
    assert by[0] == by[3] and len(by[0]) == 3 and by[1] == {0}  # ^ab ab$ and the shared one
    assert len(by[2]) == 1 + 6 + 4 + 2 and by[0] != by[2]


def test_scores_do_not_depend_on_batches(small_net, monkeypatch):
    texts = [None, "", "kind", "word " * 500 + "idiot", "x" * 100_000, "nice idiot", *["plain"] * 30]
    want = tox.Scorer(small_net).scores(iter(texts))
    monkeypatch.setattr(tox, "WINDOWS_AT_ONCE", 3)
    monkeypatch.setattr(tox, "CACHED_WORDS", 2)
    assert tox.Scorer(small_net).scores(iter(texts)) == pytest.approx(want, abs=1e-5)
    assert ((want > 0) & (want < 1)).all()
    assert want[5] > want[2] and want[3] > want[2]


def test_held_out_accuracy(spark):
    tables = [spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels")]
    docs, labels = tables[0].join(tables[1].select("doc_id"), "doc_id", "left_semi"), tables[1]
    found = tox.score(docs, labels).join(labels, "doc_id").collect()
    for r in found[:200]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.5)
    held = [r for r in found if r.held_out]
    toxic = np.array([r.toxic == 1 for r in held])
    scores = np.array([r.score for r in held])
    rank = scores.argsort().argsort()
    area = (rank[toxic].sum() - toxic.sum() * (toxic.sum() - 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert area > 0.92
    assert (scores[toxic] >= 0.5).mean() > 0.7 and (scores[~toxic] >= 0.5).mean() < 0.03


def test_defined_cases(docs, no_docs, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in tox.score(docs, none).collect()} == {0.5}
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, None), (99, 1)], "doc_id long, toxic int")
    rows = tox.score(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert tox.score(no_docs, labels).count() == 0
