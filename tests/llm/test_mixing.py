import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tracklane.llm import mixing


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Reshare by weight, round by round, until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        full = {s for s in free if left * weight[s] / total > most * sizes[s]}
        if not full:
            out |= {s: left * weight[s] / total for s in free}
            break
        for s in full:
            out[s] = most * sizes[s]
        left -= sum(most * sizes[s] for s in full)
        free -= full
    return out


def check(df):
    rows = df.select("doc_id", "text", "source").collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sums, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sums[r.source] += size(r.text)
    want = targets(sums)
    found = mixing.words_taken(df).collect()
    assert sorted(str((r.doc_id, r.source, r["size"])) for r in found) == sorted(
        str((r.doc_id, r.source, size(r.text))) for r in rows
    )
    for r in found:
        assert r.source_size == sums[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    for source, words in taken.items():
        assert abs(words - want[source]) < 1.01


def test_words_taken(docs, table):
    check(docs)
    check(table("documents"))


def test_many_slices_give_the_same_mix(table, monkeypatch):
    key = lambda df: sorted(map(tuple, mixing.words_taken(df).collect()))
    one = key(table("documents"))
    monkeypatch.setattr(mixing, "SLICE_ROWS", 2)
    assert key(table("documents").repartition(5)) == one


def test_mix_is_sorted_by_virtual_finish_and_ends_with_the_budget(table):
    rows = mixing.measured(table("documents"), F.col("doc_id"), "doc_id", "text", "source", 7)
    queue = mixing.queued(rows)
    mixed = mixing.mix(queue).collect()
    times = [r.virtual_finish for r in mixed]
    assert times == sorted(times)
    budget = 1.5 * sum(r["size"] for r in queue.select("size").collect())
    sources = len({r.source for r in mixed})
    assert budget - sources <= sum(r.words for r in mixed) <= budget
    # a queue serves its documents one after the other
    for source in {r.source for r in mixed}:
        own = [r for r in mixed if r.source == source]
        for a, b in zip(own, own[1:], strict=False):
            assert a.start + a.words == b.start


def test_mix_documents(docs, no_docs):
    mixed = mixing.mix_documents(docs)
    assert mixed.schema.names == docs.schema.names
    counts = mixed.groupBy("doc_id", "kept").count().collect()
    assert all(r["count"] <= 2 for r in counts)
    assert mixing.mix_documents(no_docs).count() == mixing.words_taken(no_docs).count() == 0


def test_source_with_limit_and_without_words(spark):
    sums = spark.createDataFrame(
        [("a", 100), ("b", 0), ("c", 10), (None, 1000), ("d", 3)],
        "source string, source_size long",
    )
    got = {r.source: r.target for r in mixing.source_targets(sums).collect()}
    want = targets({"a": 100, "b": 0, "c": 10, None: 1000, "d": 3})
    assert got == pytest.approx(want)


def test_words_taken_are_those_of_the_sorted_mix(docs, table, monkeypatch):
    calls, mix = [], mixing.mix
    monkeypatch.setattr(mixing, "mix", lambda queue: calls.append(1) or mix(queue))
    check(docs)
    check(table("documents"))
    assert len(calls) == 2


def test_the_mix_is_truncated_at_the_budget(spark):
    rows = [(i, "a" if i % 2 else None, 10.0 if i % 2 else 5.5, 4, i / 10.0, i) for i in range(8)]
    mixed = spark.createDataFrame(
        rows, "s long, source string, target double, words long, virtual_finish double, turn long"
    ).selectExpr("struct(s AS seat) AS carry", "*", "0 AS pass", "turn AS turn_id")
    found = mixing.served_in_budget(mixed.repartition(3).orderBy("virtual_finish")).collect()
    assert [r.words for r in sorted(found)] == [4, 4, 4, 3, 0, 0, 0, 0]
