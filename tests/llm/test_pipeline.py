"""The pipeline's stages against plain Python, each on what its predecessor kept."""

import pytest
from test_minhash import brute
from test_mixing import targets
from test_quality import WORD, measures

import corpus_pipeline
from tracklane.llm import quality

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage returned, as (columns, rows)."""
    top = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = {"": (docs.columns, docs.collect())}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(top / name))
        docs = spark.read.parquet(str(top / name))
        out[name] = (docs.columns, docs.collect())
    return out


def test_columns_and_order(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for name in names[:-1]:
        assert stages[name][0] == stages[""][0]


def test_quality_rules(stages, spark):
    rows, kept = stages[""][1], {r.doc_id for r in stages["quality_rules"][1]}
    failed = {r.doc_id for r in rows if measures(r.text)[-1]}
    judged = quality.judge(
        spark.read.parquet(f"{SF_DIR}/documents.parquet"),
        spark.read.parquet(f"{SF_DIR}/labels.parquet"),
    )
    assert kept == {r.doc_id for r in judged.collect() if r.kept}
    assert not kept & failed and len(kept) > 0.9 * (len(rows) - len(failed))


def test_copies(stages):
    before = stages["quality_rules"][1]
    best = {}
    for r in before:
        best[r.text] = max(best.get(r.text, r.doc_id), r.doc_id)
    assert sorted(best.values()) == sorted(r.doc_id for r in stages["exact_copies"][1])
    rows = [(r.doc_id, r.text) for r in stages["exact_copies"][1]]
    heads = {c for _, n, c in brute(rows, 5) if n}
    assert heads | {i for i, n, _ in brute(rows, 5) if not n} == {
        r.doc_id for r in stages["near_copies"][1]
    }


def test_mix_and_packing(stages):
    before = stages["near_copies"][1]
    size = {r.doc_id: len(WORD.findall(r.text)) for r in before}
    of = {r.doc_id: r.source for r in before}
    sums, largest, taken = {}, {}, {}
    for i, n in size.items():
        sums[of[i]] = sums.get(of[i], 0) + n
        largest[of[i]] = max(largest.get(of[i], 0), n)
    for r in stages["source_mix"][1]:
        taken[r.source] = taken.get(r.source, 0) + size[r.doc_id]
    for source, want in targets(sums).items():
        assert abs(taken.get(source, 0) - want) <= largest[source] / 2 + 1
    mixed = sorted(r.doc_id for r in stages["source_mix"][1])
    assert sorted(r.doc_id for r in stages["packed"][1] if r.start == 0) == mixed


def test_run(spark, stages):
    run = corpus_pipeline.run(spark, SF_DIR)
    assert run.columns == stages["packed"][0]
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in run.collect()) == sorted(
        (r.doc_id, r.start, r.ids_crc32) for r in stages["packed"][1]
    )
