import math
import re

import pytest
from pyspark.sql import functions as F

from tracklane.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    repeated = set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            repeated |= set(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(repeated),
        len(words) < 10 or 100 * len(repeated) > 20 * len(words),
    )


def test_measures(docs, table):
    labels = table("labels")
    for df in (docs, table("documents")):
        rows = df.select("doc_id", "text").collect()
        want = sorted(((r.doc_id, *measures(r.text)) for r in rows), key=str)
        got = quality.judge(df, labels).select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed",
        )
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_binomial_tail(spark):
    cases = [(10, 0, 0.01), (500, 3, 0.01), (2000, 19, 0.01), (100000, 950, 0.01), (50, 50, 0.01)]
    df = spark.createDataFrame(cases, "n long, k long, p double")
    tails = [
        r[0] for r in df.select(quality.binomial_tail(F.col("n"), F.col("k"), 0.01)).collect()
    ]
    for (n, k, p), tail in zip(cases, tails, strict=True):
        exact = 1.0 if k >= n * p else math.fsum(
            math.exp(
                math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1)
                + j * math.log(p) + (n - j) * math.log1p(-p)
            )
            for j in range(k + 1)
        )
        assert tail == pytest.approx(exact, rel=1e-6)


def scored(spark):
    """Stratum a: 1000 good documents, 5 of them above 0.3; b: 100 good ones; null: none."""
    rows = [(i, "a", 0.4 if i < 5 else 0.05) for i in range(1000)]
    rows += [(1000 + i, "b", 0.0) for i in range(100)]
    rows += [(2000 + i, "a", 0.9) for i in range(50)] + [(3000, None, 0.9)]
    return spark.createDataFrame(rows, "doc_id long, stratum string, junk double")


def test_cutoffs_against_brute_force(spark):
    df = scored(spark)
    labels = df.selectExpr("doc_id", "if(doc_id < 2000, 1, 0) AS quality")
    found = {
        r.stratum: r.cutoff
        for r in quality.certified_cutoffs(df, labels, max_false_rejection=0.01).collect()
    }

    def tail(n, k):
        return sum(math.comb(n, j) * 0.01**j * 0.99 ** (n - j) for j in range(k + 1))

    want = {}
    for stratum, values in {"a": [0.4] * 5 + [0.05] * 995, "b": [0.0] * 100}.items():
        for c in quality.CUTOFFS:
            if 2 * tail(len(values), sum(v > c for v in values)) > 0.05:
                break
            want[stratum] = c
    assert found == want == {"a": 0.4}


def test_false_rejection_is_limited(spark, table):
    labels = table("labels")
    found = quality.judge(table("documents"), labels)
    good = found.join(labels.where("quality = 1"), "doc_id").where("not base_failed")
    assert good.where("not kept").count() <= 0.02 * good.count()


def test_keep_good(docs, no_docs, table):
    labels = table("labels")
    kept = quality.keep_good(docs, labels)
    assert kept.schema.names == docs.schema.names
    judged = quality.judge(docs, labels).where("kept")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in judged.collect())
    assert quality.judge(no_docs, labels).count() == 0
    unlabelled = quality.judge(docs, labels.where("false"))
    assert unlabelled.where("kept <> (NOT base_failed)").count() == 0
