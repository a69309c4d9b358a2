from collections import defaultdict

from pyspark.sql import functions as F

from tracklane.llm import exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    best = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
    return sorted(
        ((i, best[t or ""], len(groups[t or ""]), i == best[t or ""]) for i, t in rows), key=str
    )


def classes(df, **options):
    found = exact_dedup.text_classes(df, **options)
    return sorted(map(tuple, found.drop("digest").collect()), key=str)


def test_classes(docs, table):
    for df in (docs, table("documents")):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        assert classes(df) == expected(rows)


def test_texts_decide_when_digests_clash(docs):
    def weak(text):
        return F.unhex(F.lpad(F.hex(F.length(text) % 2), 2, "0"))

    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert classes(docs, digest=weak) == expected(rows)


def test_drop_copies_keeps_one_whole_row_per_text(docs):
    kept = exact_dedup.drop_copies(docs)
    assert kept.schema.names == docs.schema.names
    found = {r.doc_id: r for r in kept.collect()}
    assert len(found) == kept.count() == 9
    assert set(found) == {2, 4, 5, 6, 7, None, 8, 9, 10}
    # of the repeated rows the one with the larger other columns
    assert found[4].kept == 4 and found[4].text == "" and found[2].source == "a"


def test_empty(no_docs):
    assert classes(no_docs) == [] and exact_dedup.drop_copies(no_docs).count() == 0
