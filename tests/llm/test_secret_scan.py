import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tracklane.llm import queries, secret_scan
from tracklane.llm.secret_scan import BASE, MORE, Rule
from tracklane.llm.trigrams import ANY, query_of
from tracklane.session import scratch_path

PIECES = {
    "private_key": "-----BEGIN RSA PRIVATE KEY-----",
    "github": "ghp_" + "a1B2" * 9,
    "slack": "xoxb-12345-abcdef",
    "google": "AIza" + "x" * 35,
    "stripe": "sk_live_" + "Z9" * 8,
    "jwt": "eyJhbGciOiJI.eyJzdWIiOiIx.abc_-",
    "bearer": "Authorization: BEARER  abcdefghij0123456789",
    "login": "postgres://me:pa.ss@host/db",
}
EDGES = [
    # the longer first match uses up what a later one would need
    'secret: "token": abcdefghijklmn',
    "token=token=abcdefghijkl PASSWORD = 'x' Api_Key:0123456789ab apikey==abcdefghijk",
    "AKIAAKIA0123456789 AKIA0123456789ABC AKIA0123456789ABCD akia0123456789abcd",
    "0123456789abcdeF 0123456789abcdef0 é0123456789abcdefé \U0001f600 0123456789abcdef",
    "to ken oke tok passwor ssw",
    "passKey toKen=abcdefghijklmn",
    "token=0123456789abcdef0123",
    "0123456789abcdef",
    " ".join(f"token={k:016x}" for k in range(3000)),
    *PIECES.values(),
    " ".join(PIECES.values()),
]


@pytest.fixture(scope="module")
def texts(spark, docs):
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(EDGES)], "doc_id long, text string")
    return docs.unionByName(more, allowMissingColumns=True).unionByName(more.limit(3), True)


def brute(text, rules):
    text, found = text or "", []
    for order, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text, re.ASCII):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), order, m.end(), rule.kind, m.group()))
    return sorted(found)


def found(df):
    return sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in df.collect()), key=str)


@pytest.mark.parametrize("rules", [BASE, BASE + MORE, MORE[:1], BASE[2:], ()])
def test_spans_against_plain_matching(texts, rules):
    want = [(r.doc_id, brute(r.text, rules)) for r in texts.select("doc_id", "text").collect()]
    assert found(secret_scan.scan(texts, rules)) == sorted(want, key=str)


def test_spans_of_the_table(table):
    rows = table("documents").select("doc_id", "text").collect()
    want = sorted(((r.doc_id, brute(r.text, BASE + MORE)) for r in rows), key=str)
    assert found(secret_scan.scan(table("documents"))) == want


def test_candidates_by_shuffle(spark, texts):
    spark.conf.set("tracklane.broadcastBytes", "0")
    try:
        got = found(secret_scan.scan(texts))
    finally:
        spark.conf.unset("tracklane.broadcastBytes")
    assert got == found(secret_scan.scan(texts))


def test_every_format_is_found(spark):
    df = spark.createDataFrame(list(PIECES.items()), "doc_id string, text string")
    for r in secret_scan.scan(df, MORE).collect():
        assert [s.kind for s in r.spans] == [r.doc_id]


def test_empty_and_clashing_columns(docs, no_docs):
    assert secret_scan.scan(no_docs).count() == 0
    odd = docs.withColumnsRenamed({"lang": "spans", "source": "rules", "carry": "trigram"})
    assert found(secret_scan.scan(odd)) == found(secret_scan.scan(docs))


def test_queries_of_patterns():
    def said(pattern):
        return sorted(sorted(x) for x in query_of(pattern))

    assert said("AKIA[A-Z0-9]+") == [["aki", "kia"]]
    assert said("abcd|xyz") == [["abc", "bcd"], ["xyz"]]
    assert said("ab(c|d)?e") == [["abc", "bce"], ["abd", "bde"], ["abe"]]
    assert said("(foo)*bar.baz") == [["bar", "baz"]]
    assert said("a(bc)+d") == [["abc"]]
    assert said("ab{3}c") == [["abb", "bbb", "bbc"]]
    for none in ("[0-9a-f]{16,}", "a.b.c", "", "ab", "abc|x", "(abc)?", "(?:abc)*", "\\d+", "[^a]bc"):
        assert query_of(none) == ANY
    assert query_of("abc(?=def)") == {frozenset(["abc"])}


@pytest.mark.parametrize("rule", BASE + MORE)
def test_queries_hold_wherever_patterns_match(rule):
    for text in EDGES:
        for m in re.finditer(rule.pattern, text, re.ASCII):
            low = m.group().lower()
            assert any(all(t in low for t in some) for some in query_of(rule.pattern))


def test_index_postings_and_candidates(spark, texts):
    rules = [*BASE, Rule("two", "abcd|wxyz")]
    grams = secret_scan.trigrams_of(rules)
    index = secret_scan.build_index(texts, grams, scratch_path(spark, "test-index"))
    got = {(r.trigram, r.doc_id, r.text_key) for r in index.collect()}
    rows = secret_scan.named(texts, "doc_id", "text").collect()
    assert got == {(t, r.doc_id, r.text_key) for r in rows for t in grams if t in r.text.lower()}
    want = set()
    for r in rows:
        for rule in rules:
            clauses = query_of(rule.pattern)
            if clauses != ANY and any(all(t in r.text.lower() for t in c) for c in clauses):
                want.add((r.doc_id, r.text_key, rule.kind))
    likely = secret_scan.candidates(index, rules).select("doc_id", "text_key", F.explode("rules"))
    assert {tuple(r) for r in likely.collect()} == want


def test_only_built_in_functions(texts):
    plan = secret_scan.scan(texts)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_query_columns(spark, tmp_path, texts):
    texts.write.parquet(str(tmp_path / "documents.parquet"))
    for r in queries.op11_secrets(spark, str(tmp_path)).collect():
        spans = [s.split(":") for s in r.spans.split(",") if s]
        base = [s for s in spans if s[0] in ("assign", "access", "hex")]
        for kind, n in (("assign", r.n_assign), ("access", r.n_access), ("hex", r.n_hex)):
            assert sum(s[0] == kind for s in base) == n
        joined = ",".join(map(":".join, base))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
