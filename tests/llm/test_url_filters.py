import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tracklane.llm import queries, url_filters


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**63), max_size=400), st.floats(0, 1))
def test_cascade_is_exact_over_its_universe(keys, share):
    h1 = np.array(sorted(keys), np.uint64)
    h2 = h1 * np.uint64(0x9E3779B97F4A7C15)
    listed = np.arange(len(h1)) < share * len(h1)
    levels = url_filters.cascade_levels(h1, h2, listed)
    assert (url_filters.in_cascade(levels, h1, h2) == listed).all()


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [
        (len(h + p), h + p, v)
        for v, h, p in queries.URL_RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    listed = any(host == h or host.endswith("." + h) for h in queries.LISTED_HOSTS)
    return host, path, None, "block" if listed else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://com", "http://COM/", "https://a.example.com/en/x",
    "https://www.example.com/en/", "https://x.www.EXAMPLE.com/en/?q=/es/", "http://a.net/es",
    "http://a.net/es/#f", "http://a.net?u=http://b.com/", "http://xnet/es/", "x://free-bets.example.net",
    "x://a.free-bets.example.net?x", "x://notfree-bets.example.net/", "a://b://c.com/d", "http://net/fr/",
    "http://" + "a." * 300 + "com/" + "y" * 50_000, "http://é.example.org/É", "http://com/\n?x",
]


def test_judge_against_rules_one_by_one(spark, monkeypatch):
    rows = [(i, u, "x", 1) for i, u in enumerate(URLS)] + [(6, URLS[6], "x", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, keys string, labels int")
    want = sorted(((i, *brute(u)) for i, u, *_ in rows), key=str)

    def judged():
        found = url_filters.judge(pages, queries.URL_RULES, queries.LISTED_HOSTS)
        return sorted(map(tuple, found.collect()), key=str)

    assert judged() == want
    # several shards in several passes, as where the levels are too large to broadcast
    monkeypatch.setattr(url_filters, "SHARD_KEYS", 20)
    monkeypatch.setattr(url_filters, "BROADCAST_BYTES", 20)
    assert judged() == want


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filters.judge(pages, queries.URL_RULES).count() == 0
