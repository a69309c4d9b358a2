import gzip
import hashlib

import pytest

from tracklane.llm import warc
from tracklane.session import scratch_path

LONG = "<p>" + "é" * 200_000
ROWS = [
    (1, "http://b.example.com/x", "a" * 99, "k"), (2, "http://b.example.com/y", "a" * 99, "k"),
    (3, "http://a.example.com/", "b" * 100, "k"), (4, "http://a.example.com/", "b" * 100, "k"),
    (9, "https://B.example.com/x", "b" * 100, "k"), (9, "https://B.example.com/x", "b" * 100, "k"),
    (5, None, None, "k"), (6, "", "", "k"), (None, "http://c/ \n", "b" * 100, "k"),
    (7, "no scheme", LONG, "k"), (8, "http://d?x#y", LONG, "k"), (3, "http://a.example.com/", "b" * 100, "k"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string, key string").repartition(3)


@pytest.fixture(scope="module")
def archives(spark, pages):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages, path)
    return spark.read.parquet(path)


def expected():
    out = []
    for page_id, _, text, _ in ROWS:
        payload = (text or "").encode()
        same = [r[0] for r in ROWS if (r[2] or "").encode() == payload and r[0] is not None]
        revisit = len(payload) >= 100 and page_id != min(same)
        out.append(
            (page_id, len(payload), hashlib.sha256(payload).hexdigest(),
             "revisit" if revisit else "response", min(same) if revisit else None)
        )
    return sorted(out, key=str)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def rows_of(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()), key=str)


def test_round_trip(archives):
    assert rows_of(warc.read_archives(archives)) == expected()


def test_members_follow_each_other_and_make_a_file(archives):
    files = {}
    for r in archives.orderBy("archive", "offset").collect():
        file = files.setdefault(r.archive, bytearray())
        assert r.offset == len(file) and r.length == len(r.member)
        file += r.member
    text = b"".join(gzip.decompress(bytes(f)) for f in files.values())
    assert text.count(b"WARC/1.1\r\n") == len(ROWS)
    # a payload is stored once
    assert text.count(b"b" * 100) == 2 and text.count("é".encode() * 200_000) == 1


@pytest.mark.parametrize(("lines", "reads"), [(3000, 1000), (1, 1000), (2, 1)])
def test_index_finds_every_capture(spark, pages, archives, monkeypatch, lines, reads):
    monkeypatch.setattr(warc, "BLOCK_LINES", lines)
    monkeypatch.setattr(warc, "RANGE_READS", reads)
    index = warc.build_index(warc.read_archives(archives))
    assert rows_of(warc.fetch(archives, warc.look_up(index, pages))) == expected()
    one = spark.createDataFrame([("http://a.example.com/",), ("http://none/",)], "url string")
    found = warc.fetch(archives, warc.look_up(index, one))
    assert sorted(r.page_id for r in found.collect()) == [3, 3, 4]


def test_damaged_payloads_are_errors():
    member = gzip.compress(warc.record(1, "u", b"x", hashlib.sha256(b"y").hexdigest(), None))
    with pytest.raises(ValueError, match="digest"):
        warc.parsed(member)


def test_keys_sort_by_domain():
    assert warc.url_key("http://www.Example.com/a?b") == "com,example,www)/a?b"
    assert warc.url_key("") == "" and warc.url_key("http://x#y") == "x)#y"


def test_empty(spark, pages):
    path = scratch_path(spark, "warc-empty")
    warc.write_archives(pages.where("false"), path)
    archives = spark.read.parquet(path)
    index = warc.build_index(warc.read_archives(archives))
    assert warc.fetch(archives, warc.look_up(index, pages)).count() == 0
