import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tracklane.llm import packing


@pytest.fixture(scope="module")
def exact():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(packing.default_vocabulary())
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def ours():
    return packing.tokenizer(packing.default_vocabulary())


LATIN = st.text(st.characters(max_codepoint=0x24F), max_size=60)


@settings(max_examples=400, deadline=None)
@given(st.one_of(LATIN, st.text(max_size=40), st.lists(LATIN, max_size=8).map(" ".join)))
def test_ids_are_those_of_the_library(exact, ours, text):
    assert ours(text) == exact(text)


def test_ids_of_tables_and_characters(exact, ours, table, monkeypatch):
    texts = [r.text for r in table("documents").select("text").collect()]
    texts += [f"a{chr(c)}b {chr(c)}c" for c in range(0x300) if not 0xD800 <= c < 0xE000]
    texts += ["<|endoftext|> x", "a <|endoftext|> b", "<|endoftext|", "it's we'll I'm 'tis"]
    assert [ours(t) for t in texts] == [exact(t) for t in texts]
    monkeypatch.setattr(packing, "BLOCK", 50)
    assert [ours(t) for t in texts[:50]] == [exact(t) for t in texts[:50]]


def test_a_spelled_special_token_is_one_id(ours):
    assert ours("a <|endoftext|> b") == [64, 220, 50256, 275]


def check(df, exact, context=packing.CONTEXT):
    want = []
    for r in df.select("doc_id", "text").collect():
        ids = [*exact(r.text), 1]
        want.append((str(r.doc_id), zlib.crc32(np.array(ids, "<u4").tobytes()), len(ids)))
    rows = packing.pack(df, context=context).collect()
    assert sum(r.length for r in rows) == sum(w[2] for w in want)
    assert sum(r.start == 0 for r in rows) == len(want)
    wanted = []
    for r in df.select("doc_id", "text").collect():
        ids = [*exact(r.text), 1]
        for start in range(0, len(ids), context):
            part = np.array(ids[start : start + context], "<u4")
            wanted.append((r.doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids)))
    got = [(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= context
    return sum(w[2] for w in want) / (len(sequences) * context)


def test_pack(docs, no_docs, table, exact):
    check(docs, exact)
    assert check(table("documents"), exact) > 0.98
    assert packing.pack(no_docs).count() == 0


def test_pack_in_groups(table, exact, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_DOCS", 40)
    assert check(table("documents"), exact) > 0.9


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 63), min_size=1, max_size=80))
def test_first_fit_decreasing_against_a_plain_search(lengths):
    numbers, offsets = packing.first_fit_decreasing(np.array(lengths), 64)
    filled, want = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = next((k for k, n in enumerate(filled) if n + lengths[i] <= 64), len(filled))
        if at == len(filled):
            filled.append(0)
        want[i] = (at, filled[at])
        filled[at] += lengths[i]
    assert [want[i] for i in range(len(lengths))] == list(zip(numbers, offsets, strict=True))
