"""License scans by matching template markup.

A template is license wording with marked regions: ``<<beginOptional>> .. <<endOptional>>``
(may be missing, may be nested) and ``<<var;words=1-4>>`` (any words, so many). It is
compiled into an automaton over words: every mandatory word must stand in its place, an
optional region may be skipped, a replaceable region reads any words within its bounds.
Sets of states are turned into single states as texts need them. A text has the template's
label if the automaton accepts words that stand consecutively anywhere in it.

``TEMPLATES`` are notices and the openings of grants, not whole licenses: what they find says
that a license is named or its text begins. Whole texts are those of ``license_texts``, which
are matched as well; a label of theirs means that all the mandatory wording is there, in one
piece. An opening that no whole text begins at has a label ending in ``-opening`` and a lower
score among them: the text goes on differently, as in the JSON License, or stops. For whole
texts typographic quotes and dashes do not count.

A template is only run on texts that contain its longest run of mandatory words, from the
places where one of its possible first words stands.

Defined cases: a null text is empty and has no words; repeated rows say the same; other
columns are ignored whatever their names; an empty table gives an empty result; texts of
any length are scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklane.llm.license_texts import TEXTS

#: Phrases whose places are counted, with their labels.
PHRASES = {
    "cc-by": "cc by",
    "gpl": "general public license",
    "reserved": "all rights reserved",
}
#: Notices and openings of grants as they are usually worded.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license <<beginOptional>>version<<endOptional>> 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification "
    "are permitted provided that the following conditions are met",
    "cc-by-nc-4.0": "licensed under <<beginOptional>>a<<endOptional>> "
    "<<beginOptional>>creative commons<<endOptional>> cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under <<beginOptional>>a<<endOptional>> "
    "<<beginOptional>>creative commons<<endOptional>> cc by sa 4 0",
    "copyright": "copyright <<beginOptional>>c<<endOptional>> <<var;words=1-8>> all rights reserved",
    "gpl-3.0": "gnu general public license <<beginOptional>>as published by the free software "
    "foundation <<beginOptional>>either<<endOptional>><<endOptional>> version 3",
    "mit": "<<beginOptional>>released<<endOptional>> <<beginOptional>>licensed<<endOptional>> "
    "under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of "
    "<<var;words=1-12>> to deal in the software without restriction",
}
#: Of these, the openings of whole texts, and their score if the rest is another.
OPENINGS = ("bsd", "mit-text")
OPENING_SCORE = 0.25
#: Quotes and dashes that copies have in place of ASCII ones.
TYPOGRAPHIC = "\u2010\u2011\u2013\u2014\u2018\u2019\u201c\u201d\u2022\u00ab\u00bb\u00b7"

_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
_SPACES = re.compile(rb" {2,}")
_MARK = re.compile(r"<<(beginOptional|endOptional|var;words=(\d+)-(\d+))>>")


def normalised(text: str | None) -> bytes:
    """Words (a-z, 0-9 and all above U+007F; A-Z lowered) between single spaces."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES)
    raw = _SPACES.sub(b" ", b" " + raw + b" ")
    return raw if raw != b" " else b""


class Template:
    """The automaton of one template. State 0 is the start; ``accepting`` ends a match."""

    def __init__(self, markup: str):
        self.moves: list[dict[bytes | None, set[int]]] = []
        self.free: list[set[int]] = []
        self.anchor = b""
        at, opened, run = self._state(), [], []
        start = 0
        marks = [*_MARK.finditer(markup), None]
        for mark in marks:
            text = markup[start : mark.start() if mark else len(markup)]
            for word in normalised(text).split():
                at = self._step(at, word)
                run.append(word)
                if not opened:
                    self.anchor = max(self.anchor, b" ".join(run), key=len)
            if mark is None:
                break
            start, run = mark.end(), []
            if mark[1] == "beginOptional":
                opened.append(at)
            elif mark[1] == "endOptional":
                skipped = self._state()
                self.free[at].add(skipped)
                self.free[opened.pop()].add(skipped)
                at = skipped
            else:
                low, high = int(mark[2]), int(mark[3])
                ends = [at]
                for _ in range(high):
                    at = self._step(at, None)
                    ends.append(at)
                for early in ends[low:-1]:
                    self.free[early].add(at)
        if opened or not self.anchor:
            raise ValueError("a template needs mandatory words and closed regions")
        self.accepting = at
        self.anchor = b" " + self.anchor + b" "
        self.begin = self._closed({0})
        self.first = {w for s in self.begin for w in self.moves[s]}
        if None in self.first or self.accepting in self.begin:
            raise ValueError("a template must begin with a word")
        self._known: dict[tuple[frozenset[int], bytes], frozenset[int]] = {}

    def _state(self) -> int:
        self.moves.append({})
        self.free.append(set())
        return len(self.moves) - 1

    def _step(self, at: int, word: bytes | None) -> int:
        to = self._state()
        self.moves[at].setdefault(word, set()).add(to)
        return to

    def _closed(self, states: set[int]) -> frozenset[int]:
        found, left = set(states), list(states)
        while left:
            for to in self.free[left.pop()] - found:
                found.add(to)
                left.append(to)
        return frozenset(found)

    def _next(self, states: frozenset[int], word: bytes) -> frozenset[int]:
        key = (states, word if any(word in self.moves[s] for s in states) else b"")
        if key not in self._known:
            reached: set[int] = set()
            for s in states:
                reached |= self.moves[s].get(word, set()) | self.moves[s].get(None, set())
            self._known[key] = self._closed(reached)
        return self._known[key]

    def _accepts(self, text: bytes, at: int) -> int | None:
        """End of the shortest accepted run of words from the space at ``at``."""
        states = self.begin
        while states:
            end = text.find(b" ", at + 1)
            if end < 0:
                return None
            states = self._next(states, text[at + 1 : end])
            if self.accepting in states:
                return end
            at = end
        return None

    def matches(self, text: bytes) -> Iterator[tuple[int, int]]:
        """Byte spans (first space, last space) of all accepted runs."""
        if self.anchor not in text:
            return
        starts = {
            m.start() for word in self.first for m in re.finditer(b"(?= %b )" % re.escape(word), text)
        }
        for at in sorted(starts):
            end = self._accepts(text, at)
            if end is not None:
                yield at, end


def scan_text(
    text: str | None, phrases: Mapping[str, Template], templates: Mapping[str, Template]
) -> tuple[int, list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Number of words; (label, first word, words) of all phrases, and of all templates."""
    words = normalised(text)

    def spans(known: Mapping[str, Template]) -> list[tuple[str, int, int]]:
        return sorted(
            (label, words.count(b" ", 0, start), words.count(b" ", start, end))
            for label, template in known.items()
            for start, end in template.matches(words)
        )

    return max(0, words.count(b" ") - 1), spans(phrases), spans(templates)


def whole_texts(
    text: str | None, texts: Mapping[str, list[Template]], openings: Mapping[str, Template]
) -> tuple[set[str], set[str]]:
    """Labels of the whole license texts in a text, and of openings that go on differently."""
    for mark in TYPOGRAPHIC:
        if text and mark in text:
            text = text.replace(mark, " ")
    words = normalised(text)
    found = [
        (label, start)
        for label, wordings in texts.items()
        for template in wordings
        for start, _ in template.matches(words)
    ]
    begun = {start for _, start in found}
    return {label for label, _ in found}, {
        f"{label}-opening"
        for label, template in openings.items()
        for start, _ in template.matches(words)
        if start not in begun
    }


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
    texts: Mapping[str, Sequence[str]] = TEXTS,
) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score (1 if a template is accepted, 0.5 if only a phrase is found, else 0), text_labels
    (whole license texts, and openings that go on differently), text_score (1 if there is a
    whole text, OPENING_SCORE if there are only openings, else 0) and spans (label, first
    word, number of words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {k: Template(v) for k, v in phrases.items()}
        marked = {k: Template(v) for k, v in templates.items()}
        wholes = {k: [Template(v) for v in wordings] for k, wordings in texts.items()}
        openings = {k: marked[k] for k in OPENINGS if k in marked}
        for batch in batches:
            rows = []
            for text in batch.column(1):
                n_words, base, more = scan_text(text.as_py(), known, marked)
                whole, begun = whole_texts(text.as_py(), wholes, openings)
                starts = [start for _, start, _ in base]
                rows.append(
                    {
                        "n_words": n_words,
                        "n_base": len(base),
                        "first_word": min(starts, default=None),
                        "last_word": max(starts, default=None),
                        "base_labels": ",".join(sorted({x[0] for x in base})),
                        "labels": ",".join(sorted({x[0] for x in base + more})),
                        "score": 1.0 if more else 0.5 if base else 0.0,
                        "text_labels": ",".join(sorted(whole | begun)),
                        "text_score": 1.0 if whole else OPENING_SCORE if begun else 0.0,
                        "spans": [
                            {"label": a, "first_word": b, "n_words": c} for a, b, c in base + more
                        ],
                    }
                )
            found = pa.RecordBatch.from_pylist(rows, schema=arrow)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *found.columns], names=["doc_id", *arrow.names]
            )

    span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())])
    arrow = pa.schema(
        [
            *[(c, pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")],
            ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
            ("text_labels", pa.string()), ("text_score", pa.float64()),
            ("spans", pa.list_(span)),
        ]
    )
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double, text_labels string, "
        "text_score double, "
        "spans array<struct<label string, first_word long, n_words long>>",
    )
