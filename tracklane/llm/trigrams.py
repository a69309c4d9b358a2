"""Boolean trigram queries of regular expressions.

``query_of`` tells which trigrams any text must hold for a pattern to match in it: a list of
alternatives, each a set of trigrams that occur together. It is never too strict: whatever
cannot be told (long classes, optional parts, other than ASCII) weakens the query, down to
``ANY`` when no trigram is mandatory. Trigrams are in lower case and stand for either case,
so that one index of lower-cased texts serves patterns with and without regard to case.

Patterns are read by the parser of Python's ``re``; what that and Java's syntax share may be
used in them.
"""

from __future__ import annotations

from itertools import product
from re import _constants as ops
from re import _parser

#: Alternatives of a query, strings that a part can be spelled out into, and their length.
MOST_ALTERNATIVES, MOST_STRINGS, MOST_CHARACTERS = 32, 32, 60

#: A query is a set of alternatives; an alternative without a trigram holds everywhere.
ANY = frozenset([frozenset()])


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _simple(query) -> frozenset:
    """Without alternatives that another one makes needless."""
    return frozenset(x for x in query if not any(y < x for y in query))


def _either(*queries) -> frozenset:
    every = _simple(frozenset().union(*queries))
    return every if len(every) <= MOST_ALTERNATIVES else ANY


def _both(x: frozenset, y: frozenset) -> frozenset:
    if len(x) * len(y) > 8 * MOST_ALTERNATIVES:
        return min(x, y, key=len)
    every = _simple(frozenset(a | b for a, b in product(x, y)))
    return every if len(every) <= MOST_ALTERNATIVES else min(x, y, key=len)


def _of_strings(strings) -> frozenset:
    return _either(frozenset(map(_trigrams, strings)))


class _Part:
    """What is known of a part: all its strings, or its two ends and a query."""

    def __init__(self, strings=None, first=frozenset([""]), last=frozenset([""]), query=ANY):
        self.strings, self.query = strings, query
        self.first = first if strings is None else strings
        self.last = last if strings is None else strings

    def opened(self) -> _Part:
        """The same, with its strings given up for ends of two characters and a query."""
        if self.strings is None:
            return self
        return _Part(
            None,
            frozenset(s[:2] for s in self.strings),
            frozenset(s[-2:] for s in self.strings),
            _of_strings(self.strings),
        )


_EMPTY, _UNKNOWN = _Part(frozenset([""])), _Part()


def _limited(ends: frozenset) -> frozenset:
    return ends if len(ends) <= MOST_STRINGS else frozenset([""])


def _joined(x: _Part, y: _Part) -> _Part:
    if x.strings is not None and y.strings is not None:
        size = max(map(len, x.strings)) + max(map(len, y.strings))
        if len(x.strings) * len(y.strings) <= MOST_STRINGS and size <= MOST_CHARACTERS:
            return _Part(frozenset(a + b for a, b in product(x.strings, y.strings)))
    a, b = x.opened(), y.opened()
    across = _of_strings({s + p for s, p in product(a.last, b.first)})
    # an end that is shorter than two characters may be the whole of an exact part
    first = {s + p for s, p in product(x.strings, b.first)} if x.strings is not None else x.first
    last = {s + p for s, p in product(a.last, y.strings)} if y.strings is not None else y.last
    return _Part(
        None,
        _limited(frozenset(s[:2] for s in first)),
        _limited(frozenset(s[-2:] for s in last)),
        _both(_both(a.query, b.query), across),
    )


def _alternatives(parts: list[_Part]) -> _Part:
    if all(p.strings is not None for p in parts):
        strings = frozenset().union(*(p.strings for p in parts))
        if len(strings) <= MOST_STRINGS:
            return _Part(strings)
    parts = [p.opened() for p in parts]
    return _Part(
        None,
        _limited(frozenset().union(*(p.first for p in parts))),
        _limited(frozenset().union(*(p.last for p in parts))),
        _either(*(p.query for p in parts)),
    )


def _characters(codes) -> _Part:
    """One of some characters; ``codes`` may be a range that is too long to look at."""
    if len(codes) > 128:
        return _UNKNOWN
    some = {chr(c) for c in codes}
    if not some or any(c > "\x7f" for c in some) or len(some) > 2 * MOST_STRINGS:
        return _UNKNOWN
    some = frozenset(c.lower() for c in some)
    return _Part(some) if len(some) <= MOST_STRINGS else _UNKNOWN


def _class(items) -> _Part:
    codes: list[int] = []
    for op, value in items:
        if op is ops.LITERAL:
            codes.append(value)
        elif op is ops.RANGE and value[1] - value[0] < 128:
            codes.extend(range(value[0], value[1] + 1))
        else:
            return _UNKNOWN
    return _characters(codes)


def _repeated(least: int, most: int, part: _Part) -> _Part:
    if least == 0:
        if most == 1 and part.strings is not None:
            return _alternatives([_EMPTY, part])
        return _UNKNOWN
    out = part
    for _ in range(min(least, MOST_CHARACTERS) - 1):
        out = _joined(out, part)
    return out if least == most <= MOST_CHARACTERS else _joined(_joined(out, _UNKNOWN), _EMPTY)


def _part(tree) -> _Part:
    out = _EMPTY
    for op, value in tree:
        if op is ops.LITERAL:
            new = _characters([value])
        elif op is ops.IN:
            new = _class(value)
        elif op is ops.BRANCH:
            new = _alternatives([_part(branch) for branch in value[1]])
        elif op is ops.SUBPATTERN:
            new = _part(value[3])
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT, ops.POSSESSIVE_REPEAT):
            new = _repeated(value[0], value[1], _part(value[2]))
        elif op in (ops.AT, ops.ASSERT, ops.ASSERT_NOT):
            new = _EMPTY
        else:
            new = _UNKNOWN
        out = _joined(out, new)
    return out


def query_of(pattern: str) -> frozenset[frozenset[str]]:
    """The alternatives of which one holds in every text that the pattern matches in."""
    return _part(_parser.parse(pattern)).opened().query
