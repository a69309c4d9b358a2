"""Word shingles of a text as sorted arrays of 64-bit numbers, inside one task."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words kept in a task's memory with their numbers; the memory is emptied when full.
CACHED_WORDS = 200_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)

_PLACES = np.array(
    [0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64
)

_numbers: dict[bytes, int] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every input bit (the splitmix64 finaliser)."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case, split at space and U+0009 to U+000D only."""
    # bytes, unlike str, know just these white-space characters and these capital letters
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_numbers(tokens: list[bytes]) -> np.ndarray:
    known = _numbers
    new = set(tokens).difference(known)
    if len(known) + len(new) > CACHED_WORDS:
        known.clear()
        new = set(tokens)
    known.update(zip(new, map(xxhash.xxh3_64_intdigest, new)))
    return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Distinct ``size``-word shingles, ascending. Shorter texts have one: all their words."""
    numbers = word_numbers(words(text))
    if not len(numbers):
        return numbers
    width = min(size, len(numbers))
    count = len(numbers) - width + 1
    # equal words at different places must not cancel, hence a multiplier for each place
    shingles = np.full(count, width, np.uint64)
    for k in range(width):
        shingles = (shingles + numbers[k : k + count]) * _PLACES[k % len(_PLACES)]
        shingles ^= shingles >> np.uint64(29)
    shingles = mixed(shingles)
    shingles.sort()
    return shingles[np.append(True, shingles[1:] != shingles[:-1])]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))
