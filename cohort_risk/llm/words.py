"""Words and word shingles of many texts at once, as numpy arrays of hashes."""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np

#: White space in UTF-8 bytes: space and the control characters from tab to carriage return.
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
#: For folded words: ASCII letters in lower case, other ASCII than letters and digits blank.
_FOLD = np.array([c if c > 127 or chr(c).isalnum() else 32 for c in range(256)], np.uint8)
_FOLD[65:91] += 32
_FACTOR = 0x9E3779B97F4A7C15 | 1


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit integers (the finaliser of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_FACTOR, -1, 1 << 64)
    out = []
    for base in (_FACTOR, inverse):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


class Words(NamedTuple):
    hashes: np.ndarray  #: one per word, over all texts
    bounds: np.ndarray  #: words of text i are bounds[i]:bounds[i + 1]
    starts: np.ndarray  #: first byte of each word, counted in its own text
    ends: np.ndarray


def words(texts: list[str], fold: bool = False) -> Words:
    """Words between ASCII white space. Equal words have equal hashes in every task.

    With ``fold``, words are runs of letters and digits, and their ASCII case is ignored.
    """
    parts = [text.encode("utf-8", "replace") for text in texts]
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(part) + 1 for part in parts], out=offsets[1:])
    data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    if fold:
        data = _FOLD[data]
    blank = _BLANK[data]
    edges = np.flatnonzero(np.diff(blank, prepend=True))
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(1 << max(20, int(len(data)).bit_length()))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    bounds = np.searchsorted(starts, offsets)
    owner = np.repeat(offsets[:-1], np.diff(bounds))
    return Words(hashes, bounds, starts - owner, ends - owner)


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and their bounds by text.

    A text of fewer words has one shingle of all its words; one without words has none.
    """
    count = np.diff(found.bounds)
    n = len(found.hashes)
    value = np.zeros(n, np.uint64)
    for j in range(min(size, n)):
        turn = np.uint64((2 * j + 3) * _FACTOR & 0xFFFFFFFFFFFFFFFF)
        value[:n - j] += mix(found.hashes[j:] + turn) * (turn | np.uint64(1))
    made = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    bounds = np.zeros(len(made) + 1, np.int64)
    np.cumsum(made, out=bounds[1:])
    place = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - found.bounds[:-1], made)
    out = mix(value[place])
    for i in np.flatnonzero((count > 0) & (count < size)):
        whole = np.full(1, count[i], np.uint64)
        for word in found.hashes[found.bounds[i]:found.bounds[i + 1]]:
            whole = mix(whole * np.uint64(31) + word)
        out[bounds[i]] = whole[0]
    return out, bounds
