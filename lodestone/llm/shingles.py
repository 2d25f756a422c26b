"""Sets of word shingles of many texts at once, in numpy.

Words are runs of bytes other than ASCII blanks, A-Z in lower case.  A word's hash is the sum over its bytes
of a value that depends on the byte and its place in the word; a shingle's is a polynomial of
its words' hashes.  Both are 64 bits long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
#: Bytes of texts that are hashed together.
CHUNK = 1 << 18
_PLACES = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit; overflow is meant."""
    x = (x ^ (x >> np.uint64(33))) * _MIX1
    x = (x ^ (x >> np.uint64(33))) * _MIX2
    return x ^ (x >> np.uint64(33))


def _values(byte: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mix((place.astype("u8") << np.uint64(8) | byte.astype("u8")) * _STEP + np.uint64(1))


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
with np.errstate(over="ignore"):
    _TABLE = _values(np.tile(np.arange(256), _PLACES), np.repeat(np.arange(_PLACES), 256))


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of data and where they begin."""
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).view("i1")))
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return np.zeros(0, "u8"), begin
    size = end - begin
    inner = data[~blank]
    first = np.cumsum(size) - size
    place = np.arange(len(inner)) - np.repeat(first, size)
    if size.max() <= _PLACES:
        value = _TABLE[place << 8 | inner]
    else:
        value = _values(inner, place)
    return mix(np.add.reduceat(value, first) + size.astype("u8") * _STEP), begin


def _combined(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each k neighbouring words."""
    n = len(hashes) - k + 1
    total = hashes[:n].copy()
    for i in range(1, k):
        total = total * _STEP + hashes[i : n + i]
    return mix(total + np.uint64(k))


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x if len(x) < 2 else x[np.concatenate([[True], x[1:] != x[:-1]])]


def _of_chunk(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    joined = np.frombuffer(b" ".join(texts).lower(), "u1")
    hashes, begin = _word_hashes(joined)
    ends = np.searchsorted(begin, np.cumsum([len(t) + 1 for t in texts]))
    grams = _combined(hashes, k) if len(hashes) >= k else hashes[:0]
    a = 0
    for b in ends.tolist():
        if b - a >= k:
            yield _distinct(grams[a : b - k + 1])
        elif b > a:  # the whole sequence; its length keeps it apart from longer ones
            yield _combined(hashes[a:b], b - a)
        else:
            yield hashes[:0]
        a = b


def shingle_sets(texts: list[str | None], k: int) -> Iterator[np.ndarray]:
    """Of each text the sorted distinct hashes of its k-word shingles.

    Fewer words than k make one shingle of the whole sequence; no word (or null) makes the empty set.
    """
    with np.errstate(over="ignore"):
        held, size = [], 0
        for t in texts:
            raw = (t or "").encode()
            if held and size + len(raw) > CHUNK:
                yield from _of_chunk(held, k)
                held, size = [], 0
            held.append(raw)
            size += len(raw) + 1
        if held:
            yield from _of_chunk(held, k)
