"""Words and word shingles of many texts at once, as 64-bit hashes, from the bytes of an Arrow batch."""

from __future__ import annotations

import numpy as np

U = np.uint64
#: Word characters are all bytes but space and \\t to \\r.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(20240601)).integers(1, 1 << 63, 256, dtype=np.int64).astype(U)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of x."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base of running hashes, and of its inverse."""
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, U)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and where each text's words start (one more entry than texts). A word ends with its text."""
    n = len(data)
    if n == 0:
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    inside = ~separator[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < n]
    first[cuts] |= inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    before = cuts[cuts > 0] - 1
    last[before] |= inside[before]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = powers(n)
    sums = np.zeros(n + 1, U)
    np.cumsum(_BYTE[data] * up, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U)), np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, hash and count of every run of `width` words; a text of fewer words, but at least one, has all its words as one run."""
    counts = np.diff(starts)
    docs, hashes = [], []
    long = np.flatnonzero(counts >= width)
    if len(long):
        n = counts[long] - width + 1
        doc = np.repeat(long, n)
        at = np.repeat(starts[long] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        h = np.zeros(len(at), U)
        for j in range(width):
            h = (h ^ words[at + j]) * U(0xD6E8FEB86659FD93) + U(j + 1)
        docs.append(doc)
        hashes.append(mix(h))
    for d in np.flatnonzero((counts > 0) & (counts < width)):
        h = np.full(1, counts[d], U)
        for w in words[starts[d] : starts[d + 1]]:
            h = (h ^ w) * U(0xA24BAED4963EE407) + U(1)
        docs.append(np.array([d]))
        hashes.append(mix(h))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, np.int64)
    doc, h = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])])
    return doc[new], h[new], np.diff(np.r_[new, len(doc)])  # each once in a document, sorted


def numbered(doc: np.ndarray, h: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run as often as it occurs, the first under its own hash, the next under others: counts as plain sets."""
    again = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    each = np.repeat(h, count)
    return np.repeat(doc, count), np.where(again > 0, mix(each + again.astype(U) * U(0x9E3779B97F4A7C15)), each)
