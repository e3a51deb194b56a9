"""Words and word shingles of whole texts as arrays of 64-bit hashes.

A word is a run of digits, letters a-z (A-Z lower-cased) and code points
from U+0080 on.  All bytes of a UTF-8 code point from U+0080 on are 0x80 or
more, so words can be cut on bytes.
"""

from __future__ import annotations

import numpy as np

WORD_BYTE = np.zeros(256, bool)
for _a, _b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    WORD_BYTE[_a : _b + 1] = True
LOWER_BYTE = np.arange(256, dtype=np.uint8)
LOWER_BYTE[0x41:0x5B] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers = np.zeros(0, np.uint64)
#: Bytes hashed at a time.
BLOCK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.full(max(n, 256), _BASE, np.uint64))
    return _powers


def _block(raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = WORD_BYTE[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = cuts[cuts < len(raw)]
    begins[cuts] = inside[cuts]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, starts
    compact = np.flatnonzero(begins[inside])
    low = LOWER_BYTE[raw[inside]].astype(np.uint64)
    lengths = np.diff(np.append(compact, len(low)))
    at = np.arange(len(low)) - np.repeat(compact, lengths)
    value = (low + np.uint64(1)) * powers(int(lengths.max()))[at]
    h = np.add.reduceat(value, compact)
    return mix(h + lengths.astype(np.uint64)), starts, starts + lengths


def words(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end in ``raw`` with offsets ``bounds``: the hash
    of each word, its byte start and end, and the n + 1 word offsets of the
    texts."""
    hs, starts, ends, at = [], [], [], 0
    while at < len(raw):
        end = min(at + BLOCK, len(raw))
        if end < len(raw):  # cut where no word is cut
            while end < len(raw):
                gaps = np.flatnonzero(~WORD_BYTE[raw[end : end + 4096]])
                if len(gaps):
                    end += int(gaps[0])
                    break
                end = min(end + 4096, len(raw))
        a, b = np.searchsorted(bounds, [at, end])
        h, s, e = _block(raw[at:end], bounds[a:b] - at)
        hs.append(h)
        starts.append(s + at)
        ends.append(e + at)
        at = end
    h = np.concatenate(hs) if hs else np.zeros(0, np.uint64)
    s = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    e = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    return h, s, e, np.searchsorted(s, bounds)


def shingles(h: np.ndarray, word_bounds: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``k`` words in each text, with the n + 1 offsets.
    A text of fewer words, but not none, has one shingle of all its words."""
    n_words = np.diff(word_bounds)
    counts = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    if not len(h):
        return np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(counts)])
    acc = np.zeros(len(h), np.uint64)
    m = len(h) - k + 1
    if m > 0:
        part = acc[:m]
        for j in range(k):
            part *= _BASE
            part += h[j : j + m]
    valid = np.zeros(len(h), bool)
    long_enough = np.flatnonzero(n_words >= k)
    edge = np.zeros(len(h) + 1, np.int64)
    np.add.at(edge, word_bounds[:-1][long_enough], 1)
    np.add.at(edge, word_bounds[1:][long_enough] - k + 1, -1)
    valid = np.cumsum(edge[:-1]) > 0
    for d in np.flatnonzero((n_words > 0) & (n_words < k)):
        value = np.uint64(n_words[d])
        for x in h[word_bounds[d] : word_bounds[d + 1]]:
            value = np.uint64((int(value) * int(_BASE) + int(x)) & 0xFFFFFFFFFFFFFFFF)
        acc[word_bounds[d]] = value
        valid[word_bounds[d]] = True
    return mix(acc[valid]), np.concatenate([[0], np.cumsum(counts)])
