"""Hashes of the words and word shingles of a text, with array operations alone.

A word is a run of bytes other than ASCII white space, with A to Z in lower case. Its hash is a
polynomial in random numbers for its bytes modulo 2^64, mixed; all words of a text come from one
running sum, as the difference of two of its entries is shifted back by the inverse power.
"""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(20240229)
_BYTES = _RANDOM.integers(1, 2**64, 256, dtype=np.uint64)
_BASE = int(_RANDOM.integers(0, 2**61, dtype=np.uint64)) * 8 + 5
_INVERSE = pow(_BASE, -1, 2**64)
_PLACES = _RANDOM.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Texts are hashed in parts of about so many bytes, cut between words.
PART = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the input changes about half of the output's bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n + 1, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


class _Powers:
    up, down = _powers(_BASE, 1 << 12), _powers(_INVERSE, 1 << 12)

    @classmethod
    def reach(cls, n: int) -> None:
        if n >= len(cls.up):
            cls.up, cls.down = _powers(_BASE, 2 * n), _powers(_INVERSE, 2 * n)


def _hash_part(b: np.ndarray) -> np.ndarray:
    space = np.concatenate([[True], _SPACE[b], [True]])
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    _Powers.reach(len(b))
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTES[b] * _Powers.up[: len(b)], out=total[1:])
    return mixed((total[ends] - total[starts]) * _Powers.down[starts])


def word_hashes(text: str) -> np.ndarray:
    """The hash of each word, in order."""
    data = text.encode().translate(LOWER)
    if len(data) <= PART:
        return _hash_part(np.frombuffer(data, np.uint8))
    b, parts, at = np.frombuffer(data, np.uint8), [], 0
    spaces = np.flatnonzero(_SPACE[b])
    while at < len(b):
        cut = np.searchsorted(spaces, at + PART)
        end = int(spaces[cut]) + 1 if cut < len(spaces) else len(b)
        parts.append(_hash_part(b[at:end]))
        at = end
    return np.concatenate(parts)


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of `width` words; of a text with fewer, of all of
    its words as one; none of a text without words."""
    words = word_hashes(text)
    if not len(words):
        return words
    n = min(width, len(words))
    runs = len(words) - n + 1
    sums = np.full(runs, n, np.uint64)
    for j in range(n):
        sums += words[j : j + runs] * _PLACES[j]
    return np.unique(mixed(sums))


def combined(values: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """One hash for each row of values."""
    sums = seeds.astype(np.uint64) * _PLACES[63]
    for j in range(values.shape[1]):
        sums = mixed(sums + values[:, j] * _PLACES[j])
    return sums
