"""Hashed word shingles of whole texts, vectorised over many documents at once.

Words are maximal runs of bytes other than ASCII white space, with A-Z lower-cased. A document's set is its distinct
shingles of `k` words; with fewer words the whole sequence counts as one; without words it is empty."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
#: Fixed odd multipliers of the hashes: of bytes in a word, and of the words in a shingle.
BASE, STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: Bytes hashed at once; a longer document is hashed on its own.
PIECE = 1 << 18

_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _table(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        size = 1 << max(12, n.bit_length())
        factors = np.full(size, base & (2**64 - 1), U64)
        factors[0] = 1
        _powers[base] = np.multiply.accumulate(factors)
    return _powers[base][:n]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(a 64-bit hash of each word, the offset of its first byte)."""
    codes = np.frombuffer(data, np.uint8)
    blank = np.ones(len(codes) + 2, bool)
    blank[1:-1] = (codes == 32) | ((codes >= 9) & (codes <= 13))
    starts = np.flatnonzero(blank[:-1] & ~blank[1:])[: len(codes)]
    ends = np.flatnonzero(~blank[:-1] & blank[1:])
    sums = np.zeros(len(codes) + 1, U64)
    np.cumsum((codes.astype(U64) + U64(1)) * _table(BASE, len(codes)), out=sums[1:])
    inverse = pow(BASE, -1, 2**64)
    return mix((sums[ends] - sums[starts]) * _table(inverse, len(codes) + 1)[starts] ^ (ends - starts).astype(U64)), starts


def shingle_sets(texts: list[str], k: int, seed: int = 0) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order."""
    at = 0
    while at < len(texts):
        group, held = [], 0
        while at < len(texts) and (not group or held + len(texts[at]) <= PIECE):
            group.append(texts[at].encode("utf-8", "surrogatepass").lower())  # bytes.lower() changes A-Z alone
            held += len(group[-1])
            at += 1
        words, offsets = word_hashes(b"\n".join(group))
        bounds = np.searchsorted(offsets, np.cumsum([0] + [len(g) + 1 for g in group]))
        n = max(0, len(words) - k + 1)
        rolled = np.full(n, seed, U64)
        for j in range(k):
            rolled = rolled * U64(STEP) + words[j : j + n]
        rolled = mix(rolled)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= k:
                yield np.unique(rolled[a : b - k + 1])
            elif b > a:
                short = U64(seed ^ int(b - a))
                for w in words[a:b]:
                    short = U64((int(short) * STEP + int(w)) % 2**64)
                yield mix(np.array([short], U64))
            else:
                yield np.zeros(0, U64)
