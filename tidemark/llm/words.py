"""Word boundaries and hashes of many texts at once, and hashes of their windows of words."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash

from tidemark.llm.common import mix

_rng = np.random.default_rng(71)
_BYTE = _rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _BACK = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
#: Sums of powers modulo 2^64 tell short words apart; longer ones are hashed one by one.
_LONG = 256


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base^2, … modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


@dataclass
class Words:
    """Of all texts together: where each word starts and ends, its text, its 64-bit hash."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    hashes: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts `data[offsets[i]:offsets[i + 1]]`, cut at blanks and at bytes 9 to 13."""
    body = ~_BLANK[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.empty(len(data) + 1, bool)
    before[0], before[1:] = False, body
    starts = np.flatnonzero(body & (first[:-1] | ~before[:-1]))
    after = np.empty(len(data), bool)
    after[:-1], after[-1:] = body[1:], False
    ends = np.flatnonzero(body & (first[1:] | ~after)) + 1

    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=sums[1:], dtype=np.uint64)
    back = powers(_BACK, len(data) + 1)
    hashes = mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts > _LONG):
        hashes[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]].tobytes(), 5)
    return Words(starts, ends, np.searchsorted(offsets, starts, "right") - 1, hashes)


def windows(found: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each run of `width` words of one text: its first word, and 128 bits of hash as two arrays."""
    n = len(found.hashes) - width + 1
    if n <= 0:
        none = np.zeros(0, np.uint64)
        return np.zeros(0, np.int64), none, none
    at = np.flatnonzero(found.text[:n] == found.text[width - 1:])
    out = []
    for h in (found.hashes, mix(found.hashes ^ _BYTE[0])):
        sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * powers(_BASE, len(h)), out=sums[1:], dtype=np.uint64)
        out.append(mix((sums[at + width] - sums[at]) * powers(_BACK, n)[at]))
    return at, out[0], out[1]
