"""Hashed five-word shingles of texts, many texts at a time."""

from __future__ import annotations

import numpy as np

SHINGLE = 5
_random = np.random.default_rng(20)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64)
_ODD = _random.integers(1, 2**62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_STEP = int(_ODD[7])
_BACK = pow(_STEP, -1, 2**64)


_powers_of: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n - 1; what a worker has computed once is kept."""
    if len(_powers_of.get(base, ())) < n:
        out = np.full(max(2 * n, 1 << 16), base, np.uint64)
        out[0] = 1
        _powers_of[base] = np.cumprod(out, dtype=np.uint64)
    return _powers_of[base][:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text: sums of its bytes' numbers times powers."""
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_STEP, len(data)), out=sums[1:])
    back = _powers(_BACK, len(data) + 1)
    return _mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles: five words each, or all words if there
    are fewer; none without words. A to Z are lower-cased."""
    if not text:
        return np.zeros(0, np.uint64)
    words = word_hashes(text.encode("utf-8", "surrogatepass").lower())
    n = min(len(words), SHINGLE)
    if not n:
        return np.zeros(0, np.uint64)
    found = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        found += words[i : len(words) - n + 1 + i] * _ODD[i]
    return np.unique(_mix(found))
