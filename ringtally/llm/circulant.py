"""C-MinHash signatures: two permutations, the second shifted round for every coordinate."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

UNIVERSE = 1 << 20
COORDINATES = 128
ROWS = 4  # coordinates per band
BANDS = COORDINATES // ROWS
SEED = 11


@lru_cache(maxsize=1)
def shifted() -> np.ndarray:
    """Row i: what the second permutation, shifted by 0 .. COORDINATES - 1, makes of i."""
    second = np.random.default_rng(SEED).permutation(UNIVERSE).astype(np.int32)
    ring = np.concatenate([second, second[: COORDINATES - 1]])
    return np.lib.stride_tricks.sliding_window_view(ring, COORDINATES)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The first permutation is the shingles' hash itself, cut to the universe."""
    if not len(shingles):
        return np.zeros(0, np.int32)
    at = (shingles >> np.uint64(44)).astype(np.int64)
    ring = shifted()
    low = ring[at[:4096]].min(axis=0)
    for i in range(4096, len(at), 4096):
        low = np.minimum(low, ring[at[i : i + 4096]].min(axis=0))
    return low


def band_keys(sign: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    parts = sign.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for column in parts.T:
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)
