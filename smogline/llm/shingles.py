"""Word shingles as 64-bit hashes, for the operators that compare documents."""

from __future__ import annotations

import hashlib

import numpy as np
from xxhash import xxh3_64_intdigest

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(words: list[bytes], k: int = 5) -> np.ndarray:
    """Hash of every run of ``k`` words in order; of the whole sequence if there are fewer; none without words."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    size = min(k, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, dtype=np.uint64)
    for j in range(size):
        total += h[j : j + n] * _MULTIPLIERS[j % 5]
    return mix(total)


def distinct(values: np.ndarray) -> np.ndarray:
    """Different values in order; sorting is much faster here than a table of hashes."""
    s = np.sort(values)
    return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def digest(values: np.ndarray) -> int:
    """Signed 64-bit digest of an array of hashes."""
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True)
