"""Hashes of word shingles."""

from __future__ import annotations

import numpy as np
import xxhash

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every ``size``-word shingle of the lower-cased text, repeats included."""
    words = text.translate(LOWER).split()  # ASCII white space, as [^\x20\x09-\x0D]+ has it
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - size + 1)
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(line[s:e], 42) for s, e in zip(starts[:n].tolist(), ends[min(size, len(words)) - 1:].tolist())),
        np.uint64, n)


def remixed(h: np.ndarray, j: int) -> np.ndarray:
    """The j-th of several independent 64-bit values from a hash; the first is the hash itself."""
    if j == 0:
        return h
    x = h + np.uint64(0x9E3779B97F4A7C15 * j % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
