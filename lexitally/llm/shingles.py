"""Word shingles of texts as 64-bit hashes, and their min-hash signatures."""

import hashlib

import numpy as np
import xxhash

from lexitally.llm.text import word_bytes

SIZE = 5
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h):
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text, size=SIZE):
    """Sorted distinct hashes of a text's `size`-word shingles; a shorter text is one shingle, no words are none."""
    words = word_bytes(text or "")
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    length = min(size, n)
    total = np.full(n - length + 1, length, np.uint64)
    for i in range(length):
        total = (total ^ hashed[i : n - length + 1 + i]) * _PRIME
        total ^= total >> np.uint64(29)
    return np.unique(_mixed(total))


def set_digest(shingles):
    """Names a set: equal for equal sets."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


class MinHash:
    """Signatures of `n` coordinates; a coordinate of two sets agrees with the chance of their similarity."""

    def __init__(self, n, seed=7):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, n, dtype=np.uint64)

    def signatures(self, sets):
        """One row of coordinate-value keys (64-bit, different for different coordinates) a set; no set may be empty."""
        flat = np.concatenate(sets)
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
        out = np.empty((len(sets), len(self.a)), np.uint64)
        for j, (a, b) in enumerate(zip(self.a, self.b)):
            out[:, j] = np.minimum.reduceat(flat * a + b, starts) + np.uint64(j * int(_PRIME) % 2**64)
        return out.view(np.int64)
