"""Word shingles of texts, their MinHash signatures, and the sequential test of two signatures."""

from __future__ import annotations

from math import comb

import numpy as np
import xxhash

BANDS, ROWS = 28, 4
HASHES = BANDS * ROWS
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_A = (np.random.default_rng(11).integers(0, 1 << 32, HASHES, np.uint64) | np.uint64(1)).astype(np.uint32)
_B = np.random.default_rng(12).integers(0, 1 << 32, HASHES, np.uint64).astype(np.uint32)
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


class _Words(dict):
    """Hashes of words, each computed once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _M[1]
    return h ^ (h >> np.uint64(29))


def shingles(text: str, size: int, known: dict | None = None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of ``size`` words, A-Z lower-cased; fewer words make one run, none no set."""
    known = _Words() if known is None else known
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    h = np.array(list(map(known.__getitem__, words)), np.uint64)
    size = min(size, len(h))
    if not size:
        return h
    run = np.full(len(h) - size + 1, np.uint64(size))
    for k in range(size):
        run = _mixed(run * _M[0] + h[k:len(h) - size + 1 + k])
    return np.unique(run)


def signature(run: np.ndarray) -> np.ndarray:
    """Least value of the set under each of the hashes."""
    low = (run >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, np.uint32(0xFFFFFFFF))
    for start in range(0, len(low), 4096):
        np.minimum(least, (low[start:start + 4096, None] * _A + _B).min(0), out=least)
    return least


def bands_of(signatures: np.ndarray) -> np.ndarray:
    """Hash of each band of each signature, and of its number."""
    wide = signatures.astype(np.uint64).reshape(-1, BANDS, ROWS)
    h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), wide.shape[:2])
    for k in range(ROWS):
        h = _mixed(h * _M[0] + wide[:, :, k])
    return h


def bytes_of(signatures: np.ndarray) -> np.ndarray:
    """A byte of each hash; two different hashes have the same one in 1 of 256 cases."""
    return ((signatures * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def least_matches(similarity: float, miss: float, step: int = 16) -> list[tuple[int, int]]:
    """For growing parts of a signature, the matches that two must have to be compared further.

    With a uniform prior, the similarity after m matches of n is Beta(m+1, n-m+1); a pair is dropped as soon as its chance
    to reach ``similarity`` is below ``miss``.
    """
    match = similarity + (1 - similarity) / 256
    out = []
    for n in [*range(step, HASHES, step), HASHES]:
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += comb(n + 1, m) * match ** m * (1 - match) ** (n + 1 - m)
        out.append((n, m))
    return out


def survivors(a: np.ndarray, b: np.ndarray, sketch: np.ndarray, limits: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs (rows ``a`` and ``b`` of ``sketch``) pass the sequential test, and their matches."""
    live, count, done = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for n, least in limits:
        count = count + (sketch[a[live], done:n] == sketch[b[live], done:n]).sum(1)
        ok = count >= least
        live, count, done = live[ok], count[ok], n
    return live, count
