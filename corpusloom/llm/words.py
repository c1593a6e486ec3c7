"""Words and hashes of word runs, in NumPy."""

from __future__ import annotations

import numpy as np
import xxhash

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_word_hash = xxhash.xxh3_64_intdigest


def split_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; ``bytes.split`` cuts at just these six characters."""
    return text.encode().split() if text else []


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_word_hash, words), np.uint64, len(words))


def mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finalizer, so that near values spread over all bits."""
    h = h ^ np.uint64(salt & _MASK)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def run_hashes(h: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hashes of each ``k`` consecutive words (of word hashes ``h``), by doubling: log2(k) vector steps."""
    m = len(h) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out, done, part, length = np.zeros(m, np.uint64), 0, h, 1
    while length <= k:
        if k & length:
            out = out * np.uint64(pow(_BASE, length, 1 << 64)) + part[done : done + m]
            done += length
        if 2 * length <= k:
            part = part[:-length] * np.uint64(pow(_BASE, length, 1 << 64)) + part[length:]
        length *= 2
    return mixed(out, salt)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` consecutive values, by doubling."""
    m = len(x) - w + 1
    if m <= 0:
        return x[:0]
    part, length = x, 1
    while 2 * length <= w:
        part = np.minimum(part[:-length], part[length:])
        length *= 2
    return np.minimum(part[:m], part[w - length : w - length + m])


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
