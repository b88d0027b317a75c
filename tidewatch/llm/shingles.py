"""Word-shingle sets as sorted 64-bit hashes, and b-bit minhash signatures of them."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
_MEMO_ENTRIES = 400_000
_BLOCK = 4096
# The 64-bit finishing constants of a public hash, and an odd multiplier.
_MIX_1, _MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_STEP = 0x9E3779B97F4A7C15
_SHIFT = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _SHIFT)) * _MIX_1
    x = (x ^ (x >> _SHIFT)) * _MIX_2
    return x ^ (x >> _SHIFT)


class WordHashes(dict):
    """Word -> 64-bit hash, remembered up to a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < _MEMO_ENTRIES:
            self[word] = value
        return value


def shingle_set(text: str | None, hashes: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles of ``width`` words.

    ASCII capitals are lowered, words end at the six ASCII spaces. A text with fewer words
    has its whole sequence as one shingle; NULL and texts without a word have none.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    span = min(width, len(words))
    # A shorter sequence starts from its own number, so that it equals no longer one.
    total = np.full(len(words) - span + 1, span, dtype=np.uint64)
    for i in range(span):
        total = total * np.uint64(_STEP) + values[i:len(values) - span + 1 + i]
    return np.unique(mix(total))


def signature_seeds(components: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed pseudo-random (xor, odd multiplier) pairs, one per component."""
    steps = np.arange(1, 2 * components + 1, dtype=np.uint64) * np.uint64(_STEP)
    values = mix(steps)
    return values[:components], values[components:] | np.uint64(1)


def signature(shingles: np.ndarray, seeds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """16 bits of the minimum of each seeded hash over the set (b-bit minhash, b = 16)."""
    xors, factors = seeds
    least = np.full(len(xors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), _BLOCK):
        part = (shingles[at:at + _BLOCK, None] ^ xors) * factors
        np.minimum(least, part.min(axis=0), out=least)
    return (mix(least) & np.uint64(0xFFFF)).astype(np.uint16)
