"""Word shingles as 64-bit hashes, for Arrow batches of whole texts."""

from __future__ import annotations

import numpy as np
import xxhash

from weftline.llm.text import mix64

_STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHashes:
    """Hashes of words.  A word is hashed each time: that takes less than to look it up among many."""

    def each(self, words: list[bytes]) -> np.ndarray:
        """Hashes of words as they are."""
        return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)

    def of(self, text: bytes | None) -> np.ndarray:
        """Hashes of the words of a text, A-Z lower-cased, in order."""
        return self.each(text.lower().split() if text else [])


def windows(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` words; fewer words make one window; none make none."""
    if not len(words):
        return words
    width = min(width, len(words))
    # By doubling, from the highest bit of the width down: out holds the windows of ``done`` words.
    out, done = words, 1
    for bit in range(width.bit_length() - 2, -1, -1):
        out, done = out[:len(out) - done] * np.uint64(pow(int(_STEP), done, 1 << 64)) + out[done:], 2 * done
        if width >> bit & 1:
            out, done = out[:-1] * _STEP + words[done:], done + 1
    return mix64(out + np.uint64(width))


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct window hashes, ascending."""
    return np.unique(windows(words, width))


class MinHash:
    """``lanes`` independent minima of a set of 64-bit hashes."""

    def __init__(self, lanes: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.mul = rng.integers(0, 1 << 63, lanes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.add = rng.integers(0, 1 << 63, lanes, dtype=np.uint64)

    def minima(self, items: np.ndarray) -> np.ndarray:
        """The smallest image per lane, over blocks that fit the processor's cache."""
        out = np.full(len(self.mul), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(items), 1024):
            images = items[None, at:at + 1024] * self.mul[:, None] + self.add[:, None]
            np.minimum(out, images.min(axis=1), out=out)
        return out
