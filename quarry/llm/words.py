"""Word shingles of texts as sorted arrays of 64-bit hashes, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_S30, _S27, _S31 = (np.uint64(x) for x in (30, 27, 31))


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit integers (a bijection)."""
    x = (x ^ (x >> _S30)) * _M2
    x = (x ^ (x >> _S27)) * _M3
    return x ^ (x >> _S31)


class WordHashes(dict):
    """Hash of each word, remembered for up to ``most`` distinct words."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def split_words(text: str | None) -> list[bytes]:
    """A-Z in lower case, then the runs of bytes outside ``[\\x20\\x09-\\x0D]``."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def shingles(words: list[bytes], k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``k`` words; of the whole sequence where there are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(k, len(h))
    n = len(h) - k + 1
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = mix(out + h[j:j + n] * _M1)
    return np.unique(out)
