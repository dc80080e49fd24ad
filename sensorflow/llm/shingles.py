"""Sets of word shingles as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
_KEPT_WORDS = 300_000
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= _KEPT_WORDS:
                self.clear()
            self[word] = value
        return value


#: word -> 64-bit hash; bounded, one for all operators of a worker.
HASHES = _Hashes()


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; bytes.lower and bytes.split do exactly that."""
    words = text.encode().lower().split() if text else []
    return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ values >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ values >> np.uint64(32)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of all runs of five words; a shorter text is one run as a whole; no words, no runs."""
    words = word_hashes(text)
    if not len(words):
        return words
    if len(words) < WORDS:
        return mixed((words * _FACTORS[:len(words)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(words)))
    runs = len(words) - WORDS + 1
    total = np.zeros(runs, np.uint64)
    for k in range(WORDS):
        total += words[k:k + runs] * _FACTORS[k]
    return np.unique(mixed(total))


def common(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())
