"""Ids of whole texts exactly as the `tokenizers` library gives them, by way of words that are encoded once per worker."""

from __future__ import annotations

from array import array
from collections.abc import Callable

import numpy as np

from sensorflow.llm import vocab

_KEPT: dict[str, vocab.Words] = {}


def word_ids(path: str) -> vocab.Words:
    """word -> its ids as little-endian 32-bit integers; the library's model merges each part."""
    if path not in _KEPT:
        v = vocab.vocabulary(path)
        tokenize = v.library.model.tokenize

        def solve(word: str, lowered: bool) -> bytes:
            ids = array("I")
            for part in v.parts(word, lowered):
                ids.extend([part] if isinstance(part, int) else [t.id for t in tokenize(part)])
            return ids.tobytes()

        _KEPT[path] = vocab.Words(solve)
    return _KEPT[path]


def id_bytes(path: str) -> Callable[[str], bytes]:
    v, known = vocab.vocabulary(path), word_ids(path)

    def encode(text: str) -> bytes:
        words, known.lowered = v.words(text)
        return b"".join(map(known.__getitem__, words))

    return encode


def ids_of(path: str) -> Callable[[str], np.ndarray]:
    encode = id_bytes(path)
    return lambda text: np.frombuffer(encode(text), "<u4")
