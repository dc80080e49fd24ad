"""Token counts without ids: the initial symbols of a text less the merges that a heap and a linked list make."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sensorflow.llm import vocab
from sensorflow.llm.tasks import map_rows

SCHEMA = "doc_id long, n_bytes long, n_tokens long, n_symbols long, n_merges long, over_limit boolean"
_SHIFT = 1 << 32


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, n_symbols, n_merges and over_limit (more than `limit` tokens) of every whole text.

    A null text counts as empty: zero bytes and tokens. A special string inside a text is one symbol and is never
    merged. Rows with a null or repeated doc_id each give a row of their own; extra columns are left out; an empty
    table gives none. Texts of any length are counted word by word. No shuffle.
    """
    path = path or vocab.default_path()
    return map_rows(docs, ["doc_id", "text"], SCHEMA, lambda: _counter(path, limit))


def _counter(path: str, limit: int):
    v = vocab.vocabulary(path)
    counts = _counts(path)

    def solve(doc_ids, texts):
        for doc_id, text in zip(doc_ids, texts, strict=True):
            text = text or ""
            words, counts.lowered = v.words(text)
            total = sum(map(counts.__getitem__, words))  # symbols and merges of all words in one sum
            symbols, merges = divmod(total, _SHIFT)
            yield doc_id, len(text.encode()), symbols - merges, symbols, merges, symbols - merges > limit

    return solve


_KEPT: dict[str, vocab.Words] = {}


def _counts(path: str) -> vocab.Words:
    """Per worker: symbols * 2**32 + merges of each word seen."""
    if path not in _KEPT:
        v = vocab.vocabulary(path)

        def solve(word: str, lowered: bool) -> int:
            total = 0
            for part in v.parts(word, lowered):
                if isinstance(part, int):
                    total += _SHIFT
                    continue
                symbols = v.symbols(part)
                total += len(symbols) * _SHIFT + v.merges.run(symbols)[1]
            return total

        _KEPT[path] = vocab.Words(solve)
    return _KEPT[path]
