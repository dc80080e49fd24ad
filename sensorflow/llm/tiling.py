"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a seed, a run of LEAST words, are tiled: the longest run of words that both have
and that no tile covers becomes a tile, again and again, down to runs of LEAST words. Equal runs are found by Karp-Rabin
hashes. What counts is the share of the item's words that tiles cover, so reordered passages are caught as well.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.shingles import HASHES
from sensorflow.llm.tasks import map_rows

LEAST = 5
COVERAGE = 0.5
BLOCK_WORDS = 1 << 20
_BLANKED = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in range(256))
_MODULUS = (1 << 61) - 1
_FACTOR = 1_000_003


_POWERS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(LEAST)], np.uint64)


def words(text: str | None) -> np.ndarray:
    """Hashes of the words of a text: letters and digits, in lower case; punctuation separates."""
    found = text.lower().encode().translate(_BLANKED).split() if text else []
    return np.fromiter(map(HASHES.__getitem__, found), np.uint64, len(found))


def seeds(tokens: np.ndarray, least: int = LEAST) -> np.ndarray:
    """A hash for every run of `least` words."""
    runs = len(tokens) - least + 1
    if runs <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(runs, np.uint64)
    for k in range(least):
        total = (total + tokens[k:k + runs]) * _POWERS[0]
        total ^= total >> np.uint64(29)
    return total


def tiles(item: list[int], text: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(place in item, place in text, length) of the tiles, longest first; of equal ones the first in the item, then text.

    At a search length, Karp-Rabin hashes of all free runs of that length pair up equal ones, which are compared and
    extended. If a match is twice as long as searched for, the search starts again from there; else the length is halved.
    """
    free_item, free_text = [True] * len(item), [True] * len(text)
    made: list[tuple[int, int, int]] = []
    search = max(least, min(len(item), len(text), 20))
    while True:
        matches = _matches(item, text, free_item, free_text, search)
        longest = max((n for n, _, _ in matches), default=0)
        if longest > 2 * search:
            search = longest
            continue
        for n, i, t in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            if all(free_item[i:i + n]) and all(free_text[t:t + n]):
                made.append((i, t, n))
                free_item[i:i + n] = [False] * n
                free_text[t:t + n] = [False] * n
        if any(not (all(free_item[i:i + n]) and all(free_text[t:t + n])) for n, i, t in matches) and _matches(
                item, text, free_item, free_text, search):
            continue  # what is left of a match that met a tile may still be long enough
        if search == least:
            return sorted(made, key=lambda m: (-m[2], m[0], m[1]))
        search = max(least, search // 2)


def _rolled(tokens: list[int], free: list[bool], length: int) -> list[tuple[int, int]]:
    """(hash, place) of every free run of that length; the hash rolls from word to word."""
    lead = pow(_FACTOR, length - 1, _MODULUS)
    out, value, filled = [], 0, 0
    for at, token in enumerate(tokens):
        if not free[at]:
            value = filled = 0
            continue
        if filled == length:
            value = (value - tokens[at - length] * lead) % _MODULUS
            filled -= 1
        value = (value * _FACTOR + token) % _MODULUS
        filled += 1
        if filled == length:
            out.append((value, at - length + 1))
    return out


def _matches(item, text, free_item, free_text, length) -> list[tuple[int, int, int]]:
    """(length, place in item, place in text) of maximal free matches of at least `length` words."""
    table = defaultdict(list)
    for value, at in _rolled(item, free_item, length):
        table[value].append(at)
    found, reached = [], {}
    for value, t in _rolled(text, free_text, length):
        for i in table.get(value, ()):
            if reached.get(t - i, -1) > t or item[i:i + length] != text[t:t + length]:
                continue  # inside a match on the same diagonal, or only equal by hash
            n = length
            while i + n < len(item) and t + n < len(text) and free_item[i + n] and free_text[t + n] and item[i + n] == text[t + n]:
                n += 1
            found.append((n, i, t))
            reached[t - i] = t + n - length + 1
    return found


class Items:
    """A block of benchmark items: words, and sorted seeds with the items that have them."""

    def __init__(self, rows: list[tuple[int, str]], least: int):
        self.ids = [i for i, _ in rows]
        self.tokens = [words(t).tolist() for _, t in rows]
        # An item that is shorter than a seed is its own seed.
        self.least = [min(least, len(t)) for t in self.tokens]
        by_size: dict[int, list[int]] = defaultdict(list)
        for place, size in enumerate(self.least):
            if size:
                by_size[size].append(place)
        self.seeds = {}
        for size, places in by_size.items():
            pairs = [(s, p) for p in places for s in set(seeds(np.array(self.tokens[p], np.uint64), size).tolist())]
            keys = np.array([s for s, _ in pairs], np.uint64)
            order = np.argsort(keys, kind="stable")
            self.seeds[size] = keys[order], np.array([p for _, p in pairs])[order]

    def touched(self, tokens: np.ndarray) -> list[int]:
        """Places of the items that share a seed with a text."""
        found: set[int] = set()
        for size, (keys, places) in self.seeds.items():
            own = seeds(tokens, size)
            low = np.searchsorted(keys, own)
            low[low == len(keys)] = 0
            hit = np.unique(own[keys[low] == own]) if len(own) else own
            for a, b in zip(np.searchsorted(keys, hit, "left"), np.searchsorted(keys, hit, "right"), strict=True):
                found.update(places[a:b].tolist())
        return sorted(found)


SCHEMA = "doc_id long, item_id long, n_words long, n_covered long, n_tiles long, longest long"


def overlaps(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id, words of the item, words that tiles cover, tiles and longest tile, for all that share a seed.

    Null or wordless texts and items share nothing. An item of fewer than `least` words is matched as a whole. Repeated
    items and rows with a null or repeated doc_id are compared like any others. Extra columns are ignored.
    The benchmark is the stated query set. It is broadcast in blocks of about `block_words` words, counted beforehand; a
    larger benchmark takes more passes over the documents. Documents are not shuffled.
    """
    found = None
    for items in blocks(benchmark, least, block_words):
        made = map_rows(docs, ["doc_id", "text"], SCHEMA, lambda items=items: lambda d, t: _tiled(items.value, d, t))
        found = made if found is None else found.unionByName(made)
    return found


def blocks(benchmark: DataFrame, least: int, block_words: int) -> Iterator[Broadcast]:
    """The items in broadcast blocks, dealt by hash after a count of their words."""
    size = F.coalesce(F.length(F.regexp_replace("text", r"\S+", "x")), F.lit(0))
    total = benchmark.agg(F.sum(size)).first()[0] or 0
    count = max(1, -(-total // (2 * block_words)))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for number in range(count):
        rows = [(r.item_id, r.text) for r in benchmark.filter(part == number).select("item_id", "text").distinct().collect()]
        yield benchmark.sparkSession.sparkContext.broadcast(Items(sorted(rows, key=str), least))


def _tiled(items: Items, doc_ids, texts):
    for doc_id, text in zip(doc_ids, texts, strict=True):
        for place, found in _tilings(items, text):
            covered = sum(n for _, _, n in found)
            yield doc_id, items.ids[place], len(items.tokens[place]), covered, len(found), found[0][2] if found else 0


def _tilings(items: Items, text: str | None) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    tokens = words(text)
    touched = items.touched(tokens)
    listed = tokens.tolist() if touched else []
    return ((place, tiles(items.tokens[place], listed, items.least[place])) for place in touched)


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, **options) -> DataFrame:
    """The overlaps in which tiles cover at least that share of the item's words."""
    return overlaps(docs, benchmark, **options).filter(F.col("n_covered") >= coverage * F.col("n_words"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least: int = LEAST,
                         block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of `docs`, with all their columns, in which no item is covered that far."""
    for items in blocks(benchmark, least, block_words):
        def clean(text: str | None, items=items) -> bool:
            return not any(sum(n for _, _, n in found) >= coverage * len(items.value.tokens[place])
                           for place, found in _tilings(items.value, text))

        docs = docs.filter(F.udf(clean, "boolean", useArrow=True)("text"))
    return docs
