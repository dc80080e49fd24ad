"""Product codes of integer vectors by way of value dictionaries.

Every dimension gets a dictionary of the distinct integers that occur in it. Squared differences of each distinct integer to
all codebook entries are tabulated once; the distance of a part to every entry is then a gather and an add for each dimension,
over dictionary codes. All of it is integer arithmetic, so results don't depend on how rows are dealt to tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm import tasks

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
TABLE_BYTES = 1 << 24  # of distances that a task holds at once


def encode(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector, for a table with vec_id, embedding and label.

    Components become floor(scale * x), and a vector PARTS equal consecutive parts. Codebooks begin with the `entries`
    smallest vec_ids, are assigned and averaged `rounds` times, and give the code: two hex digits a part. `error` is the
    squared distance to the entries, `label_error` its sum over rows of an equal label, null labels together, over all
    lengths.

    A null vector, and one with a null or non-finite component, is left out; a table without any other gives no rows.
    Equal rows each give a row and count each; rows of one vec_id are ordered by their vector, null ids come last. Fewer than
    `entries` vectors give so many entries. Vectors of each length have codebooks of their own; where a length isn't a
    multiple of PARTS the first parts are one longer, and a part may be empty (code 00, error 0). Integers beyond the bound
    at which sums could leave 64 bits (`largest`: 2**27 for 64 dimensions) count as that bound. Extra columns are
    left out.

    Each round is one pass without a shuffle of rows: a task leaves sums and counts of its entries, at most
    entries * length rows, and the codebooks brought to the driver have a fixed size.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a part of the code is one byte")
    finite = vectors.filter("embedding IS NOT NULL").filter(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = finite.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    label_type = vectors.schema["label"].dataType
    lengths = sorted(r[0] for r in rows.select(F.size("embedding")).distinct().toLocalIterator())
    coded = None
    for length in lengths:  # nearly always one
        own = rows.filter(F.size("embedding") == length)
        books = learned(own, length, entries, rounds, scale)
        found = assigned(own, books, length, scale).withColumn("codebooks_sha256", F.lit(digest(books)))
        coded = found if coded is None else coded.unionByName(found)
    if coded is None:
        return rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"),
                           F.lit("").alias("codebooks_sha256")).filter("false")
    coded = tasks.salted(tasks.written(coded.withColumn("label", F.col("label").cast(label_type)), "codes"), "vec_id", "code", "error")
    add = lambda c: F.sum(c.cast("decimal(38,0)"))
    totals = tasks.group_totals(coded, ["label"], label_error=(add, add, "error")).withColumnsRenamed({"label": "_label", "salt": "_salt"})
    on = coded["label"].eqNullSafe(totals["_label"]) & (coded["salt"] == totals["_salt"])
    return coded.join(totals, on).select("vec_id", "code", "error", F.expr("try_cast(label_error AS bigint) AS label_error"), "codebooks_sha256")


def learned(rows: DataFrame, length: int, entries: int, rounds: int, scale: int) -> list[np.ndarray]:
    """One codebook a part, entries * width, after all rounds."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    begun = integers(np.array([r[0] for r in first], np.float64).reshape(len(first), length), scale)
    books = [begun[:, s] for s in slices(length)]
    for _ in range(rounds):
        sums = [b.astype(object) * 0 for b in books]
        counts = [[0] * len(first) for _ in books]
        for part, entry, place, total in _entry_sums(rows, books, length, scale).collect():
            if place < 0:
                counts[part][entry] = int(total)
            else:
                sums[part][entry, place] = int(total)
        books = [np.array([[s // n for s in row] if n else list(old) for row, n, old in zip(total, count, book, strict=True)], np.int64).reshape(book.shape)
                 for total, count, book in zip(sums, counts, books, strict=True)]
    return books


def slices(length: int, parts: int = PARTS) -> list[slice]:
    width, more = divmod(length, parts)
    ends = np.cumsum([0] + [width + (p < more) for p in range(parts)]).tolist()
    return [slice(a, b) for a, b in zip(ends, ends[1:], strict=False)]


def largest(length: int) -> int:
    """Differences of such integers, squared and added over a vector, stay in 64 bits."""
    return math.isqrt((1 << 62) // max(length, 1)) // 2


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * float(scale)), -(bound := largest(values.shape[1])), bound).astype(np.int64)


def digest(books: Iterable[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


class Dictionary:
    """The distinct integers of one dimension among some vectors, and each vector's place in them."""

    def __init__(self, column: np.ndarray):
        self.values, self.codes = np.unique(column, return_inverse=True)

    def squares(self, entries: np.ndarray, kind: type) -> np.ndarray:
        """Squared difference of each distinct value to every entry."""
        return np.square(np.subtract.outer(self.values, entries)).astype(kind)


def nearest(block: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of every row, the lower one of ties, and the squared distance."""
    rows, width = block.shape
    span = int(max(block.max(initial=0), book.max(initial=0)) - min(block.min(initial=0), book.min(initial=0)))
    kind = np.int32 if span * span * max(width, 1) < 1 << 31 else np.int64
    away = np.zeros((rows, len(book)), kind)
    for d in range(width):
        known = Dictionary(block[:, d])
        away += known.squares(book[:, d], kind)[known.codes]
    index = away.argmin(1)
    return index, away[np.arange(rows), index].astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], length: int, scale: int, rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Vectors of several Arrow batches at once: a dictionary pays where it has fewer values than there are rows."""
    held: list[pa.RecordBatch] = []

    def block():
        table = pa.Table.from_batches(held)
        values = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return table, integers(values.reshape(len(table), length), scale)

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield block()
            held = []
    if held:
        yield block()


def _block_rows(entries: int) -> int:
    return max(1, TABLE_BYTES // (8 * max(entries, 1)))


def _entry_sums(rows: DataFrame, books: list[np.ndarray], length: int, scale: int) -> DataFrame:
    """part, entry, place and total: sums of the components of each entry's parts, and at place -1 their number."""
    schema = "part int, entry int, place int, total long"
    kinds = tasks.arrow_schema(schema)

    def run(batches):
        sums = [np.zeros((len(b), b.shape[1] + 1), np.int64) for b in books]
        room = 0  # rows that can still be added before a sum might leave 64 bits
        for _, block in _blocks(batches, length, scale, _block_rows(len(books[0]))):
            if room < len(block):
                yield from leave(sums)
                room = (1 << 62) // max(largest(length), 1)
            room -= len(block)
            for book, part, total in zip(books, slices(length), sums, strict=True):
                index, _ = nearest(block[:, part], book)
                np.add.at(total[:, 1:], index, block[:, part])
                total[:, 0] += np.bincount(index, minlength=len(book))
        yield from leave(sums)

    def leave(sums):
        for part, total in enumerate(sums):
            entry, place = np.nonzero(total)
            if len(entry):
                kept = [np.full(len(entry), part), entry, place - 1, total[entry, place]]
                yield pa.record_batch([pa.array(c, k.type) for c, k in zip(kept, kinds, strict=True)], schema=kinds)
            total[:] = 0

    found = rows.select("embedding").mapInArrow(run, schema)
    return found.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def assigned(rows: DataFrame, books: list[np.ndarray], length: int, scale: int) -> DataFrame:
    """vec_id, label, code and error of every row."""
    hexes = pa.array([f"{i:02x}" for i in range(256)])
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches):
        for table, block in _blocks(batches, length, scale, _block_rows(len(books[0]))):
            parts = [nearest(block[:, part], book) for book, part in zip(books, slices(length), strict=True)]
            code = pa.compute.binary_join_element_wise(*(hexes.take(pa.array(index)) for index, _ in parts), "")
            out = pa.table({"vec_id": table.column("vec_id"), "label": table.column("label"), "code": code, "error": pa.array(sum(e for _, e in parts), pa.int64())})
            yield from out.to_batches()

    return rows.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")
