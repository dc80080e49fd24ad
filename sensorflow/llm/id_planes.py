"""Token ids in files of compressed bit planes.

A file holds the ids of its documents one after the other, in blocks of a fixed number of ids. A block is transposed into
bit (or byte) planes, each compressed with Zstandard on its own: plane k has bit k of every id. The footer is the chunk
index (start, number of ids, sizes of the planes), the document index (doc_id, number of ids), and their sizes.
"""

from __future__ import annotations

import json
import posixpath
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorflow.llm import encoding, tasks, vocab

MAGIC = b"IDPLANE1"
BLOCK_IDS = 1 << 16
MANIFEST = "path string, first_doc long, last_doc long, n_docs long, n_ids long"
DOCUMENT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def to_planes(ids: np.ndarray, kind: str = "bit") -> list[bytes]:
    """Planes of 32-bit ids, lowest first, as many as the largest id needs."""
    ids = np.ascontiguousarray(ids, "<u4")
    top = int(ids.max()).bit_length() if len(ids) else 0
    if kind == "byte":
        columns = ids.view(np.uint8).reshape(-1, 4)
        return [columns[:, k].tobytes() for k in range((top + 7) // 8)]
    narrow = ids.astype("<u2") if top <= 16 else ids
    return [np.packbits((narrow >> k & 1).astype(bool), bitorder="little").tobytes() for k in range(top)]


def from_planes(planes: list[bytes], count: int, kind: str = "bit") -> np.ndarray:
    if kind == "byte":
        ids = np.zeros((count, 4), np.uint8)
        for k, plane in enumerate(planes):
            ids[:, k] = np.frombuffer(plane, np.uint8)
        return ids.reshape(-1).view("<u4")
    ids = np.zeros(count, "<u2" if len(planes) <= 16 else "<u4")
    for k, plane in enumerate(planes):
        ids |= np.unpackbits(np.frombuffer(plane, np.uint8), count=count, bitorder="little").astype(ids.dtype) << k
    return ids.astype("<u4")


class PlaneWriter:
    """Streams documents into one file; holds one block and the document index."""

    def __init__(self, folder: str, kind: str, block_ids: int):
        self.path = tasks.attempt_name(folder, "ids", ".planes")
        system, place = tasks.store(self.path)
        self.file = system.open_output_stream(place, compression=None)
        self.file.write(MAGIC)
        self.kind, self.block_ids, self.at = kind, block_ids, len(MAGIC)
        self.waiting, self.n_waiting, self.n_ids = [], 0, 0
        self.chunks: list[dict] = []
        self.docs: list[tuple[int | None, int]] = []
        self.packer = zstandard.ZstdCompressor(level=3)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.block_ids:
            self._blocks(last=False)

    def _blocks(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, "<u4")
        whole = len(ids) if last else len(ids) // self.block_ids * self.block_ids
        for at in range(0, whole, self.block_ids):
            block = ids[at:min(at + self.block_ids, whole)]
            packed = [self.packer.compress(p) for p in to_planes(block, self.kind)]
            self.chunks.append({"start": self.at, "ids": len(block), "planes": [len(p) for p in packed]})
            for plane in packed:
                self.file.write(plane)
                self.at += len(plane)
        self.waiting, self.n_waiting = [ids[whole:]], len(ids) - whole

    def close(self) -> tuple:
        self._blocks(last=True)
        known = np.array([d is not None for d, _ in self.docs], bool)
        footer = [
            json.dumps({"kind": self.kind, "chunks": self.chunks}).encode(), np.packbits(known).tobytes(),
            np.array([d or 0 for d, _ in self.docs], "<i8").tobytes(), np.array([n for _, n in self.docs], "<u8").tobytes(),
        ]
        packed = [self.packer.compress(part) for part in footer]
        self.file.write(b"".join(packed))
        self.file.write(struct.pack("<4QQ", *map(len, packed), len(self.docs)) + MAGIC)
        self.file.close()
        ids = [d for d, _ in self.docs if d is not None]
        return self.path, min(ids, default=None), max(ids, default=None), len(self.docs), self.n_ids


_TAIL = struct.calcsize("<4QQ") + len(MAGIC)


def footer(path: str) -> tuple[dict, list[tuple[int | None, int]]]:
    """The chunk index and the documents of a file."""
    end = tasks.file_size(path)
    tail = tasks.read_at(path, end - _TAIL, _TAIL)
    if not tail.endswith(MAGIC):
        raise ValueError(f"{path} is not a file of id planes")
    *sizes, count = struct.unpack("<4QQ", tail[:-len(MAGIC)])
    raw, at, parts = tasks.read_at(path, end - _TAIL - sum(sizes), sum(sizes)), 0, []
    for size in sizes:
        parts.append(zstandard.ZstdDecompressor().decompress(raw[at:at + size]))
        at += size
    known = np.unpackbits(np.frombuffer(parts[1], np.uint8), count=count)
    ids, lengths = np.frombuffer(parts[2], "<i8").tolist(), np.frombuffer(parts[3], "<u8").tolist()
    return json.loads(parts[0]), [(d if k else None, n) for d, k, n in zip(ids, known, lengths, strict=True)]


def chunk_ids(path: str, index: dict, number: int) -> np.ndarray:
    """The ids of one chunk, read by its entry in the index."""
    chunk = index["chunks"][number]
    raw, at, planes = tasks.read_at(path, chunk["start"], sum(chunk["planes"])), 0, []
    for size in chunk["planes"]:
        planes.append(zstandard.ZstdDecompressor().decompress(raw[at:at + size]))
        at += size
    return from_planes(planes, chunk["ids"], index["kind"])


def file_documents(path: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, ids of the file before it, its ids) of each document; holds one document and one chunk."""
    index, docs = footer(path)
    number, held, start = 0, np.zeros(0, "<u4"), 0
    for doc_id, count in docs:
        parts, need = [], count
        while need > len(held):
            parts.append(held)
            need -= len(held)
            held, number = chunk_ids(path, index, number), number + 1
        parts.append(held[:need])
        held = held[need:]
        yield doc_id, start, parts[0] if len(parts) == 1 else np.concatenate(parts)
        start += count


def write_ids(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 1, kind: str = "bit",
              block_ids: int = BLOCK_IDS) -> DataFrame:
    """Writes the ids of every whole text (and `end_id`) below `folder` in ascending doc_id order; gives the manifest.

    A null text is empty and leaves only the end id. Null doc_ids come first. Rows with equal doc_ids are ordered by a
    hash of their texts, and all are written. Extra columns are ignored; no rows give an empty manifest. Texts are
    range-partitioned by (doc_id, hash), one file for each partition, and shuffled once. A repeated task writes a new file;
    files that the manifest does not name are leftovers.
    """
    path = path or vocab.default_path()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, ids_of = None, encoding.ids_of(path)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                file = file or PlaneWriter(folder, kind, block_ids)
                file.add(doc_id, np.append(ids_of(text or ""), np.array([end_id], "<u4")))
        if file is not None:
            yield tasks.record_batch([file.close()], tasks.arrow_schema(MANIFEST))

    tasks.make_folder(folder)
    order = ["doc_id", F.xxhash64("text")]
    rows = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    manifest = posixpath.join(folder, "manifest")
    rows.mapInArrow(write, MANIFEST).write.parquet(manifest)
    return docs.sparkSession.read.schema(MANIFEST).parquet(manifest)


def read_ids(manifest: DataFrame, ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and the crc32 of its ids, read from the files.

    `ids` adds the ids themselves. The starts of the files are running totals over the manifest, one row for each file.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = []
                for doc_id, start, values in file_documents(path):
                    row = doc_id, base + start, len(values), zlib.crc32(values.astype("<u4", copy=False).tobytes())
                    rows.append((*row, values.tolist()) if ids else row)
                    if len(rows) >= tasks.BATCH_ROWS:
                        yield tasks.record_batch(rows, tasks.arrow_schema(schema))
                        rows = []
                yield tasks.record_batch(rows, tasks.arrow_schema(schema))

    schema = DOCUMENT + (", ids array<long>" if ids else "")
    before = Window.orderBy(F.col("first_doc").asc_nulls_first(), "last_doc", "path").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    return tasks.spread(bases).mapInArrow(read, schema)


def stored(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Writes the ids to a fresh folder below the shared one and reads every document back."""
    return read_ids(write_ids(docs, tasks.work_path(spark, "ids"), **options))
