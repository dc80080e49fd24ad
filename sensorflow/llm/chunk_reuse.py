"""BPE encoding and decoding with content-defined chunks that are encoded once.

1. A rolling hash over the bytes of a text cuts it where the hash of the last 32 bytes has a given pattern, so equal
   passages are cut into equal chunks wherever they stand. The documents are written once with a number of their own, so
   equal rows are told apart from here on. Only (number, place, key) of chunks are shuffled.
2. A chunk that several documents share is encoded once, by its owner: the document with the smallest number. Shared keys
   stay in a table; references find theirs by (key, salt), so a chunk that a third of all documents have is spread.
3. The documents' files are read a second time, each next to the marks of its shared chunks, in the order of the file. A
   document without marks, or that owns all its shared chunks, is finished there. Of the others, chunks of their own and those
   they own are encoded, and they ask for the shared ones. Only what is asked for travels.
4. A cut may fall inside a word, so each join is repaired: the window around it grows outward until it starts and ends at
   white space and is encoded again; what lies outside stands. White space is never part of a token and no token reaches
   over it, so such a window encodes exactly as in the whole text, and where a cut touches white space both sides already
   agree with it.
Nothing is broadcast or brought to the driver. A task holds a batch of documents, or the pieces of one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorflow.llm import encoding, tasks, vocab
from sensorflow.llm.shingles import mixed
from sensorflow.session import work_path

WINDOW = 32
LEAST, USUAL, MOST = 1024, 4096, 1 << 16
_GEAR = (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def cuts(data: bytes, least: int = LEAST, usual: int = USUAL, most: int = MOST) -> list[int]:
    """Ends of the chunks. The hash at a place depends on the 32 bytes before it; cuts never split a character."""
    n = len(data)
    if n <= least:
        return [n] if n else []
    raw = np.frombuffer(data, np.uint8)
    rolled, reach = _GEAR[raw], 1
    while reach < WINDOW:  # sum of gear[byte] << age over the last `reach` bytes, doubled
        older = rolled[:-reach] << np.uint32(reach)
        rolled = rolled.copy()
        rolled[reach:] += older
        reach *= 2
    bits = max(1, (usual - least).bit_length() - 1)
    marks = np.flatnonzero((rolled[:-1] >> np.uint32(32 - bits)) == 0) + 1
    marks = marks[raw[marks] & 0xC0 != 0x80].tolist()
    ends, start = [], 0
    for mark in [*marks, n]:
        while mark - start > most:
            end = start + most
            while raw[end] & 0xC0 == 0x80:
                end -= 1
            ends.append(end)
            start = end
        if mark - start >= least or mark == n:
            ends.append(mark)
            start = mark
    return ends


# Only these are looked for: any of them is white space for the library too.
_HEAD = re.compile(r"[^ \t\n\r]*")


class Piece:
    """An encoded chunk: ids of the word it begins with, of its middle, and of the word it ends with."""

    __slots__ = ("head", "tail", "head_ids", "middle", "tail_ids", "whole")

    def __init__(self, head: str, tail: str, head_ids: bytes, middle: bytes, tail_ids: bytes, whole: bool):
        self.head, self.tail, self.head_ids, self.middle, self.tail_ids, self.whole = head, tail, head_ids, middle, tail_ids, whole


def encode_chunk(text: str, encode: Callable[[str], bytes]) -> Piece:
    head = _HEAD.match(text).group()
    if len(head) == len(text):
        return Piece(text, "", encode(text), b"", b"", True)
    tail = text[_last_blank(text) + 1:]
    return Piece(head, tail, encode(head), encode(text[len(head):len(text) - len(tail)]), encode(tail), False)


def _last_blank(text: str) -> int:
    return max(text.rfind(" "), text.rfind("\n"), text.rfind("\t"), text.rfind("\r"))


def joined(pieces: list[Piece], encode: Callable[[str], bytes]) -> bytes:
    """Ids of the text whose chunks these are; each join is repaired unless both sides already agree with it."""
    out: list[bytes] = []
    words: list[str] = []  # the window: parts of one word on both sides of the joins met so far
    ids: list[bytes] = []

    def settle() -> None:
        # A window of a single part was encoded as it stands in the text.
        out.append(ids[0] if len(words) == 1 else encode("".join(words)) if words else b"")
        words.clear()
        ids.clear()

    for piece in pieces:
        if piece.head:
            words.append(piece.head)
            ids.append(piece.head_ids)
        if piece.whole:
            continue
        settle()
        out.append(piece.middle)
        if piece.tail:
            words.append(piece.tail)
            ids.append(piece.tail_ids)
    settle()
    return b"".join(out)


def _packed(piece: Piece, packer: zstandard.ZstdCompressor) -> bytes:
    """Lengths, words and ids of a piece, compressed: this is what travels to every document that has the chunk."""
    head, tail = piece.head.encode(), piece.tail.encode()
    parts = [head, tail, piece.head_ids, piece.middle, piece.tail_ids]
    lengths = np.array([*map(len, parts), piece.whole], "<u4").tobytes()
    return packer.compress(lengths + b"".join(parts))


def _unpacked(data: bytes, unpacker: zstandard.ZstdDecompressor) -> Piece:
    raw = unpacker.decompress(data)
    *lengths, whole = np.frombuffer(raw[:24], "<u4").tolist()
    parts, at = [], 24
    for n in lengths:
        parts.append(raw[at:at + n])
        at += n
    return Piece(parts[0].decode(), parts[1].decode(), parts[2], parts[3], parts[4], bool(whole))


# --- the job ---------------------------------------------------------------------------------------------------------

READ_ROWS = 64  # documents of a file that are read at a time
REFERENCES = 1000  # to a chunk, for each copy of its encoding
GROUP_BYTES = 16 << 20  # row groups of the written documents: bounds what a reader holds, however long the texts


def _parts(text: str, sizes: tuple[int, int, int]) -> list[bytes]:
    data, start, parts = text.encode(), 0, []
    for end in cuts(data, *sizes):
        parts.append(data[start:end])
        start = end
    return parts


class Finish:
    """What is returned of a document's ids."""

    def __init__(self, path: str, digests: bool):
        self.digests, self.strings = digests, vocab.vocabulary(path).strings

    def __call__(self, doc_id: int | None, ids: bytes) -> tuple:
        if not self.digests:
            return doc_id, len(ids) // 4, ids
        text = decoded(np.frombuffer(ids, "<u4").tolist(), self.strings)
        return doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def decoded(ids: list[int], strings: dict[int, str]) -> str:
    """As the library for a file without a decoder: the strings of the known ids, special ones too, one blank between."""
    return " ".join([strings[i] for i in ids if i in strings])


IDS = "doc_id long, n_tokens long, ids binary"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str | None = None, digests: bool = False,
                     sizes: tuple[int, int, int] = (LEAST, USUAL, MOST)) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian, 32 bits) of every whole text, or SHA-256 of the ids and the decoded text.

    A null text is empty: no ids. Rows with a null or repeated doc_id, also wholly equal rows, give one row each. Extra
    columns are ignored; no rows give no rows. Very long texts and texts without white space are encoded chunk by chunk.
    """
    path = path or vocab.default_path()
    spark = docs.sparkSession
    schema = DIGESTS if digests else IDS
    results = schema.removeprefix("doc_id long, ")

    folder = work_path(spark, "numbered")
    numbered = docs.select("doc_id", "text").withColumn("id", F.monotonically_increasing_id())
    numbered.write.option("compression", "zstd").option("parquet.block.size", GROUP_BYTES).parquet(folder)
    numbered = spark.read.schema(numbered.schema).parquet(folder)
    pieces = tasks.written(_encoded(numbered, _marks(numbered, sizes), path, digests, results, sizes), "pieces")
    tasks.removed(folder)

    names = [name for name, _ in (part.split() for part in schema.split(", "))]
    alone = pieces.filter("number IS NULL AND chunk IS NULL").select(*names)
    encoded = pieces.filter("number IS NULL AND chunk IS NOT NULL").select("chunk", "copy", "packed")
    # One copy of an encoding for about REFERENCES references to it: few chunks need a second one.
    dealt = encoded.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copy") - 1)))
    wanted = pieces.filter("number IS NOT NULL AND chunk IS NOT NULL").select("id", "doc_id", "number", "chunk", "copy")
    taken = wanted.join(dealt, ["chunk", "copy"]).select("id", "doc_id", "number", "packed")
    own = pieces.filter("number IS NOT NULL AND chunk IS NULL").select("id", "doc_id", "number", "packed")
    ordered = own.unionByName(taken).repartition("id").sortWithinPartitions("id", "number")
    return alone.unionByName(ordered.mapInArrow(_assembler(path, digests, schema), schema))


def _marks(numbered: DataFrame, sizes: tuple[int, int, int]) -> DataFrame:
    """References to chunks that several documents have: id, number, chunk, the copy of the encoding that this one takes, and
    where the document is the owner, how many copies there are."""
    def keys(ids, texts):
        for id_, text in zip(ids, texts, strict=True):
            yield from ((id_, i, xxhash.xxh3_128_digest(part)) for i, part in enumerate(_parts(text or "", sizes)))

    found = tasks.map_rows(numbered, ["id", "text"], "id long, number int, chunk binary", lambda: keys)
    references = tasks.written(tasks.salted(found, "id"), "references")
    # A group of the window is the salts of a chunk, however many references it has.
    salts = references.groupBy("chunk", "salt").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("id").alias("n"))
    whole = Window.partitionBy("chunk")
    copies = F.least(F.ceil(F.sum("n").over(whole) / REFERENCES), F.lit(tasks.salts(numbered.sparkSession))).cast("int")
    shared = salts.select("chunk", "salt", F.min("first").over(whole).alias("owner"), F.max("last").over(whole).alias("last"),
                          copies.alias("copies")).filter("owner < last").drop("last")
    shared = tasks.written(shared, "shared")
    marks = references.join(shared, ["chunk", "salt"]).select(
        "id", "number", "chunk", F.pmod("salt", "copies").alias("copy"), F.when(F.col("id") == F.col("owner"), F.col("copies")).alias("copies"))
    return tasks.written(marks, "marks")


def _encoded(numbered: DataFrame, marks: DataFrame, path: str, digests: bool, results: str, sizes: tuple[int, int, int]) -> DataFrame:
    """Documents with results, where no mark is another's; of the others, pieces of their own (number, packed) and what they ask
    for (number, chunk, copy). Shared chunks (chunk, how many copies, packed), once each.

    Each written file goes to one task, followed by the marks of its documents in their order.
    """
    spark = numbered.sparkSession
    files = numbered.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min("id").alias("start"))
    part, none = (lambda c: F.shiftright(c, 33).alias("part")), (lambda kind: F.lit(None).cast(kind))
    heads = files.select(part("start"), none("long").alias("id"), "start", "file", none("int").alias("number"),
                         none("binary").alias("chunk"), none("int").alias("copy"), none("int").alias("copies"))
    rows = marks.select(part("id"), "id", none("long").alias("start"), none("string").alias("file"), "number", "chunk", "copy", "copies")
    # A named number of parts: marks are small, and what their size says about the work of a file is nothing.
    both = heads.unionByName(rows).repartition(tasks.salts(spark), "part").sortWithinPartitions(
        "part", F.asc_nulls_first("id"), "start", "number")
    schema = f"id long, doc_id long, number int, chunk binary, copy int, packed binary, {results}"
    empty = (None,) * (results.count(",") + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, finish, packer = encoding.id_bytes(path), Finish(path, digests), zstandard.ZstdCompressor(level=3)

        def pieces() -> Iterator[tuple]:
            for id_, doc_id, text, marked in _with_marks(batches):
                alone, made, whole = all(copies for *_, copies in marked.values()), {}, []
                for i, data in enumerate(_parts(text or "", sizes)):
                    key, copy, copies = marked.get(i, (None, None, True))
                    if copies and (piece := made.get(key)) is None:
                        piece = encode_chunk(data.decode(), encode)
                        packed = None if alone and not key else _packed(piece, packer)
                        if key:
                            made[key] = piece
                            yield id_, doc_id, None, key, copies, packed, *empty
                    if alone:
                        whole.append(piece)
                    elif key:
                        yield id_, doc_id, i, key, copy, None, *empty
                    else:
                        yield id_, doc_id, i, None, None, packed, *empty
                if alone:
                    yield id_, doc_id, None, None, None, None, *finish(doc_id, joined(whole, encode))[1:]

        yield from tasks.batches(pieces(), tasks.arrow_schema(schema))

    return both.mapInArrow(run, schema)


def _with_marks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int | None, str | None, dict[int, tuple[bytes, int, int | None]]]]:
    """The documents of each file with the marks (place -> key, copy, copies) of each; both come in the order of their numbers."""
    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    for _, group in groupby(rows(), key=lambda row: row[0]):
        files, mark = [], None
        for mark in group:
            if mark[1] is not None:
                break
            files.append(mark[3])
            mark = None
        for file in files:
            for id_, doc_id, text in _documents(file):
                marked = {}
                while mark is not None and mark[1] == id_:
                    marked[mark[4]] = mark[5:8]
                    mark = next(group, None)
                yield id_, doc_id, text, marked


def _documents(file: str) -> Iterator[tuple[int, int | None, str | None]]:
    system, place = tasks.store(file)
    with system.open_input_file(place) as source:
        for batch in pq.ParquetFile(source).iter_batches(READ_ROWS, columns=["id", "doc_id", "text"]):
            yield from zip(*(batch.column(c).to_pylist() for c in ("id", "doc_id", "text")), strict=True)


def _assembler(path: str, digests: bool, schema: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, finish, unpacker = encoding.id_bytes(path), Finish(path, digests), zstandard.ZstdDecompressor()

        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        def documents() -> Iterator[tuple]:
            for (_, doc_id), pieces in groupby(rows(), key=lambda row: row[:2]):
                yield finish(doc_id, joined([_unpacked(packed, unpacker) for *_, packed in pieces], encode))

        yield from tasks.batches(documents(), tasks.arrow_schema(schema))

    return run
