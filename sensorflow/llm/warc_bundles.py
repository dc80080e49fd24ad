"""WARC records in seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each a group of whole records, and a footer in the public seekable
format: a skippable frame that lists the sizes of all frames. The index says for each record id the bundle, the frame and
the offset inside the frame, so one record costs one footer, one frame and no scan.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.llm import tasks

# Fixed values of the seekable format and of WARC 1.1.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
FRAME_BYTES = 1 << 20

INDEX = "record_id string, page_id long, path string, frame int, frame_offset long, length long"
RECORD = "record_id string, page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long"


def write_bundles(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Writes a record for every row of `pages` (page_id, url, html) below `folder` and returns the index.

    Of rows with equal payloads of at least `min_revisit_bytes`, the one with the largest page_id is a response and the
    others are revisits of it; rows that repeat page and payload are all written, with the same type. A null html is an
    empty payload; a null page_id sorts below all others and a payload that only such rows have is a response; a null url
    leaves the target out. Extra columns are ignored, and no rows give an empty index.

    Equal payloads are found by digest: maxima per (digest, salt), then per digest, are joined back on both, so a payload
    that a third of all pages share is spread over all tasks. Payloads are shuffled once. A repeated task writes a new
    file; files that no index names are leftovers.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = tasks.salted(pages.select("page_id", "url", body.alias("payload"), F.sha1(body).alias("digest")), "page_id", "url")
    last = tasks.group_totals(rows, ["digest"], last_id=(F.max, F.max, "page_id"))
    shared = F.length("payload") >= min_revisit_bytes
    roles = rows.join(last, ["digest", "salt"]).select(
        "page_id", "url", "payload", "digest", F.when(shared, F.col("last_id")).alias("last_id"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in batches:
            if bundle is None:
                bundle = BundleWriter(folder, frame_bytes)
            for page_id, url, payload, digest, last_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                bundle.add(page_id, url, payload, digest, last_id)
            yield from _batches(bundle.taken())
        if bundle is not None:
            bundle.close()

    tasks.make_folder(folder)
    path = posixpath.join(folder, "index")
    roles.mapInArrow(write, INDEX).write.parquet(path)
    return spark.read.schema(INDEX).parquet(path)


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield tasks.record_batch(rows, tasks.arrow_schema(INDEX))


class BundleWriter:
    """Streams records into one bundle; holds one frame."""

    def __init__(self, folder: str, frame_bytes: int):
        self.path = tasks.attempt_name(folder, "bundle", ".warc.zst")
        system, place = tasks.store(self.path)
        self.file = system.open_output_stream(place, compression=None)
        self.frame_bytes, self.frame, self.filled = frame_bytes, [], 0
        self.sizes: list[tuple[int, int]] = []
        self.rows: list[tuple] = []
        self.packer = zstandard.ZstdCompressor(level=3)

    def add(self, page_id, url, payload, digest, last_id) -> None:
        name = base64.b32encode(bytes.fromhex(digest)).decode()
        revisit = last_id is not None and page_id != last_id
        record = record_bytes(page_id, url, payload, name, last_id if revisit else None, revisit)
        self.rows.append((record_id(page_id, name), page_id, self.path, len(self.sizes), self.filled, len(record)))
        self.frame.append(record)
        self.filled += len(record)
        if self.filled >= self.frame_bytes:
            self.end_frame()

    def end_frame(self) -> None:
        if self.filled:
            packed = self.packer.compress(b"".join(self.frame))
            self.file.write(packed)
            self.sizes.append((len(packed), self.filled))
            self.frame, self.filled = [], 0

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows

    def close(self) -> None:
        self.end_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.file.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.file.close()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record. The block is an HTTP response; a revisit keeps its headers and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}",
            f"WARC-Date: {DATE}"]
    if url is not None:  # percent-encoded where it could not stand in a header
        head.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URL_SAFE = "%!#$&'()*+,/:;=?@[]~"


def parsed(record: bytes, at: int = 0) -> tuple[dict[str, str], dict[str, str], bytes, int]:
    """Headers, HTTP headers and payload of the record at `at`, and where it ends."""
    body = record.index(b"\r\n\r\n", at) + 4
    head = _fields(record[at:body - 4])
    end = body + int(head["content-length"])
    payload = record.index(b"\r\n\r\n", body, end) + 4
    return head, _fields(record[body:payload - 4]), record[payload:end], end + 4


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return {name.lower(): value for name, value in pairs}


def _page(urn: str) -> int | None:
    number = urn.split(":")[2]
    return int(number) if number else None


def _record_row(head: dict[str, str], http: dict[str, str], payload: bytes) -> tuple:
    digest = head["warc-payload-digest"].removeprefix("sha1:")
    if head["warc-type"] == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"{head['warc-record-id']}: the payload does not have its digest")
    refers = head.get("warc-refers-to")
    return (head["warc-record-id"], _page(head["warc-record-id"]), head.get("warc-target-uri"), head["warc-type"],
            None if refers is None else _page(refers), digest, int(http["content-length"]))


def frames(path: str) -> list[tuple[int, int, int]]:
    """Start, stored size and content size of each frame, from the footer."""
    end = tasks.file_size(path)
    count, _, magic = struct.unpack("<IBI", tasks.read_at(path, end - 9, 9))
    if magic != SEEKABLE:
        raise ValueError(f"{path} has no seek table")
    table = tasks.read_at(path, end - 9 - 8 * count, 8 * count)
    found, at = [], 0
    for stored, content in struct.iter_unpack("<II", table):
        found.append((at, stored, content))
        at += stored
    return found


def frame_content(path: str, frame: tuple[int, int, int]) -> bytes:
    start, stored, content = frame
    return zstandard.ZstdDecompressor().decompress(tasks.read_at(path, start, stored), max_output_size=content)


def read_bundles(index: DataFrame, payload: bool = True) -> DataFrame:
    """Every record of the indexed bundles: id, page_id, url, type, refers_to, digest and size of the full payload.

    `payload` adds the payload itself, null for a revisit. Digests of responses are checked against their payloads. A
    task holds one frame at a time.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for frame in frames(path):
                    content, at, rows = frame_content(path, frame), 0, []
                    while at < len(content):
                        head, http, body, at = parsed(content, at)
                        row = _record_row(head, http, body)
                        rows.append((*row, body if row[3] == "response" else None) if payload else row)
                    yield tasks.record_batch(rows, tasks.arrow_schema(schema))

    schema = RECORD + (", payload binary" if payload else "")
    return tasks.spread(index.select("path").distinct()).mapInArrow(read, schema)


def lookup(index: DataFrame, record_ids: DataFrame) -> DataFrame:
    """The records whose id is in `record_ids`; reads the frames they lie in and nothing else."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tables = (None, b""), {}
        for batch in batches:
            rows = []
            for path, frame, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held[0] != (path, frame):
                    if path not in tables:
                        tables = {path: frames(path)}
                    held = ((path, frame), frame_content(path, tables[path][frame]))
                head, http, body, _ = parsed(held[1], at)
                row = _record_row(head, http, body)
                rows.append((*row, body if row[3] == "response" else None))
            yield tasks.record_batch(rows, tasks.arrow_schema(RECORD + ", payload binary"))

    places = index.join(record_ids.select("record_id").distinct(), "record_id", "left_semi")
    places = places.select("path", "frame", "frame_offset").repartition("path", "frame")
    return places.sortWithinPartitions("path", "frame", "frame_offset").mapInArrow(read, RECORD + ", payload binary")


def archive(spark: SparkSession, pages: DataFrame, **options) -> DataFrame:
    """Writes `pages` to a fresh folder below the shared one and gives what the bundles hold, without payloads."""
    return read_bundles(write_bundles(pages, tasks.work_path(spark, "warc"), **options), payload=False)
