"""Small helpers shared by the operators: Arrow map functions, work folders, salted group minima, files."""

from __future__ import annotations

import os
import posixpath
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import sensorflow
from sensorflow.session import work_path

BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> None:
    """Texts are long: hand fewer rows and bytes at a time to Python than the defaults of 10,000 rows, any number of bytes."""
    environment = spark.sparkContext.environment  # of the Python workers, which must find this package as the driver did
    root = os.path.dirname(os.path.dirname(os.path.abspath(sensorflow.__file__)))
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [environment.get("PYTHONPATH"), root]))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def map_rows(df: DataFrame, columns: list[str], schema: str, make: Callable[[], Callable[..., Iterable[tuple]]]) -> DataFrame:
    """One call of `make()()` per Arrow batch with one list per column; it yields the rows of the result.

    Only the named columns travel to Python. Rows leave in `batches`.
    """
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in found:
            yield from batches(step(*(batch.column(i).to_pylist() for i in range(batch.num_columns))), kinds)

    kinds = arrow_schema(schema)
    return df.select(*columns).mapInArrow(run, schema)


_KINDS = {
    "long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
    "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()),
}


def arrow_schema(schema: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (part.split() for part in schema.split(", "))])


def record_batch(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)


def batches(rows: Iterable[tuple], kinds: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of at most BATCH_ROWS rows, or of the rows with which texts and binaries come to BATCH_BYTES."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, (bytes, str)))
        if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield record_batch(held, kinds)
            held, size = [], 0
    if held:
        yield record_batch(held, kinds)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written below the shared work folder and read again: a cut that survives lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(path: str) -> None:
    """Deletes a work table that nothing reads any more."""
    system, place = store(path)
    system.delete_dir(place)


def salts(spark: SparkSession) -> int:
    """Parts a hot key is split into: as many as a shuffle has, so no part is larger than a fair share."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def salted(df: DataFrame, *by: str | Column, name: str = "salt") -> DataFrame:
    return df.withColumn(name, F.pmod(F.xxhash64(*by), F.lit(salts(df.sparkSession))).cast("int"))


def group_totals(df: DataFrame, keys: list[str], **totals: tuple[Callable[[Column], Column], Callable[[Column], Column], str]) -> DataFrame:
    """Totals of each group, one row for every (group, salt) that occurs in `df` (which has a `salt`).

    Each total is (over rows, over parts, column). Joining the result on keys and salt spreads a hot group over its salts;
    nothing here gathers the rows of a group.
    """
    parts = df.groupBy(*keys, "salt").agg(*(rows(F.col(c)).alias(n) for n, (rows, _, c) in totals.items()))
    whole = parts.groupBy(*keys).agg(*(again(F.col(n)).alias(n) for n, (_, again, _) in totals.items()))
    both = parts.select(*(F.col(k).alias(f"_{k}") for k in keys), "salt")
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    return both.join(whole, on).select(*keys, "salt", *totals)


# --- files: written by tasks to the shared folder; the manifest, not the listing, says which ones count -------------

def store(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def attempt_name(folder: str, stem: str, ending: str) -> str:
    """A repeated task writes under another name; only the name in the manifest counts."""
    return posixpath.join(folder, f"{stem}-{uuid.uuid4().hex}{ending}")


def read_at(path: str, start: int, size: int) -> bytes:
    system, place = store(path)
    with system.open_input_file(place) as file:
        return file.read_at(size, start)


def file_size(path: str) -> int:
    system, place = store(path)
    return system.get_file_info(place).size


def make_folder(path: str) -> None:
    system, place = store(path)
    system.create_dir(place, recursive=True)


def spread(files: DataFrame) -> DataFrame:
    """One row per file, dealt to as many tasks as a shuffle has: a few rows can mean many bytes."""
    return files.repartition(salts(files.sparkSession))
