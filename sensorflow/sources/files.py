"""File sources: JSON lines, text, layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sensorflow.schema import READING

LOG_PATH = r"/(\d+)/(\d{8})\.log$"


def json_lines(spark: SparkSession, path: str, schema: StructType = READING, location: str = LOG_PATH) -> DataFrame:
    """One reading per line. Device and day come from the path, by the two groups of `location`."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").json(path)
    file = F.col("_metadata.file_path")
    return rows.select(
        "*", F.regexp_extract(file, location, 1).alias("file_device"),
        F.regexp_extract(file, location, 2).alias("file_day"))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def layer(spark: SparkSession, path: str, *conditions: Column, **partition) -> DataFrame:
    """A layer read back. Equal conditions on partition columns prune directories before any file is opened."""
    df = spark.read.parquet(path)
    for name, value in partition.items():
        df = df.filter(F.col(name) == value)
    for condition in conditions:
        df = df.filter(condition)
    return df


def newest_day(spark: SparkSession, path: str) -> DataFrame:
    """The newest day of a layer by year, month and day. The day is found among the directory values alone, and the filter
    on it leaves only that day's directories to read."""
    days = spark.read.parquet(path)
    last = days.select("year", "month", "day").distinct().orderBy(F.desc("year"), F.desc("month"), F.desc("day")).first()
    return days.filter("false") if last is None else layer(spark, path, year=last.year, month=last.month, day=last.day)


def sequence(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    return spark.range(0, n, 1, partitions) if partitions else spark.range(n)


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows in order: each task keeps n, only those are merged."""
    return df.orderBy(*order).limit(n)


def records(spark: SparkSession, rows: list, schema: StructType = READING) -> DataFrame:
    """A few hand-made records with an explicit schema (no inference pass)."""
    return spark.createDataFrame(rows, schema)


def register_views(**frames: DataFrame) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
