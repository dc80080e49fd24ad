"""Layer sinks for tables: partitioned writes, fan-out of a micro-batch, upsert log, compaction."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorflow.functions.features import date_parts
from sensorflow.operators.records import alerts, process, quality_metrics
from sensorflow.schema import CODEC_BY_LAYER, RETENTION_DAYS_BY_LAYER

DAY_PARTS = ("DeviceId", "year", "month", "day")


def with_date_parts(df: DataFrame, time: str = "event_time", parts=("year", "month", "day")) -> DataFrame:
    made = date_parts(time)
    return df.withColumns({p: made[p] for p in parts})


def write_layer(df: DataFrame, path: str, partition_by=(), kind: str = "parquet", codec: str | None = None,
                mode: str = "errorifexists") -> None:
    """Writes a partitioned layer. Rebalancing by the partition columns gives each directory few files of the
    advised size, and splits a directory that holds a large part of the rows over several tasks."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(kind).mode(mode).partitionBy(*partition_by)
    if codec:
        writer = writer.option("compression", codec)
    writer.save(path)


def write_by_class(routed: DataFrame, path: str, time: str = "event_time") -> None:
    """Routed records below one directory per store, then by device and day."""
    write_layer(with_date_parts(routed, time), path, ("storage", *DAY_PARTS))


def retain_layer(spark: SparkSession, name: str, source: str, target: str, as_of: Column) -> None:
    """The days of a layer that its retention keeps, and its rows without a day, in a new place. The condition is on
    partition columns only, so expired directories are not even listed for reading."""
    day = F.make_date("year", "month", "day")
    kept = spark.read.parquet(source).filter(day.isNull() | (day >= F.date_sub(as_of, RETENTION_DAYS_BY_LAYER[name])))
    write_layer(kept, target, DAY_PARTS, codec=CODEC_BY_LAYER[name])


def write_text(df: DataFrame, path: str, column: str = "value") -> None:
    df.select(F.col(column).cast("string").alias("value")).write.text(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report of a few rows as one JSON file. The rows are moved, so the work before keeps its parallelism."""
    report.repartition(1).write.json(path)


def batch_path(root: str, run: str, batch_id: int) -> str:
    return f"{root}/run={run}/batch={batch_id}"


@dataclass(frozen=True)
class FanOut:
    """Writes a micro-batch to the raw, processed, alert and quality layers.

    Each layer has a directory for each run (the id in the checkpoint) and batch that is overwritten as a whole: a batch
    that is run again after a failure replaces itself, and a query with a new checkpoint, which counts its batches from 0
    again, replaces nothing. With `keys` the processed layer is an upsert log: the newest row of each key, by `order`.
    """

    root: str
    time: str = "event_time"
    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()

    def __call__(self, batch: DataFrame, batch_id: int, run: str = "0") -> None:
        batch = batch.persist()
        try:
            # One cached table: raw columns as they came, and what processing adds beside them.
            processed = process(batch, time=self.time)
            self._write(with_date_parts(batch, self.time), "raw", batch_id, run, DAY_PARTS)
            if self.keys:
                self.processed()(processed, batch_id, run)
            else:
                self._write(processed, "processed", batch_id, run, ("DeviceId",))
            self._write(alerts(processed), "alerts", batch_id, run, (), "json")
            self._write(quality_metrics(processed), "quality", batch_id, run, ())
        finally:
            batch.unpersist()

    def processed(self) -> UpsertLog:
        """The keyed processed layer; one directory per device inside each batch."""
        return UpsertLog(self.path("processed"), self.keys, self.order or (self.time,), ("DeviceId",))

    def _write(self, df: DataFrame, name: str, batch_id: int, run: str, partition_by, kind: str = "parquet") -> None:
        write_layer(df, batch_path(self.path(name), run, batch_id), partition_by, kind, CODEC_BY_LAYER.get(name), "overwrite")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


@dataclass(frozen=True)
class UpsertLog:
    """Keyed updates without a table format.

    Every micro-batch appends its newest row per key as its own directory; reading takes the newest row per key over
    all of them. Nothing is rewritten in place, so a lost executor or a batch that is run again does no harm, and the
    cost of a batch does not depend on what is stored. `compact` folds the log into a new one from time to time.
    """

    path: str
    keys: tuple[str, ...]
    order: tuple[str, ...]
    partition_by: tuple[str, ...] = ()

    def __call__(self, batch: DataFrame, batch_id: int, run: str = "0") -> None:
        write_layer(self.newest(batch), batch_path(self.path, run, batch_id), self.partition_by, mode="overwrite")

    def newest(self, df: DataFrame) -> DataFrame:
        """Newest row per key. The rank limit is applied before the shuffle: copies of one key shrink to one per task."""
        newest = Window.partitionBy(*self.keys).orderBy(*(F.desc(c) for c in self.order))
        return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")

    def read(self, spark: SparkSession) -> DataFrame:
        return self.newest(spark.read.parquet(self.path).drop("run", "batch"))

    def compact(self, spark: SparkSession, target: str) -> UpsertLog:
        """Writes the current state as one batch of a new log, under a run of its own. Streams go on with the new log; what
        it holds is then read at the cost of the keys, not of their history."""
        write_layer(self.read(spark), batch_path(target, "compacted", 0), self.partition_by)
        return UpsertLog(target, self.keys, self.order, self.partition_by)


def compact(spark: SparkSession, source: str, target: str, partition_by=(), kind: str = "parquet",
            codec: str | None = None) -> None:
    """Many small files to few of the advised size, in a new place."""
    df = spark.read.format(kind).load(source)
    df = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    writer = df.write.format(kind).partitionBy(*partition_by)
    if codec:
        writer = writer.option("compression", codec)
    writer.save(target)


def data_files(df: DataFrame) -> int:
    return df.select(F.col("_metadata.file_path").alias("file")).distinct().count()
