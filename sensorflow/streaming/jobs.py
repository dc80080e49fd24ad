"""Streams: the row-wise functions and time-window aggregates of the library, run on Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from sensorflow.functions.features import word_count
from sensorflow.functions.quality import range_score
from sensorflow.operators.clean import containing
from sensorflow.schema import CODEC_BY_LAYER, SENSORS
from sensorflow.sinks.layers import DAY_PARTS, with_date_parts
from sensorflow.sources.topics import decode, envelope, well_formed

TRIGGER_BY_SINK = {"console": "10 seconds", "raw": "30 seconds", "processed": "1 minute", "alerts": "10 seconds"}
LATENESS = "60 seconds"


# --- stream to stream ----------------------------------------------------------------------------------------

def scored(messages: DataFrame, keep=()) -> DataFrame:
    """Decode, range score, processing time. Text that is no JSON is left to the quarantine."""
    return well_formed(decode(envelope(messages, keep), keep=keep)).withColumns(
        {"quality_score": range_score(), "processed_at": F.current_timestamp()})


def message_view(messages: DataFrame, keep=()) -> DataFrame:
    return envelope(messages, keep).withColumns(
        {"processing_time": F.current_timestamp(), "word_count": word_count("value")})


def keyword_messages(messages: DataFrame, keyword: str, keep=()) -> DataFrame:
    return containing(envelope(messages, keep), keyword)


def tumbling_statistics(df: DataFrame, window: str = "10 seconds", lateness: str = LATENESS, slide: str | None = None,
                        time: str = "event_time") -> DataFrame:
    """Per device and event-time window: rows, failures, mean of each sensor. With `slide` the windows overlap."""
    spec = F.window(time, window, slide) if slide else F.window(time, window)
    grouped = df.withWatermark(time, lateness).groupBy(spec.alias("w"), "DeviceId").agg(
        F.count("*").alias("readings"), F.count_if("isFail").alias("failures"),
        *(F.avg(s).alias(f"{s}_avg") for s in SENSORS))
    return grouped.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "DeviceId", "readings",
        "failures", *(f"{s}_avg" for s in SENSORS))


def sliding_by_panes(df: DataFrame, window: str = "1 hour", slide: str = "1 minute", lateness: str = LATENESS,
                     time: str = "event_time") -> DataFrame:
    """As `tumbling_statistics` with a slide, for windows that are much longer than it.

    Readings are summed once into panes as long as the slide, and windows are merged from panes: what is copied into every
    window it belongs to is one row a device and pane, not every reading."""
    panes = df.withWatermark(time, lateness).groupBy(F.window(time, slide).alias("pane"), "DeviceId").agg(
        F.count("*").alias("readings"), F.count_if("isFail").alias("failures"),
        *(F.sum(s).alias(f"{s}_sum") for s in SENSORS), *(F.count(s).alias(f"{s}_n") for s in SENSORS))
    # A pane lies in the windows that its last instant lies in; the watermark goes on from there.
    panes = panes.withColumn("at", F.window_time("pane"))
    merged = panes.groupBy(F.window("at", window, slide).alias("w"), "DeviceId").agg(
        F.sum("readings").alias("readings"), F.sum("failures").alias("failures"),
        *(F.try_divide(F.sum(f"{s}_sum"), F.sum(f"{s}_n")).alias(f"{s}_avg") for s in SENSORS))
    return merged.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "DeviceId", "readings", "failures",
        *(f"{s}_avg" for s in SENSORS))


def lost(sent: DataFrame, received: DataFrame, on=("DeviceId", "event_id"), lateness: str = LATENESS,
         time: str = "event_time") -> DataFrame:
    """Rows of one stream that did not come by another, each out once the watermark of both has passed it.

    Rows meet by time and the other columns, of which NULL meets NULL; copies of a received row count once, and are dropped
    before the join keeps them. State holds what lies within the allowed delay of the slower stream. After a restart both
    streams must have moved on once. Rows without time have no bound and are left out."""
    came = received.select(F.col(time).alias("_time"), *(F.col(c).alias(f"_{c}") for c in on)).filter("_time IS NOT NULL")
    came = came.withWatermark("_time", lateness).dropDuplicatesWithinWatermark(["_time", *(f"_{c}" for c in on)])
    sent = sent.filter(F.col(time).isNotNull()).withWatermark(time, lateness)
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on), F.col(time) == F.col("_time"))
    return sent.join(came, same, "left_outer").filter("_time IS NULL").select(*sent.columns)


def without_copies(df: DataFrame, keys=("DeviceId", "event_time"), lateness: str = LATENESS,
                   time: str = "event_time") -> DataFrame:
    return df.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))


def sessions(df: DataFrame, gap: str = "5 minutes", lateness: str = LATENESS, time: str = "event_time") -> DataFrame:
    """Spells of activity of a device; the space between two spells is its silence."""
    grouped = df.withWatermark(time, lateness).groupBy(F.session_window(time, gap).alias("s"), "DeviceId").agg(
        F.count("*").alias("readings"))
    return grouped.select(
        "DeviceId", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "readings")


def silence_alarms(df: DataFrame, window_seconds: int = 300, hold_seconds: int = 180, lateness: str = LATENESS,
                   time: str = "event_time") -> DataFrame:
    """One row per device and silence of at least window plus hold, out as soon as the watermark has passed it: the
    end of a spell of activity. Readings of other devices move the watermark on while one is silent."""
    quiet = window_seconds + hold_seconds
    spells = sessions(df, f"{quiet} seconds", lateness, time)
    return spells.select(
        "DeviceId", (F.col("session_end") - F.make_dt_interval(secs=F.lit(quiet))).alias("silent_from"),
        F.col("session_end").alias("alarm_at"))


# --- sinks ---------------------------------------------------------------------------------------------------

def _writer(df: DataFrame, checkpoint: str, every: str | None, mode: str = "append"):
    """One checkpoint per query. Without a period the query takes all that is there and ends."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def console(df: DataFrame, checkpoint: str, every: str | None = TRIGGER_BY_SINK["console"]) -> StreamingQuery:
    return _writer(df, checkpoint, every).format("console").start()


def raw_layer(df: DataFrame, path: str, checkpoint: str, every: str | None = TRIGGER_BY_SINK["raw"],
              time: str = "event_time") -> StreamingQuery:
    dated = with_date_parts(df, time)
    writer = _writer(dated, checkpoint, every).format("parquet").partitionBy(*DAY_PARTS)
    return writer.option("compression", CODEC_BY_LAYER["raw"]).start(path)


def alert_layer(df: DataFrame, path: str, checkpoint: str, every: str | None = TRIGGER_BY_SINK["alerts"]) -> StreamingQuery:
    return _writer(df, checkpoint, every).format("json").start(path)


def table_layer(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    return _writer(df, checkpoint, every).format("parquet").start(path)


def topic(df: DataFrame, servers: str, name: str, checkpoint: str, every: str | None = "10 seconds") -> StreamingQuery:
    writer = _writer(df, checkpoint, every).format("kafka").option("kafka.bootstrap.servers", servers)
    return writer.option("topic", name).start()


def each_batch(df: DataFrame, handler: Callable[[DataFrame, int, str], None], checkpoint: str,
               every: str | None = TRIGGER_BY_SINK["processed"], mode: str = "append") -> StreamingQuery:
    """Runs a handler (`FanOut`, `UpsertLog`) on every micro-batch; this is also where update mode belongs.

    The handler is told the id of the query, which Spark keeps in the checkpoint: the same after a restart, another for a new
    checkpoint."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        handler(batch, batch_id, batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"))

    return _writer(df, checkpoint, every, mode).foreachBatch(handle).start()


def to_end(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    return query


def until_read(query: StreamingQuery) -> None:
    """Lets a query with a timed trigger take all that is there, and stops it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def collected(df: DataFrame, root: str, spark: SparkSession) -> DataFrame:
    """Runs a stream over all available input and reads the result back as a table."""
    to_end(table_layer(df, f"{root}/out", f"{root}/checkpoint"))
    return spark.read.schema(df.schema).parquet(f"{root}/out")


END = "9999-01-01 00:00:00"


def collected_whole(df: DataFrame, transform: Callable[[DataFrame], DataFrame], root: str, time: str = "event_time") -> DataFrame:
    """As `collected`, for a transformation with windows, and with what is still open at the end of the input.

    A watermark never passes the newest row, so the last windows and sessions of a bounded run stay open. When all is read,
    one row of the far future is put beside the input and the query goes on from its checkpoint: the row closes everything
    before it and stays open itself. Input that comes after that would be late, so this is for runs that are over."""
    spark, end = df.sparkSession, f"{root}/end"
    spark.createDataFrame([], df.schema).write.parquet(end)
    closing = spark.readStream.schema(df.schema).parquet(end)
    out = transform(df.unionByName(closing))
    to_end(table_layer(out, f"{root}/out", f"{root}/checkpoint"))
    row = {f.name: F.lit(None).cast(f.dataType) for f in df.schema.fields} | {time: F.lit(END).cast(df.schema[time].dataType)}
    spark.range(1).select(*(c.alias(n) for n, c in row.items())).coalesce(1).write.mode("append").parquet(end)
    to_end(table_layer(out, f"{root}/out", f"{root}/checkpoint"))
    return spark.read.schema(out.schema).parquet(f"{root}/out")


# --- progress ------------------------------------------------------------------------------------------------

PROGRESS_SCHEMA = "batch_id bigint, input_rows bigint, rows_per_second double, duration_ms double, error_share double"


def observed(df: DataFrame, error: Column) -> DataFrame:
    """Adds the error share of every micro-batch to the progress reports of the query."""
    return df.observe(
        "rows", F.count(F.lit(1)).alias("rows"), F.avg(F.when(error, 1.0).otherwise(0.0)).alias("error_share"))


def _progress_row(progress) -> tuple:
    seen = (progress.observedMetrics or {}).get("rows")
    return (
        progress.batchId, progress.numInputRows, float(progress.processedRowsPerSecond or 0.0),
        float(progress.batchDuration or 0.0), seen["error_share"] if seen else None)


class ProgressTable:
    """Reports of one query, appended to a table as they come, so that none is lost however long it runs. Spark itself
    keeps the last hundred. `every` reports are written at a time; `close` writes the rest."""

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self.spark, self.path, self.every = spark, path, every
        self.waiting: list[tuple] = []
        self.listener = ProgressListener(self)

    def __call__(self, row: tuple) -> None:
        self.waiting.append(row)
        if len(self.waiting) >= self.every:
            self.flush()

    def flush(self) -> None:
        rows, self.waiting = self.waiting, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def __enter__(self) -> ProgressTable:
        self.spark.streams.addListener(self.listener)
        return self

    def __exit__(self, *_) -> None:
        """Reports come on a thread of their own: those of finished batches are waited for."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self.listener)
        self.flush()

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS_SCHEMA).parquet(self.path)


class ProgressListener(StreamingQueryListener):
    """Hands rate, delay and error share of each micro-batch of every query to `report`."""

    def __init__(self, report: Callable[[tuple], None]):
        self.report = report

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.report(_progress_row(event.progress))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
