"""The end-to-end jobs: messages to layers (live), and a raw layer to its reports (batch)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorflow.functions.basic import event_time
from sensorflow.operators import anomaly, clean, quality, stats
from sensorflow.sinks.layers import DAY_PARTS, FanOut, with_date_parts, write_layer, write_report
from sensorflow.sources import topics
from sensorflow.streaming import jobs


def live(messages: DataFrame, root: str, every: str | None = "1 minute") -> list[StreamingQuery]:
    """Decoded readings to the four layers, and text that is no reading to the quarantine; one checkpoint each. The
    processed layer is a log by device and time: read it with `FanOut.processed().read`, fold it with `compact`."""
    decoded = topics.decode(topics.envelope(messages))
    readings = topics.well_formed(decoded)
    readings = readings.withColumn("event_time", event_time(readings, "time")).drop("time")
    fan = FanOut(f"{root}/layers", keys=("DeviceId", "event_time"), order=("processed_at",))
    layers = jobs.each_batch(readings, fan, f"{root}/checkpoints/layers", every)
    bad = topics.malformed(decoded).select(topics.CORRUPT)
    quarantine = jobs.table_layer(bad, f"{root}/quarantine", f"{root}/checkpoints/quarantine", every)
    return [layers, quarantine]


def batch(spark: SparkSession, raw: str, target: str, *days: Column) -> None:
    """Cleans a raw layer (or the days the conditions name) and writes statistics, outliers and the quality report.
    The cleaned rows are written once and read back by every step, so nothing is computed twice and a lost executor
    costs no more than its own tasks."""
    rows = spark.read.parquet(raw)
    for condition in days:
        rows = rows.filter(condition)
    cleaned = with_date_parts(clean.clean(rows, "event_time"))
    write_layer(cleaned, f"{target}/cleaned", DAY_PARTS, codec="snappy")
    cleaned = spark.read.schema(cleaned.schema).parquet(f"{target}/cleaned")
    write_layer(stats.hourly_statistics(cleaned), f"{target}/hourly")
    write_layer(anomaly.anomalies(cleaned), f"{target}/anomalies", DAY_PARTS)
    report = quality.quality_report(rows.withColumn("time", F.col("event_time")))
    write_report(report, f"{target}/report")
