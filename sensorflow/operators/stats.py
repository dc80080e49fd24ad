"""Device, time and run statistics. All are aggregates with a map-side part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorflow.functions.basic import band, share
from sensorflow.operators.quantiles import percentile
from sensorflow.schema import MOTORS, SENSORS


def hourly_statistics(df: DataFrame, suffix: str = "_clean", time: str = "event_time") -> DataFrame:
    """Per device, date and hour: spread of the sensors, range of the motors, counts of rows, failures and gaps."""
    def summary(name: str, deviation: bool) -> list[Column]:
        value = F.col(name + suffix)
        made = [F.avg(value).alias(f"{name}_avg"), F.min(value).alias(f"{name}_min"),
                F.max(value).alias(f"{name}_max")]
        return made + ([F.stddev_samp(value).alias(f"{name}_stddev")] if deviation else [])

    return df.groupBy("DeviceId", F.to_date(time).alias("date"), F.hour(time).alias("hour")).agg(
        *(c for s in SENSORS for c in summary(s, True)),
        *(c for m in MOTORS for c in summary(m, False)),
        F.count("*").alias("record_count"),
        F.count_if("isFail").alias("failure_count"),
        F.count_if(F.col(f"sensor1{suffix}").isNull()).alias("sensor1_null_count"),
        F.count_if(F.col(f"motor1{suffix}").isNull()).alias("motor1_null_count"),
    )


def latency_statistics(df: DataFrame, latency: Column) -> DataFrame:
    """Mean, inclusive 95th percentile and maximum of the latency in seconds."""
    measured = df.select(latency.cast("double").alias("latency"))
    p95 = percentile(measured, ["latency"], 0.95, interpolate=True, suffix="_p95")
    summary = measured.agg(
        F.avg("latency").alias("mean_latency"), F.max("latency").alias("max_latency"),
        F.count("latency").alias("messages"))
    # Two tables of one row each.
    one = F.lit(1).alias("_one")
    joined = summary.select("*", one).join(p95.select("*", one), "_one", "left")
    return joined.select("mean_latency", F.col("latency_p95").alias("p95_latency"), "max_latency", "messages")


def latency_status(df: DataFrame, latency: Column, limit: float = 60, keep=()) -> DataFrame:
    status = F.when(F.col("latency_seconds") < limit, "PASS").otherwise("WARN")
    return df.select(*keep, latency.alias("latency_seconds")).withColumn("status", status)


def rate_per_window(df: DataFrame, seconds: int = 30, time: str = "event_time", keys=()) -> DataFrame:
    """Messages and messages per second of each tumbling time window."""
    grouped = df.groupBy(F.window(time, f"{seconds} seconds").alias("w"), *keys).agg(F.count("*").alias("messages"))
    return grouped.select(
        F.col("w.start").alias("window_start"), *keys, "messages",
        (F.col("messages") / F.lit(float(seconds))).alias("messages_per_second"))


def run_summary(df: DataFrame, success: Column) -> DataFrame:
    good = F.count_if(success)
    return df.agg(
        F.count("*").alias("total"), good.alias("successful"), (F.count("*") - good).alias("failed"),
        F.coalesce(F.try_divide(good * F.lit(100.0), F.count("*")), F.lit(0.0)).alias("success_rate"))


def count_words(df: DataFrame, text: str = "text") -> DataFrame:
    """Occurrences of every space-separated word; map-side counts keep frequent words off the network."""
    return df.select(F.explode(F.split(text, " ")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def rows_per_partition(df: DataFrame) -> DataFrame:
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))


def doubled_above(df: DataFrame, column: str = "id", limit: int = 100) -> DataFrame:
    doubled = F.col(column) * 2
    return df.select(doubled.alias("doubled")).filter(F.col("doubled") > limit).agg(F.count("*").alias("n"))


def trend(df: DataFrame, unit: str, value: str, time: str = "event_time") -> DataFrame:
    """Mean of a measure and failures per calendar unit and device, with the change to the unit before. The window
    runs over the aggregate: one row per device and unit."""
    start = F.date_trunc(unit, F.col(time).cast("timestamp"))
    grouped = df.groupBy("DeviceId", start.alias("period")).agg(
        F.count("*").alias("readings"), F.avg(value).alias("mean_value"), F.count_if("isFail").alias("failures"))
    before = F.lag("mean_value").over(W.partitionBy("DeviceId").orderBy("period"))
    return grouped.withColumn("change", F.col("mean_value") - before)


def failure_share(df: DataFrame) -> DataFrame:
    return df.groupBy("DeviceId").agg(
        F.count("*").alias("readings"), F.count_if("isFail").alias("failures"),
        F.avg(F.col("isFail").cast("int").cast("double")).alias("failure_rate"))


def device_overview(df: DataFrame, time: str = "event_time") -> DataFrame:
    grouped = df.groupBy("DeviceId").agg(F.count("*").alias("samples"), F.max(time).alias("last_seen"))
    return grouped.withColumn("color", band(F.col("samples"), [(1, "yellow"), (2, "green")], "red"))


def quality_gauge(df: DataFrame, score: Column) -> DataFrame:
    return df.agg((F.avg(score) * 100).alias("quality_percent")).withColumn(
        "color", band(F.col("quality_percent"), [(70, "yellow"), (90, "green")], "red"))


def error_band(df: DataFrame, error: Column, delay: Column, seconds: int = 300, time: str = "event_time") -> DataFrame:
    """Error rate and longest delay per window, with the alarm band of the worse of the two."""
    grouped = df.groupBy(F.window(time, f"{seconds} seconds").alias("w")).agg(
        (share(error) * 100).alias("error_percent"), F.max(delay).alias("max_delay"))
    level = (
        F.when((F.col("error_percent") > 10) | (F.col("max_delay") > 60), "CRITICAL")
        .when((F.col("error_percent") > 5) | (F.col("max_delay") > 30), "WARNING").otherwise("INFO"))
    return grouped.select(F.col("w.start").alias("window_start"), "error_percent", "max_delay", level.alias("band"))


def failure_band(df: DataFrame, seconds: int = 300, time: str = "event_time") -> DataFrame:
    grouped = df.groupBy(F.window(time, f"{seconds} seconds").alias("w")).agg(
        (share(F.col("isFail")) * 100).alias("failure_percent"))
    color = band(F.col("failure_percent"), [(5, "yellow"), (10, "red")], "green")
    return grouped.select(F.col("w.start").alias("window_start"), "failure_percent", color.alias("color"))


def alert_history(alerts: DataFrame, unit: str = "day", time: str = "alert_time") -> DataFrame:
    """Alerts per calendar unit, device and severity."""
    start = F.date_trunc(unit, F.col(time).cast("timestamp"))
    return alerts.groupBy("device_id", "severity", start.alias("period")).agg(
        F.count("*").alias("alerts"), F.count_if("is_fail").alias("failures"))
