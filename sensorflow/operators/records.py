"""Whole-record pipelines: transform, alert, route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.alerts import alert_record, needs_alert, record_class, storage_route
from sensorflow.functions.basic import rounded
from sensorflow.functions.quality import is_valid_record, presence_score, record_quality
from sensorflow.functions.scoring import motor_efficiency, sensor_status
from sensorflow.operators.clean import clean_with_marks, reject_null_keys
from sensorflow.schema import KEYS, MEASURES, MOTORS, SENSORS, WARNING_LIMITS_76


def transform(df: DataFrame, processed_at: Column | None = None, time: str = "time", keep=()) -> DataFrame:
    """Cleaning, status, efficiency and record quality in one projection. Quality judges the raw values, status and
    efficiency the cleaned ones."""
    fields = [time if f == "time" else f for f in ("time", "DeviceId") + MEASURES + ("isFail",)]
    judged = df.withColumn("_quality", record_quality(fields))
    cleaned = clean_with_marks(judged, time, keep=(*keep, "_quality"))
    return cleaned.withColumns({
        "sensor_status": sensor_status([f"{s}_clean" for s in SENSORS]),
        "motor_efficiency": rounded(
            motor_efficiency([f"{m}_clean" for m in MOTORS], "sensor1_clean", "sensor2_clean"), 4),
        "quality_score": rounded("_quality.quality_score", 4),
        "quality_grade": F.col("_quality.grade"),
        "quality_issues": F.col("_quality.issues"),
        "processed_at": F.current_timestamp() if processed_at is None else processed_at,
    }).drop("_quality")


def process(df: DataFrame, processed_at: Column | None = None, time: str = "time") -> DataFrame:
    """The live variant: raw values kept, humidity warning from 76, score by presence of the six measures."""
    return reject_null_keys(df, [time if k == "time" else k for k in KEYS]).withColumns({
        "isFail": F.coalesce("isFail", F.lit(False)),
        "sensor_status": sensor_status(warning=WARNING_LIMITS_76),
        "motor_efficiency": motor_efficiency(),
        "quality_score": presence_score(),
        "processed_at": F.current_timestamp() if processed_at is None else processed_at,
    })


def alerts(processed: DataFrame, at: Column | str = "processed_at", keep=()) -> DataFrame:
    return processed.filter(needs_alert()).select(*keep, alert_record(at).alias("_alert")).select(*keep, "_alert.*")


def quality_metrics(processed: DataFrame, keep=()) -> DataFrame:
    return processed.select(
        *keep, F.col("processed_at").alias("timestamp"), F.col("DeviceId").alias("device_id"),
        "quality_score", "sensor_status", "motor_efficiency")


def routed(df: DataFrame, valid: Column | None = None) -> DataFrame:
    """Storage class of every record: invalid goes to quarantine, failed to the alert store, the rest to main."""
    complete = F.col("DeviceId").isNotNull()
    kind = record_class(complete & is_valid_record() if valid is None else valid)
    return df.withColumn("record_class", kind).withColumns(storage_route(F.col("record_class")))


def expired(df: DataFrame, as_of: Column, days: Column, time: str = "event_time") -> DataFrame:
    return df.filter(F.to_date(time) < F.date_sub(as_of, days))


def retained(df: DataFrame, as_of: Column, days: Column, time: str = "event_time") -> DataFrame:
    """Rows without a time have no age: they are kept, as nothing says that they are too old."""
    return df.filter(F.col(time).isNull() | (F.to_date(time) >= F.date_sub(as_of, days)))
