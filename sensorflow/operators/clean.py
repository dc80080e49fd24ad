"""Cleaning and typing of readings (row-wise: no shuffle, works on streams)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.basic import computed_once, event_time
from sensorflow.functions.cleaning import (
    in_range_or_null, known_device, out_of_range, sentinel_to_null, text_to_flag, text_to_int, text_to_reading,
)
from sensorflow.functions.features import ratio_features, time_features
from sensorflow.functions.quality import nested_score, validity_flags
from sensorflow.schema import KEYS, MEASURES, MOTORS, SENSORS, THRESHOLD, THRESHOLD_ROWS


def reject_null_keys(df: DataFrame, keys=KEYS) -> DataFrame:
    return df.dropna(subset=list(keys))


def clean(df: DataFrame, time: str = "time", processed_at: Column | None = None, keep=()) -> DataFrame:
    """Typed time, each measure kept only inside its range, rows without device or time dropped."""
    return reject_null_keys(df, ("DeviceId", time)).select(
        *keep, "DeviceId", event_time(df, time).alias("event_time"),
        *(in_range_or_null(m).alias(f"{m}_clean") for m in MEASURES), "isFail",
        (F.current_timestamp() if processed_at is None else processed_at).alias("processed_at"),
    )


def clean_with_marks(df: DataFrame, time: str = "time", keep=()) -> DataFrame:
    """As `clean`, plus a mark on each value that was out of range; a missing failure flag is false."""
    return reject_null_keys(df, ("DeviceId", time)).select(
        *keep, "DeviceId", time, F.coalesce("isFail", F.lit(False)).alias("isFail"),
        *(in_range_or_null(m).alias(f"{m}_clean") for m in MEASURES),
        *(out_of_range(m).alias(f"{m}_outlier") for m in MEASURES),
    )


def coerce_types(df: DataFrame, keep=()) -> DataFrame:
    """Text fields to types. Unreadable time, device or value rejects the row; a missing value stays NULL; an
    unreadable failure flag becomes false."""
    typed = {
        "time": F.try_to_timestamp("time"),
        "DeviceId": F.col("DeviceId").try_cast("int"),
        **{s: text_to_reading(s) for s in SENSORS},
        **{m: text_to_int(m) for m in MOTORS},
    }
    readable = F.col("_time").isNotNull() & known_device("_DeviceId")
    for m in MEASURES:
        readable &= F.col(m).isNull() | F.col(f"_{m}").isNotNull()
    both = computed_once(df, {f"_{n}": c for n, c in typed.items()})
    return both.filter(readable).select(
        *keep, *(F.col(f"_{n}").alias(n) for n in typed), text_to_flag("isFail").alias("isFail"))


def only_known_devices(df: DataFrame) -> DataFrame:
    return df.filter(known_device())


def containing(df: DataFrame, keyword: str, column: str = "value") -> DataFrame:
    return df.filter(F.col(column).contains(keyword))


def with_validity(df: DataFrame) -> DataFrame:
    flags = validity_flags()
    valid = F.lit(True)
    for name in flags:
        valid &= F.col(name)
    return df.withColumns(flags).withColumn("is_valid_record", valid)


def fill_defaults(df: DataFrame) -> DataFrame:
    return df.fillna({**{m: 0 for m in MOTORS}, "isFail": False})


def drop_sentinels(df: DataFrame, columns=MEASURES, sentinel: float = -1) -> DataFrame:
    return df.withColumns({c: sentinel_to_null(c, sentinel) for c in columns})


def thresholds(spark) -> DataFrame:
    """The three-row sensor dimension."""
    return spark.createDataFrame(THRESHOLD_ROWS, THRESHOLD)


def check_thresholds(df: DataFrame, dimension: DataFrame, ids) -> DataFrame:
    """Sensors in long form with their limits from the dimension table. The table has one row per sensor name, a
    fixed handful, so it is broadcast."""
    long = df.unpivot(list(ids), list(SENSORS), "sensor_name", "value")
    return long.join(F.broadcast(dimension), "sensor_name").withColumn(
        "in_range", F.col("value").between(F.col("min_val"), F.col("max_val")))


def normalize_nested(df: DataFrame, min_score: float = 0.7) -> DataFrame:
    """Nested readings: score of three tests on the values as they came, then temperature outside 20-80 to NULL,
    whole-number efficiency, rows under the score dropped."""
    temperature = F.col("sensors.temperature")
    kept = F.when(temperature.between(20, 80), temperature)
    scored = (
        df.withColumn("quality_score", nested_score("sensors.temperature", "sensors.humidity", "sensors.vibration"))
        .withColumn("sensors", F.col("sensors").withField("temperature", kept))
        .withColumn("efficiency", F.col("efficiency").cast("int"))
    )
    return scored.filter(F.col("quality_score") >= min_score)


def with_time_features(df: DataFrame, time: str = "event_time") -> DataFrame:
    return df.withColumns(time_features(time))


def with_ratio_features(df: DataFrame) -> DataFrame:
    return df.withColumns(ratio_features(
        "sensors.temperature", "sensors.humidity", "efficiency", "sensors.power_consumption"))
