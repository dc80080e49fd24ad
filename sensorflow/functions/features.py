"""Calendar, ratio and text features, and partition columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorflow.functions.basic import as_col


def time_features(time: Column | str) -> dict[str, Column]:
    time = as_col(time)
    weekday = F.dayofweek(time)
    return {
        "hour": F.hour(time),
        "day_of_week": weekday,
        "is_weekend": F.when(weekday.isin(1, 7), 1).otherwise(0),
    }


def ratio_features(temperature, humidity, efficiency, power) -> dict[str, Column]:
    return {
        "temp_humidity_ratio": F.try_divide(as_col(temperature), as_col(humidity)),
        "efficiency_power_ratio": F.try_divide(as_col(efficiency), as_col(power)),
    }


def date_parts(time: Column | str) -> dict[str, Column]:
    time = as_col(time)
    return {"year": F.year(time), "month": F.month(time), "day": F.dayofmonth(time), "hour": F.hour(time)}


def word_count(text: Column | str) -> Column:
    return F.size(F.split(as_col(text), " "))
