"""Alert predicates, alert records and routing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorflow.functions.basic import any_of, as_col, present, rounded
from sensorflow.schema import (
    ALERT_STATUSES, CRITICAL_LIMITS, LOG_LEVEL_BY_SEVERITY, MOTORS, RETENTION_DAYS_BY_CLASS, SENSORS, STORE_BY_CLASS,
)


def needs_alert(status: Column | str = "sensor_status", failed: Column | str = "isFail") -> Column:
    return as_col(status).isin(*ALERT_STATUSES) | F.coalesce(as_col(failed), F.lit(False))


def consumer_alerts() -> Column:
    return present(
        F.when(any_of(F.col(s) > 90 for s in SENSORS), "HIGH_SENSOR_VALUE"),
        F.when(any_of(F.col(m) > 1500 for m in MOTORS), "HIGH_MOTOR_VALUE"),
        F.when(F.col("isFail"), "DEVICE_FAILURE"),
    )


def consumer_analysis() -> dict[str, Column]:
    first, second, third = map(F.col, SENSORS)
    speed1, speed2, speed3 = map(F.col, MOTORS)
    found = consumer_alerts()
    return {
        "sensor_average": rounded((first + second + third) / 3, 2),
        "motor_total": speed1 + speed2 + speed3,
        "alerts": found,
        "status": F.when(F.size(found) > 0, "CRITICAL").otherwise("NORMAL"),
    }


def threshold_alarms(quality: Column | str = "quality_score") -> Column:
    """Alarm names: the dashboard limits, the low-quality limit, and the two rules of the requirement list."""
    names = {"sensor1": "HIGH_TEMPERATURE", "sensor2": "HIGH_HUMIDITY", "sensor3": "HIGH_PRESSURE"}
    return present(
        *(F.when(F.col(s) > CRITICAL_LIMITS[s], F.lit(name)) for s, name in names.items()),
        F.when(as_col(quality) < 0.7, "LOW_QUALITY"),
        F.when(any_of(F.col(s) > 95 for s in SENSORS), "SENSOR_WARNING"),
        F.when(F.col("isFail"), "URGENT_FAILURE"),
    )


def alert_record(at: Column | str, device: Column | str = "DeviceId") -> Column:
    return F.struct(
        as_col(at).alias("alert_time"), as_col(device).alias("device_id"),
        F.col("sensor_status").alias("severity"), F.col("sensor_status"), F.col("motor_efficiency"),
        F.coalesce(F.col("isFail"), F.lit(False)).alias("is_fail"), F.struct(*SENSORS).alias("sensors"),
    )


def routing_severity(status: Column | str, failed: Column | str) -> Column:
    """Status labels in the words the router knows; a failed device is always critical."""
    status = as_col(status)
    return (
        F.when(F.coalesce(as_col(failed), F.lit(False)) | (status == "CRITICAL"), "CRITICAL")
        .when(status == "HIGH_WARNING", "WARNING")
        .otherwise("INFO")
    )


def channels(severity: Column | str) -> Column:
    severity = F.coalesce(as_col(severity), F.lit("INFO"))
    return (
        F.when(severity.isin("ERROR", "CRITICAL"), F.array(F.lit("email"), F.lit("chat")))
        .when(severity == "WARNING", F.array(F.lit("chat")))
        .otherwise(F.array(F.lit("log")))
    )


def alert_text(device: Column | str, message: Column | str) -> Column:
    return F.concat(
        F.lit("Device "), F.coalesce(as_col(device).cast("string"), F.lit("Unknown")), F.lit(": "),
        F.coalesce(as_col(message), F.lit("")),
    )


def log_level(severity: Column | str) -> Column:
    level = F.lit(None).cast("string")
    for name, value in LOG_LEVEL_BY_SEVERITY.items():
        level = F.when(F.lower(as_col(severity)) == name, F.lit(value)).otherwise(level)
    return level


def raises_alert(severity: Column | str) -> Column:
    return F.lower(as_col(severity)).isin("high", "critical")


def record_class(valid: Column, failed: Column | str = "isFail") -> Column:
    return (
        F.when(~F.coalesce(valid, F.lit(False)), "invalid")
        .when(F.coalesce(as_col(failed), F.lit(False)), "failed")
        .otherwise("normal")
    )


def _lookup(table: dict, key: Column, kind: str) -> Column:
    result = F.lit(None).cast(kind)
    for name, value in table.items():
        result = F.when(key == name, F.lit(value)).otherwise(result)
    return result


def storage_route(kind: Column) -> dict[str, Column]:
    return {
        "storage": _lookup(STORE_BY_CLASS, kind, "string"),
        "retention_days": _lookup(RETENTION_DAYS_BY_CLASS, kind, "int"),
        "alert_trigger": kind == "failed",
        "priority": F.when(kind == "failed", "HIGH"),
        "review_required": kind == "invalid",
    }
