"""Status labels and scores of a reading, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorflow.functions.basic import any_null, as_col, count_true, present
from sensorflow.schema import (
    CRITICAL_LIMITS, MOTORS, RATED_RPM, SENSORS, STATUS_POINTS, UNKNOWN_STATUS_POINTS, WARNING_LIMITS, Z_LIMITS,
)


def sensor_status(sensors=SENSORS, critical=CRITICAL_LIMITS, warning=WARNING_LIMITS) -> Column:
    """Counts the sensors above their critical limit and those only above their warning limit."""
    values = dict(zip(SENSORS, map(as_col, sensors)))
    severe = count_true(v > critical[n] for n, v in values.items())
    mild = count_true((v > warning[n]) & (v <= critical[n]) for n, v in values.items())
    return (
        F.when(any_null(*values.values()), "DATA_MISSING")
        .when(severe >= 2, "CRITICAL")
        .when(severe >= 1, "HIGH_WARNING")
        .when(mild >= 2, "WARNING")
        .otherwise("NORMAL")
    )


def _of_rated(speed: Column, rated: float) -> Column:
    return F.when(speed <= rated, speed / rated).otherwise(F.lit(rated) / speed)


def _derating(value: Column, start: float, floor: float) -> Column:
    return F.when(value > start, F.greatest(F.lit(floor), 1.0 - (value - start) / 100)).otherwise(1.0)


def motor_efficiency(motors=MOTORS, temperature="sensor1", humidity="sensor2") -> Column:
    speeds = dict(zip(MOTORS, map(as_col, motors)))
    temperature, humidity = as_col(temperature), as_col(humidity)
    first, second, third = (_of_rated(s, RATED_RPM[n]) for n, s in speeds.items())
    value = (first + second + third) / 3.0 * _derating(temperature, 70, 0.5) * _derating(humidity, 60, 0.7)
    return (
        F.when(any_null(*speeds.values(), temperature, humidity), 0.0)
        .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), value)))
    )


def equipment_risk(status, efficiency, failure_rate) -> Column:
    """Struct of level, score and the list of reasons. The points are added in a fixed order, since the level
    limits are compared with sums of doubles."""
    status, efficiency, failure_rate = map(as_col, (status, efficiency, failure_rate))
    status_points = F.lit(UNKNOWN_STATUS_POINTS)
    for label, points in STATUS_POINTS.items():
        status_points = F.when(status == label, points).otherwise(status_points)
    efficiency_points = F.when(efficiency < 0.3, 0.3).when(efficiency < 0.6, 0.15).otherwise(0.0)
    failure_points = F.when(failure_rate > 0.5, 0.4).when(failure_rate > 0.2, 0.2).otherwise(0.0)
    score = F.least(F.lit(1.0), status_points + efficiency_points + failure_points)
    level = (
        F.when(score >= 0.8, "CRITICAL").when(score >= 0.6, "HIGH").when(score >= 0.4, "MEDIUM")
        .when(score >= 0.2, "LOW").otherwise("MINIMAL")
    )
    reasons = present(
        F.when(status_points > 0.2, F.concat(F.lit("sensor_status_"), F.lower(status))),
        F.when(efficiency < 0.3, "low_motor_efficiency").when(efficiency < 0.6, "reduced_motor_efficiency"),
        F.when(failure_rate > 0.5, "high_failure_rate").when(failure_rate > 0.2, "elevated_failure_rate"),
    )
    return F.struct(level.alias("risk_level"), score.alias("risk_score"), reasons.alias("risk_factors"))


def outlier_score(z_scores: dict[str, Column]) -> Column:
    """Largest z-score as a share of twice its limit, at most 1; a sensor without a z-score adds nothing."""
    # `least` skips NULL and would make a missing z-score the highest one, so NULL is replaced first.
    parts = [
        F.least(F.lit(1.0), F.coalesce(F.abs(z), F.lit(0.0)) / (2 * Z_LIMITS[name])) for name, z in z_scores.items()
    ]
    return F.greatest(*parts, F.lit(0.0))


def equipment_status(temperature, vibration, efficiency) -> Column:
    t, v, e = map(as_col, (temperature, vibration, efficiency))
    return (
        F.when((t > 70) | (v > 2.5) | (e < 60), "CRITICAL")
        .when((t > 60) | (v > 2.0) | (e < 70), "WARNING")
        .when((t > 50) | (v > 1.5) | (e < 80), "CAUTION")
        .otherwise("NORMAL")
    )


def anomaly_score(temperature, humidity, vibration, efficiency) -> Column:
    t, h, v, e = map(as_col, (temperature, humidity, vibration, efficiency))
    score = (
        F.abs(t - 50) / 30 + F.abs(h - 60) / 40
        + F.greatest(F.lit(0.0), v - 1.0) / 2.0 + F.greatest(F.lit(0.0), 85 - e) / 30
    )
    return F.when(~any_null(t, h, v, e), score)


def maintenance_need(temperature, vibration, efficiency) -> Column:
    """Struct of score, level and action; NULL when an input is NULL. The efficiency part may exceed its weight."""
    t, v, e = map(as_col, (temperature, vibration, efficiency))
    score = (
        F.least(t / 80, F.lit(1.0)) * 0.3
        + F.least(v / 3.0, F.lit(1.0)) * 0.4
        + F.greatest(F.lit(0.0), (90 - e) / 30) * 0.3
    )
    level = F.when(score > 0.8, "HIGH").when(score > 0.6, "MEDIUM").when(score > 0.4, "LOW").otherwise("NORMAL")
    action = (
        F.when(score > 0.8, "IMMEDIATE_MAINTENANCE").when(score > 0.6, "SCHEDULE_MAINTENANCE")
        .when(score > 0.4, "MONITOR_CLOSELY").otherwise("ROUTINE_CHECK")
    )
    result = F.struct(
        score.alias("maintenance_score"), level.alias("risk_level"), action.alias("recommended_action")
    )
    return F.when(~any_null(t, v, e), result)
