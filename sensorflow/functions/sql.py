"""The scalar functions under SQL names, as SQL-defined functions (no UDF at run time)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from sensorflow.schema import (
    CRITICAL_LIMITS, RANGES, RATED_RPM, SENSORS, STATUS_POINTS, UNKNOWN_STATUS_POINTS, WARNING_LIMITS, Z_LIMITS,
)


def _status() -> str:
    severe = " + ".join(f"int({s} > {CRITICAL_LIMITS[s]}D)" for s in SENSORS)
    mild = " + ".join(f"int({s} > {WARNING_LIMITS[s]}D AND {s} <= {CRITICAL_LIMITS[s]}D)" for s in SENSORS)
    unknown = " OR ".join(f"{s} IS NULL" for s in SENSORS)
    return (
        f"CASE WHEN {unknown} THEN 'DATA_MISSING' WHEN {severe} >= 2 THEN 'CRITICAL' "
        f"WHEN {severe} >= 1 THEN 'HIGH_WARNING' WHEN {mild} >= 2 THEN 'WARNING' ELSE 'NORMAL' END"
    )


def _efficiency() -> str:
    speeds = " + ".join(f"CASE WHEN {m} <= {r}D THEN {m} / {r}D ELSE {r}D / {m} END" for m, r in RATED_RPM.items())
    heat = "CASE WHEN sensor1 > 70 THEN greatest(0.5D, 1 - (sensor1 - 70) / 100) ELSE 1D END"
    damp = "CASE WHEN sensor2 > 60 THEN greatest(0.7D, 1 - (sensor2 - 60) / 100) ELSE 1D END"
    unknown = " OR ".join(f"{c} IS NULL" for c in (*RATED_RPM, "sensor1", "sensor2"))
    return f"CASE WHEN {unknown} THEN 0D ELSE least(1D, greatest(0D, ({speeds}) / 3 * {heat} * {damp})) END"


def _range_score() -> str:
    tests = " AND ".join(f"{s} BETWEEN {RANGES[s][0]} AND {RANGES[s][1]}" for s in SENSORS)
    return f"CASE WHEN {tests} THEN 1D ELSE 0D END"


def _outlier_score() -> str:
    parts = ", ".join(f"least(1D, coalesce(abs({s}_z), 0D) / {2 * Z_LIMITS[s]}D)" for s in SENSORS)
    return f"greatest({parts})"


def _risk() -> str:
    labels = " ".join(f"WHEN '{label}' THEN {points}D" for label, points in STATUS_POINTS.items())
    status = f"CASE status {labels} ELSE {UNKNOWN_STATUS_POINTS}D END"
    efficiency = "CASE WHEN efficiency < 0.3D THEN 0.3D WHEN efficiency < 0.6D THEN 0.15D ELSE 0D END"
    failures = "CASE WHEN failure_rate > 0.5D THEN 0.4D WHEN failure_rate > 0.2D THEN 0.2D ELSE 0D END"
    score = f"least(1D, {status} + {efficiency} + {failures})"
    level = (
        f"CASE WHEN {score} >= 0.8D THEN 'CRITICAL' WHEN {score} >= 0.6D THEN 'HIGH' WHEN {score} >= 0.4D THEN 'MEDIUM' "
        f"WHEN {score} >= 0.2D THEN 'LOW' ELSE 'MINIMAL' END")
    reasons = (
        f"array_compact(array(CASE WHEN {status} > 0.2D THEN concat('sensor_status_', lower(status)) END, "
        "CASE WHEN efficiency < 0.3D THEN 'low_motor_efficiency' WHEN efficiency < 0.6D THEN 'reduced_motor_efficiency' END, "
        "CASE WHEN failure_rate > 0.5D THEN 'high_failure_rate' WHEN failure_rate > 0.2D THEN 'elevated_failure_rate' END))")
    return f"named_struct('risk_level', {level}, 'risk_score', {score}, 'risk_factors', {reasons})"


def _equipment_status() -> str:
    return (
        "CASE WHEN temperature > 70 OR vibration > 2.5D OR efficiency < 60 THEN 'CRITICAL' WHEN temperature > 60 OR vibration > 2D OR "
        "efficiency < 70 THEN 'WARNING' WHEN temperature > 50 OR vibration > 1.5D OR efficiency < 80 THEN 'CAUTION' ELSE 'NORMAL' END")


def _anomaly_score() -> str:
    known = "temperature IS NOT NULL AND humidity IS NOT NULL AND vibration IS NOT NULL AND efficiency IS NOT NULL"
    return (
        f"CASE WHEN {known} THEN abs(temperature - 50) / 30 + abs(humidity - 60) / 40 + greatest(0D, vibration - 1) / 2 "
        "+ greatest(0D, 85 - efficiency) / 30 END")


def _maintenance() -> str:
    known = "temperature IS NOT NULL AND vibration IS NOT NULL AND efficiency IS NOT NULL"
    score = "(least(temperature / 80, 1D) * 0.3D + least(vibration / 3, 1D) * 0.4D + greatest(0D, (90 - efficiency) / 30) * 0.3D)"
    level = f"CASE WHEN {score} > 0.8D THEN 'HIGH' WHEN {score} > 0.6D THEN 'MEDIUM' WHEN {score} > 0.4D THEN 'LOW' ELSE 'NORMAL' END"
    action = (
        f"CASE WHEN {score} > 0.8D THEN 'IMMEDIATE_MAINTENANCE' WHEN {score} > 0.6D THEN 'SCHEDULE_MAINTENANCE' "
        f"WHEN {score} > 0.4D THEN 'MONITOR_CLOSELY' ELSE 'ROUTINE_CHECK' END")
    return f"CASE WHEN {known} THEN named_struct('maintenance_score', {score}, 'risk_level', {level}, 'recommended_action', {action}) END"


RISK = "STRUCT<risk_level: STRING, risk_score: DOUBLE, risk_factors: ARRAY<STRING>>"
NEED = "STRUCT<maintenance_score: DOUBLE, risk_level: STRING, recommended_action: STRING>"


def register_functions(spark: SparkSession) -> None:
    """The functions under the names and with the arguments that existing SQL calls them by. The risk takes the device and
    an outlier score as well, the maintenance need the hours of operation; neither enters the result."""
    sensors = "sensor1 DOUBLE, sensor2 DOUBLE, sensor3 DOUBLE"
    motors = "motor1 DOUBLE, motor2 DOUBLE, motor3 DOUBLE, sensor1 DOUBLE, sensor2 DOUBLE"
    nested = "temperature DOUBLE, humidity DOUBLE, vibration DOUBLE, efficiency DOUBLE"
    for name, arguments, result, body in (
        ("classify_sensor_status", sensors, "STRING", _status()),
        ("calculate_motor_efficiency", motors, "DOUBLE", _efficiency()),
        ("calculate_quality_score", sensors, "DOUBLE", _range_score()),
        ("calculate_outlier_score", "sensor1_z DOUBLE, sensor2_z DOUBLE, sensor3_z DOUBLE", "DOUBLE", _outlier_score()),
        ("assess_equipment_risk", "device BIGINT, status STRING, efficiency DOUBLE, failure_rate DOUBLE, outlier_score DOUBLE", RISK, _risk()),
        ("classify_equipment_status", "temperature DOUBLE, vibration DOUBLE, efficiency DOUBLE", "STRING", _equipment_status()),
        ("calculate_anomaly_score", nested, "DOUBLE", _anomaly_score()),
        ("predict_maintenance_need", "temperature DOUBLE, vibration DOUBLE, efficiency DOUBLE, hours DOUBLE", NEED, _maintenance()),
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
