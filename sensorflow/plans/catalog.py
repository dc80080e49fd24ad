"""Registry of queries. Each one reads the given tables and names the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.basic import rounded
from sensorflow.session import SETTINGS
from sensorflow.sources.tables import Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", SETTINGS["spark.sql.session.timeZone"])
    return tidy(QUERIES[name](Tables(spark, folder)))


def tidy(df: DataFrame) -> DataFrame:
    """Result columns in comparable form: doubles to 6 places, times without zone, lists as text."""
    made = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "double":
            c = rounded(c, 6)
        elif kind == "timestamp":
            c = c.cast("timestamp_ntz")
        elif kind == "date":
            c = c.cast("string")
        elif kind == "array<string>":
            c = F.array_join(c, "|")
        made.append(c.alias(name))
    return df.select(*made)


# Common parts of the SQL side, put in front of a statement that names them.
_PARTS = {
    "readings": """
SELECT event_id, ts AS event_time,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(user_id % 6 AS INT) END AS DeviceId,
  CASE WHEN k % 33 = 7 THEN NULL WHEN k = 3 THEN -1.0::DOUBLE WHEN event_id % 211 = 5 THEN 5.0::DOUBLE
       ELSE 62.0::DOUBLE + (event_id * 7 % 400) / 10.0::DOUBLE END AS sensor1,
  CASE WHEN k % 33 = 8 THEN NULL WHEN k = 4 THEN -1.0::DOUBLE WHEN event_id % 223 = 5 THEN 3.0::DOUBLE
       ELSE 55.0::DOUBLE + (event_id * 11 % 480) / 10.0::DOUBLE END AS sensor2,
  CASE WHEN k % 33 = 9 THEN NULL WHEN k = 5 THEN -1.0::DOUBLE WHEN event_id % 227 = 5 THEN 2.0::DOUBLE
       ELSE 85.0::DOUBLE + (event_id * 13 % 700) / 10.0::DOUBLE END AS sensor3,
  CASE WHEN k = 10 THEN NULL ELSE CAST(150 + (event_id * 17 % 1900) AS INT) END AS motor1,
  CASE WHEN k = 11 THEN NULL ELSE CAST(100 + (event_id * 19 % 1450) AS INT) END AS motor2,
  CASE WHEN k = 12 THEN NULL ELSE CAST(100 + (event_id * 23 % 1750) AS INT) END AS motor3,
  CASE WHEN k = 13 THEN NULL ELSE event_type = 'error' END AS isFail, k, user_id
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""",
    "cleaned": """
SELECT event_id, DeviceId, event_time,
  CASE WHEN sensor1 BETWEEN 0 AND 100 THEN sensor1 END AS sensor1_clean,
  CASE WHEN sensor2 BETWEEN 0 AND 100 THEN sensor2 END AS sensor2_clean,
  CASE WHEN sensor3 BETWEEN 0 AND 150 THEN sensor3 END AS sensor3_clean,
  CASE WHEN motor1 BETWEEN 0 AND 2000 THEN motor1 END AS motor1_clean,
  CASE WHEN motor2 BETWEEN 0 AND 1500 THEN motor2 END AS motor2_clean,
  CASE WHEN motor3 BETWEEN 0 AND 1800 THEN motor3 END AS motor3_clean, isFail
FROM readings WHERE DeviceId IS NOT NULL""",
    "nested": """
SELECT event_id, DeviceId AS device_id, 'L' || (user_id % 4) AS location, event_time AS "timestamp",
  CAST(30 + k % 75 AS DOUBLE) AS efficiency, sensor1 AS temperature, sensor2 AS humidity,
  k / 30.0::DOUBLE AS vibration, CAST(motor1 AS DOUBLE) AS power
FROM readings""",
    "status": """
SELECT *, CASE WHEN sensor1 IS NULL OR sensor2 IS NULL OR sensor3 IS NULL THEN 'DATA_MISSING'
    WHEN severe >= 2 THEN 'CRITICAL' WHEN severe = 1 THEN 'HIGH_WARNING'
    WHEN mild >= 2 THEN 'WARNING' ELSE 'NORMAL' END AS sensor_status
FROM (SELECT *, (sensor1 > 90)::INT + (sensor2 > 85)::INT + (sensor3 > 130)::INT AS severe,
    (sensor1 > 81 AND sensor1 <= 90)::INT + (sensor2 > 76.5 AND sensor2 <= 85)::INT
      + (sensor3 > 117 AND sensor3 <= 130)::INT AS mild FROM readings)""",
    "status76": """
SELECT *, CASE WHEN sensor1 IS NULL OR sensor2 IS NULL OR sensor3 IS NULL THEN 'DATA_MISSING'
    WHEN severe >= 2 THEN 'CRITICAL' WHEN severe = 1 THEN 'HIGH_WARNING'
    WHEN mild >= 2 THEN 'WARNING' ELSE 'NORMAL' END AS sensor_status
FROM (SELECT *, (sensor1 > 90)::INT + (sensor2 > 85)::INT + (sensor3 > 130)::INT AS severe,
    (sensor1 > 81 AND sensor1 <= 90)::INT + (sensor2 > 76 AND sensor2 <= 85)::INT
      + (sensor3 > 117 AND sensor3 <= 130)::INT AS mild FROM readings)""",
    "efficiency": """
SELECT event_id, CASE WHEN motor1 IS NULL OR motor2 IS NULL OR motor3 IS NULL OR sensor1 IS NULL OR sensor2 IS NULL
    THEN 0.0::DOUBLE ELSE least(1.0::DOUBLE, greatest(0.0::DOUBLE,
      ((CASE WHEN motor1 <= 2000 THEN motor1 / 2000.0::DOUBLE ELSE 2000.0::DOUBLE / motor1 END)
     + (CASE WHEN motor2 <= 1500 THEN motor2 / 1500.0::DOUBLE ELSE 1500.0::DOUBLE / motor2 END)
     + (CASE WHEN motor3 <= 1800 THEN motor3 / 1800.0::DOUBLE ELSE 1800.0::DOUBLE / motor3 END)) / 3.0::DOUBLE
     * (CASE WHEN sensor1 > 70 THEN greatest(0.5::DOUBLE, 1.0::DOUBLE - (sensor1 - 70) / 100) ELSE 1.0::DOUBLE END)
     * (CASE WHEN sensor2 > 60 THEN greatest(0.7::DOUBLE, 1.0::DOUBLE - (sensor2 - 60) / 100) ELSE 1.0::DOUBLE END)
    )) END AS motor_efficiency FROM readings""",
    "base": """
SELECT DeviceId, quantile_disc(sensor1_clean, 0.95) AS sensor1_p95, quantile_disc(sensor2_clean, 0.95) AS sensor2_p95,
  quantile_disc(sensor3_clean, 0.95) AS sensor3_p95, avg(sensor1_clean) AS sensor1_mean,
  avg(sensor2_clean) AS sensor2_mean, avg(sensor3_clean) AS sensor3_mean, stddev_samp(sensor1_clean) AS sensor1_std,
  stddev_samp(sensor2_clean) AS sensor2_std, stddev_samp(sensor3_clean) AS sensor3_std
FROM cleaned GROUP BY DeviceId""",
    "loose": """
SELECT event_id,
  CASE WHEN event_id % 41 = 0 THEN 'yesterday' ELSE strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') END AS "time",
  CASE WHEN event_id % 53 = 0 THEN 'dev-' || DeviceId ELSE CAST(DeviceId AS VARCHAR) END AS DeviceId,
  CASE WHEN event_id % 43 = 0 THEN 'n/a' ELSE CAST(sensor1 AS VARCHAR) END AS sensor1,
  CAST(sensor2 AS VARCHAR) AS sensor2, CAST(sensor3 AS VARCHAR) AS sensor3,
  CASE WHEN event_id % 47 = 0 THEN 'fast' WHEN event_id % 5 = 0 THEN motor1 || '.4'
    ELSE CAST(motor1 AS VARCHAR) END AS motor1,
  CAST(motor2 AS VARCHAR) AS motor2, CAST(motor3 AS VARCHAR) AS motor3,
  CASE WHEN event_id % 59 = 0 THEN 'maybe' ELSE CAST(isFail AS VARCHAR) END AS isFail
FROM readings""",
}
_NEEDS = {"cleaned": ["readings"], "nested": ["readings"], "status": ["readings"], "status76": ["readings"],
          "efficiency": ["readings"], "base": ["readings", "cleaned"], "loose": ["readings"]}


def _rounded(sql: str) -> str:
    """Writes `round(x, n)` the way `rounded` works: from 12 places, half up."""
    at = sql.find("round(")
    if at < 0:
        return sql
    depth, cut = 0, None
    for i in range(at + 5, len(sql)):
        depth += {"(": 1, ")": -1}.get(sql[i], 0)
        if sql[i] == "," and depth == 1:
            cut = i
        if depth == 0:
            break
    if cut is None or not sql[cut + 1:i].strip().isdigit():
        return sql[:at + 6] + _rounded(sql[at + 6:])
    inner, places = _rounded(sql[at + 6:cut]), sql[cut + 1:i].strip()
    return f"{sql[:at]}CAST(round(CAST({inner} AS DECIMAL(38, 12)), {places}) AS DOUBLE){_rounded(sql[i + 1:])}"


def oracle(name: str) -> str:
    sql = _rounded(ORACLES[name].strip())
    wanted = {p for p in _PARTS if re.search(rf"\b(FROM|JOIN)\s+{p}\b", sql)}
    for part in list(wanted):
        wanted.update(_NEEDS.get(part, []))
    if not wanted:
        return sql
    parts = ",\n".join(f"{p} AS ({_PARTS[p]})" for p in _PARTS if p in wanted)
    if sql.upper().startswith("WITH "):
        return f"WITH {parts},\n{sql[5:]}"
    return f"WITH {parts}\n{sql}"
