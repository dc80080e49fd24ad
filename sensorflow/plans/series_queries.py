"""Queries over time series, outliers, scores and alerts."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorflow.functions import alerts as A
from sensorflow.functions import scoring
from sensorflow.functions.quality import presence_score
from sensorflow.functions.sql import register_functions
from sensorflow.operators import anomaly, joins, records, stats, windows
from sensorflow.operators.timeline import HOUR
from sensorflow.plans.catalog import query
from sensorflow.plans.report_queries import _PRESENT, RECORD_QUALITY_SQL, cleaned
from sensorflow.plans.source_queries import _VALID, FIELDS, _bounds
from sensorflow.schema import MEASURES, MOTORS, SENSORS, WARNING_LIMITS_76
from sensorflow.sources.files import register_views
from sensorflow.sources.tables import Tables, nested


@query("rolling_hour", """
SELECT event_id, DeviceId, round(avg(sensor1_clean) OVER w, 6) AS temp_1h_avg,
  round(stddev_samp(sensor1_clean) OVER w, 6) AS temp_1h_std FROM cleaned
WINDOW w AS (PARTITION BY DeviceId ORDER BY event_time RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)""")
def rolling_hour(t: Tables) -> DataFrame:
    return windows.rolling_mean_std(cleaned(t), "sensor1_clean", 3600).select(
        "event_id", "DeviceId", "temp_1h_avg", "temp_1h_std")


@query("rolling_decimals", """
SELECT event_id, DeviceId, round(avg(v) OVER w, 6) AS mean_30m, round(stddev_samp(v) OVER w, 6) AS std_30m
FROM (SELECT event_id, DeviceId, event_time, sin(event_id) * 1000 + sensor1 / 7 AS v FROM readings WHERE DeviceId IS NOT NULL)
WINDOW w AS (PARTITION BY DeviceId ORDER BY event_time RANGE BETWEEN INTERVAL 30 MINUTE PRECEDING AND CURRENT ROW)""")
def rolling_decimals(t: Tables) -> DataFrame:
    """Values with all their decimals, whose sums come out differently in each order of adding."""
    values = t.readings().withColumn("v", F.sin("event_id") * 1000 + F.col("sensor1") / 7)
    ranged = windows.rolling(values, "v", 1800)
    return ranged.select("event_id", "DeviceId", F.round("mean", 6).alias("mean_30m"), F.round("std", 6).alias("std_30m"))


@query("zscore", """
SELECT event_id, DeviceId, round(abs(sensor1_clean - avg(sensor1_clean) OVER w) / nullif(stddev_samp(sensor1_clean) OVER w, 0), 6) AS temp_zscore
FROM cleaned WINDOW w AS (PARTITION BY DeviceId)""")
def zscore(t: Tables) -> DataFrame:
    return anomaly.whole_series_z(cleaned(t), "sensor1_clean", "temp_zscore").select(
        "event_id", "DeviceId", "temp_zscore")


def _iqr(s: str) -> str:
    return f"""round({s}_q1, 6) AS {s}_q1, round({s}_q3, 6) AS {s}_q3,
  coalesce({s} < {s}_q1 - ({s}_q3 - {s}_q1) * 1.5 OR {s} > {s}_q3 + ({s}_q3 - {s}_q1) * 1.5, false) AS {s}_iqr_outlier"""


@query("iqr_outliers", f"""
SELECT event_id, DeviceId, {', '.join(map(_iqr, SENSORS))} FROM (SELECT *,
  {', '.join(f'quantile_cont({s}, 0.25) OVER w AS {s}_q1, quantile_cont({s}, 0.75) OVER w AS {s}_q3' for s in SENSORS)}
  FROM readings WHERE DeviceId IS NOT NULL
  WINDOW w AS (PARTITION BY DeviceId ORDER BY event_time, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW))""")
def iqr_outliers(t: Tables) -> DataFrame:
    found = windows.iqr_outliers(t.readings(), span=24 * HOUR)
    return found.select("event_id", "DeviceId", *(f"{s}_{x}" for s in SENSORS for x in ("q1", "q3", "iqr_outlier")))


@query("latest_per_device", """
SELECT event_id, DeviceId, event_time, sensor1, isFail FROM (SELECT *, row_number() OVER (
  PARTITION BY DeviceId ORDER BY event_time DESC, event_id DESC) AS rn FROM readings WHERE DeviceId IS NOT NULL) WHERE rn = 1""")
def latest_per_device(t: Tables) -> DataFrame:
    return windows.latest_per_device(t.readings()).select("event_id", "DeviceId", "event_time", "sensor1", "isFail")


@query("sustained_high", """
SELECT DeviceId, min(event_time) AS started, max(event_time) AS ended, count(*) AS readings,
  round((epoch_us(max(event_time)) - epoch_us(min(event_time))) / 1000000.0::DOUBLE, 6) AS seconds
FROM (SELECT *, sum(CASE WHEN coalesce(sensor1 > 90, false) THEN 0 ELSE 1 END)
        OVER (PARTITION BY DeviceId ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS stretch
      FROM readings WHERE DeviceId IS NOT NULL) WHERE sensor1 > 90 GROUP BY DeviceId, stretch
HAVING epoch_us(max(event_time)) - epoch_us(min(event_time)) >= 120000000""")
def sustained_high(t: Tables) -> DataFrame:
    return windows.sustained(t.readings(), F.col("sensor1") > 90, 120)


@query("failure_rate_5m", """
SELECT event_id, DeviceId, round(f / 300.0::DOUBLE * 100, 6) AS failures_per_second_x100,
  round(f * 100.0::DOUBLE / n, 6) AS failure_percent,
  CASE WHEN f * 100.0::DOUBLE / n >= 10 THEN 'red' WHEN f * 100.0::DOUBLE / n >= 5 THEN 'yellow' ELSE 'green' END AS failure_band
FROM (SELECT *, sum(coalesce(isFail, false)::INT) OVER w AS f, count(*) OVER w AS n FROM readings WHERE DeviceId IS NOT NULL
  WINDOW w AS (PARTITION BY DeviceId ORDER BY event_time RANGE BETWEEN INTERVAL 5 MINUTE PRECEDING AND CURRENT ROW))""")
def failure_rate_5m(t: Tables) -> DataFrame:
    return windows.failure_rate(t.readings()).select(
        "event_id", "DeviceId", "failures_per_second_x100", "failure_percent", "failure_band")


@query("no_data_gaps", """
SELECT DeviceId, silent_from, event_time AS silent_until,
  round((epoch_us(event_time) - epoch_us(silent_from)) / 1000000.0::DOUBLE, 6) AS gap_seconds
FROM (SELECT *, lag(event_time) OVER (PARTITION BY DeviceId ORDER BY event_time, event_id) AS silent_from
      FROM readings WHERE DeviceId IS NOT NULL)
WHERE epoch_us(event_time) - epoch_us(silent_from) >= 480000000""")
def no_data_gaps(t: Tables) -> DataFrame:
    return windows.silent_gaps(t.readings()).select("DeviceId", "silent_from", "silent_until", "gap_seconds")


@query("motor_deviation", f"""
SELECT event_id, DeviceId, {', '.join(
    f'coalesce(abs({m} / avg({m}) OVER w - 1) > 0.2, false) AS {m}_deviates' for m in MOTORS)}
FROM readings WHERE DeviceId IS NOT NULL WINDOW w AS (PARTITION BY DeviceId)""")
def motor_deviation(t: Tables) -> DataFrame:
    known = t.readings().filter(F.col("DeviceId").isNotNull())
    return anomaly.deviation_from_mean(known, MOTORS).select(
        "event_id", "DeviceId", *(f"{m}_deviates" for m in MOTORS))


_SIGMA = ", ".join(
    f"coalesce(abs({s}_clean - {s}_mean) > 3 * {s}_std, false) AS {s}_outlier" for s in SENSORS)
_HIGH = ", ".join(f"coalesce({s}_clean > {s}_p95, false) AS {s}_high" for s in SENSORS)


@query("sigma_flags", f"SELECT event_id, DeviceId, {_SIGMA} FROM cleaned LEFT JOIN base USING (DeviceId)")
def sigma_flags(t: Tables) -> DataFrame:
    return anomaly.sigma_flags(cleaned(t)).select("event_id", "DeviceId", *(f"{s}_outlier" for s in SENSORS))


@query("p95_flags", f"SELECT event_id, DeviceId, {_HIGH} FROM cleaned LEFT JOIN base USING (DeviceId)")
def p95_flags(t: Tables) -> DataFrame:
    return anomaly.high_flags(cleaned(t)).select("event_id", "DeviceId", *(f"{s}_high" for s in SENSORS))


@query("detect_anomalies", f"""
SELECT event_id, DeviceId, event_time, sensor1_clean, sensor2_clean, sensor3_clean, motor1_clean, motor2_clean,
  motor3_clean, isFail, sensor1_p95, sensor2_p95, sensor3_p95, {_SIGMA}, {_HIGH}
FROM cleaned LEFT JOIN base USING (DeviceId)""")
def detect_anomalies(t: Tables) -> DataFrame:
    return anomaly.anomalies(cleaned(t))


_LIMIT = {"sensor1": 3, "sensor2": 3, "sensor3": 3, "motor1": 2.5, "motor2": 2.5, "motor3": 2.5}


def _z(c: str, value: str) -> str:
    return f"({value} - avg({value}) OVER w) / nullif(stddev_samp({value}) OVER w, 0)"


@query("field_zscore", f"""
SELECT event_id, {', '.join(f'round({_z(c, c)}, 6) + 0 AS {c}_z' for c in MEASURES)},
  {', '.join(f'coalesce(abs({_z(c, c)}) > {_LIMIT[c]}, false) AS {c}_z_outlier' for c in MEASURES)}
FROM readings WHERE DeviceId IS NOT NULL WINDOW w AS (PARTITION BY DeviceId)""")
def field_zscore(t: Tables) -> DataFrame:
    found = anomaly.field_z_scores(t.readings().filter(F.col("DeviceId").isNotNull()))
    return found.select("event_id", *(f"{c}_z" for c in MEASURES), *(f"{c}_z_outlier" for c in MEASURES))


@query("consumer_analysis", """
SELECT event_id, round((sensor1 + sensor2 + sensor3) / 3, 2) AS sensor_average,
  motor1 + motor2 + motor3 AS motor_total, found AS alerts, CASE WHEN found <> '' THEN 'CRITICAL' ELSE 'NORMAL' END AS status
FROM (SELECT *, concat_ws('|', CASE WHEN sensor1 > 90 OR sensor2 > 90 OR sensor3 > 90 THEN 'HIGH_SENSOR_VALUE' END,
  CASE WHEN motor1 > 1500 OR motor2 > 1500 OR motor3 > 1500 THEN 'HIGH_MOTOR_VALUE' END,
  CASE WHEN isFail THEN 'DEVICE_FAILURE' END) AS found FROM readings)""")
def consumer_analysis(t: Tables) -> DataFrame:
    return t.readings().select("event_id", *(c.alias(n) for n, c in A.consumer_analysis().items()))


@query("threshold_alarms", f"""
SELECT event_id, concat_ws('|', CASE WHEN sensor1 > 90 THEN 'HIGH_TEMPERATURE' END,
  CASE WHEN sensor2 > 85 THEN 'HIGH_HUMIDITY' END, CASE WHEN sensor3 > 130 THEN 'HIGH_PRESSURE' END,
  CASE WHEN {_PRESENT} < 0.7 THEN 'LOW_QUALITY' END,
  CASE WHEN sensor1 > 95 OR sensor2 > 95 OR sensor3 > 95 THEN 'SENSOR_WARNING' END,
  CASE WHEN isFail THEN 'URGENT_FAILURE' END) AS alarms FROM readings""")
def threshold_alarms(t: Tables) -> DataFrame:
    return t.readings().select("event_id", A.threshold_alarms(presence_score()).alias("alarms"))


# --- scores --------------------------------------------------------------------------------------------------

@query("sensor_status", "SELECT event_id, sensor_status FROM status")
def sensor_status(t: Tables) -> DataFrame:
    return t.readings().select("event_id", scoring.sensor_status().alias("sensor_status"))


@query("sensor_status_76", "SELECT event_id, sensor_status FROM status76")
def sensor_status_76(t: Tables) -> DataFrame:
    return t.readings().select("event_id", scoring.sensor_status(warning=WARNING_LIMITS_76).alias("sensor_status"))


@query("motor_efficiency", "SELECT event_id, round(motor_efficiency, 6) AS motor_efficiency FROM efficiency")
def motor_efficiency(t: Tables) -> DataFrame:
    return t.readings().select("event_id", scoring.motor_efficiency().alias("motor_efficiency"))


@query("equipment_risk", """
SELECT event_id, CASE WHEN s >= 0.8 THEN 'CRITICAL' WHEN s >= 0.6 THEN 'HIGH' WHEN s >= 0.4 THEN 'MEDIUM'
    WHEN s >= 0.2 THEN 'LOW' ELSE 'MINIMAL' END AS risk_level, round(s, 6) AS risk_score,
  concat_ws('|', CASE WHEN sp > 0.2 THEN 'sensor_status_' || lower(sensor_status) END,
    CASE WHEN motor_efficiency < 0.3 THEN 'low_motor_efficiency' WHEN motor_efficiency < 0.6 THEN 'reduced_motor_efficiency' END,
    CASE WHEN rate > 0.5 THEN 'high_failure_rate' WHEN rate > 0.2 THEN 'elevated_failure_rate' END) AS risk_factors
FROM (SELECT *, least(1.0::DOUBLE, sp
    + CASE WHEN motor_efficiency < 0.3 THEN 0.3::DOUBLE WHEN motor_efficiency < 0.6 THEN 0.15 ELSE 0 END
    + CASE WHEN rate > 0.5 THEN 0.4::DOUBLE WHEN rate > 0.2 THEN 0.2 ELSE 0 END) AS s
  FROM (SELECT event_id, sensor_status, motor_efficiency, rate, CASE sensor_status WHEN 'CRITICAL' THEN 0.4::DOUBLE
      WHEN 'HIGH_WARNING' THEN 0.3 WHEN 'WARNING' THEN 0.15 WHEN 'NORMAL' THEN 0 ELSE 0.2 END AS sp
    FROM status JOIN efficiency USING (event_id)
    LEFT JOIN (SELECT DeviceId, avg(isFail::INT) AS rate FROM readings GROUP BY 1) USING (DeviceId)))""")
def equipment_risk(t: Tables) -> DataFrame:
    readings = t.readings()
    rated = joins.join_derived(readings, stats.failure_share(readings), "DeviceId")
    risk = scoring.equipment_risk(scoring.sensor_status(), scoring.motor_efficiency(), "failure_rate")
    return rated.select("event_id", risk.alias("r")).select("event_id", "r.*")


@query("outlier_score", """
SELECT event_id, round(greatest(0, %s), 6) AS outlier_score FROM cleaned WINDOW w AS (PARTITION BY DeviceId)""" % ", ".join(
    f"least(1.0::DOUBLE, coalesce(abs({_z(s, s + '_clean')}), 0) / 6)" for s in SENSORS))
def outlier_score(t: Tables) -> DataFrame:
    return anomaly.with_outlier_score(cleaned(t)).select("event_id", "outlier_score")


@query("equipment_status", """
SELECT event_id, CASE WHEN temperature > 70 OR vibration > 2.5 OR efficiency < 60 THEN 'CRITICAL'
  WHEN temperature > 60 OR vibration > 2.0 OR efficiency < 70 THEN 'WARNING'
  WHEN temperature > 50 OR vibration > 1.5 OR efficiency < 80 THEN 'CAUTION' ELSE 'NORMAL' END AS equipment_status FROM nested""")
def equipment_status(t: Tables) -> DataFrame:
    return nested(t.readings()).select("event_id", scoring.equipment_status(
        "sensors.temperature", "sensors.vibration", "efficiency").alias("equipment_status"))


@query("anomaly_score", """
SELECT event_id, round(abs(temperature - 50) / 30 + abs(humidity - 60) / 40 + CASE WHEN vibration > 1 THEN (vibration - 1) / 2 ELSE 0 END
  + CASE WHEN efficiency < 85 THEN (85 - efficiency) / 30 ELSE 0 END, 6) AS anomaly_score FROM nested""")
def anomaly_score(t: Tables) -> DataFrame:
    return nested(t.readings()).select("event_id", scoring.anomaly_score(
        "sensors.temperature", "sensors.humidity", "sensors.vibration", "efficiency").alias("anomaly_score"))


@query("maintenance_need", """
SELECT event_id, round(s, 6) AS maintenance_score,
  CASE WHEN s IS NULL THEN NULL WHEN s > 0.8 THEN 'HIGH' WHEN s > 0.6 THEN 'MEDIUM' WHEN s > 0.4 THEN 'LOW' ELSE 'NORMAL' END AS risk_level,
  CASE WHEN s IS NULL THEN NULL WHEN s > 0.8 THEN 'IMMEDIATE_MAINTENANCE' WHEN s > 0.6 THEN 'SCHEDULE_MAINTENANCE'
    WHEN s > 0.4 THEN 'MONITOR_CLOSELY' ELSE 'ROUTINE_CHECK' END AS recommended_action
FROM (SELECT event_id, CASE WHEN temperature > 80 THEN 1.0::DOUBLE ELSE temperature / 80 END * 0.3
    + CASE WHEN vibration > 3 THEN 1.0::DOUBLE ELSE vibration / 3 END * 0.4
    + CASE WHEN efficiency < 90 THEN (90 - efficiency) / 30 ELSE 0.0::DOUBLE END * 0.3 AS s FROM nested)""")
def maintenance_need(t: Tables) -> DataFrame:
    need = scoring.maintenance_need("sensors.temperature", "sensors.vibration", "efficiency")
    return nested(t.readings()).select("event_id", need.alias("m")).select("event_id", "m.*")


# --- records and alerts --------------------------------------------------------------------------------------

_CLEAN_EFFICIENCY = """CASE WHEN motor1_clean IS NULL OR motor2_clean IS NULL OR motor3_clean IS NULL
    OR sensor1_clean IS NULL OR sensor2_clean IS NULL THEN 0.0::DOUBLE ELSE least(1.0::DOUBLE, greatest(0.0::DOUBLE,
    (motor1_clean / 2000.0::DOUBLE + motor2_clean / 1500.0::DOUBLE + motor3_clean / 1800.0::DOUBLE) / 3.0::DOUBLE
    * (CASE WHEN sensor1_clean > 70 THEN greatest(0.5::DOUBLE, 1.0::DOUBLE - (sensor1_clean - 70) / 100) ELSE 1.0::DOUBLE END)
    * (CASE WHEN sensor2_clean > 60 THEN greatest(0.7::DOUBLE, 1.0::DOUBLE - (sensor2_clean - 60) / 100) ELSE 1.0::DOUBLE END))) END"""
_CLEAN_SEVERE = "(sensor1_clean > 90)::INT + (sensor2_clean > 85)::INT + (sensor3_clean > 130)::INT"
_CLEAN_MILD = """(sensor1_clean > 81 AND sensor1_clean <= 90)::INT + (sensor2_clean > 76.5 AND sensor2_clean <= 85)::INT
  + (sensor3_clean > 117 AND sensor3_clean <= 130)::INT"""

TRANSFORM_SQL = f"""
SELECT event_id, DeviceId, event_time, coalesce(isFail, false) AS isFail,
  {', '.join(f'{c}_clean' for c in MEASURES)},
  {', '.join(f'CASE WHEN NOT ({c} {_bounds(c)}) THEN true END AS {c}_outlier' for c in MEASURES)},
  CASE WHEN sensor1_clean IS NULL OR sensor2_clean IS NULL OR sensor3_clean IS NULL THEN 'DATA_MISSING'
    WHEN {_CLEAN_SEVERE} >= 2 THEN 'CRITICAL' WHEN {_CLEAN_SEVERE} = 1 THEN 'HIGH_WARNING'
    WHEN {_CLEAN_MILD} >= 2 THEN 'WARNING' ELSE 'NORMAL' END AS sensor_status,
  round({_CLEAN_EFFICIENCY}, 4) AS motor_efficiency, round(score, 4) AS quality_score, grade AS quality_grade,
  issues AS quality_issues
FROM cleaned JOIN (SELECT event_id, {', '.join(MEASURES)} FROM readings) USING (event_id)
JOIN ({RECORD_QUALITY_SQL}) USING (event_id)"""


@query("transform_record", TRANSFORM_SQL)
def transform_record(t: Tables) -> DataFrame:
    return records.transform(t.readings(), time="event_time", keep=["event_id"]).drop("processed_at")


@query("processed_record", f"""
SELECT event_id, DeviceId, event_time, sensor1, sensor2, sensor3, motor1, motor2, motor3, coalesce(isFail, false) AS isFail,
  sensor_status, round(motor_efficiency, 6) AS motor_efficiency, round({_PRESENT}, 6) AS quality_score
FROM status76 JOIN efficiency USING (event_id) WHERE DeviceId IS NOT NULL""")
def processed_record(t: Tables) -> DataFrame:
    return records.process(t.readings(), time="event_time").drop("processed_at", "k", "user_id")


@query("alert_records", """
SELECT event_id, event_time AS alert_time, DeviceId AS device_id, sensor_status AS severity, sensor_status,
  round(motor_efficiency, 6) AS motor_efficiency, coalesce(isFail, false) AS is_fail, sensor1, sensor2, sensor3
FROM status76 JOIN efficiency USING (event_id)
WHERE DeviceId IS NOT NULL AND (sensor_status IN ('CRITICAL', 'HIGH_WARNING') OR coalesce(isFail, false))""")
def alert_records(t: Tables) -> DataFrame:
    found = records.alerts(records.process(t.readings(), time="event_time"), "event_time", keep=["event_id"])
    return found.select("*", "sensors.*").drop("sensors")


@query("alert_history", """
SELECT DeviceId AS device_id, sensor_status AS severity, CAST(date_trunc('day', event_time) AS TIMESTAMP) AS period,
  count(*) AS alerts, count(*) FILTER (coalesce(isFail, false)) AS failures
FROM status76 WHERE DeviceId IS NOT NULL AND (sensor_status IN ('CRITICAL', 'HIGH_WARNING') OR coalesce(isFail, false))
GROUP BY ALL""")
def alert_history(t: Tables) -> DataFrame:
    return stats.alert_history(records.alerts(records.process(t.readings(), time="event_time"), "event_time"))


@query("alert_routing", """
SELECT event_id, severity, CASE severity WHEN 'CRITICAL' THEN 'email|chat' WHEN 'WARNING' THEN 'chat' ELSE 'log' END AS channels,
  'Device ' || coalesce(CAST(DeviceId AS VARCHAR), 'Unknown') || ': ' || sensor_status AS message
FROM (SELECT *, CASE WHEN coalesce(isFail, false) OR sensor_status = 'CRITICAL' THEN 'CRITICAL'
  WHEN sensor_status = 'HIGH_WARNING' THEN 'WARNING' ELSE 'INFO' END AS severity FROM status)""")
def alert_routing(t: Tables) -> DataFrame:
    judged = t.readings().withColumn("sensor_status", scoring.sensor_status())
    judged = judged.withColumn("severity", A.routing_severity("sensor_status", "isFail"))
    return judged.select(
        "event_id", "severity", A.channels("severity").alias("channels"),
        A.alert_text("DeviceId", "sensor_status").alias("message"))


@query("error_severity", """
SELECT severity, CASE severity WHEN 'low' THEN 'INFO' WHEN 'medium' THEN 'WARNING' WHEN 'high' THEN 'ERROR' ELSE 'CRITICAL' END AS log_level,
  severity IN ('high', 'critical') AS sends_alert, count(*) AS errors
FROM (SELECT CASE sensor_status WHEN 'CRITICAL' THEN 'critical' WHEN 'HIGH_WARNING' THEN 'high' WHEN 'NORMAL' THEN 'low'
        ELSE 'medium' END AS severity FROM status) GROUP BY 1""")
def error_severity(t: Tables) -> DataFrame:
    status = scoring.sensor_status()
    severity = (
        F.when(status == "CRITICAL", "critical").when(status == "HIGH_WARNING", "high").when(status == "NORMAL", "low")
        .otherwise("medium"))
    counted = t.readings().groupBy(severity.alias("severity")).agg(F.count("*").alias("errors"))
    return counted.select(
        "severity", A.log_level("severity").alias("log_level"), A.raises_alert("severity").alias("sends_alert"), "errors")


# --- SQL surface ---------------------------------------------------------------------------------------------

@query("sql_functions", """
SELECT DeviceId, sensor_status, count(*) AS readings, round(avg(motor_efficiency), 6) AS mean_efficiency,
  CAST(sum(CASE WHEN sensor1 BETWEEN 0 AND 100 AND sensor2 BETWEEN 0 AND 100 AND sensor3 BETWEEN 0 AND 150 THEN 1 ELSE 0 END) AS DOUBLE) AS in_range,
  count(*) FILTER (CASE sensor_status WHEN 'CRITICAL' THEN 0.4::DOUBLE WHEN 'HIGH_WARNING' THEN 0.3 WHEN 'WARNING' THEN 0.15
      WHEN 'NORMAL' THEN 0 ELSE 0.2 END + CASE WHEN motor_efficiency < 0.3 THEN 0.3::DOUBLE WHEN motor_efficiency < 0.6 THEN 0.15
      ELSE 0 END >= 0.4) AS at_risk
FROM status JOIN efficiency USING (event_id) GROUP BY 1, 2""")
def sql_functions(t: Tables) -> DataFrame:
    register_functions(t.spark)
    register_views(sensor_readings=t.readings())
    return t.spark.sql("""
        SELECT DeviceId, classify_sensor_status(sensor1, sensor2, sensor3) AS sensor_status, count(*) AS readings,
          avg(calculate_motor_efficiency(motor1, motor2, motor3, sensor1, sensor2)) AS mean_efficiency,
          sum(calculate_quality_score(sensor1, sensor2, sensor3)) AS in_range,
          count_if(assess_equipment_risk(
            DeviceId, classify_sensor_status(sensor1, sensor2, sensor3),
            calculate_motor_efficiency(motor1, motor2, motor3, sensor1, sensor2), 0D, 0D
          ).risk_level IN ('MEDIUM', 'HIGH', 'CRITICAL')) AS at_risk
        FROM sensor_readings GROUP BY 1, 2""")


@query("union_distinct", """
SELECT DISTINCT DeviceId, kind FROM (SELECT DeviceId, 'reading' AS kind FROM readings UNION ALL
  SELECT DeviceId, sensor_status FROM status)""")
def union_distinct(t: Tables) -> DataFrame:
    plain = t.readings().select("DeviceId", F.lit("reading").alias("kind"))
    judged = t.readings().select("DeviceId", scoring.sensor_status().alias("kind"))
    return plain.unionByName(judged).distinct()


@query("ordered_first_n", """
SELECT DeviceId, rn, event_id FROM (SELECT *, CAST(row_number() OVER (PARTITION BY DeviceId ORDER BY event_time, event_id) AS INT) AS rn
  FROM readings WHERE DeviceId IS NOT NULL) WHERE rn <= 3""")
def ordered_first_n(t: Tables) -> DataFrame:
    """The filter on the rank reaches below the shuffle: each task sends three rows per device."""
    order = W.partitionBy("DeviceId").orderBy("event_time", "event_id")
    known = t.readings().filter(F.col("DeviceId").isNotNull())
    return known.withColumn("rn", F.row_number().over(order)).filter("rn <= 3").select("DeviceId", "rn", "event_id")
