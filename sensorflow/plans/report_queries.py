"""Queries over statistics and data-set quality."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.basic import seconds_between
from sensorflow.functions.quality import is_valid_record, presence_score, range_score, record_quality
from sensorflow.operators import anomaly, clean, joins, quality, stats
from sensorflow.plans.catalog import query
from sensorflow.plans.source_queries import _VALID, FIELDS, _bounds
from sensorflow.schema import MEASURES, MOTORS, SENSORS
from sensorflow.sources import topics
from sensorflow.sources.tables import Tables, messages, nested

SLIM = ("event_id", "DeviceId", "event_time")


def cleaned(t: Tables) -> DataFrame:
    return clean.clean(t.readings(), "event_time", keep=["event_id"]).drop("processed_at")


def delayed(t: Tables) -> DataFrame:
    """Readings with the time they were processed, up to a minute and a half later."""
    late = F.make_dt_interval(secs=(F.col("event_id") % 90).cast("decimal(18,6)"))
    return t.readings().withColumn("processed_at", F.col("event_time") + late)


def delay() -> Column:
    return seconds_between("processed_at", "event_time")


def _stat(c: str, deviation: bool) -> str:
    sql = f"round(avg({c}_clean), 6) AS {c}_avg, min({c}_clean) AS {c}_min, max({c}_clean) AS {c}_max"
    return sql + (f", round(stddev_samp({c}_clean), 6) AS {c}_stddev" if deviation else "")


@query("device_hour_stats", f"""
SELECT DeviceId, CAST(CAST(event_time AS DATE) AS VARCHAR) AS date, CAST(hour(event_time) AS INT) AS hour,
  {', '.join(_stat(s, True) for s in SENSORS)}, {', '.join(_stat(m, False) for m in MOTORS)},
  count(*) AS record_count, count(*) FILTER (isFail) AS failure_count,
  count(*) - count(sensor1_clean) AS sensor1_null_count, count(*) - count(motor1_clean) AS motor1_null_count
FROM cleaned GROUP BY ALL""")
def device_hour_stats(t: Tables) -> DataFrame:
    return stats.hourly_statistics(cleaned(t))


@query("device_baselines", f"""
SELECT DeviceId, {', '.join(f'{s}_p95, round({s}_mean, 6) AS {s}_mean, round({s}_std, 6) AS {s}_std' for s in SENSORS)}
FROM base""")
def device_baselines(t: Tables) -> DataFrame:
    return anomaly.baselines(cleaned(t), suffix="_clean")


@query("latency_stats", """
SELECT round(avg(event_id % 90), 6) AS mean_latency, round(quantile_cont(CAST(event_id % 90 AS DOUBLE), 0.95), 6) AS p95_latency,
  CAST(max(event_id % 90) AS DOUBLE) AS max_latency, count(*) AS messages FROM events""")
def latency_stats(t: Tables) -> DataFrame:
    return stats.latency_statistics(delayed(t), delay())


@query("throughput_windows", """
SELECT time_bucket(INTERVAL 30 SECOND, event_time) AS window_start, count(*) AS messages,
  round(count(*) / 30.0::DOUBLE, 6) AS messages_per_second FROM readings GROUP BY 1""")
def throughput_windows(t: Tables) -> DataFrame:
    return stats.rate_per_window(t.readings(), 30)


@query("run_summary", f"""
SELECT count(*) AS total, count(*) FILTER (ok) AS successful, count(*) - count(*) FILTER (ok) AS failed,
  round(count(*) FILTER (ok) * 100.0::DOUBLE / count(*), 6) AS success_rate
FROM (SELECT DeviceId IS NOT NULL AND {' AND '.join(_VALID.values())} AS ok FROM readings)""")
def run_summary(t: Tables) -> DataFrame:
    return stats.run_summary(t.readings(), F.col("DeviceId").isNotNull() & is_valid_record())


@query("word_count", "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1")
def word_count(t: Tables) -> DataFrame:
    return stats.count_words(t.table("documents"))


@query("latency_status", """
SELECT event_id, CAST(event_id % 90 AS DOUBLE) AS latency_seconds,
  CASE WHEN event_id % 90 < 60 THEN 'PASS' ELSE 'WARN' END AS status FROM events""")
def latency_status(t: Tables) -> DataFrame:
    return stats.latency_status(delayed(t), delay(), keep=["event_id"])


def _trend(unit: str) -> str:
    return f"""
SELECT DeviceId, period, readings, round(mean_value, 6) AS mean_value, failures,
  round(mean_value - lag(mean_value) OVER (PARTITION BY DeviceId ORDER BY period), 6) + 0 AS change
FROM (SELECT DeviceId, CAST(date_trunc('{unit}', event_time) AS TIMESTAMP) AS period, count(*) AS readings,
        avg(sensor1_clean) AS mean_value, count(*) FILTER (isFail) AS failures FROM cleaned GROUP BY ALL)"""


def _register_trend(name: str, unit: str) -> None:
    query(name, _trend(unit))(lambda t: stats.trend(cleaned(t), unit, "sensor1_clean"))


for _name, _unit in (("daily_trend", "day"), ("weekly_trend", "week"), ("monthly_trend", "month"),
                     ("hourly_trend", "hour")):
    _register_trend(_name, _unit)


@query("failure_rate", """
SELECT DeviceId, count(*) AS readings, count(*) FILTER (isFail) AS failures,
  round(avg(CAST(isFail AS INT)), 6) AS failure_rate FROM readings GROUP BY 1""")
def failure_rate(t: Tables) -> DataFrame:
    return stats.failure_share(t.readings())


@query("device_overview", """
SELECT DeviceId, count(*) AS samples, max(event_time) AS last_seen,
  CASE WHEN count(*) >= 2 THEN 'green' WHEN count(*) >= 1 THEN 'yellow' ELSE 'red' END AS color
FROM readings GROUP BY 1""")
def device_overview(t: Tables) -> DataFrame:
    return stats.device_overview(t.readings())


_PRESENT = f"({' + '.join(f'({c} IS NOT NULL)::INT' for c in MEASURES)}) / 6.0::DOUBLE"


@query("quality_gauge", f"""
SELECT round(q, 6) AS quality_percent, CASE WHEN q >= 90 THEN 'green' WHEN q >= 70 THEN 'yellow' ELSE 'red' END AS color
FROM (SELECT avg({_PRESENT}) * 100 AS q FROM readings)""")
def quality_gauge(t: Tables) -> DataFrame:
    return stats.quality_gauge(t.readings(), presence_score())


@query("error_band", """
SELECT *, CASE WHEN error_percent > 10 OR max_delay > 60 THEN 'CRITICAL'
    WHEN error_percent > 5 OR max_delay > 30 THEN 'WARNING' ELSE 'INFO' END AS band
FROM (SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start,
  round(avg(CASE WHEN isFail THEN 1.0::DOUBLE ELSE 0 END) * 100, 6) AS error_percent,
  CAST(max(event_id % 90) AS DOUBLE) AS max_delay FROM readings GROUP BY 1)""")
def error_band(t: Tables) -> DataFrame:
    return stats.error_band(delayed(t), F.col("isFail"), delay())


@query("failure_band", """
SELECT *, CASE WHEN failure_percent >= 10 THEN 'red' WHEN failure_percent >= 5 THEN 'yellow' ELSE 'green' END AS color
FROM (SELECT time_bucket(INTERVAL 6 HOUR, event_time) AS window_start,
  round(avg(CASE WHEN isFail THEN 1.0::DOUBLE ELSE 0 END) * 100, 6) AS failure_percent FROM readings GROUP BY 1)""")
def failure_band(t: Tables) -> DataFrame:
    return stats.failure_band(t.readings(), 6 * 3600)


@query("collection_rate", """
SELECT time_bucket(INTERVAL 1 MINUTE, event_time) AS window_start, DeviceId, count(*) AS messages,
  round(count(*) / 60.0::DOUBLE, 6) AS messages_per_second FROM readings GROUP BY 1, 2""")
def collection_rate(t: Tables) -> DataFrame:
    return stats.rate_per_window(t.readings(), 60, keys=["DeviceId"])


@query("reconcile_loss", """
SELECT DeviceId, count(*) AS sent, count(*) FILTER (event_id % 150 IN (0, 30, 60, 90)) AS lost,
  round(count(*) FILTER (event_id % 150 IN (0, 30, 60, 90)) * 100.0::DOUBLE / count(*), 6) AS loss_percent
FROM readings GROUP BY 1""")
def reconcile_loss(t: Tables) -> DataFrame:
    received = topics.well_formed(topics.decode(topics.envelope(messages(t.readings()))))
    received = received.select("DeviceId", F.try_to_timestamp("time").cast("timestamp_ntz").alias("event_time"))
    return joins.reconcile(t.readings().select(*SLIM), received, ["DeviceId", "event_time"])


@query("lost_readings", """
SELECT event_id, DeviceId FROM readings WHERE event_id % 150 IN (0, 30, 60, 90)""")
def lost_readings(t: Tables) -> DataFrame:
    received = topics.well_formed(topics.decode(topics.envelope(messages(t.readings()))))
    received = received.select("DeviceId", F.try_to_timestamp("time").cast("timestamp_ntz").alias("event_time"))
    return joins.lost_rows(t.readings().select(*SLIM), received, ["DeviceId", "event_time"]).select(
        "event_id", "DeviceId")


# --- quality of the data set -----------------------------------------------------------------------------------

def _filled(f: str) -> str:
    critical = "true" if f in ("DeviceId", "event_time") else "false"
    return (f"SELECT '{f}' AS field, count(*) AS total_records, count({f}) AS non_null_records, "
            f"round(count({f}) / CAST(count(*) AS DOUBLE), 6) AS completeness_rate, {critical} AS is_critical, "
            f"count({f}) / CAST(count(*) AS DOUBLE) >= 0.95 AS passes_threshold FROM readings")


_FILLED = " UNION ALL ".join(map(_filled, FIELDS))


@query("completeness_by_field", _FILLED)
def completeness_by_field(t: Tables) -> DataFrame:
    return quality.completeness(t.readings(), FIELDS, ("DeviceId", "event_time"))


@query("overall_completeness", f"""
WITH fields AS ({_FILLED.replace('round(', '(').replace(', 6)', ')')})
SELECT round(avg(completeness_rate), 6) AS overall_completeness_rate, count(*) FILTER (passes_threshold) AS fields_passing,
  count(*) AS total_fields, (SELECT count(*) FROM readings) AS records FROM fields""")
def overall_completeness(t: Tables) -> DataFrame:
    return quality.overall_completeness(t.readings(), fields=FIELDS)


@query("validity_summary", f"""
SELECT round(avg(ok::INT), 6) AS validity_rate, count(*) FILTER (ok) AS valid_records, count(*) AS total_records
FROM (SELECT {' AND '.join(_VALID.values())} AS ok FROM readings)""")
def validity_summary(t: Tables) -> DataFrame:
    return quality.validity_summary(t.readings())


@query("dataset_summary", "SELECT count(*) AS total_records, count(DISTINCT DeviceId) AS unique_devices FROM readings")
def dataset_summary(t: Tables) -> DataFrame:
    return quality.dataset_summary(t.readings()).drop("validated_at")


_COLUMNS = ("event_id", "event_time", "DeviceId") + MEASURES + ("isFail",)


@query("column_completeness", " UNION ALL ".join(
    f'SELECT \'{c}\' AS "column", round(count({c}) / CAST(count(*) AS DOUBLE), 6) AS completeness FROM readings'
    for c in _COLUMNS))
def column_completeness(t: Tables) -> DataFrame:
    return quality.column_completeness(t.readings().select(*_COLUMNS))


_RATIOS = """avg(coalesce((temperature BETWEEN 20 AND 80)::INT, 0)) AS temperature_valid,
  avg(coalesce((humidity BETWEEN 20 AND 90)::INT, 0)) AS humidity_valid,
  avg(coalesce((efficiency BETWEEN 30 AND 100)::INT, 0)) AS efficiency_valid"""
_STEADY = """SELECT sum(after) / CAST(sum(n) AS DOUBLE) AS timestamp_order, avg((places = 1)::INT) AS device_location_consistency
FROM (SELECT device_id, count(*) AS n, count(*) FILTER ("timestamp" > TIMESTAMP '2020-01-01') AS after,
        count(DISTINCT location) AS places FROM nested GROUP BY 1)"""


@query("validity_ratios", f"""
SELECT round(temperature_valid, 6) AS temperature_valid, round(humidity_valid, 6) AS humidity_valid,
  round(efficiency_valid, 6) AS efficiency_valid FROM (SELECT {_RATIOS} FROM nested)""")
def validity_ratios(t: Tables) -> DataFrame:
    return quality.validity_ratios(nested(t.readings()))


@query("consistency_ratios", f"""
SELECT round(timestamp_order, 6) AS timestamp_order, round(device_location_consistency, 6) AS device_location_consistency
FROM ({_STEADY})""")
def consistency_ratios(t: Tables) -> DataFrame:
    return quality.consistency_ratios(nested(t.readings()))


_LEAVES = {"event_id": "event_id", "device_id": "device_id", "location": "location", "timestamp": "timestamp",
           "efficiency": "efficiency", "temperature": "sensors.temperature", "humidity": "sensors.humidity",
           "vibration": "sensors.vibration", "power": "sensors.power_consumption"}


@query("weighted_quality_grade", f"""
WITH full_rate AS (SELECT ({' + '.join(f'count("{c}")' for c in _LEAVES)}) / CAST(count(*) * {len(_LEAVES)} AS DOUBLE) AS completeness FROM nested),
valid_rate AS (SELECT (temperature_valid + humidity_valid + efficiency_valid) / 3 AS validity FROM (SELECT {_RATIOS} FROM nested)),
steady AS (SELECT (timestamp_order + device_location_consistency) / 2 AS consistency FROM ({_STEADY})),
scores AS (SELECT *, completeness * 0.3 + validity * 0.4 + consistency * 0.3 AS score FROM full_rate, valid_rate, steady)
SELECT round(completeness, 6) AS completeness, round(validity, 6) AS validity, round(consistency, 6) AS consistency,
  round(score, 6) AS overall_quality_score, CASE WHEN score > 0.9 THEN 'A' WHEN score > 0.8 THEN 'B' ELSE 'C' END AS quality_grade,
  concat_ws('|', CASE WHEN completeness < 0.95 THEN 'improve completeness' END,
    CASE WHEN validity < 0.95 THEN 'improve validity' END,
    CASE WHEN consistency < 0.98 THEN 'improve consistency' END) AS recommendations FROM scores""")
def weighted_quality_grade(t: Tables) -> DataFrame:
    return quality.weighted_grade(nested(t.readings()), {n: F.col(c) for n, c in _LEAVES.items()})


@query("duplicate_ratio", """
SELECT count(*) AS total_records, count(DISTINCT (DeviceId, h)) AS distinct_records,
  round((count(*) - count(DISTINCT (DeviceId, h))) / CAST(count(*) AS DOUBLE), 6) AS duplicate_ratio,
  (count(*) - count(DISTINCT (DeviceId, h))) / CAST(count(*) AS DOUBLE) <= 0.02 AS passes
FROM (SELECT coalesce(DeviceId, -1) AS DeviceId, date_trunc('hour', event_time) AS h FROM readings)""")
def duplicate_ratio(t: Tables) -> DataFrame:
    """Copies at hour resolution, since event times are all different."""
    return quality.duplicate_ratio(
        t.readings().withColumn("hour", F.date_trunc("hour", F.col("event_time").cast("timestamp"))),
        ("DeviceId", "hour"))


@query("temporal_order", """
SELECT DeviceId, count(*) FILTER (bad) AS violations, round(1 - avg(bad::INT), 6) AS consistency,
  1 - avg(bad::INT) > 0.98 AS passes
FROM (SELECT DeviceId, coalesce(event_time < lag(event_time) OVER (PARTITION BY DeviceId ORDER BY arrival, event_id), false) AS bad
  FROM (SELECT *, event_id + CASE WHEN event_id % 50 = 0 THEN 70 ELSE 0 END AS arrival FROM readings
        WHERE DeviceId IS NOT NULL)) GROUP BY 1""")
def temporal_order(t: Tables) -> DataFrame:
    late = F.when(F.col("event_id") % 50 == 0, 70).otherwise(0)
    return quality.temporal_order(t.readings().withColumn("arrival", F.col("event_id") + late), "arrival")


@query("interval_check", """
SELECT DeviceId, count(gap) AS intervals, round(avg(CASE WHEN gap IS NOT NULL THEN (abs(gap - 1500) <= 600)::INT END), 6) AS regular_share,
  CAST(coalesce(sum(greatest(floor(gap / 1500) - 1, 0)), 0) AS BIGINT) AS missing_readings,
  avg(CASE WHEN gap IS NOT NULL THEN (abs(gap - 1500) <= 600)::INT END) > 0.9 AS passes
FROM (SELECT DeviceId, (epoch_us(event_time) - lag(epoch_us(event_time)) OVER (PARTITION BY DeviceId ORDER BY event_time, event_id))
        / 1000000.0::DOUBLE AS gap FROM readings WHERE DeviceId IS NOT NULL) GROUP BY 1""")
def interval_check(t: Tables) -> DataFrame:
    return quality.interval_check(t.readings(), expected=1500, tolerance=600)


@query("timeliness", """
SELECT round(avg((event_id % 90 <= 60)::INT), 6) AS within_limit, round(avg((event_id % 90 <= 30)::INT), 6) AS within_target,
  round(avg((event_id % 90 <= 60)::INT), 6) AS within_a_minute, CAST(max(event_id % 90) AS DOUBLE) AS max_delay FROM events""")
def timeliness(t: Tables) -> DataFrame:
    return quality.timeliness(delayed(t), delay())


@query("kpi_table", f"""
WITH k AS (SELECT ({' + '.join(f'count({f})' for f in FIELDS)}) / CAST(count(*) * {len(FIELDS)} AS DOUBLE) AS completeness,
  avg(({' AND '.join(_VALID.values())})::INT) AS accuracy, CAST(max(event_id % 90) AS DOUBLE) AS timeliness,
  count(DISTINCT (coalesce(DeviceId, -1), event_time)) / CAST(count(*) AS DOUBLE) AS consistency FROM readings)
SELECT 'completeness' AS metric, round(completeness, 6) AS value, 0.99::DOUBLE AS target, completeness >= 0.99 AS passes FROM k
UNION ALL SELECT 'accuracy', round(accuracy, 6), 0.95, accuracy >= 0.95 FROM k
UNION ALL SELECT 'timeliness', timeliness, 30, timeliness <= 30 FROM k
UNION ALL SELECT 'consistency', round(consistency, 6), 0.98, consistency >= 0.98 FROM k""")
def kpi_table(t: Tables) -> DataFrame:
    return quality.kpi_table(delayed(t), delay())


_HERE = " + ".join(f"({f} IS NOT NULL)::INT" for f in FIELDS)
_GOOD = " + ".join(f"coalesce(({c} {_bounds(c)})::INT, 0)" for c in MEASURES)
_RANGED = " + ".join(f"({c} IS NOT NULL)::INT" for c in MEASURES)
RECORD_QUALITY_SQL = f"""SELECT *, CASE WHEN score >= 0.95 THEN 'EXCELLENT' WHEN score >= 0.85 THEN 'GOOD' WHEN score >= 0.7 THEN 'FAIR'
    ELSE 'POOR' END AS grade
FROM (SELECT event_id, ({_HERE} + {_GOOD}) / CAST(9 + {_RANGED} AS DOUBLE) AS score, 9 + {_RANGED} AS total_checks,
    {_HERE} + {_GOOD} AS passed_checks,
    concat_ws('|', {', '.join(f"CASE WHEN {f} IS NULL THEN 'missing_{f}' END" for f in FIELDS)},
      {', '.join(f"CASE WHEN NOT ({c} {_bounds(c)}) THEN 'invalid_{c}_range' END" for c in MEASURES)}) AS issues
  FROM readings)"""


@query("record_quality", f"""
SELECT event_id, round(score, 6) AS quality_score, CAST(total_checks AS INT) AS total_checks,
  CAST(passed_checks AS INT) AS passed_checks, issues, grade FROM readings JOIN ({RECORD_QUALITY_SQL}) USING (event_id)""")
def record_quality_query(t: Tables) -> DataFrame:
    return t.readings().select("event_id", record_quality(FIELDS).alias("q")).select("event_id", "q.*")


@query("range_score", """
SELECT event_id, CASE WHEN sensor1 BETWEEN 0 AND 100 AND sensor2 BETWEEN 0 AND 100 AND sensor3 BETWEEN 0 AND 150
  THEN 1.0::DOUBLE ELSE 0.0 END AS quality_score FROM readings""")
def range_score_query(t: Tables) -> DataFrame:
    return t.readings().select("event_id", range_score().alias("quality_score"))


@query("presence_score", f"SELECT event_id, round({_PRESENT}, 6) AS quality_score FROM readings")
def presence_score_query(t: Tables) -> DataFrame:
    return t.readings().select("event_id", presence_score().alias("quality_score"))


@query("quality_report", f"""
SELECT count(*) AS total_records, count(DISTINCT DeviceId) AS unique_devices,
  {', '.join(f'round(count({f}) / CAST(count(*) AS DOUBLE), 6) AS {f}_completeness' for f in FIELDS)},
  round(avg(({' AND '.join(_VALID.values())})::INT), 6) AS validity_rate,
  count(*) FILTER ({' AND '.join(_VALID.values())}) AS valid_records,
  round(({' + '.join(f'count({f})' for f in FIELDS)}) / CAST(count(*) * 9 AS DOUBLE), 6) AS overall_completeness_rate
FROM readings""")
def quality_report(t: Tables) -> DataFrame:
    return quality.quality_report(t.readings(), FIELDS).drop("validated_at")
