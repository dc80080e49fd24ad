"""Queries over sources, cleaning and repair."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.quality import missing_fields, passes_gate, range_issues, type_errors
from sensorflow.functions.features import word_count
from sensorflow.operators import anomaly, clean, stats, windows
from sensorflow.plans.catalog import query
from sensorflow.schema import MEASURES, MOTORS, SENSORS
from sensorflow.session import work_path
from sensorflow.sinks.layers import DAY_PARTS, with_date_parts, write_layer, write_text
from sensorflow.sources import files, topics
from sensorflow.sources.tables import Tables, loose_json, loose_text, messages, nested, with_iso_time

FIELDS = ("event_time", "DeviceId") + MEASURES + ("isFail",)
_LOST = "event_id % 150 IN (0, 30, 60, 90)"  # no JSON object
_SPOILED = {"sensor1": "event_id % 150 = 120", "motor1": "event_id % 150 IN (120, 121)"}
_DECODED = ", ".join(f"CASE WHEN NOT ({_LOST}) AND NOT ({_SPOILED.get(c, 'false')}) THEN {c} END AS {c}" for c in (*MEASURES, "isFail"))


@query("json_decode", f"""
SELECT event_id, CASE WHEN NOT ({_LOST}) THEN strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') END AS "time",
  CASE WHEN NOT ({_LOST}) THEN DeviceId END AS DeviceId, {_DECODED}, {_LOST} AS malformed
FROM readings""")
def json_decode(t: Tables) -> DataFrame:
    decoded = topics.decode(topics.envelope(messages(t.readings()), keep=["event_id"]), keep=["event_id"])
    return decoded.withColumn("malformed", F.col(topics.CORRUPT).isNotNull()).drop(topics.CORRUPT)


@query("json_lines_scan", """
SELECT CAST(coalesce(DeviceId, 0) AS VARCHAR) AS file_device, strftime(event_time, '%Y%m%d') AS file_day,
  count(*) AS readings, count(sensor1) AS sensor1_values, round(avg(sensor3), 6) AS sensor3_avg
FROM readings GROUP BY ALL""")
def json_lines_scan(t: Tables) -> DataFrame:
    path = work_path(t.spark, "json-lines")
    lines = with_iso_time(t.readings().withColumn("day", F.date_format("event_time", "yyyyMMdd")))
    write_layer(lines.withColumn("device", F.coalesce("DeviceId", F.lit(0))), path, ("device", "day"), "json")
    scan = files.json_lines(t.spark, path, location=r"device=(\d+)/day=(\d{8})/")
    return scan.groupBy("file_device", "file_day").agg(
        F.count("*").alias("readings"), F.count("sensor1").alias("sensor1_values"),
        F.avg("sensor3").alias("sensor3_avg"))


@query("text_scan", "SELECT props AS value, count(*) AS n FROM events GROUP BY 1")
def text_scan(t: Tables) -> DataFrame:
    path = work_path(t.spark, "text-scan")
    write_text(t.table("events"), path, "props")
    return files.text_lines(t.spark, path).groupBy("value").agg(F.count("*").alias("n"))


@query("layer_read_back", """
SELECT DeviceId, CAST(year(event_time) AS INT) AS year, CAST(month(event_time) AS INT) AS month,
  CAST(day(event_time) AS INT) AS day, count(*) AS readings, round(avg(sensor1), 6) AS sensor1_avg
FROM readings GROUP BY ALL""")
def layer_read_back(t: Tables) -> DataFrame:
    path = work_path(t.spark, "raw-layer")
    write_layer(with_date_parts(t.readings()), path, DAY_PARTS, codec="gzip")
    return files.layer(t.spark, path).groupBy(*DAY_PARTS).agg(
        F.count("*").alias("readings"), F.avg("sensor1").alias("sensor1_avg"))


@query("bounded_read", "SELECT event_id, DeviceId, sensor1 FROM readings ORDER BY event_time, event_id LIMIT 20")
def bounded_read(t: Tables) -> DataFrame:
    return files.first_rows(t.readings(), 20, "event_time", "event_id").select("event_id", "DeviceId", "sensor1")


@query("sequence_filter_count", """
SELECT count(*) AS n FROM events WHERE event_id * 2 > 100""")
def sequence_filter_count(t: Tables) -> DataFrame:
    return stats.doubled_above(t.table("events"), "event_id")


@query("partition_profile", "SELECT count(*) AS total_rows, true AS largest_fits, true AS all_have_rows FROM events")
def partition_profile(t: Tables) -> DataFrame:
    """What holds of the profile however Spark cuts the table."""
    profile = stats.rows_per_partition(t.table("events"))
    return profile.agg(
        F.sum("rows").alias("total_rows"), (F.max("rows") <= F.sum("rows")).alias("largest_fits"), (F.min("rows") > 0).alias("all_have_rows"))


@query("layer_newest_day", """
SELECT DeviceId, CAST(day(event_time) AS INT) AS day, count(*) AS readings, round(avg(sensor1), 6) AS sensor1_avg FROM readings
WHERE CAST(event_time AS DATE) = (SELECT max(CAST(event_time AS DATE)) FROM readings) GROUP BY ALL""")
def layer_newest_day(t: Tables) -> DataFrame:
    path = work_path(t.spark, "day-layer")
    write_layer(with_date_parts(t.readings()), path, DAY_PARTS)
    return files.newest_day(t.spark, path).groupBy("DeviceId", "day").agg(
        F.count("*").alias("readings"), F.avg("sensor1").alias("sensor1_avg"))


@query("topic_to_topic", """
SELECT lang AS "key", '{"doc_id":' || doc_id || ',"n_chars":' || n_chars || '}' AS value FROM documents WHERE contains(text, 'thing')""")
def topic_to_topic(t: Tables) -> DataFrame:
    """Envelope, filter, and messages for the next topic, in one chain."""
    sent = t.table("documents").select(
        F.col("lang").cast("binary").alias("key"), F.col("text").cast("binary").alias("value"),
        F.current_timestamp().alias("timestamp"), "doc_id", "n_chars")
    found = clean.containing(topics.envelope(sent, keep=["doc_id", "n_chars"]), "thing")
    return topics.to_messages(found, "key", ["doc_id", "n_chars"])


# --- cleaning ------------------------------------------------------------------------------------------------

@query("clean_readings", """
SELECT event_id, DeviceId, event_time, sensor1_clean, sensor2_clean, sensor3_clean, motor1_clean, motor2_clean,
  motor3_clean, isFail FROM cleaned""")
def clean_readings(t: Tables) -> DataFrame:
    return clean.clean(with_iso_time(t.readings()), keep=["event_id"]).drop("processed_at")


def _bounds(c: str) -> str:
    return f"BETWEEN 0 AND { {'sensor1': 100, 'sensor2': 100, 'sensor3': 150, 'motor1': 2000, 'motor2': 1500, 'motor3': 1800}[c]}"


@query("clean_with_flags", f"""
SELECT event_id, DeviceId, coalesce(isFail, false) AS isFail,
  {', '.join(f'CASE WHEN {c} {_bounds(c)} THEN {c} END AS {c}_clean' for c in MEASURES)},
  {', '.join(f'CASE WHEN NOT ({c} {_bounds(c)}) THEN true END AS {c}_outlier' for c in MEASURES)}
FROM readings WHERE DeviceId IS NOT NULL""")
def clean_with_flags(t: Tables) -> DataFrame:
    return clean.clean_with_marks(t.readings(), "event_time", keep=["event_id"]).drop("event_time")


@query("type_coercion", """
SELECT event_id, TRY_CAST("time" AS TIMESTAMP) AS "time", TRY_CAST(DeviceId AS INT) AS DeviceId,
  round(TRY_CAST(sensor1 AS DOUBLE), 2) AS sensor1, round(TRY_CAST(sensor2 AS DOUBLE), 2) AS sensor2,
  round(TRY_CAST(sensor3 AS DOUBLE), 2) AS sensor3, CAST(round(TRY_CAST(motor1 AS DOUBLE)) AS INT) AS motor1,
  CAST(round(TRY_CAST(motor2 AS DOUBLE)) AS INT) AS motor2, CAST(round(TRY_CAST(motor3 AS DOUBLE)) AS INT) AS motor3,
  coalesce(TRY_CAST(isFail AS BOOLEAN), false) AS isFail
FROM loose WHERE TRY_CAST("time" AS TIMESTAMP) IS NOT NULL AND TRY_CAST(DeviceId AS INT) BETWEEN 1 AND 5
  AND (sensor1 IS NULL OR TRY_CAST(sensor1 AS DOUBLE) IS NOT NULL)
  AND (motor1 IS NULL OR TRY_CAST(motor1 AS DOUBLE) IS NOT NULL)""")
def type_coercion(t: Tables) -> DataFrame:
    return clean.coerce_types(loose_text(t.readings()), keep=["event_id"])


@query("type_conformity", """
SELECT event_id, concat_ws('|',
  CASE WHEN DeviceId IS NULL OR event_id % 53 = 0 THEN 'DeviceId must be integer' END,
  CASE WHEN isFail IS NULL OR event_id % 59 = 0 THEN 'isFail must be boolean' END,
  CASE WHEN sensor1 IS NULL OR event_id % 43 = 0 THEN 'sensor1 must be number' END,
  CASE WHEN sensor2 IS NULL THEN 'sensor2 must be number' END,
  CASE WHEN sensor3 IS NULL THEN 'sensor3 must be number' END,
  CASE WHEN motor1 IS NULL OR event_id % 5 = 0 THEN 'motor1 must be integer' END,
  CASE WHEN motor2 IS NULL THEN 'motor2 must be integer' END,
  CASE WHEN motor3 IS NULL THEN 'motor3 must be integer' END) AS type_errors
FROM readings""")
def type_conformity(t: Tables) -> DataFrame:
    return loose_json(t.readings()).select("event_id", type_errors("payload").alias("type_errors"))


@query("missing_fields", f"""
SELECT event_id, concat_ws('|', {', '.join(f"CASE WHEN {f} IS NULL THEN '{f}' END" for f in FIELDS)}) AS missing
FROM readings""")
def missing(t: Tables) -> DataFrame:
    return t.readings().select("event_id", missing_fields(FIELDS).alias("missing"))


@query("ingest_gate", f"""
SELECT event_id, coalesce({' AND '.join(f'{f} IS NOT NULL' for f in FIELDS)}
  AND {' AND '.join(f'{s} BETWEEN 0 AND 100' for s in SENSORS)}, false) AS passes FROM readings""")
def ingest_gate(t: Tables) -> DataFrame:
    return t.readings().select("event_id", passes_gate(FIELDS).alias("passes"))


_RANGES_SQL = ", ".join(
    f"CASE WHEN NOT ({c} {_bounds(c)}) THEN '{c} out of range: ' || {c} || ' (expected {_bounds(c)[8:].replace(' AND ', '-')})' END"
    for c in MEASURES)


@query("range_issues", f"""
SELECT event_id, concat_ws('|', {', '.join(f"CASE WHEN {f} IS NULL THEN 'Missing field: {f}' END" for f in FIELDS)},
  {_RANGES_SQL},
  CASE WHEN DeviceId NOT BETWEEN 1 AND 5 THEN 'DeviceId out of range: ' || DeviceId || ' (expected 1-5)' END) AS issues
FROM readings""")
def issues(t: Tables) -> DataFrame:
    return t.readings().select("event_id", range_issues(FIELDS).alias("issues"))


@query("keyword_filter", "SELECT doc_id, n_chars FROM documents WHERE contains(text, 'thing')")
def keyword_filter(t: Tables) -> DataFrame:
    return clean.containing(t.table("documents"), "thing", "text").select("doc_id", "n_chars")


@query("device_domain", "SELECT event_id, DeviceId FROM readings WHERE DeviceId BETWEEN 1 AND 5")
def device_domain(t: Tables) -> DataFrame:
    return clean.only_known_devices(t.readings()).select("event_id", "DeviceId")


_VALID = {"DeviceId": "(DeviceId IS NULL OR DeviceId BETWEEN 1 AND 5)",
          **{c: f"({c} IS NULL OR {c} {_bounds(c)})" for c in MEASURES}}


@query("validity_flags", f"""
SELECT event_id, {', '.join(f'{v} AS {c}_range_valid' for c, v in _VALID.items())},
  {' AND '.join(_VALID.values())} AS is_valid_record FROM readings""")
def validity(t: Tables) -> DataFrame:
    return clean.with_validity(t.readings()).select(
        "event_id", *(f"{c}_range_valid" for c in _VALID), "is_valid_record")


@query("nested_normalize", """
SELECT * FROM (SELECT event_id, device_id, location,
    CASE WHEN temperature BETWEEN 20 AND 80 THEN temperature END AS temperature, humidity,
    CAST(efficiency AS INT) AS efficiency,
    round(((temperature IS NOT NULL)::INT
      + coalesce((humidity BETWEEN 20 AND 90)::INT, 0) + coalesce((vibration > 0)::INT, 0)) / 3.0::DOUBLE, 6) AS quality_score
  FROM nested) WHERE quality_score >= 0.7""")
def nested_normalize(t: Tables) -> DataFrame:
    return clean.normalize_nested(nested(t.readings())).select(
        "event_id", "device_id", "location", "sensors.temperature", "sensors.humidity", "efficiency", "quality_score")


@query("threshold_join_check", """
SELECT event_id, sensor_name, value, min_val, max_val, unit, value BETWEEN min_val AND max_val AS in_range
FROM (SELECT event_id, 'sensor1' AS sensor_name, sensor1 AS value FROM readings UNION ALL
      SELECT event_id, 'sensor2', sensor2 FROM readings UNION ALL SELECT event_id, 'sensor3', sensor3 FROM readings)
JOIN (VALUES ('sensor1', 0.0::DOUBLE, 100.0::DOUBLE, 'temperature'), ('sensor2', 0.0, 100.0, 'humidity'),
      ('sensor3', 0.0, 150.0, 'pressure')) d(sensor_name, min_val, max_val, unit) USING (sensor_name)""")
def threshold_join_check(t: Tables) -> DataFrame:
    return clean.check_thresholds(t.readings(), clean.thresholds(t.spark), ["event_id"])


# --- repair --------------------------------------------------------------------------------------------------

_ALL = ", ".join(("event_id", "DeviceId") + MEASURES + ("isFail",))
ROW = ("event_id", "DeviceId") + MEASURES + ("isFail",)


@query("fill_defaults", f"""
SELECT event_id, DeviceId, sensor1, sensor2, sensor3,
  {', '.join(f'coalesce({m}, 0) AS {m}' for m in MOTORS)}, coalesce(isFail, false) AS isFail FROM readings""")
def fill_defaults(t: Tables) -> DataFrame:
    return clean.fill_defaults(t.readings()).select(*ROW)


@query("forward_fill", f"""
SELECT event_id, DeviceId, {', '.join(
    f'last_value({s} IGNORE NULLS) OVER (PARTITION BY DeviceId ORDER BY event_time, event_id) AS {s}' for s in SENSORS)}
FROM readings WHERE DeviceId IS NOT NULL""")
def forward_fill(t: Tables) -> DataFrame:
    return windows.forward_fill(t.readings()).select("event_id", "DeviceId", *SENSORS)


@query("reject_null_keys", f"SELECT {_ALL} FROM readings WHERE DeviceId IS NOT NULL AND event_time IS NOT NULL")
def reject_null_keys(t: Tables) -> DataFrame:
    return clean.reject_null_keys(t.readings(), ("DeviceId", "event_time")).select(*ROW)


def _clip(c: str) -> str:
    top = _bounds(c)[14:]
    return f"CASE WHEN {c} > {top} THEN {top} WHEN {c} < 0 THEN 0 ELSE {c} END AS {c}"


@query("clip_limits", f"SELECT event_id, {', '.join(map(_clip, SENSORS))} FROM readings")
def clip_limits(t: Tables) -> DataFrame:
    return anomaly.treat_outliers(t.readings(), "clip", SENSORS).select("event_id", *SENSORS)


@query("device_mean_fill", f"""
SELECT event_id, DeviceId, {', '.join(
    f'round(coalesce({s}, avg({s}) OVER (PARTITION BY DeviceId)), 6) AS {s}' for s in SENSORS)}
FROM readings WHERE DeviceId IS NOT NULL""")
def device_mean_fill(t: Tables) -> DataFrame:
    return anomaly.fill_with_device_mean(t.readings()).select("event_id", "DeviceId", *SENSORS)


@query("nested_repair", """
SELECT event_id, device_id, round(coalesce(CASE WHEN temperature > 100 THEN 100.0::DOUBLE WHEN temperature < 0 THEN 0.0::DOUBLE ELSE temperature END,
    avg(temperature) OVER (PARTITION BY device_id)), 6) AS temperature, humidity, CAST(efficiency AS INT) AS efficiency
FROM nested WHERE device_id IS NOT NULL""")
def nested_repair(t: Tables) -> DataFrame:
    return anomaly.repair_nested(nested(t.readings())).select(
        "event_id", "device_id", "sensors.temperature", "sensors.humidity", "efficiency")


@query("sentinel_to_null", f"SELECT event_id, {', '.join(f'nullif({c}, -1) AS {c}' for c in MEASURES)} FROM readings")
def sentinel_to_null(t: Tables) -> DataFrame:
    return clean.drop_sentinels(t.readings()).select("event_id", *MEASURES)


@query("outlier_action_clip", f"SELECT event_id, {', '.join(map(_clip, MEASURES))} FROM readings")
def outlier_clip(t: Tables) -> DataFrame:
    return anomaly.treat_outliers(t.readings(), "clip").select("event_id", *MEASURES)


def _interpolated(c: str) -> str:
    return (f"CASE WHEN {c} IS NOT NULL THEN last_value(CASE WHEN {c} {_bounds(c)} THEN {c} END IGNORE NULLS) "
            f"OVER (PARTITION BY DeviceId, CASE WHEN DeviceId IS NULL THEN event_id END ORDER BY event_time, event_id) END AS {c}")


@query("outlier_action_interpolate", f"""
SELECT event_id, {', '.join(map(_interpolated, MEASURES))} FROM readings""")
def outlier_interpolate(t: Tables) -> DataFrame:
    return anomaly.treat_outliers(t.readings(), "interpolate").select("event_id", *MEASURES)


@query("outlier_action_flag", f"""
SELECT event_id, {', '.join(f'coalesce(NOT ({c} {_bounds(c)}), false) AS {c}_outlier' for c in MEASURES)} FROM readings""")
def outlier_flag(t: Tables) -> DataFrame:
    return anomaly.treat_outliers(t.readings(), "flag").select("event_id", *(f"{c}_outlier" for c in MEASURES))


@query("outlier_action_reject", f"""
SELECT {_ALL} FROM readings WHERE NOT ({' OR '.join(f'coalesce(NOT ({c} {_bounds(c)}), false)' for c in MEASURES)})""")
def outlier_reject(t: Tables) -> DataFrame:
    return anomaly.treat_outliers(t.readings(), "reject").select(*ROW)


# --- features ------------------------------------------------------------------------------------------------

@query("time_features", """
SELECT event_id, CAST(hour(event_time) AS INT) AS hour, CAST(dayofweek(event_time) + 1 AS INT) AS day_of_week,
  CASE WHEN dayofweek(event_time) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend FROM readings""")
def time_features(t: Tables) -> DataFrame:
    return clean.with_time_features(t.readings()).select("event_id", "hour", "day_of_week", "is_weekend")


@query("ratio_features", """
SELECT event_id, round(temperature / nullif(humidity, 0), 6) AS temp_humidity_ratio,
  round(efficiency / nullif(power, 0), 6) AS efficiency_power_ratio FROM nested""")
def ratio_features(t: Tables) -> DataFrame:
    return clean.with_ratio_features(nested(t.readings())).select(
        "event_id", "temp_humidity_ratio", "efficiency_power_ratio")


@query("feature_engineering", """
SELECT event_id, CAST(hour("timestamp") AS INT) AS hour, CAST(dayofweek("timestamp") + 1 AS INT) AS day_of_week,
  CASE WHEN dayofweek("timestamp") IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  round(temperature / nullif(humidity, 0), 6) AS temp_humidity_ratio,
  round(efficiency / nullif(power, 0), 6) AS efficiency_power_ratio,
  round(avg(temperature) OVER w, 6) AS temp_1h_avg, round(stddev_samp(temperature) OVER w, 6) AS temp_1h_std
FROM nested WHERE device_id IS NOT NULL
WINDOW w AS (PARTITION BY device_id ORDER BY "timestamp" RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)""")
def feature_engineering(t: Tables) -> DataFrame:
    featured = clean.with_ratio_features(clean.with_time_features(nested(t.readings()), "timestamp"))
    rolled = windows.rolling_mean_std(featured, "sensors.temperature", 3600, time="timestamp", key="device_id")
    return rolled.select(
        "event_id", "hour", "day_of_week", "is_weekend", "temp_humidity_ratio", "efficiency_power_ratio",
        "temp_1h_avg", "temp_1h_std")


@query("message_word_count", "SELECT doc_id, CAST(len(string_split(text, ' ')) AS INT) AS word_count FROM documents")
def message_word_count(t: Tables) -> DataFrame:
    return t.table("documents").select("doc_id", word_count("text").alias("word_count"))
