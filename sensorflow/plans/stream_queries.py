"""Queries over sinks and streams. A stream runs over all available input and is read back as a table."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.basic import event_time, rounded
from sensorflow.functions.quality import range_score
from sensorflow.operators import quality, records, stats
from sensorflow.plans.catalog import query
from sensorflow.plans.report_queries import _FILLED
from sensorflow.plans.source_queries import _VALID, FIELDS
from sensorflow.schema import CODEC_BY_LAYER
from sensorflow.session import work_path
from sensorflow.sinks import layers
from sensorflow.sinks.snapshots import SnapshotFanOut
from sensorflow.sources import files, topics
from sensorflow.sources.tables import Tables, messages, readings
from sensorflow.streaming import alarms, jobs

_CLASS = f"""CASE WHEN DeviceId IS NULL OR NOT ({' AND '.join(_VALID.values())}) THEN 'invalid'
    WHEN coalesce(isFail, false) THEN 'failed' ELSE 'normal' END"""


@query("storage_route", f"""
SELECT event_id, c AS record_class, CASE c WHEN 'normal' THEN 'HDFS_MAIN' WHEN 'failed' THEN 'HDFS_ALERT' ELSE 'HDFS_QUARANTINE' END AS storage,
  CASE c WHEN 'normal' THEN 365 WHEN 'failed' THEN 1095 ELSE 30 END AS retention_days, c = 'failed' AS alert_trigger,
  CASE WHEN c = 'failed' THEN 'HIGH' END AS priority, c = 'invalid' AS review_required
FROM (SELECT event_id, {_CLASS} AS c FROM readings)""")
def storage_route(t: Tables) -> DataFrame:
    return records.routed(t.readings()).select(
        "event_id", "record_class", "storage", "retention_days", "alert_trigger", "priority", "review_required")


@query("retention_expired", f"""
SELECT event_id, c AS record_class FROM (SELECT event_id, event_time, {_CLASS} AS c FROM readings)
WHERE CAST(event_time AS DATE) < DATE '2025-01-15' - CAST(CASE c WHEN 'normal' THEN 365 WHEN 'failed' THEN 1095 ELSE 30 END AS INT)""")
def retention_expired(t: Tables) -> DataFrame:
    routed = records.routed(t.readings())
    return records.expired(routed, F.lit("2025-01-15").cast("date"), F.col("retention_days")).select(
        "event_id", "record_class")


@query("compaction", "SELECT count(*) AS rows_before, count(*) AS rows_after, true AS fewer_files FROM readings")
def compaction(t: Tables) -> DataFrame:
    """Small files (one per device and day) to few of the advised size; the rows must stay the same."""
    small, large = work_path(t.spark, "small-files"), work_path(t.spark, "compacted")
    layers.write_layer(layers.with_date_parts(t.readings()), small, layers.DAY_PARTS)
    layers.compact(t.spark, small, large)
    before, after = files.layer(t.spark, small), files.layer(t.spark, large)
    fewer = layers.data_files(after) < layers.data_files(before)
    counts = before.agg(F.count("*").alias("rows_before"))
    both = counts.withColumn("_one", F.lit(1)).join(
        after.agg(F.count("*").alias("rows_after")).withColumn("_one", F.lit(1)), "_one")
    return both.drop("_one").withColumn("fewer_files", F.lit(fewer))


@query("topic_payload", """
SELECT event_id, CAST(DeviceId AS VARCHAR) AS "key", sensor1, motor1, isFail FROM readings""")
def topic_payload(t: Tables) -> DataFrame:
    sent = topics.to_messages(t.readings(), fields=["event_id", "DeviceId", "sensor1", "motor1", "isFail"])
    back = F.from_json("value", "event_id bigint, sensor1 double, motor1 int, isFail boolean")
    return sent.select("key", back.alias("v")).select("v.event_id", "key", "v.sensor1", "v.motor1", "v.isFail")


@query("text_sink", "SELECT event_type || ' ' || user_id AS value, count(*) AS n FROM events GROUP BY 1")
def text_sink(t: Tables) -> DataFrame:
    path = work_path(t.spark, "text-sink")
    layers.write_text(t.table("events").select(F.concat_ws(" ", "event_type", "user_id").alias("line")), path, "line")
    return files.text_lines(t.spark, path).groupBy("value").agg(F.count("*").alias("n"))


@query("report_json", _FILLED)
def report_json(t: Tables) -> DataFrame:
    path = work_path(t.spark, "report")
    report = quality.completeness(t.readings(), FIELDS, ("DeviceId", "event_time"))
    layers.write_report(report, path)
    return t.spark.read.schema(report.schema).json(path)


@query("codec_layers", """
SELECT 'raw' AS layer, 'gzip' AS codec, count(*) AS readings FROM readings UNION ALL
SELECT 'processed', 'snappy', count(*) FROM readings WHERE DeviceId IS NOT NULL UNION ALL
SELECT 'alerts', 'lz4', count(*) FROM status76 WHERE DeviceId IS NOT NULL
  AND (sensor_status IN ('CRITICAL', 'HIGH_WARNING') OR coalesce(isFail, false))""")
def codec_layers(t: Tables) -> DataFrame:
    """One layer per codec, each read back and counted."""
    source = t.readings()
    processed = records.process(source, time="event_time")
    parts = {"raw": source, "processed": processed, "alerts": records.alerts(processed, "event_time")}
    counted = []
    for name, df in parts.items():
        path, codec = work_path(t.spark, f"codec-{name}"), CODEC_BY_LAYER[name]
        layers.write_layer(df, path, codec=codec)
        counted.append(t.spark.read.parquet(path).agg(F.count("*").alias("readings")).select(
            F.lit(name).alias("layer"), F.lit(codec).alias("codec"), "readings"))
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


# --- streams -------------------------------------------------------------------------------------------------

def live(t: Tables, **options) -> DataFrame:
    return readings(t.stream("events", **options)).withColumn("event_time", F.col("event_time").cast("timestamp"))


def known(t: Tables) -> DataFrame:
    return live(t).filter(F.col("DeviceId").isNotNull())


def finished(t: Tables, df: DataFrame, name: str) -> DataFrame:
    return jobs.collected(df, work_path(t.spark, name), t.spark)


def whole(t: Tables, transform, name: str) -> DataFrame:
    return jobs.collected_whole(known(t), transform, work_path(t.spark, name))


@query("stream_enrich", """
SELECT event_id, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS "time", DeviceId, sensor1, sensor2, sensor3, motor1, motor2,
  motor3, isFail, CASE WHEN sensor1 BETWEEN 0 AND 100 AND sensor2 BETWEEN 0 AND 100 AND sensor3 BETWEEN 0 AND 150
    THEN 1.0::DOUBLE ELSE 0.0 END AS quality_score
FROM (SELECT * REPLACE (CASE WHEN event_id % 150 <> 120 THEN sensor1 END AS sensor1,
    CASE WHEN event_id % 150 NOT IN (120, 121) THEN motor1 END AS motor1) FROM readings) WHERE event_id % 150 NOT IN (0, 30, 60, 90)""")
def stream_enrich(t: Tables) -> DataFrame:
    return finished(t, jobs.scored(messages(live(t)), keep=["event_id"]), "enrich").drop("processed_at")


def _document_stream(t: Tables) -> DataFrame:
    return t.stream("documents").select(
        "doc_id", F.col("lang").cast("binary").alias("key"), F.col("text").cast("binary").alias("value"),
        F.current_timestamp().alias("timestamp"))


@query("stream_console_shape", """
SELECT doc_id, lang AS "key", n_chars AS characters, CAST(len(string_split(text, ' ')) AS INT) AS word_count
FROM documents WHERE true""")
def stream_console_shape(t: Tables) -> DataFrame:
    """What the console sink prints, written to a table instead: the console shows rows of the driver only."""
    shown = finished(t, jobs.message_view(_document_stream(t), keep=["doc_id"]), "console")
    return shown.select("doc_id", "key", F.length("value").cast("bigint").alias("characters"), "word_count")


@query("stream_keyword", """SELECT doc_id, lang AS "key", text AS value FROM documents WHERE contains(text, 'thing')""")
def stream_keyword(t: Tables) -> DataFrame:
    return finished(t, jobs.keyword_messages(_document_stream(t), "thing", keep=["doc_id"]), "keyword").drop("timestamp")


@query("malformed_quarantine", """
SELECT event_id, CASE event_id % 150 WHEN 0 THEN 'not json' WHEN 30 THEN '' WHEN 60 THEN '' WHEN 90 THEN '[1, 2]' END AS payload,
  event_id % 150 IN (0, 30, 60, 90) AS quarantined FROM readings""")
def malformed_quarantine(t: Tables) -> DataFrame:
    decoded = topics.decode(topics.envelope(messages(live(t)), keep=["event_id"]), keep=["event_id"])
    bad = finished(t, topics.malformed(decoded), "quarantine")
    good = finished(t, topics.well_formed(decoded), "accepted")
    return bad.select("event_id", F.col(topics.CORRUPT).alias("payload"), F.lit(True).alias("quarantined")).unionByName(
        good.select("event_id", F.lit(None).cast("string").alias("payload"), F.lit(False).alias("quarantined")))


@query("stream_fanout", """
SELECT 'raw' AS layer, DeviceId, count(*) AS readings FROM readings GROUP BY 2 UNION ALL
SELECT 'processed', DeviceId, count(*) FROM readings WHERE DeviceId IS NOT NULL GROUP BY 2 UNION ALL
SELECT 'alerts', DeviceId, count(*) FROM status76 WHERE DeviceId IS NOT NULL
  AND (sensor_status IN ('CRITICAL', 'HIGH_WARNING') OR coalesce(isFail, false)) GROUP BY 2 UNION ALL
SELECT 'quality', DeviceId, count(*) FROM readings WHERE DeviceId IS NOT NULL GROUP BY 2""")
def stream_fanout(t: Tables) -> DataFrame:
    root = work_path(t.spark, "fanout")
    fan = layers.FanOut(f"{root}/layers")
    jobs.to_end(jobs.each_batch(live(t), fan, f"{root}/checkpoint", every=None))
    device = {"raw": "DeviceId", "processed": "DeviceId", "alerts": "device_id", "quality": "device_id"}
    counted = None
    for name, column in device.items():
        kind = "json" if name == "alerts" else "parquet"
        reader = t.spark.read.format(kind)
        if name == "alerts":
            reader = reader.schema("device_id int")
        part = reader.load(fan.path(name)).groupBy(F.col(column).alias("DeviceId")).agg(F.count("*").alias("readings"))
        part = part.select(F.lit(name).alias("layer"), "DeviceId", "readings")
        counted = part if counted is None else counted.unionByName(part)
    return counted


@query("stream_raw_layer", """
SELECT DeviceId, CAST(year(event_time) AS INT) AS year, CAST(month(event_time) AS INT) AS month,
  CAST(day(event_time) AS INT) AS day, count(*) AS readings FROM readings GROUP BY ALL""")
def stream_raw_layer(t: Tables) -> DataFrame:
    root = work_path(t.spark, "raw-stream")
    jobs.to_end(jobs.raw_layer(live(t), f"{root}/raw", f"{root}/checkpoint", every=None))
    return files.layer(t.spark, f"{root}/raw").groupBy(*layers.DAY_PARTS).agg(F.count("*").alias("readings"))


@query("stream_upsert_latest", """
SELECT DeviceId, user_id, event_id, sensor1, isFail FROM (SELECT *, row_number() OVER (PARTITION BY DeviceId, user_id
  ORDER BY event_time DESC, event_id DESC) AS rn FROM readings WHERE DeviceId IS NOT NULL) WHERE rn = 1""")
def stream_upsert_latest(t: Tables) -> DataFrame:
    root = work_path(t.spark, "upsert")
    log = layers.UpsertLog(f"{root}/log", ("DeviceId", "user_id"), ("event_time", "event_id"))
    jobs.to_end(jobs.each_batch(known(t), log, f"{root}/checkpoint", every=None))
    return log.read(t.spark).select("DeviceId", "user_id", "event_id", "sensor1", "isFail")


_STATS = """count(*) AS readings, count(*) FILTER (isFail) AS failures, round(avg(sensor1), 6) AS sensor1_avg,
  round(avg(sensor2), 6) AS sensor2_avg, round(avg(sensor3), 6) AS sensor3_avg"""


@query("stream_stats_tumbling", f"""
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, DeviceId, {_STATS}
FROM (SELECT *, time_bucket(INTERVAL 10 MINUTE, event_time) AS window_start FROM readings WHERE DeviceId IS NOT NULL)
GROUP BY 1, 2, 3""")
def stream_stats_tumbling(t: Tables) -> DataFrame:
    return whole(t, lambda df: jobs.tumbling_statistics(df, "10 minutes"), "tumbling")


@query("stream_update_mode", f"""
SELECT window_start, DeviceId, {_STATS}
FROM (SELECT *, time_bucket(INTERVAL 10 MINUTE, event_time) AS window_start FROM readings WHERE DeviceId IS NOT NULL)
GROUP BY 1, 2""")
def stream_update_mode(t: Tables) -> DataFrame:
    """Open windows too, as they grow: each micro-batch brings the windows it changed, and the newest state of each is kept."""
    root = work_path(t.spark, "update")
    log = layers.UpsertLog(f"{root}/log", ("window_start", "DeviceId"), ("readings",))
    changed = jobs.tumbling_statistics(known(t), "10 minutes")
    for _ in range(2):  # the second run goes on from the checkpoint and finds nothing new
        jobs.to_end(jobs.each_batch(changed, log, f"{root}/checkpoint", every=None, mode="update"))
    return log.read(t.spark).drop("window_end")


@query("stream_timed_trigger", "SELECT DeviceId, count(*) AS readings FROM readings GROUP BY 1")
def stream_timed_trigger(t: Tables) -> DataFrame:
    """A raw layer by a query that wakes up every second, stopped when the input is read."""
    root = work_path(t.spark, "timed")
    jobs.until_read(jobs.raw_layer(live(t), f"{root}/raw", f"{root}/checkpoint", every="1 second"))
    return files.layer(t.spark, f"{root}/raw").groupBy("DeviceId").agg(F.count("*").alias("readings"))


@query("stream_sliding", f"""
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, DeviceId, {_STATS}
FROM (SELECT *, time_bucket(INTERVAL 1 MINUTE, event_time) - INTERVAL 1 MINUTE * shift AS window_start
      FROM readings, range(5) s(shift) WHERE DeviceId IS NOT NULL)
GROUP BY 1, 2, 3""")
def stream_sliding(t: Tables) -> DataFrame:
    return whole(t, lambda df: jobs.tumbling_statistics(df, "5 minutes", slide="1 minute"), "sliding")


@query("stream_sliding_hour", f"""
SELECT DeviceId, count(*) AS windows, CAST(sum(readings) AS BIGINT) AS readings, max(readings) AS most_readings,
  CAST(sum(failures) AS BIGINT) AS failures, round(avg(sensor1_avg), 6) AS sensor1_mean, round(max(sensor2_avg), 6) AS sensor2_most
FROM (SELECT window_start, DeviceId, {_STATS}
  FROM (SELECT *, time_bucket(INTERVAL 1 MINUTE, event_time) - INTERVAL 1 MINUTE * shift AS window_start
        FROM readings, range(60) s(shift) WHERE DeviceId IS NOT NULL) GROUP BY 1, 2) GROUP BY DeviceId""")
def stream_sliding_hour(t: Tables) -> DataFrame:
    """Every hour that begins with a minute, from panes of a minute; reported by device."""
    hours = whole(t, jobs.sliding_by_panes, "sliding-hour")
    return hours.groupBy("DeviceId").agg(
        F.count("*").alias("windows"), F.sum("readings").alias("readings"), F.max("readings").alias("most_readings"),
        F.sum("failures").alias("failures"), F.avg(rounded("sensor1_avg", 6)).alias("sensor1_mean"),
        F.max(rounded("sensor2_avg", 6)).alias("sensor2_most"))


@query("stream_lost_readings", """
SELECT event_id, DeviceId, event_time FROM readings WHERE event_id % 150 IN (0, 30, 60, 90)""")
def stream_lost_readings(t: Tables) -> DataFrame:
    """What was sent and did not come, from two live topics; what came, came twice."""
    def compared(df: DataFrame) -> DataFrame:
        came = topics.well_formed(topics.decode(topics.envelope(messages(df), keep=["event_id"]), keep=["event_id"]))
        came = came.select("event_id", "DeviceId", event_time(came, "time").alias("event_time"), F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
        return jobs.lost(df.select("event_id", "DeviceId", "event_time"), came)

    return jobs.collected_whole(live(t), compared, work_path(t.spark, "lost"))


@query("stream_dedup", "SELECT DISTINCT DeviceId, event_time FROM readings WHERE DeviceId IS NOT NULL")
def stream_dedup(t: Tables) -> DataFrame:
    """Every reading is delivered twice."""
    twice = known(t).select("DeviceId", "event_time", F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery"))
    return finished(t, jobs.without_copies(twice), "dedup").select("DeviceId", "event_time")


@query("stream_sessions", f"""
SELECT DeviceId, min(event_time) AS session_start, max(event_time) + INTERVAL 5 MINUTE AS session_end, count(*) AS readings
FROM (SELECT *, sum(fresh) OVER (PARTITION BY DeviceId ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS session
  FROM (SELECT *, CASE WHEN event_time - lag(event_time) OVER (PARTITION BY DeviceId ORDER BY event_time, event_id) < INTERVAL 5 MINUTE
          THEN 0 ELSE 1 END AS fresh FROM readings WHERE DeviceId IS NOT NULL))
GROUP BY DeviceId, session""")
def stream_sessions(t: Tables) -> DataFrame:
    return whole(t, jobs.sessions, "sessions")


@query("stream_silence", f"""
SELECT DeviceId, max(event_time) AS silent_from, max(event_time) + INTERVAL 8 MINUTE AS alarm_at
FROM (SELECT *, sum(fresh) OVER (PARTITION BY DeviceId ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS session
  FROM (SELECT *, CASE WHEN event_time - lag(event_time) OVER (PARTITION BY DeviceId ORDER BY event_time, event_id) < INTERVAL 8 MINUTE
          THEN 0 ELSE 1 END AS fresh FROM readings WHERE DeviceId IS NOT NULL))
GROUP BY DeviceId, session""")
def stream_silence(t: Tables) -> DataFrame:
    return whole(t, jobs.silence_alarms, "silence")


@query("stream_batch_parity", """
SELECT DeviceId, count(*) AS streamed, count(*) AS batched, true AS same FROM readings WHERE event_id % 150 NOT IN (0, 30, 60, 90) GROUP BY 1""")
def stream_batch_parity(t: Tables) -> DataFrame:
    """The same scoring on the stream and on the table; rows are compared as checksums per device."""
    columns = ["DeviceId", "time", "sensor1", "sensor2", "sensor3", "motor1", "motor2", "motor3", "isFail", "quality_score"]
    check = F.sum(F.xxhash64(*columns).cast("decimal(20,0)"))

    def summed(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("DeviceId").agg(F.count("*").alias(name), check.alias(f"_{name}"))

    stream = summed(finished(t, jobs.scored(messages(live(t))), "parity"), "streamed")
    batch = summed(jobs.scored(messages(t.readings())), "batched").withColumnRenamed("DeviceId", "_device")
    both = stream.join(batch, F.col("DeviceId").eqNullSafe(F.col("_device")), "full_outer")
    same = F.coalesce(F.col("_streamed") == F.col("_batched"), F.lit(False))
    return both.select("DeviceId", "streamed", "batched", same.alias("same"))


@query("stream_progress", """
SELECT CAST(count(*) AS BIGINT) AS input_rows, round(avg(CASE WHEN sensor1 BETWEEN 0 AND 100 AND sensor2 BETWEEN 0 AND 100
  AND sensor3 BETWEEN 0 AND 150 THEN 0.0::DOUBLE ELSE 1.0 END), 6) AS error_share, true AS timed FROM readings""")
def stream_progress(t: Tables) -> DataFrame:
    """Rows and error share over all micro-batches, from the reports that a listener wrote down."""
    root = work_path(t.spark, "progress")
    stream = jobs.observed(live(t), range_score() == 0)
    with jobs.ProgressTable(t.spark, f"{root}/progress") as reports:
        jobs.to_end(jobs.table_layer(stream, f"{root}/out", f"{root}/checkpoint"))
    rows = F.sum("input_rows")
    return reports.read().filter("input_rows > 0").agg(
        rows.alias("input_rows"), (F.sum(F.col("error_share") * F.col("input_rows")) / rows).alias("error_share"),
        F.coalesce(F.min("duration_ms") >= 0, F.lit(False)).alias("timed"))


@query("stream_two_checkpoints", """
SELECT 'raw' AS layer, count(*) * 2 AS readings FROM readings UNION ALL
SELECT 'processed', count(*) FROM (SELECT DISTINCT DeviceId, event_id FROM readings WHERE DeviceId IS NOT NULL) UNION ALL
SELECT 'compacted', count(*) FROM (SELECT DISTINCT DeviceId, event_id FROM readings WHERE DeviceId IS NOT NULL)""")
def stream_two_checkpoints(t: Tables) -> DataFrame:
    """The same readings by two queries with checkpoints of their own, the first started twice, into one set of layers."""
    root = work_path(t.spark, "two-runs")
    fan = layers.FanOut(f"{root}/layers", keys=("DeviceId", "event_id"), order=("event_time",))
    for name in ("a", "a", "b"):
        jobs.to_end(jobs.each_batch(live(t), fan, f"{root}/checkpoint-{name}", every=None))
    log = fan.processed()
    folded = log.compact(t.spark, f"{root}/compacted")
    tables = {"raw": t.spark.read.parquet(fan.path("raw")), "processed": log.read(t.spark), "compacted": folded.read(t.spark)}
    found = [df.agg(F.count("*").alias("readings")).select(F.lit(n).alias("layer"), "readings") for n, df in tables.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("no_data_alarms", """
WITH spaced AS (SELECT DeviceId, event_time AS silent_from, lead(event_time) OVER (PARTITION BY DeviceId ORDER BY event_time) AS back
  FROM readings WHERE DeviceId IS NOT NULL)
SELECT DeviceId, 'silent' AS kind, silent_from + INTERVAL 8 MINUTE AS "at", silent_from FROM spaced
WHERE back IS NULL OR back - silent_from >= INTERVAL 8 MINUTE
UNION ALL SELECT DeviceId, 'resumed', back, silent_from FROM spaced WHERE back - silent_from >= INTERVAL 8 MINUTE""")
def no_data_alarms(t: Tables) -> DataFrame:
    """State and timers of each device; the query goes on from its checkpoint with a tick after the last reading."""
    return whole(t, alarms.no_data_alarms, "no-data")


@query("stream_snapshot_layers", """
SELECT 'raw' AS layer, count(*) * 2 AS readings FROM readings UNION ALL
SELECT 'raw, first version', count(*) FROM readings UNION ALL
SELECT 'processed', count(*) FROM (SELECT DISTINCT DeviceId, event_id FROM readings WHERE DeviceId IS NOT NULL) UNION ALL
SELECT 'processed, device 1', count(*) FROM (SELECT DISTINCT event_id FROM readings WHERE DeviceId = 1) UNION ALL
SELECT 'processed, packed', count(*) FROM (SELECT DISTINCT DeviceId, event_id FROM readings WHERE DeviceId IS NOT NULL) UNION ALL
SELECT 'quality', count(*) * 2 FROM readings WHERE DeviceId IS NOT NULL""")
def stream_snapshot_layers(t: Tables) -> DataFrame:
    """The same readings by two queries with checkpoints of their own, the first started twice, in one set of snapshots."""
    root = work_path(t.spark, "snapshots")
    fan = SnapshotFanOut(f"{root}/layers", ("DeviceId", "event_id"), ("event_time",), buckets=2)
    for name in ("a", "a", "b"):
        jobs.to_end(jobs.each_batch(live(t), fan, f"{root}/checkpoint-{name}", every=None))
    held = fan.snapshots(t.spark)
    tables = {"raw": held.read("raw"), "raw, first version": held.read("raw", 1), "processed": held.read("processed"),
              "processed, device 1": held.read("processed", DeviceId=1), "quality": held.read("quality")}
    held.compact("processed")
    tables["processed, packed"] = held.read("processed")
    found = [df.agg(F.count("*").alias("readings")).select(F.lit(n).alias("layer"), "readings") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, found)


@query("live_throughput", """
SELECT time_bucket(INTERVAL 1 MINUTE, event_time) AS window_start, count(*) AS messages,
  round(count(*) / 60.0::DOUBLE, 6) AS messages_per_second FROM readings GROUP BY 1""")
def live_throughput(t: Tables) -> DataFrame:
    out = finished(t, live(t).select("event_id", "event_time"), "throughput")
    return stats.rate_per_window(out, 60)
