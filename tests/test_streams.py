"""Streams over several micro-batches: late rows, copies, restarts, replays."""

import json

import pytest
from pyspark.sql import functions as F

from sensorflow.functions.quality import range_score
from sensorflow.schema import ENVELOPE, READING
from sensorflow.session import work_path
from sensorflow.sinks import layers
from sensorflow.sources import topics
from sensorflow.streaming import jobs

SCHEMA = "event_id bigint, event_time timestamp, DeviceId int, sensor1 double, sensor2 double, sensor3 double, " \
         "motor1 int, motor2 int, motor3 int, isFail boolean"


def land(spark, folder, batch, rows):
    """One landing file; `rows` are (id, second, device, sensor1)."""
    data = [(i, s, d, v, 50.0, 50.0, 1000, 1000, 1000, i % 3 == 0) for i, s, d, v in rows]
    df = spark.createDataFrame(data, SCHEMA.replace("event_time timestamp", "event_time bigint"))
    df.withColumn("event_time", F.timestamp_seconds("event_time")).coalesce(1).write.parquet(f"{folder}/b{batch}")


def stream(spark, folder):
    return topics.file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, "parquet", 1,
                              recursiveFileLookup="true")


def test_late_rows_and_windows(spark):
    root = work_path(spark, "late")
    land(spark, f"{root}/in", 0, [(1, 0, 1, 10.0), (2, 5, 1, 20.0)])
    sums = jobs.tumbling_statistics(stream(spark, f"{root}/in"), "10 seconds")
    run = lambda: jobs.to_end(jobs.table_layer(sums, f"{root}/out", f"{root}/cp"))
    run()
    land(spark, f"{root}/in", 1, [(3, 200, 1, 30.0)])      # moves the watermark to 140
    run()
    land(spark, f"{root}/in", 2, [(4, 6, 1, 99.0), (5, 145, 1, 40.0)])  # 6 is too late, 145 is not
    run()
    land(spark, f"{root}/in", 3, [(6, 1000, 1, 50.0)])
    run()
    run()                                                   # nothing new: nothing is written again
    out = spark.read.parquet(f"{root}/out").orderBy("window_start")
    assert [(r.readings, r.sensor1_avg) for r in out.collect()] == [(2, 15.0), (1, 40.0), (1, 30.0)]


def test_copies_within_the_watermark(spark):
    root = work_path(spark, "copies")
    land(spark, f"{root}/in", 0, [(1, 1000, 1, 1.0), (2, 1000, 1, 2.0), (3, 1000, 2, 3.0)])
    unique = jobs.without_copies(stream(spark, f"{root}/in"))
    run = lambda: jobs.to_end(jobs.table_layer(unique, f"{root}/out", f"{root}/cp"))
    run()
    land(spark, f"{root}/in", 1, [(4, 1000, 1, 4.0), (5, 1001, 1, 5.0)])
    run()
    out = spark.read.parquet(f"{root}/out")
    assert out.count() == 3 and out.select("DeviceId", "event_time").distinct().count() == 3


def test_sessions_close_after_the_gap(spark):
    root = work_path(spark, "sessions")
    land(spark, f"{root}/in", 0, [(1, 0, 1, 1.0), (2, 100, 1, 1.0), (3, 1000, 1, 1.0)])
    found = jobs.sessions(stream(spark, f"{root}/in"))
    jobs.to_end(jobs.table_layer(found, f"{root}/out", f"{root}/cp"))
    rows = spark.read.parquet(f"{root}/out").collect()
    assert [r.readings for r in rows] == [2]
    assert (rows[0].session_end - rows[0].session_start).total_seconds() == 400


def test_upsert_keeps_the_newest_and_survives_replay(spark):
    root = work_path(spark, "upsert")
    for b, rows in enumerate([[(1, 0, 1, 1.0), (2, 0, 2, 2.0)], [(3, 10, 1, 3.0)], [(4, 5, 1, 4.0), (5, 20, 2, 5.0)]]):
        land(spark, f"{root}/in", b, rows)
    log = layers.UpsertLog(f"{root}/log", ("DeviceId",), ("event_time", "event_id"))

    def state(source):
        return sorted((r.DeviceId, r.event_id, r.sensor1) for r in source.read(spark).collect())

    jobs.to_end(jobs.each_batch(stream(spark, f"{root}/in"), log, f"{root}/cp", every=None, mode="update"))
    assert state(log) == [(1, 3, 3.0), (2, 5, 5.0)]
    # The same batches again, from a new checkpoint: the state does not change.
    jobs.to_end(jobs.each_batch(stream(spark, f"{root}/in"), log, f"{root}/cp2", every=None))
    assert state(log) == [(1, 3, 3.0), (2, 5, 5.0)]
    folded = log.compact(spark, f"{root}/folded")
    assert state(folded) == state(log)


def test_fan_out_is_idempotent(spark):
    root = work_path(spark, "fanout")
    land(spark, f"{root}/in", 0, [(1, 0, 1, 95.0), (2, 1, 2, 50.0)])
    land(spark, f"{root}/in", 1, [(4, 2, None, 50.0), (5, 3, 3, 50.0)])
    fan = layers.FanOut(f"{root}/layers")
    count = lambda name: spark.read.parquet(fan.path(name)).count()
    table = jobs.collected(stream(spark, f"{root}/in"), f"{root}/table", spark)
    for run in ("a", "a"):  # a batch that is run again replaces itself
        fan(table, 0, run)
        assert (count("raw"), count("processed"), count("quality")) == (4, 3, 3)
    jobs.to_end(jobs.each_batch(stream(spark, f"{root}/in"), fan, f"{root}/b", every=None))  # a new checkpoint adds
    assert (count("raw"), count("processed"), count("quality")) == (8, 6, 6)
    found = spark.read.json(fan.path("alerts")).collect()
    assert [(a.device_id, a.severity) for a in found] == [(1, "HIGH_WARNING")] * 2


def test_keyed_layer_over_two_checkpoints(spark):
    root = work_path(spark, "keyed")
    land(spark, f"{root}/in", 0, [(1, 0, 1, 95.0), (2, 1, 2, 50.0), (3, 1, 2, 60.0)])
    fan = layers.FanOut(f"{root}/layers", keys=("DeviceId", "event_time"), order=("event_id",))
    for name in ("a", "b"):
        jobs.to_end(jobs.each_batch(stream(spark, f"{root}/in"), fan, f"{root}/{name}", every=None))
    log = fan.processed()
    folded = log.compact(spark, f"{root}/folded")
    jobs.to_end(jobs.each_batch(stream(spark, f"{root}/in"), folded, f"{root}/c", every=None))
    for one in (log, folded):
        assert {(r.DeviceId, r.sensor1) for r in one.read(spark).collect()} == {(1, 95.0), (2, 60.0)}


def test_decoding_keeps_malformed_text(spark):
    good = {"time": "2024-01-01T00:00:00", "DeviceId": 1, "sensor1": 1.5, "sensor2": "x", "motor1": 12.6,
            "isFail": False, "test_id": "extra"}
    rows = [(b"1", json.dumps(good).encode(), None), (b"2", b"not json", None)]
    decoded = topics.decode(topics.envelope(spark.createDataFrame(rows, ENVELOPE)))
    row = topics.malformed(decoded).filter("DeviceId is null").first()
    assert row[topics.CORRUPT] == "not json"
    first = decoded.first()
    assert (first.DeviceId, first.sensor1, first.sensor2, first.motor1) == (1, 1.5, None, 13)
    assert "test_id" not in decoded.columns


def test_console_and_alert_sinks_and_raw_layer(spark):
    root = work_path(spark, "sinks")
    land(spark, f"{root}/in", 0, [(1, 0, 1, 95.0), (2, 90_000, 2, 50.0)])
    source = stream(spark, f"{root}/in")
    shown = jobs.to_end(jobs.console(source.select("event_id"), f"{root}/c1", every=None))
    assert "Console" in shown.recentProgress[0].sink.description and shown.recentProgress[0].numInputRows == 2
    jobs.to_end(jobs.alert_layer(source, f"{root}/alerts", f"{root}/c2", every=None))
    assert spark.read.json(f"{root}/alerts").count() == 2
    jobs.to_end(jobs.raw_layer(source, f"{root}/raw", f"{root}/c3", every=None))
    day = spark.read.parquet(f"{root}/raw").filter("DeviceId = 2 and year = 1970 and month = 1 and day = 2")
    assert day.count() == 1


def test_progress_reports(spark):
    root = work_path(spark, "progress")
    land(spark, f"{root}/in", 0, [(1, 0, 1, 500.0), (2, 1, 2, 50.0)])
    seen = []
    listener = jobs.ProgressListener(seen.append)
    spark.streams.addListener(listener)
    source = jobs.observed(stream(spark, f"{root}/in"), range_score() == 0)
    run = jobs.to_end(jobs.table_layer(source, f"{root}/out", f"{root}/cp"))
    spark.streams.removeListener(listener)
    assert run.recentProgress
    with jobs.ProgressTable(spark, f"{root}/reports", every=1) as reports:
        jobs.to_end(jobs.table_layer(source, f"{root}/out2", f"{root}/cp2"))
    row, = reports.read().filter("input_rows > 0").collect()
    assert row.input_rows == 2 and row.error_share == 0.5


def test_stream_equals_batch(spark):
    root = work_path(spark, "parity")
    for b in range(3):
        land(spark, f"{root}/in", b, [(10 * b + i, 10 * b + i, i % 4, 30.0 * i) for i in range(8)])
    to_message = lambda df: df.select(
        F.col("DeviceId").cast("string").alias("key"), F.col("event_time").alias("timestamp"),
        F.to_json(F.struct(F.col("event_time").cast("string").alias("time"), *READING.names[1:])).alias("value"))
    batch = jobs.scored(to_message(spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/in")))
    found = jobs.collected(jobs.scored(to_message(stream(spark, f"{root}/in"))), f"{root}/work", spark)
    assert found.drop("processed_at").exceptAll(batch.drop("processed_at")).count() == 0
    assert found.count() == batch.count() == 24


def test_kafka_source_is_declared(spark):
    """The connector is not part of this environment; the call must get as far as looking for it."""
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.topic_stream(spark, "broker:9092", "readings", "earliest", 1000)
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.topic_batch(spark, "broker:9092", "readings")
    root = work_path(spark, "topic")
    land(spark, f"{root}/in", 0, [(1, 0, 1, 1.0)])
    with pytest.raises(Exception, match="(?i)kafka"):
        jobs.topic(topics.to_messages(stream(spark, f"{root}/in")), "broker:9092", "processed", f"{root}/cp", None)


def test_lost_rows_of_two_live_topics(spark):
    """Late, repeated and missing rows over several batches and restarts; each loss is told once, when its time has passed."""
    root = work_path(spark, "lost")
    rows = [(i, 10 * i, i % 3 if i % 7 else None, 1.0) for i in range(40)]
    lost = {5, 7, 21, 38}

    def deliver(batch, numbers, also=()):
        land(spark, f"{root}/sent", batch, [rows[i] for i in numbers])
        land(spark, f"{root}/came", batch, [rows[i] for i in numbers if i not in lost] + [rows[i] for i in also])

    deliver(0, range(20), also=[3, 3])
    found = jobs.lost(stream(spark, f"{root}/sent"), stream(spark, f"{root}/came"))
    run = lambda: jobs.to_end(jobs.table_layer(found, f"{root}/out", f"{root}/cp"))
    told = lambda: sorted(r.event_id for r in spark.read.schema(found.schema).parquet(f"{root}/out").collect())
    run()
    deliver(1, [*range(20, 25), *range(26, 32)], also=[3, 19, 19])
    run()
    deliver(2, [25, *range(32, 40)])  # 25 comes late on both sides
    run()
    assert set(told()) <= lost
    land(spark, f"{root}/sent", 3, [(100, 100_000, 1, 1.0)])
    run()
    assert 38 not in told()  # the other stream has not got that far yet
    for side in ("sent", "came"):  # Spark begins a run without the marks of either stream: both have to move on
        land(spark, f"{root}/{side}", 4, [(101, 100_010, 1, 1.0)])
    land(spark, f"{root}/came", 3, [(100, 100_000, 1, 1.0)])
    run()
    run()
    assert told() == sorted(lost)


def test_panes_give_the_same_windows(spark):
    root = work_path(spark, "panes")
    land(spark, f"{root}/in", 0, [(i, i * 37 % 4000, i % 3, None if i % 5 == 0 else float(i % 17)) for i in range(600)])
    source = stream(spark, f"{root}/in").filter("DeviceId IS NOT NULL")
    tables = [jobs.collected_whole(source, make, f"{root}/{n}") for n, make in enumerate((
        lambda df: jobs.sliding_by_panes(df, "30 minutes", "5 minutes"),
        lambda df: jobs.tumbling_statistics(df, "30 minutes", slide="5 minutes")))]
    rows = [sorted((r.window_start, r.window_end, r.DeviceId, r.readings, r.failures, r.sensor1_avg and round(r.sensor1_avg, 9)) for r in t.collect())
            for t in tables]
    assert rows[0] == rows[1] and len(rows[0]) > 20
