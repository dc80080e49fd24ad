"""No-data alarms: readings in any order, over micro-batches and restarts, against a plain scan."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sensorflow.session import work_path
from sensorflow.sources import topics
from sensorflow.streaming import alarms, jobs

QUIET = 100


def land(spark, folder, batch, rows):
    df = spark.createDataFrame(rows, "DeviceId string, second double, note string").withColumn("event_time", F.timestamp_micros((F.col("second") * 1e6).cast("long")))
    df.drop("second").coalesce(1).write.parquet(f"{folder}/b{batch}")


def runner(spark, root, clock=False):
    kind = spark.createDataFrame([], "DeviceId string, note string, event_time timestamp").schema
    source = topics.file_stream(spark, f"{root}/in", kind, "parquet", 1, recursiveFileLookup="true")
    ticks = topics.file_stream(spark, f"{root}/ticks", kind, "parquet", 1, recursiveFileLookup="true").select("event_time") if clock else None
    found = alarms.no_data_alarms(source, ticks, QUIET - 40, 40, "60 seconds")
    return lambda: jobs.to_end(jobs.table_layer(found, f"{root}/out", f"{root}/cp"))


def found(spark, root):
    rows = spark.read.parquet(f"{root}/out").select("DeviceId", "kind", F.unix_micros("at") / 1e6, F.unix_micros("silent_from") / 1e6)
    return sorted(map(tuple, rows.collect()))


def plain(readings, end):
    made = []
    for device in {d for d, _ in readings if d is not None}:
        times = sorted(t for d, t in readings if d == device)
        for t, after in zip(times, [*times[1:], None], strict=True):
            if after is not None and after - t >= QUIET:
                made += [(device, "silent", t + QUIET, t), (device, "resumed", after, t)]
            elif after is None and t + QUIET <= end:
                made.append((device, "silent", t + QUIET, t))
    return sorted(made)


def test_every_device_falls_silent_and_comes_back(spark):
    root = work_path(spark, "silent")
    land(spark, f"{root}/in", 0, [("a", 0.0, ""), ("a", 50.0, ""), ("b", 10.0, ""), ("a", 149.5, "")])
    land(spark, f"{root}/ticks", 0, [(None, 20.0, "")])
    run = runner(spark, root, clock=True)
    run()
    assert found(spark, root) == []
    land(spark, f"{root}/ticks", 1, [(None, 400.0, "")])  # nobody sends; only the clock goes on
    run()
    silent = [("a", "silent", 249.5, 149.5), ("b", "silent", 110.0, 10.0)]
    assert found(spark, root) == silent
    land(spark, f"{root}/ticks", 2, [(None, 900.0, "")])
    run()
    assert found(spark, root) == silent  # one alarm a silence
    land(spark, f"{root}/in", 1, [("b", 1000.25, ""), ("b", 950.0, "")])
    run()
    land(spark, f"{root}/ticks", 3, [(None, 1030.0, "")])
    run()
    assert found(spark, root) == sorted([*silent, ("b", "resumed", 950.0, 10.0)])


def test_any_order_of_batches(spark):
    pick = random.Random(2)
    at = sorted(pick.uniform(0, 20_000) for _ in range(300))
    readings = [(pick.choice(["a", "b", "c", None]), round(t * 4) / 4) for t in at]
    readings += [("hot", float(t)) for t in range(0, 5_000, 5)] * 2
    late = sorted(((t + pick.uniform(0, 25), d, t) for d, t in readings), key=lambda r: r[0])  # within the allowed delay
    root = work_path(spark, "order")
    run = None
    for batch in range(6):
        land(spark, f"{root}/in", batch, [(d, t, "") for _, d, t in late[batch * 384:(batch + 1) * 384]])
        run = run or runner(spark, root)
        if batch % 2:
            run()  # goes on from its checkpoint
    land(spark, f"{root}/in", 6, [(None, 30_000.0, "")])
    run()
    assert found(spark, root) == plain(readings, 29_940)


def test_late_rows_do_not_undo_an_alarm():
    assert alarms.settle([(150, 160)], 100, 100, 1000) == ([], [], 100)
    assert alarms.settle([(150, 250)], 100, 100, 210) == ([("resumed", 200, 100)], [(200, 250)], None)
    assert alarms.merged([(5, 9), (0, 4), (200, 201), (7, 30)], 100) == [(0, 30), (200, 201)]


def test_a_busy_device_travels_as_spells():
    keys, at = pa.array(["a", None, "a", "b", "a", None]), pa.array([0, 5, 99, 7, 199, 500])
    made = pa.Table.from_batches(alarms._shrink(100)(iter([pa.record_batch([keys, at], names=["key", "at"])])))
    assert sorted(map(str, zip(*(c.to_pylist() for c in made.columns), strict=True))) == sorted(
        map(str, [("a", 0, 99), ("a", 199, 199), ("b", 7, 7), (None, 5, 500)]))


@pytest.mark.parametrize("keys", [[1, 2, 1], [None, None, None]])
def test_numbers_as_keys(keys):
    batch = pa.record_batch([pa.array(keys, pa.int32()), pa.array(np.array([0, 1, 2]))], names=["key", "at"])
    assert sum(b.num_rows for b in alarms._shrink(100)(iter([batch]))) == len(set(keys))
