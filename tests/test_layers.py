"""Files: layouts, codecs, pruning, compaction, retention."""

import os

import pytest
from pyspark.sql import functions as F

from sensorflow.operators import anomaly, joins, quality, records, stats
from sensorflow.schema import CODEC_BY_LAYER, READING
from sensorflow.session import shared_folder, work_path
from sensorflow.sinks import layers
from sensorflow.sources import files
from sensorflow.sources.tables import Tables


def test_log_files_of_the_collector(spark, tmp_path):
    for device, day in ((1, "20240101"), (1, "20240102"), (2, "20240101")):
        (tmp_path / str(device)).mkdir(exist_ok=True)
        (tmp_path / str(device) / f"{day}.log").write_text(
            f'{{"time":"2024-01-01T00:00:00","DeviceId":{device},"sensor1":1.5,"isFail":false}}\n' * 2)
    found = files.json_lines(spark, str(tmp_path)).groupBy("file_device", "file_day").count().collect()
    assert sorted(map(tuple, found)) == [("1", "20240101", 2), ("1", "20240102", 2), ("2", "20240101", 2)]


def test_layer_reads_only_the_named_partitions(spark, small):
    path = work_path(spark, "layer")
    layers.write_layer(layers.with_date_parts(Tables(spark, small).readings()), path, layers.DAY_PARTS, codec="gzip")
    day = files.layer(spark, path, F.col("day") <= 2, DeviceId=3, year=2024)
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(" in plan and "DeviceId" in plan.split("PartitionFilters")[1][:200]
    assert {(r.DeviceId, r.day) for r in day.select("DeviceId", "day").distinct().collect()} <= {(3, 1), (3, 2)}
    assert layers.data_files(day) <= 2


@pytest.mark.parametrize("layer,codec", CODEC_BY_LAYER.items())
def test_codecs(spark, layer, codec):
    path = work_path(spark, layer)
    layers.write_layer(spark.range(100), path, codec=codec)
    assert spark.read.parquet(path).count() == 100
    assert any(codec in name or codec[:2] in name for name in os.listdir(path) if name.endswith("parquet"))


def test_compaction_keeps_rows(spark, small):
    source, target = work_path(spark, "many"), work_path(spark, "few")
    rows = layers.with_date_parts(Tables(spark, small).readings())
    rows.repartition(8).write.partitionBy("DeviceId").parquet(source)
    layers.compact(spark, source, target, ["DeviceId"])
    before, after = spark.read.parquet(source), spark.read.parquet(target)
    assert before.exceptAll(after.select(*before.columns)).count() == 0 and before.count() == after.count()
    assert layers.data_files(after) < layers.data_files(before)


def test_text_round_trip_and_report(spark):
    path = work_path(spark, "text")
    layers.write_text(spark.range(5), path, "id")
    assert sorted(r.value for r in files.text_lines(spark, path).collect()) == list("01234")
    path = work_path(spark, "report")
    layers.write_report(spark.range(3), path)
    assert len([f for f in os.listdir(path) if f.endswith(".json")]) == 1


def test_retention_splits_rows(spark, small):
    routed = records.routed(Tables(spark, small).readings())
    as_of, days = F.lit("2025-01-15").cast("date"), F.col("retention_days")
    gone, kept = records.expired(routed, as_of, days), records.retained(routed, as_of, days)
    assert gone.count() + kept.count() == routed.count()
    assert gone.filter("record_class = 'failed'").count() == 0


def test_small_table_is_broadcast_and_large_is_not(spark):
    rows = spark.range(1000).select((F.col("id") % 50).alias("k"))
    table = rows.groupBy("k").count()
    plan = lambda n: joins.join_derived(rows, table, "k", max_rows=n)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(100) and "strategy=broadcast" not in plan(10)


def test_reports_on_empty_input(spark):
    empty = spark.createDataFrame([], READING)
    assert {r.completeness_rate for r in quality.completeness(empty).collect()} == {0.0}
    assert quality.quality_report(empty).first().total_records == 0
    assert quality.duplicate_ratio(empty).first().duplicate_ratio == 0.0
    assert stats.run_summary(empty, F.lit(True)).first().success_rate == 0.0


def test_one_row_and_constant_devices_have_no_outliers(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (2, 7.0)], "DeviceId int, sensor1_clean double")
    df = df.withColumns({"sensor2_clean": F.col("sensor1_clean"), "sensor3_clean": F.col("sensor1_clean")})
    assert anomaly.anomalies(df).filter("sensor1_outlier or sensor1_high").count() == 0
    z = anomaly.whole_series_z(df, "sensor1_clean", "z").collect()
    assert [r.z for r in z] == [None, None, None]


def test_shared_folder_follows_the_session(spark):
    assert work_path(spark, "x").startswith(shared_folder(spark))
    assert work_path(spark, "x") != work_path(spark, "x")


def test_partition_profile(spark):
    found = stats.rows_per_partition(files.sequence(spark, 300, 6)).collect()
    assert sorted(r["rows"] for r in found) == [50] * 6
    assert stats.doubled_above(files.sequence(spark, 1000, 10)).first().n == 949


def test_stores_and_retention_of_a_layer(spark, small):
    readings = Tables(spark, small).readings()
    path = work_path(spark, "stores")
    layers.write_by_class(records.routed(readings), path)
    quarantine = files.layer(spark, path, storage="HDFS_QUARANTINE")
    assert quarantine.count() == records.routed(readings).filter("record_class = 'invalid'").count()
    source, target = work_path(spark, "raw"), work_path(spark, "raw-kept")
    layers.write_layer(layers.with_date_parts(readings), source, layers.DAY_PARTS)
    layers.retain_layer(spark, "raw", source, target, F.lit("2024-02-09").cast("date"))
    kept = spark.read.parquet(target)
    assert kept.agg(F.min("day")).first()[0] == 10
    assert kept.count() == readings.filter(F.col("event_time") >= "2024-01-10").count()
