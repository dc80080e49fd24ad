"""Plans as they would be for large tables: broadcasts by size are switched off, so only checked ones remain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from sensorflow.operators import anomaly, quality, stats, windows
from sensorflow.sources.tables import Tables


@pytest.fixture
def large(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return re.findall(r"Exchange (\w+)", plan_of(df))


@pytest.mark.parametrize("name", [
    "transform_record", "detect_anomalies", "forward_fill", "rolling_hour", "iqr_outliers", "device_hour_stats",
    "completeness_by_field", "equipment_risk", "record_quality", "type_conformity", "sql_functions", "word_count"])
def test_no_python_in_the_plan(spark, small, name):
    plan = plan_of(registry.queries()[name](spark, small))
    assert "EvalPython" not in plan and "MapInPandas" not in plan and "CartesianProduct" not in plan
    assert "NestedLoop" not in plan


@pytest.mark.parametrize("name", [
    "clean_readings", "transform_record", "record_quality", "sensor_status", "motor_efficiency", "alert_records",
    "ingest_gate", "range_issues", "storage_route", "threshold_join_check", "json_decode", "anomaly_score"])
def test_row_wise_work_does_not_shuffle(large, small, name):
    assert not [e for e in exchanges(registry.queries()[name](large, small)) if e == "hashpartitioning"]


def final_plan_of(df):
    df.collect()
    return plan_of(df).split("Initial Plan")[0]


def test_rows_are_shuffled_once_by_chunk(large, small):
    plan = final_plan_of(windows.forward_fill(Tables(large, small).readings()))
    shuffles = re.findall(r"[^d]Exchange hashpartitioning\(([^)]*)\)", plan)
    # rows by chunk, carry by chunk, and the partial aggregate, which is made once and read twice
    assert sum("_part" in s for s in shuffles) == 4 and plan.count("ReusedExchange") == 1
    # windows that go over a device see one row per group of chunks
    assert all("_group" in plan[at.start():at.start() + 1500] for at in re.finditer(r"hashpartitioning\(DeviceId#\d+, \d+\)", plan))


@pytest.mark.parametrize("name", ["forward_fill", "iqr_outliers", "interval_check", "sustained_high", "no_data_gaps", "temporal_order"])
def test_ordered_operators_run_nothing_before_they_are_asked(spark, small, name):
    jobs = lambda: len({*spark.sparkContext.statusTracker().getJobIdsForGroup(None)})
    before = jobs()
    registry.queries()[name](spark, small)
    assert jobs() - before <= 1  # the footer of the table


@pytest.mark.parametrize("name", ["json_decode", "reconcile_loss"])
def test_a_payload_is_parsed_once(spark, small, name):
    assert plan_of(registry.queries()[name](spark, small)).split("Initial Plan")[0].count("from_json") == 1


@pytest.mark.parametrize("name", ["reconcile_loss", "lost_readings"])
def test_received_rows_are_not_broadcast(spark, small, name):
    plan = final_plan_of(registry.queries()[name](spark, small))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_baselines_shuffle_only_partial_results(large, small):
    rows = Tables(large, small).readings().select(
        "event_id", "DeviceId", *(F.col(s).alias(f"{s}_clean") for s in ("sensor1", "sensor2", "sensor3")))
    plan = plan_of(anomaly.sigma_flags(rows))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Window" not in plan


def test_scan_reads_only_what_is_needed(spark, small):
    plan = plan_of(stats.failure_share(Tables(spark, small).readings()))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "value" not in schema and "ts" not in schema
    plan = plan_of(Tables(spark, small).table("events").filter(F.col("ts") > "2024-01-10").select("event_id"))
    assert "GreaterThan(ts" in plan


def test_reports_are_one_aggregate(spark, small):
    assert plan_of(quality.completeness(Tables(spark, small).readings().withColumn("time", F.col("event_time")))).count(
        "FileScan") == 1
    assert plan_of(quality.quality_report(Tables(spark, small).readings().withColumn("time", F.col("event_time")))).count(
        "FileScan") == 1


def test_top_rows_per_device_are_cut_before_the_shuffle(spark, small):
    assert plan_of(registry.queries()["ordered_first_n"](spark, small)).count("WindowGroupLimit") == 2
