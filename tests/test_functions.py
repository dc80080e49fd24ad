"""Golden records and limits of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from sensorflow.functions import alerts, cleaning, quality, scoring
from sensorflow.functions.basic import rounded
from sensorflow.functions.sql import register_functions
from sensorflow.operators import clean, records
from sensorflow.schema import READING, WARNING_LIMITS_76
from sensorflow.sources.files import records as from_records

TIME = "2024-01-15T14:30:00"
GOLDEN = [
    # device, sensors, motors, failed -> status, efficiency, average, total, alerts, gate
    ((1, 45.5, 62.3, 78.9, 1200, 850, 1100, False), "NORMAL", 0.5790, 62.23, 3150, "", True),
    ((2, 85.2, 82.7, 95.5, 1850, 950, 1200, False), "WARNING", 0.4862, 87.80, 4000,
     "HIGH_SENSOR_VALUE|HIGH_MOTOR_VALUE", True),
    ((3, 95.8, 92.1, 140.2, 1950, 1200, 1650, True), "CRITICAL", 0.4660, 109.37, 4800,
     "HIGH_SENSOR_VALUE|HIGH_MOTOR_VALUE|DEVICE_FAILURE", False),
    ((1, 85.2, 92.7, 78.5, 1200, 850, 1100, False), "HIGH_WARNING", 0.3518, 85.47, 3150, "HIGH_SENSOR_VALUE", True),
    ((1, 85.0, 60.0, 120.0, 1200, 800, 1000, False), "WARNING", 0.4785, 88.33, 3000, "HIGH_SENSOR_VALUE", False),
]


def reading(spark, device=1, s1=50.0, s2=50.0, s3=50.0, m1=1000.0, m2=1000.0, m3=1000.0, failed=False, time=TIME):
    number = [None if x is None else float(x) for x in (s1, s2, s3, m1, m2, m3)]
    return from_records(spark, [(time, device, *number, failed)], READING)


def value(df, column):
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("record,status,efficiency,average,total,found,gate", GOLDEN)
def test_golden_records(spark, record, status, efficiency, average, total, found, gate):
    df = reading(spark, *record)
    analysis = alerts.consumer_analysis()
    row = df.select(
        scoring.sensor_status().alias("status"), rounded(scoring.motor_efficiency(), 4).alias("efficiency"),
        analysis["sensor_average"].alias("average"), analysis["motor_total"].alias("total"),
        F.array_join(analysis["alerts"], "|").alias("alerts"), analysis["status"].alias("state"),
        quality.passes_gate().alias("gate"), quality.record_quality().alias("q")).first()
    assert (row.status, row.efficiency, row.average, row.total) == (status, efficiency, average, total)
    assert (row.alerts, row.gate) == (found, gate)
    assert row.state == ("CRITICAL" if found else "NORMAL")
    assert (row.q.quality_score, row.q.total_checks, row.q.passed_checks, row.q.grade) == (1.0, 15, 15, "EXCELLENT")


@pytest.mark.parametrize("sensors,status", [
    ((90.0, 0, 0), "NORMAL"), ((90.01, 0, 0), "HIGH_WARNING"), ((81.0, 76.5, 0), "NORMAL"),
    ((81.01, 76.51, 0), "WARNING"), ((81.01, 0, 117.01), "WARNING"), ((0, 85.0, 130.0), "WARNING"),
    ((90.01, 85.01, 0), "CRITICAL"), ((0, 85.01, 130.0), "HIGH_WARNING"), ((None, 99, 99), "DATA_MISSING"),
])
def test_status_limits(spark, sensors, status):
    df = reading(spark, 1, *sensors)
    assert value(df, scoring.sensor_status()) == status


def test_lower_humidity_warning(spark):
    df = reading(spark, 1, 85, 76.2, 0)
    assert value(df, scoring.sensor_status()) == "NORMAL"
    assert value(df, scoring.sensor_status(warning=WARNING_LIMITS_76)) == "WARNING"


def test_efficiency_over_rated_speed_and_without_a_value(spark):
    assert value(reading(spark, m1=4000, m2=3000, m3=3600), scoring.motor_efficiency()) == pytest.approx(0.5)
    assert value(reading(spark, m1=None), scoring.motor_efficiency()) == 0.0
    assert value(reading(spark, m1=-5000, m2=0, m3=0), scoring.motor_efficiency()) == 0.0
    assert value(reading(spark, s1=200, s2=200, m1=2000, m2=1500, m3=1800), scoring.motor_efficiency()) == pytest.approx(0.35)


@pytest.mark.parametrize("status,efficiency,rate,level,score,factors", [
    ("CRITICAL", 0.2, 0.6, "CRITICAL", 1.0, ["sensor_status_critical", "low_motor_efficiency", "high_failure_rate"]),
    ("HIGH_WARNING", 0.5, 0.3, "HIGH", 0.65,
     ["sensor_status_high_warning", "reduced_motor_efficiency", "elevated_failure_rate"]),
    ("NORMAL", 0.9, 0.0, "MINIMAL", 0.0, []),
    ("DATA_MISSING", 0.9, 0.0, "LOW", 0.2, []),
    ("SOMETHING", 0.9, 0.2, "LOW", 0.2, []),
    ("WARNING", 0.6, 0.21, "LOW", 0.35, ["elevated_failure_rate"]),
])
def test_risk(spark, status, efficiency, rate, level, score, factors):
    df = spark.createDataFrame([(status, efficiency, rate)], "s string, e double, r double")
    row = value(df, scoring.equipment_risk("s", "e", "r"))
    assert (row.risk_level, row.risk_factors) == (level, factors)
    assert row.risk_score == pytest.approx(score)


@pytest.mark.parametrize("t,v,e,status", [
    (70, 2.5, 60, "WARNING"), (70.1, 0, 99, "CRITICAL"), (60, 2.0, 70, "CAUTION"), (50, 1.5, 80, "NORMAL"),
])
def test_equipment_status(spark, t, v, e, status):
    df = spark.createDataFrame([(float(t), float(v), float(e))], "t double, v double, e double")
    assert value(df, scoring.equipment_status("t", "v", "e")) == status


def test_maintenance_may_exceed_one_and_needs_all_inputs(spark):
    df = spark.createDataFrame([(100.0, 4.0, 0.0), (None, 4.0, 0.0)], "t double, v double, e double")
    full, empty = [r["m"] for r in df.select(scoring.maintenance_need("t", "v", "e").alias("m")).collect()]
    assert full.maintenance_score == pytest.approx(1.6) and full.recommended_action == "IMMEDIATE_MAINTENANCE"
    assert empty is None


@pytest.mark.parametrize("field,inside,outside", [
    ("s1", (0, 100), (-0.01, 100.000001)), ("s3", (0, 150), (-1, 150.01)), ("m1", (0, 2000), (-1, 2001)),
    ("m2", (0, 1500), (-1, 1501)), ("m3", (0, 1800), (-1, 1801)),
])
def test_range_ends(spark, field, inside, outside):
    name = {"s": "sensor", "m": "motor"}[field[0]] + field[1]
    for x in inside:
        assert value(reading(spark, **{field: x}), cleaning.in_range_or_null(name)) == x
    for x in outside:
        df = reading(spark, **{field: x})
        assert value(df, cleaning.in_range_or_null(name)) is None
        assert value(df, cleaning.out_of_range(name)) is True


@pytest.mark.parametrize("device,known", [(0, False), (1, True), (5, True), (6, False), (999, False)])
def test_known_devices(spark, device, known):
    assert clean.only_known_devices(reading(spark, device)).count() == int(known)


def test_record_quality_of_gaps_and_outliers(spark):
    q = value(reading(spark, s1=None, m1=5000), quality.record_quality())
    assert (q.total_checks, q.passed_checks) == (14, 12)
    assert q.issues == ["missing_sensor1", "invalid_motor1_range"] and q.grade == "GOOD"


def test_issue_texts(spark):
    assert value(reading(spark, 6, s1=101.5, m1=None), quality.range_issues()) == [
        "Missing field: motor1", "sensor1 out of range: 101.5 (expected 0-100)",
        "DeviceId out of range: 6 (expected 1-5)"]


def test_clipping_keeps_null(spark):
    df = spark.createDataFrame([(-5.0,), (50.0,), (500.0,), (None,)], "x double")
    assert [r.v for r in df.select(cleaning.clip("x", 0, 100).alias("v")).collect()] == [0.0, 50.0, 100.0, None]


def test_missing_failure_flag_is_false_and_keys_are_needed(spark):
    df = reading(spark, failed=None).union(reading(spark, device=None)).union(reading(spark, time=None))
    rows = records.transform(df).collect()
    assert len(rows) == 1 and rows[0].isFail is False and rows[0].quality_issues == ["missing_isFail"]


def test_bad_time_text_becomes_null(spark):
    df = reading(spark, time="2024-01-15T14:75:00")
    assert clean.clean(df).first().event_time is None


@pytest.mark.parametrize("payload,errors", [
    ('{"DeviceId":1,"sensor1":1,"sensor2":2.5,"sensor3":3,"motor1":1,"motor2":2,"motor3":3,"isFail":true}', []),
    ('{"DeviceId":"1","sensor1":"x","sensor2":2.5,"sensor3":3,"motor1":1.5,"motor2":2,"motor3":3,"isFail":0}',
     ["DeviceId must be integer", "isFail must be boolean", "sensor1 must be number", "motor1 must be integer"]),
    ("not json", None),
])
def test_type_errors(spark, payload, errors):
    df = spark.createDataFrame([(payload,)], "p string")
    found = value(df, quality.type_errors("p"))
    assert len(found) == 8 if errors is None else found == errors


def test_routing(spark):
    df = spark.createDataFrame([("ERROR",), ("CRITICAL",), ("WARNING",), ("INFO",), (None,)], "s string")
    assert [r.c for r in df.select(alerts.channels("s").alias("c")).collect()] == [
        ["email", "chat"], ["email", "chat"], ["chat"], ["log"], ["log"]]
    assert value(df.limit(1), alerts.alert_text(F.lit(None), F.lit("hot"))) == "Device Unknown: hot"


def test_log_levels(spark):
    df = spark.createDataFrame([("low",), ("medium",), ("high",), ("critical",)], "s string")
    rows = df.select(alerts.log_level("s").alias("l"), alerts.raises_alert("s").alias("a")).collect()
    assert [tuple(r) for r in rows] == [("INFO", False), ("WARNING", False), ("ERROR", True), ("CRITICAL", True)]


def test_sql_functions_agree(spark):
    register_functions(spark)
    df = reading(spark).limit(0)
    for record, *_ in GOLDEN:
        df = df.union(reading(spark, *record))
    both = df.select(
        scoring.sensor_status().alias("a"), F.expr("classify_sensor_status(sensor1, sensor2, sensor3)").alias("b"),
        scoring.motor_efficiency().alias("c"),
        F.expr("calculate_motor_efficiency(motor1, motor2, motor3, sensor1, sensor2)").alias("d")).collect()
    assert all(r.a == r.b and r.c == pytest.approx(r.d) for r in both)
    risks = spark.createDataFrame(
        [("CRITICAL", 0.2, 0.6), ("WARNING", 0.5, 0.3), ("NORMAL", 0.9, 0.0)], "s string, e double, f double")
    pairs = risks.select(scoring.equipment_risk("s", "e", "f").alias("a"), F.expr("assess_equipment_risk(1, s, e, f, 0D)").alias("b"))
    assert all(r.a == r.b for r in pairs.collect())
    z = spark.createDataFrame([(1.5, -9.0, None), (None, None, None)], "a double, b double, c double")
    score = scoring.outlier_score({"sensor1": F.col("a"), "sensor2": F.col("b"), "sensor3": F.col("c")})
    assert [tuple(r) for r in z.select(score, F.expr("calculate_outlier_score(a, b, c)")).collect()] == [(1.0, 1.0), (0.0, 0.0)]


def test_nested_sql_functions_agree(spark):
    register_functions(spark)
    values = (None, 0.0, 1.2, 2.2, 2.7, 55.0, 65.0, 71.0, 79.0, 95.0)
    df = spark.createDataFrame([(t, h, v, e) for t in values for h in (None, 61.0) for v in values[:5] for e in values],
                               "t double, h double, v double, e double")
    pairs = df.select(
        F.struct(scoring.equipment_status("t", "v", "e"), scoring.anomaly_score("t", "h", "v", "e"),
                 scoring.maintenance_need("t", "v", "e")).alias("a"),
        F.expr("struct(classify_equipment_status(t, v, e), calculate_anomaly_score(t, h, v, e), predict_maintenance_need(t, v, e, 10D))")
        .alias("b"))
    assert all(tuple(r.a) == tuple(r.b) for r in pairs.collect())
