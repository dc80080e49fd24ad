"""Chunked windows against plain windows, with chunks forced to be tiny, hot spans and copies of one instant."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorflow.functions.basic import rounded
from sensorflow.operators import quantiles, timeline, windows
from sensorflow.operators.quantiles import percentile

CUTS = [
    {"span": timeline.HOUR // 2, "max_rows": 1_000_000},
    {"span": 60 * windows.SECOND, "max_rows": 25},
    {"span": 10**15, "max_rows": 10},
    {"span": 3 * windows.SECOND, "max_rows": None},  # thousands of chunks: many groups of them
]


@pytest.fixture(scope="module")
def rows(spark):
    """Three devices; one holds most rows, a fifth of all rows falls on one instant."""
    i = F.col("id")
    df = spark.range(0, 1500, 1, 4).select(
        i.alias("event_id"),
        F.when(i % 10 < 7, 1).when(i % 10 < 9, 2).otherwise(3).alias("DeviceId"),
        F.when(i % 5 == 0, F.lit(7_000)).otherwise(i * 37 % 9973).alias("second"),
        F.when(i % 7 == 3, None).otherwise((i * 31 % 500) / 10.0).alias("x"),
        (i % 11 == 0).alias("isFail"),
    )
    # Long runs of NULLs, so that a value must be carried over several chunks.
    df = df.withColumn("x", F.when(F.col("second").between(2000, 4000), None).otherwise(F.col("x")))
    return df.withColumn("event_time", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("second"))).persist()


def order():
    return W.partitionBy("DeviceId").orderBy("event_time", "event_id")


def same(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    right = right.select(*left.columns)
    a, b = sorted(map(repr, left.collect())), sorted(map(repr, right.collect()))
    assert len(a) == len(b)
    assert a == b


@pytest.mark.parametrize("cut", CUTS)
def test_split_keeps_every_row_and_order(rows, cut):
    chunks = timeline.chunked(rows, **cut)
    assert chunks.df.count() == rows.count()
    sizes = [r["count"] for r in chunks.df.groupBy(*chunks.columns).count().collect()]
    if cut["max_rows"] and cut["max_rows"] < 100:
        assert max(sizes) < 400 and len(sizes) > 5
    ranks = chunks.df.withColumn("by_chunk", F.row_number().over(
        W.partitionBy("DeviceId").orderBy("_cell", "_part", "_pos", "event_id")))
    ranks = ranks.withColumn("by_time", F.row_number().over(W.partitionBy("DeviceId").orderBy("_pos", "event_id")))
    assert ranks.filter("by_chunk <> by_time").count() == 0


def test_splits_grow_with_rows(spark):
    """Copies of one instant are cut by their tie; the longest chunk stays as it is while rows grow."""
    longest = []
    for n in (5_000, 40_000):
        df = spark.range(n).select(F.col("id").alias("event_id"), F.lit(1).alias("DeviceId"), F.timestamp_seconds(F.lit(7)).alias("event_time"))
        chunks = timeline.chunked(df, max_rows=500)
        sizes = [r["count"] for r in chunks.df.groupBy(*chunks.columns).count().collect()]
        longest.append(max(sizes))
        assert len(sizes) > n / 1_500
    assert longest[1] < 2_000


@pytest.mark.parametrize("cut", CUTS)
def test_forward_fill(rows, cut):
    plain = rows.withColumn("x", F.last("x", True).over(order().rowsBetween(W.unboundedPreceding, 0)))
    same(windows.forward_fill(rows, ["x"], **cut).select("event_id", "x"), plain.select("event_id", "x"))


@pytest.mark.parametrize("cut", CUTS)
def test_previous(rows, cut):
    found = windows.with_previous(rows, {"before": "event_id"}, **cut)
    plain = rows.withColumn("before", F.lag("event_id").over(order()))
    same(found.select("event_id", "before"), plain.select("event_id", "before"))


def test_rolling(rows):
    frame = W.partitionBy("DeviceId").orderBy(F.unix_micros("event_time")).rangeBetween(-1800 * 10**6, 0)
    plain = rows.select(
        "event_id", F.count("x").over(frame).alias("n"), rounded(F.avg("x").over(frame), 6).alias("mean"),
        rounded(F.stddev_samp("x").over(frame), 6).alias("std"))
    found = windows.rolling(rows, "x", 1800)
    same(found.select("event_id", "n", rounded("mean", 6).alias("mean"), rounded("std", 6).alias("std")), plain)


@pytest.mark.parametrize("x", ["0.123457D", "2.5e8D", "1e-9D", "77.7D"])
def test_rolling_of_constant_values_has_no_spread(spark, x):
    df = spark.range(500).select(
        F.col("id").alias("event_id"), F.lit(1).alias("DeviceId"), F.expr(x).alias("x"),
        F.timestamp_seconds(F.col("id") * 10).alias("event_time"))
    row = windows.rolling(df, "x", 300).filter("event_id > 0").agg(F.max("std"), F.min("mean"), F.max("mean")).first()
    assert row[0] == 0.0 and tuple(row)[1:] == pytest.approx((float(x[:-1]),) * 2)


@pytest.mark.parametrize("x", ["0.5 + (id % 2) * 2e-5", "id / 7D * 1e8", "CASE WHEN id % 3 = 0 THEN NULL ELSE sin(id) * 1e-7 END"])
def test_rolling_of_any_doubles(spark, x):
    """Also several readings of one instant, and ranges that end just at a reading."""
    df = spark.range(2000).select(
        F.col("id").alias("event_id"), (F.col("id") % 3).alias("DeviceId"), F.expr(x).alias("x"),
        F.timestamp_seconds(F.floor(F.col("id") / 5) * 20).alias("event_time"))
    frame = W.partitionBy("DeviceId").orderBy(F.unix_micros("event_time")).rangeBetween(-300 * 10**6, 0)
    plain = df.select("event_id", F.count("x").over(frame).alias("n"), F.avg("x").over(frame).alias("mean"),
                      F.stddev_samp("x").over(frame).alias("std"))
    found = {r.event_id: r for r in windows.rolling(df, "x", 300).collect()}
    for r in plain.collect():
        assert found[r.event_id].n == r.n
        assert found[r.event_id].mean == (r.mean if r.mean is None else pytest.approx(r.mean, rel=1e-9))
        assert found[r.event_id].std == (r.std if r.std is None else pytest.approx(r.std, rel=1e-9))


def test_rolling_reads_once(rows):
    plan = windows.rolling(rows, "x", 1800)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == rows._jdf.queryExecution().executedPlan().toString().count("Scan ")


@pytest.mark.parametrize("cut", CUTS)
def test_iqr_frames_reach_over_chunks(rows, cut):
    frame = order().rowsBetween(-19, 0)
    q = F.percentile("x", F.array(F.lit(0.25), F.lit(0.75))).over(frame)
    plain = rows.withColumn("q", q).select(
        "event_id", rounded(F.col("q")[0], 9).alias("x_q1"), rounded(F.col("q")[1], 9).alias("x_q3"))
    found = windows.iqr_outliers(rows, ["x"], rows=20, **cut)
    same(found.select("event_id", rounded("x_q1", 9).alias("x_q1"), rounded("x_q3", 9).alias("x_q3")), plain)


@pytest.mark.parametrize("cut", CUTS)
def test_sustained(rows, cut):
    stretch = F.sum(F.when(F.col("x") > 10, 0).otherwise(1)).over(order().rowsBetween(W.unboundedPreceding, 0))
    plain = (
        rows.withColumn("s", stretch).filter("x > 10").groupBy("DeviceId", "s")
        .agg(F.min("event_time").alias("started"), F.max("event_time").alias("ended"), F.count("*").alias("readings"))
        .filter(F.unix_micros("ended") - F.unix_micros("started") >= 20 * 10**6).drop("s"))
    found = windows.sustained(rows, F.col("x") > 10, 20, **cut)
    same(found.select("DeviceId", "started", "ended", "readings"), plain)


@pytest.mark.parametrize("cut", CUTS)
def test_order_violations(rows, cut):
    plain = rows.withColumn("out_of_order", F.coalesce(
        F.col("event_time") < F.lag("event_time").over(W.partitionBy("DeviceId").orderBy("event_id")), F.lit(False)))
    found = windows.order_violations(rows, "event_id", span=100, max_rows=cut["max_rows"])
    same(found.select("event_id", "out_of_order"), plain.select("event_id", "out_of_order"))


@pytest.mark.parametrize("q,accuracy", [(0.0, 50), (0.5, 50), (0.95, 50), (1.0, 50), (0.95, 10_000)])
def test_percentiles(rows, q, accuracy):
    between = percentile(rows, ["x"], q, "DeviceId", interpolate=True, accuracy=accuracy)
    same(between.select("DeviceId", F.round("x", 9).alias("x")),
         rows.groupBy("DeviceId").agg(F.round(F.percentile("x", q), 9).alias("x")))
    occurring = percentile(rows, ["x"], q, "DeviceId", accuracy=accuracy)
    same(occurring, rows.groupBy("DeviceId").agg(F.expr(f"percentile_disc({q}) within group (order by x)").alias("x")))


def test_percentile_of_many_different_doubles(spark):
    """Far more values than the sketch keeps; NaN and NULL do not count."""
    df = spark.range(200_000).select(F.when(F.col("id") % 7 == 0, float("nan")).when(F.col("id") % 11 == 0, None)
                                     .otherwise(F.sin("id") * 1e9).alias("x"), F.lit(1).alias("DeviceId"))
    for q in (0.05, 0.5, 0.95):
        found = percentile(df, ["x"], q, interpolate=True, accuracy=200).first().x
        assert found == pytest.approx(df.filter("NOT isnan(x)").agg(F.percentile("x", q)).first()[0], rel=1e-12)


@pytest.mark.parametrize("bracket", [[0.0, 0.01], [0.99, 1.0], [0.6, 0.4]])
def test_percentile_with_a_bracket_that_misses_the_rank(spark, monkeypatch, bracket):
    monkeypatch.setattr(quantiles, "_bracket", lambda q, accuracy: bracket)
    odd = F.when(F.col("id") % 50 == 0, float("-inf")).when(F.col("id") % 51 == 0, float("inf"))
    for x in (F.sin("id") * 1e9, odd.otherwise(F.cos("id")), F.lit(3.5), F.col("id") % 3):
        df = spark.range(5000).select(x.cast("double").alias("x"))
        for q in (0.0, 0.3, 0.95):
            found = percentile(df, ["x"], q, accuracy=200).first().x
            assert found == df.agg(F.expr(f"percentile_disc({q}) within group (order by x)")).first()[0]


def test_percentile_of_nothing(spark, rows):
    assert percentile(rows.filter("false"), ["x"], 0.5, "DeviceId").count() == 0


def test_rows_without_key_or_time_have_no_place(spark):
    df = spark.createDataFrame([(1, 1, None), (2, None, 5)], "event_id int, DeviceId int, s long")
    df = df.withColumn("event_time", F.timestamp_seconds("s"))
    assert windows.with_previous(df, {"b": "event_id"}).count() == 0


def test_latest_is_an_aggregate(rows):
    found = windows.latest_per_device(rows)
    plain = rows.withColumn("r", F.row_number().over(
        W.partitionBy("DeviceId").orderBy(F.desc("event_time"), F.desc("event_id")))).filter("r = 1").drop("r")
    same(found, plain)
