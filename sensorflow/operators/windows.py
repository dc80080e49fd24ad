"""Time-ordered operators per device, built on chunks (see `timeline`)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorflow.functions.basic import as_col, band, micros
from sensorflow.operators.timeline import (
    chunked, fill_forward, previous, running_total, with_last_rows,
)
from sensorflow.schema import IQR_FACTOR, IQR_ROWS, SENSORS

SECOND = 1_000_000


def forward_fill(df: DataFrame, columns=SENSORS, time: str = "event_time", **cut) -> DataFrame:
    """A missing value becomes the last value seen before it on the same device."""
    return fill_forward(chunked(df, time, **cut), columns).result()


def rolling(df: DataFrame, value: str, seconds: float, time: str = "event_time", key: str = "DeviceId") -> DataFrame:
    """Adds `n`, `total`, `mean` and `std` of `value` over the time range [t - seconds, t] of each row, per device.

    A sliding frame adds up its rows again for every row, which is quadratic for a busy device. Here time is cut into
    cells as long as the range, so a range is the end of one cell and the beginning of the next. Beginnings and ends are
    growing frames, which take each row once and only ever add, so nothing is taken out again and any double will do.
    Each row goes to its own cell with its beginning and, one range later, to the next cell with its end; there it is the
    nearest handed-on row at or after t that completes t. Moments are merged by the pairwise formula. Two shuffles by
    (device, cell), one scan; a task holds no more than the rows of a device within one range. Rows without key or time
    are left out.
    """
    length = int(seconds * SECOND)
    rows = df.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).withColumn("_pos", micros(time))
    rows = rows.withColumn("_cell", F.floor(F.col("_pos") / F.lit(length))).withColumn("_value", F.col(value).cast("double"))
    cell = W.partitionBy(key, "_cell")
    begin, end = (cell.orderBy(o).rangeBetween(W.unboundedPreceding, W.currentRow) for o in (F.asc("_pos"), F.desc("_pos")))
    rows = rows.withColumns({"_begin": _moments("_value", begin), "_end": _moments("_value", end)})
    # A reading from another cell only brings its end along; its own columns stay behind.
    own = F.struct(F.col("_cell").alias("at"), F.col("_pos").alias("place"), F.lit(True).alias("own"), F.lit(None).cast(rows.schema["_end"].dataType).alias("before"))
    handed = F.struct((F.col("_cell") + 1).alias("at"), (F.col("_pos") + length).alias("place"), F.lit(False).alias("own"), F.col("_end").alias("before"))
    kept = F.struct(*df.columns, "_begin")
    both = rows.select(F.col(key).alias("_key"), kept.alias("_row"), F.inline(F.array(own, handed))).withColumn(
        "_row", F.when(F.col("own"), F.col("_row")))
    nearest = W.partitionBy("_key", "at").orderBy(F.desc("place"), F.asc("own")).rowsBetween(W.unboundedPreceding, W.currentRow)
    found = both.withColumn("_before", F.last("before", ignorenulls=True).over(nearest)).filter("own")
    merged = _merged(F.col("_before"), F.col("_row._begin"))
    return found.select(merged.alias("_all"), "_row.*").withColumns({
        "n": F.col("_all.n"), "total": F.when(F.col("_all.n") > 0, F.col("_all.total")),
        "mean": F.try_divide("_all.total", "_all.n"),
        "std": F.when(F.col("_all.n") > 1, F.when((F.col("_all.low") == F.col("_all.high")) & ~F.isnan("_all.low"), 0.0).otherwise(
            F.sqrt(F.try_divide("_all.spread", F.col("_all.n") - 1)))),
    }).drop("_all", "_begin")


def _moments(value: str, frame) -> Column:
    """Number, sum, sum of squared distances from the mean, least and largest, of what is not NULL."""
    n = F.count(value).over(frame)
    return F.struct(
        n.alias("n"), F.coalesce(F.sum(value).over(frame), F.lit(0.0)).alias("total"),
        F.coalesce(F.var_pop(value).over(frame) * n, F.lit(0.0)).alias("spread"),
        F.min(value).over(frame).alias("low"), F.max(value).over(frame).alias("high"))


def _merged(a: Column, b: Column) -> Column:
    n_a, n_b = F.coalesce(a["n"], F.lit(0)), F.coalesce(b["n"], F.lit(0))
    n = n_a + n_b
    apart = F.coalesce(F.try_divide(a["total"], n_a) - F.try_divide(b["total"], n_b), F.lit(0.0))
    spread = F.coalesce(a["spread"], F.lit(0.0)) + b["spread"] + F.coalesce(apart * apart * F.try_divide(n_a.cast("double") * n_b, n), F.lit(0.0))
    return F.struct(
        n.alias("n"), (F.coalesce(a["total"], F.lit(0.0)) + b["total"]).alias("total"), spread.alias("spread"),
        F.least(a["low"], b["low"]).alias("low"), F.greatest(a["high"], b["high"]).alias("high"))


def rolling_mean_std(df: DataFrame, value: str, seconds: float = 3600, prefix: str = "temp_1h", **cut) -> DataFrame:
    ranged = rolling(df, value, seconds, **cut)
    return ranged.withColumnsRenamed({"mean": f"{prefix}_avg", "std": f"{prefix}_std"}).drop("n", "total")


def failure_rate(df: DataFrame, seconds: float = 300, **cut) -> DataFrame:
    """Failures per second x 100 over the last `seconds` (the dashboard's form), and the share of failed readings
    in percent with its band."""
    marked = df.withColumn("_failed", F.when(F.col("isFail"), 1).otherwise(0))
    ranged = rolling(marked, "_failed", seconds, **cut)
    percent = F.col("mean") * 100
    return ranged.withColumns({
        "failures_per_second_x100": F.col("total") / F.lit(float(seconds)) * 100,
        "failure_percent": percent,
        "failure_band": band(percent, [(5, "yellow"), (10, "red")], "green"),
    }).drop("_failed", "n", "total", "mean", "std")


def iqr_outliers(df: DataFrame, columns=SENSORS, rows: int = IQR_ROWS, factor: float = IQR_FACTOR,
                 time: str = "event_time", **cut) -> DataFrame:
    """Marks values outside [Q1 - factor x IQR, Q3 + factor x IQR] of the last `rows` readings of the device."""
    columns = list(columns)
    chunks = with_last_rows(chunked(df, time, **cut), columns, rows - 1)
    frame = chunks.window().rowsBetween(-(rows - 1), W.currentRow)
    # Sorting the values of a frame is several times faster than the percentile aggregate, which counts them in a map.
    lists = {f"_{c}_list": F.collect_list(c).over(frame) for c in columns}
    sorted_lists = {name: F.sort_array(name) for name in lists}
    marks = {}
    for c in columns:
        low, high = _of_sorted(F.col(f"_{c}_list"), 0.25), _of_sorted(F.col(f"_{c}_list"), 0.75)
        marks |= {f"{c}_q1": low, f"{c}_q3": high}
    df = chunks.df.withColumns(lists).filter(~F.col("_context")).withColumns(sorted_lists).withColumns(marks)
    outside = {}
    for c in columns:
        reach = (F.col(f"{c}_q3") - F.col(f"{c}_q1")) * factor
        low, high = F.col(f"{c}_q1") - reach, F.col(f"{c}_q3") + reach
        outside[f"{c}_iqr_outlier"] = F.coalesce((F.col(c) < low) | (F.col(c) > high), F.lit(False))
    return replace(chunks, df=df.withColumns(outside)).result("_context", *lists)


def _of_sorted(values: Column, q: float) -> Column:
    """Inclusive percentile of a sorted list; NULL for an empty one."""
    place = (F.size(values) - 1) * q
    below = F.floor(place).cast("int")
    first, second = F.get(values, below), F.get(values, below + 1)
    return first + F.coalesce((place - below) * (second - first), F.lit(0.0))


def latest_per_device(df: DataFrame, time: str = "event_time", tie: str = "event_id",
                      key: str = "DeviceId") -> DataFrame:
    """Newest row per device. The rank limit is applied before the shuffle, so one row per task and device travels."""
    newest = W.partitionBy(key).orderBy(F.desc(time), F.desc(tie))
    ranked = df.filter(F.col(key).isNotNull()).withColumn("_rank", F.row_number().over(newest))
    return ranked.filter("_rank = 1").drop("_rank")


def sustained(df: DataFrame, condition: Column, seconds: float = 120, time: str = "event_time", **cut) -> DataFrame:
    """Stretches of consecutive readings of a device that all meet the condition and last at least `seconds`."""
    chunks = chunked(df.withColumn("_met", F.coalesce(condition, F.lit(False))), time, **cut)
    chunks = running_total(chunks, {"_stretch": F.when(F.col("_met"), 0).otherwise(1).cast("long")})
    runs = (
        chunks.df.filter("_met").groupBy(chunks.key, "_stretch")
        .agg(F.min(time).alias("started"), F.max(time).alias("ended"), F.count("*").alias("readings"))
    )
    lasted = (micros("ended") - micros("started")) / F.lit(1e6)
    return runs.withColumn("seconds", lasted).filter(F.col("seconds") >= seconds).drop("_stretch")


def with_previous(df: DataFrame, columns: dict[str, str], **cut) -> DataFrame:
    return previous(chunked(df, **cut), columns).result()


def silent_gaps(df: DataFrame, window_seconds: float = 300, hold_seconds: float = 180, time: str = "event_time",
                **cut) -> DataFrame:
    """Gaps between two readings in which the window was empty for as long as the alarm is held back."""
    paired = with_previous(df, {"silent_from": time}, time=time, **cut)
    gap = (micros(time) - micros("silent_from")) / F.lit(1e6)
    return (
        paired.withColumn("gap_seconds", gap).filter(F.col("gap_seconds") >= window_seconds + hold_seconds)
        .withColumnRenamed(time, "silent_until")
    )


def order_violations(df: DataFrame, arrival: str, time: str = "event_time", span: int = 10_000, **cut) -> DataFrame:
    """Marks readings whose event time lies before that of the reading that arrived before them. The order is the
    arrival number, so `span` counts arrivals."""
    chunks = chunked(df, time, position=as_col(arrival).cast("long"), span=span, **cut)
    paired = previous(chunks, {"_earlier": time}).result()
    broken = F.coalesce(F.col(time) < F.col("_earlier"), F.lit(False))
    return paired.withColumn("out_of_order", broken).drop("_earlier")


def intervals(df: DataFrame, time: str = "event_time", **cut) -> DataFrame:
    """Seconds since the reading before, per device; NULL for the first."""
    paired = with_previous(df, {"_earlier": time}, time=time, **cut)
    return paired.withColumn("interval_seconds", (micros(time) - micros("_earlier")) / F.lit(1e6)).drop("_earlier")
