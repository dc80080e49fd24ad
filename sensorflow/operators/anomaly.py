"""Outliers against per-device baselines.

The baseline is an aggregate with a map-side part (one row per device and task is shuffled) and comes back by a
broadcast whose size is checked. A window over the device would give the same numbers but move every row of a device
into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.basic import any_of, within
from sensorflow.functions.cleaning import clip, in_range_or_null, out_of_range
from sensorflow.functions.scoring import outlier_score
from sensorflow.operators.joins import join_derived
from sensorflow.operators.quantiles import percentile
from sensorflow.operators.windows import forward_fill
from sensorflow.schema import MEASURES, RANGES, SENSORS, Z_LIMITS


def baselines(df: DataFrame, columns=SENSORS, suffix: str = "", key: str = "DeviceId", p95: bool = True) -> DataFrame:
    """Mean and sample deviation of each column per device, and its 95th percentile (a value that occurs)."""
    stats = []
    for c in columns:
        value = F.col(c + suffix)
        stats += [F.avg(value).alias(f"{c}_mean"), F.stddev_samp(value).alias(f"{c}_std")]
    moments = df.groupBy(key).agg(*stats)
    if not p95:
        return moments
    high = percentile(df.select(key, *(F.col(c + suffix).alias(c) for c in columns)), columns, 0.95, key, suffix="_p95")
    return moments.join(high, key, "left")


def _with_baselines(df: DataFrame, key: str = "DeviceId", **kw) -> DataFrame:
    return join_derived(df, baselines(df, key=key, **kw), key)


def sigma_flag(value: Column, column: str, limit: float = 3) -> Column:
    far = F.abs(value - F.col(f"{column}_mean")) > limit * F.col(f"{column}_std")
    return F.coalesce(far, F.lit(False))


def z_score(value: Column, column: str) -> Column:
    return F.try_divide(value - F.col(f"{column}_mean"), F.col(f"{column}_std"))


def sigma_flags(df: DataFrame, suffix: str = "_clean", limit: float = 3) -> DataFrame:
    joined = _with_baselines(df, suffix=suffix, p95=False)
    flags = {f"{s}_outlier": sigma_flag(F.col(s + suffix), s, limit) for s in SENSORS}
    return joined.select(*df.columns, *(c.alias(n) for n, c in flags.items()))


def high_flags(df: DataFrame, suffix: str = "_clean") -> DataFrame:
    joined = _with_baselines(df, suffix=suffix)
    return joined.select(*df.columns, *(_above_p95(s, suffix) for s in SENSORS))


def _above_p95(sensor: str, suffix: str) -> Column:
    return F.coalesce(F.col(sensor + suffix) > F.col(f"{sensor}_p95"), F.lit(False)).alias(f"{sensor}_high")


def anomalies(df: DataFrame, suffix: str = "_clean") -> DataFrame:
    """The input plus three 95th percentiles, three 3-sigma flags and three high flags."""
    joined = _with_baselines(df, suffix=suffix)
    return joined.select(
        *df.columns, *(f"{s}_p95" for s in SENSORS),
        *(sigma_flag(F.col(s + suffix), s).alias(f"{s}_outlier") for s in SENSORS),
        *(_above_p95(s, suffix) for s in SENSORS),
    )


def field_z_scores(df: DataFrame, limits=Z_LIMITS, suffix: str = "") -> DataFrame:
    """z-score of each measure against its device, and the flag by the limit of the field."""
    joined = _with_baselines(df, columns=tuple(limits), suffix=suffix, p95=False)
    scores = {f"{c}_z": z_score(F.col(c + suffix), c) for c in limits}
    flags = {f"{c}_z_outlier": F.coalesce(F.abs(scores[f"{c}_z"]) > limits[c], F.lit(False)) for c in limits}
    return joined.select(*df.columns, *(c.alias(n) for n, c in {**scores, **flags}.items()))


def with_outlier_score(df: DataFrame, suffix: str = "_clean") -> DataFrame:
    joined = _with_baselines(df, suffix=suffix, p95=False)
    score = outlier_score({s: z_score(F.col(s + suffix), s) for s in SENSORS})
    return joined.select(*df.columns, score.alias("outlier_score"))


def whole_series_z(df: DataFrame, value: str, name: str, key: str = "DeviceId") -> DataFrame:
    stats = df.groupBy(key).agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_std"))
    joined = join_derived(df, stats, key)
    return joined.withColumn(name, F.try_divide(F.abs(F.col(value) - F.col("_mean")), F.col("_std"))).drop(
        "_mean", "_std")


def deviation_from_mean(df: DataFrame, columns, tolerance: float = 0.2, key: str = "DeviceId") -> DataFrame:
    """Marks values more than `tolerance` away from the device's own mean."""
    joined = _with_baselines(df, key=key, columns=tuple(columns), p95=False)
    flags = {}
    for c in columns:
        off = F.abs(F.try_divide(F.col(c).cast("double"), F.col(f"{c}_mean")) - 1) > tolerance
        flags[f"{c}_deviates"] = F.coalesce(off, F.lit(False))
    return joined.select(*df.columns, *(c.alias(n) for n, c in flags.items()))


def fill_with_device_mean(df: DataFrame, columns=SENSORS, key: str = "DeviceId") -> DataFrame:
    means = df.groupBy(key).agg(*(F.avg(c).alias(f"_{c}_mean") for c in columns))
    joined = join_derived(df, means, key, "inner")
    filled = {c: F.coalesce(F.col(c), F.col(f"_{c}_mean")) for c in columns}
    return joined.withColumns(filled).select(*df.columns)


def repair_nested(df: DataFrame, key: str = "device_id") -> DataFrame:
    """Nested readings: temperature clipped to 0-100, a missing one replaced by the mean of the device (of the values
    as they came), efficiency as a whole number."""
    means = df.groupBy(key).agg(F.avg("sensors.temperature").alias("_mean"))
    temperature = F.coalesce(clip("sensors.temperature", 0.0, 100.0), F.col("_mean"))
    repaired = join_derived(df, means, key, "inner").withColumns({
        "sensors": F.col("sensors").withField("temperature", temperature),
        "efficiency": F.col("efficiency").cast("int"),
    })
    return repaired.select(*df.columns)


def treat_outliers(df: DataFrame, action: str, columns=MEASURES, **cut) -> DataFrame:
    """What to do with values out of range: `clip` to the limits, `interpolate` by the last normal value, `flag`,
    or `reject` the row."""
    if action == "clip":
        return df.withColumns({c: clip(c, *RANGES[c]) for c in columns})
    if action == "flag":
        return df.withColumns({f"{c}_outlier": F.coalesce(out_of_range(c), F.lit(False)) for c in columns})
    if action == "reject":
        return df.filter(~any_of(F.coalesce(~within(c, RANGES[c]), F.lit(False)) for c in columns))
    if action == "interpolate":
        # Only outliers are replaced; a value that was NULL before stays so.
        normal = df.withColumns({f"_{c}_normal": in_range_or_null(c) for c in columns})
        # Without device or time a row has no place in an order and no value before it: its outliers become NULL.
        placed = F.col("DeviceId").isNotNull() & F.col("event_time").isNotNull()
        filled = forward_fill(normal.filter(placed), [f"_{c}_normal" for c in columns], **cut).unionByName(normal.filter(~placed))
        return filled.withColumns(
            {c: F.when(F.col(c).isNotNull(), F.col(f"_{c}_normal")) for c in columns}).select(*df.columns)
    raise ValueError(f"unknown action {action!r}")
