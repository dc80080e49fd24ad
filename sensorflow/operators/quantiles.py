"""Exact percentiles per device: a sketch says where to look, counts say where the rank is, and only what lies there is ranked.

A mergeable sketch per device and column brackets the wanted rank between two values. The bracket, what lies below it and
what lies above it are cut into BINS equal bins each, and rows are counted by bin, map-side, so at most 3 x BINS numbers of a
series leave a task. The counts are exact: they tell the bin that holds the rank wherever it lies, also outside the bracket.
The values of this bin are counted by value and ranked by running totals. A bracket holds about a thousandth of the rows of
a series, so a bin holds about one in four million where the values are spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorflow.operators.joins import join_derived

ACCURACY = 10_000
SLACK = 5  # ranks looked at on either side, in units of the sketch's error
BINS = 4096


def _bracket(q: float, accuracy: int) -> list[float]:
    reach = SLACK / accuracy
    return [max(0.0, q - reach), min(1.0, q + reach)]


def _bin(value: Column, low: Column, high: Column) -> Column:
    """Which of BINS equal parts of [low, high] a value lies in; never falls as values rise. 0 where a width is not finite."""
    part = F.coalesce(F.nanvl(F.try_divide(value - low, high - low), F.lit(0.0)), F.lit(0.0))
    return F.least(F.floor(part * BINS), F.lit(BINS - 1).cast("long"))


def percentile(df: DataFrame, columns, q: float, key: str | None = None, interpolate: bool = False,
               suffix: str = "", accuracy: int = ACCURACY) -> DataFrame:
    """One row per key with the percentile of every column under its own name plus `suffix`. The result is a value
    that occurs, or with `interpolate` the inclusive percentile between its two neighbours. NULL and NaN do not count.
    `accuracy` sets the size of the sketch and of the bracket, not the result."""
    columns, keys = list(columns), [key] if key else []
    items = [F.struct(F.lit(c).alias("_name"), F.col(c).cast("double").alias("_value")) for c in columns]
    values = df.select(*keys, F.inline(F.array(*items))).filter(F.col("_value").isNotNull() & ~F.isnan("_value"))
    series = [*keys, "_name"]
    ends = F.percentile_approx("_value", _bracket(q, accuracy), accuracy)
    brackets = values.groupBy(*series).agg(
        F.count("*").alias("_total"), ends.alias("_ends"), F.min("_value").alias("_least"), F.max("_value").alias("_most"))
    many = F.col("_total") > accuracy  # else the bracket is narrower than a rank, and there is little to rank
    place = (F.col("_total") - 1) * q + 1 if interpolate else F.greatest(F.ceil(F.col("_total") * q), F.lit(1))
    brackets = brackets.select(*series, "_least", "_most", place.cast("double").alias("_place"),
        F.when(many, F.col("_ends")[0]).otherwise(F.col("_least")).alias("_low"),
        F.when(many, F.col("_ends")[1]).otherwise(F.col("_most")).alias("_high"))
    value, least, low, high, most = map(F.col, ("_value", "_least", "_low", "_high", "_most"))
    bins = F.when(value < low, _bin(value, least, low)).when(value <= high, _bin(value, low, high) + BINS).otherwise(
        _bin(value, high, most) + 2 * BINS)
    counted = join_derived(values, brackets, series, "inner").groupBy(*series, bins.alias("_bin")).agg(
        F.count("*").alias("_count"), F.max("_place").alias("_place"), F.min("_value").alias("_low"), F.max("_value").alias("_high"))
    bins_hit = _around(counted, series, "_bin", F.lit(0))
    narrowed = bins_hit.groupBy(*series).agg(F.max("_place").alias("_place"), F.min("_low").alias("_low"),
                                             F.max("_high").alias("_high"), F.min(F.col("_upto") - F.col("_count")).alias("_below"))
    near = join_derived(values, narrowed, series, "inner").filter(value.between(low, high))
    counts = near.groupBy(*series, value.alias("_inside")).agg(
        F.count("*").alias("_count"), F.max("_place").alias("_place"), F.max("_below").alias("_below"))
    around = _around(counts, series, "_inside", F.col("_below"))
    low, high = F.min("_inside"), F.max("_inside")
    part = F.max(F.col("_place") - F.floor("_place"))
    found = around.groupBy(*series).agg(F.when(low == high, low).otherwise(low + part * (high - low)).alias("_found"))
    return found.groupBy(*keys).agg(
        *(F.max(F.when(F.col("_name") == c, F.col("_found"))).alias(c + suffix) for c in columns))


def _around(counts: DataFrame, series: list[str], by: str, below: Column) -> DataFrame:
    """The one or two rows whose running totals reach over the place of the series."""
    upto = below + F.sum("_count").over(W.partitionBy(*series).orderBy(by))
    return counts.withColumn("_upto", upto).filter(
        (F.col("_upto") >= F.floor("_place")) & (F.col("_upto") - F.col("_count") < F.ceil("_place")))
