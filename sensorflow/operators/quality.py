"""Quality of a data set: each report is one aggregate over the data, reshaped afterwards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.basic import ratio, share
from sensorflow.functions.quality import is_valid_record
from sensorflow.operators.windows import intervals, order_violations
from sensorflow.schema import (
    EXPECTED_INTERVAL_SECONDS, INTERVAL_TOLERANCE_SECONDS, KEYS, KPI_TARGETS, MAX_DELAY_SECONDS,
    MAX_DUPLICATE_RATIO, MIN_COMPLETENESS, REQUIRED,
)


def _long_form(wide: DataFrame, names: list[str], columns: dict[str, list[str]], label: str) -> DataFrame:
    """One wide row to one row per name, taking the named columns of each."""
    items = [
        F.struct(F.lit(n).alias(label), *(F.col(source[i]).alias(c) for c, source in columns.items()))
        for i, n in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*items)))


def completeness(df: DataFrame, fields=REQUIRED, critical=KEYS, minimum: float = MIN_COMPLETENESS) -> DataFrame:
    fields = list(fields)
    wide = df.agg(F.count("*").alias("_rows"), *(F.count(f).alias(f"_{f}") for f in fields))
    long = _long_form(wide, fields, {
        "total_records": ["_rows"] * len(fields), "non_null_records": [f"_{f}" for f in fields]}, "field")
    return long.withColumns({
        "completeness_rate": ratio(F.col("non_null_records"), F.col("total_records")),
        "is_critical": F.col("field").isin(*critical),
    }).withColumn("passes_threshold", F.col("completeness_rate") >= minimum)


def overall_completeness(df: DataFrame, **kw) -> DataFrame:
    return completeness(df, **kw).agg(
        F.avg("completeness_rate").alias("overall_completeness_rate"),
        F.count_if("passes_threshold").alias("fields_passing"), F.count("*").alias("total_fields"),
        F.max("total_records").alias("records"))


def validity_summary(df: DataFrame) -> DataFrame:
    valid = is_valid_record()
    return df.agg(
        share(valid).alias("validity_rate"), F.count_if(valid).alias("valid_records"),
        F.count("*").alias("total_records"))


def dataset_summary(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_records"), F.count_distinct("DeviceId").alias("unique_devices")).withColumn(
        "validated_at", F.current_timestamp())


def column_completeness(df: DataFrame) -> DataFrame:
    names = df.columns
    wide = df.agg(*(ratio(F.count(c), F.count("*")).alias(f"_{c}") for c in names))
    return _long_form(wide, names, {"completeness": [f"_{c}" for c in names]}, "column")


def validity_ratios(df: DataFrame) -> DataFrame:
    return df.agg(
        share(F.col("sensors.temperature").between(20, 80)).alias("temperature_valid"),
        share(F.col("sensors.humidity").between(20, 90)).alias("humidity_valid"),
        share(F.col("efficiency").between(30, 100)).alias("efficiency_valid"),
    )


def consistency_ratios(df: DataFrame, since: str = "2020-01-01") -> DataFrame:
    """Share of times after a date; share of devices with exactly one location. A device without a location counts
    as a device with none. Whether a device has one location is known from its least and greatest."""
    per_device = df.groupBy("device_id").agg(
        F.count("*").alias("_rows"), F.count_if(F.col("timestamp") > F.lit(since).cast("timestamp")).alias("_after"),
        F.min("location").alias("_low"), F.max("location").alias("_high"))
    one_place = F.coalesce(F.col("_low") == F.col("_high"), F.lit(False))
    return per_device.agg(
        F.try_divide(F.sum("_after").cast("double"), F.sum("_rows")).alias("timestamp_order"),
        share(one_place).alias("device_location_consistency"))


def weighted_grade(df: DataFrame, leaves: dict[str, Column] | None = None, since: str = "2020-01-01",
                   targets: dict[str, float] | None = None) -> DataFrame:
    """Weighted score of completeness, validity and consistency with its grade and what to improve. One aggregate
    per device carries all three dimensions; a second one adds up the devices."""
    leaves = leaves or {c: F.col(c) for c in df.columns}
    filled = {f"_full{i}": F.count(c) for i, c in enumerate(leaves.values())}
    valid = {
        "_valid0": F.count_if(F.col("sensors.temperature").between(20, 80)),
        "_valid1": F.count_if(F.col("sensors.humidity").between(20, 90)),
        "_valid2": F.count_if(F.col("efficiency").between(30, 100)),
    }
    per_device = df.groupBy("device_id").agg(
        F.count("*").alias("_rows"), F.count_if(F.col("timestamp") > F.lit(since).cast("timestamp")).alias("_after"),
        F.min("location").alias("_low"), F.max("location").alias("_high"),
        *(c.alias(n) for n, c in {**filled, **valid}.items()))

    def mean_of(names) -> Column:
        return reduce(lambda a, b: a + b, (ratio(F.sum(n), F.sum("_rows")) for n in names)) / len(names)

    one_place = share(F.coalesce(F.col("_low") == F.col("_high"), F.lit(False)))
    score = F.col("overall_quality_score")
    return per_device.agg(
        mean_of(filled).alias("completeness"), mean_of(valid).alias("validity"),
        ((ratio(F.sum("_after"), F.sum("_rows")) + one_place) / 2).alias("consistency"),
    ).withColumn(
        "overall_quality_score",
        F.col("completeness") * 0.3 + F.col("validity") * 0.4 + F.col("consistency") * 0.3,
    ).withColumns({
        "quality_grade": F.when(score > 0.9, "A").when(score > 0.8, "B").otherwise("C"),
        "recommendations": recommendations(
            targets or {"completeness": MIN_COMPLETENESS, "validity": 0.95, "consistency": 0.98}),
    })


def recommendations(targets: dict[str, float]) -> Column:
    """One line per dimension below its target."""
    return F.array_compact(F.array(*(
        F.when(F.col(name) < target, F.lit(f"improve {name}")) for name, target in targets.items())))


def duplicate_ratio(df: DataFrame, keys=("DeviceId", "time"), maximum: float = MAX_DUPLICATE_RATIO) -> DataFrame:
    """Rows beyond the first of each key. Counting per key first keeps copies of one key off the network."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    counted = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_records"), F.count("*").alias("distinct_records"))
    copies = ratio(F.col("total_records") - F.col("distinct_records"), F.col("total_records"))
    return counted.withColumn("duplicate_ratio", copies).withColumn("passes", F.col("duplicate_ratio") <= maximum)


def temporal_order(df: DataFrame, arrival: str, target: float = 0.98, **cut) -> DataFrame:
    marked = order_violations(df, arrival, **cut)
    return marked.groupBy("DeviceId").agg(
        F.count_if("out_of_order").alias("violations"), share(~F.col("out_of_order")).alias("consistency"),
    ).withColumn("passes", F.col("consistency") > target)


def interval_check(df: DataFrame, expected: float = EXPECTED_INTERVAL_SECONDS,
                   tolerance: float = INTERVAL_TOLERANCE_SECONDS, target: float = 0.9, **cut) -> DataFrame:
    """Share of intervals near the expected one, and readings that are missing in the longer ones."""
    gap = F.col("interval_seconds")
    missing = F.greatest(F.floor(gap / expected) - 1, F.lit(0))
    return intervals(df, **cut).groupBy("DeviceId").agg(
        F.count(gap).alias("intervals"),
        F.avg(F.when(gap.isNotNull(), (F.abs(gap - expected) <= tolerance).cast("int"))).alias("regular_share"),
        F.coalesce(F.sum(missing), F.lit(0)).alias("missing_readings"),
    ).withColumn("passes", F.col("regular_share") > target)


def timeliness(df: DataFrame, delay: Column, target: float = KPI_TARGETS["timeliness"],
               limit: float = MAX_DELAY_SECONDS) -> DataFrame:
    return df.select(delay.alias("_delay")).agg(
        share(F.col("_delay") <= limit).alias("within_limit"), share(F.col("_delay") <= target).alias("within_target"),
        share(F.abs("_delay") <= 60).alias("within_a_minute"), F.max("_delay").alias("max_delay"))


def kpi_table(df: DataFrame, delay: Column, time: str = "event_time", targets=KPI_TARGETS) -> DataFrame:
    """Completeness, accuracy, timeliness and consistency against their targets. One pass per key finds the copies;
    everything else rides along in the same aggregate."""
    fields = [time if f == "time" else f for f in REQUIRED]
    per_key = df.withColumns({"_delay": delay, "_valid": is_valid_record()}).groupBy("DeviceId", time).agg(
        F.count("*").alias("_n"), F.count_if("_valid").alias("_ok"), F.max("_delay").alias("_delay"),
        *(F.count(f).alias(f"_{f}") for f in fields))
    filled = reduce(lambda a, b: a + b, (F.sum(f"_{f}") for f in fields))
    wide = per_key.agg(
        F.try_divide(filled.cast("double"), F.sum("_n") * len(fields)).alias("completeness"),
        F.try_divide(F.sum("_ok").cast("double"), F.sum("_n")).alias("accuracy"),
        F.max("_delay").cast("double").alias("timeliness"),
        F.try_divide(F.count("*").cast("double"), F.sum("_n")).alias("consistency"))
    names = list(targets)
    long = _long_form(wide, names, {"value": names}, "metric")
    target = F.create_map(*(F.lit(x) for pair in targets.items() for x in pair))[F.col("metric")]
    reached = F.when(F.col("metric") == "timeliness", F.col("value") <= target).otherwise(F.col("value") >= target)
    return long.withColumns({"target": target, "passes": reached})


def quality_report(df: DataFrame, fields=REQUIRED) -> DataFrame:
    """Summary, completeness and validity in one row. Devices are counted from partial results per device, so one
    pass with a map-side part serves all."""
    fields = list(fields)
    rates = [ratio(F.sum(f"_{f}"), F.sum("_rows")).alias(f"{f}_completeness") for f in fields]
    valid = is_valid_record()
    per_device = df.groupBy("DeviceId").agg(
        F.count("*").alias("_rows"), F.count_if(valid).alias("_ok"), *(F.count(f).alias(f"_{f}") for f in fields))
    wide = per_device.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_records"), F.count("DeviceId").alias("unique_devices"),
        *rates, ratio(F.sum("_ok"), F.sum("_rows")).alias("validity_rate"),
        F.coalesce(F.sum("_ok"), F.lit(0)).alias("valid_records"))
    mean = reduce(lambda a, b: a + b, (F.col(f"{f}_completeness") for f in fields)) / len(fields)
    return wide.withColumn("overall_completeness_rate", mean).withColumn("validated_at", F.current_timestamp())
