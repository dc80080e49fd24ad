"""Joins of readings with small derived tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.basic import all_of

BROADCAST_ROWS = 500_000


def join_derived(rows: DataFrame, table: DataFrame, on: list[str] | str, how: str = "left",
                 max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Joins a table of one row per key that was aggregated from the rows themselves.

    Its size is not known beforehand, and the optimizer takes it for as large as its input, which would shuffle all
    rows by a handful of keys. So it is computed once, counted, and broadcast only when small; otherwise the join is
    left to adaptive execution, which splits skewed partitions of the row side.
    """
    table = table.persist()
    if table.count() <= max_rows:
        table = F.broadcast(table)
    return rows.join(table, on, how)


def lost_rows(sent: DataFrame, received: DataFrame, on: list[str]) -> DataFrame:
    """Rows sent but not received; a NULL key is met by a NULL key. Both sides are hashed by the whole key, which spreads a
    busy device. What arrived has as many rows as what was sent: few columns of a small file look small enough to broadcast, but
    every task would hold all of them. A merge join spills instead."""
    arrived = received.select(*(F.col(c).alias(f"_{c}") for c in on)).hint("merge")
    return sent.join(arrived, _same(on), "left_anti")


def _same(on: list[str]) -> Column:
    return all_of(F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on)


def reconcile(sent: DataFrame, received: DataFrame, on: list[str]) -> DataFrame:
    """Per device: rows sent, rows lost and the loss in percent. Both sides are hashed, as in `lost_rows`."""
    marks = received.select(*(F.col(c).alias(f"_{c}") for c in on)).distinct().withColumn("_arrived", F.lit(1)).hint("merge")
    matched = sent.join(marks, _same(on), "left")
    lost = F.count_if(F.col("_arrived").isNull())
    return matched.groupBy("DeviceId").agg(
        F.count("*").alias("sent"), lost.alias("lost"), (lost * 100.0 / F.count("*")).alias("loss_percent"))
