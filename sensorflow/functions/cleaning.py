"""Row-wise cleaning, typing and repair expressions; usable on tables and on streams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorflow.functions.basic import as_col, within
from sensorflow.schema import DEVICE_RANGE, RANGES


def in_range_or_null(name: str) -> Column:
    return F.when(within(name, RANGES[name]), F.col(name))


def out_of_range(name: str) -> Column:
    """True or NULL, never false: a reading either carries the mark or has none."""
    return F.when(~within(name, RANGES[name]), F.lit(True))


def sentinel_to_null(column: Column | str, sentinel: float = -1) -> Column:
    column = as_col(column)
    return F.when(column != F.lit(sentinel), column)


def clip(column: Column | str, low: float, high: float) -> Column:
    """`least`/`greatest` skip NULLs, so a NULL must be kept apart or it would turn into a limit."""
    column = as_col(column)
    return F.when(column.isNotNull(), F.least(F.greatest(column, F.lit(low)), F.lit(high)))


def known_device(column: Column | str = "DeviceId") -> Column:
    return within(column, DEVICE_RANGE)


def text_to_int(column: Column | str) -> Column:
    """Decimal text is rounded, because some devices send motor speeds with decimals."""
    return F.round(as_col(column).try_cast("double")).try_cast("int")


def text_to_reading(column: Column | str, decimals: int = 2) -> Column:
    return F.round(as_col(column).try_cast("double"), decimals)


def text_to_flag(column: Column | str, default: bool = False) -> Column:
    return F.coalesce(as_col(column).try_cast("boolean"), F.lit(default))
