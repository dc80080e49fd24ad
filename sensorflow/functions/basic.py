"""Small column helpers shared by the other modules. No Python UDFs anywhere: all of it stays in generated code."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def all_of(conditions) -> Column:
    return reduce(and_, conditions)


def any_of(conditions) -> Column:
    return reduce(or_, conditions)


def any_null(*columns: Column | str) -> Column:
    return any_of(as_col(c).isNull() for c in columns)


def count_true(conditions) -> Column:
    return reduce(lambda a, b: a + b, (F.when(c, 1).otherwise(0) for c in conditions))


def present(*candidates: Column) -> Column:
    """Array of the candidates that are not NULL, in the given order."""
    return F.array_compact(F.array(*candidates))


def within(column: Column | str, bounds: tuple[float, float]) -> Column:
    return as_col(column).between(F.lit(bounds[0]), F.lit(bounds[1]))


def event_time(df: DataFrame, name: str) -> Column:
    """The column as TIMESTAMP; unreadable text becomes NULL instead of failing the job."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_timestamp(column)
    return column.cast("timestamp")


def micros(column: Column | str) -> Column:
    return F.unix_micros(as_col(column).cast("timestamp"))


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(1_000_000.0)


def share(condition: Column) -> Column:
    """Part of all rows for which the condition is true; NULL counts as false, an empty input gives NULL."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def ratio(part: Column, whole: Column, empty: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(empty))


def band(value: Column, steps: list[tuple[float, object]], below: object) -> Column:
    """Value of the highest step whose lower bound is reached; `steps` ascend."""
    result = F.lit(below)
    for lower, label in steps:
        result = F.when(value >= lower, F.lit(label)).otherwise(result)
    return F.when(value.isNotNull(), result)


def rounded(column: Column | str, places: int) -> Column:
    """Half-up rounding that looks at 12 places only, so the last bits of a double do not decide a tie. NaN, infinite and
    very large values have no such places and stay as they are."""
    value = as_col(column)
    fits = F.abs(value) < 1e25
    return F.when(fits, F.round(value.try_cast("decimal(38,12)"), places).cast("double")).otherwise(value.cast("double"))


def computed_once(df: DataFrame, columns: dict[str, Column] | Column, keep=("*",)) -> DataFrame:
    """Adds the columns (or the fields of a struct) by way of a generator that makes one row of each row.

    A filter on a plain computed column is moved below the projection by repeating its expression, so a text would be
    parsed once for the filter and again for the result. Filters stay above a generator.
    """
    if isinstance(columns, dict):
        columns = F.struct(*(c.alias(n) for n, c in columns.items()))
    return df.select(*keep, F.inline(F.array(columns)))
