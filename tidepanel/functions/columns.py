"""Column helpers: time buckets, canonical keys, safe division, scaling, cuts, row-wise sums and medians."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from . import bigint

NO_DEBT = str(2**256 - 1)


def bucket(time: Column | str, width: str = "2 hours") -> Column:
    """Start of the fixed-width bucket that holds a time, counted from 1970; rows without a time drop out."""
    return F.window(time, width)["start"]


def canonical_time(time: Column | str) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSS 'UTC'")


def canonical_address(address: Column | str) -> Column:
    return F.lower(F.trim(address))


def parsed_time(text: Column | str) -> Column:
    """A timestamp from text with or without a trailing UTC mark; null if it does not parse."""
    return F.try_to_timestamp(F.regexp_replace(text, " ?UTC$", "")).cast("timestamp_ntz")


def divided(x: Column | str, y: Column | str) -> Column:
    """x / y as a double; null where y is 0 or either is null."""
    return F.try_divide(_c(x).cast("double"), _c(y).cast("double"))


def percent(x: Column | str, y: Column | str, digits: int = 4) -> Column:
    return F.round(F.try_divide(100.0 * _c(x), _c(y).cast("double")), digits)


def finite(x: Column | str) -> Column:
    """The number as a double, null if it is null, NaN or infinite."""
    d = _c(x).try_cast("double")
    return F.when(F.abs(d) < float("inf"), d)


def scaled(raw: Column | str, decimals: Column | str | int) -> Column:
    """raw / 10^decimals of an integer column of at most 38 digits; null if either is null."""
    d = F.lit(decimals) if isinstance(decimals, int) else _c(decimals)
    return _c(raw).cast("double") / F.pow(F.lit(10.0), d)


def shifted(digits: Column | str, decimals: Column | str | int) -> Column:
    """The same for digit strings of any length: the point is set in the string, so only one rounding takes place."""
    d = F.lit(decimals) if isinstance(decimals, int) else _c(decimals)
    minus = F.when(F.startswith(digits, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    plain = F.regexp_replace(digits, "^-", "")
    long = F.lpad(plain, F.greatest(F.length(plain), d + 1), "0")
    whole = F.substring(long, F.lit(1), F.length(long) - d)
    part = F.substring(long, F.length(long) - d + 1, F.greatest(d, F.lit(0)))
    return F.concat(minus, whole, F.lit("."), F.when(d > 0, part).otherwise(F.lit("0"))).try_cast("double")


def exactly_scaled(df: DataFrame, column: str, decimals: Column | str | int) -> Column:
    """raw / 10^decimals with one rounding: digit strings and integers of any length; doubles are divided as they are."""
    kind = df.schema[column].dataType
    if isinstance(kind, (DoubleType, FloatType)):
        return scaled(column, decimals)
    if isinstance(kind, StringType):
        return shifted(bigint.parsed(column), decimals)
    return F.when(F.abs(column) <= 2**53, scaled(column, decimals)).otherwise(shifted(F.col(column).cast("string"), decimals))


def row_sum(columns: Sequence[str]) -> Column:
    """Sum of columns, null as 0."""
    return reduce(lambda a, b: a + b, (F.coalesce(_c(c).cast("double"), F.lit(0.0)) for c in columns))


def row_upper_median(columns: Sequence[Column]) -> Column:
    """The upper middle of the columns that are not null."""
    values = F.array_sort(F.filter(F.array(*columns), lambda x: x.isNotNull()))
    return F.when(F.size(values) > 0, F.element_at(values, (F.floor(F.size(values) / 2) + 1).cast("int")))


def cut_left_closed(x: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """The label of the interval [edge, next edge) that holds x; null if x is null."""
    out = F.when(_c(x).isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        out = out.when(_c(x) < edge, label)
    return out.otherwise(labels[-1])


def cut_right_closed(x: Column | str, edges: Sequence[Column], labels: Sequence[str]) -> Column:
    """The label of the interval (edge, next edge] that holds x, as quantile cuts have it."""
    out = F.when(_c(x).isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        out = out.when(_c(x) <= edge, label)
    return out.otherwise(labels[-1])


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x
