"""Small column expressions shared by the operators."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def boundary(df: DataFrame, ts: str, day: date, offset_days: int = 0) -> Column:
    """Midnight of ``day + offset_days`` as a literal of the type of column ``ts``.

    Matching the column's own type keeps the comparison free of casts on the column, so
    it reaches the parquet scan as a pushed filter.
    """
    return F.lit((day + timedelta(days=offset_days)).isoformat()).cast(df.schema[ts].dataType)


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days between two values after casting both to dates."""
    return F.datediff(later.cast("date"), earlier.cast("date"))


def month_of(ts: Column) -> Column:
    return F.date_trunc("month", ts).cast("date")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole`` rounded half up; NULL where ``whole`` is zero."""
    return F.round(F.try_divide(F.lit(100.0).cast("double") * part, whole.cast("double")), digits)


def sql_round(value: Column | str, digits: int) -> Column:
    """The SQL's ``ROUND(x, digits)`` of a double: ``x * 10^digits`` to the nearest whole number,
    halves away from zero, divided back; infinite results give ``x`` itself.

    ``F.round`` rounds the shortest decimal form of ``x`` instead, which differs where ``x * 10^digits``
    is just under a half (0.5046875: 504687.49999999994, 0.504687 in SQL, 0.504688 by ``F.round``).
    """
    x = F.col(value) if isinstance(value, str) else value
    scale = F.lit(float(10**digits))
    back = F.round(x.cast("double") * scale, 0) / scale
    return F.when(F.isnan(back) | (F.abs(back) == float("inf")), x.cast("double")).otherwise(back)


def relative_difference(base: Column, other: Column) -> Column:
    """``abs(other - base) / abs(base)``; NULL where ``base`` is zero."""
    return F.try_divide(F.abs(other - base), F.abs(base))


def clip_int(value: Column, low: int, high: int) -> Column:
    """Clamp to ``[low, high]`` and drop the fraction; NULL stays NULL."""
    clamped = F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high)))
    return F.when(value.isNotNull(), clamped).cast("int")


def format_id(prefix: str, width: int, number: Column) -> Column:
    """``prefix`` followed by the number padded with zeros to ``width`` digits."""
    return F.format_string(f"{prefix}%0{width}d", number)


def slug(email: Column, max_length: int = 24) -> Column:
    """Safe identifier from the local part of an address.

    Lower case, each run of other characters becomes one underscore, outer underscores
    go, and the result is cut to ``max_length``.
    """
    local = F.lower(F.split_part(email, F.lit("@"), F.lit(1)))
    return F.substring(F.btrim(F.regexp_replace(local, "[^a-z0-9]+", "_"), F.lit("_")), 1, max_length)
