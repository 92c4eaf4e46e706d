"""Grouped and global aggregates; every one combines on the map side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rekindle.contracts import LOOKBACK_DAYS
from rekindle.functions import quantiles
from rekindle.functions.scalars import boundary, month_of, percent
from rekindle.operators.filters import history, not_null


def group_counts(df: DataFrame, keys: Sequence[str | Column], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_and_mean(df: DataFrame, key: str, value: str, count: str, mean: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias(count), F.round(F.avg(value), 1).alias(mean)
    )


def activity_histogram(events: DataFrame, key: str = "user_id") -> DataFrame:
    """How many keys have each number of events."""
    return group_counts(group_counts(events, [key], "n_events"), ["n_events"], "n_users")


def monthly_counts(events: DataFrame, ts: str = "event_ts") -> DataFrame:
    return group_counts(events, [month_of(F.col(ts)).alias("month")], "n_events")


def cancel_rate(subs: DataFrame) -> DataFrame:
    canceled = F.count_if(F.col("end_date").isNotNull())
    total = F.count(F.lit(1))
    return subs.agg(
        total.alias("total_subs"),
        canceled.alias("canceled"),
        percent(canceled, total).alias("pct_canceled"),
    )


def reason_counts(subs: DataFrame, column: str = "cancel_reason") -> DataFrame:
    return group_counts(not_null(subs, column), [column])


def window_counts(
    events: DataFrame,
    snapshot: date,
    days: Sequence[int] = LOOKBACK_DAYS,
    key: str = "user_id",
    ts: str = "event_ts",
) -> DataFrame:
    """Events per key in each look-back window, all windows in one pass.

    Keys without an event in the longest window have no row.
    """
    longest = history(events, snapshot, ts).where(
        F.col(ts) >= boundary(events, ts, snapshot, -max(days))
    )
    return longest.groupBy(key).agg(
        *[
            F.count_if(F.col(ts) >= boundary(events, ts, snapshot, -d)).alias(f"events_last_{d}d")
            for d in days
        ]
    )


def any_flag(df: DataFrame, key: str, condition: Column, present: str, flagged: str) -> DataFrame:
    """Per key: constant TRUE, and whether any row satisfies the condition."""
    return df.groupBy(key).agg(F.bool_or(condition).alias(flagged)).select(
        key, F.lit(True).alias(present), flagged
    )


def column_summary(
    df: DataFrame, value: str, keys: Sequence[str] = (), exact: bool = False
) -> DataFrame:
    """Non-null count, mean, sample deviation, median and 95th percentile of a column.

    Percentiles are sketches unless ``exact``.
    """
    v = F.col(value).cast("double")
    moments = {"n": F.count(v), "mean": F.avg(v), "stddev": F.stddev(v)}
    return with_percentiles(df, keys, value, moments, (0.5, 0.95), ("p50", "p95"), exact)


def with_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    plain: Mapping[str, Column],
    probs: Sequence[float],
    names: Sequence[str],
    exact: bool,
) -> DataFrame:
    """Ordinary aggregates and percentiles of one column, one row per group."""
    if exact:
        return quantiles.exact(df, keys, value, probs, names, plain)
    return df.groupBy(*keys).agg(
        *[c.alias(n) for n, c in plain.items()], *quantiles.approx(value, probs, names)
    )


def rounded_histogram(df: DataFrame, value: str, bucket: str, digits: int = 2) -> DataFrame:
    return group_counts(df, [F.round(value, digits).alias(bucket)], "count")
