"""Leading categories, shares, ordered output and top-k reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rekindle.functions.scalars import percent
from rekindle.operators.aggregates import group_counts


def leading(count: Column, name: Column) -> Column:
    """Aggregate: the name with the highest count, the smallest name on a tie.

    A minimum over (-count, name) pairs, so unlike a ranking window it needs no sort and
    merges partial results: a hot key is never gathered.
    """
    return F.min(F.when(name.isNotNull(), F.struct((-count).alias("n"), name.alias("name"))))["name"]


def top1_per_key(df: DataFrame, key: str, category: str, name: str) -> DataFrame:
    """Most frequent category per key; keys with only NULL categories have no row."""
    counts = group_counts(df.where(F.col(category).isNotNull()), [key, category], "_n")
    return counts.groupBy(key).agg(leading(F.col("_n"), F.col(category)).alias(name))


def share_of_total(df: DataFrame, keys: Sequence[str], count: str = "n", pct: str = "pct") -> DataFrame:
    """Rows per group and their share of all rows in percent.

    The total is a scalar subquery over the group counts, so any number of groups stays
    distributed; the shuffled counts are reused for both.
    """
    counts = group_counts(df, keys, count)
    total = counts.agg(F.sum(count)).scalar()
    return counts.select(*keys, count, percent(F.col(count), total).alias(pct))


def sample(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First ``n`` rows in a defined order; each task keeps only ``n``."""
    return df.orderBy(*order).limit(n)


def most_recent(events: DataFrame, n: int, ts: str, *ties: str) -> DataFrame:
    return sample(events, n, F.col(ts).desc(), *ties)


def sort_counts(counts: DataFrame, count: str, *ties: str) -> DataFrame:
    return counts.orderBy(F.col(count).desc(), *ties)
