"""Equi-joins on one key.

No join carries a hint. Spark broadcasts a side whose measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where adaptive execution
splits partitions that a hot key makes too large.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rekindle.operators.projections import presence_flag


def inner_dim(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return fact.join(dim, key, "inner")


def left_dim(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Every fact row, with NULL attributes where the dimension has no match."""
    return fact.join(dim, key, "left")


def left_anti(keys: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    return keys.join(excluded, key, "left_anti")


def left_presence(keys: DataFrame, present: DataFrame, key: str, flag: str) -> DataFrame:
    """``keys`` plus a 0/1 ``flag`` telling whether the key occurs in ``present``."""
    marked = present.select(key).distinct().withColumn("_present", F.lit(1))
    return keys.join(marked, key, "left").withColumn(flag, presence_flag("_present")).drop("_present")


def left_chain(base: DataFrame, parts: Sequence[DataFrame], key: str) -> DataFrame:
    """Left joins of one-row-per-key frames onto ``base``; all share one partitioning."""
    return reduce(lambda left, right: left.join(right, key, "left"), parts, base)


def counts_by_attribute(
    fact: DataFrame, dim: DataFrame, key: str, attribute: str, name: str = "n_events"
) -> DataFrame:
    """Fact rows per dimension attribute, counting per key *before* the join.

    A key that holds a third of the facts reaches the join as one row per map task's
    partial count and then as a single row.
    """
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    joined = inner_dim(per_key, dim.select(key, attribute), key)
    return joined.groupBy(attribute).agg(F.sum("_n").alias(name))
