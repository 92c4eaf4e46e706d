"""Column-level building blocks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_key(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def indicator_sum(condition: Column) -> Column:
    """How many rows satisfy the condition; NULL counts as "no"."""
    return F.sum(F.when(condition, 1).otherwise(0))


def bool_rate(condition: Column) -> Column:
    """Share of rows where the condition holds, among those where it is known."""
    return F.avg(condition.cast("int"))


def presence_flag(marker: str) -> Column:
    """0/1 from a marker column that a left join filled only for matches."""
    return F.coalesce(F.col(marker), F.lit(0)).cast("int")


def fill_defaults(df: DataFrame, defaults: Mapping[str, int | bool]) -> DataFrame:
    return df.fillna(dict(defaults))


def rename_reorder(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Select ``new name -> old name`` in the given order."""
    return df.select(*[F.col(old).alias(new) for new, old in columns.items()])


def exclude_columns(df: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """All other columns in their order; names that do not exist are ignored."""
    return df.drop(*excluded)


def require_column(df: DataFrame, column: str, table: str = "the table") -> DataFrame:
    if column not in df.columns:
        raise ValueError(
            f"column '{column}' is not in {table}; it has: {', '.join(df.columns)}"
        )
    return df
