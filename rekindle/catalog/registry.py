"""Registration of queries together with their SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rekindle.functions.scalars import sql_round

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL it must agree with."""

    def register(fn: Query) -> Query:
        if fn.__name__ in QUERIES:
            raise ValueError(f"{fn.__name__} is registered twice")
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 10) -> DataFrame:
    """Rounding for comparison only: summation order differs between engines.

    Ten digits keep means of short decimals away from rounding ties.
    """
    return df.withColumns({c: F.round(c, digits) for c in columns})


def sql_rounded(df: DataFrame, *columns: str, digits: int) -> DataFrame:
    """Doubles rounded as the SQL's ``ROUND`` does, where the digits are part of the result."""
    return df.withColumns({c: sql_round(c, digits) for c in columns})
