"""Typed reader and writer for the JSON request log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rekindle.contracts import PAYLOAD
from rekindle.sources.tables import overwrite_table


def conform(df: DataFrame) -> DataFrame:
    """Any frame holding the log columns, cast and ordered to the log schema."""
    return df.to(PAYLOAD)


def read_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Log files with the explicit schema, so nothing is inferred from the data."""
    return spark.read.format(fmt).schema(PAYLOAD).load(path)


def write_log(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Log table partitioned by day, so date ranges prune whole folders."""
    return overwrite_table(conform(df), name, path, partition_by=("request_date",))
