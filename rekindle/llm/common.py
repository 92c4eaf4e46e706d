"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rekindle.session import scratch_path

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Indexes that ``ragged_take`` handles at a time.
STEP = 1 << 18


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


#: Lists that are told of every written table while they are open.
_told: list[list[str]] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from the shared scratch folder: computed once, lineage cut."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    for paths in _told:
        paths.append(path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def removed(spark: SparkSession, *paths: str) -> None:
    """Deletes tables that ``written`` made; those that are gone already are no error."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discarded(*tables: DataFrame) -> None:
    """Deletes written tables that no plan reads any more."""
    for table in tables:
        removed(table.sparkSession, table.written_to)


@contextmanager
def noting() -> Iterator[list[str]]:
    """The paths that ``written`` makes meanwhile: whoever opens this owns and removes them."""
    paths: list[str] = []
    _told.append(paths)
    try:
        yield paths
    finally:
        _told.remove(paths)


def word_count(text: Column) -> Column:
    """Words of a text as long; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ragged_take(starts: np.ndarray, lengths: np.ndarray, values: np.ndarray, index: np.ndarray):
    """Concatenate ``values[starts[i] : starts[i] + lengths[i]]`` for each i of ``index``.

    Returns the values and the length each index contributed. Positions are made for some indexes
    at a time, so that little more than the result is held.
    """
    each = lengths[index]
    out = np.empty(int(each.sum()), values.dtype)
    done = 0
    for at in range(0, len(index), STEP):
        own, n = index[at : at + STEP], each[at : at + STEP]
        ends = np.cumsum(n)
        position = np.arange(ends[-1], dtype=np.int64)
        position += np.repeat(starts[own] - (ends - n), n)
        out[done : done + len(position)] = values[position]
        done += len(position)
    return out, each
