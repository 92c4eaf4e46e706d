"""Tables that are replaced safely: the new rows are written aside, then one small file switches.

A table is a folder. Each replacement writes a folder of its own; ``_current`` holds one empty file
per replacement, named ``<number>.<folder>``, and the highest number is the table. Creating that
file is the only step that readers notice: a job that dies before it leaves the old rows as they
are, and nothing is ever renamed or overwritten. Old folders stay readable for plans that still
use them until ``prune`` is called. Schemas may differ from one replacement to the next.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _switches(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Number and folder of every replacement, oldest first."""
    where, fs = _path(spark, f"{root}/_current")
    if not fs.exists(where):
        return []
    names = [status.getPath().getName().partition(".") for status in fs.listStatus(where)]
    return sorted((int(number), folder) for number, _, folder in names)


def replace(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Makes the rows of ``df`` the table below ``root``; the table read back.

    ``df`` may read the table it replaces. Of two jobs that replace it at once, one fails.
    """
    spark = df.sparkSession
    folder = f"rows-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{root}/{folder}")
    before = _switches(spark, root)
    number = before[-1][0] + 1 if before else 1
    taken = [f for n, f in _switches(spark, root) if n >= number]
    where, fs = _path(spark, f"{root}/_current/{number:012d}.{folder}")
    if taken or not fs.createNewFile(where):
        raise RuntimeError(f"{root} was replaced by another job meanwhile")
    return current(spark, root)


def current(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table below ``root`` as it stands now, or as an earlier replacement left it."""
    found = [f for n, f in _switches(spark, root) if version is None or n == version]
    if not found:
        raise RuntimeError(f"{root} holds no {'rows yet' if version is None else f'version {version}'}")
    return spark.read.parquet(f"{root}/{found[-1]}")


def prune(spark: SparkSession, root: str, keep: int = 1) -> None:
    """Deletes what the table no longer is: all but the last replacements, and what dead jobs left."""
    kept = {f for _, f in _switches(spark, root)[-keep:]}
    where, fs = _path(spark, root)
    for number, folder in _switches(spark, root)[:-keep]:
        fs.delete(_path(spark, f"{root}/_current/{number:012d}.{folder}")[0], False)
    for status in fs.listStatus(where):
        name = status.getPath().getName()
        if name.startswith("rows-") and name not in kept:
            fs.delete(status.getPath(), True)


def replace_days(df: DataFrame, path: str, day: str) -> DataFrame:
    """Replaces the partitions of the days that ``df`` holds; files of other days are not touched."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
