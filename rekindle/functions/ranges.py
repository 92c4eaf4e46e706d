"""Running sums over sorted ranges: exact for keys of any size, without one window per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rekindle.sources.tables import materialised


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    sums: Mapping[str, str],
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """``df`` plus, for each ``sums[new] = column``, its running sum within ``keys`` by ``order``.

    ``totals[new] = column`` adds sums over the whole key. Rows are range-partitioned by key and
    order and written; a range knows what lies before it from the sums per range (one row per key
    and range), and only rows of one range are put in order together. ``order`` must tell the rows
    of a key apart where the place among equals matters; equal rows stay in one range.
    """
    totals = totals or {}
    ranged = df.repartitionByRange(*[F.col(k) for k in keys], *order)
    ranged = materialised(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    columns = {*sums.values(), *totals.values()}
    per = ranged.groupBy(*keys, "_range").agg(*[F.sum(c).alias(f"_s_{c}") for c in sorted(columns)])
    whole = Window.partitionBy(*keys)
    before = per.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_range").alias("_own"),
        *[(F.sum(f"_s_{c}").over(whole.orderBy("_range")) - F.col(f"_s_{c}")).alias(f"_b_{new}") for new, c in sums.items()],
        *[F.sum(f"_s_{c}").over(whole).alias(new) for new, c in totals.items()],
    )
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_range") == F.col("_own")]
    inside = Window.partitionBy(*keys, "_range").orderBy(*order)
    upto = {new: F.col(f"_b_{new}") + F.sum(c).over(inside) for new, c in sums.items()}
    joined = ranged.join(before, reduce(Column.__and__, same))
    return joined.select(*df.columns, *[v.alias(n) for n, v in upto.items()], *totals)
