"""Percentiles per group: mergeable sketch by default, exact selection on request."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rekindle.functions.ranges import running_sums

ACCURACY = 10_000


def approx(value: str, probs: Sequence[float], names: Sequence[str]) -> list[Column]:
    """Sketch percentiles for use inside ``agg``; memory per group is bounded."""
    return [F.percentile_approx(value, p, ACCURACY).alias(n) for p, n in zip(probs, names)]


def _per_group(rows: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row next to the one row of its group; NULL keys match each other."""
    names = [c for c in groups.columns if c not in keys]
    if not keys:
        one = groups.select(F.struct(*names).alias("_g")).scalar()
        return rows.select("*", one.alias("_g")).select(*rows.columns, "_g.*")
    renamed = groups.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *names)
    match = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return rows.join(renamed, match).select(*rows.columns, *names)


def exact(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    names: Sequence[str],
    aggregates: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Exact interpolated percentiles of ``value`` per group, next to other aggregates.

    The aggregate function for exact percentiles keeps all distinct values of a group in one task.
    Here distinct values with their counts, combined on the map side, are dealt out by ranges of
    (group, value); running counts over these ranges tell where each wanted rank lies. A group of
    any size is spread over tasks, and a value that fills a third of it travels once per task.
    """
    extra = dict(aggregates or {})
    rows = df.withColumn("_v", F.col(value).cast("double"))
    v = F.col("_v")
    # NULL values keep their group but take no rank.
    weight = F.when(v.isNotNull(), F.count(F.lit(1))).otherwise(0)
    counts = rows.groupBy(*keys, "_v").agg(weight.alias("_w"))
    if not keys:
        # An empty table still has its one global row.
        nothing = df.sparkSession.range(1).select(
            F.lit(None).cast("double").alias("_v"), F.lit(0).cast("long").alias("_w")
        )
        counts = counts.union(nothing)
    ranked = running_sums(counts, keys, [v.asc_nulls_first()], {"_upto": "_w"}, {"_total": "_w"})

    def holds(rank: Column) -> Column:
        return (rank >= F.col("_upto") - F.col("_w")) & (rank < F.col("_upto"))

    tiles: list[Column] = []
    for p, name in zip(probs, names):
        x = F.lit(float(p)) * (F.col("_total") - 1)
        low, high = F.max(F.when(holds(F.floor(x)), v)), F.max(F.when(holds(F.ceil(x)), v))
        tiles.append((low + (high - low) * F.max(x - F.floor(x))).alias(name))
    found = ranked.groupBy(*keys).agg(*tiles)
    if not extra:
        return found
    others = rows.groupBy(*keys).agg(*[c.alias(n) for n, c in extra.items()])
    return _per_group(found, others, keys).select(*keys, *extra, *names)
