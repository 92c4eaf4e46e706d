from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rekindle.functions import quantiles
from rekindle.functions.ranges import running_sums

PROBS, NAMES = (0.0, 0.25, 0.5, 0.95, 1.0), ("p0", "p25", "p50", "p95", "p100")


def reference(df, keys, value):
    return df.groupBy(*keys).agg(
        *[F.percentile(value, p).alias(n) for p, n in zip(PROBS, NAMES)], F.count(F.lit(1)).alias("n")
    )


def check(df, keys, value):
    want = reference(df, keys, value).collect()
    got = quantiles.exact(df, keys, value, PROBS, NAMES, {"n": F.count(F.lit(1))}).collect()
    index = lambda rows: {tuple(r[k] for k in keys): r for r in rows}
    a, b = index(got), index(want)
    assert a.keys() == b.keys()
    for k in a:
        assert a[k].n == b[k].n
        for n in NAMES:
            assert a[k][n] == (None if b[k][n] is None else pytest.approx(b[k][n], rel=1e-12)), (k, n)


def test_continuous_values_over_many_partitions(spark):
    df = spark.range(200_000).select((F.col("id") % 3).alias("g"), (F.hash("id") / 1e6).alias("x"))
    check(df.repartition(16), ["g"], "x")
    check(df, [], "x")


def test_spikes_outliers_and_hot_group(spark):
    """A third of the rows share one value, a few are enormous, one group is hot."""
    x = (
        F.when(F.col("id") % 3 == 0, 5.0)
        .when(F.col("id") % 1000 == 1, 1e15)
        .otherwise(F.pmod(F.hash("id"), F.lit(1000)) / 7)
    )
    group = F.when(F.col("id") % 10 < 8, "hot").otherwise("cold")
    check(spark.range(50_000).select(group.alias("g"), x.alias("x")), ["g"], "x")


def test_small_groups_nulls_and_null_keys(frame):
    rows = [("a", 1.0), ("a", 2.0), ("b", None), (None, 3.0), (None, None), ("c", 4.0)]
    check(frame(rows, "g string, x double"), ["g"], "x")


def test_result_does_not_depend_on_partitions(spark):
    df = spark.range(5_000).select((F.col("id") % 2).alias("g"), (F.hash("id") % 100_003).alias("x"))
    for parts in (1, 3, 40):
        check(df.repartition(parts), ["g"], "x")
    check(df.limit(0), ["g"], "x")
    check(df.limit(0), [], "x")


def test_no_group_is_gathered(spark):
    """One group is put in order by many tasks: each range of its values holds a part of them."""
    df = spark.range(300_000).select(F.hash("id").cast("double").alias("x"), F.lit(1).alias("one"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = running_sums(df, [], [F.col("x").asc()], {"upto": "one"}, {"all": "one"})
        sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) >= 4 and max(sizes) < 120_000
        assert ranked.agg(F.max("upto"), F.countDistinct("upto"), F.max("all")).first()[:] == (300_000, 300_000, 300_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
