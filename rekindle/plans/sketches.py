"""Reports from stored sketches: each day of the log is read once, any window is a merge.

Per day and feature one small row is kept beside the log: count, mean, sum of squared deviations,
range, and a KLL sketch of the values. A report over any days merges rows and never parses a
request again; adding or replacing a day writes that day's partition only. Means and deviations
merge exactly; quantiles have the sketch's rank error, which a wider ``k`` makes smaller (about
2.3 / k^0.9), and are exact while a window holds fewer than ``k`` values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rekindle.contracts import DRIFT_THRESHOLD
from rekindle.functions import payload_json
from rekindle.functions.scalars import relative_difference

#: Items of a sketch; about 8 k bytes a row when full.
K = 4096
PREDICTION = "prediction"


def sketched(values: DataFrame, keys: Sequence[str], value: str = "value", k: int = K) -> DataFrame:
    """One row per key: what merges of the numeric ``value``, NULL left out."""
    x = F.col(value).cast("double")
    known = values.where(x.isNotNull() & ~F.isnan(x))
    return known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(x).alias("mean"),
        (F.var_pop(x) * F.count(F.lit(1))).alias("m2"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.kll_sketch_agg_double(x, k).alias("sketch"),
    )


def merged(rows: DataFrame, keys: Sequence[str], k: int = K) -> DataFrame:
    """The same for coarser keys, from sketched rows alone.

    Squared deviations of groups add up with those of the groups' means, which keep their digits
    whatever the size of the mean.
    """
    n = F.sum("n")
    mean = F.sum(F.col("mean") * F.col("n")) / n
    # weighted variance of the means, as a difference to one of them
    least = rows.groupBy(*keys).agg(F.min("mean").alias("_at"))
    shifted = rows.join(least, list(keys)) if keys else rows.withColumn("_at", least.scalar())
    gap = F.col("mean") - F.col("_at")
    between = F.sum(gap * gap * F.col("n")) - F.pow(F.sum(gap * F.col("n")), F.lit(2)) / n
    return shifted.groupBy(*keys).agg(
        n.alias("n"),
        mean.alias("mean"),
        (F.sum("m2") + F.greatest(between, F.lit(0.0))).alias("m2"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("sketch", k).alias("sketch"),
    )


def statistics(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``n``, ``mean``, ``stddev``, range, ``p50`` and ``p95`` of sketched rows."""

    def at(q: float) -> Column:
        return F.kll_sketch_get_quantile_double("sketch", F.lit(q))

    spread = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    return rows.select(*keys, "n", "mean", spread.alias("stddev"), "min", "max", at(0.5).alias("p50"), at(0.95).alias("p95"))


def values_of_log(log: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """``(request_date, feature, value)``: numbers sent, and predictions returned."""
    sent = payload_json.split_all_columns(log, ["request_date"]).withColumnRenamed("column_name", "feature")
    if features is not None:
        sent = sent.where(F.col("feature").isin(list(features)))
    answers = payload_json.predictions(log).select(
        "request_date", F.lit(PREDICTION).alias("feature"), F.col("prediction").alias("value")
    )
    return sent.unionByName(answers)


def store_days(log: DataFrame, path: str, features: Sequence[str] | None = None, k: int = K) -> None:
    """Sketches of the days that ``log`` holds; their partitions are replaced, others untouched."""
    rows = sketched(values_of_log(log, features), ["request_date", "feature"], k=k)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("request_date").parquet(path)


def stored(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Sketches of the days from ``first`` to ``last``; whole folders are pruned."""
    schema = "feature string, n bigint, mean double, m2 double, min double, max double, sketch binary, request_date date"
    rows = spark.read.schema(schema).parquet(path)
    if first is not None:
        rows = rows.where(F.col("request_date") >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.where(F.col("request_date") <= F.lit(last).cast("date"))
    return rows


def window_report(rows: DataFrame, k: int = K) -> DataFrame:
    """Statistics per feature over all days given; predictions are the feature ``prediction``."""
    return statistics(merged(rows, ["feature"], k), ["feature"])


def drift(train: DataFrame, features: Sequence[str], rows: DataFrame, threshold: float = DRIFT_THRESHOLD, k: int = K) -> DataFrame:
    """Drift report of sketched days against a training table, per feature and statistic."""
    cells = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
    own = statistics(sketched(train.select(F.inline(F.array(*cells))), ["feature"], k=k), ["feature"])
    sent = window_report(rows.where(F.col("feature").isin(list(features))), k)
    names = ("n", "mean", "stddev", "p50", "p95")

    def long(df: DataFrame, side: str) -> DataFrame:
        each = [F.struct(F.lit(s).alias("statistic"), F.col(s).cast("double").alias(side)) for s in names]
        return df.select("feature", F.inline(F.array(*each)))

    both = long(own, "train").join(long(sent, "production"), ["feature", "statistic"], "left")
    difference = F.when(F.col("statistic") != "n", relative_difference(F.col("train"), F.col("production")))
    return both.withColumn("rel_diff", difference).withColumn("drifted", F.col("rel_diff") > threshold)
