"""Traffic, latency, prediction distribution and feature drift from the request log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rekindle.contracts import DRIFT_THRESHOLD
from rekindle.functions import payload_json
from rekindle.functions.scalars import relative_difference
from rekindle.operators import aggregates
from rekindle.operators.projections import require_column
from rekindle.sources.tables import materialised

DRIFT_STATISTICS = ("mean", "stddev", "p50", "p95")


def usage(log: DataFrame) -> DataFrame:
    """Requests per day; a NULL status counts as a request but neither ok nor error."""
    status = F.col("status_code")
    return (
        log.groupBy("request_date")
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_if(status == 200).alias("ok"),
            F.count_if(status != 200).alias("errors"),
        )
        .orderBy("request_date")
    )


def latency(log: DataFrame, exact: bool = False) -> DataFrame:
    """Count, median, 95th percentile and maximum duration per status code."""
    plain = {"n": F.count(F.lit(1)), "max_ms": F.max("execution_duration_ms")}
    names = ("p50_ms", "p95_ms")
    result = aggregates.with_percentiles(
        log, ["status_code"], "execution_duration_ms", plain, (0.5, 0.95), names, exact
    )
    return result.select("status_code", "n", *names, "max_ms").orderBy("status_code")


def prediction_stats(log: DataFrame, exact: bool = False) -> DataFrame:
    """Count, mean, range and median of all predictions returned."""
    # Written once: the passes of an exact percentile read values, not JSON.
    values = materialised(payload_json.predictions(log, ()), "predictions")
    p = F.col("prediction")
    plain = {"n": F.count(F.lit(1)), "mean": F.avg(p), "min": F.min(p), "max": F.max(p)}
    return aggregates.with_percentiles(values, [], "prediction", plain, [0.5], ["p50"], exact)


def prediction_histogram(log: DataFrame) -> DataFrame:
    values = payload_json.predictions(log, ())
    return aggregates.rounded_histogram(values, "prediction", "prediction_bucket").orderBy(
        "prediction_bucket"
    )


def _compare(values: DataFrame, threshold: float, exact: bool) -> DataFrame:
    """Per feature and statistic: training, production, relative difference, flag.

    Both sides are one tagged table, summarised in one grouping and laid side by side by
    conditional aggregates, so nothing is joined across. The values are written once, so that
    no later pass parses a request again.
    """
    values = materialised(values, "drift-values")
    per_side = aggregates.column_summary(values, "value", ["feature", "source"], exact)
    long = per_side.select(
        "feature",
        "source",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(s).alias("statistic"), F.col(s).cast("double").alias("v"))
                    for s in ("n", *DRIFT_STATISTICS)
                ]
            )
        ),
    )

    def side(name: str):
        return F.max(F.when(F.col("source") == name, F.col("v"))).alias(name)

    sides = long.groupBy("feature", "statistic").agg(side("train"), side("production"))
    # The row counts are reported, not compared: traffic and training set differ in size.
    difference = F.when(
        F.col("statistic") != "n", relative_difference(F.col("train"), F.col("production"))
    )
    return sides.withColumn("rel_diff", difference).withColumn(
        "drifted", F.col("rel_diff") > threshold
    )


def drift(
    train: DataFrame,
    log: DataFrame,
    feature: str,
    threshold: float = DRIFT_THRESHOLD,
    exact: bool = False,
) -> DataFrame:
    """Distribution of one feature in training and in production."""
    require_column(train, feature, "the training table")
    sent = payload_json.split_column(log, feature, ())
    values = _tag(train, feature, "train").union(_tag(sent, feature, "production"))
    return _compare(values, threshold, exact)


def _tag(df: DataFrame, feature: str, source: str) -> DataFrame:
    return df.select(
        F.lit(feature).alias("feature"),
        F.lit(source).alias("source"),
        F.col(feature).cast("double").alias("value"),
    )


def drift_all(
    train: DataFrame,
    log: DataFrame,
    features: Sequence[str],
    threshold: float = DRIFT_THRESHOLD,
    exact: bool = False,
) -> DataFrame:
    """The same for every listed feature, with one pass over each table."""
    for f in features:
        require_column(train, f, "the training table")
    pairs = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
    trained = train.select(F.inline(F.array(*pairs))).select("feature", F.lit("train").alias("source"), "value")
    sent = (
        payload_json.split_all_columns(log)
        .where(F.col("column_name").isin(list(features)))
        .select(F.col("column_name").alias("feature"), F.lit("production").alias("source"), "value")
    )
    return _compare(trained.union(sent), threshold, exact)


def unparsed_reasons(log: DataFrame, feature: str) -> DataFrame:
    """Requests, data rows and values by the reason why they can't be used; adds up to the log."""
    return (
        payload_json.decided(log, feature)
        .groupBy("reason")
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.sum("sent").alias("data_rows"),
            F.sum("values").alias("usable_values"),
        )
    )


def unparsed(log: DataFrame, feature: str) -> DataFrame:
    """How many successful requests the drift report cannot use, and why."""
    reason = F.col("reason")
    return payload_json.decided(log, feature).agg(
        F.count_if(reason != "not_ok").alias("ok_requests"),
        F.count_if(reason.isin("no_request", "broken", "no_names", "other_shape")).alias("other_shape"),
        F.count_if(reason == "missing_column").alias("missing_column"),
    )
