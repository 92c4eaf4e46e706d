"""Reports over the request log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rekindle.catalog.features import feature_table
from rekindle.catalog.registry import query, rounded, sql_rounded
from rekindle.catalog.sql import FEATURE_CHAIN, using
from rekindle.contracts import NUMERIC_FEATURES
from rekindle.functions import quantiles
from rekindle.plans import monitoring, sketches
from rekindle.session import scratch_path
from rekindle.sources import views
from rekindle.sources.tables import materialised


def _drift_sql(train: str) -> str:
    """SQL drift report over train(feature, value) and the numeric values sent."""
    stats = {
        "n": "CAST(COUNT(value) AS DOUBLE)",
        "mean": "AVG(value)",
        "stddev": "stddev_samp(value)",
        "p50": "quantile_cont(value, 0.5)",
        "p95": "quantile_cont(value, 0.95)",
    }
    rows = " UNION ALL ".join(
        f"SELECT feature, source, '{name}' AS statistic, {expr} AS v FROM v_ GROUP BY feature, source"
        for name, expr in stats.items()
    )
    return f"""+ v_ AS (SELECT feature, 'train' AS source, CAST(value AS DOUBLE) AS value FROM ({train})
UNION ALL SELECT column_name, 'production', value FROM sent
WHERE column_name IN (SELECT DISTINCT feature FROM ({train}))),
sides AS (SELECT feature, statistic, MAX(CASE WHEN source = 'train' THEN v END) AS train,
MAX(CASE WHEN source = 'production' THEN v END) AS production FROM ({rows}) GROUP BY feature, statistic),
compared AS (SELECT *, CASE WHEN statistic <> 'n' THEN abs(production - train) / NULLIF(abs(train), 0) END AS rel_diff
FROM sides)
SELECT feature, statistic, ROUND(train, 6) AS train, ROUND(production, 6) AS production,
ROUND(rel_diff, 6) AS rel_diff, rel_diff > 0.2 AS drifted FROM compared"""


_DRIFT_BASE = " ".join(FEATURE_CHAIN) + " payload sent"
_ALL_FEATURES = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {f} AS value FROM features" for f in NUMERIC_FEATURES
)
_DRIFT_COLUMNS = ("train", "production", "rel_diff")


def drift_rounded(report: DataFrame) -> DataFrame:
    """The report's numbers as the SQL's ``ROUND(x, 6)`` of a double gives them, ties included."""
    return sql_rounded(report, *_DRIFT_COLUMNS, digits=6)


@query(using("payload", """SELECT request_date, COUNT(*) AS requests,
CAST(SUM(CASE WHEN status_code = 200 THEN 1 ELSE 0 END) AS BIGINT) AS ok,
CAST(SUM(CASE WHEN status_code <> 200 THEN 1 ELSE 0 END) AS BIGINT) AS errors
FROM payload GROUP BY request_date"""))
def mon_usage(spark: SparkSession, root: str) -> DataFrame:
    return monitoring.usage(views.inference_payload(spark, root))


@query(using("payload", """SELECT status_code, COUNT(*) AS n,
ROUND(quantile_cont(execution_duration_ms, 0.5), 10) AS p50_ms,
ROUND(quantile_cont(execution_duration_ms, 0.95), 10) AS p95_ms, MAX(execution_duration_ms) AS max_ms
FROM payload GROUP BY status_code"""))
def mon_latency(spark: SparkSession, root: str) -> DataFrame:
    return rounded(monitoring.latency(views.inference_payload(spark, root), exact=True), "p50_ms", "p95_ms")


@query(using("payload", """SELECT status_code, COUNT(*) AS n, MAX(execution_duration_ms) AS max_ms,
TRUE AS p50_in_bounds, TRUE AS p95_in_bounds FROM payload GROUP BY status_code"""))
def mon_latency_sketch(spark: SparkSession, root: str) -> DataFrame:
    """The default report; its percentiles must lie within the sketch's rank error."""
    log = views.inference_payload(spark, root)
    report = monitoring.latency(log).withColumnRenamed("status_code", "status")
    joined = log.join(report, F.col("status_code").eqNullSafe(F.col("status")))
    duration, n = F.col("execution_duration_ms"), F.count("execution_duration_ms")

    def in_bounds(p: float, column: str):
        slack = n * (4.0 / quantiles.ACCURACY) + 1
        below, upto = F.count_if(duration < F.col(column)), F.count_if(duration <= F.col(column))
        return (below <= n * p + slack) & (upto >= n * p - slack)

    return joined.groupBy("status_code").agg(
        F.max("n").alias("n"),
        F.max("max_ms").alias("max_ms"),
        in_bounds(0.5, "p50_ms").alias("p50_in_bounds"),
        in_bounds(0.95, "p95_ms").alias("p95_in_bounds"),
    )


@query(using("payload predictions", """SELECT ROUND(prediction, 2) AS prediction_bucket, COUNT(*) AS count
FROM predictions GROUP BY 1"""))
def mon_predictions(spark: SparkSession, root: str) -> DataFrame:
    return monitoring.prediction_histogram(views.inference_payload(spark, root))


@query(using(_DRIFT_BASE, _drift_sql("SELECT 'events_last_90d' AS feature, events_last_90d AS value FROM features")))
def mon_drift(spark: SparkSession, root: str) -> DataFrame:
    report = monitoring.drift(
        materialised(feature_table(spark, root), "train"),
        views.inference_payload(spark, root),
        "events_last_90d",
        exact=True,
    )
    return drift_rounded(report)


@query(using(_DRIFT_BASE, _drift_sql(_ALL_FEATURES)))
def mon_drift_all(spark: SparkSession, root: str) -> DataFrame:
    report = monitoring.drift_all(
        materialised(feature_table(spark, root), "train"),
        views.inference_payload(spark, root),
        NUMERIC_FEATURES,
        exact=True,
    )
    return drift_rounded(report)


# Per request: its data rows, and among them those with the column, cut short of it, or with a number.
_REASONS = """+ at_ AS (SELECT request_id, COUNT(*) AS named, COUNT(*) FILTER (short) AS short, COUNT(TRY_CAST(v AS DOUBLE)) AS numbers
FROM cells_ WHERE column_name = 'events_last_90d' GROUP BY request_id),
in_ AS (SELECT request_id, COUNT(*) AS n FROM rows_ GROUP BY request_id),
why_ AS (SELECT CASE WHEN status_code IS DISTINCT FROM 200 THEN 'not_ok' WHEN request IS NULL THEN 'no_request' WHEN j IS NULL THEN 'broken'
WHEN in_.n IS NULL AND data IS NULL AND (json_exists(j, '$.inputs') OR json_exists(j, '$.instances')) THEN 'no_names'
WHEN in_.n IS NULL AND data IS NULL THEN 'other_shape' WHEN in_.n IS NULL THEN 'no_rows' WHEN named IS NULL THEN 'missing_column'
WHEN numbers = 0 AND short > 0 THEN 'short_row' WHEN numbers = 0 THEN 'not_a_number' ELSE 'used' END AS reason,
CASE WHEN status_code = 200 THEN coalesce(in_.n, 0) ELSE 0 END AS sent, CASE WHEN status_code = 200 THEN coalesce(numbers, 0) ELSE 0 END AS numbers
FROM kinds_ LEFT JOIN at_ USING (request_id) LEFT JOIN in_ USING (request_id))"""


@query(using("payload sent", _REASONS + """ SELECT COUNT(*) FILTER (reason <> 'not_ok') AS ok_requests,
COUNT(*) FILTER (reason IN ('no_request', 'broken', 'no_names', 'other_shape')) AS other_shape,
COUNT(*) FILTER (reason = 'missing_column') AS missing_column FROM why_"""))
def mon_unparsed(spark: SparkSession, root: str) -> DataFrame:
    return monitoring.unparsed(views.inference_payload(spark, root), "events_last_90d")


@query(using("payload sent", _REASONS + """ SELECT reason, COUNT(*) AS requests, SUM(sent)::BIGINT AS data_rows,
SUM(numbers)::BIGINT AS usable_values FROM why_ GROUP BY reason"""))
def mon_unparsed_reasons(spark: SparkSession, root: str) -> DataFrame:
    return monitoring.unparsed_reasons(views.inference_payload(spark, root), "events_last_90d")


#: Wide enough to keep every value of a window of these tables, so that quantiles are exact.
_WIDE = 32768


def _stored(spark: SparkSession, root: str) -> DataFrame:
    """Sketches of the whole log, stored in two goes: first all days, then one of them again."""
    log, path = views.inference_payload(spark, root), scratch_path(spark, "sketches")
    sketches.store_days(log, path, k=_WIDE)
    sketches.store_days(log.where("request_date = date '2024-01-05'"), path, k=_WIDE)
    return sketches.stored(spark, path)


@query(using("payload predictions sent", """+ v_ AS (SELECT column_name AS feature, value FROM sent WHERE request_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-20'
UNION ALL SELECT 'prediction', prediction FROM predictions WHERE request_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-20')
SELECT feature, COUNT(*) AS n, ROUND(AVG(value), 9) AS mean, ROUND(stddev_samp(value), 9) AS stddev, MIN(value) AS min, MAX(value) AS max,
quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95 FROM v_ GROUP BY feature"""))
def mon_window_from_sketches(spark: SparkSession, root: str) -> DataFrame:
    """Any window of days from what was stored per day, log untouched."""
    rows = _stored(spark, root).where("request_date between date '2024-01-03' and date '2024-01-20'")
    return rounded(sketches.window_report(rows, _WIDE), "mean", "stddev", digits=9)


@query(using(_DRIFT_BASE, _drift_sql(_ALL_FEATURES).replace("quantile_cont", "quantile_disc")))
def mon_drift_from_sketches(spark: SparkSession, root: str) -> DataFrame:
    train = materialised(feature_table(spark, root), "train")
    report = sketches.drift(train, NUMERIC_FEATURES, _stored(spark, root), k=_WIDE)
    return drift_rounded(report)
