"""Streaming jobs, run over all available files and compared with batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rekindle.catalog.features import RATES, feature_table
from rekindle.catalog.models import CHAMPION_SQL, FEATURES, request_sql
from rekindle.catalog.registry import query, rounded, sql_rounded
from rekindle.catalog.sql import on_features, using
from rekindle.plans import scoring
from rekindle.session import scratch_path
from rekindle.sources import views
from rekindle.streaming import jobs


def _stream(spark: SparkSession, root: str, table: str) -> DataFrame:
    schema = views.raw(spark, root, table).schema
    return jobs.read_files(spark, root, schema, pathGlobFilter=f"{table}.parquet")


def _run(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    return jobs.run_to_table(df, scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint"))


# The last day stays open: its watermark never passes.
@query(using("payload", """SELECT request_date, COUNT(*) AS requests, COUNT(*) FILTER (status_code = 200) AS ok,
COUNT(*) FILTER (status_code <> 200) AS errors FROM payload GROUP BY request_date
HAVING request_date + INTERVAL 1 DAY <= (SELECT MAX(ts) FROM events) - INTERVAL 10 MINUTE"""))
def stream_daily_usage(spark: SparkSession, root: str) -> DataFrame:
    log = views.payload_from_events(_stream(spark, root, "events"))
    return _run(jobs.daily_usage(log, F.timestamp_millis("timestamp_ms")), "usage")


def _in_files(df: DataFrame, part: Column, parts: int, name: str) -> str:
    """``df`` as files that arrive one after the other, by ``part``."""
    path = scratch_path(df.sparkSession, name)
    for k in range(parts):
        df.where(part == k).coalesce(1).write.mode("append").parquet(path)
    return path


# Three deliveries, each of all days; some requests have no time. Days that a delivery finds closed
# are restated, and what came late is counted.
@query(using("payload", """+ t_ AS (SELECT event_id % 3 AS part, CASE WHEN event_id % 89 <> 5 THEN ts END AS moment,
CASE WHEN event_id % 97 <> 7 THEN CASE WHEN event_type = 'error' THEN 500 ELSE 200 END END AS status_code FROM events),
mark_ AS (SELECT part, MAX(moment) - INTERVAL 10 MINUTE AS upto FROM t_ GROUP BY part)
SELECT CAST(moment AS DATE) AS request_date, COUNT(*) AS requests, COUNT(*) FILTER (status_code = 200) AS ok,
COUNT(*) FILTER (status_code <> 200) AS errors,
COUNT(*) FILTER (CAST(moment AS DATE) + INTERVAL 1 DAY <= (SELECT MAX(upto) FROM mark_ WHERE mark_.part < t_.part)) AS late
FROM t_ GROUP BY 1"""))
def stream_usage_restated(spark: SparkSession, root: str) -> DataFrame:
    log = views.inference_payload(spark, root).select("request_id", "timestamp_ms", "status_code")
    key = F.col("request_id").cast("long")
    timed = log.withColumn("timestamp_ms", F.when(key % 89 != 5, F.col("timestamp_ms")))
    path = _in_files(timed, key % 3, 3, "usage-feed")
    feed = jobs.read_files(spark, path, timed.schema, files_per_trigger=1)
    out, checkpoint = scratch_path(spark, "restated"), scratch_path(spark, "restated-checkpoint")
    return jobs.restated_usage(feed, F.timestamp_millis("timestamp_ms"), out, checkpoint)


# The feature table arrives twice; each request is logged once, with all features it was scored on.
@query(on_features(f"""SELECT md5(user_id || '|946684800000') AS request_id, DATE '2000-01-01' AS request_date,
{request_sql(FEATURES)} AS request, '{{"predictions":[' || ROUND({CHAMPION_SQL}, 3) || ']}}' AS response FROM features"""))
def stream_score_log(spark: SparkSession, root: str) -> DataFrame:
    table = sql_rounded(feature_table(spark, root), *RATES, digits=6)
    path = scratch_path(spark, "score-feed")
    for _ in range(2):
        table.write.mode("append").parquet(path)
    feed = jobs.read_files(spark, path, table.schema, files_per_trigger=1)
    rows = jobs.score_feed(feed, FEATURES, F.lit(views.SNAPSHOT), scoring.COEFFICIENTS, scoring.INTERCEPT, digits=3)
    once = jobs.once_per_request(rows).select("request_id", "request_date", "request", "response")
    return jobs.log_batches(once, scratch_path(spark, "scored"), scratch_path(spark, "scored-checkpoint"))
