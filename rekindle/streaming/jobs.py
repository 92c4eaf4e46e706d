"""Structured Streaming versions of the usage report and of scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rekindle.functions.scalars import sql_round
from rekindle.plans import scoring

# The log arrives five to ten minutes late.
LATENESS = "10 minutes"


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None, **options: str
) -> DataFrame:
    """Parquet files appearing below ``path`` as a stream with an explicit schema."""
    reader = spark.readStream.schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def daily_usage(log: DataFrame, ts: Column, lateness: str = LATENESS) -> DataFrame:
    """Requests, ok and errors per UTC day of an arriving log.

    A day is final once the watermark has passed its end; in append mode each day is
    emitted exactly once, then its state is dropped. State is one row per open day.
    """
    status = F.col("status_code")
    return (
        log.withColumn("_ts", ts.cast("timestamp"))
        .withWatermark("_ts", lateness)
        .groupBy(F.window("_ts", "1 day").alias("_day"))
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_if(status == 200).alias("ok"),
            F.count_if(status != 200).alias("errors"),
        )
        .select(F.col("_day.start").cast("date").alias("request_date"), "requests", "ok", "errors")
    )


#: What a batch of the restated usage report leaves per day.
CONTRIBUTION = "request_date date, requests bigint, ok bigint, errors bigint, late bigint, last_ts timestamp, batch_id bigint"


def _batches_to(df: DataFrame, checkpoint: str, write) -> None:
    """Every batch of what is available now to ``write(batch, batch_id)``, then stop."""
    query = df.writeStream.foreachBatch(write).trigger(availableNow=True)
    query.option("checkpointLocation", checkpoint).start().awaitTermination()


def restated_usage(log: DataFrame, ts: Column, path: str, checkpoint: str, lateness: str = LATENESS) -> DataFrame:
    """Usage per day with nothing lost: late rows restate their day, rows without a time are kept.

    A batch writes what it adds to each day below ``batch_id=<id>``, replacing what a failed attempt
    of the same batch left; a day is the sum of its contributions. ``late`` counts rows of days that
    the watermark (latest time seen before the batch, less ``lateness``) had closed. The day of
    rows without a time is NULL. One row per day and batch is read back.
    """
    status = F.col("status_code")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = spark.read.schema(CONTRIBUTION).option("ignoreMissingFiles", "true").parquet(path) if batch_id else None
        seen = None if before is None else before.where(F.col("batch_id") < batch_id).agg(F.max("last_ts")).first()[0]
        at = ts.cast("timestamp")
        end = F.date_trunc("day", at) + F.expr("interval 1 day")
        closed = F.lit(False) if seen is None else F.coalesce(end <= F.lit(seen) - F.expr(f"interval {lateness}"), F.lit(False))
        batch.groupBy(at.cast("date").alias("request_date")).agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_if(status == 200).alias("ok"),
            F.count_if(status != 200).alias("errors"),
            F.count_if(closed).alias("late"),
            F.max(at).alias("last_ts"),
        ).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    _batches_to(log, checkpoint, write)
    parts = log.sparkSession.read.schema(CONTRIBUTION).parquet(path)
    return parts.groupBy("request_date").agg(*[F.sum(c).alias(c) for c in ("requests", "ok", "errors", "late")])


def once_per_request(rows: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Log rows of a stream without repeats of a request id.

    Ids are remembered as long as the watermark needs, so state doesn't grow with the log.
    """
    timed = rows.withColumn("_ts", F.timestamp_millis("timestamp_ms")).withWatermark("_ts", lateness)
    return timed.dropDuplicatesWithinWatermark(["request_id"]).drop("_ts")


def log_batches(rows: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """A stream of log rows as a table in which a batch that is tried again stands once.

    Each batch has a folder of its own that a retry replaces as a whole.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    _batches_to(rows, checkpoint, write)
    return rows.sparkSession.read.schema(rows.schema).option("recursiveFileLookup", "true").parquet(path)


def score_feed(
    feed: DataFrame,
    columns: Sequence[str],
    at: Column,
    coefficients: Mapping[str, float],
    intercept: float,
    digits: int | None = None,
) -> DataFrame:
    """Request-log rows for an arriving feature feed; stateless, row by row."""
    scored = scoring.score_with_expression(feed, coefficients, intercept)
    if digits is not None:
        scored = scored.withColumn("prediction", sql_round("prediction", digits))
    return scoring.payload_rows(scored, columns, at)


def append_to(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Start appending to Parquet files: everything available now, then stop.

    The checkpoint makes a restart continue where the last run ended, each row once.
    """
    writer = df.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.option("checkpointLocation", checkpoint).start(path)


def run_to_table(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Run a stream over all available input and return what it wrote."""
    append_to(df, path, checkpoint, partition_by).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)
