"""Canonical tables defined over the star-schema parquet files of FIXTURES.md."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SNAPSHOT = date(2000, 1, 1)


_schemas: dict[str, StructType] = {}


def raw(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the given tables. Its schema is read from the files once per process."""
    # The parquet timestamps carry no zone; UTC keeps every conversion neutral.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    path = f"{root}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def users(spark: SparkSession, root: str) -> DataFrame:
    customer = raw(spark, root, "customer")
    nation = raw(spark, root, "nation").select("n_nationkey", "n_regionkey")
    region = raw(spark, root, "region")
    bands = F.array(*[F.lit(b) for b in ("<25", "25-34", "35-44", "45-54", "55+")])
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("user_id"),
            F.date_add(F.lit(date(1994, 1, 1)), (F.col("c_custkey") % 365).cast("int")).alias(
                "signup_date"
            ),
            F.when(F.col("c_acctbal") >= 5000, "premium").otherwise("free").alias("plan_type"),
            F.get(bands, (F.col("c_custkey") % 5).cast("int")).alias("age_band"),
            F.col("r_name").alias("region"),
            F.col("c_mktsegment").alias("device_type"),
        )
    )


def books(spark: SparkSession, root: str) -> DataFrame:
    return raw(spark, root, "part").select(
        F.col("p_partkey").alias("book_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("genre"),
        F.when(F.col("p_partkey") % 5 < 2, "audiobook").otherwise("ebook").alias("format"),
        (F.col("p_size") * 30).cast("int").alias("length_minutes"),
        F.col("p_brand").alias("language"),
    )


def reading_events(spark: SparkSession, root: str) -> DataFrame:
    orders = raw(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (
        raw(spark, root, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("book_id"),
            F.col("o_orderdate").alias("event_ts"),
            (F.round(F.col("l_discount") * 100).cast("int") / F.lit(10.0)).alias("progress_pct"),
            F.col("l_quantity").cast("int").alias("session_minutes"),
            (F.col("l_returnflag") == "R").alias("finished"),
            F.when(F.col("l_partkey") % 5 == 0, F.col("l_suppkey") % 5 + 1)
            .cast("int")
            .alias("rating"),
        )
    )


def subscriptions(spark: SparkSession, root: str) -> DataFrame:
    closed = F.col("o_orderstatus") == "F"
    start = F.col("o_orderdate").cast("date")
    return (
        raw(spark, root, "orders")
        .select(
            F.col("o_custkey").alias("user_id"),
            start.alias("start_date"),
            F.when(closed, F.date_add(start, 30)).alias("end_date"),
            F.when(closed, F.col("o_orderpriority")).alias("cancel_reason"),
        )
    )


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def payload_from_events(events: DataFrame) -> DataFrame:
    """Request log derived from the event stream; works on batch and streaming input."""
    key, k = F.col("event_id"), _k(F.col("props"))
    failed = F.col("event_type") == "error"
    user, value, next_value = F.col("user_id").cast("string"), k.cast("string"), (k + 1).cast("string")

    def text(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    both = '{"dataframe_split":{"columns":["user_id","events_last_90d"],"data":'
    # one kind of request after the other, by id
    request = (
        F.when(key % 10 == 0, text('{"inputs":[[', user, ",", value, "]]}"))
        .when(key % 10 == 1, text('{"dataframe_split":{"columns":["events_last_90d","user_id"],"data":[[', value, ",", user, "]]}}"))
        .when(key % 10 == 2, text(both, "[[", user, ",", value, "],[", user, ",", next_value, "]]}}"))
        .when(key % 10 == 4, text('{"dataframe_records":[{"user_id":', user, ',"events_last_90d":', value, "}]}"))
        .when(key % 50 == 5, text('{"instances":[{"events_last_90d":"', value, '"}]}'))
        .when(key % 50 == 15, text('{"instances":[[', user, ",", value, "]]}"))
        .when(key % 50 == 25, text('{"ping":', user, "}"))
        .when(key % 50 == 3, text(both, "[[", user, "]]}}"))
        .when(key % 50 == 13, text('{"dataframe_split":{"columns":["user_id"],"data":[[', user, "]]}}"))
        .when(key % 50 == 23, text(both, "[[", user, ',"n/a"]]}}'))
        .when(key % 50 == 33, text('{"dataframe_split":{"columns":["events_last_90d', user))
        .when(key % 50 == 43, F.lit(None).cast("string"))
        .when(key % 50 == 46, text(both, "[]}}"))
        .otherwise(text(both, "[[", user, ",", value, "]]}}"))
    )
    first, second = (k / F.lit(100.0)).cast("string"), ((k + 1) / F.lit(100.0)).cast("string")
    answer = F.when(key % 10 == 2, text('{"predictions":[', first, ",", second, "]}")).otherwise(
        text('{"predictions":[', first, "]}")
    )
    return events.select(
        key.cast("string").alias("request_id"),
        F.when(key % 3 == 0, F.col("user_id").cast("string")).alias("client_request_id"),
        F.col("ts").cast("date").alias("request_date"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp_ms"),
        F.when(key % 97 != 7, F.when(failed, 500).otherwise(200)).alias("status_code"),
        F.lit(1.0).alias("sampling_fraction"),
        F.round(F.col("value") * 10).cast("long").alias("execution_duration_ms"),
        request.alias("request"),
        F.when(~failed, answer).alias("response"),
        F.create_map(F.lit("endpoint"), F.col("event_type")).alias("request_metadata"),
    )


def inference_payload(spark: SparkSession, root: str) -> DataFrame:
    return payload_from_events(raw(spark, root, "events"))


def trials(spark: SparkSession, root: str) -> DataFrame:
    """Long-form training runs: every order is a run, every line item quantity a metric.

    Runs with ``o_orderkey % 4 = 0`` log no ``val_f1_score``; experiment 4 never does, and
    experiment 14 logs no metric at all.
    """
    orders = raw(spark, root, "orders")
    experiment = F.col("o_custkey") % 50
    value = F.round(F.pmod(F.col("o_totalprice"), F.lit(1000.0)) / F.lit(1000.0), 6)
    silent = (F.col("o_orderkey") % 4 == 0) | experiment.isin(4, 14)
    return (
        orders.select(
            F.concat(F.lit("exp_u_"), experiment.cast("string")).alias("experiment"),
            F.col("o_orderkey").alias("run_id"),
            F.col("o_orderdate").alias("start_time"),
            F.col("o_orderpriority").alias("model_family"),
            F.explode(
                F.create_map(
                    F.lit("val_f1_score"),
                    F.when(~silent, value),
                    F.lit("val_roc_auc"),
                    F.when(experiment != 14, F.round((value + 1) / 2, 6)),
                )
            ).alias("metric", "value"),
        )
    )


def alias_log(spark: SparkSession, root: str) -> DataFrame:
    """Alias assignments: every order moves an alias of a model to one of its versions."""
    return raw(spark, root, "orders").select(
        F.concat(F.lit("model_"), (F.col("o_custkey") % 100).cast("string")).alias("model"),
        F.when(F.col("o_orderkey") % 3 == 0, "Champion")
        .otherwise(F.when(F.col("o_orderkey") % 3 == 1, "Challenger").otherwise("Shadow"))
        .alias("alias"),
        (F.col("o_orderkey") % 20 + 1).cast("int").alias("version"),
        F.col("o_orderdate").alias("assigned_at"),
        F.col("o_orderkey").alias("sequence"),
    )


def versions(spark: SparkSession, root: str) -> DataFrame:
    """Registered versions: one per (model, version), remembering its first run."""
    return (
        raw(spark, root, "orders")
        .groupBy(
            F.concat(F.lit("model_"), (F.col("o_custkey") % 100).cast("string")).alias("model"),
            (F.col("o_orderkey") % 20 + 1).cast("int").alias("version"),
        )
        .agg(F.min("o_orderkey").alias("run_id"))
    )
