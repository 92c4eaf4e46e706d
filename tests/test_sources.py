from __future__ import annotations

import math
import os
from datetime import date, datetime

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rekindle.contracts import PAYLOAD
from rekindle.functions import scalars
from rekindle.operators import filters, joins, projections, ranking
from rekindle.plans import clustered
from rekindle.plans.features import customer_features
from rekindle.session import scratch_path
from rekindle.sources import payload, snapshots, tables, views
from rekindle.sources.tables import own_name

SCHEMA = T.StructType(
    [T.StructField("id", T.LongType(), False), T.StructField("x", T.IntegerType(), True)]
)


def test_enforce_orders_casts_and_checks(frame):
    good = tables.enforce_schema(frame([("7", 1)], "x string, id int"), SCHEMA)
    assert good.schema == SCHEMA and tuple(good.first()) == (1, 7)
    with pytest.raises(Exception, match="NULL in NOT NULL column id"):
        tables.enforce_schema(frame([(1, None)], "x int, id int"), SCHEMA).collect()
    with pytest.raises(ValueError, match="missing"):
        tables.enforce_schema(frame([(1,)], "id int"), SCHEMA)


def test_violations_are_counted(frame):
    df = frame([("zz", None), ("3", 1), (None, 2)], "x string, id int")
    rows = {r.column_name: (r.null_violations, r.cast_failures) for r in tables.schema_violations(df, SCHEMA).collect()}
    assert rows == {"id": (1, 0), "x": (0, 1)}


def test_nan_becomes_null(frame):
    df = frame([(float("nan"),), (4.0,), (None,)], "r double")
    assert [r[0] for r in df.select(tables.nan_to_null_int(F.col("r"))).collect()] == [None, 4, None]


def test_missing_and_empty_tables(spark):
    with pytest.raises(RuntimeError, match="does not exist yet. Wait"):
        tables.require_table(spark, "no_such_table", "Wait for the first flush.")
    tables.overwrite_table(spark.range(0), "empty_table", scratch_path(spark, "empty"))
    with pytest.warns(UserWarning, match="holds no rows"):
        tables.require_table(spark, "empty_table")
    with pytest.raises(RuntimeError, match="features is empty"):
        tables.require_rows(spark.range(0), "features")


def test_overwrite_replaces_rows_and_columns(spark):
    path = scratch_path(spark, "replaced")
    tables.overwrite_table(spark.range(5), "replaced", path)
    again = tables.overwrite_table(spark.range(2).select(F.lit("a").alias("s")), "replaced", path, replace_schema=True)
    assert again.columns == ["s"] and again.count() == 2


def test_roundtrip_drops_the_table_even_on_failure(spark, monkeypatch):
    assert tuple(tables.roundtrip(spark.range(3), "trip", scratch_path(spark, "trip")).first()) == (3, 3, True)
    assert not spark.catalog.tableExists("trip")
    bad = spark.range(3).select(F.raise_error(F.lit("broken source")).cast("int").alias("x"))
    with pytest.raises(Exception, match="broken source"):
        tables.roundtrip(bad, "trip", scratch_path(spark, "trip"))
    assert not spark.catalog.tableExists("trip")


def test_log_is_partitioned_by_day(spark, small):
    path = scratch_path(spark, "log")
    table = payload.write_log(views.inference_payload(spark, small), "request_log", path)
    day = table.where("request_date = DATE '2024-01-05'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(request_date" in plan
    back = payload.read_log(spark, path)
    assert back.count() == 1000 and set(back.columns) == {f.name for f in PAYLOAD}


def test_scratch_follows_the_cluster_setting():
    class Session:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.checkpoint.dir": "hdfs://shared/"}.get(key, default)

    assert scratch_path(Session, "x").startswith("hdfs://shared/x-")


def test_contains_takes_wildcards_literally(frame):
    names = frame([("exp_ana_1",), ("expXana",), ("50%",)], "name string")
    assert [r.name for r in filters.name_contains(names, "name", "_ana").collect()] == ["exp_ana_1"]
    assert filters.name_contains(names, "name", "%").count() == 1


def test_slugs(frame):
    mails = ["Ana.Maria+x@a.b", "__J0hn--Doe__@x", "áé@x", "a" * 40 + "@x", "no-at-sign"]
    got = [r[0] for r in frame([(m,) for m in mails], "m string").select(scalars.slug(F.col("m"))).collect()]
    assert got == ["ana_maria_x", "j0hn_doe", "", "a" * 24, "no_at_sign"]


def test_clip_keeps_null_and_truncates(frame):
    df = frame([(None,), (-5.0,), (99.9,), (1e9,)], "x double")
    assert [r[0] for r in df.select(scalars.clip_int(F.col("x"), 60, 1500)).collect()] == [None, 60, 99, 1500]


def test_percent_of_nothing_is_null(frame):
    df = frame([(0, 0), (1, 3)], "a int, b int")
    assert [r[0] for r in df.select(scalars.percent(F.col("a"), F.col("b"))).collect()] == [None, 33.33]


def test_ids_are_padded_not_cut(frame):
    df = frame([(7,), (1234567,)], "n long")
    assert [r[0] for r in df.select(scalars.format_id("u_", 6, F.col("n"))).collect()] == ["u_000007", "u_1234567"]


def test_counts_by_attribute_drops_unmatched(frame):
    fact = frame([(1,), (1,), (2,), (9,), (None,)], "k int")
    dim = frame([(1, "a"), (2, "a"), (3, "b")], "k int, t string")
    assert [tuple(r) for r in joins.counts_by_attribute(fact, dim, "k", "t").collect()] == [("a", 3)]


def test_top1_on_a_hot_key(spark):
    df = spark.range(30_000).select(F.lit(1).alias("u"), F.concat(F.lit("g"), (F.col("id") % 7).cast("string")).alias("g"))
    assert tuple(ranking.top1_per_key(df, "u", "g", "best").first()) == (1, "g0")


def test_require_column_names_the_columns(frame):
    with pytest.raises(ValueError, match="it has: a"):
        projections.require_column(frame([(1,)], "a int"), "b")


def test_relative_difference(frame):
    df = frame([(10.0, 12.0), (-4.0, -5.0), (0.0, 1.0)], "a double, b double")
    got = [r[0] for r in df.select(scalars.relative_difference(F.col("a"), F.col("b"))).collect()]
    assert got[:2] == [0.2, 0.25] and got[2] is None and not math.isnan(got[0])


def test_roundtrip_leaves_a_standing_table_alone(spark):
    name = tables.own_name("standing")
    spark.range(3).write.saveAsTable(name)
    with pytest.raises(ValueError, match="exists already"):
        tables.roundtrip(spark.range(1).toDF("id"), name)
    assert spark.table(name).count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_a_killed_replacement_leaves_the_old_rows(spark, frame):
    root = scratch_path(spark, "safe")
    with pytest.raises(RuntimeError, match="no rows yet"):
        snapshots.current(spark, root)
    old = frame([(1, "a"), (2, "b")], "id int, x string")
    snapshots.replace(old, root)
    breaks = spark.range(1000).select(F.when(F.col("id") < 990, F.col("id")).otherwise(F.raise_error(F.lit("killed"))).alias("id"))
    with pytest.raises(Exception, match="killed"):
        snapshots.replace(breaks.repartition(4), root)
    assert sorted(map(tuple, snapshots.current(spark, root).collect())) == [(1, "a"), (2, "b")]
    # a table may be computed from itself, and may change its columns
    table = snapshots.current(spark, root)
    new = snapshots.replace(table.selectExpr("id + 10 AS id"), root)
    assert sorted(r.id for r in new.collect()) == [11, 12] and table.count() == 2
    assert sorted(r.id for r in snapshots.current(spark, root, 1).collect()) == [1, 2]
    snapshots.prune(spark, root)
    assert sorted(r.id for r in snapshots.current(spark, root).collect()) == [11, 12]
    assert len([d for d in os.listdir(root) if d.startswith("rows-")]) == 1
    assert snapshots.replace(new.where("id < 0"), root).count() == 0


def test_replacing_a_day_leaves_the_files_of_others(spark, frame):
    path, schema = scratch_path(spark, "days"), "id int, day string"
    snapshots.replace_days(frame([(1, "a"), (2, "b"), (3, "c")], schema), path, "day")
    before = {d: os.listdir(f"{path}/day={d}") for d in "abc"}
    after = snapshots.replace_days(frame([(7, "b"), (8, "b")], schema), path, "day")
    assert sorted(map(tuple, after.collect())) == [(1, "a"), (3, "c"), (7, "b"), (8, "b")]
    assert {d for d in "abc" if os.listdir(f"{path}/day={d}") != before[d]} == {"b"}


def test_clustered_inputs_need_no_exchange_and_split_hot_users(spark, frame):
    days = [datetime(2023, 12, 1 + k % 28) for k in range(28)]
    events = [("hot", f"b{k % 97}", days[k % 28], 0.5, 10, False, None) for k in range(3000)]
    events += [(f"u{k % 300}", f"b{k % 97}", days[k % 28], 0.5, 10, True, 5) for k in range(6000)]
    schema = "user_id string, book_id string, event_ts timestamp, progress_pct double, session_minutes int, finished boolean, rating int"
    made = frame(events, schema)
    users = made.select("user_id").distinct().selectExpr("user_id", "DATE'2020-01-01' AS signup_date", "'free' AS plan_type", "'x' AS age_band", "'y' AS region", "'z' AS device_type")
    books = made.select("book_id").distinct().selectExpr("book_id", "'t' AS title", "'g' AS genre", "'ebook' AS format", "1 AS length_minutes", "'en' AS language")
    subs = frame([("hot", date(2023, 1, 1), None, None)], "user_id string, start_date date, end_date date, cancel_reason string")
    own = clustered.store_inputs(users, made, subs, own_name("t"), scratch_path(spark, "clustered"), 8)
    plain = customer_features(users, books, made, subs, date(2024, 2, 1))
    table = customer_features(own[0], books, own[1], own[2], date(2024, 2, 1))
    assert sorted(map(str, plain.collect())) == sorted(map(str, table.collect())) and table.count() == 301

    def exchanges(df):
        return plan_of(df).partition("\n\n\n")[0].count("- Exchange")

    assert exchanges(table) < exchanges(plain)
    scan = plan_of(table).partition("\n\n\n")[0].split("Scan parquet spark_catalog")[0].rpartition("HashAggregate")
    assert "Exchange" not in scan[2]
    files = own[1].where("user_id = 'hot'").select(F.input_file_name().alias("f")).distinct().count()
    assert files > 4
