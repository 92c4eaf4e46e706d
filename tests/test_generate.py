from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from rekindle.contracts import BOOKS, SUBSCRIPTIONS, USERS
from rekindle.functions import draws
from rekindle.plans import generate as g

TODAY = date(2024, 6, 1)


@pytest.fixture(scope="module")
def tables(spark):
    ids, titles = g.keys(spark, 4000), g.keys(spark, 300)
    made = {
        "users": g.users(ids, TODAY),
        "books": g.books(titles),
        "events": g.reading_events(ids, titles, TODAY, events_per_user=20),
        "subs": g.subscriptions(ids, TODAY),
    }
    return {k: v.cache() for k, v in made.items()}


def share(df, condition):
    return df.agg(F.avg(F.expr(condition).cast("int"))).first()[0]


def test_invariants_hold(tables):
    rows = g.invariants(tables["users"], tables["books"], tables["events"], tables["subs"]).collect()
    assert len(rows) == 11 and {r.rule: r.violations for r in rows if r.violations} == {}


def test_contract_columns(tables):
    for name, schema in (("users", USERS), ("books", BOOKS), ("subs", SUBSCRIPTIONS)):
        assert [(f.name, f.dataType) for f in tables[name].schema] == [(f.name, f.dataType) for f in schema]


def test_shares_are_near_their_weights(tables):
    for column, values, weights in (
        ("plan_type", g.PLANS, g.PLAN_SHARES),
        ("age_band", g.AGE_BANDS, g.AGE_SHARES),
        ("region", g.REGIONS, g.REGION_SHARES),
        ("device_type", g.DEVICES, g.DEVICE_SHARES),
    ):
        for v, w in zip(values, weights):
            assert share(tables["users"], f"{column} = '{v}'") == pytest.approx(w, abs=0.03)
    events = tables["events"]
    assert share(events, "rating is null") == pytest.approx(0.8, abs=0.01)
    assert share(events, "progress_pct < 0.1") == pytest.approx(0.45, abs=0.01)
    assert share(events, "finished") == pytest.approx(0.25, abs=0.01)
    assert events.agg(F.avg("session_minutes")).first()[0] == pytest.approx(29.5, abs=0.7)
    assert events.count() == pytest.approx(4000 * 20, rel=0.1)
    assert share(tables["books"], "format = 'ebook'") == pytest.approx(0.6, abs=0.1)


def test_same_rows_for_any_partitioning(spark):
    def made(n):
        ids = spark.range(0, 200, 1, n).withColumnRenamed("id", "n")
        titles = spark.range(0, 20, 1, n).withColumnRenamed("id", "n")
        return g.reading_events(ids, titles, TODAY, 10), g.subscriptions(ids, TODAY)

    for one, many in zip(made(1), made(8)):
        assert sorted(map(repr, one.collect())) == sorted(map(repr, many.collect()))


def test_seed_changes_the_draws(spark):
    ids = g.keys(spark, 100)
    assert not g.users(ids, TODAY).exceptAll(g.users(ids, TODAY, seed=7)).isEmpty()


def test_heavy_user_is_spread(spark):
    plan = spark.createDataFrame([(0, 100_000), (1, 3), (2, 0)], "n long, k long")
    rows = g.fan_out(plan)
    per_task = rows.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in per_task) < 30_000
    got = {r.n: (r.c, r.lo, r.hi, r.d) for r in rows.groupBy("n").agg(
        F.count("*").alias("c"), F.min("i").alias("lo"), F.max("i").alias("hi"), F.countDistinct("i").alias("d")).collect()}
    assert got == {0: (100_000, 1, 100_000, 100_000), 1: (3, 1, 3, 3)}


def test_uniforms_are_uniform_and_independent(spark):
    u = draws.with_uniforms(spark.range(50_000), ["id"], ["a", "b"])
    r = u.agg(F.avg("a").alias("m"), F.stddev("a").alias("s"), F.corr("a", "b").alias("c"), F.min("a").alias("lo"), F.max("a").alias("hi")).first()
    assert r.m == pytest.approx(0.5, abs=0.01) and r.s == pytest.approx(12**-0.5, abs=0.01)
    assert abs(r.c) < 0.02 and 0 < r.lo and r.hi < 1


def test_weights_must_sum_to_one():
    with pytest.raises(ValueError):
        draws.choice(F.lit(0.5), ["a", "b"], [0.5, 0.6])


def test_active_period_ends_the_chain(tables):
    per_user = tables["subs"].groupBy("user_id").agg(
        F.count_if(F.col("end_date").isNull()).alias("open"), F.count("*").alias("n")
    )
    top = per_user.agg(F.max("open"), F.max("n")).first()
    assert tuple(top) == (1, 3)
