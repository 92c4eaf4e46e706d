"""Streaming jobs and model training, end to end on small data."""

from __future__ import annotations

import math
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from rekindle.catalog.features import feature_table
from rekindle.contracts import FEATURE_TABLE_COLUMNS, NUMERIC_FEATURES
from rekindle.plans import generate, monitoring, scoring, training
from rekindle.plans.monitoring import usage
from rekindle.plans.features import customer_features
from rekindle.plans.preparation import Preparation, dictionary
from rekindle.plans.registry import Fitted, Registry
from rekindle.session import scratch_path
from rekindle.sources.tables import materialised
from rekindle.streaming import jobs

LOG = "ts timestamp_ntz, status_code int"


def test_days_are_emitted_once_across_restarts(spark, frame):
    source, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "checkpoint"))

    def arrive(*rows):
        frame([(datetime(2024, 1, d, h), s) for d, h, s in rows], LOG).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = jobs.read_files(spark, source, frame([], LOG).schema)
        result = jobs.run_to_table(jobs.daily_usage(stream, F.col("ts")), out, checkpoint)
        return sorted((r.request_date.day, r.requests, r.ok, r.errors) for r in result.collect())

    arrive((1, 1, 200), (1, 2, 500), (1, 3, None), (2, 0, 200))
    assert run() == []  # the watermark (00:00 minus 10 minutes) is still inside day 1
    arrive((2, 5, 200))
    assert run() == [(1, 3, 1, 1)]
    arrive((3, 5, 200))
    assert run() == [(1, 3, 1, 1), (2, 2, 2, 0)]


def test_late_rows_restate_their_day(spark, frame):
    """A row two days late and rows without a time: the stream's sums equal the batch report's."""
    source, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "checkpoint"))
    schema, arrived = "ts timestamp, status_code int", []

    def arrive(*rows):
        rows = [(None if d is None else datetime(2024, 1, d, h), s) for d, h, s in rows]
        arrived.extend(rows)
        frame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = jobs.read_files(spark, source, frame([], schema).schema, files_per_trigger=1)
        found = jobs.restated_usage(stream, F.col("ts"), out, checkpoint).collect()
        days = {r.request_date and r.request_date.day: (r.requests, r.ok, r.errors) for r in found}
        log = frame(arrived, schema).withColumn("request_date", F.col("ts").cast("date"))
        assert days == {r.request_date and r.request_date.day: (r.requests, r.ok, r.errors) for r in usage(log).collect()}
        return {r.request_date and r.request_date.day: r.late for r in found}

    arrive((1, 1, 200), (1, 2, 500), (None, 0, 200))
    assert run() == {1: 0, None: 0}
    arrive((3, 5, 200), (1, 23, None))
    assert run() == {1: 0, 3: 0, None: 0}  # day 1 was open when these came
    arrive((1, 9, 200), (3, 6, 500), (None, 0, None))
    assert run() == {1: 1, 3: 0, None: 0}
    assert run() == {1: 1, 3: 0, None: 0}  # nothing new, nothing counted again


def test_a_failed_batch_is_counted_once(spark, frame):
    source, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "checkpoint"))
    frame([(datetime(2024, 1, 1), 200)] * 3, "ts timestamp, status_code int").write.parquet(source)
    stream = jobs.read_files(spark, source, frame([], "ts timestamp, status_code int").schema)
    whole = jobs._batches_to

    def dies(df, where, write):
        def once(batch, batch_id):
            write(batch, batch_id)
            raise RuntimeError("lost after writing")

        whole(df, where, once)

    jobs._batches_to = dies
    try:
        with pytest.raises(Exception, match="lost after writing"):
            jobs.restated_usage(stream, F.col("ts"), out, checkpoint)
    finally:
        jobs._batches_to = whole
    assert [r.requests for r in jobs.restated_usage(stream, F.col("ts"), out, checkpoint).collect()] == [3]


def test_requests_are_logged_once(spark, features):
    """The same file twice, in one run and in a later one, and a batch tried again."""
    source, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "checkpoint"))
    columns = list(FEATURE_TABLE_COLUMNS[2:])

    def run():
        feed = jobs.read_files(spark, source, features.schema, files_per_trigger=1)
        rows = jobs.score_feed(feed, columns, F.lit(date(2000, 1, 1)), scoring.COEFFICIENTS, scoring.INTERCEPT)
        return jobs.log_batches(jobs.once_per_request(rows), out, checkpoint)

    for _ in range(2):
        features.coalesce(1).write.mode("append").parquet(source)
    log = run()
    assert log.count() == log.select("request_id").distinct().count() == features.count()
    features.coalesce(1).write.mode("append").parquet(source)
    again = run()
    assert again.count() == features.count()
    batch = jobs.score_feed(features, columns, F.lit(date(2000, 1, 1)), scoring.COEFFICIENTS, scoring.INTERCEPT)
    assert again.select("request_id", "request", "response").exceptAll(batch.select("request_id", "request", "response")).isEmpty()
    # what was logged is what was scored: no feature drifts
    report = monitoring.drift_all(features, again, NUMERIC_FEATURES, exact=True)
    assert report.where("drifted").isEmpty() and report.where("production is null and train is not null").isEmpty()


@pytest.fixture(scope="module")
def features(spark):
    return materialised(feature_table(spark, "/root/testdata/sf0.01"), "features")


@pytest.fixture(scope="module")
def search(features):
    grid = (
        ("logistic_regression", {"regParam": 0.0, "maxIter": 200, "tol": 1e-9}),
        ("random_forest", {"numTrees": 3, "maxDepth": 3, "seed": 1}),
        ("naive_bayes", {"modelType": "gaussian"}),
    )
    return training.train_trials(features, grid)


def test_search_scores_and_picks(features, search):
    rows = search.trials.collect()
    assert len(rows) == 3 * 2 * len(training.METRICS)
    assert all(r.value is not None for r in rows)
    auc = {(r.run_id, r.metric): r.value for r in rows}
    assert all(0 <= v <= 1 for k, v in auc.items() if "log_loss" not in k[1])
    best = training.best_run(search, ("val_roc_auc",))
    assert auc[best, "val_roc_auc"] == max(auc[r, "val_roc_auc"] for r in search.models)
    assert training.best_run(search) == max(search.models, key=lambda r: (auc[r, "val_f1_score"], r))
    scored = scoring.score_batch(features, search.models[best])
    assert scored.columns == [*FEATURE_TABLE_COLUMNS, "prediction", "probability"]
    assert scored.schema["total_events"].dataType == features.schema["total_events"].dataType
    ends = scored.agg(F.count("probability"), F.min("probability"), F.max("probability")).first()
    assert ends[0] == features.count() and 0 <= ends[1] < ends[2] <= 1


def test_stored_metrics_follow_from_written_scores(search):
    rows = [r for r in search.scores.collect() if r.run_id == "run_001" and r.split == "test"]
    value = {r.metric: r.value for r in search.trials.where("run_id = 'run_001'").collect()}
    y, p = np.array([r.label for r in rows]), np.array([r.probability for r in rows])
    assert value["test_accuracy"] == pytest.approx(np.mean((p >= 0.5) == (y == 1)))
    assert value["test_log_loss"] == pytest.approx(-np.mean(np.log(np.where(y == 1, p, 1 - p))))
    one, none = p[y == 1][:, None], p[y == 0]
    assert value["test_roc_auc"] == pytest.approx(np.mean((one > none) + 0.5 * (one == none)))


def test_unregularised_fit_is_an_optimum(search):
    train = search.ready.where("split = 'train'")
    found = {r.position: r.gradient for r in training.logistic_gradient(train, search.models["run_000"]).collect()}
    assert max(map(abs, found.values())) < 1e-5 and -1 in found
    rows = train.select("label", vector_to_array("features").alias("x")).collect()
    x, y = np.array([r.x for r in rows]), np.array([r.label for r in rows])
    model = search.models["run_000"].classifier
    p = 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept)))
    direct = (p - y) @ x / len(y) / np.where(x.std(axis=0) > 0, x.std(axis=0, ddof=1), 1)
    assert [found[k] for k in range(x.shape[1])] == pytest.approx(direct.tolist(), abs=1e-9)
    away = model.copy()
    off = training.logistic_gradient(train, Fitted(search.models["run_000"].preparation, _moved(away)))
    assert off.agg(F.max(F.abs("gradient"))).first()[0] > 1e-3


def _moved(model):
    """The same model with another intercept, built through its stored form."""
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "moved")
    model.save(path)
    data = spark.read.parquet(f"{path}/data")
    data.withColumn("interceptVector", array_to_vector(F.array(F.lit(3.0)))).write.parquet(f"{path}-2/data")
    spark.read.text(f"{path}/metadata").write.text(f"{path}-2/metadata")
    return type(model).load(f"{path}-2")


def test_unseen_categories_and_missing_numbers_are_scored(spark, features):
    path = scratch_path(spark, "preparation")
    fitted = Preparation.fit(features, path)
    odd = features.limit(5).withColumns(
        {"region": F.lit("ATLANTIS"), "top_genre": F.lit(None).cast("string"), "pct_ebook": F.lit(None).cast("double")}
    )
    out = Preparation.load(spark, path).transform(odd)
    assert out.columns == [*odd.columns, "features"]
    slots = {(r.column_name, r.value): r.position for r in fitted.slots(spark).collect()}
    mean = features.agg(F.avg("pct_ebook")).first()[0]
    for row in out.select(vector_to_array("features").alias("x")).collect():
        assert len(row.x) == len(slots)
        assert row.x[slots["region", None]] == 1 and row.x[slots["top_genre", None]] == 1
        assert row.x[slots["pct_ebook", None]] == pytest.approx(mean)
        assert sum(row.x[k] for (c, _), k in slots.items() if c == "region") == 1


def test_dictionary_ranks_by_count_then_name(spark, frame):
    df = frame([("b", None), ("a", None), ("b", None), ("c", None), ("a", None), (None, None), ("É", None)], "x string, y string")
    got = dictionary(df, ["x", "y"]).orderBy("place").collect()
    assert [tuple(r) for r in got] == [("x", "a", 2, 0), ("x", "b", 2, 1), ("x", "c", 1, 2), ("x", "É", 1, 3)]
    assert dictionary(df.limit(0), ["x"]).collect() == []
    empty = Preparation.fit(df.limit(0), scratch_path(spark, "none"), [], [], ["x"])
    assert [r.features.toArray().tolist() for r in empty.transform(df).collect()] == [[1.0]] * 7


def test_many_categories_are_ranked_without_the_driver(spark):
    many = spark.range(300_000).select(F.md5(F.col("id").cast("string")).alias("x"))
    ranked = dictionary(many, ["x"])
    ends = ranked.agg(F.count("*"), F.min("place"), F.max("place"), F.countDistinct("place")).first()
    assert tuple(ends) == (300_000, 0, 299_999, 300_000)
    assert ranked.where("place = 7").first().value == many.orderBy("x").collect()[7].x


def test_models_outlive_their_session(spark, features, search):
    path = scratch_path(spark, "registry")
    registry = Registry(spark, path)
    assert registry.versions().count() == 0 and registry.resolved().count() == 0
    with pytest.raises(RuntimeError, match="alias"):
        registry.load("m")
    for run in ("run_000", "run_002"):
        registry.register("m", search.models[run], run, "some")
    registry.assign("m", "Champion", 1)
    registry.assign("m", "Challenger", 2)
    with pytest.raises(ValueError, match="version 9"):
        registry.assign("m", "Champion", 9)
    fresh = Registry(spark.newSession(), path)  # knows the path only
    for alias, run in (("Champion", "run_000"), ("Challenger", "run_002")):
        again = fresh.load("m", alias).score(features).select("user_id", "prediction", "probability")
        before = search.models[run].score(features).select("user_id", "prediction", "probability")
        assert sorted(again.collect()) == sorted(before.collect())
    fresh.assign("m", "Champion", 2)
    assert {(r.version, r.aliases) for r in registry.listing().collect()} == {(1, "-"), (2, "Challenger, Champion")}
    both = fresh.scored_by("m", features).groupBy("model").agg(F.sum("probability").alias("p")).collect()
    assert both[0].p == pytest.approx(both[1].p)


def test_a_registered_model_recomputes_from_its_coefficients(spark, features, search):
    registry = Registry(spark, scratch_path(spark, "registry"))
    registry.assign("m", "Champion", registry.register("m", search.models["run_000"], "run_000", "logistic_regression"))
    fitted = registry.load("m")
    weights = fitted.classifier.coefficients.toArray()
    slots = {(r.column_name, r.value): r.position for r in fitted.preparation.slots(spark).collect()}
    means = {c: features.agg(F.avg(c)).first()[0] for c in fitted.preparation.numeric}
    for row in fitted.score(features).limit(50).collect():
        z = fitted.classifier.intercept
        z += sum(weights[slots[c, None]] * (means[c] if row[c] is None else row[c]) for c in fitted.preparation.numeric)
        z += sum(weights[slots[c, None]] * bool(row[c]) for c in fitted.preparation.flags)
        z += sum(weights[slots.get((c, row[c]), slots[c, None])] for c in fitted.preparation.categorical)
        assert row.probability == pytest.approx(1 / (1 + math.exp(-z)))
        assert row.prediction == int(row.probability > 0.5)


def test_generated_users_go_all_the_way_to_scores(spark):
    """Tables of the generator, with keys of text, through features, training, storage and scoring."""
    today = date(2024, 6, 1)
    ids, titles = generate.keys(spark, 3000), generate.keys(spark, 100)
    table = materialised(
        customer_features(
            generate.users(ids, today),
            generate.books(titles),
            generate.reading_events(ids, titles, today, events_per_user=20),
            generate.subscriptions(ids, today),
            date(2024, 5, 2),
        ),
        "generated",
    )
    assert table.columns == list(FEATURE_TABLE_COLUMNS) and table.schema["user_id"].dataType.typeName() == "string"
    found = training.train_trials(table, (("logistic_regression", {"regParam": 0.01}),))
    registry = Registry(spark, scratch_path(spark, "registry"))
    registry.assign("m", "Champion", registry.register("m", found.models["run_000"], "run_000", "logistic_regression"))
    scored = registry.load("m").score(table)
    assert scored.count() == table.count() > 100
    assert scored.where("probability is null or probability < 0 or probability > 1").isEmpty()
    known = {r.metric: r.value for r in found.trials.collect()}
    assert known["test_roc_auc"] is not None and known["val_log_loss"] < 1


def test_udf_and_expression_agree(features):
    args = (scoring.COEFFICIENTS, scoring.INTERCEPT)
    both = scoring.score_with_udf(features, *args).withColumnRenamed("prediction", "u")
    gap = scoring.score_with_expression(both, *args).agg(F.max(F.abs(F.col("u") - F.col("prediction")))).first()[0]
    assert gap < 1e-12
    assert scoring.feature_columns(features) == list(FEATURE_TABLE_COLUMNS[2:])
