from __future__ import annotations

import math
import random
from datetime import datetime

import numpy as np
import pytest
from conftest import plan_of
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from rekindle.plans import evaluation

TRIALS = "experiment string, run_id long, start_time timestamp, model_family string, metric string, value double"


def test_split_is_exact_for_every_label(spark):
    df = spark.range(10_000).select(F.col("id").alias("user_id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    counts = {
        (r.y, r.split): r.n
        for r in evaluation.stratified_split(df, "user_id", "y").groupBy("y", "split").agg(F.count("*").alias("n")).collect()
    }
    assert counts == {
        (0, "train"): 5400, (0, "validation"): 1800, (0, "test"): 1800,
        (1, "train"): 600, (1, "validation"): 200, (1, "test"): 200,
    }


def test_split_does_not_depend_on_partitions_or_buckets(spark):
    df = spark.range(1000).select(F.col("id").alias("user_id"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    a = evaluation.stratified_split(df, "user_id", "y")
    b = evaluation.stratified_split(df.repartition(7), "user_id", "y", buckets=8)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_metrics_are_zero_where_undefined(frame):
    scores = frame([("m", 0, 0.1), ("m", 0, 0.2)], "model string, label int, probability double")
    r = evaluation.metrics(scores).first()
    assert (r.accuracy, r.precision, r.recall, r.f1) == (1.0, 0.0, 0.0, 0.0)
    assert evaluation.roc_auc(scores).first().roc_auc is None


def test_log_loss_of_certain_scores_is_finite(frame):
    scores = frame([("m", 1, 0.0), ("m", 0, 1.0)], "model string, label int, probability double")
    assert evaluation.metrics(scores).first().log_loss == pytest.approx(-math.log(1e-15), rel=1e-2)


def test_areas_match_the_evaluator(spark):
    p = F.pmod(F.hash("id"), F.lit(1000)) / 1000.0
    noisy = (p + F.pmod(F.hash("id", F.lit(1)), F.lit(1000)) / 1000.0 > 1.2).cast("int")
    scores = spark.range(5000).select(F.lit("m").alias("model"), noisy.alias("label"), (p + 0.0005).alias("probability"))
    for name, area in (("areaUnderROC", evaluation.roc_auc), ("areaUnderPR", evaluation.pr_auc)):
        expected = BinaryClassificationEvaluator(
            rawPredictionCol="probability", labelCol="label", metricName=name, numBins=0
        ).evaluate(scores)
        assert area(scores).first()[1] == pytest.approx(expected, abs=1e-9)


def test_checks_warn_and_fail(frame, spark):
    def status(df):
        return {r.check_name: r.status for r in evaluation.dataset_checks(df).collect()}

    labels = spark.range(500).select((F.col("id") < 60).cast("int").alias("will_reactivate"))
    assert status(labels) == {"non_empty": "ok", "binary_label": "ok", "positives": "warn"}
    bad = frame([(None,), (2,)], "will_reactivate int")
    assert status(bad) == {"non_empty": "ok", "binary_label": "fail", "positives": "fail"}
    assert status(frame([], "will_reactivate int"))["non_empty"] == "fail"


def test_profile_counts_nulls_and_distinct(frame):
    df = frame([(1, "a"), (1, "b"), (None, "b"), (4, None)], "x int, s string")
    rows = {r.column_name: r for r in evaluation.profile_columns(df, ["x", "s"]).collect()}
    x, s = rows["x"], rows["s"]
    assert (x.n, x.nulls, x.distinct_values, x["mean"], x["min"], x["max"]) == (4, 1, 2, 2.0, 1.0, 4.0)
    assert x.stddev == pytest.approx(math.sqrt(3))
    assert (s.n, s.nulls, s.distinct_values, s["mean"]) == (4, 1, 2, None)


def test_best_trial_follows_the_preference(frame):
    t = [datetime(2024, 1, d) for d in range(1, 5)]
    rows = [
        ("first", 1, t[0], "a", "val_f1_score", 0.2), ("first", 1, t[0], "a", "val_roc_auc", 0.9),
        ("first", 2, t[1], "b", "val_f1_score", 0.3), ("first", 3, t[2], "b", "val_f1_score", None),
        ("second", 4, t[0], "a", "val_f1_score", None), ("second", 4, t[0], "a", "val_roc_auc", 0.7),
        ("second", 5, t[3], "a", "val_roc_auc", 0.6),
        ("none", 6, t[0], "a", "val_f1_score", None), ("none", 7, t[1], "a", "val_f1_score", None),
    ]
    best = {r.experiment: (r.run_id, r.metric, r.value) for r in evaluation.best_trial(frame(rows, TRIALS)).collect()}
    assert best == {
        "first": (2, "val_f1_score", 0.3),
        "second": (4, "val_roc_auc", 0.7),
        "none": (7, None, None),
    }


def test_leaderboard_drops_rows_before_the_shuffle(spark):
    trials = spark.range(1000).select(
        F.when(F.col("id") >= 0, "hot").otherwise("cold").alias("experiment"), F.col("id").alias("run_id"), F.lit("f").alias("model_family"),
        F.lit("m").alias("metric"), (F.col("id") % 100).cast("double").alias("value"),
    )
    board = evaluation.leaderboard(trials, "m", top=3)
    assert [(r["rank"], r.run_id) for r in board.orderBy("rank").collect()] == [(1, 99), (2, 199), (3, 299)]
    assert "WindowGroupLimit" in plan_of(board)


def test_alias_points_to_one_version(frame):
    t = [datetime(2024, 1, d) for d in range(1, 4)]
    log = frame(
        [("m", "Champion", 1, t[0], 1), ("m", "Champion", 2, t[1], 2), ("m", "Challenger", 2, t[2], 3)],
        "model string, alias string, version int, assigned_at timestamp, sequence long",
    )
    versions = frame([("m", 1, "r1"), ("m", 2, "r2")], "model string, version int, run_id string")
    listing = {r.version: r.aliases for r in evaluation.version_listing(versions, log).collect()}
    assert listing == {1: "-", 2: "Challenger, Champion"}


def test_champion_challenger_picks_by_metric(frame):
    rows = [("a", 1, 0.9), ("a", 0, 0.8), ("b", 1, 0.6), ("b", 0, 0.4)]
    scores = frame(rows, "model string, label int, probability double")
    for metric in ("f1", "log_loss"):
        winners = {r.model: r.winner for r in evaluation.champion_challenger(scores, metric).collect()}
        assert winners == {"a": False, "b": True}


def test_rare_positives_rank_perfectly(spark):
    """Scores far below one another's usual spacing are still told apart, in any number of parts."""
    rows = [("m", 1 if k < 100 else 0, 0.001 - k * 1e-7) for k in range(2000)]
    scores = spark.createDataFrame(rows, "model string, label int, probability double")
    for parts in (1, 7):
        dealt = scores.repartition(parts)
        assert evaluation.roc_auc(dealt).first().roc_auc == 1.0
        assert abs(evaluation.pr_auc(dealt).first().pr_auc - 1.0) < 1e-9


def test_areas_over_many_ranges(spark):
    """Models of any size, ties included, against all pairs; the wide one is spread over tasks."""
    rng = random.Random(4)
    rows = [(m, rng.randrange(2), rng.randrange(k) / 1000) for m, k, n in (("wide", 10**6, 3000), ("tied", 5, 500), (None, 50, 200)) for _ in range(n)]
    scores = spark.createDataFrame(rows, "model string, label int, probability double")
    for r in evaluation.areas(scores).collect():
        one = [p for m, y, p in rows if m == r.model and y == 1]
        none = [p for m, y, p in rows if m == r.model and y == 0]
        wins = sum((a > b) + 0.5 * (a == b) for a in one for b in none)
        assert r.roc_auc == pytest.approx(wins / len(one) / len(none))
    board = spark.createDataFrame(
        [("e", f"r{k:04d}", "f", "m", float(k % 7)) for k in range(2000)] + [(None, "x", "f", "m", 1.0)],
        "experiment string, run_id string, model_family string, metric string, value double",
    )
    ranks = {(r.experiment, r.run_id): r["rank"] for r in evaluation.leaderboard(board, "m").collect()}
    order = sorted(range(2000), key=lambda k: (-(k % 7), k))
    assert all(ranks["e", f"r{k:04d}"] == place + 1 for place, k in enumerate(order)) and ranks[None, "x"] == 1


def test_comoments_merge_like_one_pass(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 3)) + np.array([1.7e12, 0.0, 5.0])
    x[:, 2] = x[:, 0] - 1.7e12 + 0.1 * x[:, 1]
    x[::7, 1] = np.nan
    x[300:, 2] = np.nan
    rows = [[None if np.isnan(v) else float(v) for v in r] + [4.5, None] for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, flat double, none double").repartition(9)
    found = {(r.column_a, r.column_b): r.correlation for r in evaluation.correlations(df, df.columns).collect()}
    for i, j in ((0, 1), (0, 2), (1, 2)):
        known = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        expected = np.corrcoef(x[known, i] - np.nanmean(x[:, i]), x[known, j])[0, 1]
        assert found["abc"[i], "abc"[j]] == pytest.approx(expected, abs=1e-4 if i == 0 else 1e-9)
    assert all(v is None for k, v in found.items() if "flat" in k or "none" in k) and len(found) == 10
    assert evaluation.correlations(df.limit(0), ["a", "b"]).collect() == []
    profile = {r.column_name: r for r in evaluation.profile_columns(df, ["a", "flat", "none"]).collect()}
    assert profile["a"].stddev == pytest.approx(np.std(x[:, 0] - 1.7e12, ddof=1), rel=1e-3)
    assert (profile["flat"].stddev, profile["none"]["mean"], profile["none"].nulls) == (0.0, None, 600)


def test_missing_scores_and_labels_count_nowhere(spark):
    rows = [("m", 1, 0.9), ("m", 0, 0.1), ("m", 0, None), ("m", None, 0.2)]
    scores = spark.createDataFrame(rows, "model string, label int, probability double")
    row = evaluation.metrics(scores).first()
    assert (row.n, row.unscored, row.accuracy) == (2, 2, 1.0) and row.log_loss < 0.11
    assert evaluation.roc_auc(scores).first().roc_auc == 1.0


def test_large_values_keep_their_spread(spark):
    table = spark.range(5).select((F.col("id") + 1_700_000_000_000).alias("x"))
    assert abs(evaluation.profile_columns(table, ["x"]).first().stddev - 1.5811388) < 1e-6


def test_split_and_best_trial_take_text_keys(spark):
    keys = spark.range(500).select(F.format_string("u_%06d", "id").alias("user_id"), (F.col("id") % 2).alias("y"))
    counts = evaluation.stratified_split(keys, "user_id", "y").groupBy("y", "split").count().collect()
    assert sorted((r.y, r.split, r["count"]) for r in counts) == [
        (y, s, n) for y in (0, 1) for s, n in (("test", 50), ("train", 150), ("validation", 50))
    ]
    rows = [("e", "run_b", 1, "f", "val_f1_score", 0.5), ("e", "run_a", 1, "f", "val_f1_score", 0.5)]
    trials = spark.createDataFrame(
        rows, "experiment string, run_id string, start_time int, model_family string, metric string, value double"
    )
    assert evaluation.best_trial(trials).first().run_id == "run_a"
    assert evaluation.leaderboard(trials, "val_f1_score").count() == 2
