"""Model search with pyspark.ml: prepare once, fit a finite grid side by side, score every trial."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rekindle.contracts import (
    BOOLEAN_FEATURES,
    CATEGORICAL_FEATURES,
    KEY,
    LABEL,
    NUMERIC_FEATURES,
    RANDOM_SEED,
)
from rekindle.plans import evaluation
from rekindle.plans.preparation import Preparation
from rekindle.plans.registry import Fitted
from rekindle.session import scratch_path
from rekindle.sources.tables import materialised

FAMILIES = {
    "logistic_regression": LogisticRegression,
    "random_forest": RandomForestClassifier,
    "gradient_boosting": GBTClassifier,
    "naive_bayes": NaiveBayes,
}
#: Fits that run at a time; each has a scheduler pool of its own, so none waits for another's tasks.
FITS = 4
# What a spread of fits looks like by default; callers pass their own.
GRID: tuple[tuple[str, dict], ...] = (
    ("logistic_regression", {"regParam": 0.0, "maxIter": 200, "tol": 1e-9}),
    ("logistic_regression", {"regParam": 0.05, "elasticNetParam": 0.5, "maxIter": 20}),
    ("random_forest", {"numTrees": 20, "maxDepth": 5, "seed": RANDOM_SEED}),
    ("gradient_boosting", {"maxIter": 5, "maxDepth": 3, "seed": RANDOM_SEED}),
    ("naive_bayes", {"modelType": "gaussian"}),
)
# Names under which a trial's metrics are logged, prefixed by the split.
METRICS = {
    "f1": "f1_score",
    "accuracy": "accuracy",
    "precision": "precision",
    "recall": "recall",
    "log_loss": "log_loss",
    "roc_auc": "roc_auc",
    "pr_auc": "pr_auc",
}


@dataclass
class Search:
    """Result of a search: long-form metrics, the fitted parts of every run, and what they saw."""

    trials: DataFrame
    models: dict[str, Fitted] = field(default_factory=dict)
    #: (key, label, split, features), written; and (run_id, split, key, label, probability), written.
    ready: DataFrame | None = None
    scores: DataFrame | None = None


def fit_all(train: DataFrame, grid: Sequence[tuple[str, dict]], at_once: int = FITS) -> list:
    """The classifiers of the grid in its order, fitted some at a time on one written table.

    A failed fit fails the search. Thread and pool end with the call.
    """
    context = train.sparkSession.sparkContext

    def fit(place: int):
        family, params = grid[place]
        context.setLocalProperty("spark.scheduler.pool", f"trial-{place % at_once}")
        try:
            return FAMILIES[family](labelCol="label", featuresCol="features", **params).fit(train)
        finally:
            context.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return list(pool.map(inheritable_thread_target(train.sparkSession)(fit), range(len(grid))))


def with_scores(ready: DataFrame, models: dict[str, Fitted], kept: Sequence[str]) -> DataFrame:
    """Long form of all models' scores from one scan: ``run_id``, the kept columns, ``probability``."""
    out, cells = ready, []
    for k, (run, fitted) in enumerate(models.items()):
        own = fitted.classifier.copy()
        own.setFeaturesCol("features").setPredictionCol(f"_c{k}").setProbabilityCol(f"_p{k}").setRawPredictionCol(f"_r{k}")
        out = own.transform(out)
        share = F.get(vector_to_array(f"_p{k}"), F.lit(1))
        cells.append(F.struct(F.lit(run).alias("run_id"), share.alias("probability")))
    return out.select(*kept, F.inline(F.array(*cells)))


def fitted_trials(
    features: DataFrame,
    grid: Sequence[tuple[str, dict]] = GRID,
    label: str = LABEL,
    key: str = KEY,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    flags: Sequence[str] = BOOLEAN_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
) -> tuple[DataFrame, dict[str, Fitted]]:
    """Vectors of all splits ``(key, label, split, features)``, written, and every run's fitted parts.

    All fits read one written table of vectors, prepared on the training split alone.
    """
    spark = features.sparkSession
    inputs = dict.fromkeys([key, label, *numeric, *flags, *categorical])
    split = materialised(evaluation.stratified_split(features.select(*inputs), key, label), "split")
    preparation = Preparation.fit(
        split.where(F.col("split") == "train"), scratch_path(spark, "preparation"), numeric, flags, categorical
    )
    columns = [key, F.col(label).cast("int").alias("label"), "split", "features"]
    ready = materialised(preparation.transform(split).select(*columns), "prepared")
    fitted = fit_all(ready.where(F.col("split") == "train").select("label", "features"), grid)
    models = {f"run_{i:03d}": Fitted(preparation, model) for i, model in enumerate(fitted)}
    return ready, models


def train_trials(
    features: DataFrame,
    grid: Sequence[tuple[str, dict]] = GRID,
    label: str = LABEL,
    key: str = KEY,
    experiment: str = "reactivation",
    numeric: Sequence[str] = NUMERIC_FEATURES,
    flags: Sequence[str] = BOOLEAN_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
) -> Search:
    """Fit every grid entry on the training split and measure it on the other two.

    ``trials`` holds (experiment, run_id, start_time, model_family, metric, value) rows
    with metrics named ``val_*`` and ``test_*``. All scores come from one scan of the vectors and
    are written before they are measured.
    """
    spark = features.sparkSession
    ready, models = fitted_trials(features, grid, label, key, numeric, flags, categorical)
    held_out = ready.where(F.col("split") != "train")
    scores = materialised(with_scores(held_out, models, [key, "label", "split"]), "trial_scores")
    runs = [(f"run_{i:03d}", i, family) for i, (family, _) in enumerate(grid)]
    named = spark.createDataFrame(runs, "run_id string, position int, model_family string")
    keys = ["run_id", "split"]
    table = evaluation.metrics(scores, keys).join(evaluation.areas(scores, keys), keys).join(named, "run_id")
    prefix = F.when(F.col("split") == "validation", "val_").otherwise("test_")
    cells = [
        F.struct(F.concat(prefix, F.lit(name)).alias("metric"), F.col(m).alias("value")) for m, name in METRICS.items()
    ]
    trials = table.select(
        F.lit(experiment).alias("experiment"),
        "run_id",
        # Runs start in grid order; a clock would make the table differ from run to run.
        F.timestamp_seconds(F.col("position")).alias("start_time"),
        "model_family",
        F.inline(F.array(*cells)),
    )
    return Search(trials=trials, models=models, ready=ready, scores=scores)


def logistic_gradient(ready: DataFrame, fitted: Fitted) -> DataFrame:
    """Mean gradient of the log-loss at a logistic model's weights, ``(position, gradient)``.

    It is near zero at the optimum of an unregularised fit, whatever path led there. Gradients are
    of standardised features, position -1 is the intercept. One vector aggregate over the rows;
    sums of ``p * x`` and ``y * x`` merge as vectors.
    """
    run = with_scores(ready, {"run": fitted}, ["label", "features"])
    # a last coordinate of ones carries the intercept
    vector = array_to_vector(F.concat(vector_to_array("features"), F.array(F.lit(1.0))))
    rows = run.select(vector.alias("x"), F.col("probability").alias("p"), F.col("label").cast("double").alias("y"))
    sums = rows.select(
        Summarizer.sum(F.col("x"), F.col("p")).alias("p"),
        Summarizer.sum(F.col("x"), F.col("y")).alias("y"),
        Summarizer.std(F.col("x")).alias("sd"),
        F.count(F.lit(1)).alias("n"),
    )
    arrays = sums.select(*[vector_to_array(c).alias(c) for c in ("p", "y", "sd")], "n")
    cells = arrays.select(F.posexplode(F.arrays_zip("p", "y", "sd")).alias("at", "c"), "n", F.size("p").alias("d"))
    last = F.col("at") == F.col("d") - 1
    scale = F.when(last, F.lit(1.0)).when(F.col("c.sd") > 0, F.col("c.sd")).otherwise(F.lit(1.0))
    return cells.select(
        F.when(last, -1).otherwise(F.col("at")).cast("long").alias("position"),
        ((F.col("c.p") - F.col("c.y")) / F.col("n") / scale).alias("gradient"),
    )


def best_run(search: Search, preference: Sequence[str] = ("val_f1_score", "val_roc_auc")) -> str:
    """Run id of the best trial; one row reaches the driver."""
    row = evaluation.best_trial(search.trials, preference).first()
    if row is None:
        raise RuntimeError("the experiment has no runs")
    return row.run_id
