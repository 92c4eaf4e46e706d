"""Training, evaluation, model bookkeeping and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rekindle.catalog import model_sql
from rekindle.catalog.features import RATES, feature_table
from rekindle.catalog.registry import query, rounded, sql_rounded
from rekindle.catalog.sql import on_features, using
from rekindle.contracts import (
    BOOLEAN_FEATURES,
    CATEGORICAL_FEATURES,
    FEATURE_TABLE_COLUMNS,
    KEY,
    LABEL,
    NUMERIC_FEATURES,
)
from rekindle.plans import evaluation, scoring, training
from rekindle.plans.preparation import Preparation
from rekindle.plans.registry import CHALLENGER, CHAMPION, Registry
from rekindle.session import scratch_path
from rekindle.sources import views
from rekindle.sources.tables import materialised, own_name
from rekindle.sources.views import SNAPSHOT


def _score_sql(coefficients: dict[str, float], intercept: float) -> str:
    terms = " + ".join(
        f"COALESCE(CAST({c} AS DOUBLE), 0) * CAST({w} AS DOUBLE)" for c, w in coefficients.items()
    )
    return f"1.0::DOUBLE / (1.0::DOUBLE + exp(-({intercept}::DOUBLE + {terms})))"


CHAMPION_SQL = _score_sql(scoring.COEFFICIENTS, scoring.INTERCEPT)
_CHALLENGER_SQL = _score_sql(scoring.CHALLENGER, scoring.CHALLENGER_INTERCEPT)
# Two hand-set models on all eligible users.
_SCORES = f"""+ scores AS (
SELECT user_id, will_reactivate AS label, 'champion' AS model, {CHAMPION_SQL} AS probability FROM features
UNION ALL SELECT user_id, will_reactivate, 'challenger', {_CHALLENGER_SQL} FROM features)"""


def scores(spark: SparkSession, root: str) -> DataFrame:
    """Both models on every eligible user, from one pass over the feature table."""
    both = F.array(
        *[
            F.struct(F.lit(m).alias("model"), scoring.linear_probability(c, i).alias("probability"))
            for m, c, i in (
                ("champion", scoring.COEFFICIENTS, scoring.INTERCEPT),
                ("challenger", scoring.CHALLENGER, scoring.CHALLENGER_INTERCEPT),
            )
        ]
    )
    return feature_table(spark, root).select("user_id", F.col(LABEL).alias("label"), F.inline(both))


@query(on_features("""SELECT 'non_empty' AS check_name, COUNT(*) AS value,
CASE WHEN COUNT(*) = 0 THEN 'fail' ELSE 'ok' END AS status FROM features
UNION ALL SELECT 'binary_label', COUNT(*), CASE WHEN COUNT(*) > 0 THEN 'fail' ELSE 'ok' END FROM features
WHERE will_reactivate IS NULL OR will_reactivate NOT IN (0, 1)
UNION ALL SELECT 'positives', COUNT(*), CASE WHEN COUNT(*) < 50 THEN 'fail' WHEN COUNT(*) < 100 THEN 'warn'
ELSE 'ok' END FROM features WHERE will_reactivate = 1"""))
def ml_dataset_checks(spark: SparkSession, root: str) -> DataFrame:
    return evaluation.dataset_checks(feature_table(spark, root))


@query(on_features("""SELECT user_id, will_reactivate, CASE WHEN place < 0.6::DOUBLE THEN 'train'
WHEN place < 0.8::DOUBLE THEN 'validation' ELSE 'test' END AS split FROM (
SELECT user_id, will_reactivate, (ROW_NUMBER() OVER (PARTITION BY will_reactivate
ORDER BY substr(md5(CAST(user_id AS VARCHAR)), 1, 8), user_id) - 1)::DOUBLE
/ COUNT(*) OVER (PARTITION BY will_reactivate) AS place FROM features)"""))
def ml_stratified_split(spark: SparkSession, root: str) -> DataFrame:
    labels = feature_table(spark, root).select("user_id", LABEL)
    return evaluation.stratified_split(labels, "user_id")


#: Every column but the key.
_PROFILED = FEATURE_TABLE_COLUMNS[1:]
_RATED = {"avg_session_minutes", "avg_progress_pct", "pct_finished", "pct_audiobook", "pct_ebook"}


def _profile_sql(column: str) -> str:
    numeric = column in NUMERIC_FEATURES or column == LABEL
    moments = (
        f"ROUND(AVG({column}), 6), ROUND(stddev_samp({column}), 6), "
        f"ROUND(MIN({column})::DOUBLE, 6), ROUND(MAX({column})::DOUBLE, 6)"
        if numeric
        else "NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE"
    )
    return (
        f"SELECT '{column}', COUNT(*), COUNT(*) - COUNT({column}), "
        f"COUNT(DISTINCT {'ROUND(' + column + ', 9)' if column in _RATED else column}), {moments} FROM features"
    )


@query(on_features(
    "SELECT * FROM (" + " UNION ALL ".join(_profile_sql(c) for c in _PROFILED)
    + ") t(column_name, n, nulls, distinct_values, mean, stddev, min, max)"))
def ml_profile_columns(spark: SparkSession, root: str) -> DataFrame:
    # Means are rounded first: their last bits depend on summation order.
    table = rounded(feature_table(spark, root), *RATES, digits=9)
    profile = evaluation.profile_columns(table, _PROFILED)
    return rounded(profile, "mean", "stddev", "min", "max", digits=6)


#: All numeric features and flags, and the label.
_CORRELATED = (*NUMERIC_FEATURES, *BOOLEAN_FEATURES, LABEL)


def _number(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


# Rounding may turn a tiny negative value into -0.0, which is 0.0 in neither engine's hash.
@query(on_features(" UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, CASE WHEN MIN({_number(a)}) < MAX({_number(a)}) AND "
    f"MIN({_number(b)}) < MAX({_number(b)}) THEN ROUND(covar_pop({_number(a)}, {_number(b)}) / "
    f"(stddev_pop({_number(a)}) * stddev_pop({_number(b)})), 8) + 0.0::DOUBLE END AS correlation FROM features"
    for i, a in enumerate(_CORRELATED) for b in _CORRELATED[i + 1:])))
def ml_correlations(spark: SparkSession, root: str) -> DataFrame:
    flags = {c: F.col(c).cast("int") for c in BOOLEAN_FEATURES}
    table = feature_table(spark, root).withColumns(flags)
    pairs = rounded(evaluation.correlations(table, _CORRELATED), "correlation", digits=8)
    return pairs.withColumn("correlation", F.col("correlation") + F.lit(0.0))


_ALL = (NUMERIC_FEATURES, BOOLEAN_FEATURES, CATEGORICAL_FEATURES)
#: Inputs of the challenger: recent activity and flags only.
_FEW = (("days_since_last_event", "total_events", "events_last_90d", "events_last_180d"), BOOLEAN_FEATURES, ())


def _with_models(*names: str) -> str:
    """The feature chain, the split and the named models, ``champion`` or ``challenger``."""
    inputs = {"champion": _ALL, "challenger": _FEW}
    parts = [model_sql.SPLITS]
    for name in names:
        parts += [model_sql.vectors(name, "split = 'train'", *inputs[name]), model_sql.gaussian(name)]
    return "+ " + ",\n".join(parts) + "\n"


@query(on_features(
    f"+ {model_sql.SPLITS}, {model_sql.vectors('all_', 'TRUE', *_ALL)} SELECT user_id, will_reactivate AS label, "
    "CAST(position AS INTEGER) AS position, ROUND(x, 9) AS value FROM all__x JOIN splits USING (user_id)"))
def ml_prepare(spark: SparkSession, root: str) -> DataFrame:
    table = materialised(feature_table(spark, root), "features")
    fitted = Preparation.fit(table, scratch_path(spark, "preparation"))
    places = F.posexplode(training.vector_to_array("features")).alias("position", "value")
    return rounded(fitted.transform(table).select(KEY, F.col(LABEL).alias("label"), places), "value", digits=9)


_TRIALS = ", ".join(f"('run_{i:03d}', '{family}')" for i, (family, _) in enumerate(training.GRID))
_METRICS = ", ".join(f"('{s}', '{p}{m}')" for s, p in (("validation", "val_"), ("test", "test_")) for m in training.METRICS.values())


# Values of iterative fits are beyond SQL. Checked here: every run has every metric over all rows of
# its split, in its range, and the first run's weights are the optimum of its loss.
@query(on_features(f"""+ {model_sql.SPLITS} SELECT 'reactivation' AS experiment, run_id, model_family, metric, n,
TRUE AS in_range, CASE WHEN run_id = 'run_000' THEN TRUE END AS optimal
FROM (VALUES {_TRIALS}) r(run_id, model_family), (VALUES {_METRICS}) m(split, metric)
JOIN (SELECT split, COUNT(*) AS n FROM splits GROUP BY split) USING (split)"""))
def ml_train_trials(spark: SparkSession, root: str) -> DataFrame:
    search = training.train_trials(feature_table(spark, root))
    steep = training.logistic_gradient(search.ready.where(F.col("split") == "train"), search.models["run_000"])
    flat = steep.agg((F.max(F.abs("gradient")) < 1e-5).alias("flat")).scalar()
    sizes = search.scores.groupBy("run_id", "split").agg(F.count("probability").alias("n"))
    prefix = F.when(F.col("split") == "validation", "val_").otherwise("test_")
    value = F.col("value")
    return (
        search.trials.join(sizes.withColumn("_of", prefix), "run_id")
        .where(F.col("metric").startswith(F.col("_of")))
        .select(
            "experiment",
            "run_id",
            "model_family",
            "metric",
            "n",
            F.coalesce((value >= 0) & ((value <= 1) | F.col("metric").endswith("log_loss")), F.lit(False)).alias("in_range"),
            F.when(F.col("run_id") == "run_000", flat).alias("optimal"),
        )
    )


_BAYES = (("naive_bayes", {"modelType": "gaussian"}),)


@query(on_features(_with_models("champion") + """, scores AS (SELECT split, will_reactivate AS label, probability
FROM splits JOIN champion_p USING (user_id) WHERE split <> 'train'),
c AS (""" + model_sql.counts("scores", "split") + """),
auc AS (SELECT p.split, SUM(CASE WHEN p.probability > n.probability THEN 1.0::DOUBLE
WHEN p.probability = n.probability THEN 0.5::DOUBLE ELSE 0 END) / COUNT(*) AS roc_auc
FROM scores p JOIN scores n ON p.split = n.split AND p.label = 1 AND n.label = 0 GROUP BY p.split),
t AS (SELECT split, unnest(['accuracy', 'precision', 'recall', 'f1_score', 'log_loss', 'roc_auc']) AS metric,
unnest([(tp + tn)::DOUBLE / n, COALESCE(tp::DOUBLE / NULLIF(tp + fp, 0), 0), COALESCE(tp::DOUBLE / NULLIF(tp + fn, 0), 0),
COALESCE(2.0::DOUBLE * tp / NULLIF(2 * tp + fp + fn, 0), 0), log_loss, roc_auc]) AS value FROM c JOIN auc USING (split))
SELECT 'run_000' AS run_id, CASE WHEN split = 'test' THEN 'test_' ELSE 'val_' END || metric AS metric, ROUND(value, 6) AS value FROM t"""))
def ml_closed_form_trial(spark: SparkSession, root: str) -> DataFrame:
    """A trial whose model has a closed form, value by value."""
    trials = training.train_trials(feature_table(spark, root), _BAYES).trials
    return rounded(trials.where(~F.col("metric").endswith("pr_auc")), "value", digits=6).select("run_id", "metric", "value")


@query(on_features(_SCORES + """, c AS (SELECT model, COUNT(*) AS n,
COUNT(*) FILTER (probability >= 0.5 AND label = 1) AS tp, COUNT(*) FILTER (probability >= 0.5 AND label = 0) AS fp,
COUNT(*) FILTER (probability < 0.5 AND label = 1) AS fn, COUNT(*) FILTER (probability < 0.5 AND label = 0) AS tn,
AVG(-ln(CASE WHEN label = 1 THEN probability ELSE 1 - probability END)) AS log_loss FROM scores GROUP BY model)
SELECT model, n, tp, fp, fn, tn, ROUND((tp + tn)::DOUBLE / n, 10) AS accuracy,
ROUND(COALESCE(tp::DOUBLE / NULLIF(tp + fp, 0), 0), 10) AS precision,
ROUND(COALESCE(tp::DOUBLE / NULLIF(tp + fn, 0), 0), 10) AS recall,
ROUND(COALESCE(2.0::DOUBLE * tp / NULLIF(2 * tp + fp + fn, 0), 0), 10) AS f1, ROUND(log_loss, 10) AS log_loss,
CAST(0 AS BIGINT) AS unscored FROM c"""))
def ml_metrics(spark: SparkSession, root: str) -> DataFrame:
    table = evaluation.metrics(scores(spark, root))
    return rounded(table, "accuracy", "precision", "recall", "f1", "log_loss")


_BY_SCORE = _SCORES + """, b AS (SELECT model, label, probability AS bucket FROM scores)"""


@query(on_features(_BY_SCORE + """SELECT p.model, ROUND(SUM(CASE WHEN p.bucket > n.bucket THEN 1.0::DOUBLE
WHEN p.bucket = n.bucket THEN 0.5::DOUBLE ELSE 0 END) / COUNT(*), 10) AS roc_auc
FROM b p JOIN b n ON p.model = n.model AND p.label = 1 AND n.label = 0 GROUP BY p.model"""))
def ml_roc_auc(spark: SparkSession, root: str) -> DataFrame:
    return rounded(evaluation.roc_auc(scores(spark, root)), "roc_auc")


@query(on_features(_BY_SCORE + """, h AS (SELECT model, bucket, SUM(label) AS pos, COUNT(*) AS k FROM b GROUP BY ALL),
c AS (SELECT model, bucket, pos::DOUBLE / SUM(pos) OVER (PARTITION BY model) AS width,
SUM(pos) OVER w::DOUBLE / SUM(k) OVER w AS prec FROM h WINDOW w AS (PARTITION BY model ORDER BY bucket DESC))
SELECT model, ROUND(SUM(width * (prec + before) / 2), 10) AS pr_auc FROM (SELECT *,
COALESCE(LAG(prec) OVER (PARTITION BY model ORDER BY bucket DESC), prec) AS before FROM c) GROUP BY model"""))
def ml_pr_auc(spark: SparkSession, root: str) -> DataFrame:
    return rounded(evaluation.pr_auc(scores(spark, root)), "pr_auc")


@query(using("trials", """SELECT experiment, CAST(rank AS INTEGER) AS rank, run_id, model_family, value FROM (
SELECT *, ROW_NUMBER() OVER (PARTITION BY experiment ORDER BY value DESC, run_id) AS rank
FROM trials WHERE metric = 'val_f1_score' AND value IS NOT NULL)"""))
def ml_leaderboard(spark: SparkSession, root: str) -> DataFrame:
    return evaluation.leaderboard(views.trials(spark, root), "val_f1_score")


@query(using("trials", """SELECT experiment, run_id, model_family, CASE WHEN value IS NOT NULL THEN metric END AS metric,
value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY experiment ORDER BY
CASE WHEN value IS NULL THEN 2 WHEN metric = 'val_f1_score' THEN 0 ELSE 1 END,
value DESC, start_time DESC, run_id) AS r FROM trials) WHERE r = 1"""))
def ml_best_trial(spark: SparkSession, root: str) -> DataFrame:
    return evaluation.best_trial(views.trials(spark, root))


MODEL = "reactivation"


def registered(spark: SparkSession, table: DataFrame, *aliases: str) -> Registry:
    """Models fitted on the training split of a written table, stored, and given their aliases."""
    registry = Registry(spark, scratch_path(spark, "registry"))
    for alias in aliases:
        inputs = _ALL if alias == CHAMPION else _FEW
        _, models = training.fitted_trials(table, _BAYES, numeric=inputs[0], flags=inputs[1], categorical=inputs[2])
        (run, fitted), = models.items()
        registry.assign(MODEL, alias, registry.register(MODEL, fitted, run, "naive_bayes"))
    return registry


@query(on_features(_with_models("champion", "challenger") + """, scores AS (
SELECT user_id, will_reactivate AS label, 'Champion' AS model, probability FROM splits JOIN champion_p USING (user_id) WHERE split = 'test'
UNION ALL SELECT user_id, will_reactivate, 'Challenger', probability FROM splits JOIN challenger_p USING (user_id) WHERE split = 'test'),
c AS (""" + model_sql.counts("scores", "model") + """)
SELECT model, n, tp, fp, fn, tn, ROUND(log_loss, 6) AS log_loss, log_loss = MIN(log_loss) OVER () AS winner FROM c"""))
def ml_champion_challenger(spark: SparkSession, root: str) -> DataFrame:
    table = materialised(feature_table(spark, root), "features")
    registry = registered(spark, table, CHAMPION, CHALLENGER)
    split = evaluation.stratified_split(table, KEY)
    held_out = materialised(split.where(F.col("split") == "test"), "holdout")
    scored = registry.scored_by(MODEL, held_out).withColumnRenamed(LABEL, "label")
    compared = evaluation.champion_challenger(scored, "log_loss")
    return rounded(compared, "log_loss", digits=6).select("model", "n", "tp", "fp", "fn", "tn", "log_loss", "winner")


@query(using("alias_log", """SELECT model, alias, version, assigned_at FROM (SELECT *, ROW_NUMBER() OVER (
PARTITION BY model, alias ORDER BY assigned_at DESC, sequence DESC) AS r FROM alias_log) WHERE r = 1"""))
def ml_latest_assignment(spark: SparkSession, root: str) -> DataFrame:
    return evaluation.latest_assignment(views.alias_log(spark, root))


@query(using("alias_log versions", """+ latest AS (SELECT model, alias, version FROM (SELECT *, ROW_NUMBER() OVER (
PARTITION BY model, alias ORDER BY assigned_at DESC, sequence DESC) AS r FROM alias_log) WHERE r = 1),
named AS (SELECT model, version, string_agg(alias, ', ' ORDER BY alias) AS aliases FROM latest GROUP BY ALL)
SELECT model, version, run_id, COALESCE(aliases, '-') AS aliases FROM versions LEFT JOIN named USING (model, version)"""))
def ml_version_listing(spark: SparkSession, root: str) -> DataFrame:
    return evaluation.version_listing(views.versions(spark, root), views.alias_log(spark, root))


# --- scoring -----------------------------------------------------------------------

_SCORED = """, scored AS (SELECT f.*, CAST(probability > 0.5 AS INTEGER) AS prediction,
ROUND(probability, 7) + 0.0::DOUBLE AS probability FROM features f JOIN champion_p USING (user_id))"""


def _scored_by_champion(spark: SparkSession, root: str) -> DataFrame:
    """The whole feature table scored by the model behind an alias, loaded from storage."""
    table = materialised(feature_table(spark, root), "features")
    return registered(spark, table, CHAMPION).load(MODEL, CHAMPION).score(table)


@query(on_features(_with_models("champion") + _SCORED + "SELECT user_id, will_reactivate, prediction, probability FROM scored"))
def score_batch(spark: SparkSession, root: str) -> DataFrame:
    scored = _scored_by_champion(spark, root)
    return rounded(scored, "probability", digits=7).select(KEY, LABEL, "prediction", "probability")


@query(on_features(f"SELECT user_id, ROUND({CHAMPION_SQL}, 10) AS prediction FROM features"))
def score_vector_udf(spark: SparkSession, root: str) -> DataFrame:
    scored = scoring.score_with_udf(feature_table(spark, root), scoring.COEFFICIENTS, scoring.INTERCEPT)
    return rounded(scored.select("user_id", "prediction"), "prediction")


@query(on_features(f"SELECT user_id, ROUND({CHAMPION_SQL}, 10) AS prediction FROM features"))
def score_linear_expr(spark: SparkSession, root: str) -> DataFrame:
    scored = scoring.score_with_expression(
        feature_table(spark, root), scoring.COEFFICIENTS, scoring.INTERCEPT
    )
    return rounded(scored.select("user_id", "prediction"), "prediction")


@query(on_features(_with_models("champion") + _SCORED
    + f"SELECT * REPLACE ({', '.join(f'ROUND({c}, 9) AS {c}' for c in RATES)}) FROM scored"))
def score_persist(spark: SparkSession, root: str) -> DataFrame:
    scored = _scored_by_champion(spark, root)
    table = scoring.persist_scores(scored, own_name("scored"), scratch_path(spark, "scored"))
    return rounded(rounded(table, "probability", digits=7), *RATES, digits=9)


@query(on_features(f"SELECT user_id, ROUND({CHAMPION_SQL}, 10) AS prediction FROM features ORDER BY user_id LIMIT 10"))
def score_sample(spark: SparkSession, root: str) -> DataFrame:
    scored = scoring.score_sample(
        feature_table(spark, root), 10, scoring.COEFFICIENTS, scoring.INTERCEPT
    )
    return rounded(scored.select("user_id", "prediction"), "prediction")


#: What a request holds: every feature, in the order of the table.
FEATURES = FEATURE_TABLE_COLUMNS[2:]


def request_sql(columns) -> str:
    """The request of a row of the feature table, as the endpoint would have logged it."""

    def cell(c: str) -> str:
        text = f"CAST({f'ROUND({c}, 6)' if c in RATES else c} AS VARCHAR)"
        return f"""'"' || {c} || '"'""" if c in CATEGORICAL_FEATURES else f"COALESCE({text}, 'null')"

    names = ",".join(f'"{c}"' for c in columns)
    return f"""'{{"dataframe_split":{{"columns":[{names}],"data":[[' || """ + " || ',' || ".join(map(cell, columns)) + """ || ']]}}'"""


# Rates and predictions are rounded before they are logged, to give both engines the same digits.
@query(on_features(f"""SELECT md5(user_id || '|946684800000') AS request_id, DATE '2000-01-01' AS request_date,
946684800000 AS timestamp_ms, 200 AS status_code, {request_sql(FEATURES)} AS request,
'{{"predictions":[' || ROUND({CHAMPION_SQL}, 3) || ']}}' AS response FROM features"""))
def score_log_payload(spark: SparkSession, root: str) -> DataFrame:
    table = sql_rounded(feature_table(spark, root), *RATES, digits=6)
    scored = scoring.score_with_expression(table, scoring.COEFFICIENTS, scoring.INTERCEPT)
    log = scoring.payload_rows(sql_rounded(scored, "prediction", digits=3), FEATURES, F.lit(SNAPSHOT))
    return log.select("request_id", "request_date", "timestamp_ms", "status_code", "request", "response")
