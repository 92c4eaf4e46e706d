"""Data checks, splits, metrics and model comparison as plain aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rekindle.contracts import LABEL
from rekindle.functions.moments import comoments
from rekindle.functions.ranges import running_sums
from rekindle.sources.tables import materialised

SPLITS = {"train": 0.6, "validation": 0.2, "test": 0.2}
#: Rows of one label that are ranked by one task.
ROWS_PER_BUCKET = 50_000
PROBABILITY_FLOOR = 1e-15


def dataset_checks(
    features: DataFrame, label: str = LABEL, warn_below: int = 100, fail_below: int = 50
) -> DataFrame:
    """One row per check (non-empty, binary label, enough positives) with its status."""
    y = F.col(label)
    counts = features.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(y.isNull() | ~y.isin(0, 1)).alias("bad_labels"),
        F.count_if(y == 1).alias("positives"),
    )

    def check(name: str, value: str, failed: Column, warned: Column | None = None) -> Column:
        status = F.when(failed, "fail")
        if warned is not None:
            status = status.when(warned, "warn")
        return F.struct(
            F.lit(name).alias("check_name"),
            F.col(value).alias("value"),
            status.otherwise("ok").alias("status"),
        )

    positives = F.col("positives")
    return counts.select(
        F.inline(
            F.array(
                check("non_empty", "rows", F.col("rows") == 0),
                check("binary_label", "bad_labels", F.col("bad_labels") > 0),
                check("positives", "positives", positives < fail_below, positives < warn_below),
            )
        )
    )


def key_hash(key: Column) -> Column:
    """Hash of a key of any type onto [0, 2^32): the first 32 bits of the MD5 of its text."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long")


def stratified_split(
    df: DataFrame,
    key: str,
    label: str = LABEL,
    shares: Mapping[str, float] = SPLITS,
    buckets: int | None = None,
) -> DataFrame:
    """``df`` plus a ``split`` column with the exact shares inside every label value.

    A row's rank by hash within its label decides its split. Ranking a whole label in
    one window would put half of the table in one task, so ranks are found in two steps:
    the small table of counts per (label, hash bucket) gives each bucket its starting
    rank, and only rows of one bucket are ranked together. The number of buckets follows
    from the number of rows, counted on the written table, which all steps read.
    """
    if buckets is None:
        df = materialised(df, "unsplit")
        buckets = max(1, -(-df.count() // ROWS_PER_BUCKET))
    hashed = df.withColumn("_h", key_hash(F.col(key)))
    hashed = hashed.withColumn("_b", F.floor(F.col("_h") / F.lit(4294967296 / buckets)).cast("int"))
    counts = hashed.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    by_label = Window.partitionBy(label)
    before = by_label.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(label).alias("_l"),
        F.col("_b").alias("_c"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(by_label).alias("_total"),
    )
    local = F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h", key))
    ranked = hashed.withColumn("_r", local).join(
        starts, F.col(label).eqNullSafe(F.col("_l")) & (F.col("_b") == F.col("_c"))
    )
    position = (F.col("_start") + F.col("_r") - 1) / F.col("_total")
    names, upto, split = list(shares), 0.0, None
    for name in names[:-1]:
        upto = round(upto + shares[name], 12)
        split = (F.when if split is None else split.when)(position < upto, name)
    split = F.lit(names[-1]) if split is None else split.otherwise(names[-1])
    return ranked.select(*df.columns, split.alias("split"))


def profile_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows, NULLs, exact distinct values, and moments of numeric columns.

    Columns become (name, value, count) rows before anything is counted distinct, so a
    value that fills a third of a column travels as one row per task. Moments of all columns are
    one pass that merges without losing digits. A column without numbers has NULL moments.
    """
    numeric = [f.name for f in df.schema.fields if f.name in columns and f.dataType.typeName() in
               ("integer", "long", "double", "float", "short", "byte", "decimal")]
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("text")) for c in columns
    ]
    values = df.select(F.inline(F.array(*cells))).groupBy("column_name", "text").agg(F.count(F.lit(1)).alias("k"))
    k = F.col("k")
    counted = values.groupBy("column_name").agg(
        F.sum(k).alias("n"),
        F.coalesce(F.sum(F.when(F.col("text").isNull(), k)), F.lit(0)).alias("nulls"),
        F.count("text").alias("distinct_values"),
    )
    if not numeric:
        moments = df.sparkSession.createDataFrame([], "c string, mean double, stddev double, min double, max double")
    else:
        known = F.col("n") > 0
        moments = comoments(df, numeric).where("column_a = column_b").select(
            F.col("column_a").alias("c"),
            F.when(known, F.col("mean_a")).alias("mean"),
            F.when(F.col("n") > 1, F.sqrt(F.greatest("var_a", F.lit(0.0)) / (F.col("n") - 1))).alias("stddev"),
            F.when(known, F.col("min_a")).alias("min"),
            F.when(known, F.col("max_a")).alias("max"),
        )
    return counted.join(moments, F.col("column_name") == F.col("c"), "left").select(
        "column_name", "n", "nulls", "distinct_values", "mean", "stddev", "min", "max"
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns over the rows that know both.

    NULL where a column is constant over these rows. All pairs come from one matrix of co-moments.
    """
    place = {c: k for k, c in enumerate(columns)}
    order = F.create_map(*[x for c, k in place.items() for x in (F.lit(c), F.lit(k))])

    def varies(x: str) -> Column:
        # what rounding leaves of a constant column is no spread
        size = F.greatest(F.abs(f"min_{x}"), F.abs(f"max_{x}"))
        return (F.col(f"min_{x}") < F.col(f"max_{x}")) & (F.col(f"var_{x}") > F.col("n") * F.pow(size * 1e-15, F.lit(2)))

    spread = F.sqrt(F.col("var_a")) * F.sqrt(F.col("var_b"))
    bounded = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("covar") / spread))
    value = F.when(varies("a") & varies("b"), bounded)
    pairs = comoments(df, columns).where(order[F.col("column_a")] < order[F.col("column_b")])
    return pairs.select("column_a", "column_b", value.alias("correlation"))


def metrics(
    scores: DataFrame,
    keys: Sequence[str] = ("model",),
    label: str = "label",
    probability: str = "probability",
    threshold: float = 0.5,
) -> DataFrame:
    """Accuracy, precision, recall, F1 and log-loss per model; 0 where undefined.

    Rows without a score or a label count as ``unscored`` and nowhere else.
    """
    usable = F.col(label).isNotNull() & F.col(probability).isNotNull()
    y, p = F.col(label) == 1, F.when(usable, F.col(probability))
    hit = p >= threshold
    bounded = F.least(F.greatest(p, F.lit(PROBABILITY_FLOOR)), F.lit(1 - PROBABILITY_FLOOR))
    counted = scores.groupBy(*keys).agg(
        F.count_if(usable).alias("n"),
        F.count_if(~usable).alias("unscored"),
        F.count_if(hit & y).alias("tp"),
        F.count_if(hit & ~y).alias("fp"),
        F.count_if(~hit & y).alias("fn"),
        F.count_if(~hit & ~y).alias("tn"),
        F.avg(F.when(usable, -F.ln(F.when(y, bounded).otherwise(1 - bounded)))).alias("log_loss"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    return counted.select(
        *keys,
        "n",
        "tp",
        "fp",
        "fn",
        "tn",
        ratio(tp + tn, F.col("n")).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        "log_loss",
        "unscored",
    )


def _curve(scores: DataFrame, keys: Sequence[str], label: str, probability: str) -> DataFrame:
    """Per model and distinct score, best first: own counts, counts up to it, and totals.

    Rows without a score or a label are left out.
    """
    p = F.col(probability).cast("double")
    usable = scores.where(F.col(label).isNotNull() & p.isNotNull() & ~F.isnan(p))
    counted = usable.groupBy(*keys, p.alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    upto, whole = {"tp": "pos", "fp": "neg"}, {"all_pos": "pos", "all_neg": "neg"}
    return running_sums(counted, keys, [F.desc("score")], upto, whole)


def areas(
    scores: DataFrame,
    keys: Sequence[str] = ("model",),
    label: str = "label",
    probability: str = "probability",
) -> DataFrame:
    """``roc_auc`` and ``pr_auc`` per model from one curve, both exact.

    ROC: equal scores count half. Precision-recall: trapezoids, the first precision held to
    recall 0; a slice needs the precision of the score before it, which follows from its own counts.
    """
    tp, fp, pos, neg = (F.col(c) for c in ("tp", "fp", "pos", "neg"))
    precision = tp / (tp + fp)
    before = F.coalesce(F.try_divide(tp - pos, tp - pos + fp - neg), precision)
    width = F.try_divide(pos.cast("double"), F.col("all_pos"))
    pairs = F.max("all_pos").cast("double") * F.max("all_neg")
    return _curve(scores, keys, label, probability).groupBy(*keys).agg(
        F.try_divide(F.sum(neg * (tp - pos / F.lit(2.0))), pairs).alias("roc_auc"),
        F.sum(width * (precision + before) / 2).alias("pr_auc"),
    )


def roc_auc(scores: DataFrame, keys: Sequence[str] = ("model",), **columns: str) -> DataFrame:
    """Exact area under the ROC curve."""
    return areas(scores, keys, **columns).drop("pr_auc")


def pr_auc(scores: DataFrame, keys: Sequence[str] = ("model",), **columns: str) -> DataFrame:
    """Area under the precision-recall curve."""
    return areas(scores, keys, **columns).drop("roc_auc")


def leaderboard(trials: DataFrame, metric: str, top: int | None = None) -> DataFrame:
    """The runs of each experiment by one metric, with their rank; all of them unless ``top``.

    Equal values share no rank: the smaller run id comes first. A rank is a running count over
    ranges of (value, run id), so that an experiment of any size is spread over tasks. With a
    limit, every task drops all but its own ``top`` runs before the shuffle instead.
    """
    known = trials.where((F.col("metric") == metric) & F.col("value").isNotNull())
    columns = ("experiment", "rank", "run_id", "model_family", "value")
    order = [F.col("value").desc(), F.col("run_id").asc()]
    if top is not None:
        first = F.row_number().over(Window.partitionBy("experiment").orderBy(*order))
        return known.withColumn("rank", first).where(F.col("rank") <= top).select(*columns)
    ranked = running_sums(known.withColumn("_one", F.lit(1)), ["experiment"], order, {"rank": "_one"})
    return ranked.withColumn("rank", F.col("rank").cast("int")).select(*columns)


def best_trial(
    trials: DataFrame, preference: Sequence[str] = ("val_f1_score", "val_roc_auc")
) -> DataFrame:
    """One run per experiment: best by the first metric that has a value, else the latest.

    A run with an earlier metric beats any run without it; of equals the smallest id, of any
    type, is taken.
    """
    level = F.lit(None).cast("int")
    for i, name in reversed(list(enumerate(preference))):
        usable = (F.col("metric") == name) & F.col("value").isNotNull()
        level = F.when(usable, F.lit(len(preference) - i)).otherwise(level)
    level = F.coalesce(level, F.lit(0))
    order = F.struct(level.alias("level"), F.when(level > 0, F.col("value")).alias("value"), "start_time")
    ordered = trials.withColumn("_order", order)
    best = ordered.groupBy("experiment").agg(F.max("_order").alias("_best")).withColumnRenamed("experiment", "_e")
    picked = (
        ordered.join(best, F.col("experiment").eqNullSafe(F.col("_e")) & F.col("_order").eqNullSafe(F.col("_best")))
        .groupBy("experiment")
        .agg(F.min(F.struct("run_id", "model_family", "metric", "value")).alias("r"), F.max("_order.level").alias("level"))
    )
    chosen = F.col("level") > 0
    return picked.select(
        "experiment",
        F.col("r.run_id").alias("run_id"),
        F.col("r.model_family").alias("model_family"),
        F.when(chosen, F.col("r.metric")).alias("metric"),
        F.when(chosen, F.col("r.value")).alias("value"),
    )


def champion_challenger(scores: DataFrame, metric: str = "f1") -> DataFrame:
    """Metrics of every model on the same rows; the best by ``metric`` is the winner.

    ``log_loss`` is the only metric where less is better. Models are few, so the
    comparison runs over one row per model.
    """
    table = metrics(scores)
    best = (F.min if metric == "log_loss" else F.max)(metric).over(Window.partitionBy())
    return table.withColumn("winner", F.col(metric) == best)


def latest_assignment(log: DataFrame) -> DataFrame:
    """Current version behind each (model, alias): the last assignment wins."""
    order = F.struct("assigned_at", "sequence")
    return log.groupBy("model", "alias").agg(
        F.max_by("version", order).alias("version"), F.max("assigned_at").alias("assigned_at")
    )


def version_listing(versions: DataFrame, log: DataFrame) -> DataFrame:
    """Every version with the sorted aliases that point to it now.

    An alias points to one version only, so a list never exceeds the alias names in use.
    """
    current = (
        latest_assignment(log)
        .groupBy("model", "version")
        .agg(F.array_join(F.array_sort(F.collect_list("alias")), ", ").alias("aliases"))
    )
    return versions.join(current, ["model", "version"], "left").select(
        "model", "version", "run_id", F.coalesce("aliases", F.lit("-")).alias("aliases")
    )
