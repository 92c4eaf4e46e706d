"""Mixing sources to target weights by entropy balancing.

Every document gets a rate between 0 and 2 copies. Among all rates that give each source its
target of words, those nearest to one copy each are taken, in relative entropy on (0, 2) with
base mass ``size + mean size of the source``. They have the form

    rate = 2 / (1 + exp(-tilt * z)),    z = size / (size + mean size),

an exponential tilt with one dual variable per source. The dual is convex; Newton steps, kept
within a shrinking bracket, run on counts per (source, size), so that a pass moves sizes, not
documents. The rates are rounded per (source, size) by running sums, the rest of a source is
evened out by single copies of fitting size, and the chosen number of documents of a class is
taken in the order of a hash of the id: reruns agree.

Null texts have size 0. A source of no words has target 0. Null sources come last. Repeated rows
are documents of their own. Extra columns are ignored by ``mix_plan`` and kept by ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rekindle.llm.common import word_count, written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
STEPS = 40
TOLERANCE = 1e-9
#: Documents of a class ranked by one task.
BIN = 1000
#: Single copies by which the rest of a source is evened out.
EVEN_OUT = 4


def _ordered(sources: DataFrame) -> DataFrame:
    """``rank`` from 0 by code point, null last; ranks come from counts per sorted partition."""
    order = sources.orderBy(F.col("source").asc_nulls_last()).withColumn(
        "at", F.monotonically_increasing_id()
    )
    order = written(order, "mix-order")
    part = F.shiftrightunsigned(F.col("at"), 33)
    inside = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    order = order.withColumn("part", part).withColumn("inside", inside)
    counts = order.groupBy("part").count()
    # one row per partition of the sort
    before = counts.select(
        "part",
        (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"),
    )
    return order.join(before, "part").select(
        "source", "source_size", "n", (F.col("before") + F.col("inside")).alias("rank")
    )


def targets(
    sources: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """``target`` words per source; what a capped source can't take is shared out by weight."""
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights)).cast("int"))
    known = written(
        _ordered(sources)
        .withColumn("weight", weight)
        .withColumn("cap", most * F.col("source_size").cast("double")),
        "mix-sources",
    )
    whole = known.agg(F.sum("source_size").alias("words")).first()["words"] or 0
    level, full = 0.0, -1
    while True:
        # capped sources keep their cap, the others share the rest by weight
        capped = F.col("weight") * level >= F.col("cap") if level else F.lit(False)
        row = known.agg(
            F.sum(F.when(capped, F.col("cap")).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.count_if(capped).alias("full"),
        ).first()
        if not row["open"] or row["full"] == full:
            break
        full, level = row["full"], max(0.0, share * whole - row["fixed"]) / row["open"]
    return known.select(
        "source",
        "source_size",
        "n",
        F.least(F.col("cap"), F.col("weight") * F.lit(float(level))).alias("target"),
    )


def _z(size: Column, mean: Column) -> Column:
    return F.when(size > 0, size / (size + mean)).otherwise(0.0)


def tilts(classes: DataFrame, goals: DataFrame, most: float = MOST) -> DataFrame:
    """The dual variable of each source: ``(source, mean, tilt)``; null where all rates are full.

    ``classes`` holds (source, size, n). A target at its cap needs an endless tilt, hence null.
    """
    state = written(
        goals.select(
            "source",
            "target",
            (F.col("source_size") / F.col("n")).alias("mean"),
            (F.col("target") >= most * F.col("source_size")).alias("full"),
            F.lit(0.0).alias("tilt"),
            F.lit(-1e6).alias("low"),
            F.lit(1e6).alias("high"),
            F.lit(False).alias("done"),
        ),
        "mix-tilt",
    )
    for _ in range(STEPS):
        z = _z(F.col("size"), F.col("mean"))
        rate = most / (1.0 + F.exp(-F.col("tilt") * z))
        joined = classes.join(
            state.filter(~F.col("full") & ~F.col("done")), F.col("s").eqNullSafe(F.col("source"))
        )
        sums = joined.groupBy("source").agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("got"),
            F.sum(F.col("n") * F.col("size") * z * rate * (most - rate) / most).alias("slope"),
        )
        sums = sums.withColumnRenamed("source", "s2")
        miss = F.col("got") - F.col("target")
        low = F.when(miss < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(miss > 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - miss / F.col("slope")
        inside = (F.col("slope") > 0) & (step > low) & (step < high)
        after = state.join(sums, F.col("source").eqNullSafe(F.col("s2")), "left")
        reached = F.abs(miss) <= TOLERANCE * F.col("target") + 1e-6
        moved = F.when(inside, step).otherwise((low + high) / 2)
        open_ = F.col("got").isNotNull() & ~reached
        state = written(
            after.select(
                "source",
                "target",
                "mean",
                "full",
                F.when(open_, moved).otherwise(F.col("tilt")).alias("tilt"),
                F.coalesce(low, F.col("low")).alias("low"),
                F.coalesce(high, F.col("high")).alias("high"),
                (F.col("done") | ~F.coalesce(open_, F.lit(False))).alias("done"),
            ),
            "mix-tilt",
        )
        if state.filter(~F.col("done")).isEmpty():
            break
    return state.select(
        "source", "mean", "target", F.when(~F.col("full"), F.col("tilt")).alias("tilt")
    )


def _rounded(classes: DataFrame, goals: DataFrame, most: float = MOST) -> DataFrame:
    """Per (source, size) of ``n`` documents: ``base`` copies each and ``extra`` single ones."""
    known = tilts(classes, goals, most).withColumnRenamed("source", "s2")
    size, n = F.col("size"), F.col("n")
    rate = F.when(F.col("tilt").isNull(), F.lit(most)).otherwise(
        most / (1.0 + F.exp(-F.col("tilt") * _z(size, F.col("mean"))))
    )
    # without words any rate meets the target
    rate = F.when(size == 0, F.lit(1.0)).otherwise(rate)
    # one row per distinct size: bounded by the longest text, whatever the number of documents
    falling = Window.partitionBy("s").orderBy(F.desc("size"))
    share = n * (F.col("rate") - F.col("base"))
    upto = F.floor(F.sum(share).over(falling) + 0.5)
    rounded = (
        classes.join(known, F.col("s").eqNullSafe(F.col("s2")))
        .withColumn("rate", rate)
        .withColumn("base", F.floor("rate"))
        .withColumn("upto", upto)
        .withColumn(
            "extra",
            F.least(
                n, F.greatest(F.lit(0).cast("long"), F.col("upto") - F.coalesce(F.lag("upto").over(falling), F.lit(0)))
            ),
        )
        .select("s", "size", "n", "target", "base", "extra")
    )
    rounded = written(rounded, "mix-rounded")
    for _ in range(EVEN_OUT):
        copies = F.col("base") * n + F.col("extra")
        rest = rounded.groupBy("s").agg(
            (F.first("target") - F.sum(copies * size)).alias("rest")
        )
        full = rounded.join(
            rest.withColumnRenamed("s", "s2"), F.col("s").eqNullSafe(F.col("s2"))
        ).drop("s2")
        # one more or one less copy of the size nearest to the rest, if that helps
        can = F.when(F.col("rest") > 0, copies < most * n).otherwise(copies > 0)
        gain = F.abs("rest") - F.abs(F.abs("rest") - size)
        best = (
            full.filter(can & (gain > 0))
            .groupBy("s")
            .agg(F.max(F.struct(gain, size)).alias("best"))
            .select(F.col("s").alias("s2"), F.col("best.size").alias("chosen"))
        )
        hit = F.coalesce(F.col("chosen") == size, F.lit(False))
        sign = F.when(F.col("rest") > 0, 1).otherwise(-1)
        total = copies + F.when(hit, sign).otherwise(0)
        rounded = written(
            full.join(best, F.col("s").eqNullSafe(F.col("s2")), "left")
            .withColumn("total", total)
            .select(
                "s",
                "size",
                "n",
                "target",
                F.floor(F.col("total") / n).alias("base"),
                (F.col("total") - F.floor(F.col("total") / n) * n).alias("extra"),
            ),
            "mix-rounded",
        )
    return rounded


def mix_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
) -> DataFrame:
    """One row per document: id, source, size, ``source_size``, ``target`` and ``copies``."""
    sized = written(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
        ),
        "mix-sizes",
    )
    classes = written(
        sized.groupBy(F.col("source").alias("s"), "size").agg(F.count("*").alias("n")),
        "mix-classes",
    )
    sources = classes.groupBy(F.col("s").alias("source")).agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n")
    )
    goals = written(targets(sources, weights, share), "mix-targets")
    rounded = _rounded(classes, goals)
    # equal hash ranges within a class, small enough to be ranked by one task each
    bins = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("n") / BIN))
    order = F.xxhash64(F.col("id"), F.lit("mix"))
    plan = rounded.join(
        goals.select(F.col("source").alias("s2"), "source_size"), F.col("s").eqNullSafe(F.col("s2"))
    ).drop("s2")
    placed = written(
        sized.join(
            plan.withColumnRenamed("size", "size2"),
            F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("size2")),
        )
        .withColumn("order", order)
        .withColumn("bin", F.pmod(F.col("order"), bins))
        .select("id", "source", "size", "source_size", "target", "n", "base", "extra", "order", "bin"),
        "mix-placed",
    )
    sums = placed.groupBy("source", "size", "bin").agg(
        F.count("*").alias("in_bin"), F.first("extra").alias("of_class")
    )
    upto = F.sum("in_bin").over(Window.partitionBy("source", "size").orderBy("bin"))
    before = sums.select(
        F.col("source").alias("s2"),
        F.col("size").alias("z2"),
        F.col("bin").alias("b2"),
        F.least("in_bin", F.greatest(F.lit(0), F.col("of_class") - (upto - F.col("in_bin")))).alias("room"),
    )
    ranked = placed.join(
        before,
        F.col("source").eqNullSafe(F.col("s2"))
        & (F.col("size") == F.col("z2"))
        & (F.col("bin") == F.col("b2")),
    ).withColumn(
        "nth",
        F.row_number().over(Window.partitionBy("source", "size", "bin").orderBy("order", "id")),
    )
    copies = F.col("base") + F.when(F.col("nth") <= F.col("room"), 1).otherwise(0)
    return ranked.select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "size",
        "source_size",
        "target",
        copies.cast("int").alias("copies"),
    )


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
) -> DataFrame:
    """The mix itself: each document as often as the plan says, with all its columns."""
    plan = mix_plan(docs, id_col, text_col, source_col, weights, share)

    def told_by(size: Column) -> Column:
        """One text per id, source and size, nulls told apart: the join and the ranks share it."""
        parts = [F.col(c).cast("string") for c in (id_col, source_col)]
        return F.concat_ws("\x1f", *[F.concat(F.isnull(p).cast("string"), F.coalesce(p, F.lit(""))) for p in parts], size)

    # rows that agree in id, source and size are told apart by their number only
    told = plan.groupBy(told_by(F.col("size")).alias("__key")).agg(
        F.min("copies").alias("__base"), F.sum("copies").alias("__sum"), F.count("*").alias("__n")
    )
    wanted = told.filter("__sum > 0")
    joined = docs.withColumn("__key", told_by(word_count(F.col(text_col)))).join(wanted, "__key")
    # ranked within the partition of the join: texts move once
    nth = F.row_number().over(Window.partitionBy("__key").orderBy(F.xxhash64(text_col)))
    extra = F.col("__sum") - F.col("__base") * F.col("__n")
    copies = F.col("__base") + F.when(F.col("__nth") <= extra, 1).otherwise(0)
    return (
        joined.withColumn("__nth", nth)
        .withColumn("__copy", F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
        .select(docs.columns)
    )
