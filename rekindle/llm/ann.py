"""Approximate nearest neighbours in a hash-prefix forest.

Each tree gives a vector a string of 63 hash bits, the sides of random hyperplanes through the
middle of a sample, and keeps all strings in one sorted array. A query descends in every tree to
the entries that share its longest prefix: binary searches in the array tell how many entries
share each length of prefix. From there all trees ascend in step, bit by bit, until together they
hold enough entries that share so long a prefix. These are compared by exact distance where they
lie, and the best of each tree merged. A tree gives at most ``reach`` entries on either side, so
that many equal strings are no large group; its nearest neighbours in the array come first.

How many entries are enough decides between recall and work, and follows from the table: for a
sample of the queries (``TRIED``) the nearest entries are found by comparing all. ``reach`` is
``SPREAD`` times the places in the array that bring ``AIM`` of them up (``WIDTH`` at least), and
the ascent ends with the least number of entries at whose depth ``AIM`` of them are among those
(``2 * WIDTH`` for each tree at least). Vectors without structure, such as directions spread evenly
over 64 dimensions, need a number that grows about as the table does, so the work on them grows
with its square.

The arrays are sorted by range partitions and numbered by position, so a block holds a fixed
number of entries whatever their strings: many equal or close strings make no large group. Equal
strings are ordered by a hash that differs per tree, so the trees do not repeat each other. Equal
vectors are one entry with their ``k + 1`` smallest ids, which is all that a list of ``k`` can
need. Only the hyperplanes' middle comes from a sample (``SAMPLE`` vectors); every vector is
indexed.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do those
whose length is not the most frequent one (the smaller on a tie). Null ids take no part. Of
repeated rows of an id each distinct vector is an entry and may name the id. With fewer vectors
than ``k`` all are returned. Columns other than id and vector are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rekindle.llm.common import written

TREES = 24
BITS = 63
#: Entries on either side that each tree looks at, at least.
WIDTH = 800
#: A tree's reach in widths: prefixes rarely lie evenly about a query.
SPREAD = 4
#: Queries that are compared with all entries to find how many are enough, and the share of their
#: nearest that those have to bring up.
TRIED = 256
AIM = 0.95
SAMPLE = 20_000
BLOCK = 8_192
SEED = 11


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of vectors that take part."""
    good = (
        F.col("id").isNotNull()
        & F.col("vec").isNotNull()
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vec", lambda x: x != 0)
    )
    found = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).filter(good)
    sizes = found.groupBy(F.size("vec").alias("dim")).count()
    top = sizes.orderBy(F.desc("count"), "dim").first()
    return found.filter(F.size("vec") == (top["dim"] if top else 0))


def entries(found: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: ``entry`` (a hash of it and its smallest id), ``vec``, its smallest ids."""
    few = (
        found.distinct()
        .withColumn("nth", F.row_number().over(Window.partitionBy("vec").orderBy("id")))
        .filter(F.col("nth") <= k + 1)
    )
    return few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(
        F.xxhash64("vec", F.get("ids", F.lit(0))).alias("entry"), "vec", "ids"
    )


def _bits(vectors: np.ndarray, planes: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """Strings as unsigned numbers below 2**63, one column per tree."""
    trees = planes.shape[1] // BITS
    sides = (vectors @ planes > middle).reshape(len(vectors), trees, BITS)
    weights = (np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)).astype(np.uint64)
    return (sides * weights).sum(axis=2, dtype=np.uint64).astype(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def forest(index: DataFrame, trees: int = TREES, seed: int = SEED) -> DataFrame:
    """The sorted arrays: (tree, key, entry, rank), rank being the position over all trees."""
    part = F.pmod(F.xxhash64("entry"), F.lit(1_000_000))
    n = index.count()
    share = min(1.0, SAMPLE / n) if n else 1.0
    sample = index.filter(part < int(share * 1_000_000)).select("vec").toPandas()["vec"]
    dim = len(sample.iloc[0]) if len(sample) else 1
    planes = np.random.default_rng(seed).standard_normal((dim, trees * BITS))
    points = np.stack(sample.to_numpy()).astype(np.float64) if len(sample) else np.zeros((1, dim))
    # tree after tree, so that the driver holds little
    each = np.split(planes, trees, axis=1)
    middle = np.concatenate([np.median(points @ x, axis=0, overwrite_input=True) for x in each])
    shared = index.sparkSession.sparkContext.broadcast((planes, middle))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, middle = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                few = batch.slice(at, 1000)
                found = _bits(_matrix(few.column("vec")).astype(np.float64), planes, middle)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.tile(np.arange(trees, dtype=np.int32), few.num_rows)),
                        pa.array(found.ravel()),
                        pa.array(np.repeat(few.column("entry").to_numpy(), trees)),
                    ],
                    names=["tree", "key", "entry"],
                )

    strings = index.select("entry", "vec").mapInArrow(keys, "tree int, key long, entry long")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            places = np.arange(at, at + batch.num_rows, dtype=np.int64)
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(places)],
                names=["tree", "key", "entry", "part", "place"],
            )

    tasks = max(1, -(-n * trees // 500_000))
    order = ("tree", "key", F.xxhash64("entry", "tree"), "entry")
    placed = written(
        strings.repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(number, "tree int, key long, entry long, part int, place long"),
        "ann-places",
    )
    # one row per task of the sort
    sizes = placed.groupBy("part").count()
    before = sizes.select(
        "part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before")
    )
    return placed.join(before, "part").select(
        "tree", "key", "entry", (F.col("before") + F.col("place")).alias("rank")
    )


def exact(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query, entry): the ``k`` nearest other entries of each of a few queries, all compared."""
    rows = queries.join(index, "entry").select("entry", "vec").collect()  # at most ``TRIED``
    names = np.array([r["entry"] for r in rows], np.int64)
    points = np.array([r["vec"] for r in rows], np.float64).reshape(len(rows), -1 if rows else 1)
    shared = index.sparkSession.sparkContext.broadcast((names, points))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, points = shared.value
        if not len(names):
            return
        found = np.zeros((len(names), 0), np.int64)
        far = np.zeros((len(names), 0))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                few = batch.slice(at, 4096)
                own, vec = few.column("entry").to_numpy(), _matrix(few.column("vec")).astype(np.float64)
                score = (vec**2).sum(axis=1) - 2 * points @ vec.T
                score[names[:, None] == own] = np.inf
                far = np.hstack([far, score])
                found = np.hstack([found, np.broadcast_to(own, score.shape)])
                if far.shape[1] > k:
                    best = np.argpartition(far, k - 1, axis=1)[:, :k]
                    far, found = np.take_along_axis(far, best, 1), np.take_along_axis(found, best, 1)
        query = np.repeat(names, far.shape[1])
        known = np.isfinite(far.ravel())
        yield pa.RecordBatch.from_arrays(
            [pa.array(query[known]), pa.array(found.ravel()[known]), pa.array(far.ravel()[known])],
            names=["query", "entry", "score"],
        )

    order = Window.partitionBy("query").orderBy("score", "entry")
    return (
        index.select("entry", "vec")
        .mapInArrow(scan, "query long, entry long, score double")
        .withColumn("nth", F.row_number().over(order))
        .filter(F.col("nth") <= k)
        .select("query", "entry")
    )


def tried(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query, entry): the nearest entries of a sample of the queries."""
    few = queries.orderBy(F.xxhash64("entry", F.lit("tried")), "entry").limit(TRIED)
    return written(exact(index, few, k), "ann-tried")


def width_for(array: DataFrame, pairs: DataFrame) -> int:
    """Entries on either side that bring ``AIM`` of the pairs up."""
    places = array.select("tree", "entry", "rank")
    asked = pairs.join(places.withColumnsRenamed({"entry": "query", "rank": "q_rank"}), "query")
    apart = F.min(F.abs(F.col("rank") - F.col("q_rank"))).alias("apart")
    needed = sorted(
        r["apart"]
        for r in asked.join(places, ["tree", "entry"]).groupBy("query", "entry").agg(apart).collect()
    )  # at most ``TRIED`` times ``k``
    return max([WIDTH, *needed[: math.ceil(len(needed) * AIM)]])


def _descend(reach: int):
    """For every length of prefix, how many entries of one block share it with a query, within reach."""
    free = np.uint64(BITS) - np.arange(BITS + 1, dtype=np.uint64)

    def run(array: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        array = array.sort_values("rank")
        rank, tree, keys = (array[c].to_numpy() for c in ("rank", "tree", "key"))
        for q in queries.itertuples(index=False):
            low = max(np.searchsorted(rank, q.q_rank - reach), np.searchsorted(tree, q.q_tree))
            high = min(np.searchsorted(rank, q.q_rank + reach + 1), np.searchsorted(tree, q.q_tree, side="right"))
            if low < high:
                own = keys[low:high].astype(np.uint64)
                least = np.uint64(q.q_key) >> free << free
                most = least | ((np.uint64(1) << free) - np.uint64(1))
                before, after = np.searchsorted(rank[low:high], [q.q_rank, q.q_rank + 1])
                left = np.maximum(0, before - np.searchsorted(own, least))
                right = np.maximum(0, np.searchsorted(own, most, side="right") - after)
                out.append((q.q_entry, q.q_tree, left.tolist(), right.tolist()))
        return pd.DataFrame(out, columns=["query", "tree", "left", "right"])

    return run


def descents(array: DataFrame, queries: DataFrame, reach: int) -> DataFrame:
    """(query, tree, left, right): entries on either side by the length of the prefix they share."""
    asked = array.join(queries.select("entry"), "entry", "left_semi")
    first = F.floor(F.greatest(F.lit(0), F.col("rank") - reach) / BLOCK)
    routed = asked.select(
        F.explode(F.sequence(first, F.floor((F.col("rank") + reach) / BLOCK))).alias("block"),
        *[F.col(c).alias(f"q_{c}") for c in ("tree", "entry", "rank", "key")],
    )
    blocks = array.select("tree", "key", "rank", F.floor(F.col("rank") / BLOCK).alias("block"))
    return (
        blocks.groupBy("block")
        .cogroup(routed.groupBy("block"))
        .applyInPandas(_descend(reach), "query long, tree int, left array<long>, right array<long>")
    )


def _sides(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return np.stack(rows["left"].to_numpy()), np.stack(rows["right"].to_numpy())


def ascended(down: DataFrame, enough: int) -> DataFrame:
    """(query, tree, depth, before, after): where the trees, ascending together, hold enough entries."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = _sides(rows)
        deep = np.flatnonzero((left + right).sum(axis=0) >= enough)
        depth = int(deep[-1]) if len(deep) else 0
        found = rows[["query", "tree"]].assign(depth=depth, before=left[:, depth], after=right[:, depth])
        # a tree's entries may lie in several blocks
        return found.groupby(["query", "tree", "depth"], as_index=False).sum()

    return down.groupBy("query").applyInPandas(run, "query long, tree int, depth int, before long, after long")


def enough_for(array: DataFrame, down: DataFrame, pairs: DataFrame, reach: int) -> int:
    """The least number of entries that ends the ascent with ``AIM`` of the pairs brought up."""
    places = array.select("tree", "entry", "key", "rank")
    asked = pairs.join(places.withColumnsRenamed({"entry": "query", "rank": "q_rank", "key": "q_key"}), "query")
    differ = F.col("key").bitwiseXOR(F.col("q_key"))
    shared = F.when(differ == 0, BITS).otherwise(BITS - F.length(F.bin(differ)))
    near = F.abs(F.col("rank") - F.col("q_rank")) <= reach
    depth = F.max(F.when(near, shared)).alias("depth")
    depths = asked.join(places, ["tree", "entry"]).groupBy("query", "entry").agg(depth).collect()

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = _sides(rows)
        return pd.DataFrame({"query": [rows["query"].iloc[0]], "total": [(left + right).sum(axis=0).tolist()]})

    few = down.join(F.broadcast(pairs.select("query").distinct()), "query", "left_semi")  # ``TRIED`` rows
    totals = {r["query"]: r["total"] for r in few.groupBy("query").applyInPandas(total, "query long, total array<long>").collect()}
    # a pair is brought up unless one bit deeper there are enough already
    needed = sorted(
        totals[r["query"]][0] + 1 if r["depth"] is None else [*totals[r["query"]], 0][r["depth"] + 1] + 1
        for r in depths
    )
    return needed[math.ceil(len(needed) * AIM) - 1] if needed else 0


def _around(k: int, component: str):
    """The best of the entries each query ascended to in one block, by exact distance."""

    def vectors(column: pd.Series) -> np.ndarray:
        return np.stack([np.frombuffer(x, component) for x in column]).astype(np.float64)

    def run(array: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(array) and len(queries):
            array = array.sort_values("rank")
            rank, tree = array["rank"].to_numpy(), array["tree"].to_numpy()
            entry, points = array["entry"].to_numpy(), vectors(array["vec"])
            for row, q in zip(queries.itertuples(index=False), vectors(queries["q_vec"]), strict=True):
                low, high = np.searchsorted(rank, [row.q_low, row.q_high + 1])
                ok = np.flatnonzero(tree[low:high] == row.q_tree) + low
                # component after component, as a plain loop adds them up
                score = np.sqrt(np.ascontiguousarray(((points[ok] - q) ** 2).T).sum(axis=0))
                best = np.argsort(score, kind="stable")
                if len(best) > k + 1:
                    # all that are as near as the last one stay
                    best = best[: np.searchsorted(score[best], score[best[k]], side="right")]
                out.append((np.full(len(best), row.q_entry), entry[ok[best]], score[best]))
        if not out:
            return pd.DataFrame({"query": [], "entry": [], "score": []}).astype(
                {"query": "int64", "entry": "int64", "score": "float64"}
            )
        query, found, score = (np.concatenate(x) for x in zip(*out, strict=True))
        return pd.DataFrame({"query": query, "entry": found, "score": score})

    return run


def scored(array: DataFrame, index: DataFrame, up: DataFrame, k: int) -> DataFrame:
    """(query, entry, score): of every tree the ``k + 1`` nearest of the entries a query ascended to."""
    element = index.schema["vec"].dataType.elementType.simpleString()
    component = "<f4" if element == "float" else "<f8"

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [x.tobytes() for x in _matrix(batch.column("vec")).astype(component)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("entry"), pa.array(rows, pa.binary())], names=["entry", "vec"]
            )

    vectors = index.select("entry", "vec").mapInArrow(packed, "entry long, vec binary")
    full = array.select("tree", "rank", "entry").join(vectors, "entry")
    spans = up.select(F.col("query").alias("entry"), "tree", "before", "after")
    asked = full.join(spans, ["entry", "tree"])
    asked = asked.withColumns({"low": F.col("rank") - F.col("before"), "high": F.col("rank") + F.col("after")})
    routed = asked.select(
        F.explode(F.sequence(F.floor(F.col("low") / BLOCK), F.floor(F.col("high") / BLOCK))).alias("block"),
        *[F.col(c).alias(f"q_{c}") for c in ("tree", "entry", "low", "high", "vec")],
    )
    blocks = full.withColumn("block", F.floor(F.col("rank") / BLOCK))
    return (
        blocks.groupBy("block")
        .cogroup(routed.groupBy("block"))
        .applyInPandas(_around(k, component), "query long, entry long, score double")
        .distinct()
    )


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    trees: int = TREES,
    width: int | None = None,
) -> DataFrame:
    """The ``k`` nearest found of each row where ``is_query`` (a condition on column ``id``).

    By default what the trees look at follows from the table; ``width`` sets it.
    """
    found = written(usable(df, id_col, vec_col), "ann-vectors")
    index = written(entries(found, k), "ann-entries")
    asking = written(
        found.filter(is_query).join(index.select("entry", "vec"), "vec").select("id", "entry").distinct(),
        "ann-queries",
    )
    queries = asking.select("entry").distinct()
    array = written(forest(index, trees), "ann-forest")
    pairs = tried(index, queries, k) if width is None else None
    reach = SPREAD * (width if pairs is None else width_for(array, pairs))
    down = written(descents(array, queries, reach), "ann-descents")
    enough = 2 * trees * (WIDTH if width is None else width)
    if pairs is not None:
        enough = max(enough, enough_for(array, down, pairs, reach))
    up = written(ascended(down, enough), "ann-ascents")
    near = scored(array, index, up, k).join(index.select("entry", "ids"), "entry")
    order = Window.partitionBy("query").orderBy("score", "vec_id")
    # k and one more, as a query may find itself
    short = (
        near.select("query", "score", F.explode("ids").alias("vec_id"))
        .withColumn("nth", F.row_number().over(order))
        .filter(F.col("nth") <= k + 1)
        .groupBy("query")
        .agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("list"))
    )
    others = F.slice(F.filter("list", lambda x: x["vec_id"] != F.col("id")), 1, k)
    return (
        asking.join(short, asking["entry"] == short["query"])
        .select(F.col("id").alias("query_id"), F.posexplode(others).alias("pos", "hit"))
        .select(
            "query_id",
            (F.col("pos") + 1).cast("int").alias("rank"),
            F.col("hit.vec_id").alias("vec_id"),
            F.col("hit.score").alias("score"),
        )
    )
