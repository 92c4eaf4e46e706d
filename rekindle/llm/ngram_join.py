"""Jaccard join of documents by word n-grams, as a blocked sparse matrix product.

Rows of the incidence matrix are documents, columns their distinct shingles of four words. Two
documents are linked when their rows overlap in at least 85 % of their union, that is when
``185 * overlap >= 85 * (n_a + n_b)``. The product of the matrix with its transpose is computed
by blocks of columns:

1. Documents with equal rows are one node.
2. First block: the rarest ``n - ceil(0.85 n) + 1`` columns of each row, by one order of all
   columns. Linked rows share one of them. A pair that first meets in column ``i`` of one row and
   ``j`` of the other overlaps at most ``1 + min(n_a - i - 1, n_b - j - 1)`` times; pairs for which
   that bound is too small are discarded. Overlap counts of the first block are added up per pair;
   where they and the columns that come after the block can't reach the overlap needed, the pair
   is discarded as well. The order comes from a table of column counts of fixed size; any order is
   right, it only decides how many pairs meet.
3. Surviving pairs: the whole rows, cut in column blocks, are multiplied block by block and the
   overlap counts added up per pair.

A column with over ``CROWDED`` rows doesn't pair them all. One leader is compared with all its
rows; those in one component need no more comparing. What is outside of the largest component is
compared with the whole column by 16, 256, ... leaders at a time, until nothing is left. No link
between components is lost, and a group of near copies costs a pass, not its square.

Words are runs without ASCII white space, A-Z lowered. Texts of under four words have their whole
sequence as the one shingle. Null, empty and wordless texts have no shingles and are linked with
nothing. Repeated rows are rows of their own; null ids take part but never name a component.
Columns other than id and text are ignored. Texts are processed whole, a row's columns must fit in
a task. Shingles are told apart by 64-bit hashes, rows by 128 bits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rekindle.llm.common import discarded, written
from rekindle.llm.simhash import components

WIDTH = 4
PERCENT = 85
#: Rows of a column above which they are compared with leaders instead of each other.
CROWDED = 32
#: Leaders per crowded column: 1 first, then this many times more each round.
MORE = 16
#: Blocks of columns in which surviving pairs are multiplied.
BLOCKS = 8
#: Entries of the table of column counts (a byte each where it is sent to tasks); with fewer, rare
#: columns look common on large inputs and more pairs meet.
SKETCH_BITS = 24
#: Parts in which tasks state their counts, and shingles counted at a time.
PARTS = 64
COUNTED = 1 << 20
#: Values of the id's hash that mark texts to be fetched: at most so many are broadcast.
MARKS = 1 << 20

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _join(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (context ^ (context >> np.uint64(29))) * _MIX + word
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))


def shingles(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    words = (text or b"").translate(_LOWER).split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(width, n)
    out = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        out = _join(out, hashes[k : n - width + 1 + k])
    return np.unique(out)


def _bucket(found: np.ndarray, bits: int) -> np.ndarray:
    return (found >> np.uint64(64 - bits)).astype(np.int64)


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def fingerprint(found: np.ndarray) -> int:
    """SimHash of distinct shingles, as a signed number; zero without shingles."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(found), 1 << 16):
        part = found[at : at + (1 << 16)].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(found), bitorder="little").view("<i8")[0])


def _described(slim: DataFrame, width: int, bits: int, prints: bool = False) -> DataFrame:
    """A row ``(id, node, n, fp)`` per document, and rows ``(part, counts)`` of a task's column
    counts; ``fp`` is the fingerprint where asked for."""
    schema = T.StructType(
        [
            T.StructField("id", slim.schema["id"].dataType),
            T.StructField("node", T.BinaryType()),
            T.StructField("n", T.LongType()),
            T.StructField("fp", T.LongType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("counts", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        seen, waiting = np.zeros(1 << bits, np.int32), []

        def count() -> None:
            at, times = np.unique(_bucket(np.concatenate(waiting), bits), return_counts=True)
            seen[at] += times.astype(np.int32)
            waiting.clear()

        size = 0
        for batch in batches:
            texts, nodes, sizes, fps = batch.column("text").cast(pa.binary()), [], [], []
            for k in range(batch.num_rows):
                found = shingles(texts[k].as_py(), width)
                nodes.append(xxhash.xxh3_128_digest(found.tobytes()))
                sizes.append(len(found))
                fps.append(fingerprint(found) if prints else None)
                waiting.append(found)
                size += len(found)
                if size >= COUNTED:
                    count()
                    size = 0
            none = pa.nulls(batch.num_rows)
            columns = [batch.column("id"), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64())]
            columns += [pa.array(fps, pa.int64()), none, none]
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, target, strict=True)], schema=target
            )
        if waiting:
            count()
        parts = [(k, x) for k, x in enumerate(np.split(seen, PARTS)) if x.any()]
        if parts:
            none = pa.nulls(len(parts))
            columns = [none, none, none, none, pa.array([k for k, _ in parts], pa.int32())]
            columns.append(pa.array([zlib.compress(x.tobytes(), 1) for _, x in parts], pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, target, strict=True)], schema=target
            )

    return slim.mapInArrow(run, schema)


def _commonness(stated: DataFrame, bits: int) -> np.ndarray:
    """A byte per bucket that grows with its count; ``2 ** bits`` bytes reach the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
                own = np.frombuffer(zlib.decompress(counts.as_py()), np.int32)
                sums[part] = sums[part] + own if part in sums else own.astype(np.int64)
        for part, total in sums.items():
            level = np.minimum(255, np.round(8 * np.log2(1.0 + total))).astype(np.uint8)
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "levels": [level.tobytes()]})

    out = np.zeros(1 << bits, np.uint8)
    per = len(out) // PARTS
    for row in stated.repartition(PARTS, "part").mapInArrow(add, "part int, levels binary").collect():
        out[row.part * per : (row.part + 1) * per] = np.frombuffer(row.levels, np.uint8)
    return out


def _rarest(slim: DataFrame, width: int, percent: int, bits: int, common: np.ndarray) -> DataFrame:
    """Per text with shingles ``(node, keys)``: the columns of the first block, rarest first."""
    levels = slim.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = levels.value
        for batch in batches:
            texts, nodes, keys = batch.column("text").cast(pa.binary()), [], []
            for k in range(batch.num_rows):
                found = shingles(texts[k].as_py(), width)
                n = len(found)
                if n:
                    first = np.lexsort((found, table[_bucket(found, bits)]))[: n + (-percent * n) // 100 + 1]
                    nodes.append(xxhash.xxh3_128_digest(found.tobytes()))
                    keys.append(found[first].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["node", "keys"]
            )

    return slim.select("text").mapInArrow(run, "node binary, keys array<bigint>")


def _incidence(slim: DataFrame, width: int) -> DataFrame:
    """The rows of the matrix, cut in blocks: ``(node, block, columns)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").cast(pa.binary()):
                found = shingles(text.as_py(), width)
                if not len(found):
                    continue
                cuts = np.searchsorted(_bucket(found, 3), np.arange(BLOCKS + 1))
                cut = [found[a:b].view(np.int64) for a, b in zip(cuts, cuts[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([xxhash.xxh3_128_digest(found.tobytes())] * BLOCKS, pa.binary()),
                        pa.array(range(BLOCKS), pa.int32()),
                        pa.array(cut, pa.list_(pa.int64())),
                    ],
                    names=["node", "block", "columns"],
                )

    return slim.select("text").mapInArrow(run, "node binary, block int, columns array<bigint>")


def _needed(percent: int) -> Column:
    """(100 + percent) times the least overlap of linked rows ``a`` and ``b``."""
    return percent * (F.col("n_a") + F.col("n_b"))


def _may_link(percent: int) -> Column:
    """The size-derived bound for rows that meet first at their places in a column."""
    return (100 + percent) * F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b")) >= _needed(percent)


def _may_share(percent: int) -> Column:
    """The bound for rows that meet anywhere: what may come before, and what is left."""
    rest = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))
    return (100 + percent) * (F.least("pos_a", "pos_b") + rest) >= _needed(percent)


def _first_block_enough(shared: Column, percent: int) -> Column:
    """The bound after the first block: what is shared there, and all columns that one has left."""
    rest = F.greatest(*[F.ceil(F.col(n) * percent / 100) - 1 for n in ("n_a", "n_b")])
    return (100 + percent) * (shared + rest) >= _needed(percent)


def _side(rows: DataFrame, name: str) -> DataFrame:
    return rows.select("key", *[F.col(c).alias(f"{c}_{name}") for c in rows.columns if c != "key"])


def _met(sparse: DataFrame, crowded: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b, both)`` that the product over the first block's sparse columns leaves.

    Crowded columns are not multiplied here: as many as both rows have may be shared besides.
    """
    pairs = (
        _side(sparse, "a")
        .join(_side(sparse, "b"), "key")
        .filter("num_a < num_b")
        .filter(_may_share(percent))
        .groupBy("num_a", "num_b", "n_a", "n_b")
        .agg(F.count(F.lit(1)).alias("shared"), F.max(_may_link(percent)).alias("first"))
    )
    for name in ("a", "b"):
        own = crowded.select(F.col("num").alias(f"num_{name}"), F.col("crowded").alias(f"crowded_{name}"))
        pairs = pairs.join(own, f"num_{name}", "left")
    more = F.least(*[F.coalesce(f"crowded_{x}", F.lit(0)) for x in ("a", "b")])
    # the column in which they meet first may be a crowded one
    enough = (F.col("first") | (more > 0)) & _first_block_enough(F.col("shared") + more, percent)
    return pairs.filter(enough).select(
        F.col("num_a").alias("a"), F.col("num_b").alias("b"), (F.col("n_a") + F.col("n_b")).alias("both")
    )


def _ordered(pairs: DataFrame) -> DataFrame:
    swap = F.col("num_a") > F.col("num_b")

    def pick(c: str, d: str) -> Column:
        return F.when(swap, F.col(d)).otherwise(F.col(c))

    return pairs.select(
        pick("num_a", "num_b").alias("a"),
        pick("num_b", "num_a").alias("b"),
        (F.col("n_a") + F.col("n_b")).alias("both"),
    ).distinct()


def _multiplied(pairs: DataFrame, matrix: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``(a, b, both)`` whose overlap, added up over column blocks, is enough."""
    left = matrix.select(F.col("num").alias("a"), "block", F.col("columns").alias("own"))
    right = matrix.select(F.col("num").alias("b"), "block", F.col("columns").alias("other"))
    shared = F.size(F.array_intersect("own", "other")).cast("long")
    counts = (
        pairs.join(left, "a")
        .join(right, ["b", "block"])
        .select("a", "b", "both", shared.alias("shared"))
        .groupBy("a", "b", "both")
        .agg(F.sum("shared").alias("overlap"))
    )
    return counts.filter((100 + percent) * F.col("overlap") >= percent * F.col("both")).select("a", "b")


def _crowded_links(dense: DataFrame, links: DataFrame, matrix: DataFrame, percent: int) -> DataFrame:
    """``links`` and those that connect the rows of crowded columns ``(key, num, n, pos, crowded)``."""
    least = dense.groupBy("key").agg(F.min("n").alias("least"))
    # too far behind for any row of the column: no partner left
    room = F.col("n") - F.col("pos")
    open_ = (100 + percent) * room >= percent * (F.col("n") + F.greatest("least", room))
    rows = written(dense.join(least, "key").filter(open_).select("key", "num", "n", "pos", "crowded"), "ngram-crowded")
    todo, leaders = rows, 1
    while True:
        salt = F.pmod(F.xxhash64("num", F.lit(leaders)), F.lit(leaders))
        chosen = todo.groupBy("key", salt.alias("salt")).agg(F.min(F.struct("pos", "num", "n", "crowded")).alias("x"))
        chosen = written(chosen.select("key", "x.*"), "ngram-leaders")
        pairs = _side(rows, "a").join(_side(chosen, "b"), "key").filter("num_a <> num_b").filter(_may_link(percent))
        # pairs that share a sparse column have met there; the others share crowded ones alone
        pairs = pairs.filter(_first_block_enough(F.least("crowded_a", "crowded_b"), percent))
        if leaders > 1:  # what is in one component needs no comparing
            part = roots.select(F.col("node").alias("num"), "root")
            for name in ("a", "b"):
                own = part.select(F.col("num").alias(f"num_{name}"), F.col("root").alias(f"root_{name}"))
                pairs = pairs.join(own, f"num_{name}", "left")
            apart = F.coalesce("root_a", "num_a") != F.coalesce("root_b", "num_b")
            pairs = pairs.filter(apart).select("num_a", "n_a", "num_b", "n_b")
        pairs = written(_ordered(pairs), "ngram-pairs")
        ends = pairs.select(F.col("a").alias("num")).union(pairs.select("b")).distinct()
        new = _multiplied(pairs, matrix.join(ends, "num", "left_semi"), percent)
        links = written(links.unionByName(new).distinct(), "ngram-links")
        roots = written(components(links), "ngram-roots")
        # rows of a column's largest component are compared by those outside of it
        named = rows.join(roots.select(F.col("node").alias("num"), "root"), "num", "left")
        named = named.withColumn("root", F.coalesce("root", "num"))
        sizes = named.groupBy("key", "root").count()
        main = sizes.groupBy("key").agg(F.max(F.struct("count", "root"))["root"].alias("main"))
        rest = named.join(main, "key").filter("root <> main").select("key", "num", "n", "pos", "crowded")
        rest = rest.join(todo.select("key", "num"), ["key", "num"], "left_semi")
        todo = written(rest.join(chosen.select("key", "num"), ["key", "num"], "left_anti"), "ngram-todo")
        if todo.isEmpty():
            return links
        leaders *= MORE


def links(
    slim: DataFrame,
    nodes: DataFrame,
    common: np.ndarray,
    width: int,
    percent: int,
    bits: int,
    candidates: DataFrame | None = None,
) -> DataFrame:
    """Pairs ``(a, b)`` of node numbers that connect all linked nodes.

    ``candidates`` of another filter, ``(num_a, n_a, num_b, n_b)``, are multiplied first: pairs of
    this filter whose nodes they already connect are not compared, nor in crowded columns.
    """
    first = _rarest(slim, width, percent, bits, common).dropDuplicates(["node"])
    posted = first.join(nodes.select("node", "num", "n"), "node").select(
        "num", "n", F.posexplode("keys").alias("pos", "key")
    )
    posted = written(posted.select("key", "num", "n", F.col("pos").cast("long").alias("pos")), "ngram-postings")
    counts = posted.groupBy("key").count().filter("count > 1")
    shared = written(posted.join(counts, "key"), "ngram-shared")
    discarded(posted)
    sparse = shared.filter(F.col("count") <= CROWDED).drop("count")
    dense = shared.filter(F.col("count") > CROWDED).drop("count")
    crowded = dense.groupBy("num").agg(F.count(F.lit(1)).alias("crowded"))
    dense = written(dense.join(crowded, "num"), "ngram-dense")
    met = _met(sparse, crowded, percent)
    near = None if candidates is None else written(_ordered(candidates), "ngram-near-pairs")
    pairs = written(met if near is None else met.unionByName(near).distinct(), "ngram-pairs")
    discarded(shared)
    used = pairs.select(F.col("a").alias("num")).union(pairs.select("b")).union(dense.select("num")).distinct()
    wanted = written(nodes.join(used, "num", "left_semi"), "ngram-wanted")
    # the texts of these nodes: first by a bounded set of marks, then by node
    mark = F.pmod(F.xxhash64("id"), F.lit(MARKS))
    marks = wanted.select(F.col("first").alias("id")).select(mark.alias("mark")).distinct()
    texts = slim.withColumn("mark", mark).join(F.broadcast(marks), "mark", "left_semi")
    matrix = written(
        _incidence(texts, width)
        .join(wanted.select("node", "num"), "node")
        .dropDuplicates(["num", "block"])
        .select("num", "block", "columns"),
        "ngram-incidence",
    )
    if near is None:
        found = written(_multiplied(pairs, matrix, percent), "ngram-links")
    else:
        # the other filter's pairs first: what they connect needs no comparing here
        sure = written(_multiplied(near, matrix, percent), "ngram-near-links")
        part = written(components(sure), "ngram-near-roots")
        rest = pairs.join(near, ["a", "b"], "left_anti")
        for name in ("a", "b"):
            own = part.select(F.col("node").alias(name), F.col("root").alias(f"root_{name}"))
            rest = rest.join(own, name, "left")
        apart = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
        rest = rest.filter(apart).select("a", "b", "both")
        found = written(sure.unionByName(_multiplied(rest, matrix, percent)).distinct(), "ngram-links")
        discarded(near, sure, part)
    out = found if dense.isEmpty() else _crowded_links(dense, found, matrix, percent)
    discarded(matrix, dense)
    return out


def described(
    slim: DataFrame, width: int, bits: int, prints: bool = False
) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """Rows ``(id, node, n, fp)``, the nodes with shingles by number, and how common columns are."""
    stated = written(_described(slim, width, bits, prints), "ngram-described")
    rows = stated.filter("part is null").select("id", "node", "n", "fp")
    nodes = written(
        rows.filter("n > 0")
        .groupBy("node")
        .agg(F.min("id").alias("first"), F.first("n").alias("n"), F.first("fp").alias("fp"))
        .withColumn("num", F.monotonically_increasing_id()),
        "ngram-nodes",
    )
    return rows, nodes, _commonness(stated.filter("part is not null").select("part", "counts"), bits)


def join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    sketch_bits: int = SKETCH_BITS,
) -> DataFrame:
    """One row per document: id, ``n_shingles`` and ``component_id``, the smallest id reachable."""
    slim = _slim(docs, id_col, text_col)
    rows, nodes, common = described(slim, width, sketch_bits)
    roots = components(links(slim, nodes, common, width, percent, sketch_bits))
    named = nodes.join(roots.withColumnRenamed("node", "num"), "num", "left").withColumn(
        "root", F.coalesce("root", "num")
    )
    named = written(named.select("node", "first", "root"), "ngram-named")
    first = named.groupBy("root").agg(F.min("first").alias("component"))
    labels = named.join(first, "root").select("node", "component")
    # without shingles a document is its own component
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return rows.join(labels, "node", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id")
    )
