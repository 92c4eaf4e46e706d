"""SimHash near-duplicates: fingerprints, pigeonring candidate filter, linked components.

A text becomes 64 bits; two texts are linked when at most two bits differ. The 64 bits are cut
into five boxes on a ring. If two fingerprints differ in at most two bits, some box starts a chain
whose running sum of differences stays within the proportional budget ``floor(length * 2 / 5)``:
0, 0, 1, 1, 2 bits for chains of one to five boxes. Hence two neighbouring boxes are equal: they
are the join key, and the longer chains prune what the key lets through before the full check.

A key shared by many fingerprints (a dense ball of near copies) would need all pairs within it.
Those fingerprints are linked another, equally exact way: each states its 64 one-bit neighbours
and itself; fingerprints that state the same value differ in at most two bits, and two that differ
in at most two bits always share one. A stated value has at most 65 owners, so nothing grows with
the square of a group.

Texts: null and wordless ones have fingerprint zero and are linked like any other. Repeated rows
and equal texts share a fingerprint. Null ids take part, but never name a component; a component
whose ids are all null has a null name. Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from rekindle.llm.common import written

SHINGLE = 3
SEED = 42
DISTANCE = 2
#: Lowest bit and width of each box.
BOXES = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Owners of a key above which its fingerprints are linked through shared neighbours.
CROWDED = 32
#: Shingles hashed at a time, so that a very long text needs bounded memory.
CHUNK = 1 << 16

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """SimHash of one text as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(1, len(words) - width + 1)
    starts, ends = starts[:last], ends[min(width, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, last, CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.dtype("<u8"))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > last, bitorder="little").view("<u8")[0])


@pandas_udf(LongType())
def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in texts:
        values = np.fromiter((fingerprint(t) for t in part), np.uint64, len(part))
        yield pd.Series(values.view(np.int64))


def fingerprint_column(text: Column) -> Column:
    """Fingerprint as a signed 64-bit number."""
    return _fingerprints(text)


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _box(fp: Column, k: int) -> Column:
    low, width = BOXES[k % len(BOXES)]
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))


def _keys(fps: DataFrame) -> DataFrame:
    """Each fingerprint once per chain start, with the two boxes that must be equal."""
    keys = [
        F.struct(
            F.lit(k).alias("start"),
            F.shiftleft(_box(F.col("fp"), k), 13).bitwiseOR(_box(F.col("fp"), k + 1)).alias("key"),
        )
        for k in range(len(BOXES))
    ]
    return fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.start", "k.key")


def _viable(a: Column, b: Column, start: Column) -> Column:
    """The chain from ``start`` keeps within its budget at every length."""
    diff = [F.bit_count(_box(a.bitwiseXOR(b), k)) for k in range(len(BOXES))]
    n = len(BOXES)

    def chain(s: int) -> Column:
        fits = F.lit(True)
        for length in range(1, n + 1):
            total = sum((diff[(s + j) % n] for j in range(length)), F.lit(0))
            fits = fits & (total <= DISTANCE * length // n)
        return fits

    return F.coalesce(*[F.when(start == s, chain(s)) for s in range(n)])


def links(fps: DataFrame) -> DataFrame:
    """Pairs ``(a, b)``, a < b, that connect all fingerprints linked within two bits.

    ``fps`` holds distinct values in ``fp``. Within a dense ball a star is returned, not all pairs.
    """
    keys = written(_keys(fps), "simhash-keys")
    crowded = (
        keys.groupBy("start", "key").count().filter(F.col("count") > CROWDED).select("start", "key")
    )
    sparse = keys.join(crowded, ["start", "key"], "left_anti")
    a = sparse.select("start", "key", F.col("fp").alias("a"))
    b = sparse.select("start", "key", F.col("fp").alias("b"))
    near = (
        a.join(b, ["start", "key"])
        .filter(F.col("a") < F.col("b"))
        .filter(_viable(F.col("a"), F.col("b"), F.col("start")))
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE)
        .select("a", "b")
    )
    dense = keys.join(crowded, ["start", "key"], "left_semi").select("fp").distinct()
    around = F.array(F.lit(0).cast("long"), *[F.lit(1 << k if k < 63 else -(1 << 63)) for k in range(64)])
    stars = (
        dense.select("fp", F.explode(around).alias("bit"))
        .groupBy(F.col("fp").bitwiseXOR(F.col("bit")).alias("stated"))
        .agg(F.array_sort(F.collect_list("fp")).alias("owners"))
        .filter(F.size("owners") > 1)
        .select(F.col("owners")[0].alias("a"), F.explode("owners").alias("b"))
        .filter(F.col("a") < F.col("b"))
    )
    return near.unionByName(stars).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, root)``, root being the smallest node.

    Each round takes the smallest root among a node's neighbours, hooks the node's old root under
    it, and jumps to the root of the root. Every round is written to the shared folder.
    """
    both = written(
        edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        ),
        "components-edges",
    )
    roots = written(
        both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")),
        "components-roots",
    )
    for _ in range(max_rounds):
        seen = both.join(roots.select(F.col("node").alias("other"), "root"), "other").select(
            "node", "root"
        )
        best = (
            seen.unionByName(roots).groupBy("node").agg(F.min("root").alias("best"))
        )
        moved = written(roots.join(best, "node"), "components-best")
        hooks = moved.groupBy(F.col("root").alias("node")).agg(F.min("best").alias("hook"))
        hooked = moved.join(hooks, "node", "left").select(
            "node", F.col("root").alias("old"), F.least("best", "hook").alias("root")
        )
        up = hooked.select(F.col("node").alias("root"), F.col("root").alias("above"))
        after = written(
            hooked.join(up, "root").select("node", "old", F.least("root", "above").alias("root")),
            "components-roots",
        )
        roots = after.select("node", "root")
        if after.filter(F.col("old") != F.col("root")).isEmpty():
            return roots
    raise RuntimeError(f"components still change after {max_rounds} rounds")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``fingerprint``, ``component_id``, and the number ``fp``."""
    rows = written(
        docs.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text_col)).alias("fp")),
        "simhash-rows",
    )
    fps = written(rows.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    roots = components(links(fps.select("fp")))
    named = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    named = written(named, "simhash-named")
    first = named.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = named.join(first, "root").select("fp", "component_id", "root")
    return rows.join(labels, "fp").select(
        F.col("id").alias(id_col),
        hex_digits(F.col("fp")).alias("fingerprint"),
        "component_id",
        "fp",
        "root",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, the one that names it; all columns stay as they are.

    A repeated row is kept once. A repeated id may carry different texts and then name several
    components; each keeps its own. Among rows of one component and id the smallest fingerprint
    is kept.
    """
    names = F.col(id_col).eqNullSafe(F.col("component_id"))
    keep = (
        near_duplicates(docs, id_col, text_col)
        .groupBy("root", F.col("component_id").alias("__id"))
        .agg(F.min(F.when(names, F.col("fp"))).alias("__fp"))
        .select("__id", "__fp")
    )
    own = docs.withColumn("__own", fingerprint_column(F.col(text_col)))
    hit = own.join(
        keep, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__fp")), "left_semi"
    )
    return hit.dropDuplicates([id_col, "__own"]).select(docs.columns)
