"""Near copies in a corpus: SimHash, then every text with a Jaccard similarity of 0.8 or more.

1. Each set of distinct five-word shingles gets a SimHash of 64 bits. Fingerprints within two bits
   meet by the pigeonring filter of ``simhash``: chains of neighbouring boxes within proportional
   budgets, crowded boxes through shared one-bit neighbours.
2. At a similarity of 0.8 fingerprints differ in about ten bits, more than boxes can filter. What
   SimHash leaves apart therefore meets in the rarest columns of the shingle matrix of
   ``ngram_join``, by its size-derived bounds, which lose no pair at 0.8.
3. Pairs are compared by their whole sets, those of SimHash first. Groups are the components of
   the texts that are linked; pairs of ``ngram_join`` that SimHash already connected are not
   compared, nor in crowded columns.

Nothing grows with the square of a group, and texts that only share a passage don't meet.

Texts of under five words are one shingle. Null, empty and wordless texts are equal and one group.
Equal sets are one node, whatever the number of rows. Columns other than id and text are kept and
never read. Empty tables give empty results.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType

from rekindle.llm import ngram_join, simhash
from rekindle.llm.common import written

SHINGLE = 5
PERCENT = 80
#: Entries of the table of column counts; as few as this keep the stage within its disk.
SKETCH_BITS = 22


@arrow_udf(BinaryType())
def _node(texts: pa.Array) -> pa.Array:
    parts = texts.cast(pa.binary())
    return pa.array([xxhash.xxh3_128_digest(ngram_join.shingles(t.as_py(), SHINGLE).tobytes()) for t in parts], pa.binary())


def simhash_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs of nodes ``(num_a, n_a, num_b, n_b)`` whose fingerprints are linked, as stars."""
    prints = written(nodes.groupBy("fp").agg(F.min(F.struct("num", "n")).alias("x")), "near-prints")
    own = prints.select("fp", F.col("x.num").alias("num_a"), F.col("x.n").alias("n_a"))
    same = nodes.select("fp", F.col("num").alias("num_b"), F.col("n").alias("n_b")).join(own, "fp")
    other = own.select(F.col("fp").alias("b"), F.col("num_a").alias("num_b"), F.col("n_a").alias("n_b"))
    near = simhash.links(prints.select("fp")).join(own.withColumnRenamed("fp", "a"), "a").join(other, "b")
    columns = ["num_a", "n_a", "num_b", "n_b"]
    return same.filter("num_a <> num_b").select(columns).unionByName(near.select(columns))


def groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Per group the row that stays, ``(id, node)``, the smallest id, null ids last; and all rows.

    A repeated id may carry different texts and then stand for several groups; each has its own.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    bits = SKETCH_BITS
    rows, nodes, common = ngram_join.described(slim, SHINGLE, bits, prints=True)
    links = ngram_join.links(slim, nodes, common, SHINGLE, PERCENT, bits, simhash_pairs(nodes))
    roots = simhash.components(links).withColumnRenamed("node", "num")
    # the smallest id of every node, with the node: a map-side minimum, whatever the copies
    name = F.struct(F.col("id").isNull().alias("unnamed"), "id", "node")
    first = rows.groupBy("node").agg(F.min(name).alias("first"))
    of = nodes.select("node", "num").join(roots, "num", "left").select("node", F.coalesce("root", "num").alias("root"))
    named = first.join(of, "node", "left")
    # texts without words have no number: they are the one group of the empty set
    kept = named.groupBy(F.coalesce("root", F.lit(-1))).agg(F.min("first").alias("x"))
    return written(kept.select("x.id", "x.node"), "near-kept"), rows


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of near copies, the smallest id; all columns stay as they are.

    A repeated row is kept once. Of rows that share id and shingles but differ elsewhere, the first
    in the order of their columns' hash stays. Only rows whose id is repeated are told apart by
    their shingles; a row's text moves once, to the list of ids that stay.
    """
    kept, rows = groups(docs, id_col, text_col)
    keep = kept.select(F.col("id").alias("__id"), F.col("node").alias("__node"))
    repeated = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col("id").isNull())
    repeated = written(repeated.select(F.col("id").alias("__id")), "near-repeated")
    ids = keep.join(repeated, keep["__id"].eqNullSafe(repeated["__id"]), "left_anti").select("__id")
    single = docs.join(ids, F.col(id_col) == F.col("__id"), "left_semi")
    again = docs.join(repeated, F.col(id_col).eqNullSafe(F.col("__id")), "left_semi").withColumn("__own", _node(F.col(text_col).cast("string")))
    hit = again.join(keep, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__node")), "left_semi")
    packed = hit.select(id_col, "__own", F.struct(F.xxhash64(*docs.columns).alias("h"), F.struct(*docs.columns).alias("r")).alias("__row"))
    one = packed.groupBy(id_col, "__own").agg(F.min_by("__row", "__row.h").alias("__row")).select("__row.r.*")
    return single.select(docs.columns).unionByName(one.select(docs.columns))
