"""Ranked lexical search with per-term geometric blocking.

A term ``t`` of ``tf`` occurrences in a document of ``n`` terms gains it
``w(t) * ((10**9 * tf) div (1000 * tf + 8 * m))`` for each time it stands in the item, with
``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and ``m = 25 + (75 * n * N) div L``; N documents with
terms, L terms in them. All but the logarithm is 64-bit integer, so scores are exact.

1. Documents become sparse vectors over the terms of the items, and are ordered by the signs of
   random projections of these vectors: similar documents stand next to each other. The order is
   cut in shards; a shard of the index is one row and holds its vectors, and its posting lists.
2. The posting list of a term in a shard follows that order and is cut in blocks of ``BLOCK``
   neighbours. A block stores the coordinatewise maximum of its documents' vectors, rounded up to
   a byte per coordinate. Lists of up to ``SHORT`` documents are one block without a summary.
3. A bound on the k-th best score of each item comes from the documents of its rarest terms.
4. Per shard and item, terms that even together can't reach the bound are left out; of the other
   lists, a block is skipped only if its summary times the item's weights stays below the bound
   (equal scores may still win by id). Documents of the other blocks are scored by their vectors,
   and the bound rises with them.

The result is that of scoring every document. Items are taken in blocks of ``ITEM_BYTES`` of text,
each a pass over the documents; what is sent to tasks is the vocabulary of such a block.

Terms are runs of ASCII letters and digits and any other characters beyond ASCII; only A-Z are
lowered. Null and empty texts have none, are no documents of N, and items without terms have no
rows. Repeated documents are ranked each, ties by ascending id, nulls last; repeated items are
answered each. Columns other than ids and texts are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rekindle.llm.common import ragged_take, written

K = 10
SHARD = 2048
BLOCK = 64
SHORT = 8
#: Bytes of a shard's vectors written out, which bound its size where items have many terms.
DENSE_BYTES = 16 << 20
ITEM_BYTES = 256 << 10
#: Documents of an item's rarest terms from which its first bound comes, per result.
FIRST = 50
#: Signs of projections by which documents are ordered.
SIGNS = 32
SEED = 42
#: A gain is below a million: levels of a summary's byte.
STEP = 3922

_TERMS = bytes(
    32 if c < 0x30 or 0x3A <= c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F else c + 32 if 0x41 <= c <= 0x5A else c
    for c in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERMS).split()


def _packed(values: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(values).data, 1)


def _unpacked(data: bytes, kind=np.int32) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


def _vectors(slim: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """Per document with terms: ``id``, ``n``, numbers and counts of known terms, place in the order."""
    number = slim.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(vocabulary)})
    schema = T.StructType(
        [
            T.StructField("id", slim.schema["id"].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("terms", T.ArrayType(T.IntegerType())),
            T.StructField("counts", T.ArrayType(T.IntegerType())),
            T.StructField("place", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        known = number.value
        signs = np.random.default_rng(SEED).integers(0, 2, (len(known), SIGNS), np.int8) * 2 - 1
        bits = 1 << np.arange(SIGNS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            texts, keep, sizes, found, counts, places = batch.column("text").cast(pa.binary()), [], [], [], [], []
            for k in range(batch.num_rows):
                own = terms(texts[k].as_py())
                if own:
                    seen = Counter([t for t in own if t in known])
                    at = np.fromiter(map(known.__getitem__, seen), np.int32, len(seen))
                    keep.append(k)
                    sizes.append(len(own))
                    found.append(at)
                    counts.append(np.fromiter(seen.values(), np.int32, len(seen)))
                    places.append(int(bits[signs[at].sum(axis=0, dtype=np.int64) > 0].sum()))
            columns = [
                batch.column("id").take(pa.array(keep, pa.int64())),
                pa.array(sizes, pa.int64()),
                pa.array(found, pa.list_(pa.int32())),
                pa.array(counts, pa.list_(pa.int32())),
                pa.array(places, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, target, strict=True)], schema=target
            )

    return slim.mapInArrow(run, schema)


def _gains(batch: pa.RecordBatch, documents: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the rows' vectors, their term numbers and gains."""
    listed = batch.column("terms")
    sizes = listed.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    found = listed.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    tf = batch.column("counts").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    n = batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
    m = np.repeat(25 + (75 * n * documents) // max(1, length), sizes)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    return starts, found, (10**9 * tf) // (1000 * tf + 8 * m)


def _scores(rows: np.ndarray, starts: np.ndarray, found: np.ndarray, gains: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Scores of some rows, none of them empty, under weights per term."""
    sizes = np.diff(starts)
    took, each = ragged_take(starts[:-1], sizes, np.arange(len(found)), rows)
    return np.add.reduceat(weights[found[took]] * gains[took], np.cumsum(each) - each)


class Items:
    """The items of a block: weight of every term, and per item its terms, rarest first."""

    def __init__(self, counted: list[dict[int, int]], frequency: np.ndarray, documents: int, k: int):
        self.k, self.size = k, len(frequency)
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(f) + 1))) for f in frequency], np.int64)
        self.terms, self.weights, self.first = [], [], []
        for own in counted:
            at = np.array(sorted((t for t in own if frequency[t]), key=lambda t: (frequency[t], t)), np.int64)
            self.terms.append(at)
            self.weights.append(weight[at] * np.array([own[t] for t in at.tolist()], np.int64))
            upto = np.cumsum(frequency[at])
            self.first.append(at[: int(np.searchsorted(upto, FIRST * k)) + 1])

    def spread(self, item: int) -> np.ndarray:
        out = np.zeros(self.size, np.int64)
        out[self.terms[item]] = self.weights[item]
        return out


def _first_bounds(vectors: DataFrame, items, documents: int, length: int) -> DataFrame:
    """The k best scores of each item among the documents of its rarest terms, per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = items.value
        best = np.zeros((len(known.terms), known.k), np.int64)
        for batch in batches:
            starts, found, gains = _gains(batch, documents, length)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(starts))
            order = np.argsort(found, kind="stable")
            lists = np.searchsorted(found[order], np.arange(known.size + 1))
            for item, first in enumerate(known.first):
                parts = [owner[order[lists[t] : lists[t + 1]]] for t in first]
                rows = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
                if len(rows):
                    got = _scores(rows, starts, found, gains, known.spread(item))
                    every = np.concatenate((best[item], got))
                    best[item] = np.partition(every, len(every) - known.k)[-known.k :]
        item, place = np.nonzero(best > 0)
        yield pa.RecordBatch.from_pydict({"item": item.astype(np.int32), "score": best[item, place]})

    return vectors.mapInArrow(run, "item int, score bigint")


def _index(vectors: DataFrame, size: int, documents: int, length: int, shard: int) -> DataFrame:
    """A row per shard: ids, vectors, posting lists, blocks and their summaries, packed."""
    schema = T.StructType(
        [T.StructField("ids", T.ArrayType(vectors.schema["id"].dataType))]
        + [
            T.StructField(c, T.BinaryType())
            for c in ("starts", "terms", "gains", "lists", "rows", "blocks", "firsts", "summaries", "most")
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)

        def build(pending: list[pa.RecordBatch]) -> pa.RecordBatch:
            batch = pa.Table.from_batches(pending).combine_chunks().to_batches()[0]
            starts, found, gains = _gains(batch, documents, length)
            owner = np.repeat(np.arange(batch.num_rows, dtype=np.int32), np.diff(starts))
            order = np.argsort(found, kind="stable")  # by term, then place in the order
            rows, listed = owner[order], found[order]
            lists = np.searchsorted(listed, np.arange(size + 1)).astype(np.int32)
            most = np.zeros(size, np.int32)
            np.maximum.at(most, found, gains.astype(np.int32))
            dense = np.zeros((batch.num_rows, size), np.uint8)
            dense[owner, found] = -(-gains // STEP)
            # blocks of long lists: by term, the first posting of each
            firsts, blocks, summaries = [], np.zeros(size + 1, np.int32), []
            for t in range(size):
                a, b = lists[t], lists[t + 1]
                if b - a > SHORT:
                    own = np.arange(0, b - a, BLOCK)
                    firsts.append(a + own)
                    summaries.append(np.maximum.reduceat(dense[rows[a:b]], own, axis=0))
                    blocks[t + 1] = len(own)
            del dense
            summaries = np.concatenate([*summaries, np.zeros((0, size), np.uint8)])
            values = {
                "starts": starts.astype(np.int32),
                "terms": found.astype(np.int32),
                "gains": gains.astype(np.int32),
                "lists": lists,
                "rows": rows,
                "blocks": np.cumsum(blocks).astype(np.int32),
                "firsts": np.concatenate([*firsts, [len(rows)]]).astype(np.int32),
                "summaries": summaries,
                "most": most,
            }
            columns = [pa.array([batch.column("id").to_pylist()], target.field("ids").type)]
            columns += [pa.array([_packed(values[f.name])], pa.binary()) for f in list(target)[1:]]
            return pa.RecordBatch.from_arrays(columns, schema=target)

        pending, have = [], 0
        for batch in batches:
            while batch.num_rows:
                piece = batch.slice(0, shard - have)
                batch = batch.slice(piece.num_rows)
                pending.append(piece)
                have += piece.num_rows
                if have == shard:
                    yield build(pending)
                    pending, have = [], 0
        if pending:
            yield build(pending)

    return vectors.mapInArrow(run, schema)


class Shard:
    """A shard of the index, read back."""

    def __init__(self, row: dict, size: int):
        self.ids = row["ids"]
        for name in ("starts", "terms", "gains", "lists", "rows", "blocks", "firsts", "most"):
            setattr(self, name, _unpacked(row[name]).astype(np.int64))
        self.summaries = _unpacked(row["summaries"], np.uint8).reshape(-1, size)

    def candidates(self, at: np.ndarray, weights: np.ndarray, bound: int) -> np.ndarray:
        """Rows that may reach the bound, from the blocks that can't be skipped."""
        reach = weights * self.most[at]
        order = np.argsort(reach, kind="stable")
        needed = order[np.cumsum(reach[order]) >= bound]
        parts = []
        for t in at[needed[reach[needed] > 0]].tolist():
            a, b = self.blocks[t], self.blocks[t + 1]
            if a == b:
                parts.append(self.rows[self.lists[t] : self.lists[t + 1]])
                continue
            most = self.summaries[a:b][:, at].astype(np.int64) @ weights * STEP
            ends = np.append(self.firsts[a + 1 : b], self.lists[t + 1])
            for k in np.flatnonzero(most >= bound).tolist():
                parts.append(self.rows[self.firsts[a + k] : ends[k]])
        return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)


def _searched(index: DataFrame, items, bounds, kind: T.DataType) -> DataFrame:
    """The k best documents of each item per task."""
    schema = T.StructType(
        [T.StructField("item", T.IntegerType()), T.StructField("id", kind), T.StructField("score", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        known = items.value
        bound = [max(1, b) for b in bounds.value]
        best: list[list] = [[] for _ in known.terms]
        for batch in batches:
            for k in range(batch.num_rows):  # a row is a whole shard
                shard = Shard({c: batch.column(c)[k].as_py() for c in batch.schema.names}, known.size)
                for item, at in enumerate(known.terms):
                    rows = shard.candidates(at, known.weights[item], bound[item])
                    if not len(rows):
                        continue
                    got = _scores(rows, shard.starts, shard.terms, shard.gains, known.spread(item))
                    good = np.flatnonzero(got >= bound[item])
                    if not len(good):
                        continue
                    every = best[item] + [(-int(got[k]), (i := shard.ids[rows[k]]) is None, i) for k in good]
                    every.sort(key=lambda x: x if not x[1] else x[:2])
                    best[item] = every[: known.k]
                    if len(best[item]) == known.k:
                        bound[item] = max(bound[item], -best[item][-1][0])
        out = [(item, i, -score) for item, own in enumerate(best) for score, _, i in own]
        target = to_arrow_schema(schema)
        columns = [pa.array([x[c] for x in out], target.field(c).type) for c in range(3)]
        yield pa.RecordBatch.from_arrays(columns, schema=target)

    return index.mapInArrow(run, schema)


def _search_block(slim: DataFrame, asked: list, k: int) -> DataFrame:
    """Ranks for the items ``(item, text)``: ``(item, rank, id, score)``."""
    counted = [Counter(terms((row.text or "").encode("utf-8", "surrogatepass"))) for row in asked]
    vocabulary = sorted(set().union(*counted))
    number = {t: n for n, t in enumerate(vocabulary)}
    size = max(1, len(vocabulary))
    spark = slim.sparkSession
    vectors = written(_vectors(slim, vocabulary), "search-vectors")
    documents, length = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # one row per term of the items
    frequency = np.zeros(size, np.int64)
    for row in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        frequency[row.t] = row["count"]
    items = spark.sparkContext.broadcast(
        Items([{number[t]: c for t, c in own.items()} for own in counted], frequency, documents, k)
    )
    some = vectors.filter(F.size("terms") > 0)
    best = Window.partitionBy("item").orderBy(F.desc("score"))
    first = _first_bounds(some, items, documents, length).withColumn("nth", F.row_number().over(best))
    bounds = [0] * len(asked)
    for row in first.filter(F.col("nth") <= k).filter(F.col("nth") == k).collect():
        bounds[row.item] = row.score
    shard = max(256, min(SHARD, DENSE_BYTES // size))
    parts = max(1, -(-documents // (2 * shard)))
    order = F.xxhash64("id")
    near = some.repartitionByRange(parts, "place", order).sortWithinPartitions("place", order)
    index = written(_index(near, size, documents, length, shard), "search-index")
    found = _searched(index, items, spark.sparkContext.broadcast(bounds), slim.schema["id"].dataType)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    names = spark.createDataFrame([(n, row.number) for n, row in enumerate(asked)], "item int, number long")
    return ranked.join(names, "item").select("number", "rank", "id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The k documents of highest score above 0 per item: item id, ``rank``, document id, ``score``."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    asked = written(asked.withColumn("number", F.monotonically_increasing_id()), "search-items")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // ITEM_BYTES))
    block = F.pmod(F.xxhash64("number"), F.lit(blocks))
    ranked = None
    for b in range(blocks):
        # bounded: a block of about ITEM_BYTES
        own = asked.filter(block == b).select("number", "text").collect()
        part = _search_block(slim, own, k)
        if blocks > 1:
            part = written(part, "search-ranked")
        ranked = part if ranked is None else ranked.unionByName(part)
    return ranked.join(asked.select("number", "item_id"), "number").select(
        F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score"
    )
