"""Stupid-backoff scores of documents under n-gram counts of the whole corpus.

    S(w | context) = c(context w) / c(context)        if the n-gram was seen often enough
                   = backoff * S(w | shorter context)  otherwise;  c(w) / N at the end

Counts come from all documents. Tasks reduce a block of texts (about ``BLOCK_BYTES``) to its
distinct n-grams with their local counts; these rows, packed as arrays, are partitioned by the
n-gram's hash, where the counts of all blocks are added up (the count table) and joined to the
n-grams of each block. The counts go back to the blocks, whose words look up their n-grams, and
are summed per document. An n-gram is one entry of a block however often it occurs, so a frequent
word or a passage that many documents share weighs no more than any other.

Blocks are written once, as compressed word numbers and the hashes of their distinct words, and
numbers of n-grams follow from them, so that a repeated task finds the same ones. N-grams are
told apart by 64-bit hashes.

A word is a run without ASCII white space; case and marks count. n-grams do not cross documents.
Null, empty and wordless texts have no words, a log score of 0 and no mean. Repeated rows count
and are scored each. Columns other than id and text are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rekindle.llm.bpe import chunks, pack, unpack
from rekindle.llm.common import written

ORDER = 2
BACKOFF = 0.4
#: An n-gram of two words or more counts as seen from here on.
LEAST = 2
BLOCK_BYTES = 12 << 20
#: Text per hash group of n-grams.
GROUP_BYTES = 12 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def mix(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from the hashes of its context and its last word."""
    with np.errstate(over="ignore"):
        h = (context ^ (context >> np.uint64(29))) * _MIX + word
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))


def _pack_counts(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    return zlib.compress(planes.tobytes(), 1)


def _unpack_counts(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


class NGrams:
    """Distinct n-grams of a block, all orders in one numbering that follows their hash group."""

    def __init__(self, words: np.ndarray, per_text: np.ndarray, hashes: np.ndarray, order: int, groups: int):
        n = len(words)
        ends = np.cumsum(per_text)
        #: Place of each word in its own text.
        self.place = np.arange(n, dtype=np.int32)
        self.place -= np.repeat((ends - per_text).astype(np.int32), per_text)
        local, found, self.offsets = words.astype(np.int32), hashes, [0]
        pools, occurrences, self.at = [], [], []
        for k in range(1, order + 1):
            if k > 1:
                ok = np.flatnonzero(self.place >= k - 1)
                code = local[ok - 1].astype(np.int64)
                code *= len(hashes)
                code += words[ok]
                distinct, inverse = np.unique(code, return_inverse=True)
                del code
                found = mix(found[distinct // len(hashes)], hashes[distinct % len(hashes)])
                local = np.full(n, -1, np.int32)
                local[ok] = inverse
                del ok, distinct, inverse
            pools.append(mix(found, np.full(len(found), k, np.uint64)))
            occurrences.append(np.bincount(local[local >= 0], minlength=len(found)))
            self.at.append(np.where(local >= 0, local + np.int32(self.offsets[-1]), np.int32(-1)))
            self.offsets.append(self.offsets[-1] + len(found))
        pool = np.concatenate(pools)
        del pools, local, found
        group = ((pool >> np.uint64(32)) % np.uint64(groups)).astype(np.int32)
        order_ = np.argsort(group, kind="stable").astype(np.int32)
        number = np.empty(len(pool), np.int32)
        number[order_] = np.arange(len(pool), dtype=np.int32)
        self.hashes, self.counts = pool[order_], np.concatenate(occurrences)[order_]
        self.cuts = np.searchsorted(group[order_], np.arange(groups + 1))
        del pool, group, occurrences, order_
        #: By order, the number of the n-gram that ends at each word, -1 if the text is too short.
        self.at = [np.where(a >= 0, number[a], np.int32(-1)) for a in self.at]


def _blocks(slim: DataFrame) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("block", T.StringType()),
            T.StructField("ids", T.ArrayType(slim.schema["id"].dataType)),
            T.StructField("counts", T.BinaryType()),
            T.StructField("sequence", T.BinaryType()),
            T.StructField("hashes", T.BinaryType()),
            T.StructField("n_words", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)

        def block(pending: list[pa.RecordBatch]) -> pa.RecordBatch:
            data = pa.Table.from_batches(pending).combine_chunks()
            index, distinct, counts = chunks(data["text"].chunk(0))
            # white space at an end of a text leaves an empty chunk
            real = np.fromiter(map(bool, distinct), bool, len(distinct))
            if not real.all():
                keep = real[index]
                text = np.repeat(np.arange(len(counts)), counts)[keep]
                index, counts = index[keep], np.bincount(text, minlength=len(counts))
            frequency = np.bincount(index, minlength=len(distinct))
            order = np.argsort(-frequency, kind="stable")[: int((frequency > 0).sum())]
            rank = np.zeros(len(distinct), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            hashes = np.fromiter(
                (xxhash.xxh64_intdigest(distinct[k].encode("utf-8", "surrogatepass")) for k in order),
                np.dtype("<u8"),
                len(order),
            )
            row = {
                "block": uuid.uuid4().hex,
                "ids": data["id"].to_pylist(),
                "counts": pack(counts),
                "sequence": pack(rank[index]),
                "hashes": hashes.tobytes(),
                "n_words": len(index),
            }
            return pa.RecordBatch.from_pylist([row], schema=target)

        pending, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                piece = batch.slice(at, 250)
                pending.append(piece)
                size += piece.nbytes
                if size >= BLOCK_BYTES:
                    yield block(pending)
                    pending, size = [], 0
        if pending:
            yield block(pending)

    return slim.mapInArrow(run, schema)


def _ngrams(row: dict, order: int, groups: int) -> NGrams:
    return NGrams(
        unpack(row["sequence"]),
        unpack(row["counts"]).astype(np.int64),
        np.frombuffer(row["hashes"], "<u8").astype(np.uint64),
        order,
        groups,
    )


def _packed_ngrams(order: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k].as_py() for n in ("block", "sequence", "counts", "hashes")}
                own = _ngrams(row, order, groups)
                parts = np.flatnonzero(np.diff(own.cuts))
                if not len(parts):
                    continue
                spans = [slice(own.cuts[g], own.cuts[g + 1]) for g in parts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(parts.astype(np.int32)),
                        pa.array([row["block"]] * len(parts)),
                        pa.array([s.start for s in spans], pa.int64()),
                        pa.array([own.hashes[s].astype("<u8").tobytes() for s in spans], pa.binary()),
                        pa.array([_pack_counts(own.counts[s]) for s in spans], pa.binary()),
                    ],
                    names=["part", "block", "first", "hashes", "counts"],
                )

    return run


def _add_up(group: pa.Table) -> pa.Table:
    """The count table of a hash group, joined to the n-grams of every block in it."""
    hashes = [np.frombuffer(x, "<u8") for x in group["hashes"].to_pylist()]
    counts = np.concatenate([_unpack_counts(x) for x in group["counts"].to_pylist()])
    distinct, place = np.unique(np.concatenate(hashes), return_inverse=True)
    table = np.zeros(len(distinct), np.int64)
    np.add.at(table, place, counts)
    back = np.split(table[place], np.cumsum([len(h) for h in hashes])[:-1])
    return pa.table(
        {
            "block": group["block"],
            "first": group["first"],
            "counts": pa.array([_pack_counts(x) for x in back], pa.binary()),
        }
    )


def _score(order: int, groups: int, total: int, backoff: float, least: int, schema: T.StructType):
    def run(blocks: pa.Table, table: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        parts = []
        for k in range(blocks.num_rows):
            row = {n: blocks[n][k].as_py() for n in ("ids", "sequence", "counts", "hashes")}
            own = _ngrams(row, order, groups)
            counts = np.zeros(len(own.hashes) + 1, np.int64)
            for first, data in zip(table["first"].to_pylist(), table["counts"].to_pylist(), strict=True):
                values = _unpack_counts(data)
                counts[first : first + len(values)] = values
            per_text = unpack(row["counts"]).astype(np.int64)
            text = np.repeat(np.arange(len(per_text)), per_text)
            # from the shortest n-gram up, a longer one that was seen replaces what it backs off to
            value = np.log(counts[own.at[0]] / max(1, total))
            steps = np.zeros(len(text), np.int64)
            for n in range(2, order + 1):
                seen = (own.at[n - 1] >= 0) & (counts[own.at[n - 1]] >= least)
                possible = own.place >= n - 1
                context = counts[own.at[n - 2][np.maximum(np.arange(len(text)) - 1, 0)]]
                with np.errstate(divide="ignore", invalid="ignore"):
                    longer = np.log(counts[own.at[n - 1]] / context)
                missed = possible & ~seen
                value = np.where(seen, longer, np.where(missed, value + np.log(backoff), value))
                steps = np.where(seen, 0, steps + missed)
            n = len(per_text)
            score = np.bincount(text, weights=value, minlength=n)
            parts.append(
                pa.table(
                    {
                        "id": pa.array(row["ids"], target.field(0).type),
                        "n_words": pa.array(per_text, pa.int64()),
                        "n_backoff": pa.array(np.bincount(text, weights=steps > 0, minlength=n).astype(np.int64)),
                        "log_score": pa.array(score.astype(np.float64)),
                    },
                    schema=target,
                )
            )
        return pa.concat_tables(parts) if parts else target.empty_table()

    return run


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    backoff: float = BACKOFF,
    least: int = LEAST,
) -> DataFrame:
    """Per document: ``n_words``, ``n_backoff`` (words scored by a shorter n-gram), ``log_score``
    (sum of natural logarithms) and ``mean_log_score``."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    blocks = written(_blocks(slim), "lm-blocks")
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(8, -(-size // GROUP_BYTES))
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    rows = blocks.select("block", "sequence", "counts", "hashes").mapInArrow(
        _packed_ngrams(order, groups), "part int, block string, first long, hashes binary, counts binary"
    )
    table = rows.groupBy("part").applyInArrow(_add_up, "block string, first long, counts binary")
    out = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_backoff", T.LongType()),
            T.StructField("log_score", T.DoubleType()),
        ]
    )
    scored = (
        blocks.select("block", "ids", "counts", "sequence", "hashes")
        .groupBy("block")
        .cogroup(table.groupBy("block"))
        .applyInArrow(_score(order, groups, total, backoff, least, out), out)
    )
    mean = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words"))
    return scored.select(
        F.col("id").alias(id_col), "n_words", "n_backoff", "log_score", mean.alias("mean_log_score")
    )
