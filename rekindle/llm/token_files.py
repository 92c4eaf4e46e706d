"""Token files: ids coded by a static range asymmetric numeral system (rANS).

Documents are sorted by id over range partitions (shards). A shard is written as rows of one
segment each: document ids and lengths, the position of the first token in the shard, and
``data``. All blocks of a segment share its frequency table. A block codes its tokens with
interleaved lanes and stands alone; the segment's index holds its checkpoint (place of the
payload, first token, number of tokens) and two checksums, of the payload and of the ids, so
that blocks can be decoded in parallel and damage is found where it is.

``data``, little endian: magic ``RKT1``; u32 symbols, u32 blocks, u32 bytes of the deflated table
(u32 symbols, then u32 frequencies, sum 2**20); the table; per block u64 place, u64 first token,
u32 tokens, u32 lanes, u32 crc32 of payload, u32 crc32 of ids; then the payloads: u64 lane
states, then u32 words in reading order.

Null texts are empty documents of one end id. Null ids come first, repeated ids by a hash of the
text. Columns other than id and text are ignored. An empty table gives an empty file set.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rekindle.llm.bpe import encode_chunks
from rekindle.llm.common import ragged_take

END_ID = 2
BITS = 20
LOW = 1 << 31
LANES = 1024
BLOCK_TOKENS = 1 << 18
#: Text gathered for a segment, and text of a shard.
SEGMENT_BYTES = 8 << 20
SHARD_BYTES = 24 << 20
#: Distinct words a task keeps with their ids before it starts anew.
KEPT_WORDS = 800_000
MAGIC = b"RKT1"


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to a sum of 2**20, at least one each."""
    total = 1 << BITS
    if len(counts) > total:
        raise ValueError("more symbols than table slots")
    if not len(counts):
        return counts.astype(np.uint32)
    spare = total - len(counts)
    share = counts / counts.sum() * spare
    scaled = 1 + np.floor(share).astype(np.int64)
    left = total - int(scaled.sum())
    scaled[np.argsort(-(share - np.floor(share)), kind="stable")[:left]] += 1
    return scaled.astype(np.uint32)


def encode_block(symbols: np.ndarray, freq: np.ndarray, cum: np.ndarray) -> tuple[bytes, int]:
    """Payload of one block and its number of lanes. ``freq`` and ``cum`` are unsigned 64 bit."""
    n = len(symbols)
    lanes = max(1, min(LANES, n // 64))
    state = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = []
    for at in range((max(n - 1, 0) // lanes) * lanes, -1, -lanes):
        own = symbols[at : at + lanes]
        f, c = freq[own], cum[own]
        x = state[: len(own)]
        full = x >= f << np.uint64(63 - BITS)
        if full.any():
            words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            x = np.where(full, x >> np.uint64(32), x)
        q = x // f
        state[: len(own)] = (q << np.uint64(BITS)) + (x - q * f) + c
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
    return state.astype("<u8").tobytes() + stream.tobytes(), lanes


def decode_block(
    payload: bytes, n: int, lanes: int, slots: np.ndarray, freq: np.ndarray, cum: np.ndarray
) -> np.ndarray:
    state = np.frombuffer(payload, "<u8", lanes).astype(np.uint64)
    words = np.frombuffer(payload, "<u4", offset=8 * lanes).astype(np.uint64)
    out, read = np.empty(n, np.int64), 0
    mask = np.uint64((1 << BITS) - 1)
    for at in range(0, n, lanes):
        size = min(lanes, n - at)
        x = state[:size]
        slot = x & mask
        own = slots[slot.astype(np.int64)]
        out[at : at + size] = own
        x = freq[own] * (x >> np.uint64(BITS)) + slot - cum[own]
        low = np.flatnonzero(x < LOW)
        if len(low):
            x[low] = x[low] << np.uint64(32) | words[read : read + len(low)]
            read += len(low)
        state[:size] = x
    if read != len(words) or (state != LOW).any():
        raise ValueError("damaged token block")
    return out


def encode_segment(ids: np.ndarray) -> bytes:
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    number = np.zeros(len(counts), np.int32)
    number[symbols] = np.arange(len(symbols), dtype=np.int32)
    index = number[ids]
    small = frequencies(counts[symbols])
    freq = small.astype(np.uint64)
    cum = (np.cumsum(freq) - freq).astype(np.uint64)
    table = zlib.compress(symbols.astype("<u4").tobytes() + small.astype("<u4").tobytes(), 1)
    entries, payloads, place = [], [], 0
    for at in range(0, len(ids), BLOCK_TOKENS):
        own = index[at : at + BLOCK_TOKENS]
        payload, lanes = encode_block(own, freq, cum)
        raw = ids[at : at + BLOCK_TOKENS].astype("<u4").tobytes()
        entries.append(
            struct.pack(
                "<QQIIII", place, at, len(own), lanes, zlib.crc32(payload), zlib.crc32(raw)
            )
        )
        payloads.append(payload)
        place += len(payload)
    head = MAGIC + struct.pack("<III", len(symbols), len(entries), len(table))
    return b"".join([head, table, *entries, *payloads])


def decode_segment(data: bytes) -> np.ndarray:
    """Ids of a segment; raises where a checksum differs."""
    if data[:4] != MAGIC:
        raise ValueError("not a token segment")
    n, blocks, size = struct.unpack_from("<III", data, 4)
    table = np.frombuffer(zlib.decompress(data[16 : 16 + size]), "<u4")
    symbols, freq = table[:n], table[n:].astype(np.uint64)
    cum = np.cumsum(freq) - freq
    slots = np.repeat(np.arange(n, dtype=np.int64), table[n:].astype(np.int64))
    index, body = 16 + size, 16 + size + 32 * blocks
    entries = [struct.unpack_from("<QQIIII", data, index + 32 * k) for k in range(blocks)]
    out = np.zeros(sum(e[2] for e in entries), np.uint32)
    for k, (place, first, count, lanes, crc, crc_ids) in enumerate(entries):
        end = body + (entries[k + 1][0] if k + 1 < blocks else len(data) - body)
        payload = data[body + place : end]
        if zlib.crc32(payload) != crc:
            raise ValueError(f"damaged token block {k}")
        own = symbols[decode_block(payload, count, lanes, slots, freq, cum.astype(np.uint64))]
        if zlib.crc32(own.astype("<u4").tobytes()) != crc_ids:
            raise ValueError(f"wrong ids in token block {k}")
        out[first : first + count] = own
    return out


class _Numbers(dict):
    """Numbers of chunks in the order in which they are first met."""

    def __missing__(self, chunk: bytes) -> int:
        number = self[chunk] = len(self)
        return number


class _Words:
    """Ids of the chunks between white space that a worker has seen; when there are too many, of
    those seen again."""

    def __init__(self, path: str):
        self.path = path
        self.number = _Numbers()
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.seen, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32)

    @staticmethod
    def of_worker(path: str) -> "_Words":
        import tokenizers

        kept = tokenizers.__dict__.setdefault("_rekindle_words", {})
        return kept.setdefault(path, _Words(path))

    def forget(self) -> None:
        keep = self.seen > 1
        words = [w for w, k in self.number.items() if keep[k]]
        old = np.flatnonzero(keep)
        self.ids, lengths = ragged_take(self.starts, self.lengths, self.ids, old)
        self.number = _Numbers(zip(words, range(len(words)), strict=True))
        self.lengths, self.starts = lengths, np.cumsum(lengths) - lengths
        self.seen = np.ones(len(words), np.int64)

    def take(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and how many each text has. Null texts have none."""
        if len(self.number) > KEPT_WORDS:
            self.forget()
        first, of = len(self.number), self.number.__getitem__
        parts, counts = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts.cast(pa.binary())):
            chunks = (text.as_py() or b"").split()
            counts[k] = len(chunks)
            parts.append(np.fromiter(map(of, chunks), np.int32, len(chunks)))
        sequence = np.concatenate(parts)
        new = [w.decode() for w in islice(self.number, first, None)]
        ids, lengths = encode_chunks(self.path, new)
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(lengths) - lengths))
        self.lengths = np.concatenate((self.lengths, lengths))
        self.ids = np.concatenate((self.ids, ids))
        self.seen = np.concatenate((self.seen, np.zeros(len(new), np.int64)))
        self.seen += np.bincount(sequence, minlength=len(self.seen)) > 0
        out, each = ragged_take(self.starts, self.lengths, self.ids, sequence)
        ends = np.concatenate(([0], np.cumsum(each)))[np.cumsum(counts)]
        return out, np.diff(np.concatenate(([0], ends)))


def write_token_files(
    docs: DataFrame,
    path: str,
    out: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
) -> None:
    """Write ``docs`` in ascending id order as token files below ``out``."""
    slim = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.xxhash64(F.col(text_col)).alias("tie"),
    )
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    schema = T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField("segment", T.IntegerType()),
            T.StructField("first", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(docs.schema[id_col].dataType)),
            T.StructField("lengths", T.ArrayType(T.LongType())),
            T.StructField("data", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target, seen = to_arrow_schema(schema), _Words.of_worker(path)
        shard, segment, first = TaskContext.get().partitionId(), 0, 0

        def one(pending: list[pa.RecordBatch]) -> pa.RecordBatch:
            data = pa.Table.from_batches(pending).combine_chunks()
            found, each = seen.take(data["text"].chunk(0))
            ids = np.insert(found.astype(np.uint32), np.cumsum(each), end_id)
            lengths = each + 1
            row = {
                "shard": shard,
                "segment": segment,
                "first": first,
                "n_tokens": len(ids),
                "doc_ids": data["id"].to_pylist(),
                "lengths": lengths.tolist(),
                "data": encode_segment(ids),
            }
            return pa.RecordBatch.from_pylist([row], schema=target)

        pending, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                piece = batch.slice(at, 200)
                pending.append(piece)
                size += piece.nbytes
                if size >= SEGMENT_BYTES:
                    row = one(pending)
                    yield row
                    first, segment = first + row["n_tokens"][0].as_py(), segment + 1
                    pending, size = [], 0
        if pending:
            yield one(pending)

    (
        slim.repartitionByRange(shards, F.col("id").asc_nulls_first(), "tie")
        .sortWithinPartitions(F.col("id").asc_nulls_first(), "tie")
        .select("id", "text")
        .mapInArrow(run, schema)
        .write.parquet(out)
    )


def read_token_files(spark: SparkSession, out: str) -> DataFrame:
    """Per document: ``doc_id``, ``start`` (tokens of all documents before it) and ``ids``."""
    files = spark.read.parquet(out)
    # one row per shard
    sizes = files.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = sizes.select(
        "shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before")
    )
    schema = T.StructType(
        [
            T.StructField("doc_id", files.schema["doc_ids"].dataType.elementType),
            T.StructField("start", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k] for n in ("before", "first", "lengths", "data")}
                ids = decode_segment(row["data"].as_py())
                lengths = np.asarray(row["lengths"].as_py(), np.int64)
                ends = np.cumsum(lengths)
                if len(ids) != (ends[-1] if len(ends) else 0):
                    raise ValueError("document lengths do not match the tokens")
                raw = ids.astype("<u4").tobytes()
                cuts = [0, *(4 * ends).tolist()]
                names = batch.column("doc_ids").slice(k, 1).flatten()
                yield pa.RecordBatch.from_arrays(
                    [
                        names.cast(target.field(0).type),
                        pa.array(row["before"].as_py() + row["first"].as_py() + ends - lengths, pa.int64()),
                        pa.array([raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
                    ],
                    schema=target,
                )

    # segments are joined while they are still coded
    return (
        files.join(before, "shard")
        .select("before", "first", "doc_ids", "lengths", "data")
        .mapInArrow(run, schema)
    )

