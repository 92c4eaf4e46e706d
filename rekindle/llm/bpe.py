"""BPE through a distinct-word table: split, encode each distinct word once, join ids back.

1. ``split``: tasks cut texts at ASCII white space, and a word off its trailing marks, into
   words; the tokenizer never looks across such a cut. A block (about ``BLOCK_BYTES`` of text)
   keeps its documents as sequences of local word numbers, most frequent first, compressed.
2. The words of all blocks are grouped by a hash of the word, packed as arrays. A group encodes
   each of its distinct words once, whatever the number of blocks and texts that hold it.
3. The ids go back to the blocks by word number, and each position takes the ids of its word.

Decoding joins ids with the id-to-piece table, which has the size of the vocabulary and is
therefore sent to every task, and puts pieces together with the tokenizer's separator.

The tokenizer's normaliser lower-cases; ASCII letters are lowered before words are compared,
except in words that may hold special tokens (``<|``), which are matched in the raw text.
Null texts count as empty and have no ids. Repeated rows and ids stay rows of their own. Columns
other than id and text are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rekindle.llm.common import ragged_take, written

BLOCK_BYTES = 24 << 20
#: Text per hash group of the word table.
GROUP_BYTES = 16 << 20
#: Text that is cut into words at a time.
CUT_BYTES = 2 << 20
MARKS = ".,;:!?"
#: Before packed numbers of four bytes; compressed data never starts like this.
WIDE = b"\x04"


def tokenizer(path: str):
    """The library's tokenizer without truncation and padding; one per worker process.

    It is kept with the library, since functions that travel by value have globals of their own.
    """
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_rekindle_loaded", {})
    if path not in kept:
        kept[path] = tokenizers.Tokenizer.from_file(path)
        kept[path].no_truncation()
        kept[path].no_padding()
    return kept[path]


def _plain(word: str) -> bool:
    """Only letters that the tokenizer's normaliser leaves alone: one piece run for the model."""
    if word.isascii():
        return word.isalpha() and word.islower()
    return word.isalpha() and word == word.lower() and is_normalized("NFC", word)


def _byte_letters() -> str:
    """The letter that stands for each byte in byte-level vocabularies (a published scheme)."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(k if k in own else next(others)) for k in range(256))


def _reads_words(coder) -> bool:
    """Whether a plain word reaches the model as it is: lower-case letters, byte by byte."""
    steps = json.loads(coder.to_str())
    before = (steps["normalizer"] or {}).get("normalizers", [])
    cuts = (steps["pre_tokenizer"] or {}).get("pretokenizers", [])
    return [x["type"] for x in before] == ["NFC", "Replace", "Lowercase"] and [
        x["type"] for x in cuts
    ] == ["Split", "ByteLevel"]


def encode_words(path: str, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words on end, and how many each word has.

    Plain words need no normalising or cutting and go straight to the tokenizer's model.
    """
    coder, letters = tokenizer(path), _byte_letters()
    direct, model = _reads_words(coder), coder.model
    ids: list[int] = []
    lengths = np.zeros(len(words), np.int64)
    for k, word in enumerate(words):
        if direct and _plain(word):
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(letters)
            own = [token.id for token in model.tokenize(word)]
        else:
            own = coder.encode(word, add_special_tokens=False).ids
        ids += own
        lengths[k] = len(own)
    return np.array(ids, np.int32), lengths


def encode_chunks(path: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """As ``encode_words``, for chunks that may hold several words."""
    number: dict[str, int] = {}
    parts, count = [], np.zeros(len(texts), np.int64)
    for k, chunk in enumerate(texts):
        found = subwords(chunk)
        count[k] = len(found)
        for word in found:
            parts.append(number.setdefault(word, len(number)))
    ids, lengths = encode_words(path, list(number))
    found, each = ragged_take(np.cumsum(lengths) - lengths, lengths, ids, np.array(parts, np.int64))
    ends = np.concatenate(([0], np.cumsum(each)))
    bounds = np.concatenate(([0], np.cumsum(count)))
    return found, np.diff(ends[bounds])


def chunks(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Numbers of white-space separated chunks of all texts, the distinct chunks, chunks per text.

    Texts are cut some at a time: what Arrow holds meanwhile is many times their size.
    """
    number: dict[str, int] = {}
    index, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for at, size in _slices(sizes, CUT_BYTES):
        split = pc.ascii_split_whitespace(pc.fill_null(texts.slice(at, size), "").cast(pa.large_string()))
        counts.append(pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64))
        coded = split.flatten().dictionary_encode()
        own = coded.dictionary.to_pylist()
        numbers = np.fromiter((number.setdefault(w, len(number)) for w in own), np.int32, len(own))
        index.append(numbers[coded.indices.to_numpy()])
        del split, coded, own
    pa.default_memory_pool().release_unused()
    return np.concatenate(index), list(number), np.concatenate(counts)


def subwords(chunk: str) -> list[str]:
    """A chunk as words: marks at its end are cut off a letter or digit before them.

    Letters of the Latin blocks are lowered here so that fewer words differ; the tokenizer
    lowers the others itself.
    """
    if not chunk or "<|" in chunk:
        return [chunk] if chunk else []
    if chunk.isascii() or (max(chunk) < "\u0250" and "\u0130" not in chunk):
        chunk = chunk.lower()
    stem = chunk.rstrip(MARKS)
    if len(stem) < len(chunk) and stem and stem[-1].isalnum():
        return [stem, chunk[len(stem) :]]
    return [chunk]


def words_of(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Word numbers of all texts on end, the distinct words by falling frequency, words per text."""
    index, distinct, counts = chunks(texts)
    number: dict[str, int] = {}
    starts, lengths, parts = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64), []
    for k, chunk in enumerate(distinct):
        found = subwords(chunk)
        starts[k], lengths[k] = len(parts), len(found)
        for word in found:
            parts.append(number.setdefault(word, len(number)))
    sequence, each = ragged_take(starts, lengths, np.asarray(parts, np.int32), index)
    ends = np.concatenate(([0], np.cumsum(each)))
    bounds = np.concatenate(([0], np.cumsum(counts)))
    per_text = ends[bounds[1:]] - ends[bounds[:-1]]
    frequency = np.bincount(sequence, minlength=len(number))
    order = np.argsort(-frequency, kind="stable")
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    words = list(number)
    return rank[sequence], [words[k] for k in order], per_text


def pack(values: np.ndarray) -> bytes:
    """Numbers below 2**32 as compressed byte planes: three, or four after a mark where one needs it."""
    most = int(values.max()) if len(values) else 0
    if most >= 1 << 32:
        raise ValueError(f"{most} does not fit in four bytes")
    wide = most >= 1 << 24
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : 4 if wide else 3].T
    packed = zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())
    return WIDE + packed if wide else packed


def unpack(data: bytes) -> np.ndarray:
    wide = data.startswith(WIDE)
    raw = zstandard.ZstdDecompressor().decompress(data[len(WIDE) :] if wide else data)
    planes = np.frombuffer(raw, np.uint8).reshape(4 if wide else 3, -1).astype(np.int64 if wide else np.int32)
    found = planes[0] | planes[1] << 8 | planes[2] << 16
    return found | planes[3] << 24 if wide else found


def _groups(words: list[str], groups: int) -> np.ndarray:
    joined = (zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words)
    return np.fromiter(joined, np.uint32, len(words)) % groups


def _split(docs: DataFrame, groups: int) -> DataFrame:
    """Block rows (``part`` -1: documents) and word rows (``part``: hash group) of all texts."""
    id_type = docs.schema["id"].dataType
    schema = T.StructType(
        [
            T.StructField("block", T.StringType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("counts", T.BinaryType()),
            T.StructField("sequence", T.BinaryType()),
            T.StructField("words", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)

        def block(pending: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            data = pa.Table.from_batches(pending).combine_chunks()
            texts = data["text"].chunk(0)
            sequence, words, counts = words_of(texts)
            name = uuid.uuid4().hex
            rows = [
                {
                    "block": name,
                    "part": -1,
                    "ids": data["id"].to_pylist(),
                    "counts": pack(counts),
                    "sequence": pack(sequence),
                }
            ]
            squeeze = zstandard.ZstdCompressor(level=6)
            part = _groups(words, groups)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(groups + 1))
            for g in np.flatnonzero(np.diff(cuts)):
                own = order[cuts[g] : cuts[g + 1]]
                rows.append(
                    {
                        "block": name,
                        "part": int(g),
                        # rising numbers: their steps are small
                        "sequence": pack(np.diff(own, prepend=0)),
                        "words": squeeze.compress("\n".join([words[k] for k in own]).encode()),
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=target)

        pending, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                piece = batch.slice(at, 500)
                pending.append(piece)
                size += piece.get_total_buffer_size() * piece.num_rows // max(1, batch.num_rows)
                if size >= BLOCK_BYTES:
                    yield from block(pending)
                    pending, size = [], 0
        if pending:
            yield from block(pending)

    return docs.mapInArrow(run, schema)


def _encode_group(path: str):
    """Encodes each distinct word of a hash group once; ids go back to every block that has it."""

    def run(group: pa.Table) -> pa.Table:
        read = zstandard.ZstdDecompressor()
        lists = [read.decompress(w).decode().split("\n") for w in group["words"].to_pylist()]
        number: dict[str, int] = {}
        codes = [np.fromiter((number.setdefault(w, len(number)) for w in x), np.int64, len(x)) for x in lists]
        ids, lengths = encode_words(path, list(number))
        starts = np.cumsum(lengths) - lengths
        back = [ragged_take(starts, lengths, ids, c) for c in codes]
        return pa.table(
            {
                "block": group["block"],
                "numbers": group["sequence"],
                "ids": pa.array([pack(x) for x, _ in back], pa.binary()),
                "lengths": pa.array([pack(n) for _, n in back], pa.binary()),
            }
        )

    return run


def _spell(ids: np.ndarray, counts: np.ndarray, table: pa.Array) -> list[pa.Array]:
    """Texts of documents of ``counts`` ids: each id joined to its piece, pieces put together."""
    out, done = [pa.array([], pa.string())], 0
    for at, size in _slices(counts, 500_000):
        ends = np.concatenate(([0], np.cumsum(counts[at : at + size])))
        own = table.take(pa.array(ids[done : done + ends[-1]]))
        out.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), own), " "))
        done += int(ends[-1])
    return out


def _join_back(names):
    """Ids of a block's documents; also their texts where ``names`` holds the pieces."""

    def run(block: pa.Table, table: pa.Table) -> pa.Table:
        def read(name: str) -> list[np.ndarray]:
            return [np.zeros(0, np.int32), *(unpack(x) for x in table[name].to_pylist())]

        number = np.concatenate([np.cumsum(x) for x in read("numbers")])
        length = np.concatenate(read("lengths")).astype(np.int64)
        ids = np.concatenate(read("ids"))
        starts, lengths = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        starts[number], lengths[number] = np.cumsum(length) - length, length
        pieces = pa.array(names.value, pa.string()) if names else None
        out: dict[str, list] = {"id": [], "ids": [], "decoded": []}
        for k in range(block.num_rows):
            counts = unpack(block["counts"][k].as_py())
            found, each = ragged_take(starts, lengths, ids, unpack(block["sequence"][k].as_py()))
            ends = np.concatenate(([0], np.cumsum(each)))[np.concatenate(([0], np.cumsum(counts)))]
            data = np.ascontiguousarray(found, "<i4")
            buffers = [None, pa.array(ends * 4, pa.int32()).buffers()[1], pa.py_buffer(data)]
            out["ids"].append(pa.Array.from_buffers(pa.binary(), len(counts), buffers))
            own = block["ids"].slice(k, 1).combine_chunks()
            out["id"].append((own.chunk(0) if isinstance(own, pa.ChunkedArray) else own).flatten())
            if names:
                out["decoded"] += _spell(found, np.diff(ends), pieces)
        columns = {"id": pa.chunked_array(out["id"]), "ids": pa.chunked_array(out["ids"], pa.binary())}
        if names:
            columns["decoded"] = pa.chunked_array(out["decoded"], pa.string())
        pa.default_memory_pool().release_unused()
        return pa.table(columns)

    return run


def encode(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    groups: int | None = None,
    decoded: bool = False,
) -> DataFrame:
    """Id and ``ids``: the token ids as little-endian unsigned 32-bit numbers.

    With ``decoded`` also the text that the ids stand for, as ``decode`` adds it, made by the
    task that has the ids at hand.

    ``groups`` is the number of hash groups of the word table; by default it follows from the
    size of all texts.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    groups = groups or _group_count(slim)
    rows = written(_split(slim, groups), "bpe-blocks")
    blocks = rows.filter("part < 0").select("block", "ids", "counts", "sequence")
    table = (
        rows.filter("part >= 0")
        .select("block", "part", "sequence", "words")
        .groupBy("part")
        .applyInArrow(_encode_group(path), "block string, numbers binary, ids binary, lengths binary")
    )
    fields = [T.StructField("id", docs.schema[id_col].dataType), T.StructField("ids", T.BinaryType())]
    if decoded:
        fields.append(T.StructField("decoded", T.StringType()))
    names = _shared_pieces(docs.sparkSession, path) if decoded else None
    return (
        blocks.groupBy("block")
        .cogroup(table.groupBy("block"))
        .applyInArrow(_join_back(names), T.StructType(fields))
        .withColumnRenamed("id", id_col)
    )


def _group_count(slim: DataFrame) -> int:
    """From the size of all texts: distinct words grow more slowly than text."""
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(8, -(-size // GROUP_BYTES))


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The id-to-piece table ``(token, piece)``, special tokens included."""
    found = tokenizer(path)
    rows = sorted((k, p) for p, k in found.get_vocab(with_added_tokens=True).items())
    return spark.createDataFrame(rows, "token int, piece string")


def _slices(counts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs ``(start, length)`` of rows whose counts add up to ``most``, or of one row."""
    start, total = 0, 0
    for k, n in enumerate(counts.tolist()):
        if total and total + n > most:
            yield start, k - start
            start, total = k, 0
        total += n
    if start < len(counts):
        yield start, len(counts) - start


def _shared_pieces(spark: SparkSession, path: str):
    """The pieces by id, sent to every task: as many as the vocabulary has."""
    if json.loads(tokenizer(path).to_str()).get("decoder"):
        raise ValueError("only tokenizers without a decoder: pieces joined by a space")
    rows = pieces(spark, path).orderBy("token").collect()
    names: list[str | None] = [None] * (rows[-1]["token"] + 1)
    for row in rows:
        names[row["token"]] = row["piece"]
    return spark.sparkContext.broadcast(names)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the text of each ``ids``, special tokens kept, as the library's ``decode`` gives it."""
    shared = _shared_pieces(encoded.sparkSession, path)
    schema = T.StructType([*encoded.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(shared.value, pa.string())
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids_col))
            counts = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False) // 4
            ids = np.frombuffer(b"".join(x or b"" for x in column.to_pylist()), "<u4")
            text = pa.chunked_array(_spell(ids, counts, table), pa.string()).combine_chunks()
            text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*batch.schema.names, out])

    return encoded.mapInArrow(run, schema)


def tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``ids`` and the ``decoded`` text, the number of ids and digests of both."""

    def sha(value: Column) -> Column:
        return F.sha2(value, 256)

    return encode(docs, path, id_col, text_col, decoded=True).select(
        id_col,
        "ids",
        "decoded",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        sha(F.col("ids")).alias("ids_sha256"),
        sha(F.col("decoded").cast("binary")).alias("decoded_sha256"),
    )


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the number of ids and digests of ids and decoded text."""
    return tokens(docs, path, id_col, text_col).drop("ids", "decoded")
