"""WARC archives with revisits: equal payloads are stored once.

Only headers (payload digest and page id) are shuffled by digest: of the records of one digest
that with the largest id is the response. The verdict is joined back to the pages by id, and
every page becomes one WARC/1.1 record with fresh headers: a response with its payload, or a
revisit that names the response. Records are written as gzipped archives by Spark's text writer,
whose line separator is the end of a WARC record, and archives are read back as whole files.

Null html is an empty payload. Rows equal in id and payload are the same capture and judged alike.
If all ids of a digest are null, all its records are responses; else a null id revisits. Line
breaks in a url are percent-encoded. Columns other than id, url and html are ignored.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BREAK = "\r\n"
#: Records per archive: an archive is read back by one task.
ARCHIVE_RECORDS = 2_000


def base32(hex_digest: Column) -> Column:
    """Base 32 (RFC 4648) of a SHA-1 in hex: 20 bits at a time."""
    parts = [
        F.lpad(F.conv(F.substring(hex_digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)
    ]
    return F.translate(
        F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def verdicts(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` of (id, url, payload) with ``digest`` and, for revisits, ``refers_to`` and its url."""
    marked = pages.withColumn("digest", base32(F.sha1(F.col("payload").cast("binary"))))
    heads = marked.select("id", "url", "digest", F.octet_length("payload").alias("size"))
    largest = (
        heads.filter(F.col("size") >= least_bytes)
        .groupBy("digest")
        .agg(F.max(F.struct("id", "url")).alias("top"), F.count("*").alias("n"))
        .filter((F.col("n") > 1) & F.col("top.id").isNotNull())
        .select("digest", F.col("top.id").alias("refers_to"), F.col("top.url").alias("refers_url"))
    )
    revisits = (
        heads.select("id", "digest")
        .join(largest, "digest")
        .filter(~F.col("id").eqNullSafe(F.col("refers_to")))
        .select(F.col("id").alias("id2"), F.col("digest").alias("d2"), "refers_to", "refers_url")
        .distinct()
    )
    return marked.join(
        revisits, F.col("id").eqNullSafe(F.col("id2")) & (F.col("digest") == F.col("d2")), "left"
    ).drop("id2", "d2")


def record(date: str = DATE) -> Column:
    """The WARC record of a row of ``verdicts``, without the line breaks that end it."""

    def clean(url: Column) -> Column:
        return F.replace(F.replace(F.coalesce(url, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))

    def name(id_: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(id_.cast("string"), F.lit("null")), F.lit(">"))

    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(BREAK * 2),
    )
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    fields = [
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", name(F.col("id"))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", clean(F.col("url"))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("Content-Type", F.lit("application/http;msgtype=response")),
        ("Content-Length", F.octet_length(block).cast("string")),
    ]
    only = [
        ("WARC-Profile", F.lit(PROFILE)),
        ("WARC-Refers-To", name(F.col("refers_to"))),
        ("WARC-Refers-To-Target-URI", clean(F.col("refers_url"))),
        ("WARC-Refers-To-Date", F.lit(date)),
    ]

    def lines(pairs: list[tuple[str, Column]]) -> Column:
        return F.concat(*[F.concat(F.lit(f"{k}: "), v, F.lit(BREAK)) for k, v in pairs])

    return F.concat(
        F.lit(f"WARC/1.1{BREAK}"),
        lines(fields),
        F.when(revisit, lines(only)).otherwise(""),
        F.lit(BREAK),
        block,
    )


def write_archives(
    pages: DataFrame,
    out: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
    date: str = DATE,
) -> None:
    slim = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("payload"),
    )
    (
        verdicts(slim, least_bytes)
        .select(record(date).alias("value"))
        .write.option("lineSep", BREAK * 2)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", ARCHIVE_RECORDS)
        .text(out)
    )


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of one archive."""
    raw = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        head = raw[at:end].decode("utf-8").split(BREAK)
        if head[0] != "WARC/1.1":
            raise ValueError("not a WARC record")
        fields = dict(line.split(": ", 1) for line in head[1:])
        start = end + 4
        at = start + int(fields["Content-Length"])
        if raw[at : at + 4] != b"\r\n\r\n":
            raise ValueError("a WARC record does not end where it says")
        yield fields, raw[start:at]
        at += 4


RECORD_COLUMNS = (
    "page string, type string, url string, date string, payload_digest string, refers string, "
    "http string, payload binary, payload_bytes long"
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record: header fields, the http head and the stored payload (null for revisits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in RECORD_COLUMNS.split(", ")]
        types = [pa.string()] * 7 + [pa.binary(), pa.int64()]
        schema = pa.schema(list(zip(names, types, strict=True)))
        for batch in batches:
            for data in batch.column("content"):
                rows = []
                for fields, block in parse_archive(data.as_py()):
                    cut = block.index(b"\r\n\r\n") + 4
                    http = block[:cut].decode("ascii")
                    length = int(http.split("Content-Length: ")[1].split(BREAK)[0])
                    stored = fields["WARC-Type"] == "response"
                    rows.append(
                        {
                            "page": fields["WARC-Record-ID"][len("<urn:page:") : -1],
                            "type": fields["WARC-Type"],
                            "url": fields["WARC-Target-URI"],
                            "date": fields["WARC-Date"],
                            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                            "refers": fields.get("WARC-Refers-To", "<urn:page:>")[len("<urn:page:") : -1] or None,
                            "http": http,
                            "payload": block[cut:] if stored else None,
                            "payload_bytes": length,
                        }
                    )
                    if stored and len(block) - cut != length:
                        raise ValueError("a payload is not as long as its http head says")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, RECORD_COLUMNS)
