"""Registered queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rekindle.llm import (
    ann,
    blocked_search,
    bpe,
    chat,
    lm,
    mixing,
    ngram_join,
    periodic_runs,
    quality,
    simhash,
    token_files,
    toxicity,
    warc,
)
from rekindle.llm.common import table, written
from rekindle.session import scratch_path

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Path of a public tokenizer file installed on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_simhash(spark: SparkSession, root: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, root, "documents")).select(
        "doc_id", "fingerprint", "component_id"
    )


def op2_quality(spark: SparkSession, root: str) -> DataFrame:
    return quality.assess(table(spark, root, "documents")).drop("n_stop_words", "n_lines", "broken")


def op3_toxicity(spark: SparkSession, root: str) -> DataFrame:
    return toxicity.assess(table(spark, root, "documents"), table(spark, root, "labels"))


def op4_chat(spark: SparkSession, root: str) -> DataFrame:
    given = table(spark, root, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    windows = written(chat.format_windows(given.unionByName(extra)), "chat-windows")
    return chat.read_windows(windows)


def op5_hash_forest(spark: SparkSession, root: str) -> DataFrame:
    return ann.nearest(table(spark, root, "embeddings"), F.col("id") % 100 == 0)


def op6_lm_scoring(spark: SparkSession, root: str) -> DataFrame:
    return lm.score(table(spark, root, "documents"))


def op7_bpe(spark: SparkSession, root: str) -> DataFrame:
    return bpe.digests(table(spark, root, "documents"), tokenizer_path())


def op8_mixing(spark: SparkSession, root: str) -> DataFrame:
    return mixing.mix_plan(table(spark, root, "documents")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "source",
        "copies",
    )


def op9_token_files(spark: SparkSession, root: str) -> DataFrame:
    out = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, root, "documents"), tokenizer_path(), out)
    return token_files.read_token_files(spark, out).select(
        "doc_id",
        "start",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op10_warc(spark: SparkSession, root: str) -> DataFrame:
    out = scratch_path(spark, "archives")
    warc.write_archives(table(spark, root, "pages"), out)
    return warc.read_archives(spark, out).select(
        F.expr("try_cast(page as bigint)").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.expr("try_cast(refers as bigint)").alias("refers_to"),
    )


def op11_ngram_join(spark: SparkSession, root: str) -> DataFrame:
    return ngram_join.join(table(spark, root, "documents"))


def op12_blocked_search(spark: SparkSession, root: str) -> DataFrame:
    return blocked_search.search(table(spark, root, "documents"), table(spark, root, "benchmark"))


@F.pandas_udf(StringType())
def _with_repeats(texts: pd.Series, draws: pd.Series) -> pd.Series:
    """Texts whose words repeat from some place on with some period; null texts stay."""

    def one(text: str | None, g: int) -> str | None:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        if not words:
            return text
        n = len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        tail = (words[a : a + p] * (-(-(n - a) // p)))[: n - a]
        return b" ".join(words[:a] + tail).decode("utf-8", "surrogatepass")

    return pd.Series([None if g is None or g != g else one(t, int(g)) for t, g in zip(texts, draws, strict=True)], dtype=object)


def op13_periodic_runs(spark: SparkSession, root: str) -> DataFrame:
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = h % 10 == 0
    repeated = _with_repeats(F.when(chosen, F.col("text")), F.when(chosen, F.floor(h / 10)))
    docs = table(spark, root, "documents").select("doc_id", F.when(chosen, repeated).otherwise(F.col("text")).alias("text"))
    line = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    return periodic_runs.runs(docs).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "leading.start",
        "leading.length",
        "leading.period",
        F.expr("1000 * leading.length div leading.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_quality,
        op3_toxicity,
        op4_chat,
        op5_hash_forest,
        op6_lm_scoring,
        op7_bpe,
        op8_mixing,
        op9_token_files,
        op10_warc,
        op11_ngram_join,
        op12_blocked_search,
        op13_periodic_runs,
    )
}

_WORD = "[^\\x20\\x09-\\x0D]+"
_TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

ORACLES: dict[str, str] = {
    "op2_quality": rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
-- every 3-word window with its place
win AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT doc_id, words, unnest(range(1, greatest(1, len(words) - 1))) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM win) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) t(k) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w),
dup AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n FROM lines
  WHERE regexp_matches(line, '[^ 	-
]') GROUP BY doc_id),
stop AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, lower(unnest(words)) AS word FROM w)
  WHERE regexp_matches(word, '^({'|'.join(sorted(set(quality.STOP_WORDS.split())))})([.,;:!?].*)?$') GROUP BY doc_id),
m AS (SELECT w.doc_id, len(words) AS n_words, len(array_to_string(words, '')) AS word_chars,
  len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
  coalesce(n_lines, 0) AS n_lines, coalesce(covered.n, 0) AS n_repeat_words, coalesce(stop.n, 0) AS n_stop
  FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN stop USING (doc_id)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND word_chars >= 2.0 * n_words AND word_chars <= 12.0 * n_words AND n_symbols <= 0.1 * n_words
  AND n_stop >= 0.03 * n_words AND n_dup_lines <= 0.6 * n_lines AS kept FROM j""",
    "op10_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, h, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes,
  -- base 32, five hex digits being four letters
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(x, 5 * (i // 4)::INTEGER + 1, 5))::INTEGER
    >> (15 - 5 * (i % 4))::INTEGER) & 31))::INTEGER, 1) FOR i IN range(0, 32)], '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to FROM d""",
    # Exact search: on a few hundred vectors the forest returns every one as a candidate.
    "op5_hash_forest": """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
d AS (SELECT q.vec_id AS query_id, c.vec_id, 
    sqrt(list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(q.v, c.v)])) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d) WHERE rank <= 10""",
    "op11_ngram_join": rf"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS num, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS words FROM documents),
s AS (SELECT DISTINCT num, array_to_string(words[i:i + 3], ' ') AS shingle
  FROM (SELECT num, words, unnest(range(1, 1 + greatest(1, len(words) - 3))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT num, count(*) AS n FROM s GROUP BY num),
o AS (SELECT a.num AS a, b.num AS b, count(*) AS overlap FROM s a JOIN s b ON a.shingle = b.shingle AND a.num < b.num GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.num = a JOIN n y ON y.num = b WHERE 185 * overlap >= 85 * (x.n + y.n)),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT DISTINCT a AS num, a AS other FROM both_ways UNION
  SELECT reach.num, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a),
named AS (SELECT reach.num, min(w.doc_id) AS component_id FROM reach JOIN w ON w.num = reach.other GROUP BY reach.num)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, CASE WHEN named.num IS NULL THEN w.doc_id ELSE component_id END AS component_id
FROM w LEFT JOIN n USING (num) LEFT JOIN named USING (num)""",
    "op12_blocked_search": rf"""
WITH t AS (SELECT num, doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term
  FROM (SELECT row_number() OVER () AS num, * FROM documents)),
tf AS (SELECT num, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
size AS (SELECT num, count(*) AS n FROM t GROUP BY num),
whole AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM size),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id,
  unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM (SELECT row_number() OVER () AS item, * FROM benchmark)) GROUP BY ALL),
w AS (SELECT item, item_id, term, times * floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
  FROM q JOIN df USING (term), whole),
m AS (SELECT num, 25 + (75 * n * docs) // words AS m FROM size, whole),
scored AS (SELECT item, item_id, num, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM w JOIN tf USING (term) JOIN m USING (num) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
