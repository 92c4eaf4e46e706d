"""A corpus pipeline: toxicity, quality rules, near-duplicates, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the documents of the next. All but the last keep the columns they are given; the
last returns per document its id, its token ids (little-endian, 32 bits each) and the text they
stand for, with the number of ids and digests of both. Rules for nulls, empty texts, repeated rows and
empty tables are those of the operators. What a stage writes on the way is removed as soon as its
result is written.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rekindle.llm import bpe, common, mixing, near_copies, quality, toxicity
from rekindle.llm.common import table
from rekindle.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.tokens(docs, tokenizer_path())


#: Tables that stages left for their results to be computed from.
_left: list[str] = []


def _owned(stage: Stage) -> Stage:
    """The stage as owner of what it writes on the way.

    Its result is read from these tables until it is written itself, which has happened when the
    next stage is given its documents; then they go. Tables that those documents read stay.
    """

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles() if _left else []
        done = [p for p in _left if not any(p.rstrip("/") + "/" in f for f in read)]
        common.removed(spark, *done)
        _left[:] = [p for p in _left if p not in done]
        with common.noting() as made:
            out = stage(spark, docs, sf_dir)
        _left.extend(made)
        return out

    return run


STAGES = [
    ("toxicity", _owned(reject_toxic)),
    ("quality_rules", _owned(reject_low_quality)),
    ("simhash_near_dedup", _owned(drop_near_duplicates)),
    ("mixing", _owned(mix_sources)),
    ("bpe", _owned(encode_tokens)),
]

#: Learned weights and near-duplicate components are beyond SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; only the result's own table stays in the scratch folder."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            common.discarded(before)
        before = docs
    common.removed(spark, *_left)
    _left.clear()
    return docs
