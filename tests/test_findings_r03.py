"""Queries against their SQL on small tables shaped like the larger ones of the review."""

from __future__ import annotations

import compare
import pytest
from rekindle.catalog import basics, features, models, monitoring, streams, synthetic  # noqa: F401
from rekindle.catalog.registry import ORACLES, QUERIES


def agrees(spark, root: str, name: str) -> None:
    differences = compare.differences(
        QUERIES[name](spark, root).toArrow(),
        compare.oracle_table(compare.connect(root), ORACLES[name]),
    )
    assert not differences, differences


@pytest.fixture
def folder(spark, tmp_path):
    def write(name: str, rows, schema: str) -> str:
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write


def test_format_id_cuts_long_keys_like_lpad(spark, folder):
    # At 1 GB the customer keys reach six digits, one more than the book id's width.
    root = folder("customer", [(7,), (99999,), (123456,), (1234567,), (-5,)], "c_custkey long")
    agrees(spark, root, "fn_format_id")


@pytest.mark.parametrize("name", ["gen_clipped_normal", "gen_gamma_sessions"])
def test_uniforms_hash_like_the_sql_where_a_word_is_all_ones(spark, folder, name):
    # For draw u1 of order 1688368 a Murmur3 word is 0xFFFFFFFF, which the SQL rotates to 0.
    root = folder("lineitem", [(1688368, 5), (1688368, 6), (1, 1)], "l_orderkey long, l_linenumber int")
    agrees(spark, root, name)


def test_rates_round_like_the_sql_round_of_a_double(spark, frame):
    # 0.5046875 * 10^6 is 504687.49999999994, which the SQL rounds down and F.round up.
    import duckdb
    from rekindle.functions.scalars import sql_round

    values = [0.5046875, 0.5421875, -0.5046875, 2.5, -2.5, 0.4999999999999999, 1e300, 123.4564999]
    got = [r[0] for r in frame([(v,) for v in values], "x double").select(sql_round("x", 6)).collect()]
    want = [duckdb.sql(f"SELECT ROUND({v!r}::DOUBLE, 6)").fetchall()[0][0] for v in values]
    assert got == want


def test_drift_report_rounds_like_the_sql_round_of_a_double(spark, frame):
    # the drift reports rounded with F.round, which gives 0.504688 where the SQL's ROUND gives 0.504687.
    import duckdb
    from rekindle.catalog.monitoring import drift_rounded

    values = [0.5046875, 0.5421875, -0.5046875, 0.4828125, 2.5, None, 123.4564999]
    report = frame([(v, v, v) for v in values], "train double, production double, rel_diff double")
    got = [tuple(r) for r in drift_rounded(report).collect()]
    want = [
        duckdb.sql(f"SELECT ROUND({v!r}::DOUBLE, 6), ROUND({v!r}::DOUBLE, 6), ROUND({v!r}::DOUBLE, 6)").fetchall()[0]
        if v is not None
        else (None, None, None)
        for v in values
    ]
    assert got == want


def test_simhash_pairs_spare_the_comparisons_they_connect(spark, monkeypatch):
    # the star of another filter links the first copy with both others; the pair of the two
    # others, which the n-gram bounds find as well, then needs no comparing.
    from rekindle.llm import ngram_join, simhash

    base = [f"w{k}" for k in range(100)]
    texts = [" ".join(base[:k] + [f"x{k}"] + base[k + 1 :]) for k in (10, 50, 90)]
    slim = spark.createDataFrame(list(enumerate(texts, 1)), "id long, text string")
    _, nodes, common = ngram_join.described(slim, 5, 22, prints=True)
    (hub, n_hub), *others = sorted((r.num, r.n) for r in nodes.collect())
    star = spark.createDataFrame([(hub, n_hub, num, n) for num, n in others], "num_a long, n_a long, num_b long, n_b long")
    compared, multiplied = [], ngram_join._multiplied

    def counting(pairs, matrix, percent):
        compared.append(pairs.count())
        return multiplied(pairs, matrix, percent)

    monkeypatch.setattr(ngram_join, "_multiplied", counting)

    def linked(candidates):
        compared.clear()
        found = ngram_join.links(slim, nodes, common, 5, 80, 22, candidates)
        return sum(compared), sorted(tuple(r) for r in simhash.components(found).collect())

    alone, groups = linked(None)
    helped, helped_groups = linked(star)
    assert alone == 3 and helped_groups == groups and {root for _, root in groups} == {hub}
    assert helped == 2
