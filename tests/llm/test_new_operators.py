"""N-gram join, blocked search and periodic runs against brute force on small tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from rekindle.llm import blocked_search, ngram_join, periodic_runs
from rekindle.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Columns with the names of results and helpers must not matter.
SCHEMA = "doc_id long, text string, n_shingles string, node double, score string, start string, num int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 0.5, "y", "z", 1) for i, t in rows], SCHEMA).repartition(3)


# --- n-gram join -------------------------------------------------------------------


def _components(rows, width=4, percent=85):
    sets = []
    for _, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set())
    root = list(range(len(rows)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return Counter((i, len(s), least.get(find(k))) for k, (i, s) in enumerate(zip([i for i, _ in rows], sets, strict=True)))


def _edited(words, edits, rng):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def _corpus(seed=3):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(160)]
    passage = " ".join(f"p{k}" for k in range(100))
    rows = [(1, None), (2, ""), (2, " \n\t"), (None, "a b"), (3, "A b"), (3, "A b"), (4, "a b c d e"), (None, None)]
    rows += [(100 + k, _edited(base, rng.randrange(9), rng)) for k in range(60)]
    rows += [(900 - k, " ".join(base)) for k in range(5)]
    rows += [(300 + k, passage + " " + " ".join(f"o{rng.randrange(10**6)}" for _ in range(60))) for k in range(50)]
    # chains: each text is near to the next one only
    chain = [f"c{k}" for k in range(120)]
    for k in range(30):
        rows.append((400 + k, " ".join(chain)))
        chain[(7 * k) % 120 : (7 * k) % 120 + 1] = [f"d{k}"]
    rows.append((500, "x " * 3000 + "y"))
    return rows


@pytest.mark.parametrize("crowded", [ngram_join.CROWDED, 3])
def test_ngram_components_against_all_pairs(spark, monkeypatch, crowded):
    monkeypatch.setattr(ngram_join, "CROWDED", crowded)
    monkeypatch.setattr(ngram_join, "MORE", 4)
    rows = _corpus()
    found = ngram_join.join(_frame(spark, rows), sketch_bits=12)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert Counter(map(tuple, found.collect())) == _components(rows)


def test_ngram_join_of_no_rows(spark):
    assert ngram_join.join(_frame(spark, [(1, "a")]).limit(0)).collect() == []
    only = ngram_join.join(_frame(spark, [(7, None), (8, "")])).collect()
    assert sorted(map(tuple, only)) == [(7, 0, 7), (8, 0, 8)]


def test_texts_that_share_a_passage_do_not_meet(spark, monkeypatch):
    """The pairs to multiply follow the texts, not the square of the group that shares a passage."""
    sizes = []
    whole = ngram_join._multiplied

    def counted(pairs, *rest):
        sizes.append(pairs.count())
        return whole(pairs, *rest)

    monkeypatch.setattr(ngram_join, "_multiplied", counted)
    passage = " ".join(f"p{k}" for k in range(100))
    for n in (200, 400):
        rng = random.Random(n)
        rows = [(k, passage + " " + " ".join(f"o{rng.randrange(10**9)}" for _ in range(60))) for k in range(n)]
        assert ngram_join.join(_frame(spark, rows)).filter("component_id <> doc_id").isEmpty()
    assert sum(sizes) < 600


# --- search ------------------------------------------------------------------------


def _ranked(docs, items, k=10):
    own = [Counter(TERM.findall((t or "").translate(LOWER))) for _, t in docs]
    documents, length = sum(map(bool, own)), sum(sum(c.values()) for c in own)
    frequency = Counter(t for c in own for t in c)
    out = []
    for item, text in items:
        asked, scores = Counter(TERM.findall((text or "").translate(LOWER))), []
        for (i, _), c in zip(docs, own, strict=True):
            m = 25 + (75 * sum(c.values()) * documents) // max(1, length)
            score = sum(
                times * math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency[t] + 1)))
                * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t, times in asked.items()
                if c[t]
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return Counter(out)


def _texts(n, rng):
    words = [f"Wört{k}" for k in range(40)] + [f"n{k}-x" for k in range(300)]
    return [" ".join(rng.choices(words, weights=[30] * 40 + [1] * 300, k=rng.randrange(1, 120))) for _ in range(n)]


@pytest.mark.parametrize("limits", [{}, {"SHARD": 64, "BLOCK": 4, "SHORT": 1, "DENSE_BYTES": 1, "ITEM_BYTES": 400, "FIRST": 1}])
def test_search_against_scoring_all(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(blocked_search, name, value)
    rng = random.Random(5)
    docs = list(enumerate(_texts(900, rng)))
    # equal scores, repeated and null ids, texts without terms, a long one
    docs += [(5, docs[5][1]), (None, docs[5][1]), (1000, docs[5][1]), (2000, None), (2001, ""), (2002, "- - !")]
    docs += [(3000, "long " * 20000 + "n7-x")]
    items = [(k, " ".join(rng.sample(docs, 1)[0][1].split()[:30]) if docs else "") for k in range(12) if k]
    items = [(k, t or "n1") for k, t in items if t is not None]
    items += [(20, None), (21, ""), (22, "unheard of"), (23, docs[5][1]), (23, docs[5][1]), (24, "n7 n7 LONG")]
    given = spark.createDataFrame([(i, t, 7, "q") for i, t in items], "item_id long, text string, rank int, doc_id string")
    found = blocked_search.search(_frame(spark, docs), given)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, found.collect())) == _ranked(docs, items)


def test_search_of_no_rows(spark):
    docs, items = _frame(spark, [(1, "a b")]), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert blocked_search.search(docs.limit(0), items).collect() == []
    assert blocked_search.search(docs, items.limit(0)).collect() == []
    assert [tuple(r)[:3] for r in blocked_search.search(docs, items).collect()] == [(1, 1, 1)]


def test_blocks_are_skipped_by_their_summaries(spark, monkeypatch):
    """A block whose summary stays below the bound is not among the candidates; no better row is lost."""
    monkeypatch.setattr(blocked_search, "BLOCK", 8)
    rng = random.Random(9)
    # texts of fifty subjects: those of one subject stand next to each other
    texts = [" ".join(f"s{k % 50}w{rng.randrange(20)}" for _ in range(rng.randrange(10, 60))) for k in range(2000)]
    slim = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    vocabulary = sorted({t for r in slim.collect() for t in blocked_search.terms(r.text.encode())})
    vectors = blocked_search._vectors(slim, vocabulary)
    order = vectors.repartition(1).sortWithinPartitions("place")
    row = blocked_search._index(order, len(vocabulary), 2000, 120000, 4096).collect()[0].asDict()
    shard = blocked_search.Shard(row, len(vocabulary))
    # an item of ten subjects, one of which weighs more: blocks of the others stay below the bound
    at = np.array([k for k, t in enumerate(vocabulary) if t.startswith(b"s1")])
    weights, spread = np.array([3 if vocabulary[k].startswith(b"s17w") else 1 for k in at]), np.zeros(len(vocabulary), np.int64)
    spread[at] = weights
    every = blocked_search._scores(np.arange(len(shard.ids)), shard.starts, shard.terms, shard.gains, spread)
    bound = int(np.sort(every)[-10])
    rows = shard.candidates(at, weights, bound)
    assert set(np.flatnonzero(every >= bound)) <= set(rows.tolist())
    assert len(rows) < 0.5 * np.count_nonzero(every)


# --- periodic runs -----------------------------------------------------------------


def _runs(words, least=24, times=3):
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            smaller = any(all(words[i + k] == words[i + k + p] for k in range(length - p)) for p in range(1, q))
            if length >= max(least, times * q) and not smaller:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rng = random.Random(1)
    for _ in range(1500):
        least, times = rng.choice([4, 6, 24]), rng.choice([2, 3])
        size, kinds, words = rng.choice([0, 5, 30, 90]), rng.choice([1, 2, 3, 5]), []
        while len(words) < size:
            part = [rng.randrange(kinds) for _ in range(rng.randrange(1, 6))]
            words += part * (rng.randrange(1, 9) if rng.random() < 0.5 else 1)
        expected = _runs(words, least, times)
        assert sorted(periodic_runs.squares_to_runs(words, least, times), key=lambda r: (r[0], r[2])) == expected
        assert periodic_runs.find_runs(words, least, times) == expected


def test_runs_of_long_and_far_repeats():
    fibonacci, before = "a", "b"
    while len(fibonacci) < 800:
        fibonacci, before = fibonacci + before, fibonacci
    assert periodic_runs.find_runs(list(fibonacci)) == _runs(list(fibonacci))
    passage = [f"w{k}" for k in range(400)]
    assert periodic_runs.find_runs(passage + ["x"] + passage) == []
    assert periodic_runs.find_runs(["w"] * 100_000) == [(0, 100_000, 1)]


def _expected(i, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(i).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
    runs = _runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
    digest = hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest()
    kept = " ".join(w for k, w in enumerate(words) if k not in dropped)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (i, len(runs), *top, digest, hashlib.sha256(kept.encode()).hexdigest())


def test_run_query_against_all_periods(spark, tmp_path):
    rng = random.Random(2)
    rows = [(k, " ".join(f"é{rng.randrange(50)}" for _ in range(rng.randrange(0, 150)))) for k in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "a " * 60 + "\x0b b"), (1002, "a " * 60), (1003, "a b\x85c " * 10 + "d " * 30)]
    rows += [(2000 + k, None if k % 2 else "same words here") for k in range(40)]
    _frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert found.columns == columns
    assert Counter(map(tuple, found.collect())) == Counter(_expected(i, t) for i, t in rows)
    assert any(r.n_runs for r in found.collect())


def test_runs_of_no_rows_and_null_ids(spark):
    assert periodic_runs.runs(_frame(spark, [(1, "a")]).limit(0)).collect() == []
    row = periodic_runs.runs(_frame(spark, [(None, "a " * 30 + "b")])).first()
    assert row.doc_id is None and row.collapsed == "a b" and row.n_words == 31 and row.leading.length == 30
