"""Quality rules, SimHash, toxicity, language model and BPE against brute force on small tables."""

from __future__ import annotations

import hashlib
import math
import re
import struct
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rekindle.llm import bpe, lm, near_copies, ngram_join, quality, simhash, toxicity
from rekindle.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = "The ship went out at dawn and nobody on the quay was there to see it leave for the north "
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "a b c d a b c x y z a b c"),
    (5, "one\none\n two\none\n\n"),
    (6, PROSE * 4),
    (7, PROSE * 3 + "It came back at night with # marks | and $ signs in the log of the day and"),
    (8, PROSE * 300),
    (9, "It's a TEST<|endoftext|>x <|ENDOFTEXT|> é é ΣΑΣ. ≠ a≠b 12.5,3. it's. \x85 q\x1fz"),
    (9, "It's a TEST<|endoftext|>x <|ENDOFTEXT|> é é ΣΑΣ. ≠ a≠b 12.5,3. it's. \x85 q\x1fz"),
    (10, "x " * 70),
]


@pytest.fixture(scope="module")
def docs(spark):
    # columns with the names of results and helpers must not matter
    rows = [(i, t, "n", 1.5) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, fingerprint double")


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def _quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i in range(len(words) - 2):
        if windows[words[i], words[i + 1], words[i + 2]] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, repeat = len(words), len(covered)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat,
        n < 50 or 100 * repeat > 50 * n,
    )


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_quality_counts(docs, given):
    every = docs.select("doc_id", "text").unionByName(given.select("doc_id", "text"))
    texts = [(r.doc_id, r.text) for r in every.collect()]
    found = quality.assess(every).select("doc_id", *COUNTS).collect()
    assert Counter(map(tuple, found)) == Counter((i, *_quality(t)) for i, t in texts)


def test_quality_verdicts(spark, docs):
    good, bad = PROSE + "with a lamp that he had to carry in his left hand for the rest of it as far as one can ", "x1 "
    frame = spark.createDataFrame(
        [(1, good + good[::-1]), (2, bad * 60), (3, good + "# | $ % " * 20), (4, None)], "doc_id long, text string"
    )
    kept = {r.doc_id: (r.kept, r.broken) for r in quality.assess(frame).collect()}
    assert kept[1][0] is True and kept[1][1] == []
    assert kept[2] == (False, ["few_repeats", "stop_words"])
    assert "symbols" in kept[3][1] and kept[4][0] is False
    assert quality.keep_good(frame).collect() == frame.filter("doc_id = 1").collect()
    assert quality.keep_good(docs).columns == docs.columns


def test_quality_filter_is_computed_once(given):
    plan = quality.keep_good(given)._jdf.queryExecution().optimizedPlan().toString()
    # the words, and the stop words inside regexp_count
    assert plan.count("regexp_extract_all") == 2 and "Python" not in plan


def _fingerprint(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    if not words:
        return 0
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash_against_all_pairs(docs, given):
    every = docs.select("doc_id", "text").unionByName(given.select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    prints = {r.doc_id: _fingerprint(r.text) for r in every.collect()}
    near = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    expected = _components(near, prints)
    found = simhash.near_duplicates(every).collect()
    assert len(found) == every.count()
    assert all(r.fingerprint == f"{prints[r.doc_id]:016x}" for r in found)
    assert all(r.component_id == expected[r.doc_id] for r in found)
    kept = [r.doc_id for r in simhash.keep_one(every).collect()]
    assert sorted(kept) == sorted(set(expected.values()))


def test_dense_ball_is_linked_without_pairs(spark, monkeypatch):
    """A ball of fingerprints goes through shared neighbours; both ways give the same components."""
    centre = 0x0123456789ABCDEF
    values = {centre, 5} | {centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(0, a, 3)}
    values |= {centre ^ 0xFFFF ^ (1 << a) for a in range(20)}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    fps = spark.createDataFrame(signed, "fp long")
    expected = _components(
        [(a[0], b[0]) for a, b in combinations(signed, 2) if ((a[0] ^ b[0]) & (2**64 - 1)).bit_count() <= 2],
        [v[0] for v in signed],
    )
    for crowded in (2, 32, 10**6):
        monkeypatch.setattr(simhash, "CROWDED", crowded)
        edges = simhash.links(fps)
        roots = {r.node: r.root for r in simhash.components(edges).collect()}
        assert {n: roots.get(n, n) for n in expected} == expected
        if crowded == 2:
            assert edges.count() < 40 * len(values)


def _shingle_groups(rows):
    """Smallest id of each group of texts with a Jaccard similarity of 0.8 on five-word shingles."""
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if 5 * both >= 4 * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return {top(i) for i in sets}


@pytest.mark.parametrize("crowded", [32, 2])
def test_near_copies_against_all_pairs(spark, monkeypatch, crowded):
    monkeypatch.setattr(ngram_join, "CROWDED", crowded)
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("n_chars < 20000").limit(500)
    rows = [(r.doc_id, r.text) for r in given.collect()]
    base = [f"w{k}" for k in range(100)]
    for k in range(60):  # each is near the first, not all near each other
        own = list(base)
        own[k] = f"x{k}"
        rows.append((10**6 + k, " ".join(own)))
    rows += [(2 * 10**6, None), (2 * 10**6 + 1, " "), (2 * 10**6 + 2, "one two")]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in near_copies.keep_one(made).collect()) == sorted(_shingle_groups(rows))


def test_near_copies_odd_rows(spark):
    """Empty tables, null and repeated ids, repeated rows, clashing names, rows that differ elsewhere."""
    same, other = "same text here and there", "another text of its own to keep"
    schema = "doc_id long, text string, id string, node int, n double, fp string, h int, num string"
    rows = [(None, same), (3, same), (3, other), (3, same), (None, None), (None, " "), (4, None), (5, other + " x")]
    frame = spark.createDataFrame([(i, t, "a", k, 0.5, "f", k, "z") for k, (i, t) in enumerate(rows)], schema)
    kept = near_copies.keep_one(frame)
    assert kept.columns == frame.columns and near_copies.keep_one(frame.limit(0)).collect() == []
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(3, other), (3, same), (4, None), (5, other + " x")]
    again = near_copies.keep_one(frame.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, kept.collect()))


def test_shared_passage_is_no_copy(spark):
    """2,000 different texts that share one passage all stay; a copy of each of some goes."""
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, passage + " " + " ".join(f"o{k}_{j}" for j in range(40))) for k in range(2000)]
    rows += [(10_000 + k, rows[k][1] + " end") for k in range(0, 2000, 100)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in near_copies.keep_one(frame).select("doc_id").collect()) == list(range(2000))


def test_toxicity_does_not_depend_on_the_order_of_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    one = toxicity.assess(docs, labels).collect()
    two = toxicity.assess(docs.repartition(7), labels.repartition(5, "quality")).collect()
    assert sorted(one) == sorted(two)


def test_simhash_odd_ids(spark):
    rows = [(None, "same text here"), (3, "same text here"), (3, "another text of its own"), (3, "same text here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter((r.doc_id, r.component_id) for r in simhash.near_duplicates(frame).collect())
    assert found == {(None, 3): 1, (3, 3): 3}
    assert sorted(r.text for r in simhash.keep_one(frame).collect()) == ["another text of its own", "same text here"]


def test_simhash_long_text_in_chunks(monkeypatch):
    text = " ".join(f"w{k * k % 977}" for k in range(5000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text) == whole == _fingerprint(text)


def test_grammar_patterns():
    grammar = toxicity.Grammar({"fool": 7.0, "clow*": 7.0})
    assert grammar.word("fool") == 7.0 and grammar.word("clowns") == 7.0 and grammar.word("foolish") == 0.0
    plain = grammar.score("A fool walks by")
    assert grammar.score("") == grammar.score(None) == pytest.approx(toxicity.PRIOR)
    assert plain > 0.7
    assert grammar.score("You are a fool") > plain
    assert grammar.score("He is not a fool") < grammar.score("He is a fool")
    assert grammar.score("They said fool") < plain
    # a negation in another clause does not count
    assert grammar.score("Not. fool") == plain
    assert grammar.score("fool. fool.") > plain
    assert [p for hits in grammar.matches("She never wrote fool") for p, _ in hits] == ["negated reported"]


def test_toxicity_held_out(spark):
    root = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{root}/{n}.parquet") for n in ("documents", "labels"))
    rows = toxicity.assess(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    toxic = [r for r in rows if r.toxic]
    # some labelled texts are scrambled and no longer hold what made them toxic
    assert right > 0.97 and sum(r.predicted for r in toxic) / len(toxic) > 0.85
    assert all(0.0 <= r.score <= 1.0 for r in rows)


def test_toxicity_without_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity.assess(docs, labels).collect()
    assert len(rows) == len(TEXTS) and all(r.predicted == 0 for r in rows)
    assert toxicity.keep_clean(docs, labels).columns == docs.columns
    empty = docs.limit(0)
    assert toxicity.assess(empty, labels).count() == 0


def _backoff(texts, order, alpha=lm.BACKOFF, least=lm.LEAST):
    words = [WORD.findall(t or "") for t in texts]
    counts = Counter(tuple(w[i : i + k]) for w in words for k in range(1, order + 1) for i in range(len(w) - k + 1))
    total = sum(map(len, words))

    def score(gram):
        if len(gram) == 1:
            return counts[gram] / total
        if counts[gram] >= least:
            return counts[gram] / counts[gram[:-1]]
        return alpha * score(gram[1:])

    return [
        (len(w), sum(math.log(score(tuple(w[max(0, i - order + 1) : i + 1]))) for i in range(len(w)))) for w in words
    ]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_stupid_backoff(docs, given, order, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 50_000)
    every = docs.select("doc_id", "text").unionByName(given.select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    rows = [(r.doc_id, r.text) for r in every.collect()]
    expected = sorted((i, *s) for (i, _), s in zip(rows, _backoff([t for _, t in rows], order), strict=True))
    found = sorted((r.doc_id, r.n_words, r.log_score) for r in lm.score(every, order=order).collect())
    assert [x[:2] for x in found] == [x[:2] for x in expected]
    assert [x[2] for x in found] == pytest.approx([x[2] for x in expected], rel=1e-9)


def test_lm_empty(docs):
    assert lm.score(docs.limit(0)).count() == 0


def test_bpe_matches_the_library(docs, given, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 60_000)
    every = docs.select("doc_id", "text").unionByName(given.select("doc_id", "text"))
    coder = bpe.tokenizer(tokenizer_path())
    expected = Counter()
    for r in every.collect():
        ids = coder.encode(r.text or "", add_special_tokens=False).ids
        text = coder.decode(ids, skip_special_tokens=False)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        expected[r.doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(map(tuple, bpe.digests(every, tokenizer_path()).collect())) == expected


def test_bpe_decode_alone(given):
    path = tokenizer_path()
    both = bpe.decode(bpe.encode(given, path, decoded=True), path, out="again")
    assert both.filter("decoded = again").count() == given.count()


@pytest.mark.parametrize("values", [[], [0, 5, 2**24 - 1], [1, 2**24, 2**31 + 7]])
def test_packed_numbers(values):
    assert bpe.unpack(bpe.pack(np.array(values, np.int64))).tolist() == values


def test_bpe_empty(docs):
    assert bpe.digests(docs.limit(0), tokenizer_path()).count() == 0
