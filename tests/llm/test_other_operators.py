"""Mixing, chat windows, search, token files, archives and the pipeline on small tables."""

from __future__ import annotations

import base64
import hashlib
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rekindle.llm import ann, bpe, chat, mixing, quality, token_files, warc
from rekindle.llm.queries import QUERIES, tokenizer_path
from rekindle.llm.common import written
from rekindle.session import scratch_dir, scratch_path

SMALL = "/root/testdata/sf0.001"


def _water(sizes, share=1.5, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    target = {s: share * sum(sizes.values()) * weight[s] / sum(weight.values()) for s in names}
    while over := [s for s in names if target[s] > 2 * sizes[s] + 1e-9]:
        excess = sum(target[s] - 2 * sizes[s] for s in over)
        for s in over:
            target[s] = 2 * sizes[s]
        free = [s for s in names if target[s] < 2 * sizes[s] - 1e-9]
        for s in free:
            target[s] += excess * weight[s] / sum(weight[x] for x in free)
    return target


def _mix(frame):
    rows = mixing.mix_plan(frame).collect()
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        assert 0 <= r.copies <= 2
        size[r.source] += r.size
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
    assert all(r.source_size == size[r.source] for r in rows)
    return rows, size, taken, target


def test_mix_targets_and_words(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows, size, taken, target = _mix(docs)
    expected = _water(size)
    for s in size:
        assert target[s] == pytest.approx(expected[s])
        assert abs(taken[s] - target[s]) <= 0.05 * target[s] + 5
    again = mixing.mix_plan(docs.repartition(3)).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    made = mixing.mixed(docs)
    assert made.columns == docs.columns
    copies = Counter(r.doc_id for r in made.collect())
    assert copies == Counter({r.doc_id: r.copies for r in rows if r.copies})


def test_mix_repeats_nulls_and_ties(spark):
    rows = [(1, "a b c d", "s", 1)] * 2500 + [(2, None, None, 1), (3, "", "t", 1), (4, "x y", None, 1), (None, "q", "u", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    found, size, taken, target = _mix(frame)
    assert len(found) == len(rows)
    assert target == pytest.approx(_water(size))
    assert abs(taken["s"] - target["s"]) <= 4 and taken["t"] == 0
    assert mixing.mixed(frame).filter("doc_id = 1").count() == taken["s"] // 4
    assert mixing.mix_plan(frame.limit(0)).count() == 0


def test_chat_round_trip(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [
        (-7, 0, "user", said), (-7, 1, "assistant", said),
        (1, 0, "a\nb\\\x1f", None), (1, 1, None, "\\ \\[INST] <|im_end|>\n<|im_start|>user\nhi"), (1, None, "system", "first"),
        (2, 0, "system", "s t"), *[(2, k, ("user", "assistant")[k % 2], f"t{k} " * 9) for k in range(1, 40)],
        (3, 0, "assistant", "long " * 3000), (3, 1, "user", "z"), (3, 1, "user", "z"), (3, 1, "assistant", "z"),
        (None, 0, "assistant", "q"), (4, 0, "system", "only"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    talks = defaultdict(list)
    for c, turn, role, text in rows:
        talks[c].append((-1 if turn is None else turn, role or "", text or ""))
    for budget in (20, 60, 1024):
        windows = chat.format_windows(frame, budget=budget).collect()
        found = {r.conv_id: r for r in chat.read_windows(spark.createDataFrame(windows, chat.WINDOW.format(kind="bigint"))).collect()}
        assert set(found) == set(talks)
        for c, turns in talks.items():
            turns = sorted(turns)
            whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
            learned = "".join(t for _, r, t in turns if r == "assistant")
            r = found[c]
            assert r.n_turns == len(turns) and r.loss_chars == len(learned)
            assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
            assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
            assert r.formatted_chars == sum(len(w.text) for w in windows if w.conv_id == c)
    for w in chat.format_windows(frame, budget=60).filter("conv_id = 2").collect():
        turns = chat.parse(w.text)
        assert turns[0][:2] == ("system", "s t") and 60 >= sum(4 + len(t.split()) for _, t, *_ in turns)
        assert w.repeated == (0 if w.window == 0 else 3)
    assert chat.format_windows(frame.limit(0)).count() == 0


def _exact(rows, k=10):
    ids = np.array([i for i, _ in rows])
    points = np.array([v for _, v in rows], np.float64)
    out = {}
    for i, v in rows:
        score = np.sqrt(((points - np.array(v)) ** 2).sum(axis=1))
        order = np.lexsort((ids, score))
        out[i] = [(int(ids[j]), score[j]) for j in order if ids[j] != i][:k]
    return out


def test_search_recall(spark):
    data = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    expected = _exact([(r.vec_id, r.embedding) for r in data.collect()])
    found = ann.nearest(data, F.col("id") % 100 == 0, width=300).collect()
    hits = sum(any(r.vec_id == i for i, _ in expected[r.query_id]) for r in found)
    assert hits / len(found) >= 0.9 and len(found) == 10 * len({r.query_id for r in found})


def test_search_width_follows_the_table(spark):
    """Two trees of the least width see under half of the table; recall must hold all the same."""
    rng = np.random.default_rng(5)
    points = rng.standard_normal((8000, 64))
    points /= np.linalg.norm(points, axis=1)[:, None]
    points[:1000] = points[0] + 1e-5 * rng.standard_normal((1000, 64))
    data = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    found = defaultdict(set)
    for r in ann.nearest(data, F.col("id") % 80 == 0, trees=2).collect():
        found[r.query_id].add(r.vec_id)
    hits = 0
    for q in range(0, 8000, 80):
        far = ((points - points[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        hits += len(found[q] & set(np.argsort(far)[:10].tolist()))
    assert hits >= 0.9 * 10 * 100


def test_equal_strings_lie_differently_in_each_tree(spark):
    index = spark.createDataFrame([(i, [1.0, 1.0 + 1e-12 * i]) for i in range(40)], "entry long, vec array<double>")
    array = ann.forest(index, trees=2)
    same = defaultdict(list)
    for r in array.orderBy("rank").collect():
        same[r.tree, r.key].append(r.entry)
    large = [set(map(tuple, (x, sorted(x)))) for x in same.values() if len(x) > 10]
    assert large and all(len(x) == 2 for x in large)


def test_trees_ascend_together_by_prefix(spark):
    """Depths and ranges against a walk over all strings."""
    rng = np.random.default_rng(9)
    points = np.vstack([rng.standard_normal((150, 8)), np.ones((1, 8)) + 1e-9 * rng.standard_normal((60, 8))])
    index = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "entry long, vec array<double>")
    array = written(ann.forest(index, trees=3), "ann-forest")
    rows = array.collect()
    reach, enough = 25, 40
    queries = index.filter("entry % 7 = 0").select("entry")
    up = {(r.query, r.tree): r for r in ann.ascended(ann.descents(array, queries, reach), enough).collect()}
    assert len(up) == 3 * queries.count()
    for q in range(0, 210, 7):
        near = []
        for own in [r for r in rows if r.entry == q]:
            for r in rows:
                if r.tree == own.tree and r.entry != q and abs(r.rank - own.rank) <= reach:
                    near.append((r.tree, 63 - (r.key ^ own.key).bit_length(), r.rank < own.rank))
        depth = max((d for d in range(64) if sum(x >= d for _, x, _ in near) >= enough), default=0)
        for tree in range(3):
            inside = [before for k, x, before in near if k == tree and x >= depth]
            r = up[q, tree]
            assert (r.depth, r.before, r.after) == (depth, sum(inside), len(inside) - sum(inside))


def test_search_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.integers(-3, 4, 4)]) for k in range(300)]
    rows = [(k, v) for k, v in rows if any(v)] + [(k, [1.0, 1.0, 1.0, 1.0]) for k in range(1000, 1400)]
    bad = [(2000, None), (2100, [0.0] * 4), (2200, [1.0, None, 1.0, 1.0]), (2300, [float("nan")] * 4), (2400, [float("inf")] * 4), (2500, [1.0])]
    frame = spark.createDataFrame([(*r, 1) for r in rows + bad], "vec_id long, embedding array<float>, rank int")
    expected = _exact(rows)
    found = defaultdict(list)
    for r in sorted(ann.nearest(frame, F.col("id") % 100 == 0).collect(), key=lambda r: (r.query_id, r["rank"])):
        found[r.query_id].append((r.vec_id, r.score))
    assert set(found) == {k for k, _ in rows if k % 100 == 0}
    for q, hits in found.items():
        assert [i for i, _ in hits] == [i for i, _ in expected[q]]
        assert [s for _, s in hits] == pytest.approx([s for _, s in expected[q]])
    few = ann.nearest(frame.filter("vec_id in (1000, 1001, 2000)"), F.col("id") % 100 == 0).collect()
    assert [tuple(r) for r in few] == [(1000, 1, 1001, 0.0)]
    assert ann.nearest(frame.limit(0), F.col("id") % 100 == 0).count() == 0


@pytest.mark.parametrize("n", [0, 1, 63, 5000, 300_000])
def test_token_segment_round_trip(n):
    ids = np.random.default_rng(n).zipf(1.3, n).clip(0, 49_000).astype(np.uint32)
    data = token_files.encode_segment(ids)
    assert (token_files.decode_segment(data) == ids).all()
    if n > 1000:
        damaged = data[:-40] + bytes([data[-40] ^ 1]) + data[-39:]
        with pytest.raises(ValueError, match="damaged"):
            token_files.decode_segment(damaged)
        assert len(data) < 4 * n


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_BYTES", 20_000)
    monkeypatch.setattr(token_files, "SHARD_BYTES", 100_000)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-2, None), (-1, ""), (5, "again"), (5, "again")], "doc_id long, text string")
    every = docs.unionByName(odd)
    out = scratch_path(spark, "tokens")
    token_files.write_token_files(every, tokenizer_path(), out)
    found = sorted((r.doc_id, r.start, bytes(r.ids)) for r in token_files.read_token_files(spark, out).collect())
    coder, start = bpe.tokenizer(tokenizer_path()), 0
    texts = defaultdict(list)
    for r in every.collect():
        ids = [*coder.encode(r.text or "", add_special_tokens=False).ids, 2]
        texts[r.doc_id].append(np.array(ids, "<u4").tobytes())
    assert len(found) == every.count()
    for doc, at, data in found:
        assert at == start and data in texts[doc]
        texts[doc].remove(data)
        start += len(data) // 4
    assert not any(texts.values())
    assert zlib.crc32(found[0][2]) == zlib.crc32(np.array([2], "<u4").tobytes())
    empty = scratch_path(spark, "tokens")
    token_files.write_token_files(docs.limit(0), tokenizer_path(), empty)
    assert token_files.read_token_files(spark, empty).count() == 0


def test_archives(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 7)
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    odd = [(-1, "u\r\nx", None), (-2, None, ""), (-3, "a", "x\r\n\r\nWARC/1.1\r\n é"), (-4, "b", "x\r\n\r\nWARC/1.1\r\n é"),
           (-5, "c", "twin"), (-5, "c", "twin"), (None, "d", "twin"), (None, "e", "alone")]
    every = pages.select("page_id", "url", "html").unionByName(
        spark.createDataFrame(odd, "page_id long, url string, html string")
    )
    out = scratch_path(spark, "archives")
    warc.write_archives(every, out)
    rows = [(r.page_id, (r.html or "").encode()) for r in every.collect()]
    last = {}
    for page, html in rows:
        if page is not None:
            last[html] = max(last.get(html, page), page)
    expected = Counter()
    for page, html in rows:
        own = last.get(html, page) == page
        digest = base64.b32encode(hashlib.sha1(html).digest()).decode()
        expected["null" if page is None else str(page), len(html), digest, "response" if own else "revisit", None if own else str(last[html]), html if own else None] += 1
    found = warc.read_archives(spark, out).collect()
    assert Counter((r.page, r.payload_bytes, r.payload_digest, r.type, r.refers, r.payload and bytes(r.payload) if r.type == "revisit" else bytes(r.payload)) for r in found) == expected
    out = scratch_path(spark, "archives")
    warc.write_archives(every, out, least_bytes=10**6)
    assert {r.type for r in warc.read_archives(spark, out).collect()} == {"response"}


def test_archives_empty(spark):
    out = scratch_path(spark, "archives")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), out)
    assert warc.read_archives(spark, out).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        before, docs = docs, written(stage(spark, docs, SMALL), "stage")
        assert docs.columns == columns
        gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in docs.collect()}
        if k == 1:
            # well made documents stay unless the base rules reject them
            judged = {r.doc_id for r in quality.assess(before).filter("base_failed").collect()}
            assert all(labels[i].quality == 0 for i in gone - judged if i in labels)
    total = corpus_pipeline.run(spark, SMALL)
    assert total.count() == docs.count() and set(total.columns) >= {"doc_id", "n_tokens"}


def test_pipeline_leaves_only_its_result(spark, tmp_path):
    """Null texts, extra columns and an empty table go through; nothing else stays in the scratch folder."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("copies", F.lit("x"))
    odd = docs.limit(3).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(None).cast("long"))
    for name, made in (("full", docs.unionByName(odd)), ("empty", docs.limit(0))):
        made.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.read.parquet(f"{SMALL}/labels.parquet").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        before = set(os.listdir(scratch_dir(spark)))
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        left = set(os.listdir(scratch_dir(spark))) - before
        assert left == {os.path.basename(out.written_to)}
        assert (out.count() > 0) == (name == "full")


def test_stages_remove_what_the_stage_before_left(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[2:4]:
        before = list(corpus_pipeline._left)
        made = stage(spark, docs, SMALL)
        assert not set(before) & set(corpus_pipeline._left)
        # a plan that still reads the stage's tables keeps them
        corpus_pipeline.STAGES[1][1](spark, made, SMALL)
        docs = written(made, "stage")
        assert docs.count() > 0


def test_pipeline_ends_in_tokens(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(20)
    out = corpus_pipeline.encode_tokens(spark, docs, SMALL).collect()
    texts, coder = {r.doc_id: r.text or "" for r in docs.collect()}, bpe.tokenizer(tokenizer_path())
    for r in out:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == coder.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.decoded == coder.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(r.ids).hexdigest()


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
