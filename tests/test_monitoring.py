from __future__ import annotations

import json
import math
import os
import random
from datetime import date

import pytest
from conftest import plan_of

from rekindle.functions import payload_json
from rekindle.plans import monitoring, sketches
from rekindle.session import scratch_path

LOG = (
    "request_id string, request_date date, status_code int, execution_duration_ms long, "
    "request string, response string"
)
DAY = date(2024, 1, 1)


def split(columns, *rows):
    return json.dumps({"dataframe_split": {"columns": columns, "data": list(rows)}})


def row(request="{}", response='{"predictions":[0.5]}', status=200, ms=10, day=DAY):
    return ("r", day, status, ms, request, response)


def test_null_status_is_neither_ok_nor_error(frame):
    log = frame([row(), row(status=500), row(status=None)], LOG)
    assert tuple(monitoring.usage(log).first()) == (DAY, 3, 1, 1)


def test_latency_keeps_null_groups(frame):
    log = frame([row(ms=m) for m in (1, 2, 3, 4)] + [row(status=None, ms=7), row(status=500, ms=None)], LOG)
    for exact in (True, False):
        rows = {r.status_code: r for r in monitoring.latency(log, exact).collect()}
        assert rows[200].max_ms == 4 and rows[None].p95_ms == 7
        assert (rows[500].n, rows[500].p50_ms, rows[500].max_ms) == (1, None, None)
    assert {r.status_code: r.p50_ms for r in monitoring.latency(log, True).collect()}[200] == 2.5


def test_split_column_survives_malformed_requests(frame):
    log = frame(
        [
            row(split(["a", "b"], [1, 2.5], [3, None], [4])),
            row(split(["b"], ["zz"], ["7"])),
            row(split(["a"], [1])),
            row('{"inputs":[[1,2]]}'),
            row("not json"),
            row(None),
            row(split(["b"], [99]), status=500),
        ],
        LOG,
    )
    values = sorted(r.b for r in payload_json.split_column(log, "b").collect())
    assert values == [2.5, 7.0]
    everything = payload_json.split_all_columns(log).groupBy("column_name").count().collect()
    assert {r.column_name: r["count"] for r in everything} == {"a": 4, "b": 2}
    counts = monitoring.unparsed(log, "b").first()
    assert tuple(counts) == (6, 3, 1)


def test_every_request_has_one_reason(frame):
    """All shapes a request may have; reasons add up to the log, and only named shapes give values."""
    records, instances = '{"dataframe_records":[%s]}', '{"instances":[%s]}'
    cases = [
        ("used", split(["b"], [1], [2]), 2), ("used", split(["a", "b"], [1, "x"], [1, 5], [1]), 1),
        ("used", records % '{"a":1,"b":3},{"b":null}', 1), ("used", instances % '{"b":"4"}', 1),
        ("short_row", split(["a", "b"], [1]), 0), ("not_a_number", split(["b"], ["zz"], [None], [True]), 0),
        ("missing_column", split(["a"], [1]), 0), ("missing_column", records % '{"a":1}', 0), ("no_rows", split(["b"]), 0),
        ("no_names", '{"inputs":[[1]]}', 0), ("no_names", instances % "[1]", 0), ("no_names", '{"instances":[{"b":1},2]}', 0),
        ("other_shape", '{"b":1}', 0), ("other_shape", "[1]", 0), ("other_shape", '{"dataframe_split":{"columns":["b"]}}', 0),
        ("other_shape", "7", 0), ("broken", '{"dataframe_split":', 0), ("broken", "", 0), ("no_request", None, 0),
    ]
    rows = [(f"{k}", *row(request=text)[1:]) for k, (_, text, _) in enumerate(cases)]
    rows += [("bad", *row(split(["b"], [1]), status=500)[1:]), ("unknown", *row(split(["b"], [1]), status=None)[1:])]
    log = frame(rows, LOG)
    found = {r.request_id: (r.reason, r["values"]) for r in payload_json.decided(log, "b", ["request_id"]).collect()}
    assert found == {f"{k}": (reason, n) for k, (reason, _, n) in enumerate(cases)} | {"bad": ("not_ok", 0), "unknown": ("not_ok", 0)}
    reasons = monitoring.unparsed_reasons(log, "b").collect()
    assert sum(r.requests for r in reasons) == log.count() and {r.reason for r in reasons} == set(payload_json.REASONS)
    values = payload_json.split_column(log, "b", ["request_id"]).groupBy("request_id").count().collect()
    assert {r.request_id: r["count"] for r in values} == {f"{k}": n for k, (_, _, n) in enumerate(cases) if n}
    every = payload_json.split_all_columns(log).where("column_name = 'b'").count()
    assert every == sum(n for _, _, n in cases)
    assert monitoring.unparsed_reasons(log.limit(0), "b").collect() == []


def test_predictions_of_several_rows(frame):
    log = frame([row(response='{"predictions":[0.1,0.104,0.9]}'), row(response=None), row(response="x")], LOG)
    assert payload_json.predictions(log).count() == 3
    histogram = {r.prediction_bucket: r["count"] for r in monitoring.prediction_histogram(log).collect()}
    assert histogram == {0.1: 2, 0.9: 1}


def test_empty_log(frame):
    log = frame([], LOG)
    assert monitoring.usage(log).count() == 0 and monitoring.latency(log, True).count() == 0
    for exact in (True, False):
        stats = monitoring.prediction_stats(log, exact).first()
        assert (stats.n, stats["mean"], stats.p50) == (0, None, None)
    train = frame([(1.0,), (2.0,)], "b double")
    report = {r.statistic: r for r in monitoring.drift(train, log, "b", exact=True).collect()}
    assert report["mean"].train == 1.5 and report["mean"].production is None
    assert report["mean"].drifted is None


def test_drift_flags_and_zero_base(frame):
    log = frame([row(split(["b", "c"], [12, 0.0], [12, 1.0]))], LOG)
    train = frame([(10.0, 0.0), (10.0, 0.0)], "b double, c double")
    rows = {
        (r.feature, r.statistic): r for r in monitoring.drift_all(train, log, ["b", "c"], exact=True).collect()
    }
    assert rows["b", "mean"].rel_diff == pytest.approx(0.2)
    assert rows["b", "mean"].drifted is False  # exactly 20 % is not above it
    assert rows["c", "mean"].rel_diff is None and rows["c", "mean"].drifted is None
    assert rows["b", "n"].rel_diff is None
    one = {r.statistic: r for r in monitoring.drift(train, log, "b", exact=True).collect()}
    assert all(one[s] == rows["b", s] for s in one)


def test_drift_needs_the_training_column(frame):
    with pytest.raises(ValueError, match="not in the training table"):
        monitoring.drift(frame([(1.0,)], "a double"), frame([], LOG), "b")


def test_requests_round_trip_through_json(frame):
    table = frame([("x\"y", 1, 2.5, True, None)], "s string, i int, d double, t boolean, z string")
    text = table.select(payload_json.split_encode(table.columns).alias("j")).first().j
    assert json.loads(text) == {
        "dataframe_split": {"columns": ["s", "i", "d", "t", "z"], "data": [['x"y', 1, 2.5, True, None]]}
    }


def test_windows_are_merges_of_stored_days(spark, frame):
    """Any window from stored days equals one pass within the rank error; a day replaced leaves the others."""
    rng = random.Random(6)
    days = [date(2024, 1, d) for d in range(1, 8)]
    rows = [(split(["a"], [1e12 + rng.gauss(0, 3)], [None]), f'{{"predictions":[{rng.random()}]}}', d) for d in days for _ in range(700)]
    log = frame([row(request=r, response=p, day=d) for r, p, d in rows], LOG)
    path = scratch_path(spark, "sketches")
    sketches.store_days(log, path, k=200)
    files = {d: sorted(os.listdir(f"{path}/request_date={d}")) for d in days}
    sketches.store_days(log.where("request_date = '2024-01-03'"), path, k=200)
    after = {d: sorted(os.listdir(f"{path}/request_date={d}")) for d in days}
    assert [d.day for d in days if files[d] != after[d]] == [3]
    stored = sketches.stored(spark, path, "2024-01-02", "2024-01-05")
    assert "PartitionFilters: [isnotnull(request_date" in plan_of(stored)
    found = {r.feature: r for r in sketches.window_report(stored, 200).collect()}
    window = [x for x in rows if 2 <= x[2].day <= 5]
    for name, values in (
        ("a", [json.loads(r)["dataframe_split"]["data"][0][0] for r, _, _ in window]),
        ("prediction", [json.loads(p)["predictions"][0] for _, p, _ in window]),
    ):
        got, values = found[name], sorted(values)
        middle = sum(v - values[0] for v in values) / len(values)
        assert got.n == len(values) and (got["min"], got["max"]) == (values[0], values[-1])
        assert got["mean"] - values[0] == pytest.approx(middle, abs=1e-3)
        spread = math.sqrt(sum((v - values[0] - middle) ** 2 for v in values) / (len(values) - 1))
        assert got.stddev == pytest.approx(spread, rel=1e-3)
        for q, value in ((0.5, got.p50), (0.95, got.p95)):
            assert abs(sum(v <= value for v in values) / len(values) - q) < 0.03
    train = frame([(1e12,), (2e12,)], "a double")
    report = {r.statistic: r for r in sketches.drift(train, ["a"], stored, k=200).collect()}
    assert report["mean"].drifted is True and report["n"].rel_diff is None
    empty = sketches.window_report(sketches.stored(spark, path, "2025-01-01"))
    assert empty.collect() == []
