from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from rekindle.catalog.features import feature_table
from rekindle.contracts import FEATURE_TABLE_COLUMNS
from rekindle.functions.scalars import boundary
from rekindle.plans import features
from rekindle.sources import views

SNAP = date(2024, 6, 1)
MIDNIGHT = datetime(2024, 6, 1)
EVENTS = (
    "user_id string, book_id string, event_ts timestamp_ntz, progress_pct double, "
    "session_minutes int, finished boolean"
)
BOOKS = "book_id string, genre string, format string"
USERS = (
    "user_id string, signup_date date, plan_type string, region string, device_type string, age_band string"
)
SUBS = "user_id string, start_date date, end_date date"


def event(user, when, book="b1", progress=0.5, minutes=10, finished=False):
    return (user, book, when, progress, minutes, finished)


@pytest.fixture
def build(frame):
    """Both feature plans over tiny tables; they must agree, the result is by user."""

    def run(events, books=(("b1", "A", "ebook"),), users=(), subs=(), **options):
        tables = (
            frame(list(users), USERS),
            frame(list(books), BOOKS),
            frame(events, EVENTS),
            frame(list(subs), SUBS),
        )
        one = {r.user_id: r for r in features.customer_features(*tables, SNAP, **options).collect()}
        chain = features.customer_features_by_joins(*tables, SNAP, **options).collect()
        assert one == {r.user_id: r for r in chain}
        return one

    return run


DAY = timedelta(days=1)


def test_boundaries_are_half_open(build):
    old = event("", MIDNIGHT - 100 * DAY)[1:]
    rows = build(
        [
            event("at_cutoff", MIDNIGHT - 30 * DAY),
            event("before_cutoff", MIDNIGHT - 30 * DAY - timedelta(seconds=1)),
            ("at_snapshot", *old),
            event("at_snapshot", MIDNIGHT),
            ("at_horizon", *old),
            event("at_horizon", MIDNIGHT + 30 * DAY),
            ("last_moment", *old),
            event("last_moment", MIDNIGHT + 30 * DAY - timedelta(seconds=1)),
            event("future_only", MIDNIGHT + DAY),
        ]
    )
    assert set(rows) == {"before_cutoff", "at_snapshot", "at_horizon", "last_moment"}
    labels = {u: r.will_reactivate for u, r in rows.items()}
    assert labels == {"before_cutoff": 0, "at_snapshot": 1, "at_horizon": 0, "last_moment": 1}
    # Events from the cut-off on are never features.
    assert rows["at_snapshot"].total_events == 1


def test_window_starts_are_inclusive(build):
    rows = build(
        [event("u", MIDNIGHT - d * DAY) for d in (90, 91, 180, 181)]
    )
    assert (rows["u"].events_last_90d, rows["u"].events_last_180d) == (1, 3)
    assert rows["u"].days_since_last_event == 90


def test_unmatched_book_counts_but_leaves_the_rates(build):
    when = MIDNIGHT - 60 * DAY
    rows = build(
        [event("u", when), event("u", when, "b2"), event("u", when, "gone"), event("v", when, "gone")],
        books=[("b1", "A", "ebook"), ("b2", "B", "audiobook")],
    )
    u, v = rows["u"], rows["v"]
    assert (u.total_events, u.distinct_books) == (3, 3)
    assert (u.pct_audiobook, u.pct_ebook) == (0.5, 0.5)
    assert (v.pct_audiobook, v.pct_ebook, v.top_genre) == (None, None, None)


def test_genre_tie_takes_the_smaller_name(build):
    when = MIDNIGHT - 60 * DAY
    books = [("b1", "B", "ebook"), ("b2", "A", "ebook"), ("b3", "C", "ebook")]
    rows = build([event("u", when, b) for b in ("b1", "b1", "b2", "b2", "b3")], books=books)
    assert rows["u"].top_genre == "A"


def test_genres_after_the_snapshot_do_not_count(build):
    books = [("b1", "B", "ebook"), ("b2", "A", "ebook")]
    events = [event("u", MIDNIGHT - 60 * DAY, "b1")] + [event("u", MIDNIGHT + DAY, "b2")] * 3
    row = build(events, books=books)["u"]
    assert (row.top_genre, row.distinct_books, row.total_events) == ("B", 1, 1)


def test_only_four_columns_are_filled(build):
    row = build([event("u", MIDNIGHT - 400 * DAY)])["u"]
    assert (row.events_last_90d, row.events_last_180d) == (0, 0)
    assert (row.had_subscription, row.subscription_canceled) == (False, False)
    assert (row.tenure_days, row.plan_type, row.region) == (None, None, None)


def test_null_measures_are_skipped_by_means(build):
    when = MIDNIGHT - 60 * DAY
    row = build(
        [event("u", when, progress=None, minutes=None, finished=None), event("u", when, progress=1.0, minutes=4, finished=True)]
    )["u"]
    assert (row.avg_progress_pct, row.avg_session_minutes, row.pct_finished) == (1.0, 4.0, 1.0)
    assert row.total_events == 2


def test_late_cancellation_leaks_only_by_default(build):
    events = [event("u", MIDNIGHT - 60 * DAY), event("v", MIDNIGHT - 60 * DAY)]
    subs = [("u", date(2024, 1, 1), date(2024, 7, 1)), ("v", date(2024, 6, 2), None)]
    loose = build(events, subs=subs)
    assert (loose["u"].subscription_canceled, loose["v"].had_subscription) == (True, True)
    strict = build(events, subs=subs, strict=True)
    assert (strict["u"].had_subscription, strict["u"].subscription_canceled) == (True, False)
    assert strict["v"].had_subscription is False


def test_strict_needs_a_snapshot(frame):
    with pytest.raises(ValueError):
        features.subscription_flags(frame([], SUBS), strict=True)


def test_empty_log_gives_no_rows(build):
    assert build([]) == {}


def _tables(spark, root):
    return [f(spark, root) for f in (views.users, views.books, views.reading_events, views.subscriptions)]


def _sorted(df):
    return sorted(map(tuple, df.collect()))


def test_row_order_and_partitioning_do_not_matter(spark, small):
    users, books, events, subs = _tables(spark, small)
    plain = features.customer_features(users, books, events, subs, views.SNAPSHOT)
    shuffled = events.repartition(13, "book_id").sortWithinPartitions(F.desc("session_minutes"))
    moved = features.customer_features(users, books, shuffled, subs, views.SNAPSHOT)
    keep = [c for c in FEATURE_TABLE_COLUMNS if c != "avg_progress_pct"]
    assert _sorted(plain.select(*keep)) == _sorted(moved.select(*keep))


def test_no_positives_past_the_data(spark, small):
    users, books, events, subs = _tables(spark, small)
    late = features.customer_features(users, books, events, subs, date(2030, 1, 1))
    assert late.count() == 150 and late.where("will_reactivate = 1").count() == 0


def test_events_after_the_snapshot_change_only_the_label(spark, small):
    users, books, events, subs = _tables(spark, small)
    cut = boundary(events, "event_ts", views.SNAPSHOT)
    spoiled = events.withColumns(
        {
            "session_minutes": F.when(F.col("event_ts") >= cut, 9999).otherwise(F.col("session_minutes")),
            "book_id": F.when(F.col("event_ts") >= cut, -1).otherwise(F.col("book_id")),
        }
    )
    a, b = (
        features.customer_features(users, books, e, subs, views.SNAPSHOT, strict=True).drop("will_reactivate")
        for e in (events, spoiled)
    )
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_class_balance_and_funnel(frame):
    table = frame([(1,), (0,), (0,)], "will_reactivate int")
    rows = {r.will_reactivate: (r.n, r.pct) for r in features.class_balance(table).collect()}
    assert rows == {0: (2, 66.67), 1: (1, 33.33)}
    users = frame([("u",), ("v",), ("w",)], "user_id string")
    events = frame(
        [event("u", MIDNIGHT - 40 * DAY), event("v", MIDNIGHT - DAY), event("x", MIDNIGHT)], EVENTS
    )
    assert tuple(features.cohort_funnel(users, events, SNAP).first()) == (3, 2, 1)


def test_filters_and_columns_reach_the_scan(spark, small):
    events = views.raw(spark, small, "orders").select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("event_ts")
    )
    plan = plan_of(features.eligible(events, views.SNAPSHOT))
    assert "LessThan(o_orderdate,2000-01-01" in plan
    assert "o_totalprice" not in plan


def test_event_log_is_scanned_once(spark, small):
    plan = plan_of(feature_table(spark, small))
    assert plan.count("lineitem.parquet") == 1
