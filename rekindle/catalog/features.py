"""The point-in-time feature pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rekindle.catalog.registry import query, rounded
from rekindle.catalog.sql import on_features, using
from rekindle.contracts import LABEL
from rekindle.operators import aggregates
from rekindle.plans import clustered, features
from rekindle.session import scratch_path
from rekindle.sources import views
from rekindle.sources.tables import own_name
from rekindle.sources.views import SNAPSHOT

RATES = ("avg_session_minutes", "avg_progress_pct", "pct_finished", "pct_audiobook", "pct_ebook")
_ROUND = ", ".join(f"ROUND({c}, 10) AS {c}" for c in RATES)


def feature_table(spark: SparkSession, root: str) -> DataFrame:
    return features.customer_features(
        views.users(spark, root),
        views.books(spark, root),
        views.reading_events(spark, root),
        views.subscriptions(spark, root),
        SNAPSHOT,
    )


@query(using("reading_events eligible", "SELECT user_id FROM eligible"))
def feat_eligible(spark: SparkSession, root: str) -> DataFrame:
    return features.eligible(views.reading_events(spark, root), SNAPSHOT)


@query(using("reading_events eligible labels_", "SELECT * FROM labels_"))
def feat_label(spark: SparkSession, root: str) -> DataFrame:
    events = views.reading_events(spark, root)
    return features.label(events, features.eligible(events, SNAPSHOT), SNAPSHOT)


@query(using("users reading_events eligible", """SELECT (SELECT COUNT(*) FROM users) AS total_users,
(SELECT COUNT(DISTINCT user_id) FROM reading_events WHERE event_ts < TIMESTAMP '2000-01-01') AS with_history,
(SELECT COUNT(*) FROM eligible) AS eligible"""))
def feat_cohort_funnel(spark: SparkSession, root: str) -> DataFrame:
    return features.cohort_funnel(
        views.users(spark, root), views.reading_events(spark, root), SNAPSHOT
    )


@query(using("books reading_events activity", f"SELECT * REPLACE ({_ROUND}) FROM activity"))
def feat_activity(spark: SparkSession, root: str) -> DataFrame:
    activity = features.activity(
        views.reading_events(spark, root), views.books(spark, root), SNAPSHOT
    )
    return rounded(activity, *RATES)


@query(using("books reading_events genres", "SELECT * FROM genres"))
def feat_top_genre(spark: SparkSession, root: str) -> DataFrame:
    return features.top_genre(views.reading_events(spark, root), views.books(spark, root), SNAPSHOT)


@query(using("reading_events windows_", "SELECT * FROM windows_"))
def feat_recent_windows(spark: SparkSession, root: str) -> DataFrame:
    return features.recent_windows(views.reading_events(spark, root), SNAPSHOT)


@query(using("users demographics", "SELECT * FROM demographics"))
def feat_demographics(spark: SparkSession, root: str) -> DataFrame:
    return features.demographics(views.users(spark, root), SNAPSHOT)


@query(using("subscriptions subs_flags", "SELECT * FROM subs_flags"))
def feat_subscription(spark: SparkSession, root: str) -> DataFrame:
    return features.subscription_flags(views.subscriptions(spark, root))


@query(using("subscriptions", """SELECT user_id, TRUE AS had_subscription,
bool_or(end_date IS NOT NULL AND end_date < DATE '2000-01-01') AS subscription_canceled
FROM subscriptions WHERE start_date < DATE '2000-01-01' GROUP BY user_id"""))
def feat_subscription_strict(spark: SparkSession, root: str) -> DataFrame:
    return features.subscription_flags(views.subscriptions(spark, root), SNAPSHOT, strict=True)


@query(on_features(f"SELECT * REPLACE ({_ROUND}) FROM features"))
def feat_customer_features(spark: SparkSession, root: str) -> DataFrame:
    return rounded(feature_table(spark, root), *RATES)


@query(on_features(f"SELECT * REPLACE ({_ROUND}) FROM features"))
def feat_customer_features_by_joins(spark: SparkSession, root: str) -> DataFrame:
    table = features.customer_features_by_joins(
        views.users(spark, root),
        views.books(spark, root),
        views.reading_events(spark, root),
        views.subscriptions(spark, root),
        SNAPSHOT,
    )
    return rounded(table, *RATES)


@query(on_features(f"SELECT * REPLACE ({_ROUND}) FROM features"))
def feat_customer_features_clustered(spark: SparkSession, root: str) -> DataFrame:
    """The feature table from clustered inputs, without an exchange before its first grouping."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    users, events, subs = clustered.store_inputs(
        views.users(spark, root),
        views.reading_events(spark, root),
        views.subscriptions(spark, root),
        own_name("clustered"),
        scratch_path(spark, "clustered"),
        buckets,
    )
    table = features.customer_features(users, views.books(spark, root), events, subs, SNAPSHOT)
    return rounded(table, *RATES)


@query(on_features("SELECT will_reactivate, COUNT(*) AS n FROM features GROUP BY 1"))
def agg_label_counts(spark: SparkSession, root: str) -> DataFrame:
    events = views.reading_events(spark, root)
    labels = features.label(events, features.eligible(events, SNAPSHOT), SNAPSHOT)
    return aggregates.group_counts(labels, [LABEL]).orderBy(LABEL)


@query(on_features("""SELECT will_reactivate, COUNT(*) AS n,
ROUND(CAST(100.0 AS DOUBLE) * COUNT(*) / SUM(COUNT(*)) OVER (), 2) AS pct FROM features GROUP BY 1"""))
def feat_class_balance(spark: SparkSession, root: str) -> DataFrame:
    return features.class_balance(feature_table(spark, root)).orderBy(LABEL)
