"""Table contracts: column schemas, label windows and feature order."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import types as T

# They define what the label, the features and the drift flag mean.
RANDOM_SEED = 42
N_USERS = 10_000
N_EVENTS_TARGET = 500_000
INACTIVITY_WINDOW_DAYS = 30
PREDICTION_HORIZON_DAYS = 30
LOOKBACK_DAYS = (90, 180)
DRIFT_THRESHOLD = 0.20

KEY = "user_id"
LABEL = "will_reactivate"


def default_snapshot(today: date | None = None) -> date:
    """Latest cut-off whose whole label horizon has already been observed."""
    return (today or date.today()) - timedelta(days=INACTIVITY_WINDOW_DAYS)


def _schema(*cols: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, null) for n, t, null in cols])


USERS = _schema(
    ("user_id", T.StringType(), False),
    ("signup_date", T.DateType(), False),
    ("plan_type", T.StringType(), False),
    ("age_band", T.StringType(), False),
    ("region", T.StringType(), False),
    ("device_type", T.StringType(), False),
)

BOOKS = _schema(
    ("book_id", T.StringType(), False),
    ("title", T.StringType(), False),
    ("genre", T.StringType(), False),
    ("format", T.StringType(), False),
    ("length_minutes", T.IntegerType(), False),
    ("language", T.StringType(), False),
)

READING_EVENTS = _schema(
    ("user_id", T.StringType(), False),
    ("book_id", T.StringType(), False),
    ("event_ts", T.TimestampType(), False),
    ("progress_pct", T.DoubleType(), False),
    ("session_minutes", T.IntegerType(), False),
    ("finished", T.BooleanType(), False),
    ("rating", T.IntegerType(), True),
)

SUBSCRIPTIONS = _schema(
    ("user_id", T.StringType(), False),
    ("start_date", T.DateType(), False),
    ("end_date", T.DateType(), True),
    ("cancel_reason", T.StringType(), True),
)

PAYLOAD = _schema(
    ("request_id", T.StringType(), True),
    ("client_request_id", T.StringType(), True),
    ("request_date", T.DateType(), True),
    ("timestamp_ms", T.LongType(), True),
    ("status_code", T.IntegerType(), True),
    ("sampling_fraction", T.DoubleType(), True),
    ("execution_duration_ms", T.LongType(), True),
    ("request", T.StringType(), True),
    ("response", T.StringType(), True),
    ("request_metadata", T.MapType(T.StringType(), T.StringType()), True),
)

# Order of the feature table: key, label, then the features.
FEATURE_TABLE_COLUMNS = (
    KEY,
    LABEL,
    "tenure_days",
    "plan_type",
    "region",
    "device_type",
    "age_band",
    "total_events",
    "total_session_minutes",
    "avg_session_minutes",
    "distinct_books",
    "avg_progress_pct",
    "pct_finished",
    "pct_audiobook",
    "pct_ebook",
    "top_genre",
    "days_since_last_event",
    "events_last_90d",
    "events_last_180d",
    "had_subscription",
    "subscription_canceled",
)

NUMERIC_FEATURES = (
    "tenure_days",
    "total_events",
    "total_session_minutes",
    "avg_session_minutes",
    "distinct_books",
    "avg_progress_pct",
    "pct_finished",
    "pct_audiobook",
    "pct_ebook",
    "days_since_last_event",
    "events_last_90d",
    "events_last_180d",
)
CATEGORICAL_FEATURES = ("plan_type", "region", "device_type", "age_band", "top_genre")
BOOLEAN_FEATURES = ("had_subscription", "subscription_canceled")
