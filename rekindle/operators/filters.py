"""Row filters around a cut-off date, and simple predicates.

All windows are half open: history ends before the cut-off, the horizon starts on it.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rekindle.contracts import INACTIVITY_WINDOW_DAYS, PREDICTION_HORIZON_DAYS
from rekindle.functions.scalars import boundary


def history(events: DataFrame, snapshot: date, ts: str = "event_ts") -> DataFrame:
    return events.where(F.col(ts) < boundary(events, ts, snapshot))


def horizon(
    events: DataFrame, snapshot: date, days: int = PREDICTION_HORIZON_DAYS, ts: str = "event_ts"
) -> DataFrame:
    """Events in ``[snapshot, snapshot + days)``."""
    t = F.col(ts)
    return events.where(
        (t >= boundary(events, ts, snapshot)) & (t < boundary(events, ts, snapshot, days))
    )


def recent(
    events: DataFrame, snapshot: date, days: int = INACTIVITY_WINDOW_DAYS, ts: str = "event_ts"
) -> DataFrame:
    """Events in ``[snapshot - days, snapshot)``."""
    t = F.col(ts)
    return events.where(
        (t >= boundary(events, ts, snapshot, -days)) & (t < boundary(events, ts, snapshot))
    )


def recently_active(
    events: DataFrame,
    snapshot: date,
    days: int = INACTIVITY_WINDOW_DAYS,
    key: str = "user_id",
    ts: str = "event_ts",
) -> DataFrame:
    return recent(events, snapshot, days, ts).select(key).distinct()


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def status_ok(log: DataFrame) -> DataFrame:
    return log.where("status_code = 200")


def name_contains(df: DataFrame, column: str, fragment: str) -> DataFrame:
    """Plain substring search: ``_`` and ``%`` in the fragment mean themselves."""
    return df.where(F.col(column).contains(fragment))
