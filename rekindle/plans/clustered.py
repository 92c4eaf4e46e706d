"""Clustered storage of the inputs, for feature tables that are built again and again.

Events are bucketed by (user, book): the first and largest grouping of the feature plan finds its
rows together and needs no exchange, and a user with a third of all events is still spread over
as many buckets as they have books. Users and subscriptions are bucketed by user, so that their
side of a join stays where it is. The tables are plain bucketed Parquet tables of the catalog;
``features.customer_features`` reads them like any others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from rekindle.contracts import KEY

EVENT_KEYS = (KEY, "book_id")


def store(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` as table ``name`` in ``buckets`` buckets by ``keys``, one sorted file each."""
    rows = df.repartition(buckets, *keys)
    writer = rows.write.format("parquet").mode("overwrite").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def store_inputs(
    users: DataFrame, events: DataFrame, subs: DataFrame, prefix: str, root: str, buckets: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Users, events and subscriptions, clustered for the feature plan."""
    return (
        store(users, f"{prefix}_users", f"{root}/users", [KEY], buckets),
        store(events, f"{prefix}_events", f"{root}/events", EVENT_KEYS, buckets),
        store(subs, f"{prefix}_subscriptions", f"{root}/subscriptions", [KEY], buckets),
    )
