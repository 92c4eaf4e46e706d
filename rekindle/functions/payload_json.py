"""Reading and writing the JSON documents of the request log.

Everything tolerates malformed input: a document of another shape, a short row or a
value that is not a number gives NULL, never a failed job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPLIT_SCHEMA = "dataframe_split struct<columns: array<string>, data: array<array<string>>>"
RESPONSE_SCHEMA = "predictions array<double>"


def predictions(log: DataFrame, keep: Sequence[str] = ("request_date",)) -> DataFrame:
    """One row per prediction of every successful response."""
    return (
        log.where("status_code = 200")
        .select(*keep, F.from_json("response", RESPONSE_SCHEMA).alias("_r"))
        .select(*keep, F.explode("_r.predictions").alias("prediction"))
    )


def parsed_requests(log: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Column names and rows of every successful request; NULL in any other shape.

    ``inline`` hands both fields on as columns, so later filters on one of them cannot
    make Spark parse the document again.
    """
    split = F.from_json("request", SPLIT_SCHEMA)["dataframe_split"]
    return log.where("status_code = 200").select(*keep, F.inline(F.array(split)))


def index_of(columns: Column, name: str) -> Column:
    """1-based position of ``name``; 0 when absent, NULL when the array is NULL."""
    return F.array_position(columns, name)


def _get(value: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(value, path, kind)


def number(cell: Column) -> Column:
    """The number a VARIANT stands for, also where it is sent as text; else NULL."""
    return _get(cell, "$", "string").try_cast("double")


def named_rows(document: Column) -> Column:
    """The data rows of a parsed request as an array of (names, cells), NULL if it has no such shape.

    ``dataframe_split`` states the names once; ``dataframe_records`` and ``instances`` state them
    in each row. ``instances`` and ``inputs`` that are plain lists have no names.
    """
    columns = _get(document, "$.dataframe_split.columns", "array<string>")
    data = _get(document, "$.dataframe_split.data", "array<variant>")
    split = F.transform(data, lambda r: F.struct(columns.alias("names"), _get(r, "$", "array<variant>").alias("cells")))
    records = F.coalesce(_get(document, "$.dataframe_records", "array<variant>"), _get(document, "$.instances", "array<variant>"))
    maps = F.transform(records, lambda r: _get(r, "$", "map<string,variant>"))
    named = F.transform(maps, lambda m: F.struct(F.map_keys(m).alias("names"), F.map_values(m).alias("cells")))
    readable = F.forall(maps, lambda m: m.isNotNull())
    return F.when(columns.isNotNull() & data.isNotNull(), split).when(readable, named)


def documents(log: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every request parsed once: ``document`` (NULL if it is no JSON) and its named ``rows``.

    ``inline`` hands the parsed document on as a column, so that it is not parsed again.
    """
    held = log.select(*keep, "status_code", "request", F.inline(F.array(F.struct(F.try_parse_json("request").alias("document")))))
    return held.select("*", F.inline(F.array(F.struct(named_rows(F.col("document")).alias("rows")))))


def split_column(log: DataFrame, name: str, keep: Sequence[str] = ("request_date",)) -> DataFrame:
    """Numeric values sent for the column ``name``, one row per data row that has one."""
    return (
        documents(log.where("status_code = 200"), keep)
        .select(*keep, F.inline("rows"))
        .select(*keep, "cells", index_of(F.col("names"), name).cast("int").alias("_at"))
        .where("_at > 0")
        .select(*keep, number(F.get("cells", F.col("_at") - 1)).alias(name))
        .where(F.col(name).isNotNull())
    )


def split_all_columns(log: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every numeric value sent, as (column_name, value) rows."""
    return (
        documents(log.where("status_code = 200"), keep)
        .select(*keep, F.inline("rows"))
        .select(*keep, "cells", F.posexplode("names").alias("_at", "column_name"))
        .select(*keep, "column_name", number(F.get("cells", F.col("_at"))).alias("value"))
        .where(F.col("value").isNotNull())
    )


#: Why a request gives no value of a column, in the order in which it is asked.
REASONS = (
    "not_ok",
    "no_request",
    "broken",
    "no_names",
    "other_shape",
    "no_rows",
    "missing_column",
    "short_row",
    "not_a_number",
    "used",
)


def decided(log: DataFrame, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """Every request with the ``reason`` why it gives no value of ``name``, ``used`` if it gives one.

    ``sent`` and ``values`` count its data rows and the values among them.
    """
    document, rows = F.col("document"), F.col("rows")

    def has(key: str) -> Column:
        return _get(document, f"$.{key}", "variant").isNotNull()

    def cell(r: Column) -> Column:
        at = index_of(r["names"], name).cast("int")
        return F.when(at > 0, number(F.get(r["cells"], at - 1)))

    found = F.size(F.filter(rows, lambda r: cell(r).isNotNull()))
    named = F.exists(rows, lambda r: index_of(r["names"], name) > 0)
    short = F.exists(rows, lambda r: F.coalesce(F.size(r["cells"]), F.lit(0)) < index_of(r["names"], name))
    tests = (
        F.coalesce(F.col("status_code") != 200, F.lit(True)),
        F.col("request").isNull(),
        document.isNull(),
        rows.isNull() & (has("inputs") | has("instances")),
        rows.isNull(),
        F.size(rows) == 0,
        ~named,
        (found == 0) & short,
        found == 0,
        F.lit(True),
    )
    reason = F.coalesce(*[F.when(t, F.lit(r)) for t, r in zip(tests, REASONS, strict=True)])
    usable = ~tests[0] & rows.isNotNull()
    return documents(log, keep).select(
        *keep,
        reason.alias("reason"),
        F.when(usable, F.size(rows)).otherwise(0).cast("long").alias("sent"),
        F.when(usable, found).otherwise(0).cast("long").alias("values"),
    )


def split_encode(columns: Sequence[str]) -> Column:
    """The row as a one-row ``{"dataframe_split": {"columns", "data"}}`` document.

    A VARIANT array holds values of mixed types, so numbers, strings, booleans and NULLs
    each keep their JSON form.
    """
    names = F.array(*[F.lit(c) for c in columns])
    row = F.array(*[F.col(c).cast("variant") for c in columns])
    split = F.struct(names.alias("columns"), F.array(row).alias("data"))
    return F.to_json(F.struct(split.alias("dataframe_split")))


def response_encode(prediction: Column) -> Column:
    """One prediction as a ``{"predictions": [p]}`` document."""
    return F.to_json(F.struct(F.array(prediction).alias("predictions")))
