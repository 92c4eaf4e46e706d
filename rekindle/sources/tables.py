"""Reading, checking and writing tables."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Mapping
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rekindle.session import scratch_path


_FILLERS = {
    "string": "",
    "boolean": False,
    "date": date(1970, 1, 1),
    "timestamp": datetime(1970, 1, 1),
    "timestamp_ntz": datetime(1970, 1, 1),
}


def _filler(kind: T.DataType) -> Column:
    """Some value of a type that is not NULL."""
    if isinstance(kind, T.ArrayType):
        return F.array().cast(kind)
    if isinstance(kind, T.MapType):
        return F.create_map().cast(kind)
    if isinstance(kind, T.StructType):
        return F.struct(*[_filler(f.dataType).alias(f.name) for f in kind.fields]).cast(kind)
    if isinstance(kind, T.BinaryType):
        return F.lit(b"")
    return F.lit(_FILLERS.get(kind.typeName(), 0)).cast(kind)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every named table in one job; each branch is a map-side count."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types.

    A value that does not fit its type, or a NULL in a NOT NULL column, fails the job
    and names the column.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the table: {', '.join(missing)}")

    def checked(field: T.StructField) -> Column:
        value = F.col(field.name).cast(field.dataType)
        if field.nullable:
            return value.alias(field.name)
        guard = F.raise_error(F.lit(f"NULL in NOT NULL column {field.name}")).cast(field.dataType)
        # Never reached after the guard; a literal last makes the column NOT NULL for Catalyst.
        last = _filler(field.dataType)
        return F.coalesce(value, guard, last).alias(field.name)

    return df.select(*[checked(f) for f in schema.fields])


def schema_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column: NULLs where none are allowed, and values that do not cast; one scan."""
    columns = [f for f in schema.fields if f.name in df.columns]
    counts: list[Column] = []
    for f in columns:
        value = F.col(f.name)
        nulls = F.count_if(value.isNull()) if not f.nullable else F.lit(0).cast("long")
        bad = F.count_if(value.isNotNull() & value.try_cast(f.dataType).isNull())
        counts.append(F.struct(F.lit(f.name).alias("column_name"), nulls.alias("null_violations"),
                               bad.alias("cast_failures")))
    return df.agg(F.array(*counts).alias("c")).select(F.inline("c"))


def nan_to_null_int(value: Column) -> Column:
    """A float column whose NaN means "absent", as a nullable int."""
    return F.when(~F.isnan(value), value).cast("int")


def overwrite_table(
    df: DataFrame,
    name: str,
    path: str | None = None,
    partition_by: tuple[str, ...] = (),
    fmt: str = "parquet",
    replace_schema: bool = False,
) -> DataFrame:
    """Replace the contents of table ``name`` and return it read back.

    ``replace_schema`` also lets the columns change. Parquet tables always do;
    the option is what formats with schema enforcement need.
    """
    writer = df.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if replace_schema:
        writer = writer.option("overwriteSchema", "true")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def own_name(what: str) -> str:
    """A table name that no other run uses."""
    return f"rekindle_{what}_{uuid.uuid4().hex[:12]}"


def materialised(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared scratch folder and read back.

    Later passes reread files instead of recomputing the joins behind them, and a lost
    executor costs only its own tasks.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def roundtrip(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Create a table, insert ``df``, read it back, verify, and drop it on any outcome.

    One result row: rows written, rows read, and whether the per-row digests agree.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        raise ValueError(f"table {name} exists already; a round trip needs a name of its own")
    source = f"{name}_source"
    df.createOrReplaceTempView(source)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    location = f" LOCATION '{path}'" if path else ""
    digest = "count(*) AS n, coalesce(sum(cast(xxhash64(*) AS decimal(38,0))), 0) AS digest"
    try:
        spark.sql(f"CREATE TABLE {name} ({columns}) USING PARQUET{location}")
        spark.sql(f"INSERT INTO {name} SELECT * FROM {source}")
        sent = spark.sql(f"SELECT {digest} FROM {source}").first()
        got = spark.sql(f"SELECT {digest} FROM {name}").first()
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.dropTempView(source)
    if sent != got:
        raise RuntimeError(f"{name}: wrote {sent.n} rows, read {got.n}, digests differ")
    return spark.range(1).select(
        F.lit(sent.n).cast("long").alias("rows_written"),
        F.lit(got.n).cast("long").alias("rows_read"),
        F.lit(sent.digest == got.digest).alias("identical"),
    )


def require_table(spark: SparkSession, name: str, hint: str = "") -> DataFrame:
    """The table, or an error that says what to do; an empty table only warns."""
    if not spark.catalog.tableExists(name):
        raise RuntimeError(f"table {name} does not exist yet. {hint}".strip())
    table = spark.table(name)
    if table.isEmpty():
        warnings.warn(f"table {name} exists but holds no rows. {hint}".strip(), stacklevel=2)
    return table


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df`` itself, or an error when it holds no rows; reads at most one row."""
    if df.isEmpty():
        raise RuntimeError(f"{what} is empty")
    return df


def event_range(events: DataFrame, ts: str, horizon_days: int = 30) -> DataFrame:
    """First and last event, and the latest cut-off that leaves a whole horizon after it."""
    return events.agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts")).select(
        "min_ts",
        "max_ts",
        F.date_sub(F.to_date("max_ts"), horizon_days).alias("suggested_snapshot"),
    )
