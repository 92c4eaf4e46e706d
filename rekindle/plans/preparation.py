"""Model inputs as tables: means, a ranked dictionary of categories, and one vector per row.

Nothing that grows with the data reaches the driver. A preparation is three written tables below
one path, so that a later session transforms rows exactly as training did:

- ``means``: one row per numeric column;
- ``dictionary``: ``(column_name, value, n, place)``, values ranked by falling count, then by name;
- ``sizes``: one row per categorical column, with its number of values.

A vector holds the numeric columns (mean where NULL or NaN), the flags (0 where NULL), then per
categorical column one slot per value of the dictionary and a last one for NULL or unseen values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rekindle.contracts import BOOLEAN_FEATURES, CATEGORICAL_FEATURES, NUMERIC_FEATURES
from rekindle.functions.ranges import running_sums


def dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of each column with count and place, most frequent first.

    Counts are combined before the shuffle; places are running counts over sorted ranges.
    """
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    counts = (
        df.select(F.inline(F.array(*cells)))
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_one", F.lit(1))
    )
    ranked = running_sums(counts, ["column_name"], [F.col("n").desc(), F.col("value").asc()], {"upto": "_one"})
    return ranked.select("column_name", "value", "n", (F.col("upto") - 1).alias("place"))


def _known(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


@dataclass(frozen=True)
class Preparation:
    """A fitted preparation, stored below ``path``."""

    path: str
    numeric: tuple[str, ...]
    flags: tuple[str, ...]
    categorical: tuple[str, ...]

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        path: str,
        numeric: Sequence[str] = NUMERIC_FEATURES,
        flags: Sequence[str] = BOOLEAN_FEATURES,
        categorical: Sequence[str] = CATEGORICAL_FEATURES,
    ) -> Preparation:
        """Means and dictionary of ``df``, which is read twice: give it written."""
        own = [
            F.struct(F.lit(k).alias("position"), F.lit(c).alias("column_name"), F.avg(_known(c)).alias("mean"))
            for k, c in enumerate(numeric)
        ]
        means = df.agg(F.array(*own).alias("m")) if own else df.sparkSession.createDataFrame([], "m array<struct<position int, column_name string, mean double>>")
        means.select(F.inline("m")).write.parquet(f"{path}/means")
        found = dictionary(df, categorical) if categorical else None
        spark = df.sparkSession
        empty = spark.createDataFrame([], "column_name string, value string, n long, place long")
        (empty if found is None else found).write.parquet(f"{path}/dictionary")
        stored = spark.read.parquet(f"{path}/dictionary").groupBy("column_name").agg(F.count(F.lit(1)).alias("k"))
        names = spark.createDataFrame(
            [(k, kind, c) for kind, of in (("flag", flags), ("category", categorical)) for k, c in enumerate(of)],
            "position int, kind string, column_name string",
        )
        sizes = names.join(stored, "column_name", "left").select("position", "kind", "column_name", F.coalesce("k", F.lit(0)).alias("k"))
        sizes.coalesce(1).write.parquet(f"{path}/sizes")
        return cls(path, tuple(numeric), tuple(flags), tuple(categorical))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preparation:
        """A stored preparation; one row per column is read here, never a dictionary."""
        named = sorted(spark.read.parquet(f"{path}/sizes").collect(), key=lambda r: r.position)
        numeric = sorted(spark.read.parquet(f"{path}/means").collect(), key=lambda r: r.position)
        return cls(
            path,
            tuple(r.column_name for r in numeric),
            tuple(r.column_name for r in named if r.kind == "flag"),
            tuple(r.column_name for r in named if r.kind == "category"),
        )

    def transform(self, df: DataFrame, vector: str = "features") -> DataFrame:
        """``df`` with its vector; columns and their types stay as they are.

        Each category is found by a join with its part of the dictionary. Means and sizes are one
        value per column and become literals of the plan.
        """
        spark = df.sparkSession
        means = {r.column_name: r.mean for r in spark.read.parquet(f"{self.path}/means").collect()}
        sizes = {r.column_name: r.k for r in spark.read.parquet(f"{self.path}/sizes").collect()}
        row = F.struct(*[F.col(c) for c in df.columns]).alias("_row")
        cells = [F.coalesce(_known(c), F.lit(means[c] or 0.0)).alias(f"_x_{c}") for c in self.numeric]
        cells += [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_x_{c}") for c in self.flags]
        cells += [F.col(c).cast("string").alias(f"_v_{c}") for c in self.categorical]
        out = df.select(row, *cells)
        known = spark.read.parquet(f"{self.path}/dictionary")
        for c in self.categorical:
            own = known.where(F.col("column_name") == c).select(
                F.col("value").alias(f"_d_{c}"), F.col("place").cast("double").alias(f"_p_{c}")
            )
            out = out.join(own, F.col(f"_v_{c}") == F.col(f"_d_{c}"), "left").withColumn(
                f"_p_{c}", F.coalesce(f"_p_{c}", F.lit(float(sizes[c])))
            )
        inputs = [f"_x_{c}" for c in (*self.numeric, *self.flags)]
        if self.categorical:
            places = [f"_p_{c}" for c in self.categorical]
            slots = [f"_o_{c}" for c in self.categorical]
            # the widths of the vectors are those of the dictionary, whatever values appear in df
            widest = spark.createDataFrame([tuple(float(sizes[c]) for c in self.categorical)], ", ".join(f"{p} double" for p in places))
            coder = OneHotEncoder(inputCols=places, outputCols=slots, dropLast=False).fit(widest)
            out, inputs = coder.transform(out), inputs + slots
        out = VectorAssembler(inputCols=inputs, outputCol="_vector").transform(out)
        return out.select("_row.*", F.col("_vector").alias(vector))

    def slots(self, spark: SparkSession) -> DataFrame:
        """What each position of the vector stands for: ``(position, column_name, value)``."""
        first = len(self.numeric) + len(self.flags)
        plain = [(k, c, None) for k, c in enumerate((*self.numeric, *self.flags))]
        parts = [spark.createDataFrame(plain, "position long, column_name string, value string")]
        known = spark.read.parquet(f"{self.path}/dictionary")
        sizes = {r.column_name: r.k for r in spark.read.parquet(f"{self.path}/sizes").collect()}
        for c in self.categorical:
            own = known.where(F.col("column_name") == c)
            parts.append(own.select((F.col("place") + first).cast("long").alias("position"), "column_name", "value"))
            last = spark.createDataFrame([(first + sizes[c], c, None)], "position long, column_name string, value string")
            parts.append(last)
            first += sizes[c] + 1
        return reduce(DataFrame.unionByName, parts)
