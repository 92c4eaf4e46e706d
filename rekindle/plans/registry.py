"""Models that outlive the session: versions and aliases as tables, fitted parts on shared storage.

Below the registry's path:

- ``versions``: ``(model, version, run_id, family, path)``, one row per registered version;
- ``aliases``: ``(model, alias, version, assigned_at, sequence)``, an assignment log in which the
  last one wins, so that an alias moves and never points to two versions;
- ``models/<model>/<version>``: the preparation's tables and the classifier as ``pyspark.ml``
  stores it.

Each row is a small file written in one step; nothing is rewritten, so a reader always sees whole
versions. Registrations of one model are expected from one job at a time.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rekindle.plans import evaluation
from rekindle.plans.preparation import Preparation

VERSIONS = "model string, version int, run_id string, family string, path string"
ALIASES = "model string, alias string, version int, assigned_at timestamp, sequence long"
CHAMPION, CHALLENGER = "Champion", "Challenger"


@dataclass(frozen=True)
class Fitted:
    """A preparation and the classifier that was fitted on its vectors."""

    preparation: Preparation
    classifier: Model

    def save(self, path: str) -> None:
        """Stores the classifier beside the preparation, which moves with a copy of its tables."""
        spark = SparkSession.getActiveSession()
        for part in ("means", "dictionary", "sizes"):
            spark.read.parquet(f"{self.preparation.path}/{part}").write.parquet(f"{path}/preparation/{part}")
        PipelineModel(stages=[self.classifier]).write().save(f"{path}/classifier")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Fitted:
        preparation = Preparation.load(spark, f"{path}/preparation")
        return cls(preparation, PipelineModel.load(f"{path}/classifier").stages[0])

    def score(self, table: DataFrame) -> DataFrame:
        """All input columns, then ``prediction`` (the class) and ``probability`` (of class 1)."""
        row = F.struct(*[F.col(c) for c in table.columns]).alias("_row")
        packed = table.select(row, *[c for c in table.columns if c in self.inputs])
        scored = self.classifier.transform(self.preparation.transform(packed, "features"))
        share = F.get(vector_to_array("probability"), F.lit(1))
        return scored.select("_row.*", F.col("prediction").cast("int").alias("prediction"), share.alias("probability"))

    @property
    def inputs(self) -> set[str]:
        p = self.preparation
        return {*p.numeric, *p.flags, *p.categorical}


@dataclass(frozen=True)
class Registry:
    spark: SparkSession
    path: str

    def _table(self, name: str, schema: str) -> DataFrame:
        empty = self.spark.createDataFrame([], schema)
        # an empty first write makes the table readable before any version exists
        empty.write.mode("append").parquet(f"{self.path}/{name}") if not self._exists(name) else None
        return self.spark.read.schema(empty.schema).parquet(f"{self.path}/{name}")

    def _exists(self, name: str) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def versions(self) -> DataFrame:
        return self._table("versions", VERSIONS)

    def aliases(self) -> DataFrame:
        return self._table("aliases", ALIASES)

    def register(self, model: str, fitted: Fitted, run_id: str, family: str) -> int:
        """Stores the fitted parts as the next version of ``model``; its number."""
        last = self.versions().where(F.col("model") == model).agg(F.max("version")).first()[0]
        version = (last or 0) + 1
        path = f"{self.path}/models/{model}/{version}"
        fitted.save(path)
        row = self.spark.createDataFrame([(model, version, run_id, family, path)], VERSIONS)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/versions")
        return version

    def assign(self, model: str, alias: str, version: int) -> None:
        """Points ``alias`` to ``version``; whatever it pointed to before loses it."""
        if self.versions().where((F.col("model") == model) & (F.col("version") == version)).isEmpty():
            raise ValueError(f"{model} has no version {version}")
        last = self.aliases().where(F.col("model") == model).agg(F.max("sequence")).first()[0]
        at = datetime.now(timezone.utc)
        row = self.spark.createDataFrame([(model, alias, version, at, (last or 0) + 1)], ALIASES)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/aliases")

    def resolved(self, model: str | None = None) -> DataFrame:
        """``(model, alias, version, run_id, family, path)`` of what each alias points to now."""
        current = evaluation.latest_assignment(self.aliases()).select("model", "alias", "version")
        found = current.join(self.versions(), ["model", "version"])
        found = found if model is None else found.where(F.col("model") == model)
        return found.select("model", "alias", "version", "run_id", "family", "path")

    def listing(self) -> DataFrame:
        return evaluation.version_listing(self.versions(), self.aliases())

    def load(self, model: str, alias: str = CHAMPION) -> Fitted:
        """The fitted parts behind an alias, read from storage; one row reaches the driver."""
        row = self.resolved(model).where(F.col("alias") == alias).first()
        if row is None:
            raise RuntimeError(f"{model} has no version with the alias {alias}")
        return Fitted.load(self.spark, row.path)

    def scored_by(self, model: str, table: DataFrame, aliases: tuple[str, ...] = (CHAMPION, CHALLENGER)) -> DataFrame:
        """``table`` scored by the model behind each alias, in long form with a column ``model``."""
        parts = [self.load(model, a).score(table).withColumn("model", F.lit(a)) for a in aliases]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out
