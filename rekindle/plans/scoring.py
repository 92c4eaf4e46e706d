"""Applying models to the feature table: fitted pipelines, UDFs and plain expressions."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rekindle.contracts import KEY, LABEL
from rekindle.functions import payload_json
from rekindle.operators.projections import exclude_columns
from rekindle.operators.ranking import sample
from rekindle.plans.registry import Fitted
from rekindle.sources.tables import overwrite_table

# A model fixed by hand, for scoring paths that need no training.
COEFFICIENTS: dict[str, float] = {
    "days_since_last_event": -0.004,
    "events_last_90d": 0.12,
    "events_last_180d": 0.05,
    "pct_finished": 0.6,
    "total_events": 0.008,
}
INTERCEPT = -1.1
CHALLENGER: dict[str, float] = {
    "days_since_last_event": -0.002,
    "events_last_180d": 0.2,
    "tenure_days": 0.0002,
}
CHALLENGER_INTERCEPT = -1.4


def feature_columns(table: DataFrame) -> list[str]:
    """Every column but the key and the label, in table order."""
    return exclude_columns(table, [KEY, LABEL]).columns


def linear_probability(coefficients: Mapping[str, float], intercept: float) -> Column:
    """Logistic score as a column expression: no Python worker, fully generated code.

    A missing feature contributes nothing.
    """
    terms = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * w for c, w in coefficients.items()]
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-reduce(add, terms, F.lit(intercept))))


def vector_udf(columns: Sequence[str], coefficients: Mapping[str, float], intercept: float):
    """The same model as a vectorised UDF over all feature columns, in their order.

    The iterator form sets the model up once per task, as an external model would need.
    """
    weights = [(columns.index(c), w) for c, w in coefficients.items()]

    @F.pandas_udf("double")
    def predict(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        positions = [i for i, _ in weights]
        w = np.array([v for _, v in weights])
        for batch in batches:
            x = np.column_stack(
                [np.nan_to_num(batch[i].to_numpy(dtype=float, na_value=np.nan)) for i in positions]
            )
            yield pd.Series(1.0 / (1.0 + np.exp(-(x @ w + intercept))))

    return predict


def score_with_udf(table: DataFrame, coefficients: Mapping[str, float], intercept: float) -> DataFrame:
    columns = feature_columns(table)
    predict = vector_udf(columns, coefficients, intercept)
    return table.withColumn("prediction", predict(*[F.col(c) for c in columns]))


def score_with_expression(
    table: DataFrame, coefficients: Mapping[str, float], intercept: float
) -> DataFrame:
    return table.withColumn("prediction", linear_probability(coefficients, intercept))


def score_batch(table: DataFrame, model: Fitted) -> DataFrame:
    """All input columns, then the class ``prediction`` and ``probability`` of a fitted model."""
    return model.score(table)


def score_sample(
    table: DataFrame, n: int, coefficients: Mapping[str, float], intercept: float
) -> DataFrame:
    """Scores of the first ``n`` rows by key."""
    return score_with_expression(sample(table, n, KEY), coefficients, intercept)


def persist_scores(scored: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The scored table: every feature column and the prediction, replaced each run."""
    return overwrite_table(scored, name, path, replace_schema=True)


def payload_rows(
    scored: DataFrame,
    columns: Sequence[str],
    at: Column,
    endpoint: str = "reactivation",
    key: str = KEY,
) -> DataFrame:
    """Request-log rows for scored rows, as an endpoint would have captured them.

    ``at`` is the request time. The request id is a digest of key and time, so a rerun
    logs the same ids.
    """
    stamp = at.cast("timestamp")
    return scored.select(
        F.md5(F.concat_ws("|", F.col(key).cast("string"), F.unix_millis(stamp).cast("string"))).alias(
            "request_id"
        ),
        F.lit(None).cast("string").alias("client_request_id"),
        stamp.cast("date").alias("request_date"),
        F.unix_millis(stamp).alias("timestamp_ms"),
        F.lit(200).alias("status_code"),
        F.lit(1.0).alias("sampling_fraction"),
        F.lit(0).cast("long").alias("execution_duration_ms"),
        payload_json.split_encode(columns).alias("request"),
        payload_json.response_encode(F.col("prediction")).alias("response"),
        F.create_map(F.lit("endpoint"), F.lit(endpoint)).alias("request_metadata"),
    )


