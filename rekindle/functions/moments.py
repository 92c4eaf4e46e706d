"""Moments and co-moments of all columns in one pass, merged like any partial aggregate."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Merging tasks of the first level.
WIDE = 32
_PARTS = ("n", "mean", "own", "both", "low", "high")


def of_rows(x: np.ndarray) -> dict[str, np.ndarray]:
    """Of the rows of ``x`` (NaN: unknown), by pair of columns: rows in which both are known, the
    first one's mean over them, its squared deviations, and the products of both deviations."""
    known = ~np.isnan(x)
    count = np.maximum(known.sum(axis=0), 1)
    shift = np.where(known, x, 0.0).sum(axis=0) / count  # near the mean, so that squares keep their digits
    y, m = np.where(known, x - shift, 0.0), known.astype(float)
    n = m.T @ m
    each = np.maximum(n, 1)
    total = y.T @ m
    low, high = np.where(known, x, np.inf).min(axis=0), np.where(known, x, -np.inf).max(axis=0)
    return {
        "n": n,
        "mean": shift[:, None] + total / each,
        "own": (y * y).T @ m - total * total / each,
        "both": y.T @ y - total * total.T / each,
        "low": low,
        "high": high,
    }


def merged(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Moments of both sets of rows together; neither depends on the size of the means."""
    n = a["n"] + b["n"]
    each = np.maximum(n, 1)
    gap = b["mean"] - a["mean"]
    weight = a["n"] * b["n"] / each
    return {
        "n": n,
        "mean": np.where(a["n"] > 0, a["mean"] + gap * b["n"] / each, b["mean"]),
        "own": a["own"] + b["own"] + gap * gap * weight,
        "both": a["both"] + b["both"] + gap * gap.T * weight,
        "low": np.minimum(a["low"], b["low"]),
        "high": np.maximum(a["high"], b["high"]),
    }


def comoments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per ordered pair ``(column_a, column_b)``: ``n`` rows in which both are known, means,
    ``var_a``, ``var_b`` and ``covar`` over these (sums of squares and products of deviations), and
    least and greatest value of either column. A column with itself: its own moments. No rows: none.

    NULL and NaN count as unknown. Tasks reduce their rows to matrices of the columns' number;
    these are merged in two levels, so that nothing but one matrix per task travels.
    """
    d = len(columns)
    slim = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    kind = ", ".join(f"{p} array<double>" for p in _PARTS)

    def row(state: dict[str, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([state[p].ravel()], pa.list_(pa.float64())) for p in _PARTS], names=list(_PARTS))

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if batch.num_rows:
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
                own = of_rows(x)
                state = own if state is None else merged(state, own)
        if state is not None:
            yield row(state)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for values in batch.to_pylist():
                own = {p: np.array(values[p]) for p in _PARTS}
                own |= {p: own[p].reshape(d, d) for p in ("n", "mean", "own", "both")}
                state = own if state is None else merged(state, own)
        if state is not None:
            yield row(state)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in merge(batches):
            x = {p: np.array(batch.column(p)[0].as_py()) for p in _PARTS}
            one, two = np.divmod(np.arange(d * d), d)
            turned = two * d + one
            names = np.array(columns, object)
            yield pa.RecordBatch.from_pydict(
                {
                    "column_a": names[one],
                    "column_b": names[two],
                    "n": x["n"].astype(np.int64),
                    **{"mean_a": x["mean"], "mean_b": x["mean"][turned], "var_a": x["own"], "var_b": x["own"][turned]},
                    "covar": x["both"],
                    **{"min_a": x["low"][one], "max_a": x["high"][one], "min_b": x["low"][two], "max_b": x["high"][two]},
                }
            )

    numbers = "mean_a mean_b var_a var_b covar min_a max_a min_b max_b".split()
    out = "column_a string, column_b string, n bigint, " + ", ".join(f"{c} double" for c in numbers)
    parts = slim.mapInArrow(reduce_rows, kind)
    return parts.repartition(WIDE).mapInArrow(merge, kind).repartition(1).mapInArrow(cells, out)
