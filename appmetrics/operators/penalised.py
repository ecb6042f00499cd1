"""Elastic-net paths by coordinate descent on second moments.

The penalised squares of a linear model depend on the rows only through their number, means and covariances. One
pass returns these (one number for each pair of features), and any number of penalties is then solved without
reading the rows again, each from the solution before it.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from appmetrics.functions.parsing import field


class Moments(NamedTuple):
    """Rows, means and covariances (over n) of the features and, last, the label."""

    n: int
    means: np.ndarray
    covariances: np.ndarray


def moments(df: DataFrame, label: str, features: str = "features") -> Moments:
    """Of the rows that have features and a label. All features of a row must be numbers."""
    known = df.filter(field(features).isNotNull())
    rows = known.select(vector_to_array(field(features)).alias("x"), field(label).cast("double").alias("y"))
    parts = rows.filter("y IS NOT NULL AND NOT isnan(y)").mapInArrow(_task_moments, "n bigint, means array<double>, products array<double>")
    found = parts.rdd.map(tuple).treeAggregate(None, _merged, _merged)
    if found is None:
        raise ValueError("no rows with features and a label")
    n, means, products = found
    return Moments(n, np.array(means), np.array(products).reshape(len(means), len(means)) / n)


def _merged(a, b):
    """Rows, means and centered products of two sets of rows together; the products are a flat list."""
    if a is None or b is None:
        return a or b
    n, off = a[0] + b[0], np.array(b[1]) - np.array(a[1])
    means = np.array(a[1]) + off * (b[0] / n)
    products = np.array(a[2]) + np.array(b[2]) + np.outer(off, off).ravel() * (a[0] * (b[0] / n))
    return n, means.tolist(), products.tolist()


def _task_moments(batches):
    """One row (n, means, products) for the rows of a task, none for a task without rows."""
    found = None
    for batch in batches:
        if batch.num_rows:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            rows = np.column_stack((x, batch.column(1).to_numpy(zero_copy_only=False)))
            means = rows.mean(axis=0)
            rows -= means
            found = _merged(found, (len(rows), means.tolist(), (rows.T @ rows).ravel().tolist()))
    if found:
        kinds = (pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(found, kinds)], ["n", "means", "products"])


class PenalisedLine(NamedTuple):
    strength: float
    l1_share: float
    coefficients: list[float]
    intercept: float
    iterations: int
    objective_history: list[float]
    rmse: float
    r2: float | None


def elastic_net_path(m: Moments, strengths, l1_share: float = 0.8, max_iter: int = 1000, tolerance: float = 1e-12) -> list[PenalisedLine]:
    """The linear models of each strength, in the order given.

    Features and label are scaled to deviation 1 first, as ``pyspark.ml`` does, so models and objectives are the
    same. A constant feature has coefficient 0; with a constant label all have. Iterations are rounds over all
    features; they end when no scaled coefficient moves by more than ``tolerance``.
    """
    width = len(m.means) - 1
    sample = m.n / max(m.n - 1, 1)
    deviations = np.sqrt(np.diag(m.covariances) * sample)
    own, label = deviations[:width], deviations[width]
    factor = np.divide(1.0, own, out=np.zeros(width), where=own > 0)
    by_label = 1.0 / label if label > 0 else 0.0
    gram = m.covariances[:width, :width] * factor[:, None] * factor
    pull = m.covariances[:width, width] * factor * by_label
    left = m.covariances[width, width] * by_label**2
    beta, out = np.zeros(width), []
    for strength in strengths:
        l1, l2 = strength * by_label * l1_share, strength * by_label * (1 - l1_share)

        def objective():
            return float(left / 2 - pull @ beta + beta @ gram @ beta / 2 + l1 * np.abs(beta).sum() + l2 / 2 * beta @ beta)

        history, moved = [objective()], np.inf
        while moved > tolerance and len(history) <= max_iter:
            moved = 0.0
            for j in range(width):
                size = gram[j, j] + l2
                rest = pull[j] - gram[j] @ beta + gram[j, j] * beta[j]
                new = np.sign(rest) * max(abs(rest) - l1, 0.0) / size if factor[j] and size > 0 else 0.0
                moved, beta[j] = max(moved, abs(new - beta[j])), new
            history.append(objective())
        coefficients = beta * factor * label
        squares = m.covariances[width, width] - 2 * coefficients @ m.covariances[:width, width] + coefficients @ m.covariances[:width, :width] @ coefficients
        squares = max(float(squares), 0.0)
        r2 = float(1.0 - squares / m.covariances[width, width]) if label > 0 else None
        intercept = float(m.means[width] - coefficients @ m.means[:width])
        out.append(PenalisedLine(float(strength), l1_share, coefficients.tolist(), intercept, len(history) - 1, history, squares**0.5, r2))
    return out


def path_frame(df: DataFrame, lines: list[PenalisedLine]) -> DataFrame:
    """One row for each strength."""
    schema = """strength double, l1_share double, coefficients array<double>, intercept double, iterations int,
      objective_history array<double>, rmse double, r2 double"""
    return df.sparkSession.createDataFrame([tuple(line) for line in lines], schema)
