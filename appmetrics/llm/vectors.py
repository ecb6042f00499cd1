"""What operators on vectors share: which rows take part, and vectors from Arrow columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from appmetrics.functions.parsing import quoted

USABLE = (
    "vector IS NOT NULL AND size(vector) > 0 AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    " AND exists(vector, x -> x <> 0)"
)

FINITE = "vector IS NOT NULL AND size(vector) > 0 AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"


def floored(table: DataFrame, vector_col: str, scale: int, **kept: str) -> DataFrame:
    """The columns ``kept`` (name = column) and ``vector`` array<bigint>: floor(scale * x) of every component.

    Vectors that are null, empty or hold null or non-finite components are left out; zero vectors stay.
    """
    rows = table.select(
        *[F.col(quoted(c)).alias(name) for name, c in kept.items()], F.col(quoted(vector_col)).cast("array<double>").alias("vector")
    ).filter(FINITE)
    return rows.select(*kept, F.expr(f"transform(vector, x -> cast(floor({scale} * x) AS bigint))").alias("vector"))


def whole_matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of an Arrow list column of whole numbers, ``width`` in each."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(lists.flatten(), np.int64).reshape(len(lists), width)


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector array<double>) with one row per id.

    Vectors that are null, empty, zero or hold null or non-finite components are left out, as are null ids. Rows
    that share an id count as one: the least vector.
    """
    rows = table.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.filter(f"id IS NOT NULL AND ({USABLE})").groupBy("id").agg(F.min("vector").alias("vector"))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of an Arrow list column, all of one length."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(lists.flatten(), np.float64).reshape(len(lists), -1)


def directions(dimension: int, count: int, seed: int) -> np.ndarray:
    """Random directions, orthonormal in runs of ``dimension``."""
    made = []
    random = np.random.default_rng(seed)
    while sum(map(len, made)) < count:
        made.append(np.linalg.qr(random.normal(size=(dimension, dimension)))[0].T)
    return np.concatenate(made)[:count]
