"""Distance expressions over numeric columns."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from appmetrics.functions.parsing import field, quoted


def _square_sql(features, center) -> str:
    return " + ".join(f"pow({quoted(c)} - {float(v)!r}D, 2)" for c, v in zip(features, center))


def squared_distance(features, center) -> Column:
    """Squared Euclidean distance of a row to a fixed point."""
    return F.expr(_square_sql(features, center))


def euclidean(left, right) -> Column:
    """Euclidean distance between two lists of columns."""
    return F.sqrt(reduce(add, [(field(a) - field(b)) * (field(a) - field(b)) for a, b in zip(left, right)]))


def nearest(features, centers) -> Column:
    """Struct (distance, cluster) of the closest center; the lower index wins a tie."""
    options = ", ".join(f"struct({_square_sql(features, c)} AS distance, {i} AS cluster)" for i, c in enumerate(centers))
    return F.expr(f"array_min(array({options}))")


def nearest_cluster(features, centers) -> Column:
    return nearest(features, centers)["cluster"]
