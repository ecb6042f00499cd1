"""Percent of total."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from appmetrics.functions.parsing import field


def percent_of_total(df: DataFrame, value: str, out: str = "percent") -> DataFrame:
    """Add ``value`` as percent of its sum. The sum is a scalar subquery, not a one-task window."""
    total = df.agg(F.sum(field(value)).alias("total")).scalar()
    return df.withColumn(out, field(value) * 100.0 / total)
