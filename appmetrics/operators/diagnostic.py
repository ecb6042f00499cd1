"""Diagnostic group-bys over numeric listings, and the best groups inside each group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from appmetrics.functions.parsing import exact_sum, field

def group_totals(df: DataFrame, group: str, value: str, how: str = "sum", n: int | None = None, ascending: bool = False, out: str = "total") -> DataFrame:
    """Sum or mean of ``value`` per group (groups without a key stay out), sorted, optionally the first n."""
    order = F.asc(out) if ascending else F.desc(out)
    amount = {"sum": exact_sum(df, value), "mean": F.avg(field(value).cast("double"))}[how]
    totals = df.filter(field(group).isNotNull()).groupBy(field(group)).agg(amount.alias(out)).orderBy(order, field(group))
    first = totals if n is None else totals.limit(n)
    return first.withColumn(out, field(out).cast("double"))


def overall_mean(df: DataFrame, value: str, out: str = "mean") -> DataFrame:
    return df.agg(F.avg(field(value)).alias(out))


def rated_counts(df: DataFrame, group: str) -> DataFrame:
    """Rated listings per group and their percent of all rated listings (needs the IsRated column)."""
    from appmetrics.operators.shares import percent_of_total

    return percent_of_total(df.groupBy(field(group)).agg(F.sum("IsRated").alias("rated")), "rated")


def best_groups_within(
    df: DataFrame, outer: str, inner: str, value: str, n: int = 10, max_groups: int | None = None
) -> DataFrame:
    """For each ``outer`` value, the ``n`` ``inner`` groups with the highest mean ``value``.

    ``max_groups`` restricts the report to the first outer values in sort order. The rank filter is
    pushed below the shuffle as a per-task group limit, so a hot outer value stays small.
    """
    rows = df.filter(field(outer).isNotNull() & field(inner).isNotNull())
    if max_groups is not None:
        first = rows.select(field(outer)).distinct().orderBy(field(outer)).limit(max_groups)
        rows = rows.join(first, outer, "left_semi")
    means = rows.groupBy(field(outer), field(inner)).agg(F.avg(field(value)).alias("mean"))
    place = F.row_number().over(Window.partitionBy(field(outer)).orderBy(F.desc("mean"), field(inner)))
    return means.withColumn("place", place).filter(F.col("place") <= n)
