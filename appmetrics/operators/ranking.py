"""Exact quantiles, ranks and running totals that never put a whole column into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from appmetrics.functions import parsing as P
from appmetrics.functions.scratch import stage
from appmetrics.schema import float_columns


def running_totals(df: DataFrame, order, amount: str | None = None, out: str = "running_total") -> DataFrame:
    """Sum of ``amount`` (or the row number) up to each row in the global ``order``.

    Rows are range-partitioned and summed inside each range; the ranges' own totals, one row per
    partition, give each range its starting offset. ``order`` must identify a row.
    """
    step = P.field(amount).cast("bigint") if amount else F.lit(1).cast("bigint")
    ranged = stage(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).withColumn("_step", step), "ranges"
    )
    # One row per shuffle partition, so this window is bounded by the session's partition count.
    totals = ranged.groupBy("_range").agg(F.sum("_step").alias("_total"))
    offsets = totals.select(
        "_range",
        (F.sum("_total").over(Window.orderBy("_range")) - F.col("_total")).alias("_offset"),
    )
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumn("_sum", F.sum("_step").over(within))
        .join(offsets, "_range")
        .withColumn(out, F.col("_sum") + F.col("_offset"))
        .drop("_range", "_step", "_sum", "_offset")
    )


def running_sums(df: DataFrame, group, order: str, amounts) -> DataFrame:
    """Adds ``<amount>_upto``, the sum up to each row in the order of its group, and ``<amount>_all``, the group's sum.

    ``order`` tells the rows of a group apart. Rows lie in range partitions of group and order, so a group of any size
    is summed in parts; each part's start comes from the parts before it, one row per group and range.
    """
    group, amounts = list(group), list(amounts)
    ranged = stage(df.repartitionByRange(*group, order).withColumn("_range", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy(*group, "_range").agg(*[F.sum(a).alias(f"_{a}") for a in amounts])
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(g).alias(f"_group{i}") for i, g in enumerate(group)],
        F.col("_range").alias("_part"),
        *[F.coalesce(F.sum(f"_{a}").over(before), F.lit(0)).alias(f"_{a}_before") for a in amounts],
        *[F.sum(f"_{a}").over(whole).alias(f"{a}_all") for a in amounts],
    )
    within = Window.partitionBy("_range", *group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    # A null group is a group too.
    same = [F.col(g).eqNullSafe(F.col(f"_group{i}")) for i, g in enumerate(group)]
    return (
        ranged.withColumns({f"_{a}_sum": F.sum(a).over(within) for a in amounts})
        .join(starts, [F.col("_range") == F.col("_part"), *same])
        .withColumns({f"{a}_upto": F.col(f"_{a}_sum") + F.col(f"_{a}_before") for a in amounts})
        .drop("_range", "_part", *[f"_group{i}" for i in range(len(group))], *[f"_{a}_{part}" for a in amounts for part in ("sum", "before")])
    )


BINS = 1024


def exact_quantiles(df: DataFrame, columns, probabilities) -> dict[str, list[float | None]]:
    """The value at rank ceil(p * n) of every column, by counting.

    The numbers are written once as a narrow table. Every pass counts the rows per bin of each open range, from
    the column's least to its largest value at first, and goes on with the bin that holds the rank, until that
    bin holds one value. A pass is a plain aggregate whose result has ``BINS`` rows per range, for tables of any
    size, and after the first one few rows are inside the ranges.
    """
    columns, probabilities = list(columns), list(probabilities)
    if not columns:
        return {}
    floats = set(float_columns(df))
    values = stage(df.selectExpr(*[f"{P.number_sql(c, c in floats)} AS v{i}" for i, c in enumerate(columns)]), "numbers")
    finite = "CASE WHEN abs(v{0}) < double('Infinity') THEN v{0} END"
    facts = values.agg(
        *[F.expr(f"count(v{i}) AS n{i}") for i in range(len(columns))],
        *[F.expr(f"min({finite.format(i)}) AS low{i}") for i in range(len(columns))],
        *[F.expr(f"max({finite.format(i)}) AS high{i}") for i in range(len(columns))],
        *[F.expr(f"count_if(v{i} = double('-Infinity')) AS below{i}") for i in range(len(columns))],
        *[F.expr(f"count_if(v{i} = double('Infinity')) AS above{i}") for i in range(len(columns))],
    ).first()

    result = {c: [None] * len(probabilities) for c in columns}
    open_ranks: dict[tuple[int, int], tuple[float, float, int]] = {}
    for i, c in enumerate(columns):
        n, below, above = facts[f"n{i}"], facts[f"below{i}"], facts[f"above{i}"]
        for j, p in enumerate(probabilities):
            # Integer arithmetic of the decimal text: 0.1 * 30 must give rank 3, not 4.
            rank = max(1, -(-_scaled(p) * n // 10**9))
            if n and rank <= below:
                result[c][j] = float("-inf")
            elif n and rank > n - above:
                result[c][j] = float("inf")
            elif n:
                open_ranks[(i, j)] = (float(facts[f"low{i}"]), float(facts[f"high{i}"]), rank - below)
    while open_ranks:
        ranges = sorted({(i, low, high) for (i, _), (low, high, _) in open_ranks.items()})
        bins = _counted(values, ranges)
        for (i, j), (low, high, rank) in list(open_ranks.items()):
            for least, most, rows in bins[ranges.index((i, low, high))]:
                if rank <= rows:
                    break
                rank -= rows
            open_ranks[(i, j)] = (least, most, rank)
            if least == most:
                result[columns[i]][j] = least
                del open_ranks[(i, j)]
    return result


def _scaled(p: float) -> int:
    return int(round(p * 10**9))


def _bin_sql(v: str, low: float, high: float) -> str:
    """Bin of a value; halves, so that the width of no range overflows."""
    scale = BINS / (high / 2 - low / 2) if high / 2 > low / 2 else float("inf")
    if scale == float("inf"):
        return f"CASE WHEN {v} > {low!r}D THEN 1 ELSE 0 END"
    return f"cast(least(floor(({v} / 2 - {low / 2!r}D) * {scale!r}D), {BINS - 1}) AS int)"


def _counted(values: DataFrame, ranges) -> list[list[tuple[float, float, int]]]:
    """For each range (column number, low, high): least value, largest value and rows of its bins, in order."""
    inside = [
        f"CASE WHEN v{i} BETWEEN {low!r}D AND {high!r}D THEN struct({t} AS range, {_bin_sql(f'v{i}', low, high)} AS bin, v{i} AS value) END"
        for t, (i, low, high) in enumerate(ranges)
    ]
    counted = (
        values.selectExpr("inline(array_compact(array(" + ", ".join(inside) + ")))")
        .groupBy("range", "bin")
        .agg(F.min("value").alias("least"), F.max("value").alias("most"), F.count(F.lit(1)).alias("rows"))
    )
    out: list[list] = [[] for _ in ranges]
    for r in sorted(counted.collect(), key=lambda r: (r["range"], r["bin"])):
        out[r["range"]].append((r["least"], r["most"], r["rows"]))
    return out


def top_rows(df: DataFrame, n: int, *order) -> DataFrame:
    """First ``n`` rows in ``order``; Spark keeps only ``n`` rows per task."""
    return df.orderBy(*order).limit(n)
