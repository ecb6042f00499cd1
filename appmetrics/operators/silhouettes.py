"""Exact silhouettes with plain Euclidean distances.

A point's score needs its mean distance to every cluster. On one number these come from sorted prefixes: with the
rows and the sum of a cluster's values up to x, the sum of its distances to x is known, so no two points meet. On more
numbers the distinct points, weighted by their rows, meet in blocks of bounded size, and each block returns one sum
for a point and cluster, never a pair. That work grows with the square of the distinct points: it is meant for flags,
ratings and counts, or samples; ``clustering.silhouette`` with squared distances is linear.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from appmetrics.functions.parsing import complete_rows, quoted
from appmetrics.functions.scratch import stage

BLOCK_ROWS = 4096


def silhouette_points(df: DataFrame, features, cluster: str = "cluster") -> DataFrame:
    """(x array<double>, cluster, w): the distinct points of each cluster and their rows. Rows with nulls are left out."""
    names = [*features, cluster]
    rows = complete_rows(df.selectExpr(*[f"cast({quoted(c)} AS double) AS {quoted(c)}" for c in features], quoted(cluster)), names)
    x = ", ".join(quoted(c) for c in features)
    return rows.selectExpr(f"array({x}) AS x", f"{quoted(cluster)} AS cluster").groupBy("x", "cluster").agg(F.count(F.lit(1)).cast("double").alias("w"))


def euclidean_silhouette(points: DataFrame, width: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row ``silhouette``: the mean score of all rows of ``points`` (x, cluster, w).

    A row alone in its cluster scores 0, as does one at distance 0 from everything. Null if there is one cluster
    or no row.
    """
    points = stage(points.select("x", "cluster", F.col("w").cast("double").alias("w")).withColumn("at", F.monotonically_increasing_id()), "points")
    sizes = points.groupBy("cluster").agg(F.sum("w").alias("size"))
    sums = _by_prefixes(points) if width == 1 else _by_blocks(points, block_rows)
    measured = sums.join(sizes.withColumnRenamed("cluster", "other"), "other")
    own = F.col("other") == F.col("cluster")
    means = measured.groupBy("at", "cluster", "w").agg(
        F.max(F.when(own, F.try_divide(F.col("sum"), F.col("size") - 1))).alias("a"),
        F.min(F.when(~own, F.col("sum") / F.col("size"))).alias("b"),
        F.max(F.when(own, F.col("size"))).alias("size"),
    )
    score = F.when(F.col("size") == 1, F.lit(0.0)).otherwise(F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    several = F.count_if(F.col("b").isNull()) == 0
    return means.agg(F.when(several, F.sum(score * F.col("w")) / F.sum("w")).alias("silhouette"))


def _by_prefixes(points: DataFrame) -> DataFrame:
    """(at, cluster, w, other, sum) on one number: the sum of distances to the rows of each cluster.

    Points are dealt to ranges of x; within a range prefixes are running sums, and each range's totals, one row for
    a range and cluster, give where the next one starts.
    """
    ranged = stage(
        points.selectExpr("at", "x[0] AS v", "cluster", "w").repartitionByRange("v", "at").withColumn("range", F.spark_partition_id()), "ranges"
    )
    totals = stage(ranged.groupBy("range", "cluster").agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("v")).alias("s")), "totals")
    last = totals.agg(F.max("range")).first()[0] or 0
    # A row for each range and cluster, also where the cluster has no point in the range.
    whole = totals.groupBy("cluster").agg(F.sum("n").alias("all_n"), F.sum("s").alias("all_s"))
    grid = whole.select("*", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("range"))
    before = Window.partitionBy("cluster").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = grid.join(totals, ["range", "cluster"], "left").select(
        "range", F.col("cluster").alias("other"), "all_n", "all_s",
        F.coalesce(F.sum("n").over(before), F.lit(0.0)).alias("n0"), F.coalesce(F.sum("s").over(before), F.lit(0.0)).alias("s0"),
    )
    # Each point once for every cluster, to be measured; as a member it counts for its own cluster only.
    every = ranged.join(offsets, "range").withColumn("mine", F.when(F.col("other") == F.col("cluster"), F.col("w")).otherwise(F.lit(0.0)))
    up_to = Window.partitionBy("range", "other").orderBy("v", "at").rowsBetween(Window.unboundedPreceding, 0)
    met = every.select("*", (F.col("n0") + F.sum("mine").over(up_to)).alias("n"), (F.col("s0") + F.sum(F.col("mine") * F.col("v")).over(up_to)).alias("s"))
    distance = F.greatest(F.col("v") * (2 * F.col("n") - F.col("all_n")) + F.col("all_s") - 2 * F.col("s"), F.lit(0.0))
    return met.select("at", "cluster", "w", "other", distance.alias("sum"))


def _by_blocks(points: DataFrame, block_rows: int) -> DataFrame:
    """(at, cluster, w, other, sum) on any numbers: every point against every block."""
    blocks = max(1, -(-points.count() // block_rows))
    deal = f"cast(pmod(xxhash64(at), {blocks}) AS int)"
    every = f"explode(sequence(0, {blocks - 1}))"
    met = points.selectExpr("at", "x", "cluster", "w", "true AS asks", f"{deal} AS batch", f"{every} AS block").unionAll(
        points.selectExpr("at", "x", "cluster", "w", "false AS asks", f"{deal} AS block", f"{every} AS batch").select(
            "at", "x", "cluster", "w", "asks", "batch", "block"
        )
    )

    def run(group: pa.Table) -> pa.Table:
        asks = np.asarray(group["asks"])
        x = np.asarray(group["x"].combine_chunks().flatten(), np.float64).reshape(len(asks), -1)
        clusters, weights = np.asarray(group["cluster"].cast(pa.int64())), np.asarray(group["w"])
        names, member = np.unique(clusters[~asks], return_inverse=True)
        shares = np.zeros((int((~asks).sum()), len(names)))
        shares[np.arange(len(shares)), member] = weights[~asks]
        stored, asked = x[~asks], x[asks]
        sums = np.zeros((len(asked), len(names)))
        for at in range(0, len(asked), 256):  # differences, not products: near points lose no digits
            part = asked[at : at + 256]
            squares = np.zeros((len(part), len(stored)))
            for j in range(x.shape[1]):
                squares += (part[:, j, None] - stored[None, :, j]) ** 2
            sums[at : at + 256] = np.sqrt(squares) @ shares
        k = len(names)
        ids = np.asarray(group["at"])[asks]
        return pa.table(
            {
                "at": pa.array(np.repeat(ids, k)), "cluster": pa.array(np.repeat(clusters[asks], k)),
                "w": pa.array(np.repeat(weights[asks], k)), "other": pa.array(np.tile(names, len(ids))), "sum": pa.array(sums.ravel()),
            }
        )

    schema = "at bigint, cluster bigint, w double, other bigint, sum double"
    return met.groupBy("block", "batch").applyInArrow(run, schema).groupBy("at", "cluster", "w", "other").agg(F.sum("sum").alias("sum"))
