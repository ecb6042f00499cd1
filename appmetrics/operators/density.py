"""Exact density clustering of 0/1 columns.

Rows with equal flags are at distance 0, so clustering the distinct flag patterns with their row counts gives the
same clusters as clustering the rows: the only work over the data is one group-by on the pattern. Neighbours
are found among the patterns that occur, by a join on what near patterns must share, so any number of flags will do.
"""

from __future__ import annotations

from math import floor

from pyspark.sql import Column, DataFrame, Window, functions as F

from appmetrics.functions.parsing import quoted
from appmetrics.functions.scratch import stage
from appmetrics.operators.ranking import running_totals
from appmetrics.operators.silhouettes import euclidean_silhouette

NOISE = -1


def pattern_mask(columns) -> Column:
    """0/1 columns as one value; null if any is null.

    The bits of an int, or of a bigint from 32 flags on; a text of 0 and 1 from 64 on.
    """
    columns = list(columns)
    if len(columns) > 63:
        return F.expr("concat(" + ", ".join(f"cast(cast({quoted(c)} AS int) AS string)" for c in columns) + ")")
    kind = "int" if len(columns) < 32 else "bigint"
    return F.expr(" + ".join(f"cast({quoted(c)} AS {kind}) * {1 << i}{'L' * (kind == 'bigint')}" for i, c in enumerate(columns)))


def _set_bits(columns) -> Column:
    """The numbers of the flags that are 1."""
    return F.expr("array_compact(array(" + ", ".join(f"CASE WHEN cast({quoted(c)} AS int) = 1 THEN {i} END" for i, c in enumerate(columns)) + "))")


def _patterns(df: DataFrame, columns) -> DataFrame:
    """(mask, bits, rows) of the patterns that occur."""
    if not columns:
        raise ValueError("need a flag column")
    rows = df.select(pattern_mask(columns).alias("mask"), _set_bits(columns).alias("bits")).filter("mask IS NOT NULL")
    return rows.groupBy("mask").agg(F.first("bits").alias("bits"), F.count(F.lit(1)).alias("rows"))


def _shared_jaccard(patterns: DataFrame, eps: float) -> DataFrame:
    """(mask, bits, rows, token): patterns at Jaccard distance ``eps`` or less share a token.

    With bits in one order, rarest first, patterns that are so alike share one of their first
    n - ceil((1 - eps) n) + 1 bits (n: set bits). Patterns without bits are at distance 0 from each other only.
    """
    rarity = patterns.select(F.explode("bits").alias("bit")).groupBy("bit").agg(F.count(F.lit(1)).alias("n"))
    placed = patterns.select("mask", F.explode("bits").alias("bit")).join(rarity, "bit")
    number = F.row_number().over(Window.partitionBy("mask").orderBy("n", "bit"))  # a pattern has as many as flags
    # A hair more than the bound, so that rounding loses no pair; the distance itself decides.
    length = F.expr(f"size(bits) - cast(ceil({1.0 - eps!r}D * size(bits) - 1e-9) AS int) + 1")
    first = placed.withColumn("place", number).join(patterns, "mask").filter(F.col("place") <= length)
    return first.selectExpr("mask", "bits", "rows", "bit AS token").unionAll(patterns.filter("size(bits) = 0").selectExpr("mask", "bits", "rows", "-1 AS token"))


def _shared_segments(patterns: DataFrame, apart: int, width: int) -> DataFrame:
    """(mask, bits, rows, token): patterns that differ in ``apart`` flags or fewer share a token.

    Cut into one segment more than there are differences, one segment of two such patterns is equal.
    """
    segments = apart + 1
    part = f"array_join(transform(filter(bits, b -> b div {-(-width // segments)} = s), b -> cast(b AS string)), ',')"
    tokens = f"explode(transform(sequence(0, {segments - 1}), s -> concat(s, ':', {part})))"
    return patterns.selectExpr("mask", "bits", "rows", f"{tokens} AS token")


def _neighbours(patterns: DataFrame, width: int, eps: float, metric: str) -> DataFrame:
    """(mask, rows, other, other_rows): patterns within ``eps`` of each other, each itself included."""
    both = "size(array_intersect(bits, other_bits))"
    if metric == "jaccard":
        distance = f"CASE WHEN size(bits) + size(other_bits) = 0 THEN 0D ELSE 1D - {both} / (size(bits) + size(other_bits) - {both}) END"
        everything = eps >= 1
        tokens = None if everything else _shared_jaccard(patterns, eps)
    elif metric == "euclidean":
        distance = f"sqrt(cast(size(bits) + size(other_bits) - 2 * {both} AS double))"
        apart = floor(eps * eps + 1e-9)
        everything = apart >= width
        tokens = None if everything else _shared_segments(patterns, apart, width)
    else:
        raise ValueError(f"no such metric: {metric}")
    if everything:  # so wide a reach asks for all pairs of patterns: they share one token
        tokens = patterns.withColumn("token", F.lit(0))
    tokens = stage(tokens, "tokens")
    other = tokens.select("token", F.col("mask").alias("other"), F.col("bits").alias("other_bits"), F.col("rows").alias("other_rows"))
    near = tokens.join(other, "token").filter(f"{distance} <= {float(eps)!r}D")
    return near.select("mask", "rows", "other", "other_rows").distinct()


def pattern_clusters(df: DataFrame, columns, eps: float = 0.5, min_points: int = 5, metric: str = "jaccard") -> DataFrame:
    """(mask, rows, core, cluster) per distinct pattern. Clusters count from 0; noise is -1.

    A pattern is core if the rows within ``eps`` (itself included) number at least ``min_points``.
    A border pattern joins the lowest cluster that reaches it. No rows give no patterns.
    """
    columns = list(columns)
    patterns = stage(_patterns(df, columns), "patterns")
    near = stage(_neighbours(patterns, len(columns), eps, metric), "neighbours")
    density = near.groupBy("mask", "rows").agg((F.sum("other_rows") >= min_points).alias("core"))
    core = density.filter("core").select("mask")
    links = stage(
        near.join(core, "mask", "left_semi")
        .join(core.withColumnRenamed("mask", "other"), "other", "left_semi")
        .select("mask", "other"),
        "links",
    )

    # Smallest reachable mask per core pattern. Each round also jumps to the label's own label.
    labels = core.withColumn("label", F.col("mask"))
    while True:
        spread = (
            links.join(labels.withColumnRenamed("mask", "other"), "other").groupBy("mask").agg(F.min("label").alias("label"))
        )
        jump = spread.select(F.col("mask").alias("label"), F.col("label").alias("further"))
        after = stage(
            spread.join(jump, "label", "left").select("mask", F.least("label", F.coalesce("further", "label")).alias("label")),
            "labels",
        )
        changed = after.join(labels.withColumnRenamed("label", "before"), "mask").filter(F.col("label") != F.col("before"))
        done = changed.isEmpty()
        labels = after
        if done:
            break

    # Cluster numbers in order of their smallest pattern.
    numbered = running_totals(labels.select("label").distinct(), ["label"], out="number").selectExpr("label", "cast(number - 1 AS int) AS cluster")
    clusters = stage(labels.join(numbered, "label").select(F.col("mask").alias("other"), "cluster"), "clusters")
    reached = near.join(clusters, "other").groupBy("mask").agg(
        F.min("cluster").alias("lowest"), F.max(F.when(F.col("mask") == F.col("other"), F.col("cluster"))).alias("own")
    )
    return density.join(reached, "mask", "left").select(
        "mask", "rows", "core", F.coalesce("own", "lowest", F.lit(NOISE)).alias("cluster")
    )


def density_clusters(df: DataFrame, columns, eps: float = 0.5, min_points: int = 5, metric: str = "jaccard", out: str = "cluster") -> DataFrame:
    """The rows with their cluster (null where a flag is null)."""
    found = pattern_clusters(df, columns, eps, min_points, metric)
    labels = found.select(F.col("mask").alias("_mask"), F.col("cluster").alias(out))
    return df.withColumn("_mask", pattern_mask(list(columns))).join(labels, "_mask", "left").drop("_mask")


def pattern_silhouette(clusters: DataFrame, width: int) -> DataFrame:
    """One row: mean Euclidean silhouette over all rows of the clustered patterns; noise counts as a cluster.

    ``width`` is the number of flags. Null if there is only one cluster. A row alone in its cluster scores 0.
    """
    if width > 63:
        flags = "transform(split(mask, ''), b -> cast(b AS double))"
    else:
        flags = f"transform(sequence(0, {width - 1}), i -> cast(shiftright(mask, i) & 1 AS double))"
    points = clusters.selectExpr(f"{flags} AS x", "cluster", "rows AS w")
    # Two numbers at least, so that 0/1 flags take the way of blocks.
    return euclidean_silhouette(points, max(width, 2))
