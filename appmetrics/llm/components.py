"""Connected components of a graph given as pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from appmetrics.functions.scratch import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has an edge to another; root is the smallest node reachable.

    Alternating large-star and small-star rounds: every node is re-linked to the least neighbour it knows,
    until all edges are stars around roots. The number of rounds grows with the logarithm of the longest
    chain. Minima are pre-aggregated before they are shuffled, the edges of a node with very many
    neighbours are split by adaptive skew joins (both join sides are plain scans), and each round is
    written to the shared folder, so a lost executor costs one round at most.

    Null ends and loops are ignored; repeated edges count once; no edges give no rows.
    """
    now = stage(
        edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
        .filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .selectExpr("greatest(a, b) AS a", "least(a, b) AS b")
        .distinct(),
        "edges",
    )
    before = _signature(now)
    while before[0]:
        both = now.unionAll(now.selectExpr("b AS a", "a AS b"))
        least = stage(both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) AS m"), "least")
        large = stage(
            both.join(least, "a").filter("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(),
            "large",
        )
        least = stage(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage(small.unionAll(least.selectExpr("a", "m AS b")).distinct(), "edges")
        after = _signature(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _signature(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges; one row to the driver."""
    row = edges.selectExpr("count(*) AS n", "sum(cast(xxhash64(a, b) AS decimal(20, 0))) AS s", "bit_xor(xxhash64(b, a)) AS x").first()
    return row["n"], row["s"], row["x"]
