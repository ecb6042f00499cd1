"""K-means: seeding, Lloyd iterations from given centers, sweeps over k, cluster profiles."""

from __future__ import annotations

from dataclasses import dataclass, field as attribute
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from appmetrics.functions.distance import nearest, nearest_cluster, squared_distance
from appmetrics.functions.parsing import complete_rows, field, missing_sql, quoted
from appmetrics.functions.scratch import stage
from appmetrics.operators.silhouettes import euclidean_silhouette
from appmetrics.schema import float_columns

WEIGHT = "_weight"


def weighted_points(df: DataFrame, features, collapse: bool = True) -> DataFrame:
    """Feature rows without missing values, with a weight.

    ``collapse`` groups equal rows into one with their count: the k-means objective is the same and the
    iterations then run over distinct points (a few dozen for ratings). Leave it off for features that
    are nearly unique, where the grouping would only add a shuffle.
    """
    weighted = [quoted(WEIGHT)] if WEIGHT in df.columns else []
    rows = complete_rows(df.selectExpr(*[f"cast({quoted(c)} AS double) AS {quoted(c)}" for c in features], *weighted))
    if weighted:  # points already
        return rows
    if collapse:
        return rows.groupBy(*[field(c) for c in features]).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT))
    return rows.withColumn(WEIGHT, F.lit(1.0))


def counted_rows(df: DataFrame, features) -> DataFrame:
    """Complete rows, equal ones once with their number as weight, in the columns' own types, written once.

    Seeding, iterations and profile then all read these: texts are parsed and tables joined once.
    """
    kept = complete_rows(df.select(*[field(c) for c in features]))
    return stage(kept.groupBy(*[field(c) for c in features]).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT)), "counted")


@dataclass
class Clusters:
    """Centers of a k-means run and how it got there."""

    features: list[str]
    centers: list[list[float]]
    iterations: int = 0
    costs: list[float] = attribute(default_factory=list)

    def assign(self, df: DataFrame, out: str = "cluster") -> DataFrame:
        """Add the index of the nearest center; null where a feature is missing (null or NaN)."""
        floats = set(float_columns(df))
        complete = " AND ".join(f"NOT {missing_sql(c, c in floats)}" for c in self.features)
        return df.withColumn(out, F.when(F.expr(complete), nearest_cluster(self.features, self.centers)))


def lloyd_step(points: DataFrame, features, centers) -> tuple[list[list[float]], float]:
    """Next centers and the cost of the given ones. A center without points stays where it is."""
    w = F.col(WEIGHT)
    placed = points.withColumn("_near", nearest(features, centers))
    rows = (
        placed.groupBy(F.col("_near.cluster").alias("cluster"))
        .agg(
            F.sum(w * F.col("_near.distance")).alias("cost"),
            *[(F.sum(w * field(c)) / F.sum(w)).alias(f"m{i}") for i, c in enumerate(features)],
        )
        .collect()
    )
    after = [list(map(float, c)) for c in centers]
    for r in rows:
        after[r["cluster"]] = [r[f"m{i}"] for i in range(len(features))]
    return after, sum(r["cost"] for r in rows)


def lloyd(df: DataFrame, features, centers, max_iter: int = 20, tolerance: float = 0.0, collapse: bool = True) -> Clusters:
    """Lloyd iterations from ``centers`` until none moves by more than ``tolerance`` (relative), or ``max_iter``.

    Only the k centers travel to the driver; each iteration is one aggregate over the cached points.
    """
    features = list(features)
    points = weighted_points(df, features, collapse).persist(StorageLevel.MEMORY_AND_DISK)
    found = Clusters(features, [list(map(float, c)) for c in centers])
    try:
        while found.iterations < max_iter:
            after, cost = lloyd_step(points, features, found.centers)
            moved = max(
                abs(a - b) / max(1.0, abs(b)) for x, y in zip(after, found.centers) for a, b in zip(x, y)
            )
            found.iterations += 1
            found.costs.append(cost)
            found.centers = after
            if moved <= tolerance:
                break
    finally:
        points.unpersist()
    return found


def centers_frame(df: DataFrame, found: Clusters) -> DataFrame:
    """(cluster, one column per feature)."""
    schema = "cluster int, " + ", ".join(f"`{c}` double" for c in found.features)
    return df.sparkSession.createDataFrame([(i, *c) for i, c in enumerate(found.centers)], schema)


def seeding_draw(features, seed: int) -> str:
    """SQL of a number in (0, 1) from an MD5 of seed and features (to 6 decimals); any SQL engine can repeat it."""
    parts = ", ".join(f"cast(cast(round({quoted(c)}, 6) AS decimal(38, 6)) AS string)" for c in features)
    return f"(cast(conv(left(md5(concat_ws('|', '{seed}', {parts})), 8), 16, 10) AS bigint) + 0.5D) / 4294967296.0D"


def kmeans_plus_plus(df: DataFrame, features, k: int, seed: int, collapse: bool = True) -> list[list[float]]:
    """K-means++ centers: each next one is drawn with probability proportional to its squared distance.

    Points carry their distance to the nearest center so far, so a round measures the new center only. The draw is
    the first arrival of an exponential race; ties go to the least features. Fewer than ``k`` centers come back
    if there are fewer distinct points.
    """
    features = list(features)
    points = stage(weighted_points(df, features, collapse).withColumn("_pull", F.lit(1.0)), "seeding")
    centers: list[list[float]] = []
    while len(centers) < k:
        arrival = F.expr(f"-ln({seeding_draw(features, seed + len(centers))}) / ({quoted(WEIGHT)} * _pull)")
        drawn = points.filter("_pull > 0").orderBy(arrival, *[field(c) for c in features]).limit(1).select(*[field(c) for c in features]).collect()
        if not drawn:
            break
        centers.append([float(v) for v in drawn[0]])
        if len(centers) < k:
            new = squared_distance(features, centers[-1])
            points = stage(points.withColumn("_pull", new if len(centers) == 1 else F.least("_pull", new)), "seeding")
    return centers


def _vectors(df: DataFrame, features, collapse: bool = True) -> DataFrame:
    points = weighted_points(df, features, collapse)
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(points).select("features", WEIGHT)


def kmeans(df: DataFrame, features, k: int = 3, seed: int = 0, centers=None, max_iter: int = 20, collapse: bool = True) -> Clusters:
    """K-means with given centers (Lloyd) or with parallel seeding."""
    features = list(features)
    if centers is not None:
        return lloyd(df, features, centers, max_iter, collapse=collapse)
    vectors = _vectors(df, features, collapse).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = KMeans(k=k, seed=seed, maxIter=max_iter, weightCol=WEIGHT).fit(vectors)
    finally:
        vectors.unpersist()
    return Clusters(features, [list(map(float, c)) for c in model.clusterCenters()], model.summary.numIter, [model.summary.trainingCost])


class Sweep(NamedTuple):
    """(k, score) rows and the chosen k."""

    curve: DataFrame
    best: int


def knee(scores: list[tuple[int, float]]) -> int:
    """The k farthest from the chord between the first and the last point of a cost curve."""
    (x0, y0), (x1, y1) = scores[0], scores[-1]
    height = (y0 - y1) or 1.0
    span = (x1 - x0) or 1

    def below_chord(point):
        x, y = point
        return (1 - (x - x0) / span) - (y - y1) / height

    return max(scores, key=lambda p: (below_chord(p), -p[0]))[0]


def _curve(df: DataFrame, scores, name: str) -> DataFrame:
    return df.sparkSession.createDataFrame(scores, f"k int, {name} double")


def lloyd_sweep(points: DataFrame, features, starts: dict[int, list], max_iter: int = 20) -> dict[int, tuple[list, float]]:
    """k -> (centers, cost) from the centers given for each k, until none moves or ``max_iter``.

    ``points`` are weighted points that are cheap to read again. One aggregate moves the centers of every k; a last
    one gives the costs.
    """
    features, w = list(features), F.col(WEIGHT)
    now = {k: [list(map(float, c)) for c in centers] for k, centers in starts.items()}

    def placed(ks):
        options = [F.struct(F.lit(k).alias("k"), nearest(features, now[k]).alias("near")) for k in ks]
        return points.select("*", F.explode(F.array(*options)).alias("_of")).select("*", "_of.k", "_of.near.cluster", "_of.near.distance")

    moving = sorted(now)
    for _ in range(max_iter):
        if not moving:
            break
        means = [(F.sum(w * field(c)) / F.sum(w)).alias(f"m{i}") for i, c in enumerate(features)]
        after = {k: [list(c) for c in now[k]] for k in moving}
        for r in placed(moving).groupBy("k", "cluster").agg(*means).collect():
            after[r["k"]][r["cluster"]] = [r[f"m{i}"] for i in range(len(features))]
        moving = [k for k in moving if after[k] != now[k]]
        now |= after
    costs = {r["k"]: r["cost"] for r in placed(sorted(now)).groupBy("k").agg(F.sum(w * F.col("distance")).alias("cost")).collect()}
    return {k: (now[k], float(costs.get(k, 0.0))) for k in now}


def _starts(df: DataFrame, features, max_clusters: int, seed: int, least: int) -> dict[int, list]:
    """The first k centers of one seeding, for each k: they are what a seeding of k would have drawn."""
    drawn = kmeans_plus_plus(df, features, max_clusters - 1, seed)
    return {k: drawn[:k] for k in range(least, len(drawn) + 1)}


def elbow(df: DataFrame, features, max_clusters: int = 10, seed: int = 0, collapse: bool = True, starts: dict[int, list] | None = None, max_iter: int = 20) -> Sweep:
    """Cost for k = 1 .. max_clusters - 1, and the knee of that curve.

    Centers start from ``starts`` (k -> centers) or from one k-means++ seeding; there are no k beyond the number
    of distinct points. Points are derived once, and all k move in one pass.
    """
    features = list(features)
    points = stage(weighted_points(df, features, collapse), "points")
    found = lloyd_sweep(points, features, starts or _starts(points, features, max_clusters, seed, 1), max_iter)
    scores = [(k, cost) for k, (_, cost) in sorted(found.items())]
    return Sweep(_curve(df, scores, "cost"), knee(scores))


def plain_silhouette(df: DataFrame, features, max_clusters: int = 10, seed: int = 0, scale: bool = False, starts: dict[int, list] | None = None) -> Sweep:
    """Silhouette with plain Euclidean distances for k = 2 .. max_clusters - 1, and the k with the highest.

    Exact: linear in the points for one feature, quadratic in the distinct points for more (see ``silhouettes``).
    """
    features = list(features)
    points = stage(_scaled(weighted_points(df, features), features) if scale else weighted_points(df, features), "points")
    found = lloyd_sweep(points, features, starts or _starts(points, features, max_clusters, seed, 2))
    x = F.array(*[field(c) for c in features])
    scores = []
    for k, (centers, _) in sorted(found.items()):
        placed = points.select(x.alias("x"), nearest_cluster(features, centers).cast("bigint").alias("cluster"), F.col(WEIGHT).alias("w"))
        score = euclidean_silhouette(placed, len(features)).first()[0]
        if score is not None:
            scores.append((k, float(score)))
    return Sweep(_curve(df, scores, "score"), max(scores, key=lambda p: (p[1], -p[0]))[0])


def _scaled(points: DataFrame, features) -> DataFrame:
    """Weighted points with each feature divided by its deviation over the rows."""
    w = F.col(WEIGHT)
    n = F.sum(w)
    spread = [
        F.sqrt((F.sum(w * field(c) * field(c)) - F.sum(w * field(c)) * F.sum(w * field(c)) / n) / (n - 1)).alias(f"s{i}")
        for i, c in enumerate(features)
    ]
    deviations = [float(s) or 1.0 for s in points.agg(*spread).first()]
    return points.withColumns({c: field(c) / F.lit(s) for c, s in zip(features, deviations)})


def silhouette(df: DataFrame, features, max_clusters: int = 10, seed: int = 0, scale: bool = False, collapse: bool = True) -> Sweep:
    """Silhouette (squared Euclidean) for k = 2 .. max_clusters - 1, and the k with the highest.

    ``scale`` divides each feature by its deviation first. A point's score here uses squared distances,
    which makes it linear in the rows; values differ from the plain Euclidean score (``plain_silhouette``).
    """
    features = list(features)
    raw = stage(weighted_points(df, features, collapse), "points")
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    points = assembler.transform(_scaled(raw, features) if scale else raw).select("features", WEIGHT).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        judge = ClusteringEvaluator(metricName="silhouette", distanceMeasure="squaredEuclidean", weightCol=WEIGHT)
        distinct = points.count()
        scores = []
        for k in range(2, max_clusters):
            if k > distinct:
                break
            predicted = KMeans(k=k, seed=seed, weightCol=WEIGHT).fit(points).transform(points)
            scores.append((k, float(judge.evaluate(predicted))))
    finally:
        points.unpersist()
    return Sweep(_curve(df, scores, "score"), max(scores, key=lambda p: (p[1], -p[0]))[0])


def cluster_profile(df: DataFrame, features, cluster: str = "cluster") -> DataFrame:
    """Rows, mean, minimum and maximum of each feature per cluster; weighted points count as the rows they stand for."""
    if WEIGHT in df.columns:
        w = F.col(WEIGHT)
        rows, mean = F.sum(w).cast("bigint"), lambda c: F.sum(w * c) / F.sum(w)
    else:
        rows, mean = F.count(F.lit(1)), F.avg
    measures = [make(field(c)).alias(f"{name}_{c}") for c in features for name, make in (("mean", mean), ("min", F.min), ("max", F.max))]
    return df.filter(field(cluster).isNotNull()).groupBy(field(cluster)).agg(rows.alias("rows"), *measures)


def rounded_means(df: DataFrame, cluster: str = "cluster", rating="Rating", installs="Maximum Installs", size="Size") -> DataFrame:
    """Cluster means for reading: rating to 2 decimals, whole installs, size in megabytes to 2 decimals."""
    return (
        df.filter(field(cluster).isNotNull())
        .groupBy(field(cluster))
        .agg(
            F.round(F.avg(field(rating)), 2).alias("rating"),
            F.floor(F.avg(field(installs))).cast("bigint").alias("installs"),
            F.round(F.avg(field(size)) / 1e6, 2).alias("megabytes"),
            F.count(F.lit(1)).alias("rows"),
        )
    )
