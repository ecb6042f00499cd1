"""Clustering against brute force on small data."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from appmetrics.operators import clustering as K, density as D, silhouettes as S


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(c, 0.3, (60, 2)) for c in ((0, 0), (5, 5), (0, 6))])
    return spark.createDataFrame([tuple(map(float, p)) for p in points] + [(None, 1.0)], "x double, y double")


def test_lloyd(blobs):
    starts = [[0.0, 1.0], [1.0, 0.0], [6.0, 6.0]]
    found = K.lloyd(blobs, ["x", "y"], starts, max_iter=20)
    assert all(a >= b - 1e-9 for a, b in zip(found.costs, found.costs[1:]))
    same = K.lloyd(blobs, ["x", "y"], starts, max_iter=20, collapse=False)
    assert np.allclose(found.centers, same.centers)
    labelled = found.assign(blobs)
    assert labelled.filter("cluster IS NULL").count() == 1
    assert sum(r["rows"] for r in K.cluster_profile(labelled, ["x", "y"]).collect()) == 180


def test_empty_cluster_keeps_its_center(blobs):
    found = K.lloyd(blobs, ["x", "y"], [[0.0, 0.0], [1e6, 1e6]], max_iter=5)
    assert found.centers[1] == [1e6, 1e6]


def test_equal_distance_goes_to_the_first(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    assert K.Clusters(["x"], [[0.0], [2.0]]).assign(df).first()["cluster"] == 0


def test_plus_plus(blobs, spark):
    centers = K.kmeans_plus_plus(blobs, ["x", "y"], 3, seed=4)
    assert len(centers) == 3 and centers == K.kmeans_plus_plus(blobs.repartition(7), ["x", "y"], 3, seed=4)
    rows = {(r["x"], r["y"]) for r in blobs.collect()}
    assert all(tuple(c) in rows for c in centers)
    two = spark.createDataFrame([(1.0,), (1.0,), (2.0,)], "x double")
    assert sorted(K.kmeans_plus_plus(two, ["x"], 5, seed=1)) == [[1.0], [2.0]]


def test_sweeps(blobs):
    assert K.elbow(blobs, ["x", "y"], 8, seed=1).best == 3
    found = K.silhouette(blobs, ["x", "y"], 6, seed=1, scale=True)
    assert found.best == 3 and found.curve.count() == 4
    assert K.knee([(1, 100.0), (2, 20.0), (3, 10.0), (4, 5.0)]) == 2
    assert len(K.kmeans(blobs, ["x", "y"], 3, seed=1).centers) == 3


def brute_dbscan(points, distance, eps, min_points):
    n = len(points)
    near = [[j for j in range(n) if distance(points[i], points[j]) <= eps] for i in range(n)]
    core = [len(x) >= min_points for x in near]
    label = [None] * n
    clusters = 0
    for i in range(n):
        if core[i] and label[i] is None:
            todo = [i]
            while todo:
                k = todo.pop()
                if label[k] is None:
                    label[k] = clusters
                    todo += [j for j in near[k] if core[j]]
            clusters += 1
    reach = [{label[j] for j in near[i] if core[j]} for i in range(n)]
    return core, label, reach


def jaccard(x, y):
    both, either = sum(a & b for a, b in zip(x, y)), sum(a | b for a, b in zip(x, y))
    return 0.0 if either == 0 else 1 - both / either


def euclid(x, y):
    return math.dist(x, y)


@pytest.mark.parametrize("metric,eps,min_points,seed", [("jaccard", 0.5, 5, 0), ("jaccard", 0.34, 6, 1), ("euclidean", 1.0, 9, 2), ("jaccard", 0.0, 4, 3)])
def test_density_matches_brute_force(spark, metric, eps, min_points, seed):
    rng = random.Random(seed)
    width = 4
    weights = [rng.choice([0, 0, 1, 3, 8]) for _ in range(2**width)]
    points = [tuple((m >> i) & 1 for i in range(width)) for m in range(2**width) for _ in range(weights[m])]
    df = spark.createDataFrame(points, "a int, b int, c int, d int")
    columns = df.columns
    got = {tuple(r[c] for c in columns): r["cluster"] for r in D.density_clusters(df, columns, eps, min_points, metric).collect()}
    core, label, reach = brute_dbscan(points, {"jaccard": jaccard, "euclidean": euclid}[metric], eps, min_points)
    for (i, p), (j, q) in itertools.combinations(enumerate(points), 2):
        if core[i] and core[j]:
            assert (got[p] == got[q]) == (label[i] == label[j])
    names = {label[i]: got[p] for i, p in enumerate(points) if core[i]}
    for i, p in enumerate(points):
        if not core[i]:
            assert got[p] == (min(names[x] for x in reach[i]) if reach[i] else D.NOISE)

    clusters = D.pattern_clusters(df, columns, eps, min_points, metric)
    score = D.pattern_silhouette(clusters, width).first()[0]
    labels = [got[p] for p in points]
    if len(set(labels)) == 1:
        assert score is None
        return
    total = 0.0
    for i, p in enumerate(points):
        groups = {}
        for j, q in enumerate(points):
            if i != j:
                groups.setdefault(labels[j], []).append(euclid(p, q))
        if labels[i] not in groups:
            continue
        a = np.mean(groups.pop(labels[i]))
        b = min(np.mean(v) for v in groups.values())
        total += (b - a) / max(a, b) if max(a, b) else 0.0
    assert abs(score - total / len(points)) < 1e-9


@pytest.mark.parametrize("width,metric,eps", [(20, "jaccard", 0.4), (20, "euclidean", 1.5), (40, "jaccard", 0.6), (70, "euclidean", 2.3), (5, "jaccard", 1.0), (2, "euclidean", 2.0)])
def test_density_of_many_flags(spark, width, metric, eps):
    rng = random.Random(width)
    seeds = [[int(rng.random() < 0.3) for _ in range(width)] for _ in range(8)] + [[0] * width]
    points = []
    for _ in range(150):
        p = list(rng.choice(seeds))
        for i in rng.sample(range(width), rng.choice([0, 0, 1, 2])):
            p[i] ^= 1
        points.append(tuple(p))
    df = spark.createDataFrame([*points, (None,) + (0,) * (width - 1)], ", ".join(f"`c.{i}` int" for i in range(width)))
    columns = df.columns
    rows = D.density_clusters(df, columns, eps, 6, metric).collect()
    assert [r["cluster"] for r in rows if r["c.0"] is None] == [None]
    got = {tuple(r[c] for c in columns): r["cluster"] for r in rows if r["c.0"] is not None}
    core, label, reach = brute_dbscan(points, {"jaccard": jaccard, "euclidean": euclid}[metric], eps, 6)
    names = {}
    for p, c, l in zip(points, core, label):
        if c:
            assert names.setdefault(l, got[p]) == got[p]
    assert len(set(names.values())) == len(names)
    for p, c, r in zip(points, core, reach):
        if not c:
            assert got[p] == (min(names[x] for x in r) if r else D.NOISE)
    score = D.pattern_silhouette(D.pattern_clusters(df, columns, eps, 6, metric), width).first()[0]
    want = brute_silhouette(points, [got[p] for p in points])
    assert (score is None and want is None) or abs(score - want) < 1e-9


def brute_silhouette(points, labels):
    if len(set(labels)) < 2:
        return None
    points, labels = np.array(points, float), np.array(labels)
    gaps = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    total = 0.0
    for i in range(len(points)):
        mine = labels == labels[i]
        if mine.sum() == 1:
            continue
        a = gaps[i, mine].sum() / (mine.sum() - 1)
        b = min(gaps[i, labels == other].mean() for other in set(labels) - {labels[i]})
        total += (b - a) / max(a, b) if max(a, b) else 0.0
    return total / len(points)


@pytest.mark.parametrize("width,block_rows", [(1, 4096), (2, 4096), (2, 30), (3, 17)])
def test_plain_silhouettes_match_brute_force(spark, width, block_rows):
    rng = np.random.default_rng(width)
    points = np.round(rng.normal(size=(140, width)) * 3, 1)
    labels = [int(abs(p[0])) % 4 if i else 9 for i, p in enumerate(points)]  # one alone in its cluster
    rows = [(*map(float, p), int(l)) for p, l in zip(points, labels)] * 2 + [(None,) * width + (1,), (float("nan"),) * width + (1,)]
    rows = rows[1:]
    df = spark.createDataFrame(rows, ", ".join(f"x{i} double" for i in range(width)) + ", cluster long").repartition(6)
    found = S.euclidean_silhouette(S.silhouette_points(df, [f"x{i}" for i in range(width)]), width, block_rows).first()[0]
    assert abs(found - brute_silhouette([r[:-1] for r in rows[:-2]], [r[-1] for r in rows[:-2]])) < 1e-9


def test_silhouettes_without_a_second_cluster(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0)], "x double, cluster long")
    assert S.euclidean_silhouette(S.silhouette_points(df, ["x"]), 1).first()[0] is None
    none = df.limit(0).withColumn("y", F.col("x"))
    for names in (["x"], ["x", "y"]):
        assert S.euclidean_silhouette(S.silhouette_points(none, names), len(names)).first()[0] is None


def test_sweep_of_all_k_is_lloyd_of_each(blobs):
    starts = {k: [[0.0, 1.0], [1.0, 0.0], [6.0, 6.0], [2.0, 2.0]][:k] for k in (1, 2, 4)}
    points = K.weighted_points(blobs, ["x", "y"]).persist()
    found = K.lloyd_sweep(points, ["x", "y"], starts, max_iter=20)
    for k, centers in starts.items():
        alone = K.lloyd(blobs, ["x", "y"], centers, max_iter=20)
        assert np.allclose(found[k][0], alone.centers)
        assert abs(found[k][1] - K.lloyd_step(points, ["x", "y"], alone.centers)[1]) < 1e-6
    plain = K.plain_silhouette(blobs, ["x", "y"], 6, seed=1)
    assert plain.best == 3


def test_rows_with_nan_have_no_cluster(spark):
    df = spark.createDataFrame([(1.0,), (9.0,), (float("nan"),), (None,)], "x double")
    got = [r["cluster"] for r in K.Clusters(["x"], [[0.0], [10.0]]).assign(df).collect()]
    assert got == [0, 1, None, None]


def test_profile_of_counted_rows_is_that_of_the_rows(spark):
    rows = [(1, 2.0), (1, 2.0), (1, 2.5), (9, -1.0), (9, -1.0), (9, None), (None, 3.0), (8, float("nan"))]
    df = spark.createDataFrame(rows, "a bigint, b double")
    points = K.counted_rows(df, ["a", "b"])
    assert points.count() == 3
    found = K.kmeans(points, ["a", "b"], 2, centers=[[1.0, 2.0], [9.0, -1.0]])
    got = K.cluster_profile(found.assign(points), ["a", "b"])
    want = K.cluster_profile(found.assign(df), ["a", "b"])
    assert got.dtypes == want.dtypes
    assert [(r["rows"], r["min_a"], r["max_b"]) for r in want.orderBy("cluster").collect()] == [(3, 1, 2.5), (2, 9, -1.0)]
    for a, b in zip(got.orderBy("cluster").collect(), want.orderBy("cluster").collect()):
        assert tuple(a) == pytest.approx(tuple(b))


def test_registered_profile_parses_the_listings_once(spark, small):
    """Its last pass reads counted rows, not the tables again."""
    from __spark_entry__ import queries

    assert not any("lineitem" in f for f in queries()["kmeans_profile"](spark, small).inputFiles())
