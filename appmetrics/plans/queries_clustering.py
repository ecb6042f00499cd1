"""Registered clustering queries."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from appmetrics.functions.distance import euclidean
from appmetrics.operators import clustering as K, density as D, features as E, silhouettes as S
from appmetrics.plans.catalog import CATALOG, SIZE_SQL, listing_sql, rounded
from appmetrics.plans.preparation import flag_listings, kmeans_listings, lloyd_listings
from appmetrics.sources.listing_view import listings

_FEATURES = ["Rating", "Maximum Installs", "Size"]
_CENTERS = [[1.0, 50_000.0, 5e6], [3.0, 300_000.0, 2e7], [4.0, 800_000.0, 1.2e9]]
_POINTS = f"""points AS MATERIALIZED (SELECT "Rating" AS f0, "Maximum Installs"::DOUBLE AS f1, {SIZE_SQL} AS f2, count(*)::DOUBLE AS w
FROM apps WHERE "Size" <> 'Varies with device' AND {SIZE_SQL} IS NOT NULL AND "Rating" IS NOT NULL AND "Maximum Installs" IS NOT NULL
GROUP BY ALL)"""
_RATINGS = 'points AS MATERIALIZED (SELECT "Rating" AS f0, count(*)::DOUBLE AS w FROM apps WHERE "Rating" IS NOT NULL GROUP BY ALL)'


def _nearest_sql(width: int, k: int) -> str:
    """Index of the closest center, given one row c with columns c<center>_<feature>."""
    d = ["(" + " + ".join(f"pow(f{j} - c{i}_{j}, 2)" for j in range(width)) + ")" for i in range(k)]
    cases = " ".join(f"WHEN {d[i]} <= least({', '.join(d)}) THEN {i}" for i in range(k))
    return f"CASE {cases} END"


def _lloyd_ctes(points: str, centers, steps: int) -> list[str]:
    """Chained CTEs s0 .. s<steps>, each one row of centers."""
    k, width = len(centers), len(centers[0])
    out = [points]
    start = ", ".join(f"{v!r}::DOUBLE AS c{i}_{j}" for i, c in enumerate(centers) for j, v in enumerate(c))
    out.append(f"s0 AS MATERIALIZED (SELECT {start})")
    for step in range(steps):
        means = ", ".join(
            f"""coalesce(sum(f{j} * w) FILTER (near = {i}) / sum(w) FILTER (near = {i}), any_value(c{i}_{j})) AS c{i}_{j}"""
            for i in range(k)
            for j in range(width)
        )
        out.append(
            f"s{step + 1} AS MATERIALIZED (SELECT {means} FROM (SELECT *, {_nearest_sql(width, k)} AS near FROM points, s{step}))"
        )
    return out


def _centers_sql(step: int, k: int, names) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS cluster, "
        + ", ".join(f'round(c{i}_{j}, 2) AS "{name}"' for j, name in enumerate(names))
        + f" FROM s{step}"
        for i in range(k)
    )


def _lloyd_frame(spark, sf_dir):
    return lloyd_listings(listings(spark, sf_dir, "Rating", "Maximum Installs", "Size", busy=True))


@CATALOG.add(
    "CL-1",
    sql=listing_sql(
        f"""SELECT near AS cluster, count(*) AS rows, round(sum(d), 2) AS distance FROM (
        SELECT CAST({_nearest_sql(3, 3)} AS INTEGER) AS near, sqrt(pow(f0 - f1 / 1e6, 2)) AS d, unnest(range(w::BIGINT)) FROM points, s0)
        GROUP BY 1""",
        *_lloyd_ctes(_POINTS, _CENTERS, 0),
    ),
)
def nearest_centers(spark, sf_dir):
    found = K.Clusters(_FEATURES, _CENTERS)
    df = found.assign(_lloyd_frame(spark, sf_dir)).withColumn("millions", F.col("Maximum Installs") / 1e6)
    gap = euclidean(["Rating"], ["millions"])
    return rounded(df.groupBy("cluster").agg(F.count(F.lit(1)).alias("rows"), F.sum(gap).alias("distance")), "distance", digits=2)


@CATALOG.add("CL-5", "FLT-2", sql=listing_sql(_centers_sql(3, 3, _FEATURES), *_lloyd_ctes(_POINTS, _CENTERS, 3)))
def lloyd_three_rounds(spark, sf_dir):
    df = _lloyd_frame(spark, sf_dir)
    return rounded(K.centers_frame(df, K.lloyd(df, _FEATURES, _CENTERS, max_iter=3)), *_FEATURES, digits=2)


@CATALOG.add("CL-5", "FLT-2", sql=listing_sql(_centers_sql(20, 3, _FEATURES), *_lloyd_ctes(_POINTS, _CENTERS, 20)))
def lloyd_to_the_end(spark, sf_dir):
    """Until the centers repeat, 20 rounds at most."""
    df = _lloyd_frame(spark, sf_dir)
    return rounded(K.centers_frame(df, K.lloyd(df, _FEATURES, _CENTERS, max_iter=20)), *_FEATURES, digits=2)


_STARTS = [[0.0], [2.0], [3.0], [4.5]]


@CATALOG.add("CL-6", sql=listing_sql(_centers_sql(20, 4, ["Rating"]), *_lloyd_ctes(_RATINGS, _STARTS, 20)))
def lloyd_on_ratings(spark, sf_dir):
    df = listings(spark, sf_dir, "Rating")
    return rounded(K.centers_frame(df, K.lloyd(df, ["Rating"], _STARTS, max_iter=20)), "Rating", digits=2)


@CATALOG.add(
    "CL-7",
    sql=listing_sql(
        f"""SELECT CAST({_nearest_sql(3, 3)} AS INTEGER) AS cluster, round(sum(f0 * w) / sum(w), 2) AS rating,
        CAST(floor(sum(f1 * w) / sum(w)) AS BIGINT) AS installs, round(sum(f2 * w) / sum(w) / 1e6, 2) AS megabytes,
        CAST(sum(w) AS BIGINT) AS rows FROM points, s3 GROUP BY 1""",
        *_lloyd_ctes(_POINTS, _CENTERS, 3),
    ),
)
def cluster_means(spark, sf_dir):
    df = _lloyd_frame(spark, sf_dir)
    return K.rounded_means(K.lloyd(df, _FEATURES, _CENTERS, max_iter=3).assign(df))


@CATALOG.add(
    "CL-7",
    sql=listing_sql(
        f"""SELECT CAST({_nearest_sql(3, 3)} AS INTEGER) AS cluster, round(sum(f0 * w) / sum(w), 2) AS rating,
        CAST(floor(sum(f1 * w) / sum(w)) AS BIGINT) AS installs, round(sum(f2 * w) / sum(w) / 1e6, 2) AS megabytes,
        CAST(sum(w) AS BIGINT) AS rows FROM points, s20 GROUP BY 1""",
        *_lloyd_ctes(_POINTS, _CENTERS, 20),
    ),
)
def cluster_means_at_the_end(spark, sf_dir):
    df = _lloyd_frame(spark, sf_dir)
    return K.rounded_means(K.lloyd(df, _FEATURES, _CENTERS, max_iter=20).assign(df))


_PROFILE = ", ".join(
    f"""round(sum({v} * w) / sum(w), 2) AS "mean_{c}", min({v}) AS "min_{c}", max({v}) AS "max_{c}\"""" for v, c in zip(("f0", "f1", "f2"), _FEATURES)
)


@CATALOG.add(
    "CL-3",
    "CL-13",
    sql=listing_sql(
        f"SELECT CAST({_nearest_sql(3, 3)} AS INTEGER) AS cluster, CAST(sum(w) AS BIGINT) AS rows, {_PROFILE} FROM points, s20 GROUP BY 1",
        *_lloyd_ctes(_POINTS, _CENTERS, 20),
    ),
)
def kmeans_profile_from_given_centers(spark, sf_dir):
    df = _lloyd_frame(spark, sf_dir)
    found = K.kmeans(df, _FEATURES, 3, centers=_CENTERS, max_iter=20)
    doubles = found.assign(df).withColumns({c: F.col(c).cast("double") for c in _FEATURES})
    return rounded(K.cluster_profile(doubles, _FEATURES), *[f"mean_{c}" for c in _FEATURES], digits=2)


@CATALOG.add(
    "CL-8",
    sql=listing_sql(
        """SELECT round("Rating", 4) AS "Rating", round("Rating" / (SELECT stddev_samp("Rating") FROM apps), 4) AS "Rating_scaled",
        count(*) AS rows FROM apps WHERE "Rating" IS NOT NULL GROUP BY ALL"""
    ),
)
def scaled_ratings(spark, sf_dir):
    df = listings(spark, sf_dir, "Rating").filter(F.col("Rating").isNotNull())
    scaled = rounded(E.scale_columns(df, ["Rating"]), "Rating", "Rating_scaled")
    return scaled.groupBy("Rating", "Rating_scaled").agg(F.count(F.lit(1)).alias("rows"))


# ---- seeded searches: results depend on random draws, so there is no SQL form ----

_SHAPE = ["Size", "Installs", "Rating"]


def _shape_frame(spark, sf_dir, rating_value=False):
    columns = ["Size", "Installs", "Rating", "Rating Count", "Minimum Android"]
    return kmeans_listings(listings(spark, sf_dir, *columns, busy=True), rating_value)


def _seed_ctes(k: int, width: int, seed: int) -> list[str]:
    """c0 .. c<k-1>, one row each: points (f0.., w) raced by their weighted squared distance to the nearest center so far."""
    parts = ", ".join(f"CAST(CAST(round(f{j}, 6) AS DECIMAL(38, 6)) AS VARCHAR)" for j in range(width))
    names = ", ".join(f"f{j}" for j in range(width))
    ctes = ["p0 AS MATERIALIZED (SELECT *, 1.0::DOUBLE AS pull FROM points)"]
    for i in range(k):
        draw = f"(('0x' || left(md5(concat_ws('|', '{seed + i}', {parts})), 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE"
        ctes.append(f"c{i} AS MATERIALIZED (SELECT {names} FROM p{i} WHERE pull > 0 ORDER BY -ln({draw}) / (w * pull), {names} LIMIT 1)")
        new = " + ".join(f"pow(p.f{j} - c.f{j}, 2)" for j in range(width))
        ctes.append(f"p{i + 1} AS MATERIALIZED (SELECT p.* REPLACE ({new if i == 0 else f'least(p.pull, {new})'} AS pull) FROM p{i} AS p, c{i} AS c)")
    return ctes


@CATALOG.add(
    "CL-2",
    "SMP-5",
    sql=listing_sql(
        " UNION ALL ".join(
            f'SELECT {i} AS cluster, round(f0, 4) AS "Rating", round(f1, 4) AS "Maximum Installs", round(f2, 4) AS "Size" FROM c{i}' for i in range(4)
        ),
        _POINTS,
        *_seed_ctes(4, 3, 1),
    ),
)
def seeded_centers(spark, sf_dir):
    """Four centers drawn one by one, each by its distance to those before it."""
    df = _lloyd_frame(spark, sf_dir)
    return rounded(K.centers_frame(df, K.Clusters(_FEATURES, K.kmeans_plus_plus(df, _FEATURES, 4, seed=1))), *_FEATURES)


_SWEEP = {k: _STARTS[:k] for k in range(1, 5)}


def _sweep_ctes(steps: int) -> list[str]:
    """The steps of every k, one after the other: k<k>s<step>."""
    ctes = [_RATINGS]
    for k, centers in _SWEEP.items():
        ctes += [c.replace("s0 AS", f"k{k}s0 AS", 1) if c.startswith("s0") else re.sub(r"\bs(\d+)\b", rf"k{k}s\1", c) for c in _lloyd_ctes(_RATINGS, centers, steps)[1:]]
    return ctes


def _cost_sql(k: int, step: int) -> str:
    least = "least(" + ", ".join(f"pow(f0 - c{i}_0, 2)" for i in range(k)) + ")" if k > 1 else "pow(f0 - c0_0, 2)"
    return f"SELECT {k} AS k, round(sum(w * {least}), 2) AS cost FROM points, k{k}s{step}"


@CATALOG.add("CL-4", sql=listing_sql(" UNION ALL ".join(_cost_sql(k, 20) for k in _SWEEP), *_sweep_ctes(20)))
def elbow_from_given_centers(spark, sf_dir):
    found = K.elbow(listings(spark, sf_dir, "Rating"), ["Rating"], starts=_SWEEP, max_iter=20)
    return rounded(found.curve, "cost", digits=2)


def _silhouette_sql(width: int, clusters: str) -> str:
    """Mean score from all pairs of the distinct points of ``clusters`` (f0.., w, cluster)."""
    gap = " + ".join(f"pow(x.f{j} - y.f{j}, 2)" for j in range(width))
    names = ", ".join(f"x.f{j}" for j in range(width))
    return f"""SELECT round(sum(w * CASE WHEN size = 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END) / sum(w), 4) AS silhouette FROM (
    SELECT any_value(w) AS w, max(size) FILTER (own) AS size, max(d / nullif(size - 1, 0)) FILTER (own) AS a, min(d / size) FILTER (NOT own) AS b FROM (
      SELECT {names}, x.cluster, x.w, x.cluster = y.cluster AS own, sum(y.w) AS size, sum(y.w * sqrt({gap})) AS d
      FROM {clusters} AS x, {clusters} AS y GROUP BY {names}, x.cluster, x.w, y.cluster) GROUP BY {names.replace("x.", "")}, cluster)"""


@CATALOG.add(
    "CL-9",
    "CL-10",
    sql=listing_sql(
        _silhouette_sql(1, "placed"),
        *_lloyd_ctes(_RATINGS, _STARTS, 20),
        f"placed AS MATERIALIZED (SELECT f0, w, CAST({_nearest_sql(1, 4)} AS BIGINT) AS cluster FROM points, s20)",
    ),
)
def rating_silhouette(spark, sf_dir):
    """Plain Euclidean silhouette of the ratings' clusters."""
    df = listings(spark, sf_dir, "Rating")
    placed = K.lloyd(df, ["Rating"], _STARTS, max_iter=20).assign(df)
    return rounded(S.euclidean_silhouette(S.silhouette_points(placed, ["Rating"]), 1), "silhouette")


@CATALOG.add(
    "CL-10",
    sql=listing_sql(
        _silhouette_sql(2, "placed"),
        """placed AS MATERIALIZED (SELECT "Rating" AS f0, CAST("Free" AS INTEGER)::DOUBLE AS f1, CAST(floor("Rating") AS BIGINT) AS cluster, count(*)::DOUBLE AS w
        FROM apps WHERE "Rating" IS NOT NULL AND "Free" IS NOT NULL GROUP BY ALL)""",
    ),
)
def stars_silhouette(spark, sf_dir):
    """How well whole stars part the listings by rating and price flag."""
    df = listings(spark, sf_dir, "Rating", "Free").selectExpr("Rating", "cast(Free AS int) AS Free", "cast(floor(Rating) AS bigint) AS stars")
    return rounded(S.euclidean_silhouette(S.silhouette_points(df, ["Rating", "Free"], "stars"), 2), "silhouette")


@CATALOG.add("CL-10")
def rating_silhouettes_plain(spark, sf_dir):
    found = K.plain_silhouette(listings(spark, sf_dir, "Rating"), ["Rating"], 10, seed=1)
    return found.curve.withColumn("best", F.col("k") == found.best)


@CATALOG.add("CL-2", "SMP-5")
def kmeans_plus_plus_centers(spark, sf_dir):
    df = _shape_frame(spark, sf_dir)
    return K.centers_frame(df, K.Clusters(_SHAPE, K.kmeans_plus_plus(df, _SHAPE, 3, seed=1)))


@CATALOG.add("CL-3", "CL-13")
def kmeans_profile(spark, sf_dir):
    points = K.counted_rows(_shape_frame(spark, sf_dir), _SHAPE)
    found = K.kmeans(points, _SHAPE, 3, centers=K.kmeans_plus_plus(points, _SHAPE, 3, seed=1))
    return K.cluster_profile(found.assign(points), _SHAPE)


@CATALOG.add("CL-3", "CL-13")
def kmeans_profile_with_rating_value(spark, sf_dir):
    names = ["Size", "Installs", "Rating_Value"]
    df = _shape_frame(spark, sf_dir, rating_value=True)
    # The seeding, so the numbers of the clusters, depend on where points lie: the fit takes the rows as they come.
    return K.cluster_profile(K.kmeans(df, names, 3, seed=1).assign(K.counted_rows(df, names)), names)


@CATALOG.add("CL-4")
def elbow_curve(spark, sf_dir):
    found = K.elbow(_shape_frame(spark, sf_dir), _SHAPE, 10, seed=1)
    return found.curve.withColumn("knee", F.col("k") == found.best)


@CATALOG.add("CL-9", "CL-8")
def rating_silhouettes(spark, sf_dir):
    found = K.silhouette(listings(spark, sf_dir, "Rating"), ["Rating"], 10, seed=1, scale=True)
    return found.curve.withColumn("best", F.col("k") == found.best)


@CATALOG.add("CL-9")
def rating_clusters(spark, sf_dir):
    df = listings(spark, sf_dir, "Rating")
    return K.cluster_profile(K.kmeans(df, ["Rating"], 3, seed=1).assign(df), ["Rating"])


@CATALOG.add("CL-10")
def listing_silhouettes(spark, sf_dir):
    found = K.silhouette(_shape_frame(spark, sf_dir), _SHAPE, 10, seed=1)
    return found.curve.withColumn("best", F.col("k") == found.best)


# ---- density clusters of flags ----

_FLAGS = ["Ad Supported", "In App Purchases", "Free"]


def _pattern_ctes(eps: float, min_points: int) -> list[str]:
    return [
        """patterns AS MATERIALIZED (SELECT CAST("Ad Supported" = 'True' AS INTEGER) + 2 * CAST("In App Purchases" = 'True' AS INTEGER)
        + 4 * CAST("Free" AS INTEGER) AS mask, count(*) AS rows FROM apps WHERE "Ad Supported" IN ('True', 'False') GROUP BY 1)""",
        f"""near AS MATERIALIZED (SELECT x.mask AS mask, y.mask AS other, y.rows AS other_rows FROM patterns x, patterns y
        WHERE CASE WHEN x.mask | y.mask = 0 THEN 0 ELSE 1 - bit_count(x.mask & y.mask)::DOUBLE / bit_count(x.mask | y.mask) END <= {eps})""",
        f"density AS MATERIALIZED (SELECT mask, sum(other_rows) >= {min_points} AS core FROM near GROUP BY 1)",
        """reach AS (SELECT mask, mask AS other FROM density WHERE core UNION
        SELECT r.mask, n.other FROM reach r JOIN near n ON n.mask = r.other JOIN density d ON d.mask = n.other AND d.core)""",
        "roots AS (SELECT mask, min(other) AS root FROM reach GROUP BY 1)",
        "numbered AS (SELECT mask, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS cluster FROM roots)",
        """clusters AS MATERIALIZED (SELECT p.mask, p.rows, d.core, coalesce(
          (SELECT cluster FROM numbered m WHERE m.mask = p.mask),
          (SELECT min(m.cluster) FROM near n JOIN numbered m ON m.mask = n.other WHERE n.mask = p.mask), -1) AS cluster
        FROM patterns p JOIN density d ON d.mask = p.mask)""",
    ]


def _flags(spark, sf_dir):
    return flag_listings(listings(spark, sf_dir, *_FLAGS), _FLAGS)


@CATALOG.add("CL-11", "SCA-9", sql=listing_sql("SELECT * FROM clusters", *_pattern_ctes(0.5, 5)))
def flag_pattern_clusters(spark, sf_dir):
    return D.pattern_clusters(_flags(spark, sf_dir), _FLAGS)


@CATALOG.add("CL-11", sql=listing_sql("SELECT * FROM clusters", *_pattern_ctes(0.4, 20000)))
def flag_pattern_clusters_dense_only(spark, sf_dir):
    return D.pattern_clusters(_flags(spark, sf_dir), _FLAGS, eps=0.4, min_points=20000)


@CATALOG.add(
    "CL-11",
    sql=listing_sql(
        """SELECT cluster, mask & 1 AS "Ad Supported", (mask >> 1) & 1 AS "In App Purchases", (mask >> 2) & 1 AS "Free",
        CAST(sum(rows) AS BIGINT) AS rows FROM clusters GROUP BY ALL""",
        *_pattern_ctes(0.5, 5),
    ),
)
def listings_by_flag_cluster(spark, sf_dir):
    df = D.density_clusters(_flags(spark, sf_dir), _FLAGS)
    return df.groupBy("cluster", *_FLAGS).agg(F.count(F.lit(1)).alias("rows"))


@CATALOG.add(
    "CL-12",
    sql=listing_sql(
        """SELECT round(sum(rows * CASE WHEN size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END) / sum(rows), 4) AS silhouette FROM (
        SELECT mask, any_value(rows) AS rows, max(size) FILTER (own) AS size, max(d / (size - 1)) FILTER (own) AS a, min(d / size) FILTER (NOT own) AS b
        FROM (SELECT x.mask, x.rows, x.cluster = y.cluster AS own, y.cluster AS c, sum(y.rows)::DOUBLE AS size,
              sum(y.rows * sqrt(bit_count(xor(x.mask, y.mask)))) AS d FROM clusters x, clusters y GROUP BY ALL) GROUP BY mask)""",
        *_pattern_ctes(0.5, 5),
    ),
)
def flag_cluster_silhouette(spark, sf_dir):
    found = D.pattern_clusters(_flags(spark, sf_dir), _FLAGS)
    return rounded(D.pattern_silhouette(found, len(_FLAGS)), "silhouette")
