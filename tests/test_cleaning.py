"""Missing values, outliers, exact ranks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from appmetrics.operators import cleaning as C, profiling as R, ranking as Q, sampling as S


def test_fills(spark):
    df = spark.createDataFrame(
        [(1.0, 1, "b"), (float("nan"), 2, "a"), (None, 2, "a"), (4.0, None, "b"), (None, None, None)], "x double, n bigint, t string"
    )
    mean = C.handle_missing(df, "mean", ["x", "n"]).collect()
    assert [r["x"] for r in mean] == [1.0, 2.5, 2.5, 4.0, 2.5]
    assert [r["n"] for r in mean] == [1, 2, 2, 1, 1]  # 5/3 truncated
    median = C.handle_missing(df, "median", ["x"]).collect()
    assert [r["x"] for r in median] == [1.0, 1.0, 1.0, 4.0, 1.0]
    mode = C.handle_missing(df, "mode", ["t"]).collect()
    assert mode[4]["t"] == "a"  # two-way tie, lowest
    assert C.handle_missing(df, "drop", []).count() == 5
    assert C.handle_missing(df, "drop", ["x"]).count() == 2
    with pytest.raises(ValueError):
        C.handle_missing(df, "other", ["x"])


def test_all_null_column(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    assert C.outlier_bounds(df) == {"b": (1.0 - 1.5, 2.0 + 1.5)}
    assert C.fill_mean(df, ["a"]).filter("a IS NOT NULL").count() == 0
    assert Q.exact_quantiles(df, ["a"], [0.5]) == {"a": [None]}
    assert R.box_statistics(df).count() == 1


def test_outlier_rows_need_two_flags(spark):
    rows = [(float(i % 10), float(i % 7), True) for i in range(200)] + [(1000.0, 3.0, True), (1000.0, 900.0, False), (None, 900.0, True)]
    df = spark.createDataFrame(rows, "a double, b double, flag boolean")
    kept = C.drop_outliers(df)
    assert kept.count() == 202 and kept.filter("a = 1000 AND b = 900").count() == 0
    report = {r["column"]: r["outliers"] for r in C.outlier_report(df).collect()}
    assert report == {"a": 2, "b": 2}


@pytest.mark.parametrize("n", [1, 2, 3, 6, 10, 11, 12, 100, 1001])
def test_quantiles_are_exact(spark, n):
    values = np.random.default_rng(n).normal(size=n)
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(4)
    probabilities = [0.1, 0.25, 0.3, 0.5, 0.75, 1.0]
    got = Q.exact_quantiles(df, ["v"], probabilities)["v"]
    ordered = np.sort(values)
    want = [ordered[max(1, -(-int(round(p * 100)) * n // 100)) - 1] for p in probabilities]
    assert got == want


def test_quantiles_with_hot_value(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 500.0).otherwise(F.col("id") * 1.0).alias("v"))
    values = np.sort([500.0 if i % 3 == 0 else float(i) for i in range(30_000)])
    got = Q.exact_quantiles(df, ["v"], [0.25, 0.5, 0.75])["v"]
    assert got == [values[7499], values[14999], values[22499]]


@pytest.mark.parametrize(
    "values",
    [
        [1.0], [2.0, 2.0, 2.0], [float("-inf"), 1.0, float("inf"), float("inf")], [float("inf")] * 3, [-1.7e308, 0.0, 1.7e308, 5.0],
        [0.0, 5e-324, 1e-323, 1.0], [1e18, 1e18 + 128, 1.0, 2.0, 1e-9], [-0.0, 0.0, -5e-324],
    ],
)
def test_quantiles_of_extreme_values(spark, values):
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double")
    ordered = sorted(values)
    want = [ordered[max(1, -(-int(p * 100) * len(ordered) // 100)) - 1] for p in (0.25, 0.5, 0.75)]
    assert Q.exact_quantiles(df, ["v"], [0.25, 0.5, 0.75])["v"] == want


def test_running_totals(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("w")).repartition(8)
    rows = sorted((r["k"], r["t"]) for r in Q.running_totals(df, [F.col("k")], "w", "t").collect())
    assert [t for _, t in rows] == list(np.cumsum([k % 7 for k in range(5000)]))
    numbers = sorted(r["t"] for r in Q.running_totals(df, [F.desc("w"), F.col("k")], out="t").collect())
    assert numbers == list(range(1, 5001))


def test_null_report_counts_nan(spark):
    df = spark.createDataFrame([(float("nan"), None, True), (None, "x", False)], "x double, t string, b boolean")
    assert [tuple(r) for r in R.null_report(df).collect()] == [("x", 2, 100.0), ("t", 1, 50.0), ("b", 0, 0.0)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)] + [(None,)], "v double")
    assert [r["count"] for r in R.equal_width_histogram(df, "v", 5).orderBy("bin").collect()] == [2, 2, 2, 2, 3]
    flat = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert sum(r["count"] for r in R.equal_width_histogram(flat, "v").collect()) == 2


def test_samples(spark):
    df = spark.range(10_000)
    one, again = S.sample_fraction(df, 0.15, 5), S.sample_fraction(df.repartition(13), 0.15, 5)
    assert sorted(r[0] for r in one.collect()) == sorted(r[0] for r in again.collect())
    assert 1300 < one.count() < 1700
    picks = S.sample_rows(df, 7, 0)
    assert picks.count() == 7 and sorted(picks.collect()) == sorted(S.sample_rows(df.repartition(5), 7, 0).collect())
    parts = S.split_rows(df, {"a": 7, "b": 3}, 1)
    assert parts["a"].count() + parts["b"].count() == 10_000 and parts["a"].intersect(parts["b"]).count() == 0


def test_weighted_draw_follows_weights(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(5)], "k int, w double")
    drawn = [S.weighted_draw(df, F.col("w"), seed, ["k"]).first()["k"] for seed in range(60)]
    assert 0 not in drawn and drawn.count(4) > drawn.count(1)
