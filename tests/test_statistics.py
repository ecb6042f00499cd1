"""Statistics against pyspark.ml.stat, closed forms and brute force."""

import itertools
import math

import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.stat import ChiSquareTest, Correlation

from appmetrics.functions.distributions import chi_square_tail, f_tail, regularized_beta
from appmetrics.operators import diagnostic as G, statistics as T
from appmetrics.sources.listing_view import listings


def test_tail_probabilities():
    assert abs(chi_square_tail(3.841458820694124, 1) - 0.05) < 1e-12
    assert abs(chi_square_tail(18.307038053275146, 10) - 0.05) < 1e-12
    assert abs(chi_square_tail(2.0, 2) - math.exp(-1)) < 1e-14
    assert abs(f_tail(4.9646027437307145, 1, 10) - 0.05) < 1e-10
    # F with 2 and n degrees of freedom has a closed form.
    for n, f in itertools.product((2, 7, 500), (0.1, 1.0, 9.0)):
        assert abs(f_tail(f, 2, n) - (1 + 2 * f / n) ** (-n / 2)) < 1e-12
    assert abs(regularized_beta(0.3, 2, 3) - 0.3483) < 1e-12
    assert chi_square_tail(0, 3) == 1 and f_tail(0, 2, 3) == 1 and math.isnan(f_tail(math.nan, 1, 1))


def test_chi_square_matches_builtin(spark, small):
    df = listings(spark, small, "Category", "Content Rating")
    coded = StringIndexer(inputCols=df.columns, outputCols=["a", "b"]).fit(df).transform(df)
    vectors = VectorAssembler(inputCols=["a"], outputCol="f").transform(coded)
    want = ChiSquareTest.test(vectors, "f", "b").first()
    got = T.chi_square(df, "Category", "Content Rating").first()
    assert abs(got["chi_square"] - want["statistics"][0]) < 1e-8
    assert abs(T.chi_square_p_value(df, "Category", "Content Rating") - want["pValues"][0]) < 1e-10


def test_two_by_two_is_corrected(spark):
    rows = [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 30 + [("b", "y")] * 5
    got = T.chi_square(spark.createDataFrame(rows, "p string, q string"), "p", "q").first()["chi_square"]
    n, (o, r, c) = 65, (10, 30, 40)
    gap = abs(o - r * c / n) - 0.5
    want = sum(gap * gap / (x * y / n) for x in (30, 35) for y in (40, 25))
    assert abs(got - want) < 1e-9


def test_two_by_two_with_an_empty_cell(spark):
    rows = [("a", "x")] * 8 + [("b", "y")] * 8 + [("b", "x")] * 1
    got = T.chi_square(spark.createDataFrame(rows, "p string, q string"), "p", "q").first()["chi_square"]
    gap = abs(8 - 8 * 9 / 17) - 0.5
    assert abs(got - sum(gap * gap / (x * y / 17) for x in (8, 9) for y in (9, 8))) < 1e-9


def test_association_matrix(spark):
    rows = [(str(i % 3), str(i % 3), str(i % 4), None if i == 5 else "z") for i in range(120)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    m = {(r[0], r[1]): r[2] for r in T.association_matrix(df, ["a", "b", "c"]).collect()}
    assert len(m) == 9 and all(abs(m[(x, y)] - m[(y, x)]) < 1e-12 for x, y in m)
    assert abs(m[("a", "b")] - 1) < 1e-9 and m[("a", "c")] == 0 and m[("c", "c")] == 1
    one_sided = T.association_matrix(df, ["a", "d"]).filter("column_a != column_b").collect()
    assert [r["value"] for r in one_sided] == [None, None]  # a constant column has no association


def test_spearman_matches_builtin(spark, small):
    df = listings(spark, small, "Rating", "Maximum Installs").na.drop()
    vectors = VectorAssembler(inputCols=df.columns, outputCol="f").transform(df)
    want = Correlation.corr(vectors, "f", "spearman").first()[0][0, 1]
    assert abs(T.spearman(df, "Rating", "Maximum Installs").first()["value"] - want) < 1e-9


def test_pearson_skips_incomplete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.1, 1.0), (3.0, None, 2.0), (4.0, 8.0, float("nan"))], "a double, b double, c double")
    m = {(r[0], r[1]): r[2] for r in T.pearson_matrix(df).collect()}
    assert m[("a", "b")] > 0.999 and abs(m[("a", "c")] - 1) < 1e-12 and m[("b", "c")] is None


def test_anova_p_value(spark, small):
    df = listings(spark, small, "Category", "Rating").na.drop()
    row = T.anova(df, "Category", "Rating").first()
    coded = StringIndexer(inputCol="Category", outputCol="c").fit(df).transform(df)
    vectors = VectorAssembler(inputCols=["Rating"], outputCol="f").transform(coded)
    jvm = spark.sparkContext._jvm.org.apache.spark.ml.stat.ANOVATest.test(vectors._jdf, "f", "c").first()
    assert abs(T.anova_p_value(df, "Category", "Rating") - jvm.getAs("pValues").apply(0)) < 1e-8
    assert abs(row["f"] - jvm.getAs("fValues").apply(0)) < 1e-6
    some = T.anova(df, "Category", "Rating", ["Brand#11", "Brand#12"]).first()
    assert some["groups"] <= 2
    assert math.isnan(T.anova_p_value(df.limit(0), "Category", "Rating"))


def test_best_groups_limit(spark):
    df = spark.createDataFrame([(o, i, float(i)) for o in "abc" for i in range(5)], "o string, i int, v double")
    got = G.best_groups_within(df, "o", "i", "v", n=2, max_groups=2).collect()
    assert sorted((r["o"], r["i"], r["place"]) for r in got) == [("a", 3, 2), ("a", 4, 1), ("b", 3, 2), ("b", 4, 1)]


def test_unknown_pairs_rejected(spark):
    with pytest.raises(ValueError):
        T.pearson_matrix(spark.range(3))
