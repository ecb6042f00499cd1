"""Encoders against pyspark.ml, models on easy data, evaluation against pyspark.ml evaluators."""

import inspect

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from appmetrics.functions import parsing as Q
from appmetrics.operators import columns as K, evaluation as V, features as E, models as M
from appmetrics.operators import machines as X, penalised as N
from appmetrics.plans import preparation as P
from appmetrics.plans.catalog import all_queries
from appmetrics.sources.listing_view import listings


def test_label_index_matches_builtin(spark, small):
    df = listings(spark, small, "App Id", "Released", "Ad Supported")
    want = df
    for c in ("Released", "Ad Supported"):
        want = StringIndexer(inputCol=c, outputCol=c + "_i", handleInvalid="skip").fit(want).transform(want).drop(c).withColumnRenamed(c + "_i", c)
    got = E.label_encode(df, ["Released", "Ad Supported"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))
    assert got.schema["Released"].metadata["ml_attr"]["num_vals"] > 100


def test_unknown_values(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "t string")
    indexes = E.label_indexes(df, ["t"])
    other = spark.createDataFrame([("a",), ("zzz",), (None,)], "t string")
    assert [r[0] for r in E.label_encode(other, ["t"], indexes).collect()] == [0.0]
    kept = E.encode_columns(other, ["t"], indexes=indexes)
    assert sorted(r["t_enc"] for r in kept.collect()) == [0, 2, 2]
    assert {r["t_orig"] for r in E.decode_columns(kept, ["t"], indexes).collect()} == {"a", None}


def test_one_hot_of_many_values_and_nulls(spark):
    df = spark.range(1200).select(F.when(F.col("id") > 0, F.col("id").cast("string")).alias("t"))
    flags = E.one_hot_encode(df, ["t"])
    assert len(flags.columns) == 1199
    vectors = E.one_hot_vectors(df, ["t"]).select("t", vector_to_array("t_vec").alias("v"))
    assert vectors.count() == 1200
    assert vectors.filter("size(v) <> 1199").count() == 0
    assert vectors.filter("aggregate(v, 0D, (a, x) -> a + x) <> CASE WHEN t IS NULL THEN 0 ELSE 1 END").count() == 0


def test_label_is_never_a_feature():
    assert "Rating" not in P.model_columns("Rating")
    assert "Free" not in P.model_columns("Price") and "Price" not in P.model_columns("Price")
    assert len(P.model_columns("Installs")) == 14


def test_small_columns(spark):
    df = spark.createDataFrame([(1.9, True, None), (-0.5, False, 0.0)], "a double, f boolean, r double")
    assert [r["a"] for r in K.floor_columns(df, "a").collect()] == [1, -1]
    assert [r["f"] for r in K.flags_as_int(df, "f").collect()] == [1, 0]
    assert [r["IsRated"] for r in K.with_is_rated(df, "r").collect()] == [0, 0]
    assert K.label_last(df, "a").columns == ["f", "r", "a"]
    assert K.wide_to_long(df, ["a", "r"]).count() == 4
    assert K.shared_columns(df, df.select("r", "a")) == ["a", "r"] and K.other_columns(df, "a") == ["f", "r"]


def test_value_counts_leave_rows_where_they_are(spark):
    """A large table with few values: only its counts are shuffled."""
    rows = spark.range(2_000_000).selectExpr("id", "CASE WHEN id % 3 > 0 THEN cast(id % 3 AS string) END AS v")
    counted = E.with_value_counts(rows, "v", "n")
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert {(r["v"], r["n"]) for r in counted.select("v", "n").distinct().collect()} == {(None, None), ("1", 666667), ("2", 666666)}


@pytest.fixture(scope="module")
def rings(spark):
    """Two classes no straight line separates, and a third apart."""
    d = spark.range(900).select(
        (F.rand(1) * 6.283).alias("t"), (F.col("id") % 3).cast("double").alias("y")
    )
    r = F.when(F.col("y") == 0, 0.5).when(F.col("y") == 1, 3.0).otherwise(8.0)
    return E.assemble(d.select((r * F.cos("t")).alias("a"), (r * F.sin("t")).alias("b"), "y"), ["a", "b"], "y").persist()


def test_rbf_machine_and_search(rings):
    model = M.rbf_machine(rings, "y", size=32, max_iter=15, gamma=1.0)
    assert M.accuracy(model, rings, "y") > 0.95

    def forest(rows, label, depth):
        return M.forest_classifier(rows, label, trees=3, maxDepth=depth)

    found = M.random_search(rings, "y", forest, {"depth": [1, 5]}, draws=3, folds=2, key=["y"])
    assert found.trials.count() == 3 and found.accuracy == max(r["score"] for r in found.trials.collect())


def test_search_is_the_fits_of_its_folds(rings):
    """All draws and folds in one fit give what each of them gives alone."""
    rows = rings.withColumn("id", F.monotonically_increasing_id())
    how = {"size": 12, "max_iter": 6, "gamma": 1.0}
    found = M.machine_search(rows, "y", [1.0, 30.0], draws=2, folds=2, key=["id"], **how)
    folded = rows.withColumn("fold", M.fold_of(["id"], 2, 42)).persist()
    for trial, setting in zip(found.trials.orderBy("trial").collect(), M.drawn_settings({"cost": [1.0, 30.0]}, 2, 42)):
        scores = []
        for k in range(2):
            model = M.rbf_machine(folded.filter(F.col("fold") != k), "y", cost=setting["cost"], **how)
            scores.append(M.accuracy(model, folded.filter(F.col("fold") == k), "y"))
        assert trial["parameters"] == str(setting) and abs(trial["score"] - sum(scores) / 2) < 0.01
    assert found.accuracy == max(r["score"] for r in found.trials.collect())


def test_objectives_reach_those_of_the_library(spark, rings):
    """Machine by machine, the mean hinge loss with its penalty is no more than 0.1 % above LinearSVC's."""
    rows = X.narrow_rows(rings, "y", "features")
    found = X.fit_machines(rows, [1.0, 1000.0], size=24, gamma=0.4)
    table = rows.toPandas()
    mapped, labels = found.mapped(np.stack(table["x"]), 0), table["label"].to_numpy()
    for c, cost in enumerate(found.costs):
        for p, (a, b) in enumerate(X.class_pairs(3)):
            mine = np.isin(labels, [found.classes[a], found.classes[b]])
            z, up = mapped[mine], labels[mine] == found.classes[b]

            def objective(w):
                return np.maximum(0, 1 - np.where(up, 1, -1) * (z @ w)).mean() + (w[:-1] ** 2).sum() / (2 * cost * len(z))

            frame = spark.createDataFrame([(float(u), Vectors.dense(v[:-1])) for u, v in zip(up, z)], ["label", "features"])
            library = LinearSVC(regParam=1 / (cost * len(z)), maxIter=50, standardization=False).fit(frame)
            theirs = objective(np.append(library.coefficients.toArray(), library.intercept))
            assert found.objectives[0, c, p] <= 1.001 * theirs + 1e-4
            assert abs(objective(found.weights[0, c, p]) - found.objectives[0, c, p]) < 1e-9


def test_equal_rows_are_read_once_and_weigh_what_they_stand_for(spark, rings):
    """Three of each row are 900 rows to read; three times the rows are three times the cost."""
    thrice = rings.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(2))))
    rows = X.narrow_rows(thrice, "y", "features", F.expr("int(copy > 0)"), 2)
    assert rows.count() == 900 and {tuple(r["rows"]) for r in rows.collect()} == {(1, 2)}
    how = {"size": 12, "max_iter": 8, "scale": False}
    one = X.fit_machines(X.narrow_rows(rings, "y", "features"), [3.0], **how)
    three = X.fit_machines(rows, [1.0, 1.5], (-1, 0), **how)
    assert np.allclose(one.objectives[0, 0], three.objectives[0, 0]) and np.allclose(one.objectives[0, 0], three.objectives[1, 1])
    (mean, factor), x = X._facts(rows, (-1,))[2][0], np.stack(rings.toPandas()["features"].map(lambda v: v.toArray()))
    assert np.allclose(mean, x.mean(axis=0)) and np.allclose(1 / factor, np.repeat(x, 3, axis=0).std(axis=0, ddof=1))
    held = X.held_out_accuracy(rows, three, (0, 1))
    assert np.allclose(held[:, 0], M.accuracy(X.PairwiseModel(three, "features"), rings, "y"), atol=0.05)


def test_many_minimisations_side_by_side():
    random = np.random.default_rng(1)
    goals, bends = random.normal(size=(20, 6)), random.uniform(0.1, 30, (20, 6))

    def evaluate(points, which):
        off = points - goals[which]
        return (bends[which] * off**2).sum(axis=1), 2 * bends[which] * off

    points, values, passes = X.minimise(evaluate, np.zeros((20, 6)), 100, 1e-14)
    assert np.allclose(points, goals, atol=1e-4) and values.max() < 1e-8 and passes < 60


def test_machines_of_one_class_and_of_odd_rows(spark):
    df = spark.createDataFrame([(2.0, 1.0), (3.0, 1.0), (4.0, None)], "a double, y double")
    model = M.rbf_machine(E.assemble(df, ["a"], "y"), "y", size=4)
    assert {r["prediction"] for r in model.transform(E.assemble(df, ["a"], "y")).collect()} == {1.0}
    with pytest.raises(ValueError):
        M.rbf_machine(E.assemble(df.limit(0), ["a"], "y"), "y", size=4)


def test_registered_search_is_the_whole_search(spark, small, monkeypatch):
    search, seen = M.machine_search, {}

    def called(*args, **how):
        seen.update(inspect.signature(search).bind(*args, **how).arguments)
        raise InterruptedError

    monkeypatch.setattr(M, "machine_search", called)
    with pytest.raises(InterruptedError):
        all_queries()["stars_machine_search"].run(spark, small)
    default = inspect.signature(search).parameters
    assert (seen.get("draws", default["draws"].default), seen.get("folds", default["folds"].default)) == (30, 5)
    assert not seen.get("machine")
    default = inspect.signature(X.fit_machines).parameters
    assert default["size"].default == 128 and default["max_iter"].default == 50


def test_regressors(spark):
    df = spark.range(400).select((F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("z"))
    rows = E.assemble(df.withColumn("y", F.col("x") * 3 - F.col("z") + 2), ["x", "z"], "y")
    for model, least in (
        (M.linear(rows, "y"), 0.9999),
        (M.elastic_net(rows, "y"), 0.98),
        (M.decision_tree(rows, "y", max_bins=32), 0.95),
        (M.forest_regressor(rows, "y"), 0.9),
        (M.boosted_trees(rows, "y", max_iter=10), 0.95),
    ):
        assert V.regression_metrics(model.transform(rows), "y").first()["r2"] > least
    summary = M.linear_summary(rows, M.elastic_net(rows, "y")).first()
    assert summary["r2"] > 0.98 and len(summary["objective_history"]) == summary["iterations"] + 1


@pytest.mark.parametrize("l1_share", [0.0, 0.8, 1.0])
def test_penalised_path_is_the_librarys(spark, l1_share):
    random = np.random.default_rng(3)
    x = random.normal(size=(300, 5)) * [1, 10, 0.1, 3, 0] + [0, 5, 1, -2, 7]  # correlated, differently scaled, one constant
    x[:, 3] += x[:, 1]
    y = x @ [1.0, 0.3, -4.0, 0.0, 2.0] + random.normal(size=300)
    df = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "y"])
    odd = df.unionAll(spark.createDataFrame([(Vectors.dense([1.0] * 5), None)], df.schema))
    for line in N.elastic_net_path(N.moments(odd, "y"), [5.0, 0.3, 0.0], l1_share):
        model = LinearRegression(labelCol="y", regParam=line.strength, elasticNetParam=l1_share, tol=1e-12, maxIter=1000, solver="l-bfgs").fit(df)
        assert np.allclose(line.coefficients, model.coefficients.toArray(), atol=1e-6) and abs(line.intercept - model.intercept) < 1e-5
        assert abs(line.rmse - model.summary.rootMeanSquaredError) < 1e-6 and abs(line.r2 - model.summary.r2) < 1e-6
        assert abs(line.objective_history[-1] - model.summary.objectiveHistory[-1]) < 1e-6
    with pytest.raises(ValueError):
        N.moments(df.limit(0), "y")


def test_metrics_match_builtin(spark):
    rows = [(float(i % 4), float((i * i) % 5)) for i in range(101)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    got = V.classification_metrics(df).first()
    for ours, theirs in (
        ("accuracy", "accuracy"), ("f1", "f1"), ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall"),
    ):
        assert abs(got[ours] - MulticlassClassificationEvaluator(metricName=theirs).evaluate(df)) < 1e-12
    assert abs(got["error_rate"] - V.error_rate(df).first()[0]) < 1e-12
    numbers = V.regression_metrics(df).first()
    for m in ("rmse", "mse", "mae", "r2"):
        assert abs(numbers[m] - RegressionEvaluator(metricName=m).evaluate(df)) < 1e-12


def test_moments_of_uneven_tasks(spark, monkeypatch):
    """One pass merges what tasks return: large means take no digits, tasks without rows add nothing."""
    monkeypatch.setattr(N.F, "covar_pop", None)
    random = np.random.default_rng(4)
    table = random.normal(size=(700, 4)) * [1, 1e-3, 5, 2] + [1e6, 3e4, 0, -7]
    rows = [(i % 3 * i % 5, Vectors.dense(r[:3]), float(r[3])) for i, r in enumerate(table)]
    odd = [(9, None, 1.0), (9, Vectors.dense([1, 1, 1]), None), (9, Vectors.dense([1, 1, 1]), float("nan"))]
    df = spark.createDataFrame(rows + odd, ["p", "features", "y"])
    found = N.moments(df.repartition(7, "p"), "y")
    assert found.n == 700 and np.allclose(found.means, table.mean(axis=0), rtol=1e-12)
    assert np.allclose(found.covariances, np.cov(table.T, ddof=0), rtol=1e-8, atol=1e-9)


def test_label_indexes_count_without_a_row_per_value(spark, monkeypatch):
    """Values of all columns are counted by grouping sets; earlier nulls leave a row out only if ``sequential``."""
    rows = [("a", 1, None), ("b", 2, True), ("b", None, True), (None, 2, False), ("a", 3, True), ("b", 2, False)]
    df = spark.createDataFrame(rows, "s string, n int, f boolean")

    def found(sequential):
        tables = E.label_indexes(df, ["s", "n", "f"], sequential)
        return {c: [r["value"] for r in t.orderBy("index").collect()] for c, t in tables.items()}

    plans, totals = [], E.running_totals
    monkeypatch.setattr(E, "running_totals", lambda counts, *a, **k: plans.append(counts._jdf.queryExecution().optimizedPlan().toString()) or totals(counts, *a, **k))
    assert found(True) == found(False) == {"s": ["b", "a"], "n": ["2", "1", "3"], "f": ["true", "false"]}
    assert [r["value"] for r in E.label_indexes(df, ["f"])["f"].orderBy("index").collect()] == ["true", "false"]
    assert plans and not any("Generate" in p for p in plans)


def test_years_of_plain_and_odd_dates(spark):
    texts = ["May 21, 2020", "Feb 29, 2020", "Feb 29, 2021", "Feb 30, 2020", "Dec 31, 1970", "Sep 31, 2001", "may 1, 2020", "May 01, 2020"]
    texts += ["May 1, 2020 ", "May 1, 2020\n", "May 0, 2020", "June 3, 2020", "Jan 1, 20200", "Jan 1, 0999", "x", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    shown = df.select(Q.listing_year("t").alias("year"), F.year(Q.listing_date("t")).alias("want")).collect()
    assert [r["year"] for r in shown] == [r["want"] for r in shown] and shown[0]["year"] == 2020


def test_model_rows_are_written_with_flags_and_years(spark, small, monkeypatch):
    written, stage = [], P.stage
    monkeypatch.setattr(P, "stage", lambda df, name: written.append(dict(df.dtypes)) or stage(df, name))
    P.model_rows(listings(spark, small), "Price")
    (kinds,) = written
    assert kinds["Last Updated"] == "int" and {kinds[c] for c in [*P.MODEL_FLAGS, *P.MODEL_PRESENCE]} == {"boolean"}
