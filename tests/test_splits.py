"""Trees by counting: against pyspark.ml on few values, against plain loops, and on odd rows."""

import random

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from appmetrics.operators import features as E, splits as S
from appmetrics.operators.ranking import running_sums


@pytest.fixture(scope="module")
def table(spark):
    draw = random.Random(3)
    rows = []
    for i in range(2000):
        a, b, c = draw.randrange(23), draw.randrange(7), draw.randrange(3)
        rows.append((i, float(a), float(b), float(c), 3.0 * (a > 11) + 0.7 * b + draw.random(), float((a // 6 + b) % 3)))
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y double, k double").repartition(5).persist()


def test_running_sums_of_one_hot_group(spark):
    rows = [("hot", i, float(i % 5)) for i in range(3000)] + [("small", 1, 2.0), (None, 4, 1.0)]
    got = running_sums(spark.createDataFrame(rows, "g string, i int, v double"), ["g"], "i", ["v"]).collect()
    sums = {}
    for r in sorted((r for r in got if r["g"] == "hot"), key=lambda r: r["i"]):
        sums["hot"] = sums.get("hot", 0.0) + r["v"]
        assert r["v_upto"] == sums["hot"] and r["v_all"] == sum(i % 5 for i in range(3000))
    assert [(r["v_upto"], r["v_all"]) for r in got if r["g"] == "small"] == [(2.0, 2.0)]
    assert len(got) == 3002


@pytest.mark.parametrize("depth", [1, 4])
def test_regression_equals_the_library(table, depth):
    vectors = E.assemble(table, ["a", "b", "c"], "y", keep=["id"])
    want = DecisionTreeRegressor(labelCol="y", maxDepth=depth, maxBins=64).fit(vectors).transform(vectors)
    got = S.tree(table, "y", ["a", "b", "c"], depth).transform(table)
    both = got.join(want.select("id", F.col("prediction").alias("w")), "id")
    assert both.filter("abs(prediction - w) > 1e-9").count() == 0 and both.count() == 2000


def test_classification_equals_the_library(table):
    vectors = E.assemble(table, ["a", "b", "c"], "k", keep=["id"])
    want = DecisionTreeClassifier(labelCol="k", maxDepth=4, maxBins=64).fit(vectors).transform(vectors)
    got = S.tree(table, "k", ["a", "b", "c"], 4, [0, 1, 2]).transform(table)
    assert got.join(want.select("id", F.col("prediction").alias("w")), "id").filter("prediction <> w").count() <= 20
    assert abs(got.filter("prediction = k").count() - want.filter("prediction = k").count()) <= 2


def test_split_against_loops(spark):
    draw = random.Random(5)
    rows = [(round(draw.random(), 2), draw.randrange(9) * 1.0) for _ in range(300)]
    got = S.best_splits(spark.createDataFrame(rows, "x double, y double"), "y", ["x"]).first()

    def spread(ys):
        mean = sum(ys) / len(ys)
        return sum((y - mean) ** 2 for y in ys)

    every = [y for _, y in rows]
    cuts = sorted({x for x, _ in rows})[:-1]
    falls = {c: (spread(every) - spread([y for x, y in rows if x <= c]) - spread([y for x, y in rows if x > c])) / 300 for c in cuts}
    best = max(falls, key=falls.get)
    assert got["threshold"] == best and abs(got["gain"] - falls[best]) < 1e-9
    assert got["rows_left"] == sum(x <= best for x, _ in rows)


def test_forest_is_better_than_the_mean_and_repeats(table):
    def grow(rows):
        return S.forest(rows, "y", ["a", "b", "c"], 4, trees=8, key=["id"], tried=2, seed=1)

    model = grow(table)
    assert len({repr(t) for t in model.trees}) == 8
    again = grow(table.repartition(3, "b"))
    assert [[(i, n.split and n.split[:2]) for i, n in sorted(t.items())] for t in model.trees] == [
        [(i, n.split and n.split[:2]) for i, n in sorted(t.items())] for t in again.trees
    ]
    row = model.transform(table).agg(F.avg(F.expr("pow(prediction - y, 2)")).alias("left"), F.var_pop("y").alias("all")).first()
    assert row["left"] < 0.3 * row["all"]


def test_boosting_lowers_the_error(table):
    errors = []
    for rounds in (1, 4, 8):
        model = S.boosted(table, "y", ["a", "b", "c"], rounds, depth=2, rate=0.5)
        errors.append(model.transform(table).agg(F.avg(F.expr("pow(prediction - y, 2)"))).first()[0])
    assert errors[0] > errors[1] > errors[2]


def test_odd_rows(spark):
    rows = [(None, 1.0), (float("nan"), 1.0), (0.0, 5.0), (2.0, 5.0), (2.0, None), (3.0, float("nan"))]
    df = spark.createDataFrame(rows, "`x.y` double, `the label` double")
    model = S.tree(df, "the label", ["x.y"], 3)
    assert model.trees[0][1].rows == 4 and model.trees[0][1].split.threshold == float("-inf")
    assert [r["prediction"] for r in model.transform(df).collect()] == [1.0, 1.0, 5.0, 5.0, 5.0, 5.0]
    assert model.nodes(df).count() == 3
    same = S.tree(df.filter("`x.y` = 2"), "the label", ["x.y"], 3)
    assert list(same.trees[0]) == [1] and same.nodes(df).first()["feature"] is None
    with pytest.raises(ValueError):
        S.tree(df.limit(0), "the label", ["x.y"])
    assert S.best_splits(df.limit(0), "the label", ["x.y"]).count() == 0


def test_a_pass_over_many_nodes_names_no_feature_in_its_cases(table, monkeypatch):
    """The code of a level stays small: its nodes name lists of numbers, not expressions of the features."""
    plans, running = [], S.running_sums
    monkeypatch.setattr(S, "running_sums", lambda df, *how: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or running(df, *how))
    S.forest(table, "y", ["a", "b", "c"], depth=3, trees=4, key=["id"], tried=2)
    assert len(plans) == 3
    assert all("struct(feature" not in p and "named_struct(feature" not in p for p in plans)
