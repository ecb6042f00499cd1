"""Registered queries for encoders, model inputs, models, evaluation and the summary of facts."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F

from appmetrics.functions.scratch import scratch_path, stage
from appmetrics.operators import evaluation as V, features as E, models as M, penalised as N
from appmetrics.operators.machines import vote
from appmetrics.plans import preparation as P
from appmetrics.plans.catalog import CATALOG, INSTALLS_SQL, SIZE_SQL, YEAR_SQL, listing_sql, rounded
from appmetrics.plans.insights import insights
from appmetrics.sources.files import load_model, save_model
from appmetrics.sources.listing_view import driver_table, listings

# ---- encoders ----


def _index_cte(name: str, column: str, where: str = "TRUE", source: str = "apps") -> str:
    return f"""{name} AS MATERIALIZED (SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS i FROM (
      SELECT "{column}"::VARCHAR AS v, count(*) AS n FROM {source} WHERE "{column}" IS NOT NULL AND {where} GROUP BY 1))"""


@CATALOG.add(
    "FEA-1",
    "SCA-10",
    sql=listing_sql(
        """SELECT "App Id", r.i AS "Released", a.i AS "Ad Supported", d.i AS "Developer Email" FROM apps
        JOIN r ON r.v = "Released" JOIN a ON a.v = "Ad Supported" JOIN d ON d.v = "Developer Email" """,
        _index_cte("r", "Released"),
        _index_cte("a", "Ad Supported", '"Released" IS NOT NULL'),
        _index_cte("d", "Developer Email", '"Released" IS NOT NULL AND "Ad Supported" IS NOT NULL'),
    ),
)
def label_encoded(spark, sf_dir):
    columns = ["Released", "Ad Supported", "Developer Email"]
    return E.label_encode(listings(spark, sf_dir, "App Id", *columns), columns)


@CATALOG.add(
    "FEA-2",
    "PRJ-16",
    sql=listing_sql(
        """SELECT "App Id", "Category", "Ad Supported", CAST(c.i AS INTEGER) AS "Category_enc",
        CAST(coalesce(a.i, (SELECT count(*) FROM a)) AS INTEGER) AS "Ad Supported_enc" FROM apps
        LEFT JOIN c ON c.v = "Category" LEFT JOIN a ON a.v = "Ad Supported" """,
        _index_cte("c", "Category"),
        _index_cte("a", "Ad Supported"),
    ),
)
def encoded_columns(spark, sf_dir):
    columns = ["Category", "Ad Supported"]
    return E.encode_columns(listings(spark, sf_dir, "App Id", *columns), columns)


@CATALOG.add(
    "FEA-3",
    sql=listing_sql(
        """SELECT "App Id", "Category", "Ad Supported", "Category" AS "Category_orig", "Ad Supported" AS "Ad Supported_orig" FROM apps"""
    ),
)
def decoded_columns(spark, sf_dir):
    columns = ["Category", "Ad Supported"]
    df = listings(spark, sf_dir, "App Id", *columns)
    indexes = E.label_indexes(df, columns, sequential=False)
    encoded = E.encode_columns(df, columns, indexes=indexes)
    return E.decode_columns(encoded, columns, indexes).drop("Category_enc", "Ad Supported_enc")


@CATALOG.add("FEA-3", sql=listing_sql('SELECT "App Id", "Released" FROM apps WHERE "Released" IS NOT NULL'))
def label_decoded(spark, sf_dir):
    df = listings(spark, sf_dir, "App Id", "Released")
    indexes = E.label_indexes(df, ["Released"])
    return E.label_decode(E.label_encode(df, ["Released"], indexes), ["Released"], indexes)


def _share(c: str) -> str:
    return f'(CASE WHEN "{c}" IS NOT NULL THEN count(*) OVER (PARTITION BY "{c}") END)'


@CATALOG.add(
    "FEA-4",
    sql=listing_sql(
        f"""SELECT "App Id", round({_share("Category")}::DOUBLE / count(*) OVER (), 8) AS "Category",
        round({_share("Released")}::DOUBLE / count(*) OVER (), 8) AS "Released" FROM apps"""
    ),
)
def frequency_encoded(spark, sf_dir):
    columns = ["Category", "Released"]
    return rounded(E.frequency_encode(listings(spark, sf_dir, "App Id", *columns), columns), *columns, digits=8)


@CATALOG.add("JOI-1", sql=listing_sql(f'SELECT "App Id", "Ad Supported", {_share("Ad Supported")} AS occurrences FROM apps'))
def with_value_counts(spark, sf_dir):
    return E.with_value_counts(listings(spark, sf_dir, "App Id", "Ad Supported"), "Ad Supported", "occurrences")


@CATALOG.add(
    "FEA-5",
    sql=listing_sql(
        """SELECT "App Id", coalesce("Ad Supported" = 'False', FALSE) AS "Ad Supported_False",
        coalesce("Ad Supported" = 'True', FALSE) AS "Ad Supported_True", "Currency" = 'EUR' AS "Currency_EUR",
        "Currency" = 'USD' AS "Currency_USD" FROM apps"""
    ),
)
def one_hot_encoded(spark, sf_dir):
    columns = ["Ad Supported", "Currency"]
    return E.one_hot_encode(listings(spark, sf_dir, "App Id", *columns), columns)


@CATALOG.add(
    "FEA-5",
    sql=listing_sql(
        """SELECT "App Id", CAST(i.i AS INTEGER) AS position, (SELECT count(*)::INTEGER FROM i) AS width
        FROM apps JOIN i ON i.v = "Content Rating" """,
        _index_cte("i", "Content Rating"),
    ),
)
def one_hot_vectors(spark, sf_dir):
    df = E.one_hot_vectors(listings(spark, sf_dir, "App Id", "Content Rating"), ["Content Rating"])
    slots = vector_to_array("Content Rating_vec")
    return df.select("App Id", (F.array_position(slots, 1.0) - 1).cast("int").alias("position"), F.size(slots).alias("width"))


@CATALOG.add(
    "FEA-6",
    sql=listing_sql(
        """SELECT "App Id", ["Rating", "Rating Count"::DOUBLE, "Free"::INTEGER::DOUBLE] AS features FROM apps WHERE "Rating" IS NOT NULL"""
    ),
)
def assembled_vectors(spark, sf_dir):
    df = listings(spark, sf_dir, "App Id", "Rating", "Rating Count", "Free")
    rows = E.assemble(df, ["Rating", "Rating Count", "Free"], invalid="skip")
    return rows.select("App Id", vector_to_array("features").alias("features"))


@CATALOG.add(
    "FEA-7",
    "PRJ-13",
    "PRJ-17",
    "FLT-6",
    sql=listing_sql(
        """SELECT "Rating", "Rating Count", "Free", """
        + ", ".join(
            f'round({_share(c)}::DOUBLE / count(*) OVER (), 4) AS "{c}"' for c in ("Category", "Ad Supported", "Content Rating")
        )
        + " FROM kept",
        """kept AS (SELECT * REPLACE (CAST(floor("Rating") AS INTEGER) AS "Rating", CAST("Free" AS INTEGER) AS "Free") FROM apps
        WHERE "Rating" IS NOT NULL AND floor("Rating") <= 5 AND "Ad Supported" IN ('True', 'False'))""",
    ),
)
def labelled_listings(spark, sf_dir):
    df = listings(spark, sf_dir, "App Name", "Category", "Rating", "Rating Count", "Free", "Price", "Ad Supported", "Content Rating")
    return rounded(P.labelled_listings(df), "Category", "Ad Supported", "Content Rating")


MODEL_COLUMNS = [
    "Category",
    "Rating",
    "Rating Count",
    "Installs",
    "Free",
    "Price",
    "Size",
    "Minimum Android",
    "Developer Website",
    "Released",
    "Last Updated",
    "Content Rating",
    "Privacy Policy",
    "Ad Supported",
    "In App Purchases",
    "Editors Choice",
]
MODEL_SQL = listing_sql(
    f"""SELECT kept.*, CAST(a.i AS INTEGER) AS "Category_enc", CAST(b.i AS INTEGER) AS "Minimum Android_enc", CAST(c.i AS INTEGER) AS "Content Rating_enc"
    FROM kept JOIN a ON a.v = kept."Category" JOIN b ON b.v = kept."Minimum Android" JOIN c ON c.v = kept."Content Rating" """,
    f"""sized AS (SELECT "Category", "Rating", "Rating Count", {INSTALLS_SQL} AS "Installs", "Free", "Price", {SIZE_SQL} AS "Size", "Minimum Android",
      "Developer Website" IS NOT NULL AS "Developer Website", "Released", {YEAR_SQL.format('"Last Updated"')} AS "Last Updated", "Content Rating",
      "Privacy Policy" IS NOT NULL AS "Privacy Policy", "Ad Supported" <> 'False' AS "Ad Supported", "In App Purchases" <> 'False' AS "In App Purchases", "Editors Choice"
      FROM apps WHERE "Size" <> 'Varies with device' AND {SIZE_SQL} IS NOT NULL AND "Installs" IS NOT NULL AND "Ad Supported" IS NOT NULL AND "Released" IS NOT NULL)""",
    """kept AS MATERIALIZED (SELECT * REPLACE (round(coalesce("Rating", (SELECT avg("Rating") FROM sized)), 4) AS "Rating") FROM sized
      WHERE coalesce("Rating", (SELECT avg("Rating") FROM sized)) >= 1 AND "Rating Count" >= 200 AND "Price" >= 0)""",
    _index_cte("a", "Category", source="kept"),
    _index_cte("b", "Minimum Android", source="kept"),
    _index_cte("c", "Content Rating", source="kept"),
)


@CATALOG.add("CLN-14", "FLT-5", sql=MODEL_SQL)
def model_rows(spark, sf_dir):
    return rounded(P.model_rows(listings(spark, sf_dir, *MODEL_COLUMNS, busy=True), "Price"), "Rating")


# ---- models ----


def _vectors(spark, sf_dir, label, floor_label=False):
    """Prepared vectors, written once: fitting and scoring read them several times."""
    df = listings(spark, sf_dir, "App Id", *MODEL_COLUMNS, busy=True)
    return P.split_by_draw(stage(P.model_vectors(df, label, floor_label), "vectors"), 0.7)


def _linear_vectors(spark, sf_dir, label):
    cleaned = stage(P.clean_listings(listings(spark, sf_dir, busy=True)), "cleaned")
    return P.split_by_draw(stage(P.encoded_vectors(cleaned, label), "vectors"), 0.8)


def _scores(model, test, label):
    return V.regression_metrics(model.transform(test), label)


@CATALOG.add(
    "MOD-1",
    "FEA-6",
    sql="""SELECT round(regr_slope(l_extendedprice, l_quantity), 3) AS slope,
    round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 4) AS r2 FROM lineitem""",
)
def price_on_quantity_line(spark, sf_dir):
    rows = E.assemble(driver_table(spark, sf_dir, "lineitem"), ["l_quantity"], "l_extendedprice")
    summary = M.linear_summary(rows, M.linear(rows, "l_extendedprice"))
    line = summary.select(F.get("coefficients", F.lit(0)).alias("slope"), "intercept", "r2")
    return rounded(rounded(line, "slope", "intercept", digits=3), "r2")


@CATALOG.add(
    "MOD-1",
    "EVA-2",
    sql="""SELECT round(sqrt(regr_syy(l_extendedprice, l_quantity) / count(*) * (1 - regr_r2(l_extendedprice, l_quantity))), 2) AS rmse,
    round(regr_r2(l_extendedprice, l_quantity), 4) AS r2, [round(regr_slope(l_extendedprice, l_quantity), 3)] AS coefficients FROM lineitem""",
)
def price_on_quantity_fit(spark, sf_dir):
    rows = E.assemble(driver_table(spark, sf_dir, "lineitem"), ["l_quantity"], "l_extendedprice")
    fit = M.linear_summary(rows, M.linear(rows, "l_extendedprice")).selectExpr("rmse", "r2", "transform(coefficients, c -> round(c, 3)) AS coefficients")
    return rounded(rounded(fit, "rmse", digits=2), "r2")


@CATALOG.add("MOD-1", "EVA-1", "EVA-2", "PRJ-14", "SMP-4")
def rating_line(spark, sf_dir):
    train, test = _linear_vectors(spark, sf_dir, "Rating")
    model = M.linear(train, "Rating")
    fit = M.linear_summary(train, model).select(F.lit("train").alias("part"), "rmse", "r2")
    return fit.unionByName(_scores(model, test, "Rating").select(F.lit("test").alias("part"), "rmse", "r2"))


@CATALOG.add("MOD-1", "EVA-1")
def installs_line(spark, sf_dir):
    train, test = _linear_vectors(spark, sf_dir, "Maximum Installs")
    return _scores(M.linear(train, "Maximum Installs"), test, "Maximum Installs")


@CATALOG.add("MOD-1", "MOD-3", "EVA-1")
def price_line_and_tree(spark, sf_dir):
    train, test = _linear_vectors(spark, sf_dir, "Price")
    line = _scores(M.linear(train, "Price"), test, "Price").withColumn("model", F.lit("line"))
    tree = _scores(M.decision_tree(train, "Price"), test, "Price").withColumn("model", F.lit("tree"))
    return line.unionByName(tree)


@CATALOG.add("MOD-2", "EVA-2")
def installs_elastic_net(spark, sf_dir):
    train, _ = _vectors(spark, sf_dir, "Installs")
    return M.linear_summary(train, M.elastic_net(train, "Installs"))


_STRENGTHS = [30000.0, 3000.0, 0.3]


@CATALOG.add(
    "MOD-2",
    "EVA-2",
    sql=f"""SELECT strength, round(slope, 3) AS slope, round(ymean - slope * xmean, 3) AS intercept,
      round(sqrt(yvar - 2 * slope * xy + slope * slope * xvar), 2) AS rmse, round(1 - (yvar - 2 * slope * xy + slope * slope * xvar) / yvar, 4) AS r2
    FROM (SELECT *, sign(r) * greatest(abs(r) - 0.8::DOUBLE * strength / sy, 0) / (xvar / (sx * sx) + 0.2::DOUBLE * strength / sy) * sy / sx AS slope
      FROM (SELECT *, xy / (sx * sy) AS r, unnest([{", ".join(f"{v}::DOUBLE" for v in _STRENGTHS)}]) AS strength
        FROM (SELECT covar_pop(l_extendedprice, l_quantity) AS xy, stddev_samp(l_quantity) AS sx, stddev_samp(l_extendedprice) AS sy,
          var_pop(l_quantity) AS xvar, var_pop(l_extendedprice) AS yvar, avg(l_quantity) AS xmean, avg(l_extendedprice) AS ymean FROM lineitem)))""",
)
def price_elastic_net_path(spark, sf_dir):
    """With one feature the solution is a soft threshold."""
    rows = E.assemble(driver_table(spark, sf_dir, "lineitem"), ["l_quantity"], "l_extendedprice")
    lines = N.path_frame(rows, N.elastic_net_path(N.moments(rows, "l_extendedprice"), _STRENGTHS))
    shown = lines.selectExpr("strength", "coefficients[0] AS slope", "intercept", "rmse", "r2")
    figures = rounded(rounded(rounded(shown, "intercept", digits=3), "rmse", digits=2), "r2")
    # The sign stays where the threshold leaves nothing: -0.0, as in SQL.
    return figures.withColumn("slope", F.signum("slope") * F.round(F.abs("slope"), 3))


@CATALOG.add("MOD-2", "EVA-2")
def installs_elastic_net_path(spark, sf_dir):
    """Ten strengths from one pass over the training rows."""
    train, _ = _vectors(spark, sf_dir, "Installs")
    return N.path_frame(train, N.elastic_net_path(N.moments(train, "Installs"), [0.3 * 4.0**i for i in range(9, -1, -1)]))


@CATALOG.add("MOD-4", "EVA-1")
def rating_forest(spark, sf_dir):
    train, test = _vectors(spark, sf_dir, "Rating")
    return _scores(M.forest_regressor(train, "Rating"), test, "Rating")


@CATALOG.add("MOD-5", "EVA-1")
def price_boosted_trees(spark, sf_dir):
    train, test = _vectors(spark, sf_dir, "Price")
    return _scores(M.boosted_trees(train, "Price"), test, "Price")


@CATALOG.add("MOD-6", "EVA-3", "EVA-5")
def stars_forest(spark, sf_dir):
    train, test = _vectors(spark, sf_dir, "Rating", floor_label=True)
    return V.classification_metrics(M.forest_classifier(train, "Rating").transform(test), "Rating")


@CATALOG.add("MOD-7", "EVA-5")
def stars_shallow_forest(spark, sf_dir):
    train, test = _vectors(spark, sf_dir, "Rating", floor_label=True)
    model = M.forest_classifier(train, "Rating", maxDepth=4, maxBins=32, impurity="gini")
    trees = F.lit(model.toDebugString)
    return V.error_rate(model.transform(test), "Rating").withColumn("forest", trees)


def _labelled_vectors(spark, sf_dir):
    source = listings(
        spark, sf_dir, "App Id", "App Name", "Category", "Rating", "Rating Count", "Free", "Price", "Ad Supported", "Content Rating", busy=True
    )
    # The id only draws: it is no feature, and its frequency would need a count of all ids.
    drawn = P.labelled_listings(P.with_draw(source).drop("App Id")).withColumn("Ad Supported", F.col("Ad Supported").cast("double"))
    features = [c for c in drawn.columns if c not in ("Rating", P.DRAW)]
    return P.split_by_draw(stage(E.assemble(drawn, features, "Rating", keep=[P.DRAW]), "labelled"), 0.8)


@CATALOG.add("MOD-8", "EVA-4")
def stars_rbf_machine(spark, sf_dir):
    train, test = _labelled_vectors(spark, sf_dir)
    model = M.rbf_machine(train, "Rating")
    predicted = stage(model.transform(test).select("Rating", "prediction"), "predicted")
    return V.classification_report(predicted, "Rating")


@CATALOG.add("MOD-9")
def stars_machine_search(spark, sf_dir):
    train, _ = _labelled_vectors(spark, sf_dir)
    found = M.machine_search(train, "Rating", M.log_uniform(1.0, 1e4), key=[P.DRAW])
    return found.trials.select("trial", "parameters", "score", (F.col("parameters") == str(found.best)).alias("best"))


_MARGINS = ("l_quantity - 25", "l_discount * 100 - 5", "l_tax * 100 - 4")


@CATALOG.add(
    "MOD-8",
    sql=f"""SELECT prediction, count(*) AS rows FROM (SELECT CASE WHEN zero >= one AND zero >= two THEN 0.0::DOUBLE WHEN one >= two THEN 1.0 ELSE 2.0 END AS prediction
    FROM (SELECT (m01 <= 0)::INTEGER + (m02 <= 0)::INTEGER AS zero, (m01 > 0)::INTEGER + (m12 <= 0)::INTEGER AS one,
      (m02 > 0)::INTEGER + (m12 > 0)::INTEGER AS two
    FROM (SELECT round({_MARGINS[0]}, 6) AS m01, round({_MARGINS[1]}, 6) AS m02, round({_MARGINS[2]}, 6) AS m12 FROM lineitem))) GROUP BY 1""",
)
def votes_of_given_margins(spark, sf_dir):
    """Three classes, three pairs, so some rows have a vote each: the lowest class takes them."""
    margins = ", ".join(f"round({m}, 6)" for m in _MARGINS)
    rows = driver_table(spark, sf_dir, "lineitem").selectExpr(f"array({margins}) AS margins")
    return rows.groupBy(vote("margins", [0.0, 1.0, 2.0]).alias("prediction")).agg(F.count(F.lit(1)).alias("rows"))


@CATALOG.add("SNK-4", sql="SELECT count(*) AS rows, count(*) AS equal FROM part")
def reloaded_model(spark, sf_dir):
    rows = E.assemble(driver_table(spark, sf_dir, "part"), ["p_size"], "p_retailprice")
    model = M.linear(rows, "p_retailprice")
    path = scratch_path(spark, "line")
    save_model(model, path)
    again = load_model(LinearRegressionModel, path)
    both = again.setPredictionCol("again").transform(model.transform(rows))
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("prediction") == F.col("again")).alias("equal"))


# ---- evaluation on rule-based predictions ----

_PREDICTED = """predicted AS (SELECT CAST(floor("Rating") AS INTEGER) AS label, "Rating" AS y, "Rating Count" / 250.0::DOUBLE AS p,
  ("Rating Count" // 20) % 6 AS prediction FROM apps WHERE "Rating" IS NOT NULL)"""
_CLASSES = """classes AS (SELECT k.c AS class, coalesce(h::DOUBLE / nullif(np, 0), 0) AS precision, coalesce(h::DOUBLE / nullif(nl, 0), 0) AS recall,
  CASE WHEN np + nl = 0 THEN 0 ELSE 2.0::DOUBLE * h / (np + nl) END AS f1, nl AS support, h AS hits FROM (
    SELECT c, (SELECT count(*) FROM predicted WHERE label = c) AS nl, (SELECT count(*) FROM predicted WHERE prediction = c) AS np,
      (SELECT count(*) FROM predicted WHERE label = c AND prediction = c) AS h
    FROM (SELECT DISTINCT label AS c FROM predicted UNION SELECT DISTINCT prediction FROM predicted)) AS k)"""


def _predicted(spark, sf_dir):
    df = listings(spark, sf_dir, "Rating", "Rating Count").filter("Rating IS NOT NULL")
    return df.selectExpr("cast(floor(Rating) AS int) AS label", "Rating AS y", "`Rating Count` / 250D AS p", "(`Rating Count` div 20) % 6 AS prediction")


@CATALOG.add(
    "EVA-1",
    sql=listing_sql(
        """SELECT count(*) AS n, round(avg(pow(y - p, 2)), 4) AS mse, round(sqrt(avg(pow(y - p, 2))), 4) AS rmse,
        round(avg(abs(y - p)), 4) AS mae, round(1 - sum(pow(y - p, 2)) / (var_pop(y) * count(*)), 4) AS r2 FROM predicted""",
        _PREDICTED,
    ),
)
def regression_metrics(spark, sf_dir):
    return rounded(V.regression_metrics(_predicted(spark, sf_dir), "y", "p"), "mse", "rmse", "mae", "r2")


@CATALOG.add(
    "EVA-3",
    "EVA-5",
    sql=listing_sql(
        """SELECT round(sum(hits)::DOUBLE / sum(support), 4) AS accuracy, round(sum(f1 * support) / sum(support), 4) AS f1,
        round(sum(precision * support) / sum(support), 4) AS weighted_precision,
        round(sum(recall * support) / sum(support), 4) AS weighted_recall,
        round(1 - sum(hits)::DOUBLE / sum(support), 4) AS error_rate FROM classes""",
        _PREDICTED,
        _CLASSES,
    ),
)
def classification_metrics(spark, sf_dir):
    df = V.classification_metrics(_predicted(spark, sf_dir))
    return rounded(df, "accuracy", "f1", "weighted_precision", "weighted_recall", "error_rate")


@CATALOG.add(
    "EVA-4",
    sql=listing_sql(
        """SELECT class, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1, CAST(support AS BIGINT) AS support FROM (
        SELECT class::DOUBLE::VARCHAR AS class, precision, recall, f1, support FROM classes
        UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM classes
        UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
          sum(f1 * support) / sum(support), sum(support) FROM classes)""",
        _PREDICTED,
        _CLASSES,
    ),
)
def classification_report(spark, sf_dir):
    return rounded(V.classification_report(_predicted(spark, sf_dir)), "precision", "recall", "f1")


@CATALOG.add("EVA-5", sql=listing_sql("SELECT round(avg((label <> prediction)::INTEGER), 4) AS error_rate FROM predicted", _PREDICTED))
def error_rate(spark, sf_dir):
    return rounded(V.error_rate(_predicted(spark, sf_dir)), "error_rate")


@CATALOG.add(
    "EVA-6",
    sql=listing_sql(
        """SELECT fact, CAST(place AS INTEGER) AS place, subject, round(value, 2) AS value FROM (
        SELECT *, row_number() OVER (PARTITION BY fact ORDER BY value DESC, subject) AS place FROM (
          SELECT 'category by mean installs' AS fact, "Category" AS subject, floor(avg("Maximum Installs"))::DOUBLE AS value
            FROM apps WHERE "Maximum Installs" IS NOT NULL GROUP BY 2
          UNION ALL SELECT 'category by rating', "Category", avg("Rating") FROM apps WHERE "Rating" IS NOT NULL GROUP BY 2
          UNION ALL SELECT 'category by total installs', "Category", sum("""
        + INSTALLS_SQL
        + """)::DOUBLE FROM apps GROUP BY 2
          UNION ALL SELECT 'developer by score', "Developer Id", floor(sum("Rating") * sum("Rating Count")::DOUBLE / count(*))::DOUBLE
            FROM apps WHERE "Rating" IS NOT NULL GROUP BY 2
          UNION ALL SELECT 'developer by rating value', "Developer Id", avg("Rating" * "Rating Count") FROM apps GROUP BY 2))
        WHERE place <= 5
        UNION ALL SELECT 'expected installs', 1, 'all', round(avg("""
        + INSTALLS_SQL
        + """), 2) FROM apps
        UNION ALL SELECT 'expected rating', 1, 'all', round(avg("Rating") FILTER ("Rating Count" > 500), 2) FROM apps
        UNION ALL SELECT 'expected price', 1, 'all', round(avg("Price") FILTER (NOT "Free"), 2) FROM apps"""
    ),
)
def top_level_facts(spark, sf_dir):
    df = listings(spark, sf_dir, "Category", "Developer Id", "Rating", "Rating Count", "Installs", "Maximum Installs", "Free", "Price")
    return rounded(insights(df, min_critics=500), "value", digits=2)
