"""Registered diagnostic queries: totals and means over complete numeric listings, best groups within groups, statistics."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from appmetrics.functions import parsing as P
from appmetrics.operators import columns as K, diagnostic as G, profiling as R, statistics as T
from appmetrics.operators.shares import percent_of_total
from appmetrics.plans.catalog import ANDROID_SQL, CATALOG, INSTALLS_SQL, SIZE_SQL, YEAR_SQL, listing_sql, rounded
from appmetrics.plans.preparation import diagnostic_listings
from appmetrics.sources.listing_view import driver_table, listings

# Complete listings with numeric Installs, Rating, Size (megabytes) and 0/1 flags.
_DIAGNOSTIC = f"""complete AS (
SELECT * REPLACE ({SIZE_SQL} / 1e6 AS "Size", {INSTALLS_SQL} AS "Installs", {ANDROID_SQL} AS "Minimum Android",
  CAST("Ad Supported" = 'True' AS INTEGER) AS "Ad Supported", CAST("In App Purchases" = 'True' AS INTEGER) AS "In App Purchases",
  CAST("Free" AS INTEGER) AS "Free", CAST("Editors Choice" AS INTEGER) AS "Editors Choice")
FROM apps WHERE "Size" <> 'Varies with device' AND {SIZE_SQL} IS NOT NULL AND "Rating" IS NOT NULL
  AND "Installs" IS NOT NULL AND "Maximum Installs" IS NOT NULL AND "Developer Email" IS NOT NULL
  AND "Released" IS NOT NULL AND "Ad Supported" IS NOT NULL)"""
_VALUE = '("Rating" * "Rating Count")'


def _sql(body: str) -> str:
    return listing_sql(body, _DIAGNOSTIC)


def _complete(spark, sf_dir):
    return diagnostic_listings(listings(spark, sf_dir, busy=True))


def _rated(spark, sf_dir):
    return K.with_rating_value(_complete(spark, sf_dir))


_BY_CATEGORY = 'SELECT "Category", CAST(sum("Installs") AS DOUBLE) AS total FROM complete GROUP BY 1'


@CATALOG.add("AGG-18", sql=_sql(_BY_CATEGORY + ' ORDER BY total DESC, "Category" LIMIT 20'))
def total_installs_by_category(spark, sf_dir):
    return G.group_totals(_complete(spark, sf_dir), "Category", "Installs", n=20)


@CATALOG.add(
    "AGG-18",
    "WIN-2",
    sql=_sql(f"SELECT *, round(total * 100 / sum(total) OVER (), 4) AS percent FROM ({_BY_CATEGORY})"),
)
def installs_share_by_category(spark, sf_dir):
    totals = G.group_totals(_complete(spark, sf_dir), "Category", "Installs")
    return rounded(percent_of_total(totals, "total"), "percent")


@CATALOG.add("AGG-19", sql=_sql('SELECT round(avg("Installs"), 2) AS mean FROM complete'))
def mean_installs(spark, sf_dir):
    return rounded(G.overall_mean(_complete(spark, sf_dir), "Installs"), "mean", digits=2)


@CATALOG.add("AGG-20", sql=_sql('SELECT "Ad Supported", CAST(sum("Installs") AS DOUBLE) AS total FROM complete GROUP BY 1'))
def total_installs_by_ads(spark, sf_dir):
    return G.group_totals(_complete(spark, sf_dir), "Ad Supported", "Installs", n=10)


@CATALOG.add(
    "AGG-21",
    "SCA-4",
    "SCA-5",
    sql=_sql(
        """SELECT TRY_CAST(left("Minimum Android", 3) AS DOUBLE) AS "Minimum Android", CAST(sum("Installs") AS DOUBLE) AS total
        FROM complete GROUP BY 1 ORDER BY total DESC, 1 LIMIT 10"""
    ),
)
def total_installs_by_android(spark, sf_dir):
    df = _complete(spark, sf_dir).withColumn("Minimum Android", P.android_major_minor("Minimum Android"))
    return G.group_totals(df, "Minimum Android", "Installs", n=10)


@CATALOG.add(
    "AGG-22",
    sql=_sql(
        """SELECT "Developer Id", CAST(sum("Installs") AS DOUBLE) AS total FROM complete GROUP BY 1
        ORDER BY total DESC, "Developer Id" LIMIT 10"""
    ),
)
def top_developers_by_installs(spark, sf_dir):
    return G.group_totals(_complete(spark, sf_dir), "Developer Id", "Installs", n=10)


@CATALOG.add(
    "AGG-23",
    "PRJ-12",
    sql=_sql(
        """SELECT "Ad Supported", count(*) FILTER ("Rating" > 0) AS rated,
        round(100.0::DOUBLE * count(*) FILTER ("Rating" > 0) / sum(count(*) FILTER ("Rating" > 0)) OVER (), 4) AS percent
        FROM complete GROUP BY 1"""
    ),
)
def rated_listings_by_ads(spark, sf_dir):
    return rounded(G.rated_counts(K.with_is_rated(_complete(spark, sf_dir)), "Ad Supported"), "percent")


def _mean_value_sql(group: str, value: str, where: str = "TRUE", tail: str = "") -> str:
    return _sql(f'SELECT {group}, round(avg({value}), 4) AS mean FROM complete WHERE {where} GROUP BY 1 {tail}')


@CATALOG.add("AGG-24", "PRJ-11", sql=_mean_value_sql('"Ad Supported"', _VALUE))
def rating_value_by_ads(spark, sf_dir):
    df = G.group_totals(_rated(spark, sf_dir), "Ad Supported", "Rating_Value", "mean", n=10, out="mean")
    return rounded(df, "mean")


@CATALOG.add("AGG-24", "FLT-5", sql=_mean_value_sql('"Ad Supported"', _VALUE, '"Rating" <> 0'))
def rating_value_by_ads_rated_only(spark, sf_dir):
    df = _rated(spark, sf_dir).filter(F.col("Rating") != 0)
    return rounded(G.group_totals(df, "Ad Supported", "Rating_Value", "mean", n=10, out="mean"), "mean")


_YEAR = YEAR_SQL.format('"Last Updated"')
_RELEASED = YEAR_SQL.format('"Released"')


@CATALOG.add(
    "AGG-25",
    "SCA-8",
    sql=_mean_value_sql(f'{_YEAR} AS "Last Updated"', _VALUE, '"Rating" <> 0', "ORDER BY mean DESC, 1 LIMIT 10"),
)
def rating_value_by_update_year(spark, sf_dir):
    df = K.with_year(_rated(spark, sf_dir).filter(F.col("Rating") != 0), "Last Updated")
    return rounded(G.group_totals(df, "Last Updated", "Rating_Value", "mean", n=10, out="mean"), "mean")


@CATALOG.add("AGG-26", sql=_mean_value_sql('"Content Rating"', '"Rating"', '"Rating" <> 0'))
def rating_by_content_rating(spark, sf_dir):
    df = _complete(spark, sf_dir).filter(F.col("Rating") != 0)
    return rounded(G.group_totals(df, "Content Rating", "Rating", "mean", n=10, out="mean"), "mean")


@CATALOG.add(
    "AGG-27",
    sql=_mean_value_sql('"Developer Id"', _VALUE, '"Rating" <> 0', 'ORDER BY mean DESC, "Developer Id" LIMIT 20'),
)
def top_developers_by_rating_value(spark, sf_dir):
    df = _rated(spark, sf_dir).filter(F.col("Rating") != 0)
    return rounded(G.group_totals(df, "Developer Id", "Rating_Value", "mean", n=20, out="mean"), "mean")


@CATALOG.add(
    "AGG-28",
    "SRT-1",
    sql=_mean_value_sql('"Category"', '"Rating"', '"Rating" <> 0', 'ORDER BY mean, "Category" LIMIT 20'),
)
def lowest_rated_categories(spark, sf_dir):
    df = _complete(spark, sf_dir).filter(F.col("Rating") != 0)
    return rounded(G.group_totals(df, "Category", "Rating", "mean", n=20, ascending=True, out="mean"), "mean")


@CATALOG.add("AGG-30", sql=listing_sql('SELECT "Category", "App Id" FROM apps ORDER BY "Category", "App Id"'))
def listings_in_category_order(spark, sf_dir):
    # The id splits a category that holds many rows over several ranges.
    return listings(spark, sf_dir, "Category", "App Id").orderBy("Category", "App Id")


# ---- two-variable points ----


def _grid_sql(x: str, y: str, dx: float, dy: float) -> str:
    return _sql(
        f"""SELECT floor({x} / {dx}::DOUBLE) * {dx}::DOUBLE AS x, floor({y} / {dy}::DOUBLE) * {dy}::DOUBLE AS y,
        count(*) AS points FROM complete GROUP BY 1, 2"""
    )


@CATALOG.add("AGG-32", sql=_grid_sql('"Size"', '"Installs"', 10.0, 100000.0))
def size_against_installs(spark, sf_dir):
    return R.point_grid(_complete(spark, sf_dir), "Size", "Installs", 10.0, 100000.0)


@CATALOG.add("AGG-32", "PRJ-11", sql=_grid_sql(_VALUE, '"Installs"', 100.0, 100000.0))
def rating_value_against_installs(spark, sf_dir):
    return R.point_grid(_rated(spark, sf_dir), "Rating_Value", "Installs", 100.0, 100000.0)


# ---- best groups inside each group ----


def _within_sql(outer: str, inner: str, value: str, outer_name: str, inner_name: str, where: str = "TRUE", digits: int = 4) -> str:
    return _sql(
        f"""SELECT "{outer_name}", "{inner_name}", round(mean, {digits}) AS mean, place FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY "{outer_name}" ORDER BY mean DESC, "{inner_name}") AS INTEGER) AS place
          FROM (SELECT {outer} AS "{outer_name}", {inner} AS "{inner_name}", avg({value}) AS mean
                FROM complete WHERE {where} GROUP BY 1, 2)) WHERE place <= 10"""
    )


@CATALOG.add("WIN-1", "FLT-9", sql=_within_sql('"Category"', '"Size"', '"Installs"', "Category", "Size", digits=2))
def best_sizes_within_category(spark, sf_dir):
    return rounded(G.best_groups_within(_complete(spark, sf_dir), "Category", "Size", "Installs"), "mean", digits=2)


@CATALOG.add("WIN-1", sql=_within_sql(_RELEASED, _YEAR, _VALUE, "Released", "Last Updated", '"Rating" <> 0'))
def best_update_years_within_release_year(spark, sf_dir):
    df = K.with_year(K.with_year(_rated(spark, sf_dir).filter(F.col("Rating") != 0), "Last Updated"), "Released")
    return rounded(G.best_groups_within(df, "Released", "Last Updated", "Rating_Value"), "mean")


@CATALOG.add("WIN-1", sql=_within_sql('"Category"', '"Content Rating"', '"Rating"', "Category", "Content Rating", '"Rating" <> 0'))
def best_content_ratings_within_category(spark, sf_dir):
    df = _complete(spark, sf_dir).filter(F.col("Rating") != 0)
    return rounded(G.best_groups_within(df, "Category", "Content Rating", "Rating"), "mean")


@CATALOG.add("WIN-1", sql=_within_sql('"Category"', '"Developer Id"', _VALUE, "Category", "Developer Id", '"Rating" <> 0'))
def best_developers_within_category(spark, sf_dir):
    df = _rated(spark, sf_dir).filter(F.col("Rating") != 0)
    return rounded(G.best_groups_within(df, "Category", "Developer Id", "Rating_Value"), "mean")


# ---- numeric statistics ----

_NUMBERS = ["Rating", "Rating Count", "Minimum Installs", "Maximum Installs", "Price"]


@CATALOG.add(
    "STA-1",
    sql=listing_sql(
        " UNION ALL ".join(
            f"""SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr("{a}", "{b}"), 4) + 0.0::DOUBLE AS value FROM apps"""
            for a, b in combinations(_NUMBERS, 2)
        )
    ),
)
def pearson_matrix(spark, sf_dir):
    return rounded(T.pearson_matrix(listings(spark, sf_dir, *_NUMBERS)), "value")


def _spearman_sql(a: str, b: str) -> str:
    return f"""SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr(ra, rb), 4) + 0.0::DOUBLE AS value, count(*) AS n FROM (
      SELECT rank() OVER (ORDER BY "{a}") + (count(*) OVER (PARTITION BY "{a}") - 1) / 2.0 AS ra,
             rank() OVER (ORDER BY "{b}") + (count(*) OVER (PARTITION BY "{b}") - 1) / 2.0 AS rb
      FROM apps WHERE "{a}" IS NOT NULL AND "{b}" IS NOT NULL)"""


_RANKED = ["Rating", "Rating Count", "Maximum Installs"]


@CATALOG.add("STA-2", sql=listing_sql(" UNION ALL ".join(_spearman_sql(a, b) for a, b in combinations(_RANKED, 2))))
def spearman_matrix(spark, sf_dir):
    return rounded(T.spearman_matrix(listings(spark, sf_dir, *_RANKED)), "value")


# ---- categorical statistics ----


@CATALOG.add(
    "STA-3",
    sql=listing_sql('SELECT "Category", "Content Rating", count(*) AS count FROM apps GROUP BY 1, 2'),
)
def contingency_table(spark, sf_dir):
    return T.contingency(listings(spark, sf_dir, "Category", "Content Rating"), "Category", "Content Rating")


@CATALOG.add(
    "STA-3",
    sql=listing_sql(
        """SELECT coalesce("Ad Supported", 'null') AS "Ad Supported_Free", count(*) FILTER (NOT "Free") AS "false",
        count(*) FILTER ("Free") AS "true" FROM apps GROUP BY 1"""
    ),
)
def contingency_table_wide(spark, sf_dir):
    return T.contingency_wide(listings(spark, sf_dir, "Ad Supported", "Free"), "Ad Supported", "Free")


def _chi_sql(a: str, b: str, source: str) -> str:
    """n, r, k and chi-square over the full grid of the two margins, empty cells included."""
    pairs = f'(SELECT "{a}"::VARCHAR AS a, "{b}"::VARCHAR AS b FROM {source} WHERE "{a}" IS NOT NULL AND "{b}" IS NOT NULL)'
    return f"""(SELECT any_value(n)::DOUBLE AS n, any_value(r) AS r, any_value(k) AS k,
      sum(CASE WHEN r = 2 AND k = 2 THEN pow(abs(o - e) - least(0.5, abs(o - e)), 2) ELSE pow(o - e, 2) END / e) AS chi_square
      FROM (SELECT coalesce(c.o, 0) AS o, x.n * y.n / t.n::DOUBLE AS e, t.n AS n, t.r AS r, t.k AS k
        FROM (SELECT a, count(*) AS n FROM {pairs} GROUP BY a) AS x
        CROSS JOIN (SELECT b, count(*) AS n FROM {pairs} GROUP BY b) AS y
        CROSS JOIN (SELECT count(*) AS n, count(DISTINCT a) AS r, count(DISTINCT b) AS k FROM {pairs}) AS t
        LEFT JOIN (SELECT a, b, count(*) AS o FROM {pairs} GROUP BY a, b) AS c ON c.a = x.a AND c.b = y.b))"""


def _v_sql(a: str, b: str, source: str) -> str:
    return f"""(SELECT round(sqrt(greatest(0, chi_square / n - (k - 1) * (r - 1) / (n - 1))
      / least(r - (r - 1) * (r - 1) / (n - 1) - 1, k - (k - 1) * (k - 1) / (n - 1) - 1)), 4) AS value FROM {_chi_sql(a, b, source)})"""


def _chi_query(a: str, b: str) -> str:
    return listing_sql(
        f"""SELECT n, r, k, round(chi_square, 4) AS chi_square, (r - 1) * (k - 1) AS degrees_of_freedom
        FROM {_chi_sql(a, b, "apps")}"""
    )


@CATALOG.add("STA-7", sql=_chi_query("Category", "Content Rating"))
def chi_square_of_category_and_content_rating(spark, sf_dir):
    df = listings(spark, sf_dir, "Category", "Content Rating")
    return rounded(T.chi_square(df, "Category", "Content Rating"), "chi_square")


@CATALOG.add("STA-7", sql=_chi_query("Ad Supported", "Free"))
def chi_square_of_ads_and_free(spark, sf_dir):
    return rounded(T.chi_square(listings(spark, sf_dir, "Ad Supported", "Free"), "Ad Supported", "Free"), "chi_square")


@CATALOG.add("STA-4", sql=listing_sql("SELECT value FROM " + _v_sql("Ad Supported", "Free", "apps")))
def cramers_v_of_ads_and_free(spark, sf_dir):
    return rounded(T.cramers_v(listings(spark, sf_dir, "Ad Supported", "Free"), "Ad Supported", "Free"), "value")


@CATALOG.add("STA-4", sql=listing_sql("SELECT value FROM " + _v_sql("Size", "Minimum Android", "apps")))
def cramers_v_of_size_and_android(spark, sf_dir):
    df = listings(spark, sf_dir, "Size", "Minimum Android")
    return rounded(T.cramers_v(df, "Size", "Minimum Android"), "value")


_CLASSES = ["Category", "Content Rating", "Ad Supported", "Free", "Currency", "Minimum Android"]


@CATALOG.add(
    "STA-5",
    sql=listing_sql(
        " UNION ALL ".join(
            [f"SELECT '{a}' AS column_a, '{b}' AS column_b, value FROM {_v_sql(a, b, 'filled')}" for a, b in combinations(_CLASSES, 2)]
            + [f"SELECT '{b}' AS column_a, '{a}' AS column_b, value FROM {_v_sql(a, b, 'filled')}" for a, b in combinations(_CLASSES, 2)]
            + [f"SELECT '{c}' AS column_a, '{c}' AS column_b, 1.0::DOUBLE AS value" for c in _CLASSES]
        ),
        "filled AS MATERIALIZED (SELECT " + ", ".join(f'"{c}"' for c in _CLASSES) + ' FROM apps WHERE "Ad Supported" IS NOT NULL)',
    ),
)
def association_matrix(spark, sf_dir):
    return rounded(T.association_matrix(listings(spark, sf_dir, *_CLASSES), _CLASSES), "value")


# ---- variance by category ----


def _anova_sql(category: str, value: str, source: str) -> str:
    return f"""SELECT groups, n, round(ss_between, 2) AS ss_between, round(ss_within, 2) AS ss_within,
      round((ss_between / (groups - 1)) / (ss_within / (n - groups)), 4) AS f FROM (
      SELECT count(DISTINCT g) AS groups, count(*) AS n, sum(pow(m - grand, 2)) AS ss_between, sum(pow(v - m, 2)) AS ss_within
      FROM (SELECT g, v, avg(v) OVER (PARTITION BY g) AS m, avg(v) OVER () AS grand
            FROM (SELECT "{category}" AS g, "{value}"::DOUBLE AS v FROM {source}
                  WHERE "{category}" IS NOT NULL AND "{value}" IS NOT NULL)))"""


@CATALOG.add("STA-6", sql=listing_sql(_anova_sql("Ad Supported", "Rating Count", "apps")))
def anova_of_rating_count_by_ads(spark, sf_dir):
    df = T.anova(listings(spark, sf_dir, "Ad Supported", "Rating Count"), "Ad Supported", "Rating Count")
    return rounded(rounded(df, "f"), "ss_between", "ss_within", digits=2)


@CATALOG.add("STA-6", sql=listing_sql(_anova_sql("Category", "Rating", "apps")))
def anova_of_rating_by_category(spark, sf_dir):
    df = T.anova(listings(spark, sf_dir, "Category", "Rating"), "Category", "Rating")
    return rounded(rounded(df, "f"), "ss_between", "ss_within", digits=2)


@CATALOG.add("STA-6", sql="WITH RECURSIVE " + "apps AS (SELECT * FROM events) " + _anova_sql("event_type", "value", "apps"))
def anova_of_event_value_by_type(spark, sf_dir):
    df = T.anova(driver_table(spark, sf_dir, "events"), "event_type", "value")
    return rounded(rounded(df, "f"), "ss_between", "ss_within", digits=2)


@CATALOG.add("STA-6", "STA-7")
def p_values(spark, sf_dir):
    """The incomplete gamma and beta functions behind these have no SQL form; tests hold them to known values."""
    apps = listings(spark, sf_dir, "Category", "Content Rating", "Ad Supported", "Free", "Rating", "Rating Count")
    found = [
        ("anova: Rating Count by Ad Supported", T.anova_p_value(apps, "Ad Supported", "Rating Count")),
        ("anova: Rating by Category", T.anova_p_value(apps, "Category", "Rating")),
        ("anova: value by event type", T.anova_p_value(driver_table(spark, sf_dir, "events"), "event_type", "value")),
        ("chi-square: Category and Content Rating", T.chi_square_p_value(apps, "Category", "Content Rating")),
        ("chi-square: Ad Supported and Free", T.chi_square_p_value(apps, "Ad Supported", "Free")),
    ]
    return spark.createDataFrame(found, "test string, p_value double")
