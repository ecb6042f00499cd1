"""Registered descriptive queries."""

from __future__ import annotations

from appmetrics.operators import descriptive as D
from appmetrics.plans.catalog import CATALOG, SIZE_SQL, listing_sql, rounded
from appmetrics.sources.listing_view import listings


@CATALOG.add(
    "AGG-1",
    "FLT-3",
    "SRC-4",
    sql=listing_sql(
        'SELECT count(*) AS total, count(*) FILTER ("Free") AS free, count(*) FILTER (NOT "Free") AS paid FROM apps'
    ),
)
def kind_counts(spark, sf_dir):
    return D.kind_counts(listings(spark, sf_dir, "Free"))


_INSTALLS_BY_KIND = """kinds AS (
SELECT "Free", CAST(sum(ceil(("Maximum Installs" + "Minimum Installs") / 2.0)) AS DOUBLE) / count(*) AS average_installs
FROM apps WHERE "Free" IS NOT NULL GROUP BY "Free")"""


@CATALOG.add(
    "AGG-2",
    "SCA-7",
    sql=listing_sql('SELECT "Free", round(average_installs, 4) AS average_installs FROM kinds', _INSTALLS_BY_KIND),
)
def installs_by_kind(spark, sf_dir):
    df = listings(spark, sf_dir, "Free", "Minimum Installs", "Maximum Installs")
    return rounded(D.installs_by_kind(df), "average_installs")


@CATALOG.add(
    "AGG-3",
    "WIN-2",
    sql=listing_sql(
        """SELECT "Free", round(average_installs, 4) AS average_installs,
        round(average_installs * 100 / sum(average_installs) OVER (), 4) AS percent FROM kinds""",
        _INSTALLS_BY_KIND,
    ),
)
def installs_share_by_kind(spark, sf_dir):
    df = listings(spark, sf_dir, "Free", "Minimum Installs", "Maximum Installs")
    return rounded(D.installs_share_by_kind(df), "average_installs", "percent")


_PRICES = """SELECT "Category", round(avg("Price"), 4) AS average_price, round(max("Price"), 4) AS maximum_price,
count(*) AS listings FROM apps WHERE NOT "Free" AND "Category" IS NOT NULL AND "Price" IS NOT NULL GROUP BY "Category" """


@CATALOG.add("AGG-4", "AGG-5", "FLT-2", "FLT-3", "SRC-4", sql=listing_sql(_PRICES + 'ORDER BY average_price DESC, "Category"'))
def prices_by_category(spark, sf_dir):
    df = listings(spark, sf_dir, "Category", "Price", "Free")
    return rounded(D.prices_by_category(df), "average_price", "maximum_price")


@CATALOG.add("AGG-5", "SRT-1", sql=listing_sql(_PRICES + 'ORDER BY maximum_price DESC, "Category"'))
def prices_by_category_highest_first(spark, sf_dir):
    df = listings(spark, sf_dir, "Category", "Price", "Free")
    return rounded(D.prices_by_category(df, "maximum_price"), "average_price", "maximum_price")


@CATALOG.add(
    "AGG-6",
    sql=listing_sql('SELECT "Category", count(*) AS listings FROM apps WHERE "Category" IS NOT NULL GROUP BY 1'),
)
def listings_per_category(spark, sf_dir):
    return D.listings_per_group(listings(spark, sf_dir, "Category"), "Category")


_INSTALLS = """SELECT "Category", CAST(floor(avg("Maximum Installs")) AS BIGINT) AS average_installs,
max("Maximum Installs") AS maximum_installs FROM apps WHERE "Maximum Installs" IS NOT NULL GROUP BY 1"""


@CATALOG.add("AGG-7", "SCA-7", sql=listing_sql(_INSTALLS))
def installs_by_category(spark, sf_dir):
    return D.installs_by_category(listings(spark, sf_dir, "Category", "Maximum Installs"))


@CATALOG.add("AGG-7", "SRT-3", sql=listing_sql(_INSTALLS + ' ORDER BY average_installs DESC, "Category" LIMIT 10'))
def top_categories_by_installs(spark, sf_dir):
    return D.installs_by_category(listings(spark, sf_dir, "Category", "Maximum Installs"), 10)


@CATALOG.add(
    "AGG-8",
    "CLN-2",
    "FLT-4",
    sql=listing_sql(
        f"""SELECT "Category", round(avg({SIZE_SQL}) / 1e6, 2) AS average_megabytes FROM apps
        WHERE "Size" <> 'Varies with device' GROUP BY 1"""
    ),
)
def size_by_category(spark, sf_dir):
    return rounded(D.size_by_category(listings(spark, sf_dir, "Category", "Size")), "average_megabytes")


_DEVELOPERS = 'SELECT "Developer Id", count(*) AS listings FROM apps WHERE "Developer Id" IS NOT NULL GROUP BY 1'


@CATALOG.add("AGG-9", sql=listing_sql(_DEVELOPERS))
def listings_per_developer(spark, sf_dir):
    return D.listings_per_group(listings(spark, sf_dir, "Developer Id"), "Developer Id")


@CATALOG.add("AGG-9", "SRT-3", sql=listing_sql(_DEVELOPERS + ' ORDER BY listings DESC, "Developer Id" LIMIT 10'))
def top_developers_by_listings(spark, sf_dir):
    return D.listings_per_group(listings(spark, sf_dir, "Developer Id"), "Developer Id", 10)


_STARS = """stars AS (SELECT CAST(floor("Rating") AS INTEGER) AS stars, count(*) AS listings FROM apps
WHERE "Rating" IS NOT NULL GROUP BY 1)"""


@CATALOG.add("AGG-10", sql=listing_sql("SELECT * FROM stars", _STARS))
def rating_histogram(spark, sf_dir):
    return D.rating_histogram(listings(spark, sf_dir, "Rating"))


@CATALOG.add(
    "AGG-10",
    "WIN-2",
    sql=listing_sql("SELECT *, round(listings * 100.0::DOUBLE / sum(listings) OVER (), 4) AS percent FROM stars", _STARS),
)
def rating_shares(spark, sf_dir):
    return rounded(D.rating_shares(listings(spark, sf_dir, "Rating")), "percent")


@CATALOG.add(
    "AGG-11",
    sql=listing_sql('SELECT "Category", round(avg("Rating"), 4) AS average_rating FROM apps WHERE "Rating" IS NOT NULL GROUP BY 1'),
)
def rating_by_category(spark, sf_dir):
    return rounded(D.rating_by_category(listings(spark, sf_dir, "Category", "Rating")), "average_rating")


_SCORES = """SELECT "Developer Id",
CAST(floor(sum("Rating") * CAST(sum("Rating Count") AS DOUBLE) / count(*)) AS BIGINT) AS score
FROM apps WHERE "Rating" IS NOT NULL AND "Rating Count" IS NOT NULL GROUP BY 1"""


@CATALOG.add("AGG-12", sql=listing_sql(_SCORES))
def developer_scores(spark, sf_dir):
    return D.developer_scores(listings(spark, sf_dir, "Developer Id", "Rating", "Rating Count"))


@CATALOG.add("AGG-12", "SRT-3", sql=listing_sql(_SCORES + ' ORDER BY score DESC, "Developer Id" LIMIT 10'))
def top_developers_by_score(spark, sf_dir):
    return D.developer_scores(listings(spark, sf_dir, "Developer Id", "Rating", "Rating Count"), 10)


@CATALOG.add(
    "AGG-13",
    sql=listing_sql(
        'SELECT "Category", count(*) FILTER ("Free") AS free, count(*) FILTER (NOT "Free") AS paid FROM apps GROUP BY 1'
    ),
)
def kinds_by_category(spark, sf_dir):
    return D.kinds_by_category(listings(spark, sf_dir, "Category", "Free"))


@CATALOG.add(
    "AGG-14",
    sql=listing_sql(
        """SELECT "Category", round(avg("Rating"), 4) AS average_rating FROM apps
        WHERE "Rating" IS NOT NULL AND NOT "Free" GROUP BY 1"""
    ),
)
def paid_rating_by_category(spark, sf_dir):
    df = listings(spark, sf_dir, "Category", "Rating", "Free")
    return rounded(D.rating_by_category(df, paid_only=True), "average_rating")


@CATALOG.add(
    "AGG-15",
    "AGG-32",
    sql=listing_sql(
        """SELECT "Content Rating", CAST(sum("Maximum Installs") AS DOUBLE) AS installs,
        CAST(sum("Rating Count") AS BIGINT) AS ratings FROM apps
        WHERE "Maximum Installs" IS NOT NULL AND "Rating Count" IS NOT NULL GROUP BY 1"""
    ),
)
def reach_by_content_rating(spark, sf_dir):
    return D.reach_by_content_rating(listings(spark, sf_dir, "Content Rating", "Maximum Installs", "Rating Count"))


def _best_sql(free: str) -> str:
    return listing_sql(
        f"""SELECT "App Name", round(max("Rating"), 4) AS rating, CAST(sum("Minimum Installs") AS DOUBLE) AS installs
        FROM apps WHERE "Rating" IS NOT NULL AND "Minimum Installs" IS NOT NULL AND {free} "Free" GROUP BY 1
        HAVING sum("Minimum Installs") > 500000 ORDER BY rating DESC, installs, "App Name" LIMIT 10"""
    )


def _best(spark, sf_dir, free):
    df = listings(spark, sf_dir, "App Name", "Rating", "Minimum Installs", "Free")
    return rounded(D.best_listings(df, free), "rating")


@CATALOG.add("AGG-16", "FLT-7", "SRT-2", sql=_best_sql("NOT"))
def best_paid_listings(spark, sf_dir):
    return _best(spark, sf_dir, False)


@CATALOG.add("AGG-17", "FLT-7", "SRT-2", sql=_best_sql(""))
def best_free_listings(spark, sf_dir):
    return _best(spark, sf_dir, True)
