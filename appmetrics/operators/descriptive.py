"""Descriptive questions about listings: counts, prices, installs, sizes, ratings, developers.

Every answer is one filter, one partially aggregated group-by and a sort of the grouped rows; top-k
forms use ``orderBy().limit()``, which keeps k rows per task. Totals of whole numbers are summed in decimal:
those of a large table exceed a 64-bit integer. Results are given in double where the column was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from appmetrics.functions.parsing import exact_sum, field, quoted, size_bytes
from appmetrics.operators.shares import percent_of_total
from appmetrics.schema import VARIES


def _has(*columns: str):
    return F.expr(" AND ".join(f"{quoted(c)} IS NOT NULL" for c in columns))


def kind_counts(df: DataFrame) -> DataFrame:
    """One row: all, free and paid listings."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(field("Free")).alias("free"),
        F.count_if(~field("Free")).alias("paid"),
    )


def installs_by_kind(df: DataFrame) -> DataFrame:
    """Mean of the rounded-up middle of the install range, per free / paid, over all listings of the kind."""
    middle = F.ceil((field("Maximum Installs") + field("Minimum Installs")) / 2)
    return (
        df.filter(_has("Free"))
        .groupBy("Free")
        .agg((F.sum(middle.cast("double")) / F.count(F.lit(1))).alias("average_installs"))
    )


def installs_share_by_kind(df: DataFrame) -> DataFrame:
    return percent_of_total(installs_by_kind(df), "average_installs")


def prices_by_category(df: DataFrame, order: str = "average_price") -> DataFrame:
    """Paid listings: mean and highest price and count, by falling ``average_price`` or ``maximum_price``."""
    return (
        df.filter(_has("Category", "Price") & ~field("Free"))
        .groupBy("Category")
        .agg(
            F.avg("Price").alias("average_price"),
            F.max("Price").alias("maximum_price"),
            F.count(F.lit(1)).alias("listings"),
        )
        .orderBy(F.desc(order), "Category")
    )


def listings_per_group(df: DataFrame, group: str, n: int | None = None) -> DataFrame:
    """Number of listings per value of ``group``, most first."""
    counts = (
        df.filter(_has(group))
        .groupBy(field(group))
        .agg(F.count(F.lit(1)).alias("listings"))
        .orderBy(F.desc("listings"), field(group))
    )
    return counts if n is None else counts.limit(n)


def installs_by_category(df: DataFrame, n: int | None = None) -> DataFrame:
    """Mean (truncated) and highest of Maximum Installs per category, by falling mean."""
    out = (
        df.filter(_has("Category", "Maximum Installs"))
        .groupBy("Category")
        .agg(
            F.floor(F.avg("Maximum Installs")).cast("bigint").alias("average_installs"),
            F.max("Maximum Installs").alias("maximum_installs"),
        )
        .orderBy(F.desc("average_installs"), "Category")
    )
    return out if n is None else out.limit(n)


def size_by_category(df: DataFrame) -> DataFrame:
    """Mean size in megabytes, two decimals. Sizes that cannot be read stay out of the mean."""
    return (
        df.filter(_has("Size") & (field("Size") != VARIES))
        .groupBy("Category")
        .agg(F.round(F.avg(size_bytes("Size")) / 1e6, 2).alias("average_megabytes"))
        .orderBy(F.desc("average_megabytes"), "Category")
    )


def rating_histogram(df: DataFrame) -> DataFrame:
    """Listings per whole-star rating."""
    return (
        df.filter(_has("Rating"))
        .groupBy(F.floor("Rating").cast("int").alias("stars"))
        .agg(F.count(F.lit(1)).alias("listings"))
    )


def rating_shares(df: DataFrame) -> DataFrame:
    return percent_of_total(rating_histogram(df), "listings")


def rating_by_category(df: DataFrame, paid_only: bool = False) -> DataFrame:
    """Mean rating per category, best first."""
    wanted = _has("Category", "Rating")
    if paid_only:
        wanted = wanted & ~field("Free")
    return (
        df.filter(wanted)
        .groupBy("Category")
        .agg(F.avg("Rating").alias("average_rating"))
        .orderBy(F.desc("average_rating"), "Category")
    )


def developer_scores(df: DataFrame, n: int | None = None) -> DataFrame:
    """Per developer: sum of ratings times sum of rating counts over listings, truncated."""
    score = F.sum("Rating") * exact_sum(df, "Rating Count").cast("double") / F.count(F.lit(1))
    # Ordered before it is cut to 64 bits, so that larger scores do not tie.
    out = (
        df.filter(_has("Developer Id", "Rating", "Rating Count"))
        .groupBy("Developer Id")
        .agg(score.alias("exact"))
        .selectExpr("`Developer Id`", "exact", "cast(floor(exact) AS bigint) AS score")
        .orderBy(F.desc("score"), F.expr("CASE WHEN score = 9223372036854775807L THEN exact END").desc(), "Developer Id")
        .drop("exact")
    )
    return out if n is None else out.limit(n)


def kinds_by_category(df: DataFrame) -> DataFrame:
    """Free and paid listings per category."""
    return (
        df.filter(_has("Category", "Free"))
        .groupBy("Category")
        .agg(F.count_if(field("Free")).alias("free"), F.count_if(~field("Free")).alias("paid"))
    )


def reach_by_content_rating(df: DataFrame) -> DataFrame:
    """Sums of Maximum Installs and Rating Count per audience, largest pair first."""
    return (
        df.filter(_has("Rating Count", "Maximum Installs", "Content Rating"))
        .groupBy("Content Rating")
        .agg(exact_sum(df, "Maximum Installs").alias("installs"), exact_sum(df, "Rating Count").alias("ratings"))
        .orderBy(F.desc("installs"), F.desc("ratings"), "Content Rating")
        .selectExpr("`Content Rating`", "cast(installs AS double) AS installs", "try_cast(ratings AS bigint) AS ratings")
    )


def best_listings(df: DataFrame, free: bool, min_installs: int = 500_000, n: int | None = 10) -> DataFrame:
    """Names with more than ``min_installs`` installs in total: best rating first, then fewest installs."""
    out = (
        df.filter(_has("Minimum Installs", "Rating", "App Name") & (field("Free") == F.lit(free)))
        .groupBy("App Name")
        .agg(F.max("Rating").alias("rating"), exact_sum(df, "Minimum Installs").alias("total"))
        .filter(F.col("total") > min_installs)
        .orderBy(F.desc("rating"), F.asc("total"), "App Name")
    )
    first = out if n is None else out.limit(n)
    return first.selectExpr("`App Name`", "rating", "cast(total AS double) AS installs")
