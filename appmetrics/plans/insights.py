"""The top-level facts about a table of listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from appmetrics.functions.parsing import count_from_text, exact_sum
from appmetrics.functions.scratch import stage

# Of grouping_id(Category, Developer Id): which of the two is not grouped by.
CATEGORIES, DEVELOPERS, ALL = 1, 2, 3

# Fact, groups, value; whether groups without a value are left out.
_RANKED = (
    ("category by mean installs", CATEGORIES, "average_installs", True),
    ("category by rating", CATEGORIES, "average_rating", True),
    ("category by total installs", CATEGORIES, "total_installs", False),
    ("developer by score", DEVELOPERS, "score", True),
    ("developer by rating value", DEVELOPERS, "rating_value", False),
)
_EXPECTED = (("expected installs", "expected_installs"), ("expected rating", "expected_rating"), ("expected price", "expected_price"))


def group_facts(df: DataFrame, min_critics: int) -> DataFrame:
    """One row per category, per developer and for all listings (``groups``), from one pass over ``df``."""
    rows = df.withColumns({"_installs": count_from_text("Installs"), "_rating": F.expr("CASE WHEN NOT isnan(Rating) THEN Rating END")})
    rows = rows.withColumn("_both", F.expr("_rating IS NOT NULL AND `Rating Count` IS NOT NULL")).withColumn("_critics", F.expr("CASE WHEN _both THEN `Rating Count` END"))
    sets = rows.groupingSets([["Category"], ["Developer Id"], []], "Category", "Developer Id")
    found = sets.agg(
        F.expr("cast(grouping_id() AS int)").alias("groups"),
        F.expr("cast(floor(avg(`Maximum Installs`)) AS double)").alias("average_installs"),
        F.avg("_rating").alias("average_rating"),
        exact_sum(rows, "_installs").cast("double").alias("total_installs"),
        F.floor(F.expr("sum(CASE WHEN _both THEN _rating END)") * exact_sum(rows, "_critics").cast("double") / F.expr("nullif(count_if(_both), 0)")).cast("double").alias("score"),
        F.expr("avg(_rating * `Rating Count`)").alias("rating_value"),
        F.avg("_installs").alias("expected_installs"),
        F.expr(f"avg(CASE WHEN `Rating Count` > {min_critics} THEN _rating END)").alias("expected_rating"),
        F.expr("avg(CASE WHEN NOT Free THEN Price END)").alias("expected_price"),
    )
    return found.withColumn("subject", F.coalesce("Category", "Developer Id")).drop("Category", "Developer Id")


def insights(df: DataFrame, n: int = 5, min_critics: int = 2000) -> DataFrame:
    """(fact, place, subject, value): leading categories and developers, and the expected figures.

    ``df`` needs Category, Developer Id, Rating, Rating Count, Installs (text), Maximum Installs, Free, Price. It is
    read once; the groups, by both columns and in all, are written and the facts taken from there.
    """
    groups = stage(group_facts(df, min_critics), "facts")

    def ranked(name, kind, value, known):
        first = groups.filter((F.col("groups") == kind) & F.col("subject").isNotNull()).select("subject", F.col(value).alias("value"))
        if known:
            first = first.filter("value IS NOT NULL")
        first = first.orderBy(F.desc("value"), "subject").limit(n)
        # n rows at most, so numbering them takes one small task.
        rows = first.agg(F.array_sort(F.collect_list(F.struct((-F.col("value")).alias("o"), "subject", "value"))).alias("rows"))
        one = rows.select(F.posexplode("rows").alias("i", "r"))
        return one.select(F.lit(name).alias("fact"), (F.col("i") + 1).alias("place"), F.col("r.subject").alias("subject"), F.col("r.value").alias("value"))

    facts = F.array(*[F.struct(F.lit(name).alias("fact"), F.col(value).alias("value")) for name, value in _EXPECTED])
    out = groups.filter(F.col("groups") == ALL).select(F.inline(facts)).select("fact", F.lit(1).alias("place"), F.lit("all").alias("subject"), "value")
    for fact in _RANKED:
        out = out.unionByName(ranked(*fact))
    return out
