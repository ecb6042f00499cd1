"""Plans: what reaches the scan, and what must not appear."""

from __future__ import annotations

import pytest

from __spark_entry__ import queries
from appmetrics.operators import descriptive as D
from appmetrics.sources.listing_view import driver_table, listings, spread


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_and_filters_reach_the_scan(spark, small):
    text = plan(D.rating_by_category(listings(spark, small, "Category", "Rating", "Free"), paid_only=True))
    assert "Not(EqualTo(l_linestatus,O))" in text.replace(" ", "")
    scan = next(line for line in text.splitlines() if "l_tax" in line and "ReadSchema" in line)
    assert "l_extendedprice" not in scan.split("ReadSchema")[1] and "l_shipdate" not in scan.split("ReadSchema")[1]
    assert "o_orderkey" not in text  # the view joins only what the columns need


@pytest.mark.parametrize(
    "name",
    """cramers_v_of_size_and_android anova_of_rating_by_category frequency_encoded with_value_counts kind_counts installs_by_kind
    prices_by_category top_categories_by_installs size_by_category top_developers_by_score best_free_listings rating_bins
    total_installs_by_category best_developers_within_category null_report pearson_matrix association_matrix contingency_table
    chi_square_of_category_and_content_rating listings_in_category_order surplus_fields_skipped splits_written""".split(),
)
def test_no_nested_loops(spark, small, name):
    text = plan(queries()[name](spark, small))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_ranked_groups_are_cut_before_the_shuffle(spark, small):
    assert "WindowGroupLimit" in plan(queries()["best_developers_within_category"](spark, small))


def test_top_k_is_not_a_full_sort(spark, small):
    assert "TakeOrderedAndProject" in plan(queries()["top_developers_by_score"](spark, small))


def test_spread_leaves_wide_scans_alone(spark, small):
    cores = spark.sparkContext.defaultParallelism
    assert spread(driver_table(spark, small, "lineitem")).rdd.getNumPartitions() == cores
    many = spark.range(0, 10_000, 1, 2 * cores)
    assert spread(many) is many
