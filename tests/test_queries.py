"""Every registered query with an SQL form gives the same rows as DuckDB; the entry point works."""

import pytest
from oracle import difference, spark_rows, sql_rows

from __spark_entry__ import entry, oracle_sql, queries
from appmetrics.plans.catalog import all_queries


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, duck, small, name):
    got = spark_rows(queries()[name](spark, small))
    assert difference(got, sql_rows(duck, oracle_sql()[name])) is None


def test_entry(spark):
    rows = entry(spark)
    assert rows.columns == ["Category", "average_price", "maximum_price", "listings"]
    assert rows.count() > 0


# The training-data operators have tests of their own.
@pytest.mark.parametrize("name", sorted(n for n, q in all_queries().items() if q.sql is None))
def test_runs_without_sql(spark, small, name):
    assert queries()[name](spark, small).count() > 0


def test_inventory_is_covered():
    covered = {i for q in all_queries().values() for i in q.covers}
    groups = {
        "SRC": 4, "SNK": 4, "PRJ": 18, "FLT": 9, "CLN": 15, "SMP": 5, "JOI": 2, "AGG": 32, "WIN": 2, "SRT": 4,
        "SET": 1, "SCA": 10, "STA": 7, "CL": 13, "FEA": 7, "MOD": 9, "EVA": 6,
    }
    assert {f"{g}-{i}" for g, n in groups.items() for i in range(1, n + 1)} - covered == set()
