"""Registered queries: a name, what it covers, the Spark form and, where SQL can say it, the SQL form."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from appmetrics.sources.listing_view import LISTINGS_SQL


@dataclass(frozen=True)
class Query:
    """``covers`` lists the inventory ids the query exercises."""

    name: str
    covers: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


class Catalog:
    """Collects queries by decorator; the docstring-free functions below each one are the Spark form."""

    def __init__(self):
        self.queries: dict[str, Query] = {}

    def add(self, *covers: str, sql: str | None = None):
        def register(run):
            name = run.__name__
            if name in self.queries:
                raise ValueError(f"query registered twice: {name}")
            self.queries[name] = Query(name, covers, run, sql)
            return run

        return register


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    """Doubles at a fixed scale (and never -0.0), so that engines can be compared exactly."""
    return df.withColumns({c: F.expr(f"round(`{c}`, {digits}) + 0.0D") for c in columns})


def listing_sql(body: str, *more: str) -> str:
    """SQL over the CTE ``apps``; ``more`` are further CTEs written as ``name AS (...)``."""
    return "WITH RECURSIVE " + ",\n".join([f"apps AS ({LISTINGS_SQL})", *more]) + "\n" + body


# Size in bytes, installs as a number and version text, as SQL over a column of apps.
SIZE_SQL = """(CASE WHEN right("Size", 1) IN ('G', 'M', 'k')
  THEN TRY_CAST(replace(left("Size", length("Size") - 1), ',', '') AS DOUBLE) *
       CASE right("Size", 1) WHEN 'G' THEN 1e9::DOUBLE WHEN 'M' THEN 1e6::DOUBLE ELSE 1e3::DOUBLE END
  ELSE TRY_CAST(replace("Size", ',', '') AS DOUBLE) END)"""
INSTALLS_SQL = """TRY_CAST(replace(replace("Installs", ',', ''), '+', '') AS BIGINT)"""
ANDROID_SQL = """replace(replace("Minimum Android", 'Varies with device', '0.0'), ' and up', '')"""
YEAR_SQL = """CAST(year(strptime({}, '%b %-d, %Y')) AS INTEGER)"""

CATALOG = Catalog()


def all_queries() -> dict[str, Query]:
    """Every registered query; importing the modules registers them."""
    from appmetrics.plans import (  # noqa: F401
        queries_cleaning,
        queries_clustering,
        queries_descriptive,
        queries_diagnostic,
        queries_modelling,
        queries_trees,
    )

    return CATALOG.queries
