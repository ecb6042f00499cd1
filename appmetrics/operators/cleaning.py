"""Cleaning: sizes, outliers, missing values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from appmetrics.functions import parsing as P
from appmetrics.functions.scratch import stage
from appmetrics.operators.columns import shared_columns
from appmetrics.operators.profiling import long_aggregate
from appmetrics.operators.ranking import exact_quantiles
from appmetrics.schema import VARIES, float_columns, numeric_columns


def with_fixed_size(df: DataFrame, column: str = "Size") -> DataFrame:
    """Rows whose size is a single value (the "varies" text and null go)."""
    return df.filter(P.field(column) != VARIES)


def with_size_bytes(df: DataFrame, column: str = "Size") -> DataFrame:
    """``with_fixed_size`` with the size as a number of bytes."""
    return with_fixed_size(df, column).withColumn(column, P.size_bytes(column))


# ---- outliers ----


def outlier_bounds(df: DataFrame, columns=None, reach: float = 1.5) -> dict[str, tuple[float, float]]:
    """Per numeric column the quartiles widened by ``reach`` box lengths. All-null columns have none."""
    columns = list(columns or numeric_columns(df))
    bounds = {}
    for c, (q1, q3) in exact_quantiles(df, columns, [0.25, 0.75]).items():
        if q1 is not None:
            bounds[c] = (q1 - reach * (q3 - q1), q3 + reach * (q3 - q1))
    return bounds


def outlier_report(df: DataFrame, columns=None, bounds=None) -> DataFrame:
    """(column, outliers, percent). Without given bounds the numbers are derived and written once for both steps."""
    if not bounds:
        df = stage(df.select(*map(P.field, columns or numeric_columns(df))), "measured")
        bounds = outlier_bounds(df, columns)

    def counts(c):
        low, high = bounds[c]
        v = f"cast({P.quoted(c)} AS double)"
        return {"outliers": f"count_if({v} < {low!r}D OR {v} > {high!r}D)", "rows": "count(1)"}

    report = long_aggregate(df, list(bounds), counts)
    return report.selectExpr("column", "outliers", "try_divide(outliers * 100.0D, rows) AS percent")


def drop_outliers(df: DataFrame, columns=None, allowed: int = 1, bounds=None) -> DataFrame:
    """Keep rows that are outside the bounds in at most ``allowed`` columns.

    Without given bounds the rows are written once, so that the bounds and the range tests read plain numbers.
    """
    if not bounds:
        df = stage(df, "measured")
        bounds = outlier_bounds(df, columns)
    if not bounds:
        return df
    numbers = {c: f"cast({P.quoted(c)} AS double)" for c in bounds}
    outside = [f"if({numbers[c]} < {low!r}D OR {numbers[c]} > {high!r}D, 1, 0)" for c, (low, high) in bounds.items()]
    return df.filter(f"{' + '.join(outside)} <= {int(allowed)}")


def surviving_rows(original: DataFrame, cleaned: DataFrame, columns=None) -> DataFrame:
    """Rows of ``original`` whose shared columns appear in ``cleaned``."""
    return original.join(cleaned, columns or shared_columns(original, cleaned), "left_semi")


# ---- missing values ----


def drop_missing(df: DataFrame, columns=()) -> DataFrame:
    """Drop rows with null (or NaN) in a listed column; an empty list changes nothing."""
    return P.complete_rows(df, list(columns)) if columns else df



def _fill(df: DataFrame, values: dict) -> DataFrame:
    """Replace missing values by constants; whole-number columns take the truncated constant."""
    floats = set(float_columns(df))
    kinds = dict(df.dtypes)
    filled = {
        c: F.when(F.expr(P.missing_sql(c, c in floats)), F.lit(v).cast(kinds[c])).otherwise(P.field(c))
        for c, v in values.items()
        if v is not None
    }
    return df.withColumns(filled) if filled else df


def column_means(df: DataFrame, columns) -> dict:
    floats = set(float_columns(df))
    row = df.agg(*[F.expr(f"avg({P.number_sql(c, c in floats)})") for c in columns]).first()
    return {c: row[i] for i, c in enumerate(columns)}


def column_modes(df: DataFrame, columns) -> dict:
    """Most frequent value per column, the lowest on ties: a grouped count and a top-1, no value map in memory."""
    modes = {}
    for c in columns:
        counts = df.filter(P.field(c).isNotNull()).groupBy(P.field(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        top = counts.orderBy(F.desc("n"), "v").limit(1).collect()
        modes[c] = top[0]["v"] if top else None
    return modes


def fill_mean(df: DataFrame, columns) -> DataFrame:
    return _fill(df, column_means(df, list(columns)))


def fill_median(df: DataFrame, columns) -> DataFrame:
    return _fill(df, {c: q[0] for c, q in exact_quantiles(df, list(columns), [0.5]).items()})


def fill_mode(df: DataFrame, columns) -> DataFrame:
    return _fill(df, column_modes(df, list(columns)))


def handle_missing(df: DataFrame, method: str = "drop", columns=()) -> DataFrame:
    """``drop`` rows, or fill with the ``mean``, ``median`` or ``mode`` of each column."""
    ways = {"drop": drop_missing, "mean": fill_mean, "median": fill_median, "mode": fill_mode}
    if method not in ways:
        raise ValueError(f"unknown method: {method}")
    return ways[method](df, list(columns))
