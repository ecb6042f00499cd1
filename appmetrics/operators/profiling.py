"""Descriptions of a table: missing values, summaries, frequencies, distribution figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from appmetrics.functions import parsing as P
from appmetrics.operators.ranking import exact_quantiles
from appmetrics.schema import float_columns, numeric_columns


def long_aggregate(df: DataFrame, columns, make) -> DataFrame:
    """One aggregate over all columns, then one row (column, ...) per column.

    ``make`` gives, for a column name, a dict of output names to SQL aggregates.
    """
    structs, rows = [], []
    for i, c in enumerate(columns):
        fields = make(c)
        structs.append(F.expr("struct(" + ", ".join(f"{sql} AS {out}" for out, sql in fields.items()) + f") AS c{i}"))
        rows.append(f"struct({P.text(c)} AS column, " + ", ".join(f"c{i}.{out} AS {out}" for out in fields) + ")")
    return df.agg(*structs).selectExpr("inline(array(" + ", ".join(rows) + "))")


def null_report(df: DataFrame, columns=None) -> DataFrame:
    """(column, missing, percent): nulls, and NaN in float columns, most first."""
    floats = set(float_columns(df))
    report = long_aggregate(
        df,
        list(columns or df.columns),
        lambda c: {"missing": f"count_if({P.missing_sql(c, c in floats)})", "rows": "count(1)"},
    )
    return report.selectExpr("column", "missing", "try_divide(missing * 100.0D, rows) AS percent").orderBy(
        F.desc("missing"), "column"
    )


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("bigint"))


def summary_statistics(df: DataFrame, columns=None) -> DataFrame:
    """(column, count, mean, stddev, min, max) of the numeric columns, in one pass."""

    def measures(c):
        number = f"cast({P.quoted(c)} AS double)"
        return {
            "count": f"count({P.quoted(c)})",
            "mean": f"avg({number})",
            "stddev": f"stddev_samp({number})",
            "min": f"min({number})",
            "max": f"max({number})",
        }

    return long_aggregate(df, list(columns or numeric_columns(df)), measures)


def value_frequencies(df: DataFrame, column: str) -> DataFrame:
    """(column, count), most frequent first."""
    return (
        df.groupBy(P.field(column).alias(column))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), P.field(column))
    )


def scraped_day_frequencies(df: DataFrame, column: str = "Scraped Time") -> DataFrame:
    return value_frequencies(df.select(P.day_text(column).alias(column)), column)


def value_share(df: DataFrame, column: str, value) -> DataFrame:
    """Percent of all rows (also those without a value) that hold ``value``."""
    hit = F.coalesce(P.field(column) == F.lit(value), F.lit(False)).cast("double")
    return df.agg((F.avg(hit) * 100).alias("percent"))


def distinct_counts(df: DataFrame, columns, approximate: bool = False) -> DataFrame:
    """(column, distinct values). The exact form counts distinct (column, value) pairs in one shuffle."""
    columns = list(columns)
    if approximate:
        return long_aggregate(df, columns, lambda c: {"distinct_values": f"approx_count_distinct({P.quoted(c)})"})
    texts = df.selectExpr(*[f"cast({P.quoted(c)} AS string) AS {P.quoted(c)}" for c in columns])
    pairs = texts.unpivot([], columns, "column", "value").filter(F.col("value").isNotNull()).distinct()
    return pairs.groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(P.field(column)).distinct()


def box_statistics(df: DataFrame, columns=None, reach: float = 1.5) -> DataFrame:
    """Figures of a box plot per column: quartiles, and the last data points within ``reach`` box lengths."""
    columns = list(columns or numeric_columns(df))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    floats = set(float_columns(df))

    def figures(c):
        q1, median, q3 = quartiles[c]
        low, high, v = q1 - reach * (q3 - q1), q3 + reach * (q3 - q1), P.number_sql(c, c in floats)
        return {
            "q1": f"first({q1!r}D)",
            "median": f"first({median!r}D)",
            "q3": f"first({q3!r}D)",
            "whisker_low": f"min(CASE WHEN {v} >= {low!r}D THEN {v} END)",
            "whisker_high": f"max(CASE WHEN {v} <= {high!r}D THEN {v} END)",
            "outside": f"count_if({v} < {low!r}D OR {v} > {high!r}D)",
        }

    return long_aggregate(df, [c for c in columns if quartiles[c][0] is not None], figures)


def equal_width_histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """(bin, low, high, count) over [min, max]; the last bin holds its upper edge; empty bins count 0."""
    values = df.select(P.field(column).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    edges = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if edges["lo"] is None:
        raise ValueError(f"no values in {column}")
    lo, hi = edges["lo"], edges["hi"]
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    place = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counts = values.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("low"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("high"),
        F.coalesce("rows", F.lit(0)).cast("bigint").alias("count"),
    )


def flag_counts(df: DataFrame, columns) -> DataFrame:
    """(column, value, count) of several flags from one shuffle."""
    texts = df.selectExpr(*[f"cast({P.quoted(c)} AS string) AS {P.quoted(c)}" for c in columns])
    return texts.unpivot([], list(columns), "column", "value").groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("count")
    )


def point_grid(df: DataFrame, x: str, y: str, x_width: float, y_width: float) -> DataFrame:
    """Scatter plot as counts per grid cell: the cell's lower corner and the points in it."""
    cells = [(F.floor(P.field(c) / F.lit(w)) * F.lit(w)).cast("double") for c, w in ((x, x_width), (y, y_width))]
    return (
        df.filter(P.field(x).isNotNull() & P.field(y).isNotNull())
        .groupBy(cells[0].alias("x"), cells[1].alias("y"))
        .agg(F.count(F.lit(1)).alias("points"))
    )
