"""Correlation, association and variance tests, computed from grouped counts and moments."""

from __future__ import annotations

from itertools import accumulate, combinations

from pyspark.sql import DataFrame, functions as F

from appmetrics.functions.distributions import chi_square_tail, f_tail
from appmetrics.functions.parsing import complete_rows, field, number_sql, quoted, text
from appmetrics.functions.scratch import stage
from appmetrics.operators.ranking import running_totals
from appmetrics.schema import float_columns, numeric_columns


# ---- numeric columns ----


def pearson_matrix(df: DataFrame, columns=None) -> DataFrame:
    """(column_a, column_b, value) for each unordered pair; a pair uses the rows where both have a value.

    All pairs come from one aggregate, so the table is read once.
    """
    columns = list(columns or numeric_columns(df))
    floats = set(float_columns(df))

    pairs = list(combinations(columns, 2))
    if not pairs:
        raise ValueError("need two numeric columns")
    # NaN becomes null once, below the aggregate; corr skips pairs with a null.
    values = df.selectExpr(*[f"{number_sql(c, c in floats)} AS v{i}" for i, c in enumerate(columns)])
    at = {c: f"v{i}" for i, c in enumerate(columns)}
    one = values.agg(*[F.expr(f"corr({at[a]}, {at[b]}) AS p{i}") for i, (a, b) in enumerate(pairs)])
    rows = [f"struct({text(a)} AS column_a, {text(b)} AS column_b, p{i} AS value)" for i, (a, b) in enumerate(pairs)]
    return one.selectExpr("inline(array(" + ", ".join(rows) + "))")


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rank correlation of two columns: one row (column_a, column_b, value, n)."""
    return _spearman(df, [(a, b)])


def spearman_matrix(df: DataFrame, columns=None) -> DataFrame:
    """(column_a, column_b, value, n) for each unordered pair; a pair uses the rows where both have a value."""
    return _spearman(df, list(combinations(columns or numeric_columns(df), 2)))


def _spearman(df: DataFrame, pairs) -> DataFrame:
    """Rank correlations with mean ranks for ties, all pairs together.

    Rows shrink to distinct value pairs with their counts before anything is ranked, so a value held by a
    third of the rows is one row here. The ranks of all columns of all pairs are one running total.
    """
    floats = set(float_columns(df))
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    at = {c: f"v{i}" for i, c in enumerate(columns)}
    values = df.selectExpr(*[f"{number_sql(c, c in floats)} AS {at[c]}" for c in columns])
    entries = ", ".join(f"struct({i} AS pair, {at[a]} AS a, {at[b]} AS b)" for i, (a, b) in enumerate(pairs))
    cells = stage(
        values.selectExpr(f"inline(array({entries}))")
        .filter("a IS NOT NULL AND b IS NOT NULL")
        .groupBy("pair", "a", "b")
        .agg(F.count(F.lit(1)).alias("w")),
        "cells",
    )
    sides = cells.selectExpr("pair", "w", "inline(array(struct(0 AS side, a AS v), struct(1 AS side, b AS v)))")
    ties = sides.groupBy("pair", "side", "v").agg(F.sum("w").alias("ties"))
    upto = stage(running_totals(ties, [F.col("pair"), F.col("side"), F.col("v")], "ties", "upto"), "ranks")
    # One number for each pair travels to the driver: both sides of a pair have its rows, so they tell where each begins.
    counted = {r["pair"]: r["n"] for r in cells.groupBy("pair").agg(F.sum("w").alias("n")).collect()}
    sizes = [counted.get(i, 0) for i in range(len(pairs))]
    begins = [2 * total for total in accumulate([0, *sizes[:-1]])]
    size, begin = (f"get(array({', '.join(f'{v}L' for v in numbers)}), pair)" for numbers in (sizes, begins))
    # distance of the mean rank from the middle rank
    ranks = upto.selectExpr(
        "pair", "side", "v", f"upto - ({begin} + side * {size}) - (ties - 1) / 2D - ({size} + 1) / 2D AS rank"
    )
    left = ranks.filter("side = 0").selectExpr("pair", "v AS a", "rank AS ra")
    right = ranks.filter("side = 1").selectExpr("pair", "v AS b", "rank AS rb")
    found = (
        cells.join(left, ["pair", "a"])
        .join(right, ["pair", "b"])
        .groupBy("pair")
        .agg(
            F.expr("try_divide(sum(w * ra * rb), sqrt(sum(w * ra * ra)) * sqrt(sum(w * rb * rb))) AS value"),
            F.expr("sum(w) AS n"),
        )
    )
    names = ", ".join(f"struct({text(a)} AS a, {text(b)} AS b)" for a, b in pairs)
    return found.selectExpr(f"get(array({names}), pair) AS name", "value", "n").selectExpr(
        "name.a AS column_a", "name.b AS column_b", "value", "n"
    )


# ---- categorical columns ----


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts per pair of values, in long form; null is a value of its own."""
    return df.groupBy(field(a), field(b)).agg(F.count(F.lit(1)).alias("count"))


def contingency_wide(df: DataFrame, a: str, b: str) -> DataFrame:
    """One column per value of ``b`` (for columns with few values)."""
    return df.crosstab(a, b)


def _pair_cells(df: DataFrame, pairs, complete_case: bool) -> DataFrame:
    """(pair, a, b, o): observed counts of every column pair from one scan and one shuffle."""
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    texts = df.selectExpr(*[f"cast({quoted(c)} AS string) AS t{i}" for i, c in enumerate(columns)])
    if complete_case:
        texts = complete_rows(texts)
    at = {c: f"t{i}" for i, c in enumerate(columns)}
    entries = ", ".join(f"struct({i} AS pair, {at[a]} AS a, {at[b]} AS b)" for i, (a, b) in enumerate(pairs))
    exploded = texts.selectExpr(f"inline(array({entries}))").filter("a IS NOT NULL AND b IS NOT NULL")
    return exploded.groupBy("pair", "a", "b").agg(F.count(F.lit(1)).cast("double").alias("o"))


def _chi_square_parts(cells: DataFrame) -> DataFrame:
    """Per pair: n, table shape, and chi-square (with the continuity correction on 2 x 2 tables).

    Over all cells, empty ones included, sum (o - e)^2 / e equals n * (sum o^2 / (row * column) - 1);
    empty cells add nothing to that sum, so the full grid is never built. In a 2 x 2 table |o - e| is
    the same in all four cells, which gives the corrected value from the margins alone.
    """
    rows = cells.groupBy("pair", "a").agg(F.sum("o").alias("ra"))
    cols = cells.groupBy("pair", "b").agg(F.sum("o").alias("cb"))
    parts = (
        cells.join(rows, ["pair", "a"])
        .join(cols, ["pair", "b"])
        # (o, row * column) of any one cell gives |o - e| of a 2 x 2 table
        .selectExpr("pair", "o", "o * o / ra / cb AS fit", "null AS row_total", "null AS column_total", "struct(o, ra * cb AS margins) AS cell")
    )
    rest = "cast(null AS struct<o:double,margins:double>) AS cell"
    row_marks = rows.selectExpr("pair", "null AS o", "null AS fit", "ra AS row_total", "null AS column_total", rest)
    col_marks = cols.selectExpr("pair", "null AS o", "null AS fit", "null AS row_total", "cb AS column_total", rest)
    sums = (
        parts.union(row_marks)
        .union(col_marks)
        .groupBy("pair")
        .agg(
            F.expr("sum(o) AS n"),
            F.expr("sum(fit) AS fit"),
            F.expr("count(row_total) AS r"),
            F.expr("count(column_total) AS k"),
            F.expr("sum(1 / row_total) AS inverse_rows"),
            F.expr("sum(1 / column_total) AS inverse_columns"),
            F.expr("max(cell) AS cell"),
        )
    )
    corrected = sums.withColumn("gap", F.expr("abs(cell.o - cell.margins / n)")).withColumn("gap", F.expr("gap - least(0.5D, gap)"))
    return corrected.selectExpr(
        "pair",
        "n",
        "r",
        "k",
        """CASE WHEN r = 2 AND k = 2 THEN n * gap * gap * inverse_rows * inverse_columns
           ELSE greatest(n * (fit - 1), 0.0D) END AS chi_square""",
    )


def _bias_corrected_v(parts: DataFrame) -> DataFrame:
    return (
        parts.withColumn("phi", F.expr("greatest(0.0D, chi_square / n - (k - 1) * (r - 1) / (n - 1))"))
        .withColumn("side", F.expr("least(r - (r - 1) * (r - 1) / (n - 1) - 1, k - (k - 1) * (k - 1) / (n - 1) - 1)"))
        .withColumn("value", F.expr("sqrt(try_divide(phi, side))"))
    )


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: n, r, k, chi_square, degrees_of_freedom."""
    parts = _chi_square_parts(_pair_cells(df, [(a, b)], True))
    return parts.select("n", "r", "k", "chi_square", ((F.col("r") - 1) * (F.col("k") - 1)).alias("degrees_of_freedom"))


def chi_square_p_value(df: DataFrame, a: str, b: str) -> float:
    row = chi_square(df, a, b).first()
    return chi_square_tail(row["chi_square"], row["degrees_of_freedom"])


def cramers_v(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: bias-corrected association of two columns, 0 to 1."""
    return _bias_corrected_v(_chi_square_parts(_pair_cells(df, [(a, b)], True))).select("value")


def association_matrix(df: DataFrame, columns, complete_case: bool = True) -> DataFrame:
    """(column_a, column_b, value) in full: both directions, and 1 on the diagonal.

    ``complete_case`` uses only rows with a value in every column; otherwise each pair uses its own.
    """
    columns = list(columns)
    pairs = list(combinations(columns, 2))
    if not pairs:
        raise ValueError("need two columns")
    found = _bias_corrected_v(_chi_square_parts(_pair_cells(df, pairs, complete_case)))
    names = ", ".join(f"struct({text(a)} AS a, {text(b)} AS b)" for a, b in pairs)
    upper = found.selectExpr(f"get(array({names}), pair) AS name", "value").selectExpr("name.a AS column_a", "name.b AS column_b", "value")
    lower = upper.selectExpr("column_b AS column_a", "column_a AS column_b", "value")
    diagonal = df.sparkSession.createDataFrame([(c, c, 1.0) for c in columns], "column_a string, column_b string, value double")
    return upper.unionByName(lower).unionByName(diagonal)


# ---- numeric by category ----


def anova(df: DataFrame, category: str, value: str, categories=()) -> DataFrame:
    """One row: groups, n, sums of squares between and within, F. Null groups and values stay out."""
    rows = complete_rows(df.select(field(category).alias("g"), field(value).cast("double").alias("v")))
    if categories:
        rows = rows.filter(F.col("g").isin(*categories))
    groups = rows.groupBy("g").agg(
        F.count("v").alias("n"), F.avg("v").alias("m"), (F.var_pop("v") * F.count("v")).alias("ss")
    )
    grand = groups.agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand")).scalar()
    gap = F.col("m") - grand
    sums = groups.agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * gap * gap).alias("ss_between"),
        F.sum("ss").alias("ss_within"),
    )
    between = F.try_divide(F.col("ss_between"), F.col("groups") - 1)
    within = F.try_divide(F.col("ss_within"), F.col("n") - F.col("groups"))
    return sums.withColumn("f", F.try_divide(between, within))


def anova_p_value(df: DataFrame, category: str, value: str, categories=()) -> float:
    """P-value of the one-way test (NaN if there are no two groups to compare)."""
    row = anova(df, category, value, categories).first()
    if row["groups"] < 2 or row["n"] <= row["groups"]:
        return float("nan")
    if row["f"] is None:
        return 0.0 if row["ss_between"] > 0 else float("nan")
    return f_tail(row["f"], row["groups"] - 1, row["n"] - row["groups"])
