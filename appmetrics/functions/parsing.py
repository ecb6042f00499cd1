"""Column expressions that turn the text fields of a listing into typed values.

Everything here stays inside Catalyst expressions. Malformed text becomes null (``try_cast`` and
``try_to_date``), so the functions work with ANSI mode on. Expressions are written as SQL text: one call
to the JVM each, where a chain of Column calls costs milliseconds per link in the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from appmetrics.schema import DATE_FORMAT, VARIES, float_columns

# Size suffixes and their powers of ten.
SIZE_UNITS = {"G": 9, "M": 6, "k": 3}


# Fixed value: dates of any year from 1000 to 2999 in DATE_FORMAT, but for February 29.
_PLAIN_DATE = (
    r"^(?:(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) (?:[1-9]|1[0-9]|2[0-8])"
    r"|(?:Jan|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) (?:29|30)|(?:Jan|Mar|May|Jul|Aug|Oct|Dec) 31), [12][0-9]{3}\z"
)


def quoted(c: str) -> str:
    """Column name for SQL text; also right for names with spaces, dots and backticks."""
    return "`" + c.replace("`", "``") + "`"


def text(value: str) -> str:
    """String literal for SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def field(c: str | Column) -> Column:
    return c if isinstance(c, Column) else F.col(quoted(c))


def whole_number_sql(value: str) -> str:
    """A count written as a whole or decimal number (``64``, ``64.0``, ``1e3``), truncated; exact to 64 bits."""
    return f"try_cast(try_cast({value} AS decimal(38, 6)) AS bigint)"


def whole_number(c: str) -> Column:
    return F.expr(whole_number_sql(quoted(c)))


def count_from_text(c: str) -> Column:
    """``'1,000+'`` -> 1000."""
    return F.expr(whole_number_sql(f"translate(cast({quoted(c)} AS string), ',+', '')"))


def _size_sql(c: str) -> str:
    number = f"translate(trim({quoted(c)}), ',', '')"
    for suffix, exponent in SIZE_UNITS.items():
        number = f"regexp_replace({number}, '{suffix}$', 'e{exponent}')"
    return f"nanvl(try_cast({number} AS double), cast(null AS double))"


def size_bytes(c: str) -> Column:
    """``'3.3M'`` -> 3.3e6; a bare number counts bytes; anything else is null.

    The unit becomes an exponent, so the text is named once: an expression that repeats its input grows
    with every projection and filter Catalyst folds into it.
    """
    return F.expr(_size_sql(c))


def size_megabytes(c: str) -> Column:
    return F.expr(f"{_size_sql(c)} / 1e6D")


def _android_sql(c: str) -> str:
    return f"replace(replace(translate({quoted(c)}, ',', ''), {text(VARIES)}, '0.0'), ' and up', '')"


def android_version_text(c: str) -> Column:
    """``'4.1 and up'`` -> ``'4.1'``; the "varies" text becomes ``'0.0'``."""
    return F.expr(_android_sql(c))


def android_major_minor(c: str) -> Column:
    """First three characters as a number: ``'4.1 and up'`` -> 4.1."""
    return F.expr(f"try_cast(substring({_android_sql(c)}, 1, 3) AS double)")


def listing_date(c: str) -> Column:
    """``'May 21, 2020'`` -> date."""
    return F.expr(f"try_to_date({quoted(c)}, '{DATE_FORMAT}')")


def listing_year(c: str) -> Column:
    """Year of ``listing_date``. A text that is plainly a date of the calendar ends in it; only others are parsed as dates."""
    return F.expr(
        f"CASE WHEN {quoted(c)} RLIKE {text(_PLAIN_DATE)} THEN cast(right({quoted(c)}, 4) AS int) ELSE year(try_to_date({quoted(c)}, '{DATE_FORMAT}')) END"
    )


def day_text(c: str) -> Column:
    """Date part of ``'2021-06-16 01:37:34'``."""
    return F.expr(f"get(split({quoted(c)}, ' '), 0)")


def flag(c: str, null_as: bool | None = True) -> Column:
    """Text or boolean flag to boolean: ``false`` in any case is false, other text is true."""
    default = "cast(null AS boolean)" if null_as is None else str(null_as).lower()
    return F.expr(f"coalesce(lower(cast({quoted(c)} AS string)) != 'false', {default})")


def flag_bit(c: str) -> Column:
    """``True`` or 1 -> 1, ``False`` or 0 -> 0, other -> null."""
    return F.expr(
        f"CASE lower(cast({quoted(c)} AS string)) WHEN 'true' THEN 1 WHEN '1' THEN 1 WHEN 'false' THEN 0 WHEN '0' THEN 0 END"
    )


def missing_sql(c: str, is_float: bool) -> str:
    """Null, or NaN where the type has one."""
    return f"({quoted(c)} IS NULL OR isnan({quoted(c)}))" if is_float else f"({quoted(c)} IS NULL)"


def number_sql(c: str, is_float: bool) -> str:
    """The value as double, with NaN turned into null."""
    return f"nanvl(cast({quoted(c)} AS double), cast(null AS double))" if is_float else f"cast({quoted(c)} AS double)"


def complete_rows(df: DataFrame, columns=None) -> DataFrame:
    """Rows with a value (no null, no NaN) in every column, or in every listed one.

    A conjunction of single-column tests: Catalyst pushes each to the scan or join side it belongs to and
    drops those on columns that cannot be null. ``na.drop`` is one indivisible test over all columns.
    """
    floats = set(float_columns(df))
    nullable = {f.name for f in df.schema.fields if f.nullable}
    tests = []
    for c in columns if columns is not None else df.columns:
        if c in nullable:
            tests.append(f"{quoted(c)} IS NOT NULL")
        if c in floats:
            tests.append(f"NOT isnan({quoted(c)})")
    return df.filter(" AND ".join(tests)) if tests else df


def exact_sum(df: DataFrame, c: str) -> Column:
    """Sum of a column: whole numbers in decimal, so that no total overflows or depends on the order of rows."""
    if dict(df.dtypes)[c] in ("tinyint", "smallint", "int", "bigint"):
        return F.sum(F.expr(f"cast({quoted(c)} AS decimal(20, 0))"))
    return F.sum(field(c).cast("double"))
