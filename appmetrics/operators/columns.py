"""Projections, flags and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from appmetrics.functions import parsing as P
from appmetrics.schema import FLAG_COLUMNS, numeric_columns, text_columns


def select_kind(df: DataFrame, kind: str = "all") -> DataFrame:
    """``Categorical`` keeps text columns, ``Numerical`` numeric ones, ``all`` everything."""
    if kind == "all":
        return df
    if kind == "Categorical":
        return df.select(*[P.field(c) for c in text_columns(df)])
    if kind == "Numerical":
        return df.select(*[P.field(c) for c in numeric_columns(df)])
    raise ValueError(f"unknown kind of columns: {kind}")


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Absent names are ignored; names match in any case."""
    return df.drop(*columns)


def presence_flags(df: DataFrame, columns) -> DataFrame:
    """Replace each column by whether it has a value."""
    return df.withColumns({c: P.field(c).isNotNull() for c in columns})


def text_flags(df: DataFrame, columns, null_as: bool | None = True) -> DataFrame:
    """Replace each text flag by a boolean."""
    return df.withColumns({c: P.flag(c, null_as) for c in columns})


def binary_indicators(df: DataFrame, columns=None) -> DataFrame:
    """Drop rows with any null, turn flags into 0/1, drop rows whose flag is neither."""
    flags = [c for c in (columns or FLAG_COLUMNS) if c in df.columns]
    return P.complete_rows(df.withColumns({c: P.flag_bit(c) for c in flags}))


def numeric_fields(df: DataFrame) -> dict:
    """Installs, Rating, Size (megabytes) as numbers and the cleaned version text.

    A text Size is parsed with its unit; a numeric one counts bytes.
    """
    by_text = "Size" in text_columns(df)
    size = P.size_megabytes("Size") if by_text else P.field("Size").cast("double") / F.lit(1e6)
    return {
        "Installs": P.count_from_text("Installs"),
        "Rating": P.field("Rating").try_cast("double"),
        "Size": size,
        "Minimum Android": P.android_version_text("Minimum Android"),
    }


def numeric_listings(df: DataFrame) -> DataFrame:
    """Drop rows with any null, then make the fields of ``numeric_fields`` numeric."""
    return P.complete_rows(df).withColumns(numeric_fields(df))


def with_rating_value(df: DataFrame, rating="Rating", count="Rating Count", out="Rating_Value") -> DataFrame:
    return df.withColumn(out, P.field(rating) * P.field(count))


def with_is_rated(df: DataFrame, rating="Rating", out="IsRated") -> DataFrame:
    """1 if the rating is above zero, else 0 (also for no rating)."""
    return df.withColumn(out, F.coalesce((P.field(rating) > 0).cast("int"), F.lit(0)))


def floor_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.floor(P.field(c)).cast("int") for c in columns})


def flags_as_int(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: P.flag_bit(c) for c in columns})


def label_last(df: DataFrame, label: str) -> DataFrame:
    """Move the label behind the features."""
    return df.select(*[P.field(c) for c in df.columns if c != label], P.field(label))


def feature_names(df: DataFrame, label: str) -> list[str]:
    return [c for c in df.columns if c != label]


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Names both frames have, in the order of the left one."""
    return [c for c in left.columns if c in set(right.columns)]


def other_columns(df: DataFrame, *columns: str) -> list[str]:
    return [c for c in df.columns if c not in set(columns)]


def wide_to_long(df: DataFrame, columns, name="column", value="value", keep=()) -> DataFrame:
    """One row per (row, column)."""
    return df.unpivot(list(keep), list(columns), name, value)


def with_year(df: DataFrame, column: str = "Last Updated") -> DataFrame:
    """Replace a listing date by its year; rows without a readable date go."""
    return df.withColumn(column, P.listing_year(column)).filter(P.field(column).isNotNull())


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
