"""Names and types of the listing table."""

from __future__ import annotations

from pyspark.sql import types as T

# The 24 listing columns in file order, as they stand in a raw CSV export.
LISTING_COLUMNS = [
    "App Name",
    "App Id",
    "Category",
    "Rating",
    "Rating Count",
    "Installs",
    "Minimum Installs",
    "Maximum Installs",
    "Free",
    "Price",
    "Currency",
    "Size",
    "Minimum Android",
    "Developer Id",
    "Developer Website",
    "Developer Email",
    "Released",
    "Last Updated",
    "Content Rating",
    "Privacy Policy",
    "Ad Supported",
    "In App Purchases",
    "Editors Choice",
    "Scraped Time",
]

# The types numeric and flag fields are parsed into; all other fields stay text.
TYPED_COLUMNS = {
    "Rating": "double",
    "Rating Count": "bigint",
    "Installs": "bigint",
    "Minimum Installs": "bigint",
    "Maximum Installs": "bigint",
    "Price": "double",
}

FLAG_COLUMNS = ["Free", "Ad Supported", "In App Purchases", "Editors Choice"]

# Fixed value: the text that stands for "no single size / version".
VARIES = "Varies with device"

# Fixed value: format of the Released and Last Updated fields ("May 21, 2020").
DATE_FORMAT = "MMM d, yyyy"


def raw_schema(columns=LISTING_COLUMNS) -> T.StructType:
    """All-text schema of a raw export."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def numeric_columns(df) -> list[str]:
    """Columns of a numeric type (booleans, dates and vectors do not count)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def float_columns(df) -> list[str]:
    """Columns that can hold NaN."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
