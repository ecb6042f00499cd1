"""Preparation of listings for analysis, clustering and modelling, as chains of operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from appmetrics.functions import parsing as P
from appmetrics.functions.hashing import uniform_hash
from appmetrics.functions.parsing import field
from appmetrics.functions.scratch import stage
from appmetrics.operators import cleaning as C, columns as K
from appmetrics.operators.features import assemble, encode_columns, frequency_encode, label_encode
from appmetrics.schema import text_columns
from appmetrics.sources.files import type_listings, without_commas

# Columns without use for the analyses, columns whose missing rows are dropped,
# columns filled with the mean and columns filled with the mode.
UNUSED = ["Developer Website", "Privacy Policy", "Currency", "Scraped Time"]
REQUIRED = [
    "Minimum Android",
    "Size",
    "Minimum Installs",
    "Installs",
    "Developer Email",
    "Developer Id",
    "Price",
    "Ad Supported",
    "In App Purchases",
]
MEAN_FILLED = ["Rating", "Rating Count", "Maximum Installs"]
MODE_FILLED = ["Released"]


def clean_listings(df: DataFrame, comma_free: bool = False) -> DataFrame:
    """Typed, sized, without outlier rows, without missing values.

    The parsed table is written once; small jobs over its numeric columns find the constants (quartiles,
    means, mode), and the result is one lazy plan with them.
    """
    sized = stage(C.with_size_bytes(K.drop_columns(type_listings(df), *UNUSED)), "sized")
    kept = C.drop_missing(C.drop_outliers(sized, bounds=C.outlier_bounds(sized)), REQUIRED)
    filled = C.fill_mode(C.fill_mean(kept, MEAN_FILLED), MODE_FILLED)
    return without_commas(filled) if comma_free else filled


def diagnostic_listings(df: DataFrame) -> DataFrame:
    """Complete rows with numeric Installs, Rating, Size (megabytes) and 0/1 flags.

    Parsing gives null where there is nothing to parse, so one completeness filter after it does the work
    of one before and one after.
    """
    kept = C.with_fixed_size(K.drop_columns(df, *[c for c in UNUSED if c != "Scraped Time"]))
    return K.binary_indicators(kept.withColumns(K.numeric_fields(kept)))


# ---- model inputs ----

# The model columns. A label is never also a feature.
MODEL_DROPPED = [
    "Scraped Time",
    "App Name",
    "App Id",
    "Minimum Installs",
    "Maximum Installs",
    "Currency",
    "Developer Email",
    "Developer Id",
]
MODEL_REQUIRED = [
    "Minimum Android",
    "Size",
    "Installs",
    "Price",
    "Ad Supported",
    "In App Purchases",
    "Released",
    "Last Updated",
]
MODEL_PARSED = ["Size", "Installs", "Price"]
MODEL_MEAN_FILLED = ["Rating", "Rating Count", "Installs"]
MODEL_PRESENCE = ["Privacy Policy", "Developer Website"]
MODEL_FLAGS = ["Ad Supported", "In App Purchases", "Editors Choice", "Free"]
MODEL_ENCODED = ["Category", "Minimum Android", "Content Rating"]
MODEL_FEATURES = [
    "Rating",
    "Rating Count",
    "Installs",
    "Price",
    "Size",
    "Last Updated",
    "Privacy Policy",
    "Developer Website",
    "Ad Supported",
    "In App Purchases",
    "Editors Choice",
    "Free",
    "Category_enc",
    "Minimum Android_enc",
    "Content Rating_enc",
]


def model_columns(label: str) -> list[str]:
    """Feature names for a label. Free says whether the price is zero, so it does not predict prices."""
    return [c for c in MODEL_FEATURES if c != label and not (label == "Price" and c == "Free")]


def model_rows(df: DataFrame, label: str, min_rating: float = 1.0, min_ratings: int = 200) -> DataFrame:
    """Cleaned and encoded rows for predicting ``label`` (Rating, Installs or Price), before assembly."""
    # What the means need is written once, with flags and years instead of texts. Parsed columns are tested for
    # missing values after that: a test before it would parse them twice.
    known = C.drop_missing(df, [c for c in MODEL_REQUIRED if c not in MODEL_PARSED])
    sized = K.drop_columns(C.with_size_bytes(type_listings(known)), *MODEL_DROPPED)
    flagged = K.text_flags(K.presence_flags(sized, MODEL_PRESENCE), MODEL_FLAGS)
    narrow = stage(flagged.withColumn("Last Updated", P.listing_year("Last Updated")), "sized")
    filled = C.fill_mean(C.drop_missing(narrow, MODEL_PARSED), MODEL_MEAN_FILLED)
    kept = filled.filter((field("Rating") >= min_rating) & (field("Rating Count") >= min_ratings))
    if label == "Price":
        kept = kept.filter(field("Price") >= 0)
    return encode_columns(kept.filter(field("Last Updated").isNotNull()), MODEL_ENCODED)


# Uniform number per row, for splitting after the other columns have become a vector.
DRAW = "draw"


def with_draw(df: DataFrame, seed: int = 0) -> DataFrame:
    """Adds the draw, from the listing's id where there is one: rows that are alike in all else draw apart."""
    return df.withColumn(DRAW, uniform_hash(["App Id"] if "App Id" in df.columns else df.columns, seed))


def model_vectors(df: DataFrame, label: str, floor_label: bool = False, seed: int = 0) -> DataFrame:
    """(features, label, draw) for predicting ``label``; ``floor_label`` turns ratings into whole-star classes."""
    rows = model_rows(with_draw(df, seed), label)
    if floor_label:
        rows = K.floor_columns(rows, label)
    return assemble(rows, model_columns(label), label, keep=[DRAW])


def split_by_draw(df: DataFrame, train: float) -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(DRAW) < train), df.filter(F.col(DRAW) >= train)


# Columns left out of, and columns label-encoded for, each all-column linear model.
LINEAR_INPUTS = {
    "Rating": {
        "drop": ["App Name", "App Id", "Price", "Size", "Free"],
        "encode": [
            "In App Purchases",
            "Minimum Android",
            "Developer Id",
            "Developer Email",
            "Released",
            "Last Updated",
            "Content Rating",
            "Ad Supported",
            "Editors Choice",
            "Category",
        ],
    },
    "Maximum Installs": {
        "drop": ["App Name", "App Id", "Price"],
        "encode": [
            "Category",
            "Ad Supported",
            "In App Purchases",
            "Editors Choice",
            "Free",
            "Minimum Android",
            "Developer Id",
            "Developer Email",
            "Released",
            "Last Updated",
            "Content Rating",
        ],
    },
    "Price": {
        "drop": [
            "App Name",
            "App Id",
            "Installs",
            "Maximum Installs",
            "Minimum Installs",
            "Rating",
            "Rating Count",
            "Size",
            "Content Rating",
            "Developer Id",
            "Developer Email",
        ],
        "encode": [
            "Category",
            "Ad Supported",
            "In App Purchases",
            "Editors Choice",
            "Free",
            "Minimum Android",
            "Released",
            "Last Updated",
        ],
    },
}


def encoded_vectors(cleaned: DataFrame, label: str, seed: int = 0) -> DataFrame:
    """(features, label, draw) from all remaining columns of cleaned listings; incomplete rows are skipped."""
    plan = LINEAR_INPUTS[label]
    kept = K.drop_columns(with_draw(cleaned, seed), *plan["drop"])
    ordered = K.label_last(label_encode(kept, plan["encode"]), label)
    return assemble(ordered, K.feature_names(ordered.drop(DRAW), label), label, invalid="skip", keep=[DRAW])


def labelled_listings(df: DataFrame, label: str = "Rating", drop=("App Name", "App Id", "Price", "Size")) -> DataFrame:
    """Whole-star labels with numeric features: Free as 0/1, every text column as its value's frequency."""
    rows = df
    if label == "Rating":
        text = F.replace(field("Rating").cast("string"), F.lit('"'), F.lit(""))
        rows = rows.withColumn("Rating", F.floor(text.try_cast("double")).cast("int"))
        rows = rows.filter(field("Rating").isNotNull() & (field("Rating") <= 5))
    rows = K.flags_as_int(rows, "Free")
    rows = rows.filter(field("Ad Supported").cast("string").isin("True", "False"))
    return K.drop_columns(frequency_encode(rows, text_columns(rows)), *drop)


def kmeans_listings(df: DataFrame, rating_value: bool = False) -> DataFrame:
    """Size (megabytes), Installs and Rating (or Rating_Value) of complete rows."""
    numeric = K.numeric_listings(C.with_size_bytes(df))
    if rating_value:
        return K.with_rating_value(numeric).select("Size", "Installs", "Rating_Value")
    return numeric.select("Size", "Installs", "Rating")


def lloyd_listings(df: DataFrame) -> DataFrame:
    """Rating, Maximum Installs and Size (bytes) where all three are known."""
    return P.complete_rows(C.with_size_bytes(df).select("Rating", "Maximum Installs", "Size"))


def flag_listings(df: DataFrame, columns=("Ad Supported", "In App Purchases", "Free")) -> DataFrame:
    """0/1 flags of rows that have all of them."""
    return K.binary_indicators(df.select(*[field(c) for c in columns]), list(columns))
