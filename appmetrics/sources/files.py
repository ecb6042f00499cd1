"""CSV readers and writers for listing exports.

A CSV is read as text by header name and typed afterwards with ``try_cast``: no schema-inference job,
and a malformed field becomes null instead of failing the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from appmetrics.functions import parsing as P
from appmetrics.operators.columns import drop_columns, select_kind
from appmetrics.schema import TYPED_COLUMNS, raw_schema, text_columns

_LINE = "_irregular_line"
_END = "\u0001end"


def read_text_fields(spark: SparkSession, path: str, **options) -> DataFrame:
    """All fields as text, named by the header row. Quoted commas stay inside their field."""
    return spark.read.csv(path, header=True, escape='"', **options)


def read_well_formed(spark: SparkSession, path: str, columns=None, **options) -> DataFrame:
    """As ``read_text_fields``, without the lines that have more fields than the header.

    Lines with fewer fields are kept and padded with nulls. (``DROPMALFORMED`` would drop those too.)
    ``columns`` names the fields of files without a header.
    """
    header = list(columns or read_text_fields(spark, path, **options).columns)
    # A parser that skips unused columns would not count fields.
    counting = spark.read.option("columnPruning", False).option("columnNameOfCorruptRecord", _LINE)
    read = counting.csv(path, header=columns is None, escape='"', schema=raw_schema([*header, _LINE]), **options)
    # A line with another number of fields than the header is kept aside. With one more field at its end it is
    # short enough if that field still finds a place.
    sep = options.get("sep", ",")
    kinds = ", ".join(f"f{i} string" for i in range(len(header) + 1))
    again = F.from_csv(F.concat(F.col(_LINE), F.lit(f"{sep}{_END}")), kinds, {"escape": '"', "sep": sep})
    short = F.array_contains(F.array(*[again[f"f{i}"] for i in range(len(header) + 1)]), _END)
    return read.filter(F.col(_LINE).isNull() | short).drop(_LINE)


def type_listings(df: DataFrame) -> DataFrame:
    """Parse the numeric fields that are present and keep Editors Choice as text."""
    typed = {}
    for name, kind in TYPED_COLUMNS.items():
        if name in df.columns:
            if name == "Installs":
                typed[name] = P.count_from_text(name)
            else:
                typed[name] = P.whole_number(name) if kind == "bigint" else P.field(name).try_cast(kind)
    if "Editors Choice" in df.columns:
        typed["Editors Choice"] = P.field("Editors Choice").cast("string")
    return df.withColumns(typed) if typed else df


def read_listings(
    spark: SparkSession,
    path: str,
    features: str = "all",
    drop=(),
    encode=(),
    skip_malformed: bool = False,
) -> DataFrame:
    """Typed scan of a listing CSV.

    ``features`` is ``all``, ``Categorical`` or ``Numerical``; ``encode`` names text columns to replace
    by their frequency index; ``drop`` names columns to leave out.
    """
    reader = read_well_formed if skip_malformed else read_text_fields
    df = select_kind(type_listings(reader(spark, path)), features)
    if encode:
        from appmetrics.operators.features import label_encode

        df = label_encode(df, list(encode))
    return drop_columns(df, *drop)


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """CSV with a header. ``single_file`` sends all rows through one task; leave it off for big data."""
    (df.coalesce(1) if single_file else df).write.mode(mode).csv(path, header=True, escape='"')


def write_splits(splits: dict[str, DataFrame], folder: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Each split below ``folder/<name>``, written by the executors."""
    for name, df in splits.items():
        writer = df.write.mode(mode)
        if fmt == "csv":
            writer.csv(f"{folder}/{name}", header=True, escape='"')
        else:
            writer.format(fmt).save(f"{folder}/{name}")


def without_commas(df: DataFrame) -> DataFrame:
    """Commas leave the text: removed from Installs, turned into spaces elsewhere."""
    swaps = {
        c: F.translate(P.field(c), ",", "") if c == "Installs" else F.translate(P.field(c), ",", " ")
        for c in text_columns(df)
    }
    return df.withColumns(swaps) if swaps else df


def rewrite_without_commas(spark: SparkSession, source: str, target: str, single_file: bool = False) -> None:
    """Copy a CSV so that every comma in it separates fields."""
    write_csv(without_commas(read_well_formed(spark, source)), target, single_file)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(kind, path: str):
    """``kind`` is the model class, e.g. ``RandomForestClassificationModel``."""
    return kind.load(path)
