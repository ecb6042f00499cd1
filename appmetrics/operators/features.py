"""Encoders and vectors."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from appmetrics.functions.parsing import field
from appmetrics.functions.scratch import stage
from appmetrics.operators.ranking import running_totals


def value_counts(df: DataFrame, column: str, out: str = "count") -> DataFrame:
    """(value, rows) for the non-null values of a column."""
    return df.filter(field(column).isNotNull()).groupBy(field(column).alias(column)).agg(F.count(F.lit(1)).alias(out))


def with_value_counts(df: DataFrame, column: str, out: str) -> DataFrame:
    """How often each row's value occurs; null stays null.

    A join with the pre-aggregated counts, not a window: a value held by a third of the rows never
    gathers in one task. The counts are written first, so their size is known when the join is planned: few
    values are broadcast and the rows stay where they are read; only many values are joined by a shuffle.
    """
    return df.join(stage(value_counts(df, column, out), "counts"), column, "left")


def frequency_encode(df: DataFrame, columns) -> DataFrame:
    """Replace each value by its share of all rows; null stays null.

    One scan counts the values of all columns, and the rows. Values are told apart by their text.
    """
    columns = list(columns)
    entries = [F.struct(F.lit(-1).alias("_column"), F.lit("").alias("_value"))]
    for i, c in enumerate(columns):
        entries.append(F.when(field(c).isNotNull(), F.struct(F.lit(i).alias("_column"), field(c).cast("string").alias("_value"))))
    counts = stage(
        df.select(F.inline(F.array_compact(F.array(*entries)))).groupBy("_column", "_value").agg(F.count(F.lit(1)).alias("_rows")),
        "frequencies",
    )
    total = counts.filter(F.col("_column") == -1).agg(F.max("_rows")).first()[0] or 1
    out = df
    for i, c in enumerate(columns):
        table = counts.filter(F.col("_column") == i).select("_value", (F.col("_rows") / total).alias("_share"))
        out = out.join(table, field(c).cast("string") == F.col("_value"), "left").drop(c, "_value").withColumnRenamed("_share", c)
    return out.select(*[field(c) for c in df.columns])


def one_hot_encode(df: DataFrame, columns) -> DataFrame:
    """One boolean column ``<column>_<value>`` per value; the source columns go. Null is false in all of them.

    The result is as wide as there are values: use ``one_hot_vectors`` for columns with many.
    """
    out = df
    for c in columns:
        found = df.filter(field(c).isNotNull()).select(field(c).cast("string").alias("v")).distinct().collect()
        text = field(c).cast("string")
        flags = {f"{c}_{v}": F.coalesce(text == F.lit(v), F.lit(False)) for v in sorted(r["v"] for r in found)}
        out = out.withColumns(flags).drop(c)
    return out


def one_hot_vectors(df: DataFrame, columns) -> DataFrame:
    """Sparse one-hot vector ``<column>_vec`` per column; null gives a vector of zeros.

    Values get their places from the distributed label index (most frequent first), so a column may have any
    number of them.
    """
    columns = list(columns)
    indexes = label_indexes(df, columns, sequential=False)
    sizes = _index_sizes(indexes, columns)
    coded = encode_columns(df, columns, "_idx", indexes)
    for c in columns:
        size = max(1, sizes[c])
        place = F.greatest(field(f"{c}_idx"), F.when(field(c).isNull(), size).otherwise(0)).cast("double")
        coded = coded.withColumn(f"{c}_idx", place).withMetadata(f"{c}_idx", {"ml_attr": {"type": "nominal", "name": c, "num_vals": size}})
    # A place past the known values is kept as a value of its own, which is then dropped: zeros.
    encoder = OneHotEncoder(
        inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_vec" for c in columns], handleInvalid="keep", dropLast=True
    )
    return encoder.fit(coded).transform(coded).drop(*[f"{c}_idx" for c in columns])


def label_indexes(df: DataFrame, columns, sequential: bool = True) -> dict[str, DataFrame]:
    """For each column a table (value, index): 0 for the most frequent value, ties in text order.

    The indexes stay tables, so columns with any number of values (developers, e-mails) can be encoded,
    and all columns are counted in one scan and one shuffle. ``sequential`` counts, for each column, only
    rows whose earlier columns have a value, as encoders that drop null rows one after the other do.
    """
    columns = list(columns)
    values, kept = [], F.lit(True)
    for i, c in enumerate(columns):
        known = field(c).isNotNull()
        values.append(F.when(kept & known, field(c).cast("string")).alias(f"_value{i}"))
        if sequential:
            kept = kept & known
    # One set of grouping per column: its bit alone is not set in the grouping id.
    names, last = [f"_value{i}" for i in range(len(columns))], len(columns) - 1
    sets = df.select(*values).groupingSets([[F.col(n)] for n in names], *[F.col(n) for n in names])
    which = " ".join(f"WHEN {(2 << last) - 1 - (1 << last - i)} THEN {i}" for i in range(len(columns)))
    counts = (
        sets.agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_rows"))
        .select(F.expr(f"CASE _set {which} END").alias("_column"), F.coalesce(*names).alias("_value"), "_rows")
        .filter("_value IS NOT NULL")
    )
    ranked = running_totals(counts, [F.col("_column"), F.desc("_rows"), F.col("_value")], out="_place")
    first = ranked.groupBy("_column").agg(F.min("_place").alias("_first"))
    placed = stage(ranked.join(first, "_column"), "indexes")
    return {
        c: placed.filter(F.col("_column") == i).select(
            F.col("_value").alias("value"), (F.col("_place") - F.col("_first")).cast("double").alias("index")
        )
        for i, c in enumerate(columns)
    }


def label_encode(df: DataFrame, columns, indexes: dict[str, DataFrame] | None = None) -> DataFrame:
    """Replace each column by its label index; rows with a null (or unknown) value are dropped.

    The encoded columns carry their number of values as ML metadata, so trees treat them as categories.
    """
    indexes = indexes or label_indexes(df, columns)
    sizes = _index_sizes(indexes, columns)
    out = df
    for c in columns:
        table = indexes[c].select(F.col("value").alias("_value"), F.col("index").alias("_index"))
        out = out.join(table, field(c).cast("string") == F.col("_value")).drop(c, "_value").withColumnRenamed("_index", c)
    out = out.select(*[field(c) for c in df.columns])
    for c in columns:
        out = out.withMetadata(c, {"ml_attr": {"type": "nominal", "name": c, "num_vals": max(1, sizes[c])}})
    return out


def _index_sizes(indexes: dict[str, DataFrame], columns) -> dict[str, int]:
    """Number of values per index table, from one job over the (already written) tables."""
    parts = None
    for i, c in enumerate(columns):
        one = indexes[c].agg(F.lit(i).alias("i"), F.count(F.lit(1)).alias("n"))
        parts = one if parts is None else parts.unionByName(one)
    return {columns[r["i"]]: r["n"] for r in parts.collect()}


def label_decode(df: DataFrame, columns, indexes: dict[str, DataFrame]) -> DataFrame:
    """Inverse of ``label_encode`` with the same index tables; values come back as text."""
    out = df
    for c in columns:
        table = indexes[c].select(F.col("value").alias("_value"), F.col("index").alias("_index"))
        out = out.join(table, field(c) == F.col("_index")).drop(c, "_index").withColumnRenamed("_value", c)
    return out.select(*[field(c) for c in df.columns])


def encode_columns(df: DataFrame, columns, suffix: str = "_enc", indexes: dict[str, DataFrame] | None = None) -> DataFrame:
    """Add ``<column>_enc`` as int; a null or unknown value gets the number of known values."""
    columns = list(columns)
    indexes = indexes or label_indexes(df, columns, sequential=False)
    sizes = _index_sizes(indexes, columns)
    out = df
    for c in columns:
        table = indexes[c].select(F.col("value").alias("_value"), F.col("index").alias("_index"))
        code = F.coalesce(F.col("_index").cast("int"), F.lit(sizes[c]).cast("int"))
        out = (
            out.join(table, field(c).cast("string") == F.col("_value"), "left")
            .withColumn(c + suffix, code)
            .drop("_value", "_index")
        )
    return out


def decode_columns(df: DataFrame, columns, indexes: dict[str, DataFrame], suffix: str = "_enc") -> DataFrame:
    """Add ``<column>_orig`` next to each ``<column>_enc``; the index of unknown values gives null."""
    out = df
    for c in columns:
        table = indexes[c].select(F.col("value").alias(f"{c}_orig"), F.col("index").cast("int").alias("_index"))
        out = out.join(table, field(c + suffix) == F.col("_index"), "left").drop("_index")
    return out


def assemble(df: DataFrame, features, label: str | None = None, invalid: str = "error", out: str = "features", keep=()) -> DataFrame:
    """Feature vector; with a label, only the vector, the label and the ``keep`` columns stay.

    ``invalid`` is ``error``, ``skip`` or ``keep``.
    """
    rows = VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid=invalid).transform(df)
    return rows if label is None else rows.select(out, field(label), *[field(c) for c in keep])


def scale_columns(df: DataFrame, columns) -> DataFrame:
    """Divide each column by its sample standard deviation (no centering)."""
    return df.withColumns(
        {f"{c}_scaled": F.try_divide(field(c), df.agg(F.stddev_samp(field(c)).alias("s")).scalar()) for c in columns}
    )


def scale_vectors(df: DataFrame, column: str = "features", out: str = "scaled"):
    """(scaled frame, fitted scaler) for a vector column; unit deviation, no centering."""
    model = StandardScaler(inputCol=column, outputCol=out, withStd=True, withMean=False).fit(df)
    return model.transform(df), model
