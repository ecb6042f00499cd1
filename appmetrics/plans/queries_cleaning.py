"""Registered queries for parsing, flags, filters, profiling, missing values, outliers and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from appmetrics.functions import parsing as P
from appmetrics.functions.scratch import scratch_path
from appmetrics.operators import cleaning as C, columns as K, profiling as R, sampling as S
from appmetrics.plans.catalog import ANDROID_SQL, CATALOG, INSTALLS_SQL, SIZE_SQL, YEAR_SQL, listing_sql, rounded
from appmetrics.plans.preparation import REQUIRED, clean_listings
from appmetrics.schema import FLAG_COLUMNS
from appmetrics.sources.files import (
    read_listings,
    read_text_fields,
    read_well_formed,
    rewrite_without_commas,
    type_listings,
    without_commas,
    write_csv,
    write_splits,
)
from appmetrics.sources.listing_view import driver_table, listings

# ---- parsing and projections ----


@CATALOG.add(
    "PRJ-1",
    "PRJ-2",
    "SCA-1",
    "SCA-2",
    "SCA-10",
    sql=listing_sql(
        f"""SELECT "App Id", "Rating", "Rating Count", {INSTALLS_SQL} AS "Installs", "Minimum Installs",
        "Maximum Installs", "Price" FROM apps"""
    ),
)
def typed_numbers(spark, sf_dir):
    return type_listings(
        listings(
            spark, sf_dir, "App Id", "Rating", "Rating Count", "Installs", "Minimum Installs", "Maximum Installs", "Price"
        )
    )


@CATALOG.add("CLN-1", "FLT-4", "SCA-4", "SCA-6", sql=listing_sql(f'SELECT "App Id", {SIZE_SQL} AS "Size" FROM apps WHERE "Size" <> \'Varies with device\''))
def sizes_in_bytes(spark, sf_dir):
    return C.with_size_bytes(listings(spark, sf_dir, "App Id", "Size"))


@CATALOG.add(
    "PRJ-3",
    "PRJ-6",
    "PRJ-7",
    "PRJ-8",
    "PRJ-16",
    sql=listing_sql(
        """SELECT "App Id", "Developer Website" IS NOT NULL AS "Developer Website",
        "Privacy Policy" IS NOT NULL AS "Privacy Policy",
        coalesce(lower("Ad Supported") <> 'false', TRUE) AS "Ad Supported",
        coalesce(lower("In App Purchases") <> 'false', TRUE) AS "In App Purchases",
        lower(CAST("Editors Choice" AS VARCHAR)) <> 'false' AS "Editors Choice" FROM apps"""
    ),
)
def presence_and_text_flags(spark, sf_dir):
    df = listings(
        spark, sf_dir, "App Id", "Developer Website", "Privacy Policy", "Ad Supported", "In App Purchases", "Editors Choice"
    )
    return K.text_flags(
        K.presence_flags(df, ["Developer Website", "Privacy Policy"]), ["Ad Supported", "In App Purchases", "Editors Choice"]
    )


@CATALOG.add(
    "PRJ-4",
    "PRJ-5",
    "PRJ-15",
    "SET-1",
    sql=listing_sql('SELECT "App Name", "Category", "Currency", "Content Rating", count(*) AS listings FROM apps GROUP BY ALL'),
)
def categorical_columns(spark, sf_dir):
    df = listings(spark, sf_dir, "App Name", "Category", "Rating", "Free", "Currency", "Content Rating", "Developer Id")
    kept = K.drop_columns(K.select_kind(df, "Categorical"), "developer id", "no such column")
    return kept.groupBy(*kept.columns).agg(F.count(F.lit(1)).alias("listings"))


@CATALOG.add(
    "PRJ-4",
    sql=listing_sql('SELECT "Rating", "Rating Count", count(*) AS listings FROM apps GROUP BY ALL'),
)
def numerical_columns(spark, sf_dir):
    df = K.select_kind(listings(spark, sf_dir, "Category", "Rating", "Rating Count", "Free"), "Numerical")
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("listings"))


@CATALOG.add(
    "PRJ-9",
    "FLT-6",
    "FLT-8",
    "PRJ-17",
    sql=listing_sql(
        """SELECT CAST("Ad Supported" = 'True' AS INTEGER) AS "Ad Supported",
        CAST("In App Purchases" = 'True' AS INTEGER) AS "In App Purchases", CAST("Free" AS INTEGER) AS "Free",
        CAST("Editors Choice" AS INTEGER) AS "Editors Choice", count(*) AS listings
        FROM apps WHERE "Ad Supported" IN ('True', 'False') GROUP BY ALL"""
    ),
)
def binary_indicators(spark, sf_dir):
    df = K.binary_indicators(listings(spark, sf_dir, *FLAG_COLUMNS))
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("listings"))


@CATALOG.add(
    "PRJ-10",
    "PRJ-11",
    "PRJ-12",
    sql=listing_sql(
        f"""SELECT "App Id", "Rating", "Rating Count", {INSTALLS_SQL} AS "Installs", round({SIZE_SQL} / 1e6, 4) AS "Size",
        {ANDROID_SQL} AS "Minimum Android", round("Rating" * "Rating Count", 4) AS "Rating_Value",
        CAST("Rating" > 0 AS INTEGER) AS "IsRated"
        FROM apps WHERE "Rating" IS NOT NULL AND "Installs" IS NOT NULL AND "Size" IS NOT NULL"""
    ),
)
def numeric_listings(spark, sf_dir):
    df = listings(spark, sf_dir, "App Id", "Rating", "Rating Count", "Installs", "Size", "Minimum Android")
    return rounded(K.with_is_rated(K.with_rating_value(K.numeric_listings(df))), "Size", "Rating_Value")


@CATALOG.add(
    "PRJ-13",
    "PRJ-14",
    "SCA-8",
    "SCA-3",
    sql=listing_sql(
        f"""SELECT "App Id", {YEAR_SQL.format('"Last Updated"')} AS "Last Updated", left("Scraped Time", 10) AS day,
        CAST(floor("Rating") AS INTEGER) AS "Rating" FROM apps"""
    ),
)
def years_days_and_floors(spark, sf_dir):
    df = listings(spark, sf_dir, "App Id", "Rating", "Last Updated", "Scraped Time")
    df = K.with_year(df, "Last Updated").withColumn("day", P.day_text("Scraped Time")).drop("Scraped Time")
    return K.label_last(K.floor_columns(df, "Rating"), "Rating")


@CATALOG.add(
    "FLT-5",
    sql=listing_sql(
        """SELECT "Rating", "Rating Count", count(*) AS listings FROM apps
        WHERE "Rating" >= 1 AND "Rating" <= 5 AND "Rating Count" >= 200 AND "Price" >= 0 GROUP BY ALL"""
    ),
)
def range_filters(spark, sf_dir):
    df = listings(spark, sf_dir, "Rating", "Rating Count", "Price")
    kept = df.filter("Rating >= 1 AND Rating <= 5").filter((F.col("Rating Count") >= 200) & (F.col("Price") >= 0))
    return kept.groupBy("Rating", "Rating Count").agg(F.count(F.lit(1)).alias("listings"))


@CATALOG.add("SRT-4", sql=listing_sql('SELECT "App Id", "Rating" FROM apps ORDER BY "App Id" LIMIT 5'))
def first_listings(spark, sf_dir):
    return K.preview(listings(spark, sf_dir, "App Id", "Rating").orderBy("App Id"))


# ---- profiling ----

_PROFILED = ["Rating", "Installs", "Maximum Installs", "Size", "Developer Website", "Developer Email", "Released", "Privacy Policy", "Ad Supported"]


@CATALOG.add(
    "CLN-5",
    "PRJ-18",
    sql=listing_sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS missing,
            round((count(*) - count("{c}")) * 100.0::DOUBLE / count(*), 4) AS percent FROM apps"""
            for c in _PROFILED
        )
    ),
)
def null_report(spark, sf_dir):
    return rounded(R.null_report(listings(spark, sf_dir, *_PROFILED)), "percent")


_MEASURED = ["Rating", "Rating Count", "Minimum Installs", "Maximum Installs", "Price"]


@CATALOG.add(
    "CLN-10",
    sql=listing_sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count("{c}") AS count, round(avg("{c}"), 4) AS mean,
            round(stddev_samp("{c}"), 4) AS stddev, round(min("{c}")::DOUBLE, 4) AS min, round(max("{c}")::DOUBLE, 4) AS max
            FROM apps"""
            for c in _MEASURED
        )
    ),
)
def summary_statistics(spark, sf_dir):
    return rounded(R.summary_statistics(listings(spark, sf_dir, *_MEASURED)), "mean", "stddev", "min", "max")


@CATALOG.add("CLN-10", sql=listing_sql('SELECT count(*) AS rows, CAST(24 AS BIGINT) AS columns FROM apps'))
def table_shape(spark, sf_dir):
    return R.table_shape(listings(spark, sf_dir))


@CATALOG.add("CLN-11", sql=listing_sql('SELECT "Currency", count(*) AS count FROM apps GROUP BY 1'))
def currency_frequencies(spark, sf_dir):
    return R.value_frequencies(listings(spark, sf_dir, "Currency"), "Currency")


@CATALOG.add("CLN-11", "SCA-3", sql=listing_sql('SELECT left("Scraped Time", 10) AS "Scraped Time", count(*) AS count FROM apps GROUP BY 1'))
def scraped_day_frequencies(spark, sf_dir):
    return R.scraped_day_frequencies(listings(spark, sf_dir, "Scraped Time"))


@CATALOG.add("CLN-11", "SCA-8", sql=listing_sql(f'SELECT {YEAR_SQL.format(chr(34) + "Last Updated" + chr(34))} AS "Last Updated", count(*) AS count FROM apps GROUP BY 1'))
def update_year_frequencies(spark, sf_dir):
    return R.value_frequencies(K.with_year(listings(spark, sf_dir, "Last Updated")), "Last Updated")


@CATALOG.add("CLN-12", sql=listing_sql("""SELECT round(100.0::DOUBLE * count(*) FILTER ("Size" = 'Varies with device') / count(*), 4) AS percent FROM apps"""))
def varying_size_share(spark, sf_dir):
    return rounded(R.value_share(listings(spark, sf_dir, "Size"), "Size", "Varies with device"), "percent")


_COUNTED = ["App Name", "Category", "Developer Id", "Minimum Android", "Released", "Last Updated"]


@CATALOG.add(
    "CLN-15",
    sql=listing_sql(
        " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(DISTINCT "{c}") AS distinct_values FROM apps""" for c in _COUNTED)
    ),
)
def distinct_counts(spark, sf_dir):
    return R.distinct_counts(listings(spark, sf_dir, *_COUNTED), _COUNTED)


def _box_sql(column: str, source: str) -> str:
    return f"""SELECT '{column}' AS "column", q.q1, q.median, q.q3,
    (SELECT min(v) FROM (SELECT "{column}"::DOUBLE AS v FROM {source}) WHERE v >= q.q1 - 1.5 * (q.q3 - q.q1)) AS whisker_low,
    (SELECT max(v) FROM (SELECT "{column}"::DOUBLE AS v FROM {source}) WHERE v <= q.q3 + 1.5 * (q.q3 - q.q1)) AS whisker_high,
    (SELECT count(*) FROM (SELECT "{column}"::DOUBLE AS v FROM {source})
     WHERE v < q.q1 - 1.5 * (q.q3 - q.q1) OR v > q.q3 + 1.5 * (q.q3 - q.q1)) AS outside
    FROM (SELECT quantile_disc("{column}"::DOUBLE, 0.25) AS q1, quantile_disc("{column}"::DOUBLE, 0.5) AS median,
          quantile_disc("{column}"::DOUBLE, 0.75) AS q3 FROM {source}) AS q"""


def _box_round(sql: str) -> str:
    return f'SELECT "column", round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(whisker_low, 4) AS whisker_low, round(whisker_high, 4) AS whisker_high, outside FROM ({sql})'


_BOX_OUT = ("q1", "median", "q3", "whisker_low", "whisker_high")


@CATALOG.add("AGG-31", sql=listing_sql(_box_round(" UNION ALL ".join(_box_sql(c, "apps") for c in _MEASURED))))
def box_statistics(spark, sf_dir):
    return rounded(R.box_statistics(listings(spark, sf_dir, *_MEASURED)), *_BOX_OUT)


@CATALOG.add("AGG-31", "CLN-3", sql=_box_round(_box_sql("value", "events")))
def event_box_statistics(spark, sf_dir):
    return rounded(R.box_statistics(driver_table(spark, sf_dir, "events"), ["value"]), *_BOX_OUT)


@CATALOG.add(
    "AGG-29",
    sql=listing_sql(
        """SELECT b.i AS bin, round(e.lo + b.i * (e.hi - e.lo) / 10, 4) AS low, round(e.lo + (b.i + 1) * (e.hi - e.lo) / 10, 4) AS high,
        count(v.p) AS count
        FROM (SELECT CAST(range AS INTEGER) AS i FROM range(10)) AS b CROSS JOIN edges AS e
        LEFT JOIN places AS v ON v.p = b.i GROUP BY ALL""",
        'edges AS (SELECT min("Rating") AS lo, max("Rating") AS hi FROM apps)',
        """places AS (SELECT least(CAST(floor(("Rating" - lo) / ((hi - lo) / 10)) AS INTEGER), 9) AS p
        FROM apps, edges WHERE "Rating" IS NOT NULL)""",
    ),
)
def rating_bins(spark, sf_dir):
    return rounded(R.equal_width_histogram(listings(spark, sf_dir, "Rating"), "Rating", 10), "low", "high")


@CATALOG.add(
    "AGG-29",
    sql=listing_sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", CAST(CAST(lower("{c}"::VARCHAR) = 'true' AS INTEGER) AS VARCHAR) AS value, count(*) AS count
            FROM apps WHERE "Ad Supported" IS NOT NULL GROUP BY ALL"""
            for c in FLAG_COLUMNS
        )
    ),
)
def flag_counts(spark, sf_dir):
    return R.flag_counts(K.binary_indicators(listings(spark, sf_dir, *FLAG_COLUMNS)), FLAG_COLUMNS)


# ---- missing values ----


@CATALOG.add(
    "CLN-6",
    "CLN-7",
    sql=listing_sql(
        """SELECT "App Id", round(coalesce("Rating", m.r), 4) AS "Rating",
        coalesce("Maximum Installs", CAST(trunc(m.i) AS BIGINT)) AS "Maximum Installs" FROM apps,
        (SELECT avg("Rating") AS r, avg("Maximum Installs") AS i FROM apps) AS m"""
    ),
)
def mean_filled(spark, sf_dir):
    df = listings(spark, sf_dir, "App Id", "Rating", "Maximum Installs")
    return rounded(C.handle_missing(df, "mean", ["Rating", "Maximum Installs"]), "Rating")


@CATALOG.add(
    "CLN-6",
    "CLN-8",
    sql=listing_sql(
        """SELECT "App Id", round(coalesce("Rating", m.r), 4) AS "Rating", coalesce("Maximum Installs", m.i) AS "Maximum Installs"
        FROM apps, (SELECT quantile_disc("Rating", 0.5) AS r, quantile_disc("Maximum Installs", 0.5) AS i FROM apps) AS m"""
    ),
)
def median_filled(spark, sf_dir):
    df = listings(spark, sf_dir, "App Id", "Rating", "Maximum Installs")
    return rounded(C.handle_missing(df, "median", ["Rating", "Maximum Installs"]), "Rating")


_MODE = """(SELECT "{c}" FROM apps WHERE "{c}" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, "{c}" LIMIT 1)"""


@CATALOG.add(
    "CLN-6",
    "CLN-9",
    sql=listing_sql(
        f"""SELECT "App Id", coalesce("Released", {_MODE.format(c="Released")}) AS "Released",
        coalesce("Ad Supported", {_MODE.format(c="Ad Supported")}) AS "Ad Supported" FROM apps"""
    ),
)
def mode_filled(spark, sf_dir):
    df = listings(spark, sf_dir, "App Id", "Released", "Ad Supported")
    return C.handle_missing(df, "mode", ["Released", "Ad Supported"])


@CATALOG.add(
    "CLN-6",
    "FLT-8",
    sql=listing_sql(
        """SELECT "App Id", "Rating", "Installs", "Released" FROM apps
        WHERE "Rating" IS NOT NULL AND "Installs" IS NOT NULL"""
    ),
)
def rows_without_missing(spark, sf_dir):
    return C.handle_missing(listings(spark, sf_dir, "App Id", "Rating", "Installs", "Released"), "drop", ["Rating", "Installs"])


# ---- outliers ----


def _bounds_cte(columns, source="apps") -> str:
    parts = ", ".join(
        f"""quantile_disc("{c}"::DOUBLE, 0.25) - 1.5 * (quantile_disc("{c}"::DOUBLE, 0.75) - quantile_disc("{c}"::DOUBLE, 0.25)) AS lo{i},
        quantile_disc("{c}"::DOUBLE, 0.75) + 1.5 * (quantile_disc("{c}"::DOUBLE, 0.75) - quantile_disc("{c}"::DOUBLE, 0.25)) AS hi{i}"""
        for i, c in enumerate(columns)
    )
    return f"bounds AS (SELECT {parts} FROM {source})"


def _flag(c: str, i: int) -> str:
    return f"""coalesce("{c}" < lo{i} OR "{c}" > hi{i}, FALSE)"""


@CATALOG.add(
    "CLN-4",
    sql=listing_sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) FILTER ({_flag(c, i)}) AS outliers,
            round(100.0::DOUBLE * count(*) FILTER ({_flag(c, i)}) / count(*), 4) AS percent FROM apps, bounds"""
            for i, c in enumerate(_MEASURED)
        ),
        _bounds_cte(_MEASURED),
    ),
)
def outlier_report(spark, sf_dir):
    return rounded(C.outlier_report(listings(spark, sf_dir, *_MEASURED)), "percent")



@CATALOG.add(
    "CLN-3",
    sql=listing_sql(
        f'''SELECT "App Id", {", ".join(f'"{c}"' for c in _MEASURED)} FROM apps, bounds WHERE '''
        + " + ".join(f"CAST({_flag(c, i)} AS INTEGER)" for i, c in enumerate(_MEASURED))
        + " <= 1",
        _bounds_cte(_MEASURED),
    ),
)
def listings_without_outliers(spark, sf_dir):
    return C.drop_outliers(listings(spark, sf_dir, "App Id", *_MEASURED))


@CATALOG.add(
    "CLN-3",
    sql=f"WITH {_bounds_cte(['value'], 'events')} SELECT event_id, value FROM events, bounds WHERE NOT {_flag('value', 0)}",
)
def events_without_outliers(spark, sf_dir):
    events = driver_table(spark, sf_dir, "events").select("event_id", "value")
    return C.drop_outliers(events, ["value"], allowed=0)


@CATALOG.add(
    "JOI-2",
    sql=listing_sql(
        """SELECT "App Id", "Category", "Price" FROM apps, bounds WHERE "Price" BETWEEN lo0 AND hi0""",
        _bounds_cte(["Price"]),
    ),
)
def rows_surviving_outlier_removal(spark, sf_dir):
    df = listings(spark, sf_dir, "App Id", "Category", "Price")
    return C.surviving_rows(df, C.drop_outliers(df, ["Price"], allowed=0).select("App Id", "Price"))


@CATALOG.add(
    "CLN-3",
    sql=f"""WITH squared AS (SELECT event_id, value, value * value AS square FROM events), {_bounds_cte(['value', 'square'], 'squared')}
    SELECT event_id FROM squared, bounds
    WHERE CAST({_flag('value', 0)} AS INTEGER) + CAST({_flag('square', 1)} AS INTEGER) <= 1""",
)
def events_outside_once_at_most(spark, sf_dir):
    value = F.col("value")
    events = driver_table(spark, sf_dir, "events").select("event_id", "value", (value * value).alias("square"))
    return C.drop_outliers(events, ["value", "square"]).select("event_id")


# ---- the whole cleaning chain ----

_KEPT_NUMBERS = ["Rating", "Rating Count", "Installs", "Minimum Installs", "Maximum Installs", "Price", "Size"]
_CLEAN_TEXT = ["App Name", "App Id", "Category", "Free", "Minimum Android", "Developer Id", "Developer Email", "Last Updated", "Content Rating", "Ad Supported", "In App Purchases"]
_CLEAN_SQL = listing_sql(
    f"""SELECT {", ".join(f'"{c}"' for c in _CLEAN_TEXT)}, lower("Editors Choice"::VARCHAR) AS "Editors Choice",
    coalesce("Released", (SELECT "Released" FROM kept WHERE "Released" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS "Released",
    round(coalesce("Rating", m.r), 4) AS "Rating", "Rating Count",
    coalesce("Maximum Installs", CAST(trunc(m.i) AS BIGINT)) AS "Maximum Installs",
    "Installs", "Minimum Installs", "Price", "Size"
    FROM kept, (SELECT avg("Rating") AS r, avg("Maximum Installs") AS i FROM kept) AS m""",
    f"""sized AS (SELECT * REPLACE ({SIZE_SQL} AS "Size", {INSTALLS_SQL} AS "Installs") FROM apps WHERE "Size" <> 'Varies with device')""",
    _bounds_cte(_KEPT_NUMBERS, "sized"),
    "kept AS (SELECT sized.* FROM sized, bounds WHERE "
    + " + ".join(f"CAST({_flag(c, i)} AS INTEGER)" for i, c in enumerate(_KEPT_NUMBERS))
    + " <= 1 AND "
    + " AND ".join(f'"{c}" IS NOT NULL' for c in REQUIRED)
    + ")",
)


@CATALOG.add("CLN-13", "CLN-3", "CLN-6", "PRJ-5", sql=_CLEAN_SQL)
def cleaned_listings(spark, sf_dir):
    return rounded(clean_listings(listings(spark, sf_dir, busy=True)), "Rating")


# ---- files ----


@CATALOG.add(
    "SRC-1",
    "SRC-2",
    "SNK-1",
    "FLT-1",
    sql=listing_sql(
        f"""SELECT "App Name", "App Id", "Rating", {INSTALLS_SQL} AS "Installs", "Price", "Size" FROM apps"""
    ),
)
def csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "listings-csv")
    write_csv(listings(spark, sf_dir, "App Name", "App Id", "Rating", "Installs", "Price", "Size", "Currency"), path)
    return read_listings(spark, path, drop=["Currency"])


@CATALOG.add(
    "SRC-3",
    "PRJ-1",
    sql=listing_sql(
        """SELECT "App Id", CASE WHEN "Rating Count" % 60 = 40 THEN NULL ELSE "Rating Count" END AS "Rating Count"
        FROM apps WHERE "Rating Count" % 100 NOT IN (0, 20)"""
    ),
)
def surplus_fields_skipped(spark, sf_dir):
    """Counts written as decimals, in lines of which some have too many fields, empty ones too, or too few."""
    path = scratch_path(spark, "listings-lines")
    end = """CASE WHEN `Rating Count` % 100 = 0 THEN ',,x' WHEN `Rating Count` % 100 = 20 THEN ',' ELSE '' END"""
    count = """CASE WHEN `Rating Count` % 100 IN (0, 20) THEN concat(',', `Rating Count`, '.0') WHEN `Rating Count` % 60 = 40 THEN ''
      WHEN `Rating Count` % 40 = 0 THEN concat(',', `Rating Count`) ELSE concat(',', `Rating Count`, '.0') END"""
    listings(spark, sf_dir, "App Id", "Rating Count").selectExpr(f"concat(`App Id`, {count}, {end}) AS line").write.text(path)
    return type_listings(read_well_formed(spark, path, columns=["App Id", "Rating Count"]))


@CATALOG.add(
    "SNK-3",
    sql=listing_sql("""SELECT "App Id", replace("Installs", ',', '') AS "Installs", replace("Released", ',', ' ') AS "Released" FROM apps"""),
)
def comma_free_copy(spark, sf_dir):
    source, target = scratch_path(spark, "with-commas"), scratch_path(spark, "without-commas")
    write_csv(listings(spark, sf_dir, "App Id", "Installs", "Released"), source)
    rewrite_without_commas(spark, source, target)
    return read_text_fields(spark, target)


@CATALOG.add(
    "SNK-3",
    sql=listing_sql("""SELECT "App Id", replace("Installs", ',', '') AS "Installs", replace("Released", ',', ' ') AS "Released" FROM apps"""),
)
def comma_free_text(spark, sf_dir):
    return without_commas(listings(spark, sf_dir, "App Id", "Installs", "Released"))


# ---- samples and splits ----


def _uniform_sql(seed: int) -> str:
    return f"""(CAST(concat('0x', left(md5(concat('{seed}|', "App Id")), 8)) AS BIGINT) / 4294967296.0::DOUBLE)"""


@CATALOG.add("SMP-1", sql=listing_sql(f'SELECT "App Id", "Category" FROM apps WHERE {_uniform_sql(1)} < 0.15'))
def sampled_fraction(spark, sf_dir):
    return S.sample_fraction(listings(spark, sf_dir, "App Id", "Category"), 0.15, 1, ["App Id"], portable=True)


@CATALOG.add("SMP-2", sql=listing_sql(f'SELECT "App Id", "Rating" FROM apps WHERE "Rating" IS NOT NULL ORDER BY {_uniform_sql(0)}, "App Id" LIMIT 4'))
def sampled_rows(spark, sf_dir):
    df = listings(spark, sf_dir, "App Id", "Rating").filter(F.col("Rating").isNotNull())
    return S.sample_rows(df, 4, 0, ["App Id"], portable=True)


_PARTS_SQL = listing_sql(
    f"""SELECT CASE WHEN u < 0.6 THEN 'train' WHEN u < 0.6 + 0.2 THEN 'val' ELSE 'test' END AS part, "App Id"
    FROM (SELECT "App Id", {_uniform_sql(7)} AS u FROM apps)"""
)


@CATALOG.add("SNK-2", sql=_PARTS_SQL)
def splits_written(spark, sf_dir):
    folder = scratch_path(spark, "splits")
    write_splits(S.train_validation_test(listings(spark, sf_dir, "App Id"), 7, portable=True), folder)
    parts = [read_text_fields(spark, f"{folder}/{name}").withColumn("part", F.lit(name)) for name in ("train", "val", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@CATALOG.add(
    "SMP-3",
    sql=listing_sql(
        f"""SELECT CASE WHEN u < 0.6 THEN 'train' WHEN u < 0.6 + 0.2 THEN 'val' ELSE 'test' END AS part, "App Id"
        FROM (SELECT "App Id", {_uniform_sql(7)} AS u FROM apps)"""
    ),
)
def train_validation_test(spark, sf_dir):
    parts = S.train_validation_test(listings(spark, sf_dir, "App Id"), 7, portable=True)
    out = None
    for name, part in parts.items():
        one = part.withColumn("part", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@CATALOG.add("SMP-4", sql=listing_sql(f'SELECT "App Id", {_uniform_sql(3)} < 0.8 AS train FROM apps'))
def train_test(spark, sf_dir):
    parts = S.split_rows(listings(spark, sf_dir, "App Id"), {"train": 0.8, "test": 0.2}, 3, portable=True)
    return parts["train"].withColumn("train", F.lit(True)).unionByName(parts["test"].withColumn("train", F.lit(False)))
