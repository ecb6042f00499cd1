"""A messy CSV, row by row, and the writers."""

import pytest
from pyspark.ml.regression import LinearRegressionModel

from appmetrics.functions import parsing as P
from appmetrics.operators import cleaning as C, columns as K, features as E, models as M, sampling as S
from appmetrics.schema import LISTING_COLUMNS
from appmetrics.sources import files as IO


def line(**fields):
    base = {c: "" for c in LISTING_COLUMNS}
    base.update({"App Name": "a", "Rating": "4.1", "Free": "True", "Size": "3.3M", "Price": "0"})
    base.update({k.replace("_", " "): v for k, v in fields.items()})
    return ",".join(base[c] for c in LISTING_COLUMNS)


ROWS = [
    line(App_Name="clean", Installs='"1,000+"', Last_Updated='"May 21, 2020"', Editors_Choice="False"),
    line(App_Name="comma size", Size='"1,018M"'),
    line(App_Name="bare", Size="1024"),
    line(App_Name="junk", Size="abc"),
    line(App_Name="varies", Size="Varies with device"),
    line(App_Name="no size", Size=""),
    line(App_Name="huge", Installs='"10,000,000,000+"'),
    line(App_Name="flags", Ad_Supported="", Free="false"),
    line(App_Name="short date", Last_Updated="May 21"),
    line(App_Name="bad number", Rating="n/a"),
    line(App_Name='"Foo, Bar"'),
    line(App_Name="too many") + ",x",
    line(App_Name="empty and more") + ",,x",
    line(App_Name="one empty more") + ",",
    line(App_Name="decimal counts", Rating_Count="64.0", Minimum_Installs="1e3", Maximum_Installs="12345678901234567890", Installs='"1,000.0+"'),
    "too few,id,cat",
]


@pytest.fixture(scope="module")
def path(tmp_path_factory):
    p = tmp_path_factory.mktemp("csv") / "apps.csv"
    p.write_text(",".join(LISTING_COLUMNS) + "\n" + "\n".join(ROWS) + "\n")
    return str(p)


def value(df, name, column):
    return df.filter(df["App Name"] == name).select(f"`{column}`").first()[0]


def test_typed_scan(spark, path):
    df = IO.read_listings(spark, path)
    assert df.columns == LISTING_COLUMNS
    assert value(df, "clean", "Installs") == 1000
    assert value(df, "huge", "Installs") == 10_000_000_000
    assert value(df, "bad number", "Rating") is None
    assert df.filter(df["App Name"] == "Foo, Bar").count() == 1


def test_counts_written_as_decimals(spark, path):
    df = IO.read_listings(spark, path)
    assert value(df, "decimal counts", "Rating Count") == 64
    assert value(df, "decimal counts", "Minimum Installs") == 1000
    assert value(df, "decimal counts", "Maximum Installs") is None
    assert value(df, "decimal counts", "Installs") == 1000
    assert value(df, "clean", "Rating Count") is None


def test_surplus_fields(spark, path):
    names = {r[0] for r in IO.read_well_formed(spark, path).select("App Name").collect()}
    assert names.isdisjoint({"too many", "empty and more", "one empty more"})
    assert {"too few", "clean", "Foo, Bar", "decimal counts"} <= names


def test_feature_subsets_and_encoding(spark, path):
    numbers = IO.read_listings(spark, path, "Numerical")
    assert "Rating" in numbers.columns and "Category" not in numbers.columns
    texts = IO.read_listings(spark, path, "Categorical", drop=["App Id"], encode=["Free"])
    assert "App Id" not in texts.columns and "Rating" not in texts.columns
    assert value(texts, "clean", "Free") == 0.0 and value(texts, "flags", "Free") == 1.0
    with pytest.raises(ValueError):
        IO.read_listings(spark, path, "other")


def test_malformed_lines(spark, path):
    names = {r[0] for r in IO.read_well_formed(spark, path).select("App Name").collect()}
    assert "too many" not in names and "too few" in names and len(names) == len(ROWS) - 3


def test_sizes(spark, path):
    df = C.with_size_bytes(IO.read_listings(spark, path))
    assert value(df, "clean", "Size") == 3.3e6
    assert value(df, "comma size", "Size") == 1.018e9
    assert value(df, "bare", "Size") == 1024.0
    assert value(df, "junk", "Size") is None
    assert df.filter(df["App Name"].isin("varies", "no size")).count() == 0


def test_flags_and_years(spark, path):
    df = IO.read_listings(spark, path)
    flags = K.text_flags(df, ["Ad Supported", "Free", "Editors Choice"])
    assert value(flags, "flags", "Ad Supported") is True  # no value counts as true
    assert value(flags, "flags", "Free") is False
    assert value(flags, "clean", "Editors Choice") is False
    assert value(K.text_flags(df, ["Ad Supported"], null_as=None), "flags", "Ad Supported") is None
    assert dict(flags.dtypes)["Free"] == "boolean"
    years = K.with_year(df)
    assert [r[0] for r in years.select("Last Updated").collect()] == [2020]


def test_round_trip_and_commas(spark, path, tmp_path):
    out, plain = str(tmp_path / "out"), str(tmp_path / "plain")
    IO.write_csv(IO.read_text_fields(spark, path), out, single_file=True)
    assert IO.read_text_fields(spark, out).count() == len(ROWS)
    IO.rewrite_without_commas(spark, path, plain)
    again = IO.read_text_fields(spark, plain)
    assert value(again, "clean", "Installs") == "1000+"
    assert again.filter("`App Name` = 'Foo  Bar'").count() == 1
    assert value(again, "clean", "Last Updated") == "May 21  2020"


def test_splits_written(spark, tmp_path):
    df = spark.range(1000).withColumnRenamed("id", "n")
    parts = S.train_validation_test(df, seed=3)
    for fmt in ("csv", "parquet"):
        folder = str(tmp_path / fmt)
        IO.write_splits(parts, folder, fmt)
        read = spark.read.option("header", True).format(fmt)
        sizes = {name: read.load(f"{folder}/{name}").count() for name in parts}
        assert sum(sizes.values()) == 1000
        assert abs(sizes["train"] - 600) < 60 and abs(sizes["val"] - 200) < 50


def test_model_round_trip(spark, tmp_path):
    rows = E.assemble(spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "x double, y double"), ["x"], "y")
    model = M.linear(rows, "y")
    IO.save_model(model, str(tmp_path / "m"))
    again = IO.load_model(LinearRegressionModel, str(tmp_path / "m"))
    assert again.coefficients == model.coefficients and abs(again.coefficients[0] - 2) < 1e-9


def test_odd_names(spark):
    df = spark.createDataFrame([("1,0+", None)], "`a.b` string, `c``d` string")
    assert df.select(P.count_from_text("a.b")).first()[0] == 10
    assert P.complete_rows(df).count() == 0 and P.complete_rows(df, ["a.b"]).count() == 1
