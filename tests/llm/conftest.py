import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 4999}x{i % 17}" for i in range(60_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))


def rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, rows that share an id."""
    texts = [
        None, "", "   \t\n", "one", "one two", "Hello, World! hello world", LONG, LONG + " end", "é ß 漢字 \U0001f600 x",
        f"before {PASSAGE} after it", f"{PASSAGE} only", "a " * 80, "  two  spaces\n\nand lines ", "one", PASSAGE.upper(),
    ]
    out = [(i, t, ["en", "de", None][i % 3], ["s1", "s2", None, "s0"][i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]
    out += [out[9], out[9], (9, "another text with the same id", "en", "s1", None), (None, "no id", "en", "s1", 5), (None, None, None, None, None)]
    return out


@pytest.fixture(scope="module")
def odd(spark):
    """Odd documents, with extra columns whose names the operators use inside."""
    clash = ["id", "row", "size", "key", "draw", "values", "text_hash", "packed", "fingerprint", "component", "rank", "ids", "made", "part", "whole"]
    docs = spark.createDataFrame(rows(), DOCS).repartition(3)
    return docs.withColumns({c: F.lit(f"mine {c}") for c in clash})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)
