"""From raw documents to token ids: each stage works on the documents that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from appmetrics.functions.scratch import stage as written
from appmetrics.llm import mixing, pairwise_quality, pieces, repeats, simhash
from appmetrics.llm.queries import HELD_OUT, piece_model


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.5 or more, learned from the labels of two thirds of the ids.

    Null and empty texts are scored like any other; without labels of both kinds all documents stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    known = docs.select("doc_id", "text").filter(f"NOT {HELD_OUT}")
    return pairwise_quality.keep(pairwise_quality.learn(known, labels), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id, a null id only if no other is there.

    Repeated rows count as one document; rows that share an id and differ in text are separate documents. Null
    and empty texts are near-duplicates of each other.
    """
    keys = {"__key1": F.xxhash64("doc_id", "text"), "__key2": F.xxhash64("text", F.lit(0), "doc_id")}
    keyed = docs.withColumns(keys)
    named = keyed.select(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "__key1", "__key2").alias("id"), "text")
    groups = simhash.simhash_groups(named, "id")
    first = written(groups.filter("id = component OR id <=> component").select("id.__key1", "id.__key2").distinct(), "first")
    return keyed.join(first, ["__key1", "__key2"], "left_semi").dropDuplicates(["__key1", "__key2"]).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that occur more than once; a text that loses none stays as it is.

    Every document stays, with an empty text if nothing is left; ``n_chars`` is counted anew where a text changed.
    """
    cut = repeats.without_repeats(docs, verbatim=True)
    chars = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("row.n_chars"))
    new = {"text": F.col("text"), "n_chars": chars.cast(docs.schema["n_chars"].dataType)}
    return cut.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as many of their words, as the mix of sources takes.

    A document that is taken more than once has as many rows; documents without words are not taken.
    """
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, with begin and end ids, and the bytes of text that their spans cover."""
    encoded = pieces.encode(docs, piece_model(), parts=("ids", "covered"))
    return encoded.select(F.col("id").alias("doc_id"), "n_tokens", "ids", F.col("covered").alias("bytes_in_spans"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixture", mixture),
    ("tokens", tokens),
]

# Learned scores, XXH64 fingerprints and sub-word merges cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = written(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
