"""Quality scores learned from preferences (Bradley-Terry).

A document of quality 1 is preferred to one of quality 0. With score(d) = weights . features(d), the chance that a
is preferred to b is the logistic function of score(a) - score(b), so the weights come from a logistic
regression without intercept on feature differences of pairs. The score that separates good from bad is a
quantile of the labelled documents' scores: the one that labels most of them rightly. All labelled documents take
part in pairs and quantiles: they get their places from range partitions, so none of this gathers in one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from appmetrics.functions.parsing import quoted
from appmetrics.functions.scratch import stage
from appmetrics.llm.batches import bound_batches
from appmetrics.operators.ranking import running_totals

#: Pairs in which each preferred document takes part.
PAIRS = 8
LEVELS = 200
REGULARISATION = 1e-3

# Byte classes that features count.
_DIGITS, _UPPER, _LOWER = range(48, 58), range(65, 91), range(97, 123)
_COMMON = frozenset(b" \t\n\r\v\f.,;:'\"?!-()")
_ODD = np.array([b < 128 and b not in _COMMON and b not in (*_DIGITS, *_UPPER, *_LOWER) for b in range(256)])

FEATURES = (
    "log_words", "word_length", "odd_signs", "exclamations", "digits", "capitals", "stops", "commas", "lines",
    "beyond_ascii", "distinct_words", "repeated_neighbours", "commonest_word", "repeated_lines", "odd_words", "capital_words",
)


def features(text: bytes | None) -> np.ndarray:
    """Numbers about a whole text in UTF-8, each in a bounded range; a null text counts as empty."""
    text = text or b""
    words = text.split()
    n, chars = max(len(words), 1), max(len(text), 1)
    byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    letters = max(int(byte[65:91].sum() + byte[97:123].sum() + byte[128:].sum()), 1)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in text.split(b"\n") if x.strip()]
    tails = [w[-1] for w in words]
    odd_words = sum(map(_ODD.__getitem__, tails))
    return np.array(
        [
            np.log1p(len(words)) / 10,
            min(len(text) / n, 30) / 10,
            byte[_ODD].sum() / chars * 10,
            min(byte[33] / n, 1),
            byte[48:58].sum() / chars * 10,
            byte[65:91].sum() / letters,
            min(byte[46] / n, 1),
            min(byte[44] / n, 1),
            min(byte[10] / n, 1),
            byte[128:].sum() / chars,
            np.log(max(len(counts), 1)) / np.log(max(len(words), 2)),
            sum(map(bytes.__eq__, words, words[1:])) / n,
            max(counts.values(), default=0) / n,
            1 - len(set(lines)) / max(len(lines), 1),
            odd_words / n,
            sum(map(bytes.isupper, words)) / n,
        ]
    )


def feature_array(text: Column) -> Column:
    """array<double>: the features of a text and their squares, so that too much and too little both count."""

    def run(texts: pa.Array) -> pa.Array:
        found = [features(t.as_py()) for t in texts]
        return pa.array([np.concatenate((f, f * f)) for f in found], pa.list_(pa.float64()))

    return F.arrow_udf(run, "array<double>")(text.cast("binary"))


@dataclass(frozen=True)
class Ranking:
    """Weights of the features, the score that separates, and the spread of the labelled documents' scores."""

    weights: list[float]
    threshold: float
    spread: float

    def raw(self, values: str) -> str:
        """SQL of the Bradley-Terry score of an array of features."""
        weights = ", ".join(f"{w!r}D" for w in self.weights)
        return f"aggregate(zip_with({values}, array({weights}), (x, w) -> x * w), 0D, (a, b) -> a + b)"

    def score(self, values: str) -> Column:
        """0 to 1, rising with the Bradley-Terry score; 0.5 at the separating quantile."""
        return F.expr(f"1D / (1D + exp(-({self.raw(values)} - {self.threshold!r}D) / {self.spread!r}D))")


def fit(known: DataFrame, pairs: int = PAIRS) -> Ranking:
    """A ranking learned from all rows (id, quality, values): quality 0 or 1, an array of features.

    Rows with a null id, quality or array are left out. Without rows of both qualities every document scores 0.5.
    """
    rows = known.filter("id IS NOT NULL AND values IS NOT NULL AND quality IN (0, 1)")
    rows = rows.select("quality", "values", F.xxhash64("id").alias("draw"))
    placed = stage(running_totals(rows, ["quality", "draw", "values"], out="place").drop("draw"), "placed")
    sizes = {r["quality"]: r["n"] for r in placed.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(sizes) != {0, 1}:
        return Ranking([0.0] * (2 * len(FEATURES)), 0.0, 1.0)
    # Places from 0 on in each class: class 0 comes first.
    ordered = placed.selectExpr("quality", "values", f"place - 1 - quality * {sizes[0]} AS at")
    # Every document takes part: both sides are gone through in turn, the rounds shifted against each other.
    rounds = pairs * -(-max(sizes.values()) // sizes[1])
    meetings = (
        ordered.filter("quality = 1")
        .selectExpr("values AS better", "at", f"explode(sequence(0, {rounds - 1})) AS round")
        .selectExpr("better", "round", f"(at + round * {max(1, sizes[0] // rounds) + 1}) % {sizes[0]} AS other")
        .join(ordered.filter("quality = 0").selectExpr("values AS worse", "at AS other"), "other")
    )
    differences = meetings.selectExpr(
        "CASE WHEN (round + other) % 2 = 0 THEN 1D ELSE 0D END AS label", "zip_with(better, worse, (b, w) -> b - w) AS d"
    ).select("label", array_to_vector(F.expr("CASE WHEN label = 1D THEN d ELSE transform(d, x -> -x) END")).alias("features"))
    model = LogisticRegression(fitIntercept=False, regParam=REGULARISATION, maxIter=100).fit(stage(differences, "pairs"))
    ranked = Ranking([float(w) for w in model.coefficients], 0.0, 1.0)
    scored = stage(ordered.selectExpr("quality", f"{ranked.raw('values')} AS raw"), "scored")
    threshold = _separating(scored, quantiles(scored, "raw", [(i + 0.5) / LEVELS for i in range(LEVELS)]), sizes)
    return Ranking(ranked.weights, threshold, scored.agg(F.stddev_pop("raw")).first()[0] or 1.0)


def quantiles(df: DataFrame, column: str, shares: list[float]) -> list[float]:
    """Exact quantiles of a column without nulls, between two values in proportion, as SQL's ``percentile``."""
    placed = stage(running_totals(df.select(column), [column], out="place"), "ranked")
    n = placed.count()
    places = [(n - 1) * p for p in shares]
    asked = sorted({whole + 1 for p in places for whole in (math.floor(p), math.ceil(p))})
    at = {r["place"]: r[column] for r in placed.filter(F.col("place").isin(asked)).collect()}
    out = []
    for p in places:
        low, high = math.floor(p), math.ceil(p)
        out.append(at[low + 1] if low == high else (high - p) * at[low + 1] + (p - low) * at[high + 1])
    return out


def _separating(scored: DataFrame, levels: list[float], sizes: dict[int, int]) -> float:
    """The middle of the levels that label most rows (quality, raw) rightly, classes weighing the same."""
    steps = sorted(set(levels))
    split = Bucketizer(splits=[-math.inf, *steps, math.inf], inputCol="raw", outputCol="reached").transform(scored)
    rows = {(r["quality"], int(r["reached"])): r["n"] for r in split.groupBy("quality", "reached").agg(F.count(F.lit(1)).alias("n")).collect()}
    right = []
    for level in levels:
        step = steps.index(level)
        good = sum(n for (quality, reached), n in rows.items() if quality == 1 and reached > step)
        bad = sum(n for (quality, reached), n in rows.items() if quality == 0 and reached <= step)
        right.append(good / sizes[1] + bad / sizes[0])
    best = [q for q, r in zip(levels, right) if r >= max(right) - 1e-12]
    return (best[0] + best[-1]) / 2


def labelled(values: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", label_id: str = "doc_id") -> DataFrame:
    """(id, quality, values) of the rows of ``values`` that have a label 0 or 1; labels are joined by id."""
    label = F.col(quoted(label_col))
    known = labels.filter(label.isin(0, 1)).select(F.col(quoted(label_id)).alias("id"), label.alias("quality")).distinct()
    return values.select(F.col(quoted(id_col)).alias("id"), "values").join(known, "id")


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> Ranking:
    """A ranking from the texts of all labelled rows of ``docs``.

    Texts become features where they are read, so the join with the labels moves no text. A repeated label counts
    once; an id with both labels is in both classes; rows that share an id all count. Without rows of both
    qualities every document scores 0.5.
    """
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text")).filter("id IS NOT NULL")
    made = stage(texts.select("id", feature_array(F.col("text")).alias("values")), "features")
    return fit(labelled(made, labels, "id", label_id=id_col), **how)


def keep(ranking: Ranking, docs: DataFrame, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``."""
    bound_batches(docs.sparkSession)
    made = docs.select(F.struct("*").alias("row"), feature_array(F.col(quoted(text_col))).alias("values"))
    return made.filter(ranking.score("values") >= least).select("row.*")


def score(ranking: Ranking, docs: DataFrame, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a column ``out``: the score, 0 to 1, of every whole text, null and empty ones included.

    A column of that name is replaced. Repeated rows score alike; an empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c != out]
    made = docs.select(F.struct(*kept).alias("row"), feature_array(F.col(quoted(text_col))).alias("values"))
    return made.select("row.*", ranking.score("values").alias(out))
