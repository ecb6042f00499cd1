"""Samples and splits that do not depend on how rows are partitioned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from appmetrics.functions.hashing import uniform_hash, uniform_md5
from appmetrics.functions.parsing import field


def _uniform(df: DataFrame, seed: int, key, portable: bool) -> Column:
    columns = list(key or df.columns)
    return uniform_md5(columns, seed) if portable else uniform_hash(columns, seed)


def sample_fraction(df: DataFrame, fraction: float, seed: int, key=None, portable: bool = False) -> DataFrame:
    """Each row stays with probability ``fraction``, decided by a hash of ``key`` (default: the row)."""
    return df.filter(_uniform(df, seed, key, portable) < F.lit(fraction))


def sample_rows(df: DataFrame, k: int, seed: int, key=None, portable: bool = False) -> DataFrame:
    """``k`` rows without replacement: the ``k`` smallest hashes."""
    columns = list(key or df.columns)
    return df.orderBy(_uniform(df, seed, key, portable), *[field(c) for c in columns]).limit(k)


def split_rows(df: DataFrame, weights: dict[str, float], seed: int, key=None, portable: bool = False) -> dict[str, DataFrame]:
    """Disjoint named parts that add up to ``df``."""
    total, at, parts = float(sum(weights.values())), 0.0, {}
    u = _uniform(df, seed, key, portable)
    names = list(weights)
    for name in names:
        low, at = at, at + weights[name] / total
        high = F.lit(True) if name == names[-1] else u < F.lit(at)
        parts[name] = df.filter((u >= F.lit(low)) & high)
    return parts


def train_validation_test(df: DataFrame, seed: int, key=None, portable: bool = False) -> dict[str, DataFrame]:
    """60 / 20 / 20."""
    return split_rows(df, {"train": 0.6, "val": 0.2, "test": 0.2}, seed, key, portable)


def train_test(df: DataFrame, seed: int, train: float = 0.8, key=None) -> tuple[DataFrame, DataFrame]:
    parts = split_rows(df, {"train": train, "test": 1.0 - train}, seed, key)
    return parts["train"], parts["test"]


def weighted_draw(df: DataFrame, weight: Column, seed: int, key) -> DataFrame:
    """One row with probability proportional to ``weight``: the first arrival of an exponential race."""
    arrival = -F.log(uniform_hash(list(key), seed)) / weight
    return df.filter(weight > 0).orderBy(arrival, *[field(c) for c in key]).limit(1)
