"""Deterministic pseudo-random numbers from row content.

``rand(seed)`` depends on how rows are laid out in partitions, so a task that is run again after a
lost executor can draw other numbers. A hash of the row does not.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from appmetrics.functions.parsing import quoted


def uniform_md5(columns, seed: int = 0) -> Column:
    """Number in [0, 1) from the first 8 hex digits of an MD5 of seed and columns, joined by ``|``.

    Null counts as empty text. Any SQL engine can repeat it.
    """
    parts = ", ".join(f"coalesce(cast({quoted(c)} AS string), '')" for c in columns)
    return F.expr(f"cast(conv(left(md5(concat_ws('|', '{seed}', {parts})), 8), 16, 10) AS bigint) / 4294967296.0D")


def uniform_hash(columns, seed: int = 0) -> Column:
    """Number in (0, 1) from xxhash64: cheaper than MD5, same guarantees inside Spark."""
    parts = ", ".join(quoted(c) for c in columns)
    return F.expr(f"(shiftrightunsigned(xxhash64({seed}, {parts}), 11) + 0.5D) / {float(1 << 53)!r}D")
