"""How much text travels to Python at once."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_MB = 8


def size_of(setting: str) -> int:
    """Bytes of a setting like ``8m``, ``64mb`` or ``1000``; -1 for no limit."""
    number, unit = re.fullmatch(r"(-?\d+)([bkmgt]?)b?", setting.strip().lower()).groups()
    return int(number) * 1024 ** "bkmgt".index(unit or "b")


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's limit for the bytes of an Arrow batch to ``BATCH_MB``; a lower one stays.

    A batch is held several times over, by the JVM, by Arrow and as Python objects, so its size and the
    longest text decide how much memory a Python worker takes beside the executor's heap.
    """
    if not 0 < size_of(spark.conf.get(SETTING)) <= BATCH_MB << 20:
        spark.conf.set(SETTING, f"{BATCH_MB}m")
