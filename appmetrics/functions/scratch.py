"""Where jobs cut lineage: tables in the shared checkpoint folder of the session."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local session without one gets one temporary folder, which goes when the process ends. A configured
    folder is the caller's: what jobs have left in it can be deleted once their results are written.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    session = spark.sparkContext.applicationId
    if session not in _OWN:
        _OWN[session] = tempfile.mkdtemp(prefix="appmetrics-")
        atexit.register(shutil.rmtree, _OWN[session], ignore_errors=True)
    return _OWN[session]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back.

    This is how jobs cut lineage: the rows are computed once (a checkpoint computes them twice), lost
    executors lose nothing, each later pass reads only its columns, and plans start short again.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete what ``scratch_path`` has named, in whatever store it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
