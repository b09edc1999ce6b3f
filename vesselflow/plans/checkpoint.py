"""Stored intermediate tables for multi-stage runs.

A table that a plan reads several times is written once as Parquet below the
shared folder that ``spark.checkpoint.dir`` names and read back: lineage ends
there, readers prune columns and push filters, and a lost executor costs only
its own tasks. Never a node-local folder, never ``localCheckpoint``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_STORED: list[str] = []


def stage_dir(spark: SparkSession) -> str:
    """The session's shared folder. Where none is named, a local session gets a
    temporary one; any other master is refused, and so is a folder of its driver."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
        raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="vf-stage-"))
    return spark.conf.get("spark.checkpoint.dir")


def materialize(df: DataFrame) -> DataFrame:
    """``df``, written now and read back from the shared folder."""
    path = f"{stage_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STORED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """``df`` with an observation of its rows (``get["rows"]``), filled by the first job that reads all of it."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def materialize_counted(df: DataFrame, value: Column | None = None) -> tuple[DataFrame, int]:
    """``materialize`` and the number of rows written, or another aggregate of them, observed by the job that wrote them."""
    seen = Observation(f"stored-{uuid.uuid4().hex}")
    watched = df.observe(seen, (F.count(F.lit(1)) if value is None else value).alias("value"))
    return materialize(watched), seen.get["value"]


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def drop_stages(spark: SparkSession) -> None:
    """Delete all tables that ``materialize`` stored in this process; DataFrames over them end."""
    while _STORED:
        delete_path(spark, _STORED.pop())
