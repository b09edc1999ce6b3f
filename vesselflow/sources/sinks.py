"""Result sinks: events, trajectories and report tables to files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_days(df: DataFrame, path: str, time_column: str, fmt: str = "parquet", unit: str = "day") -> None:
    """S5 by time: append ``day`` (and ``hour`` with ``unit="hour"``) of ``time_column`` and write partitioned by them,
    replacing only the partitions that ``df`` has rows of. Writing a day again leaves the table as it was after the first
    time, and other days untouched; rows without a time go to the null partition, which is one of them.

    A day is one partition of files, not one task: rows are written by the tasks that hold them.
    """
    parts = {"day": F.to_date(time_column)} | ({"hour": F.hour(time_column)} if unit == "hour" else {})
    w = df.withColumns(parts).write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        w = w.option("header", True)
    w.partitionBy(*parts).save(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> None:
    """Write ``df`` with Spark's file writer (task-level commit, so a lost
    executor's partial output is discarded and the task rerun)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
