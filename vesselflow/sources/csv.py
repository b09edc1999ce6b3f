"""CSV ping source and day selection.

The path pattern goes to Spark's reader as a glob, so listing happens in the
reader (works the same on HDFS / object stores) and no driver-side ``glob``
is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vesselflow.params import CSV_FIRST_HEADER, DEFAULT, Params
from vesselflow.sources.schema import AIS_COLUMNS, ais_schema


def day_path(data_dir: str, day="all", p: Params = DEFAULT) -> str:
    """``{dir}/{prefix}-{yyyy-MM}-*.csv`` for ``"all"``, else the zero-padded day file."""
    base = data_dir.rstrip("/")
    if day is None or str(day).lower() == "all":
        return f"{base}/{p.file_prefix}-{p.year_month}-*.csv"
    d = int(day)
    if not 1 <= d <= 31:
        raise ValueError(f"day must be 1..31 or 'all', got {day!r}")
    return f"{base}/{p.file_prefix}-{p.year_month}-{d:02d}.csv"


def read_pings_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read AIS CSV with the fixed 26-column schema.

    Header line is skipped and names are positional (no inference pass);
    malformed numbers become NULL (PERMISSIVE); leading/trailing blanks trimmed.
    """
    return spark.read.csv(
        path,
        header=True,
        schema=ais_schema(),
        enforceSchema=True,
        mode="PERMISSIVE",
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
    )


def load_pings(spark: SparkSession, data_dir: str, day="all", p: Params = DEFAULT) -> DataFrame:
    """Day selection + scan: the raw (unparsed) ping table."""
    return read_pings_csv(spark, day_path(data_dir, day, p))


def write_pings_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write raw pings in the AIS CSV layout (first header cell ``# Timestamp``).

    ``Timestamp`` must already be text in the file format.
    """
    out = df.select(
        F.col("Timestamp").alias(CSV_FIRST_HEADER), *[F.col(c) for c in AIS_COLUMNS[1:]]
    )
    out.write.mode(mode).option("header", True).csv(path)
