"""Incremental landing of AIS CSV day files into a Parquet table.

New ``aisdk-*.csv`` files dropped into a folder are picked up by a
Structured Streaming file source with the fixed 26-column schema, the
timestamp is parsed (C1, rows that do not parse are dropped), a ``day``
column is added, and rows are appended to a Parquet table partitioned by
day. The checkpoint location records which files were committed, so a
restarted or failed run neither loses nor duplicates a file.

The cleaning chain itself stays a batch job over the landed table: its jump
filter needs each vessel's previous ping, a row-order window that streaming
aggregation does not offer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vesselflow.operators.clean import parse_timestamp
from vesselflow.params import DEFAULT, Params
from vesselflow.sources.schema import ais_schema


def read_csv_stream(spark: SparkSession, source_dir: str, p: Params = DEFAULT, max_files: int | None = None) -> DataFrame:
    reader = (
        spark.readStream.schema(ais_schema())
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("pathGlobFilter", f"{p.file_prefix}-*.csv")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(source_dir)


def land_pings(
    spark: SparkSession,
    source_dir: str,
    table_path: str,
    checkpoint_path: str,
    p: Params = DEFAULT,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the landing stream; with ``available_now`` it processes the
    files present and stops (a scheduled batch), else it keeps watching."""
    parsed = parse_timestamp(read_csv_stream(spark, source_dir, p), p).withColumn(
        "day", F.to_date(F.col("Timestamp"))
    )
    w = (
        parsed.writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint_path)
        .partitionBy("day")
        .outputMode("append")
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_landed(spark: SparkSession, table_path: str, days: list[str] | None = None) -> DataFrame:
    """Read the landed table; a ``days`` list prunes partitions at the scan."""
    df = spark.read.parquet(table_path)
    if days:
        df = df.filter(F.col("day").isin([F.lit(d).cast("date") for d in days]))
    return df.drop("day")
