"""Token ids in Parquet files: a list column of ids, with the document's metadata beside it.

Documents are range-partitioned and sorted by id before they are tokenised, so the sampling for the ranges reads
text and never tokenises twice, and files follow each other in ascending order of ids. The ids are dictionary
coded, the ascending metadata columns delta coded (the dictionary is off for them); row groups and pages have set
sizes, and the page indexes let a reader take single documents, or the metadata columns alone.

Null text counts as empty: such a document is its end id alone. Rows that share an id stay side by side. A null id comes first. Empty tables give an empty data set. Other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vesselflow.llm.stage import ship, staged, whole_text
from vesselflow.llm.word_ids import texts_of, word_ids

#: Bytes of a row group and of a page; rows of a page at most.
LAYOUT = {
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.page.write-checksum.enabled": "true",
    "compression": "zstd",
}
#: Pieces in a generation of a worker's cache: a job that does little else holds more of them.
GENERATION = 480_000
SCHEMA = "doc_id bigint, n_tokens bigint, ids array<int>"


def _ids(path: str, end_id: int):
    def ids(array: pa.Array) -> pa.Array:
        words = word_ids(path, GENERATION)
        end = np.array([end_id], words.dtype).tobytes()
        each = [words.encode(x) + end for x in texts_of(array)]
        at = np.concatenate(([0], np.cumsum([len(x) // words.dtype.itemsize for x in each]))).astype(np.int32)
        values = np.frombuffer(b"".join(each), words.dtype).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(at), pa.array(values))

    return ids


def write_tokens(docs: DataFrame, path: str, out: str, end_id: int = 2, files: int | None = None) -> None:
    """Write the ids of every document, in ascending order of ``doc_id``, below the folder ``out``."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", whole_text().alias("text"))
    n = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
    ids = ordered.select("doc_id", F.arrow_udf(_ids(path, end_id), "array<int>")("text").alias("ids"))
    ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids").write.options(**LAYOUT).parquet(out)


def read_tokens(spark: SparkSession, out: str) -> DataFrame:
    """The documents of a token data set, with the file and the place in it that hold them."""
    return spark.read.schema(SCHEMA).parquet(out).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def _crc32(array: pa.Array) -> pa.Array:
    values = np.ascontiguousarray(array.values.to_numpy(zero_copy_only=False), "<u4")
    at = array.offsets.to_numpy()
    return pa.array([zlib.crc32(values[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.int64())


def digest(spark: SparkSession, out: str) -> DataFrame:
    """From the files alone: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``.

    ``start`` is a running sum inside each file plus the files before it: the second needs one row a file.
    """
    ship(spark)
    crc = F.arrow_udf(_crc32, "bigint")(F.col("ids"))
    rows = staged(read_tokens(spark, out).select("doc_id", "n_tokens", "file", "row", crc.alias("ids_crc32")), "token-digest")
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    order = Window.orderBy(F.asc_nulls_first("low"), F.asc_nulls_first("high"), "file").rowsBetween(Window.unboundedPreceding, -1)
    before = files.select("file", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(before, "file")
        .select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
    )
