"""Helpers shared by the operators: staged tables, skew-safe group joins, bounded key filters."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import weakref
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A group holding more than 1 / HOT_SHARE of the rows is hot; there are at most HOT_SHARE of them.
HOT_SHARE = 1000
#: Bits of a key filter (1 MB); a multiple of the 32768 bits of one bitmap.
FILTER_BITS = 1 << 23
#: Most bits of a filter that is sized by its keys (8 MB).
MOST_FILTER_BITS = 1 << 26
_BITMAP_BITS = 1 << 15

#: Folders of the staged tables that are in use.
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def whole_text(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Only A-Z lowered."""
    return F.translate(text, UPPER, LOWER)


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where it is unset, a local session gets a temporary one
    (once); any other master is refused, because its executors share no local folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.conf.get("spark.master", "").startswith("local") or "local-cluster" in spark.conf.get("spark.master", ""):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="llm-stage-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there, later readers
    prune columns, and a lost executor costs only its own tasks."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder below the shared one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unstage(*tables: DataFrame) -> None:
    """Delete staged ``tables`` that nothing reads any more. The JVM's garbage is collected too, as Spark deletes the
    shuffle files behind consumed tables only when their plans are."""
    for table in tables:
        delete(table.sparkSession, _PATHS.pop(table))
    tables[0].sparkSession._jvm.System.gc()


#: Rows and bytes of one Arrow batch: whole texts are large rows, and a worker holds a batch and its results.
ARROW_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def ship(spark: SparkSession) -> None:
    """Make ready for Python workers: bound Arrow batches, unless the session has smaller ones, and let workers import
    this package where it is not installed or on PYTHONPATH."""
    for name, most in ARROW_BATCH.items():
        now = re.match(r"\d+", spark.conf.get(name, None) or "")
        if not now or not 0 < int(now[0]) <= most:
            spark.conf.set(name, str(most))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or "site-packages" in root:
        return
    name = f"vesselflow-{spark.sparkContext.applicationId}.zip"
    if any(name in str(f) for f in spark.sparkContext.listFiles):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="llm-code-"), name)
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(os.path.join(root, "vesselflow")):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, how: str = "left", few: int = 0) -> DataFrame:
    """``rows`` with the columns of their group, whatever the size of a group.

    ``groups`` has one row for each key and the number ``size`` of its rows in ``rows``. At most ``few`` groups are broadcast
    as they are. Else groups above 1 / HOT_SHARE of all grouped rows, so HOT_SHARE rows at most, are broadcast; the others
    meet in a shuffle join in which no key has more than that share. Keys must not be null. Both inputs are read
    more than once: pass staged tables.
    """
    n, total = groups.agg(F.count(F.lit(1)), F.sum(size)).first()
    if n <= few:
        return rows.join(F.broadcast(groups), keys, how)
    limit = (total or 0) // HOT_SHARE
    hot = groups.where(F.col(size) > limit)
    rest = groups.where(F.col(size) <= limit)
    # two joins that take a row or not: a row leaves the one or the other, marking them all would make each row twice
    cold = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").select(*rows.columns).join(rest, keys, how)
    return rows.join(F.broadcast(hot), keys).select(*cold.columns).unionByName(cold)


def key_filter(keys: DataFrame, hashed: Column, bits: int = FILTER_BITS) -> DataFrame:
    """Bitmaps over the 64-bit hashes of ``keys``: at most bits / 32768 rows of 4 KB, whatever the number of
    keys. A hash whose bit is unset isn't among the keys; a set bit may be another key's."""
    at = F.pmod(hashed, F.lit(bits))
    return (
        keys.select(at.alias("at"))
        .select(F.floor(F.col("at") / _BITMAP_BITS).alias("__bucket"), F.pmod("at", F.lit(_BITMAP_BITS)).alias("at"))
        .groupBy("__bucket")
        .agg(F.bitmap_construct_agg("at").alias("__bits"))
    )


def whole_rows(docs: DataFrame, **more: Column) -> DataFrame:
    """``docs`` as one struct column ``row`` beside the columns ``more``, whose names can't clash with those of ``docs``;
    ``select("row.*")`` gives ``docs`` back."""
    names = ["`" + c.replace("`", "``") + "`" for c in docs.columns]
    return docs.select(F.struct(*[F.col(c) for c in names]).alias("row"), *[c.alias(name) for name, c in more.items()])


def filter_bits(keys: int) -> int:
    """Bits of a filter of so many keys: sixteen for a key, from FILTER_BITS to MOST_FILTER_BITS. With more keys than that
    allows a filter lets more through, and the exact join behind it does the work."""
    bits = FILTER_BITS
    while bits < MOST_FILTER_BITS and bits < 16 * keys:
        bits *= 2
    return bits


def without(docs: DataFrame, gone: DataFrame, text_hash: Column) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` and ``text_hash`` (an expression over ``text``) aren't in ``gone`` (``id``,
    ``hash``; distinct, staged; a null id is one). A broadcast filter of the ids tells which rows may be: only they, with
    their texts, go through a join, and only their texts are hashed; the others stay where they are."""
    hashed = F.xxhash64("id")
    bits = filter_bits(gone.count())
    rows = passes_filter(whole_rows(docs, id=F.col("doc_id")), hashed, key_filter(gone, hashed, bits), "maybe", bits)
    maybe = rows.where("maybe").select("row", F.col("row.doc_id").alias("own_id"), text_hash.alias("own_hash"))
    same = maybe["own_id"].eqNullSafe(gone["id"]) & (maybe["own_hash"] == gone["hash"])
    return rows.where("NOT maybe").select("row.*").unionByName(maybe.join(gone, same, "left_anti").select("row.*"))


def passes_filter(df: DataFrame, hashed: Column, bitmaps: DataFrame, name: str, bits: int = FILTER_BITS) -> DataFrame:
    """``df`` with the boolean ``name``: False only if the hash is surely none of the filter's keys.
    The bitmaps are broadcast; their size is bound by ``bits``."""
    at = F.pmod(hashed, F.lit(bits))
    inside = F.pmod(at, F.lit(_BITMAP_BITS))
    byte = F.conv(F.hex(F.expr("substring(__bits, __byte, 1)")), 16, 10).cast("int")
    bit = F.when(F.col("__bits").isNull(), F.lit(False)).otherwise(byte.bitwiseAND(F.expr("shiftleft(1, __bit)")) != 0)
    return (
        df.withColumns(
            {
                "__bucket": F.floor(at / _BITMAP_BITS),
                "__byte": (F.floor(inside / 8) + 1).cast("int"),
                "__bit": F.pmod(inside, F.lit(8)).cast("int"),
            }
        )
        .join(F.broadcast(bitmaps), "__bucket", "left")
        .select(*df.columns, bit.alias(name))
    )
