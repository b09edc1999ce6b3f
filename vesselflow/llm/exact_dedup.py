"""Exact deduplication by progressive refinement, in DataFrame operations only.

1. Group by byte length; 2. group the rows of shared lengths by length and prefix hash; 3. take the full
SHA-256 only of rows whose length and prefix are shared. Which rows go on is told by a bounded bitmap filter
(a false positive costs one needless hash), so neither text nor unbounded key lists are shuffled or broadcast.

Texts are equal when identical after lowering A-Z. Of equal texts the row with the largest ``doc_id`` stays.
Null text counts as empty and equals the empty text. A null ``doc_id`` ranks below all others; rows that
share both the text and the largest ``doc_id`` all stay (they are one document read twice). Empty tables give
empty results. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vesselflow.llm.stage import ascii_lower, join_groups, key_filter, passes_filter, staged, whole_text, without

#: Characters of the second level's prefix.
PREFIX_CHARS = 256


def refine(docs: DataFrame, digest_all: bool = False) -> DataFrame:
    """Each row's ``doc_id``, ``n_bytes`` and ``full_hash``: the SHA-256 of the lowered text where another row may
    have the same text, else null (with ``digest_all``, which only the digest of a report needs, never null, and
    ``maybe_copy`` says which rows the levels left)."""
    base = docs.select("doc_id", whole_text().alias("text"), F.octet_length(whole_text()).alias("n_bytes"))
    length = F.xxhash64("n_bytes")
    lengths = base.groupBy("n_bytes").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    level1 = passes_filter(base, length, key_filter(lengths, length), "same_length")

    prefix = F.xxhash64(F.col("n_bytes"), ascii_lower(F.substring("text", 1, PREFIX_CHARS)))
    level1 = level1.withColumn("prefix", F.when(F.col("same_length"), prefix))
    prefixes = (
        level1.where("same_length").groupBy("n_bytes", "prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    )
    level2 = passes_filter(level1, F.coalesce("prefix", F.lit(0)), key_filter(prefixes, F.col("prefix")), "same_prefix")

    copy = F.col("same_length") & F.col("same_prefix")
    full = F.sha2(ascii_lower(F.col("text")), 256)
    return level2.select(
        "doc_id", "n_bytes", copy.alias("maybe_copy"), (full if digest_all else F.when(copy, full)).alias("full_hash")
    )


def exact_copies(docs: DataFrame, digest_all: bool = False) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``full_hash``."""
    rows = staged(refine(docs, digest_all), "exact")
    maybe = rows.where("maybe_copy").select("doc_id", "n_bytes", "full_hash")
    groups = staged(
        maybe.groupBy("n_bytes", "full_hash").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")),
        "exact-groups",
    )
    grouped = join_groups(maybe, groups, ["n_bytes", "full_hash"], "group_size")
    alone = rows.where(~F.col("maybe_copy")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "full_hash"
    )
    return (
        grouped.select("doc_id", "keep_id", "group_size", "full_hash")
        .unionByName(alone)
        .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "full_hash")
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. A ``doc_id`` on rows of several texts goes only
    where that text's row goes: what goes is told by the id and the text's hash (``without``)."""
    gone = exact_copies(docs).where("not kept").select(F.col("doc_id").alias("id"), F.col("full_hash").alias("hash"))
    return without(docs, staged(gone.distinct(), "exact-gone"), F.sha2(ascii_lower(whole_text("row.text")), 256))
