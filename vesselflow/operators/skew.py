"""Flooded keys: joins and look-ups in which no key, however many rows it has, bounds a task.

Sizes are measured, not guessed, and rows are never dropped. What is broadcast is bounded: ``attach`` broadcasts the
groups with more than 1 / HOT_SHARE of the grouped rows (HOT_SHARE rows at most), and joins the others by shuffle,
where none has more than that share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vesselflow.plans.checkpoint import materialize

HOT_SHARE = 1000


def largest_group(rows: DataFrame, keys: list[str]) -> int:
    """Rows of the largest group; partial counts per task, one number to the driver."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """``rows`` left-joined with ``groups`` (one stored row for each key, with the number ``size`` of its rows)."""
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = groups.where(F.col(size) > total // HOT_SHARE).withColumn("_hot", F.lit(True))
    rest = groups.where(F.col(size) <= total // HOT_SHARE)
    others = [c for c in groups.columns if c not in keys]
    marked = rows.join(F.broadcast(hot), keys, "left").select(*rows.columns, *others, "_hot")
    if rest.isEmpty():
        return marked.drop("_hot")
    cold = marked.where(F.col("_hot").isNull()).drop(*others, "_hot").join(rest, keys, "left")
    return marked.where("_hot").drop("_hot").unionByName(cold)


def split_join(left: DataFrame, right: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """The inner equi-join on ``keys``, with flooded keys split in blocks.

    A key with ``a`` rows left and ``b`` right, one of them above ``limit``, becomes ``ceil(a / limit)`` by
    ``ceil(b / limit)`` blocks: a row is in one block row (or column) and copied to each block of it, so each pair of
    rows meets once, in a task that gets 2 x ``limit`` rows of a block. Both inputs are read several times: pass
    tables over stored ones. Rows are dealt by their place in the input, so equal rows are split too.
    """
    counted = [df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)) for df, name in ((left, "_a"), (right, "_b"))]
    flooded = materialize(counted[0].join(counted[1], keys).where(F.greatest("_a", "_b") > limit))
    if flooded.isEmpty():
        return left.join(right, keys, "inner")
    blocks = {"_rows": F.ceil(F.col("_a") / F.lit(limit)).cast("int"), "_cols": F.ceil(F.col("_b") / F.lit(limit)).cast("int")}
    one = F.lit(1)

    def dealt(df: DataFrame, size: str, own: str, copies: str, mine: str, each: str) -> DataFrame:
        marked = attach(df.withColumn("_place", F.monotonically_increasing_id()), flooded.withColumns(blocks).drop({"_a": "_b", "_b": "_a"}[size]), keys, size)
        mine_of = F.pmod(F.xxhash64("_place"), F.coalesce(own, one)).cast("int").alias(mine)
        copied = F.explode(F.sequence(F.lit(0), F.coalesce(copies, one) - one)).alias(each)
        return marked.select(*df.columns, mine_of, copied)

    a = dealt(left, "_a", "_rows", "_cols", "_block_row", "_block_col")
    b = dealt(right, "_b", "_cols", "_rows", "_block_col", "_block_row")
    return a.join(b, [*keys, "_block_row", "_block_col"], "inner").drop("_block_row", "_block_col")
