"""Previous-row look-up in which no key, and no chunk of a key, bounds a task.

``lag(x) OVER (PARTITION BY key ORDER BY ts)`` sends every row of a key to a
single task. A vessel id (or a spoofed one) can carry a large share of all
pings, so instead rows are partitioned by ``(key, chunk)`` where ``chunk`` is
a coarse, order-preserving bucket of ``ts`` (the hour). The last row of each
chunk in the full order is found with a partial aggregate (one row per chunk
and task; a struct maximum, so Spark sorts for it), stored, moved to the next
non-empty chunk of the same key with a lag over that table, and unioned in as
a marker row ahead of the chunk's real rows. One window over
``(key, chunk)`` then yields the exact previous row for every real row.

The same aggregate counts the rows of each chunk. Chunks above ``limit`` rows
are flooded: their rows alone are range-partitioned by the whole order (and by
their place in the input, so that equal rows are split too) and stored with
their partition as ``SLICE``; slices ascend along the order, so ``(chunk,
slice)`` takes the place of the chunk and last rows are carried across slice
edges as across hours. Without flooded chunks the big input is shuffled once,
by ``(key, chunk)``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vesselflow.functions.sqltext import col, ref
from vesselflow.operators.index import SLICE
from vesselflow.operators.skew import attach
from vesselflow.params import DEFAULT
from vesselflow.plans.checkpoint import materialize, materialize_counted

_MARK = "_seq_marker"
_LAST = "_seq_last"
_ROWS = "_seq_rows"
#: Slices of a flooded chunk hold this share of the limit, so that tasks of several slices come out even.
_SLICES_PER_LIMIT = 8


def _last_rows(df: DataFrame, by: list[str], carried: list[str]) -> DataFrame:
    """The last row of each group in the full order, and the group's size."""
    parts = ", ".join(ref(c) for c in carried)
    return df.groupBy(*by).agg(col(f"max(struct({parts}))").alias(_LAST), F.count(F.lit(1)).alias(_ROWS))


def _sliced(df: DataFrame, flooded: DataFrame, by: list[str], order: list[str], limit: int) -> tuple[DataFrame, DataFrame]:
    """The rows of chunks that aren't flooded, and those of flooded ones, stored, with their ``SLICE`` (from 1)."""
    rows = flooded.agg(F.sum(_ROWS)).first()[0]
    marked = attach(df, flooded, by, _ROWS)
    hot = marked.where(F.col(_ROWS).isNotNull()).drop(_ROWS).withColumn("_place", F.monotonically_increasing_id())
    slices = math.ceil(rows * _SLICES_PER_LIMIT / limit)
    ranged = hot.repartitionByRange(slices, *by, *order, "_place").withColumn(SLICE, F.spark_partition_id() + 1)
    return marked.where(F.col(_ROWS).isNull()).drop(_ROWS), materialize(ranged.drop("_place"))


def with_previous(
    df: DataFrame,
    keys: list[str],
    chunk: str,
    order: list[str],
    values: list[str],
    prefix: str = "prev_",
    limit: int = DEFAULT.flood_rows,
    keep_slice: bool = False,
) -> DataFrame:
    """Add ``prefix + c`` for ``c`` in ``values``: that column's value on the
    previous row of the same ``keys`` in ``order``.

    ``chunk`` must be non-decreasing along ``order`` within a key (e.g. the
    hour of the timestamp that leads ``order``); it, the keys and ``order[0]``
    must not be NULL. Inside a chunk and across chunk edges rows follow the
    whole ``order``, so rows that tie on the timestamp give the same answer in
    any input order (rows equal in all of ``order`` and ``values`` are alike).
    The first row of a key gets NULLs. Runs a job, for the chunks' last rows.
    With ``keep_slice`` the column ``SLICE`` stays where a chunk is flooded.
    """
    carried = list(dict.fromkeys(order + values))
    by = [*keys, chunk]
    last, most = materialize_counted(_last_rows(df, by, carried), F.max(_ROWS))
    parts = [chunk]
    if (most or 0) > limit:
        parts = [chunk, SLICE]
        flooded = last.where(F.col(_ROWS) > limit).select(*by, _ROWS)
        normal, hot = _sliced(df, flooded, by, order, limit)
        df = normal.withColumn(SLICE, F.lit(0)).unionByName(hot)
        calm = last.where(F.col(_ROWS) <= limit).withColumn(SLICE, F.lit(0))
        last = calm.unionByName(_last_rows(hot, [*by, SLICE], carried))
    last = last.select(*keys, *parts, f"{_LAST}.*")
    along = Window.partitionBy(*keys).orderBy(*parts)
    markers = last.select(
        *keys, *parts, *[F.lag(c).over(along).alias(c) for c in carried], F.lit(True).alias(_MARK)
    ).filter(F.col(order[0]).isNotNull())
    both = df.withColumn(_MARK, F.lit(False)).unionByName(markers, allowMissingColumns=True)
    # markers sort first inside their chunk (True > False with desc)
    w = Window.partitionBy(*keys, *parts).orderBy(F.col(_MARK).desc(), *order)
    out = both.withColumns({prefix + c: F.lag(c).over(w) for c in values})
    out = out.filter(~F.col(_MARK)).drop(_MARK)
    return out if keep_slice else out.drop(SLICE)


def with_rank(df: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """``df`` sorted by ``order`` with each row's place in it (from 1), without one task for all rows: a range sort,
    stored; each row's place is its place in its partition after the rows of the partitions before. Ties take any
    order: give a full one."""
    placed = df.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id())
    placed = materialize(placed)
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    # one row for each partition, whose number is a setting
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = placed.join(F.broadcast(parts), "_part")
    return ranked.select(*df.columns, (F.col("_before") + F.col("_place") - F.col("_first") + 1).alias(name))
