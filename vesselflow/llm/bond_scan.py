"""Hard negatives for contrastive training, by a BOND scan of vertical blocks.

Rows are packed into blocks of up to BLOCK vectors, stored dimension by dimension. An anchor reads a block's dimensions
in the order of its own components' magnitude. After each few dimensions every candidate's score lies between its partial
score plus the least, and plus the greatest, that the remaining dimensions can add (from the block's minimum and maximum
in each); candidates that can't be among the best any more, or can't lie in any wanted window of scores, leave the
candidate set, so later dimensions are read for few. Scores of those left are exact. A block of anchors reads the
dimensions after which bounds are still wide, of each anchor those that come first in its order, in one matrix product; and
a task keeps what its anchors have found in the blocks before.

Blocks of anchors and of rows meet in a product that the executors make: nothing goes through the driver or is broadcast,
whatever size Spark takes the tables for, and of the blocks only those of anchors are shuffled.

Components are ``floor(256 * x)``; a score is the integer inner product, and higher scores come first, ties by smaller
``vec_id``. An anchor's positives are its first ``POSITIVES`` other rows of its label. For each positive the first
``NEGATIVES`` rows of other labels whose score lies between 50% and 95% of the positive's are hard negatives.

Rows with a null id, label or vector, or a null or non-finite component take no part. Missing components of shorter
vectors count as zero. Rows that share a ``vec_id`` are rows of their own (ties between them keep the order of the stored
table); an anchor is never its own positive, but its equal copy may be. A positive without negatives, and an anchor
without positives, give no rows; empty tables give empty results. Other columns are not read. Scores that don't fit a
long raise an OverflowError. The anchors are a stated set of queries that meets all rows, block by block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vesselflow.llm.stage import ship, staged
from vesselflow.llm.textbatch import release_memory

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LEAST_PERCENT, MOST_PERCENT = 50, 95
BLOCK = 4096
ANCHOR_BLOCK = 256
#: Dimensions read between two looks at the candidates.
STEP = 8
#: Dimensions are read for all candidates at once until the others can add 1 / REST of what all can.
REST = 32
#: Blocks of anchors that a task holds, and the most parts of so many; with more anchors parts are larger instead, as each
#: meets all parts of the blocks in a task of its own and the driver keeps a record of each task.
ANCHOR_PART, MOST_PARTS = 16, 64
#: Rows that anchors meet first, for scores that others must reach; then eight times as many, and so on.
FIRST_ROWS = 128
#: Below and above all scores.
LEAST, MOST = -(1 << 62), 1 << 62

_BLOCK_TYPE = "rows array<bigint>, ids array<bigint>, labels array<bigint>, width int, matrix binary"
_WINDOWS_TYPE = ", windows array<array<bigint>>"


def participants(embeddings: DataFrame, label: Column | None = None) -> DataFrame:
    """``row`` (a number of its own for each row), ``vec_id``, ``label`` and the integer ``vector`` of the rows that take
    part; stored, so numbers stay."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    quantised = F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        (F.col("label") if label is None else label).cast("long").alias("label"), quantised.alias("vector"),
    )
    return staged(rows, "bond-rows")


def _packed(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packs rows into blocks of up to ``size``, sorted by label; a column ``windows`` comes along. The matrix has the
    shortest integers that hold its numbers."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                room = size - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in held) == size:
                    yield block(pa.Table.from_batches(held))
                    held = []
        if held:
            yield block(pa.Table.from_batches(held))
        release_memory()

    def block(table: pa.Table) -> pa.RecordBatch:
        table = table.take(np.argsort(table["label"].to_numpy(), kind="stable"))
        vectors = table["vector"].combine_chunks()
        lengths = np.diff(vectors.offsets.to_numpy())
        values, n, width = vectors.flatten().to_numpy(zero_copy_only=False), len(lengths), int(lengths.max(initial=0))
        matrix = np.zeros((width, n), next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= values.min(initial=0) and values.max(initial=0) <= np.iinfo(t).max))
        at = np.repeat(np.cumsum(lengths) - lengths, lengths)
        matrix[np.arange(len(values)) - at, np.repeat(np.arange(n), lengths)] = values
        one = lambda c: pa.array([table[c].to_pylist()], pa.list_(table[c].type))
        columns = {"rows": one("row"), "ids": one("vec_id"), "labels": one("label")}
        columns |= {"width": pa.array([width], pa.int32()), "matrix": pa.array([matrix.tobytes()], pa.binary())}
        columns |= {"windows": one("windows")} if "windows" in table.column_names else {}
        return pa.RecordBatch.from_pydict(columns)

    return pack


def _blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Sorted, so that a block has few labels."""
    kind = _BLOCK_TYPE + (_WINDOWS_TYPE if "windows" in rows.columns else "")
    return staged(rows.sortWithinPartitions("label").mapInArrow(_packed(size), kind), name)


def cells(anchors: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each block of anchors beside each block of rows."""
    parts = min(MOST_PARTS, max(1, -(-anchors.count() // ANCHOR_PART)))
    queries = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns]).repartition(parts)
    # without the hint Spark may broadcast a side, by a guess from the size of compressed files
    return blocks.hint("shuffle_replicate_nl").crossJoin(queries)


class VerticalBlock:
    """A block's dimensions with their minima and maxima, as numbers in which sums of products with ``queries`` are exact.
    For each query: its dimensions in order, and the least and the greatest that those from a place on can add."""

    def __init__(self, matrix: np.ndarray, queries: np.ndarray):
        width = max(len(matrix), len(queries))
        matrix, queries = (m if len(m) == width else np.pad(m, ((0, width - len(m)), (0, 0))) for m in (matrix, queries))
        most = _most(matrix, queries)
        exact = np.float32 if most < 1 << 23 else np.float64 if most < 1 << 52 else np.int64
        self.columns, queries = matrix.astype(exact), queries.astype(exact)
        low, high = self.columns.min(1, initial=0), self.columns.max(1, initial=0)
        self.order = np.argsort(-np.abs(queries), axis=0, kind="stable")
        self.queries = np.take_along_axis(queries, self.order, 0)
        ends = self.queries * low[self.order], self.queries * high[self.order]
        self.least, self.greatest = (np.concatenate((np.cumsum(f(*ends)[::-1], 0, exact)[::-1], np.zeros((1, queries.shape[1]), exact))) for f in (np.minimum, np.maximum))

    def head(self, bottom: np.ndarray, top: np.ndarray | None) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        """The number of dimensions that are read for all candidates at once; then the queries, the candidates and the
        partial scores of the pairs whose score may lie between a query's ``bottom`` and ``top``."""
        spread, width = self.greatest - self.least, len(self.order)
        done = next(k for k in [*range(0, width, STEP), width] if k == width or (spread[k] * REST <= spread[0]).all())
        queries = np.zeros_like(self.queries)
        np.put_along_axis(queries, self.order[:done], self.queries[:done], 0)
        used = np.flatnonzero(queries.any(1))
        columns = self.columns if len(used) == width else self.columns[used]
        partial = queries[used].T @ columns
        # bounds that the type can't hold are rounded, which keeps the order, so no pair is lost
        may = partial >= (bottom - self.greatest[done]).astype(partial.dtype)[:, None]
        if top is not None:
            may &= partial <= (top - self.least[done]).astype(partial.dtype)[:, None]
        query, alive = np.divmod(np.flatnonzero(may), max(1, partial.shape[1]))
        return done, query, alive, partial[query, alive]

    def scan(self, query: int | np.ndarray, alive: np.ndarray, keep: Callable[..., np.ndarray], done: int = 0, partial: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """The candidates of ``alive`` that ``keep`` leaves, given bounds of their scores, and their exact scores. With an
        array ``query``, of pairs, their queries come first. ``partial``: the scores by the first ``done`` dimensions."""
        pairs = np.broadcast_to(query, alive.shape)
        partial = np.zeros(len(alive), self.columns.dtype) if partial is None else partial
        for k in range(done, len(self.order), STEP):
            if not len(alive):
                break
            end = min(k + STEP, len(self.order))
            partial = partial + (self.queries[k:end, pairs] * self.columns[self.order[k:end, pairs], alive]).sum(0)
            left = keep(partial + self.least[end, pairs], partial + self.greatest[end, pairs], pairs)
            pairs, alive, partial = pairs[left], alive[left], partial[left]
        found = alive, partial.astype(np.int64)
        return found if np.ndim(query) == 0 else (pairs, *found)


def _magnitude(matrix: np.ndarray) -> np.ndarray:
    return np.maximum(matrix.max(1, initial=0).astype(object), -matrix.min(1, initial=0).astype(object))


def _most(matrix: np.ndarray, queries: np.ndarray) -> int:
    """What no score, nor any part of one, exceeds."""
    most = sum(int(a) * int(b) for a, b in zip(_magnitude(matrix), _magnitude(queries)))
    if most * 100 >= 1 << 63:
        raise OverflowError("scores must fit a long, also a hundredfold")
    return most


def _raise(floor: np.ndarray, lower: np.ndarray, query: np.ndarray, count: int) -> None:
    """Raises the scores that the ``count`` highest of each query reach, given ``lower`` bounds of some."""
    more = np.flatnonzero(lower > floor[query])
    if len(more) < count:
        return
    more = more[np.lexsort((-lower[more], query[more]))]
    owner, start, size = np.unique(query[more], return_index=True, return_counts=True)
    full = size >= count
    floor[owner[full]] = lower[more[start[full] + count - 1]].astype(np.int64)


def best(count: int, floor: np.ndarray | None = None) -> Callable[..., np.ndarray]:
    """Keeps what may be among the ``count`` highest of its query. ``floor``: by query, a score that so many reach already;
    raised on the way."""
    floor = np.full(1, LEAST) if floor is None else floor

    def keep(lower: np.ndarray, upper: np.ndarray, query: np.ndarray) -> np.ndarray:
        query = query if len(floor) > 1 else np.zeros(len(query), np.int64)
        _raise(floor, lower, query, count)
        return upper >= floor[query]

    return keep


def window(positive: int) -> tuple[int, int]:
    """The least and the greatest score of a hard negative."""
    return -(-LEAST_PERCENT * positive // 100), MOST_PERCENT * positive // 100


def best_in(windows: list[tuple], count: int, floors: list[np.ndarray] | None = None) -> Callable[..., np.ndarray]:
    """Keeps what may be among the ``count`` highest of one of its query's windows. ``windows``: the least and the greatest
    score, one for all queries or an array by query; ``floors``: as in ``best``, for each window."""
    windows = [tuple(np.atleast_1d(np.asarray(x, np.int64)) for x in w) for w in windows]
    floors = [lo.copy() for lo, _ in windows] if floors is None else floors

    def keep(lower: np.ndarray, upper: np.ndarray, query: np.ndarray) -> np.ndarray:
        out = np.zeros(len(lower), bool)
        for (lo, hi), floor in zip(windows, floors, strict=True):
            at = query if len(floor) > 1 else np.zeros(len(query), np.int64)
            may = (upper >= floor[at]) & (lower <= hi[at])
            sure = np.flatnonzero(may & (lower >= lo[at]) & (upper <= hi[at]))
            _raise(floor, lower[sure], at[sure], count)
            out |= may & (upper >= floor[at])
        return out

    return keep


class Firsts:
    """The first ``count`` rows of each of ``groups`` groups: by score, the highest first, by id and by row."""

    def __init__(self, groups: int, count: int):
        self.count, self.found = count, [np.zeros(0, np.int64)] * 4
        self.last = np.full(groups, LEAST), np.full(groups, MOST)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        last, last_id = (x[group] for x in self.last)
        new = np.flatnonzero((score > last) | ((score == last) & (ids <= last_id)))
        if not len(new):
            return
        group, score, ids, rows = (np.concatenate((x, y[new])) for x, y in zip(self.found, (group, score, ids, rows), strict=True))
        order = np.lexsort((rows, ids, -score, group))
        place = np.arange(len(order)) - np.searchsorted(group[order], group[order])
        self.found = [x[order[place < self.count]] for x in (group, score, ids, rows)]
        full = order[place == self.count - 1]
        for x, y in zip(self.last, (score, ids), strict=True):
            x[group[full]] = y[full]


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[np.ndarray], list[dict[str, np.ndarray]]]]:
    """Each cell: its row; the matrices and the numbers of its anchors and of its rows."""
    for batch in batches:
        for k in range(batch.num_rows):
            cell = {name: batch[name][k] for name in batch.schema.names}
            matrices, numbers = [], []
            for p in ("a_", ""):
                numbers.append({c: np.array(cell[p + c].values, np.int64) for c in ("rows", "ids", "labels")})
                shape, held = (cell[p + "width"].as_py(), len(numbers[-1]["rows"])), cell[p + "matrix"].as_buffer()
                matrices.append(np.frombuffer(held, f"i{held.size // (shape[0] * shape[1]) if held.size else 8}").reshape(shape))
            yield cell, matrices, numbers


def _slices(start: int, end: int, new: bool) -> Iterator[slice]:
    """The rows from ``start`` to ``end`` at once or, for ``new`` anchors, a few first."""
    size = FIRST_ROWS if new else end
    while start < end:
        yield slice(start, min(end, start + size))
        start, size = start + size, 8 * size


def _collect(anchors: dict[str, np.ndarray], owner: np.ndarray, positive: np.ndarray | None, found: list[np.ndarray]) -> pa.RecordBatch:
    """``owner``: of each group."""
    group, score, ids, rows = found
    positive = pa.nulls(len(group), pa.int64()) if positive is None else pa.array(positive[group])
    columns = {"anchor": anchors["rows"][owner[group]], "anchor_id": anchors["ids"][owner[group]], "positive_score": positive, "row": rows, "vec_id": ids, "score": score}
    return pa.RecordBatch.from_pydict(columns)


_FOUND_TYPE = "anchor bigint, anchor_id bigint, positive_score bigint, row bigint, vec_id bigint, score bigint"


def _positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, tuple[dict[str, np.ndarray], Firsts, np.ndarray]] = {}
    for _, (queries, matrix), (anchors, rows) in _cells(batches):
        _most(matrix, queries)  # also of rows of other labels
        size = len(anchors["rows"])
        _, firsts, floors = held.setdefault(int(anchors["rows"][0]), (anchors, Firsts(size, POSITIVES), np.full(size, LEAST)))
        for label in np.intersect1d(anchors["labels"], rows["labels"]):
            own, run = (slice(*(np.searchsorted(x["labels"], label, side) for side in ("left", "right"))) for x in (anchors, rows))
            floor = floors[own]
            for part in _slices(run.start, run.stop, (floor == LEAST).any()):
                block = VerticalBlock(matrix[:, part], queries[:, own])
                done, query, alive, partial = block.head(floor, None)
                other = rows["rows"][part][alive] != anchors["rows"][own][query]
                query, alive, score = block.scan(query[other], alive[other], best(POSITIVES, floor), done, partial[other])
                firsts.add(query + own.start, score, rows["ids"][part][alive], rows["rows"][part][alive])
                np.maximum(floor, firsts.last[0][own], out=floor)
    for anchors, firsts, _ in held.values():
        yield _collect(anchors, np.arange(len(anchors["rows"])), None, firsts.found)
    release_memory()


def _negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, tuple] = {}
    for cell, (queries, matrix), (anchors, rows) in _cells(batches):
        size = len(anchors["rows"])
        if int(anchors["rows"][0]) not in held:
            wanted = [w.as_py() for w in cell["a_windows"]]
            places = max(map(len, wanted))
            positive, lo, hi = np.zeros((places, size), np.int64), np.full((places, size), MOST), np.full((places, size), LEAST)
            for a, scores in enumerate(wanted):
                for w, p in enumerate(scores):
                    positive[w, a], (lo[w, a], hi[w, a]) = p, window(p)
            held[int(anchors["rows"][0])] = anchors, positive, lo, hi, lo.copy(), Firsts(lo.size, NEGATIVES)
        _, _, lo, hi, floor, firsts = held[int(anchors["rows"][0])]
        if len(np.unique(np.concatenate((anchors["labels"], rows["labels"])))) == 1:
            continue
        for part in _slices(0, len(rows["rows"]), not len(firsts.found[0])):
            block = VerticalBlock(matrix[:, part], queries)
            done, query, alive, partial = block.head(floor.min(0), hi.max(0))
            other = rows["labels"][part][alive] != anchors["labels"][query]
            query, alive, score = block.scan(query[other], alive[other], best_in([*zip(lo, hi, strict=True)], NEGATIVES, [*floor]), done, partial[other])
            window_of, inside = np.nonzero((score >= lo[:, query]) & (score <= hi[:, query]))
            firsts.add(window_of * size + query[inside], score[inside], rows["ids"][part][alive[inside]], rows["rows"][part][alive[inside]])
            np.maximum(floor, firsts.last[0].reshape(floor.shape), out=floor)
    for anchors, positive, *_, firsts in held.values():
        yield _collect(anchors, np.tile(np.arange(len(anchors["rows"])), len(positive)), positive.ravel(), firsts.found)
    release_memory()


def hard_negatives(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score`` over
    ``participants``; ``is_anchor``: a condition on their columns."""
    ship(rows.sparkSession)
    blocks = _blocks(rows, BLOCK, "bond-blocks")
    anchors = rows.where(is_anchor)
    order = [F.col("score").desc(), F.col("vec_id"), F.col("row")]

    packed = _blocks(anchors, ANCHOR_BLOCK, "bond-anchors")
    near = cells(packed, blocks).mapInArrow(_positives, _FOUND_TYPE)
    near = near.withColumn("place", F.row_number().over(Window.partitionBy("anchor").orderBy(*order))).where(F.col("place") <= POSITIVES)
    positives = staged(near.select("anchor", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("row").alias("positive_row"), F.col("score").alias("positive_score")), "bond-positives")

    windows = positives.groupBy(F.col("anchor").alias("row")).agg(F.collect_set("positive_score").alias("windows"))
    packed = _blocks(anchors.join(windows.hint("merge"), "row"), ANCHOR_BLOCK, "bond-windows")
    hard = cells(packed, blocks).mapInArrow(_negatives, _FOUND_TYPE)
    by = Window.partitionBy("anchor", "positive_score").orderBy(*order)
    hard = hard.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= NEGATIVES).drop("anchor_id")
    return positives.hint("merge").join(hard, ["anchor", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
