"""Token counts with a SentencePiece model by a two-tier look-up on the map side.

1. The most frequent pre-tokens and their counts are a compact open-addressing table of 64-bit hashes, broadcast
   (its rows are bounded by TABLE_ROWS). Every task counts the pre-tokens of all its texts and passes on only its
   most frequent ones, so what is gathered for the table is bounded for each task and no pre-token is shuffled.
2. A pre-token that isn't in the table goes through a bounded cache of the worker process to the library.

The table decides only where a count is looked up: counts are those of the library whatever it holds. Null and
empty texts have no tokens. Each row is counted, repeated ones too. Empty tables give empty results. Other columns
are not read. A model that may join pieces across pre-tokens gets whole texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vesselflow.llm.pieces import PieceModel, pre_token_spans
from vesselflow.llm.stage import ship, whole_text
from vesselflow.llm.textbatch import Hasher, chunks, per_row

TABLE_ROWS = 1 << 15
#: Frequent pre-tokens that a task passes on, and how many it holds while it counts.
TASK_ROWS = 1 << 12
TASK_HELD = 1 << 16
CACHED = 500_000
MAX_CACHED_BYTES = 256


class Lengths(dict):
    """Token counts of pre-tokens (UTF-8, each with its leading space or line feed), from the library."""

    def __init__(self, path: str):
        super().__init__()
        self.model = PieceModel(path)

    def __missing__(self, key: bytes) -> int:
        text = key.decode()
        if text == " ":
            n = 1
        elif text[0] == " ":
            n = len(self.model.library.encode(text[1:]))
        else:  # without the mark that the library puts before a line feed
            n = len(self.model.library.encode(text)) - 1
        if len(key) <= MAX_CACHED_BYTES:
            if len(self) >= CACHED:
                self.clear()
            self[key] = n
        return n


@cache
def lengths(path: str) -> Lengths:
    return Lengths(path)


class Table:
    """Open addressing with linear probing over 64-bit hashes; a hash of 0 marks a free slot."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        size = 1 << max(4, (2 * len(hashes)).bit_length())
        self.keys, self.counts = np.zeros(size, np.uint64), np.zeros(size, np.uint16)
        self.mask = np.uint64(size - 1)
        for h, n in zip(hashes.tolist(), counts.tolist(), strict=True):
            k = h & (size - 1)
            while self.keys[k]:
                k = (k + 1) & (size - 1)
            self.keys[k], self.counts[k] = h, n

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """The counts; -1 where the table has no such hash."""
        out = np.full(len(hashes), -1, np.int64)
        slot = hashes & self.mask
        open_ = np.arange(len(hashes))
        while len(open_):
            found = self.keys[slot[open_]]
            hit = found == hashes[open_]
            out[open_[hit]] = self.counts[slot[open_[hit]]]
            open_ = open_[~hit & (found != 0)]
            slot[open_] = (slot[open_] + np.uint64(1)) & self.mask
        return out


def _with_dummy(text):
    """As the model sees it: a space before the text, and its white space mark as a space."""
    return F.when(text == "", F.lit("")).otherwise(F.concat(F.lit(" "), F.translate(text, "▁", " ")))


def _task_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's most frequent pre-tokens. Those met once in a chunk are not held."""
    held: Counter[bytes] = Counter()
    for batch in batches:
        for _, _, buf, at in chunks(batch.column(0)):
            starts, ends, _ = pre_token_spans(buf, at)
            _, first, n = np.unique(Hasher(buf)(starts, ends), return_index=True, return_counts=True)
            raw = buf.tobytes()
            for k in np.flatnonzero((n > 1) & (ends[first] - starts[first] <= MAX_CACHED_BYTES)):
                held[raw[starts[first[k]] : ends[first[k]]]] += int(n[k])
            if len(held) > 2 * TASK_HELD:
                held = Counter(dict(held.most_common(TASK_HELD)))
    top = held.most_common(TASK_ROWS)
    yield pa.RecordBatch.from_pydict({"key": pa.array([k for k, _ in top], pa.binary()), "n": pa.array([n for _, n in top], pa.int64())})


def frequent_table(docs: DataFrame, path: str, rows: int = TABLE_ROWS) -> Table:
    """The table of the most frequent pre-tokens of all of ``docs``."""
    ship(docs.sparkSession)
    by_task = docs.select(_with_dummy(whole_text()).alias("text")).mapInArrow(_task_counts, "key binary, n bigint")
    top = by_task.groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(rows).collect()
    keys = [bytes(r["key"]) for r in top]
    buf = np.frombuffer(b"".join(keys), np.uint8)
    at = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int64)
    count = lengths(path)
    return Table(Hasher(buf)(at[:-1], at[1:]), np.array([count[k] for k in keys], np.int64))


def _count(path: str, shared):
    def count(array: pa.Array) -> pa.Array:
        known, table = lengths(path), shared.value
        out = np.zeros(len(array), np.int64)
        if not known.model.cuttable:
            return pa.array([len(known.model.library.encode(t[1:])) for t in array.to_pylist()], pa.int64())
        for lo, hi, buf, at in chunks(array):
            starts, ends, rows = pre_token_spans(buf, at)
            n = table.look_up(Hasher(buf)(starts, ends))
            missed = np.flatnonzero(n < 0)
            raw = buf.tobytes()
            keys = [raw[a:b] for a, b in zip(starts[missed].tolist(), ends[missed].tolist(), strict=True)]
            n[missed] = np.fromiter(map(known.__getitem__, keys), np.int64, len(keys))
            out[lo:hi] = per_row(n, rows, hi - lo)
        return pa.array(out)

    return count


def with_counts(docs: DataFrame, path: str, name: str = "n_tokens") -> DataFrame:
    """``docs`` with its texts' token counts in the column ``name``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(frequent_table(docs, path))
    return docs.withColumn(name, F.arrow_udf(_count(path, shared), "bigint")(_with_dummy(whole_text())))
