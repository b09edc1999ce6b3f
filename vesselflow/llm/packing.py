"""Packing token ids into sequences: first-fit decreasing with a tournament tree over bin capacities, run by
itself in each randomised group of documents.

A document is cut every ``max_len`` tokens; whole cuts are sequences of their own, made where the document is
tokenised, and only the remainders travel to their group. After first-fit decreasing, the tokens of a group's
emptiest bins are cut to fill the holes of the fuller ones, and the last bin is cut at powers of two, which need
no padding; so a group has no padding at all.

Null text counts as empty: such a document is its end id alone. Each row is packed, repeated ones too. A row's
group is drawn from its place in the input, so rows spread over the groups however many are equal; pass a stored
table, whose places are the same when a task is run again. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vesselflow.llm.stage import ship, whole_text
from vesselflow.llm.word_ids import texts_of, word_ids

MAX_LEN = 2048
#: Documents of a group, about. More documents leave fewer cuts at a group's end; the group's remainders
#: (2 bytes a token below 65,536 ids) are what a task holds.
GROUP_DOCS = 512
#: Bits of a sequence id that name its group; the other 23 number the sequences of a group.
_GROUP_BITS = 40
_CUT = "doc_id bigint, doc_tokens bigint, place bigint, start bigint, length bigint, crc bigint, ids binary"
_CUT_NAMES = [x.split()[0] for x in _CUT.split(", ")]
_PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


class FirstFit:
    """A tournament tree over the free room of bins in order of opening: each node holds the larger of its two
    children, so the first bin with enough room is found from the root in one descent."""

    def __init__(self, items: int, size: int):
        self.size, self.opened = size, 0
        self.leaves = 1 << max(0, (max(1, items) - 1).bit_length())
        self.room = [0] * (2 * self.leaves)

    def _set(self, leaf: int, room: int) -> None:
        k, tree = leaf + self.leaves, self.room
        tree[k] = room
        while k > 1:
            k >>= 1
            top = max(tree[2 * k], tree[2 * k + 1])
            if tree[k] == top:
                break
            tree[k] = top

    def place(self, length: int) -> int:
        """The bin that takes ``length``: the first opened with room, else a new one."""
        tree = self.room
        if tree[1] < length:
            leaf = self.opened
            self.opened += 1
            self._set(leaf, self.size - length)
            return leaf
        k = 1
        while k < self.leaves:
            k = 2 * k if tree[2 * k] >= length else 2 * k + 1
        self._set(k - self.leaves, tree[k] - length)
        return k - self.leaves


def pack(lengths: list[int], size: int = MAX_LEN) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, first token, tokens) that hold each item's tokens once. Every sequence is full, or its
    length is a power of two."""
    fit = FirstFit(len(lengths), size)
    bins: list[list[tuple[int, int, int]]] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = fit.place(lengths[i])
        if at == len(bins):
            bins.append([])
        bins[at].append((i, 0, lengths[i]))
    used = [sum(p[2] for p in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda k: (-used[k], k))
    front, back = 0, len(order) - 1
    while front < back:
        taker, giver = bins[order[front]], bins[order[back]]
        hole = size - used[order[front]]
        if not hole:
            front += 1
        elif not giver:
            back -= 1
        else:
            item, start, length = giver.pop()
            take = min(hole, length)
            taker.append((item, start, take))
            if take < length:
                giver.append((item, start + take, length - take))
            used[order[front]] += take
            used[order[back]] -= take
    out = [bins[k] for k in order[:back] if bins[k]]
    rest = bins[order[back]] if order else []
    left = sum(p[2] for p in rest)
    while left:
        target = size if left >= size else 1 << (left.bit_length() - 1)
        sequence, have = [], 0
        while have < target:
            item, start, length = rest.pop()
            take = min(target - have, length)
            sequence.append((item, start, take))
            if take < length:
                rest.append((item, start + take, length - take))
            have += take
        out.append(sequence)
        left -= target
    return out


def _cuts(path: str, end_id: int, size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path)
        end, wide = np.array([end_id], words.dtype).tobytes(), np.dtype("<u4")
        for batch in batches:
            rows = []
            for doc, text, place in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                ids = np.frombuffer(words.encode(text) + end, words.dtype)
                n, full = len(ids), len(ids) // size * size
                rows += [(doc, n, place, k, size, zlib.crc32(ids[k : k + size].astype(wide)), None) for k in range(0, full, size)]
                if full < n:
                    rows.append((doc, n, place, full, n - full, zlib.crc32(ids[full:].astype(wide)), ids[full:].tobytes()))
            kinds = [pa.int64()] * 6 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=_CUT_NAMES)

    return cut


def _pack_group(bytes_per_id: int, size: int):
    dtype = np.dtype(f"<u{bytes_per_id}")

    def run(key: tuple, group: pa.Table) -> pa.Table:
        first = key[0].as_py() << (63 - _GROUP_BITS)
        rows = list(zip(*(group[c].to_pylist() for c in ("doc_id", "start", "length", "crc", "doc_tokens", "ids")), strict=True))
        rest = [r for r in rows if r[5] is not None]
        rest.sort(key=lambda r: (-r[2], r[0] is not None, r[0] or 0, r[1], r[3]))
        ids = [np.frombuffer(r[5], dtype) for r in rest]
        out = []
        sequences = pack([len(x) for x in ids], size)
        for n, sequence in enumerate(sequences):
            offset = 0
            for item, start, length in sequence:
                crc = zlib.crc32(ids[item][start : start + length].astype("<u4"))
                out.append((rest[item][0], rest[item][1] + start, length, crc, rest[item][4], first + n, offset))
                offset += length
        done = (r for r in rows if r[5] is None)
        out += [(d, s, n, c, t, first + len(sequences) + k, 0) for k, (d, s, n, c, t, _) in enumerate(done)]
        return pa.table([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=[x.split()[0] for x in _PIECE.split(", ")])

    return run


def packed(docs: DataFrame, path: str, end_id: int = 1, size: int = MAX_LEN, group_docs: int = GROUP_DOCS) -> DataFrame:
    """One row for each piece of a document: ``doc_id``, ``start`` (its document's ids before it), ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence."""
    ship(docs.sparkSession)
    groups = -(-docs.count() // group_docs) or 1
    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"), F.monotonically_increasing_id().alias("place"))
    cuts = rows.mapInArrow(_cuts(path, end_id, size), _CUT)
    pieces = cuts.withColumn("group", F.pmod(F.xxhash64("place"), F.lit(groups))).drop("place")
    return pieces.groupBy("group").applyInArrow(_pack_group(word_ids(path).dtype.itemsize, size), _PIECE)
