"""Near-duplicate documents by SimHash fingerprints and pivot distance tables.

Fingerprint: A-Z lowered, words ``[^\\x20\\x09-\\x0D]+``, three-word shingles with repeats (fewer words: the whole
sequence), joined by one blank and hashed by XXH64 (seed 42); a bit is set if it is set in over half the hashes. Texts
without words have fingerprint zero. Fingerprints link at ``MAX_BITS`` or fewer differing bits.

Pivot distance tables: the Hamming distances of each distinct fingerprint to fixed reference fingerprints. By the
triangle inequality no distance of two linked fingerprints differs by more than MAX_BITS. Two kinds of references:

* SEGMENT_REFERENCES for each of five segments of the bits, each apart from the zero fingerprint in that segment only, so
  the difference of the distances to it and to zero depends on that segment alone. At most MAX_BITS = 3 segments change
  between linked fingerprints, so all these coordinates agree in two whole segments at least: fingerprints meet by the
  coordinates of each two segments, which misses no link.
* WIDE_REFERENCES anywhere: of fingerprints that meet, pairs with a coordinate difference above MAX_BITS are
  discarded, one coordinate after the other, and survivors are verified bit by bit.

A group of more than CHUNK fingerprints that meet is split in chunks, and each two chunks are compared in a task of their
own; of a comparison a spanning forest is kept, not the pairs. Copies share a fingerprint and are never paired.

Null text is empty. A null ``doc_id`` is never a component's id, unless all of the component's are null. Rows that share an
id or a text are each a row of the result. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vesselflow.llm.components import components
from vesselflow.llm.stage import filter_bits, join_groups, key_filter, passes_filter, ship, staged, whole_text
from vesselflow.llm.textbatch import chunks, release_memory, spans, xxh64

SHINGLE = 3
SEED = 42
MAX_BITS = 3
SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
SEGMENT_REFERENCES = 14
WIDE_REFERENCES = 16
CHUNK = 8192
#: Groups up to this size are compared together with others, shift by shift.
SMALL = 64

_BYTE = np.arange(256)
BLANK = (_BYTE == 0x20) | ((_BYTE >= 0x09) & (_BYTE <= 0x0D))
LOWER = np.where((_BYTE >= 0x41) & (_BYTE <= 0x5A), _BYTE + 32, _BYTE).astype(np.uint8)

def shingles(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words joined by one blank, and each shingle's start, end and row in them."""
    starts, ends, rows = spans(buf, at, BLANK)
    n = len(starts)
    size = ends - starts
    to = np.zeros(n + 1, np.int64)
    np.cumsum(size + 1, out=to[1:])
    joined = buf[np.minimum(np.arange(to[-1]) + np.repeat(starts - to[:-1], size + 1), max(len(buf) - 1, 0))]
    joined[to[1:] - 1] = 0x20
    words = np.bincount(rows, minlength=len(at) - 1)
    first = np.cumsum(words) - words
    place = np.arange(n) - first[rows]
    own = np.flatnonzero(place < np.maximum(words[rows] - SHINGLE + 1, 1))
    last = np.minimum(own + SHINGLE, first[rows[own]] + words[rows[own]]) - 1
    return joined, to[own], to[last] + size[last], rows[own]


def fingerprints(array: pa.Array) -> pa.Array:
    """The fingerprint of each text, its bits as a signed 64-bit integer."""
    out = np.zeros(len(array), np.uint64)
    for lo, _, buf, at in chunks(array):
        joined, starts, ends, rows = shingles(LOWER[buf], at)
        if not len(rows):
            continue
        bits = np.unpackbits(xxh64(joined, starts, ends, SEED).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        n = np.diff(np.append(first, len(rows)))
        over = 2 * np.add.reduceat(bits, first, axis=0, dtype=np.int64) > n[:, None]
        out[lo + rows[first]] = np.packbits(over, axis=1, bitorder="little").view(np.uint64)[:, 0]
    release_memory()
    return pa.array(out.view(np.int64))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fp`` of each row."""
    ship(docs.sparkSession)
    return docs.select("doc_id", F.arrow_udf(fingerprints, "bigint")(whole_text()).alias("fp"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def references() -> tuple[list[list[int]], list[int]]:
    """For each segment its references, and the wide ones."""
    draw = random.Random(SEED)
    by_segment = [[draw.randrange(1, 1 << width) << low for _ in range(SEGMENT_REFERENCES)] for low, width in SEGMENTS]
    return by_segment, [draw.getrandbits(64) for _ in range(WIDE_REFERENCES)]


def pivot_table(fps: DataFrame) -> DataFrame:
    """``fp``, ``segments`` (for each segment a hash of its coordinates) and ``wide`` (distances to the wide references,
    eight to a long, one byte each)."""
    distance = lambda reference: F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(reference))))
    by_segment, wide = references()
    coordinates = [F.xxhash64(*[distance(r) - F.bit_count("fp") for r in own]) for own in by_segment]
    packed = []
    for k in range(0, WIDE_REFERENCES, 8):
        x = F.lit(0).cast("long")
        for j, r in enumerate(wide[k : k + 8]):
            x = x.bitwiseOR(F.shiftleft(distance(r).cast("long"), 8 * j))
        packed.append(x)
    return fps.select("fp", F.array(*coordinates).alias("segments"), F.array(*packed).alias("wide"))


def meeting_keys(table: DataFrame) -> DataFrame:
    """``key``, ``fp``, ``wide``: a row for each two segments."""
    both: list[Column] = [F.xxhash64(F.lit(k), F.col("segments")[a], F.col("segments")[b]) for k, (a, b) in enumerate(combinations(range(len(SEGMENTS)), 2))]
    return table.select(F.explode(F.array(*both)).alias("key"), "fp", "wide")


def survivors(fp: np.ndarray, wide: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose coordinates all differ by MAX_BITS at most, and whose fingerprints do."""
    for c in range(wide.shape[1]):
        near = np.abs(wide[i, c] - wide[j, c]) <= MAX_BITS
        i, j = i[near], j[near]
    near = np.bitwise_count(fp[i] ^ fp[j]) <= MAX_BITS
    return i[near], j[near]


def hook(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``root`` (each item's smallest known companion) after the links i - j."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def spanning_links(fp: np.ndarray, wide: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within each of the consecutive groups of ``sizes`` fingerprints."""
    n = len(fp)
    root = np.arange(n)
    ends = np.repeat(np.cumsum(sizes), sizes)
    for shift in range(1, int(sizes[sizes <= SMALL].max(initial=1))):
        i = np.flatnonzero((np.arange(n) + shift < ends) & np.repeat(sizes <= SMALL, sizes))
        root = hook(root, *survivors(fp, wide, i, i + shift))
    for end, size in zip(np.cumsum(sizes)[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        own = end - size + np.argsort(wide[end - size : end, 0], kind="stable")
        first = wide[own, 0]
        step = max(1, (1 << 21) // size)
        for lo in range(0, size, step):
            hi = min(lo + step, size)
            most = np.searchsorted(first, first[hi - 1] + MAX_BITS, "right")
            a, b = own[lo:hi], own[lo:most]
            near = np.abs(wide[a, 1][:, None] - wide[b, 1][None, :]) <= MAX_BITS
            near &= (root[a][:, None] != root[b][None, :]) & (np.arange(lo, hi)[:, None] < np.arange(lo, most)[None, :])
            i, j = np.nonzero(near)
            root = hook(root, *survivors(fp, wide, a[i], b[j]))
    own = np.flatnonzero(root != np.arange(n))
    return own, root[own]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = np.diff(batch["members"].offsets.to_numpy())
        members = batch["members"].flatten()
        fp = members.field("fp").to_numpy(zero_copy_only=False).astype(np.int64)
        wide = members.field("wide").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        i, j = spanning_links(fp.view(np.uint64), wide.view(np.uint8).reshape(len(fp), WIDE_REFERENCES).astype(np.int8), sizes.astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(fp[i]), pa.array(fp[j])], names=["a", "b"])
    release_memory()


def links(fps: DataFrame) -> DataFrame:
    """``a``, ``b``: links that connect what the links of all pairs of the distinct ``fp`` connect."""
    table = staged(pivot_table(fps), "pivots")
    keys = meeting_keys(table)
    shared = staged(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "pivot-keys")
    bits = filter_bits(shared.count())
    meeting = passes_filter(keys, F.col("key"), key_filter(shared, F.col("key"), bits), "meets", bits).where("meets").drop("meets")
    meeting = join_groups(staged(meeting, "pivot-rows"), shared, ["key"], "n", "inner")
    parts = F.ceil(F.col("n") / CHUNK).cast("int")
    chunk = meeting.groupBy("key", parts.alias("parts"), F.pmod(F.xxhash64("fp"), parts).cast("int").alias("part")).agg(
        F.collect_list(F.struct("fp", "wide")).alias("members")
    )
    chunk = staged(chunk, "pivot-chunks")
    other = F.explode(F.expr("sequence(0, parts - 1)")).alias("other")
    cells = chunk.where("parts > 1").select("key", "part", other, "members").groupBy(
        "key", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi")
    ).agg(F.flatten(F.collect_list("members")).alias("members"))
    compared = chunk.where("parts = 1").select("members").unionByName(cells.select("members"))
    return compared.mapInArrow(_links, "a bigint, b bigint")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (the smallest
    ``doc_id`` that links lead to, its own included) and ``component_size``."""
    rows = staged(fingerprinted(docs), "simhash")
    groups = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("min_id"), F.count(F.lit(1)).alias("n")), "simhash-groups")
    labels = components(staged(links(groups.select("fp")), "simhash-links"))
    labelled = groups.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    labelled = staged(labelled, "simhash-labels")
    classes = labelled.groupBy("label").agg(
        F.min("min_id").alias("component_id"), F.sum("n").alias("component_size"), F.count(F.lit(1)).alias("fps")
    )
    by_fp = join_groups(labelled.drop("min_id"), staged(classes, "simhash-classes"), ["label"], "fps")
    by_fp = staged(by_fp.select("fp", "n", "component_id", "component_size"), "simhash-classes")
    out = join_groups(rows, by_fp, ["fp"], "n")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component_size")
