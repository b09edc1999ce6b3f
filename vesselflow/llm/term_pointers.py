"""Source divergence audit: how far each source's use of terms is from that of the other sources of its language.

Token-start pointer sort: of each shard of texts (Arrow buffers of about SHARD_BYTES) the byte positions where terms
start are sorted by the bytes that follow, with a multikey quicksort whose digit is eight bytes: a slice of pointers is
quicksorted on its next eight bytes, and only runs of equal bytes are looked at again, eight bytes further. No term is
copied or made a Python object while sorting. The runs of equal pointers give document frequencies and counts by source;
Spark adds the shards' counts up.

Terms are ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, with A-Z lowered. A language keeps the terms in at least ``min_docs``
of its documents. Every (lang, source) that occurs, and every language, gives each kept term with ``count`` occurrences
the share ``p = 1 + floor(10^9 (count + 1) / (N + V))``, with N its occurrences of kept terms and V the language's kept
terms; ``f = floor((p - q)^2 / q)`` measures how far p is from q. All arithmetic is on integers (wide decimals for the
shares).

Null text, lang and source count as ''. A text without terms still makes its group occur. Each row is a document, also
where rows are equal or share an id. Equal values are ranked by item. Empty tables give empty results; other columns are
not read. A shard is bounded by SHARD_BYTES or by the longest text; the shares of a block of terms by CELLS numbers, or
by the number of sources of a language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vesselflow.llm.stage import join_groups, ship, staged
from vesselflow.llm.textbatch import release_memory, spans, utf8

MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
SHARD_BYTES = 8 << 20
#: Shares of a block of terms (terms x sources); sources of one tile of a block.
CELLS = 1 << 13
TILE = 256

_BYTE = np.arange(256)
IN_TERM = (_BYTE >= 0x80) | ((_BYTE >= 0x41) & (_BYTE <= 0x5A)) | ((_BYTE >= 0x61) & (_BYTE <= 0x7A))
LOWER = np.where((_BYTE >= 0x41) & (_BYTE <= 0x5A), _BYTE + 32, _BYTE).astype(np.uint8)
#: The first k of eight bytes, big-endian.
_HEAD = np.array([((1 << 64) - 1) ^ ((1 << (64 - 8 * k)) - 1) for k in range(9)], np.uint64)


def sort_pointers(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pointers in the order of the terms they point to, and the number of each one's run of equal terms (from 0).
    Terms hold no zero byte."""
    n = len(starts)
    padded = np.concatenate((buf, np.zeros(8, np.uint8)))
    eight = np.ndarray(len(buf) + 1, ">u8", padded, strides=(1,))
    order, begins = np.arange(n), np.zeros(n, bool)
    begins[:1] = True
    slots, slices, depth = np.arange(n), np.zeros(n, np.int64), 0
    while len(slots):
        own = order[slots]
        at = starts[own] + depth
        key = eight[at].astype(np.uint64) & _HEAD[np.minimum(ends[own] - at, 8)]
        by = np.argsort(key)
        if slices[-1]:
            by = by[np.argsort(slices[by], kind="stable")]
        order[slots], key, slices = own[by], key[by], slices[by]
        new = np.ones(len(slots), bool)
        new[1:] = (key[1:] != key[:-1]) | (slices[1:] != slices[:-1])
        begins[slots[new]] = True
        # a run is settled if its terms end within these eight bytes, or it holds one pointer
        run = np.cumsum(new) - 1
        more = ((key & np.uint64(0xFF)) != 0) & (np.bincount(run) > 1)[run]
        slots, slices, depth = slots[more], run[more], depth + 8
    return order, np.cumsum(begins) - 1


def shard_counts(buf: np.ndarray, at: np.ndarray, group: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Terms, groups, occurrences and documents of each (term, group) of a shard; ``group``: each document's."""
    buf = LOWER[buf]
    starts, ends, rows = spans(buf, at, ~IN_TERM)
    order, run = sort_pointers(buf, starts, ends)
    n = len(group)
    by_group = np.argsort(group, kind="stable")
    place = np.empty(n, np.int64)
    place[by_group] = np.arange(n)
    packed = run * n + place[rows[order]]
    packed.sort()
    owner = group[by_group[packed % n]] if n else packed
    new_doc, new_group = np.ones(len(packed), bool), np.ones(len(packed), bool)
    new_doc[1:] = packed[1:] != packed[:-1]
    new_group[1:] = (packed[1:] // n != packed[:-1] // n) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new_group)
    counts = np.diff(np.append(first, len(packed)))
    docs = np.add.reduceat(new_doc.astype(np.int64), first) if len(first) else counts
    pointer = order[np.flatnonzero(np.diff(run, prepend=-1))][packed[first] // n] if len(first) else first
    return _strings(buf, starts[pointer], ends[pointer]), owner[first], counts, docs


def _strings(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as an Arrow string array."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    data = buf[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], ends - starts)]
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= SHARD_BYTES:
            yield from _shard(pa.Table.from_batches(held))
            held, size = [], 0
    if held:
        yield from _shard(pa.Table.from_batches(held))
    release_memory()


def _shard(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """The counts of the table's documents, and a row without a term for each of its groups."""
    if not table.num_rows:
        return
    lang, source = (table[c].combine_chunks().dictionary_encode() for c in ("lang", "source"))
    names = len(source.dictionary)
    pairs, group = np.unique(lang.indices.to_numpy().astype(np.int64) * names + source.indices.to_numpy(), return_inverse=True)
    buf, at = utf8(table["text"])
    terms, owner, counts, docs = shard_counts(buf[at[0] :], at - at[0], group)
    for texts, own, n, df in (
        (pa.nulls(len(pairs), pa.string()), pairs, np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)),
        (terms.cast(pa.string()), pairs[owner], counts, docs),
    ):
        columns = [lang.dictionary.take(pa.array(own // names)), source.dictionary.take(pa.array(own % names)), texts, pa.array(n), pa.array(df)]
        yield pa.RecordBatch.from_arrays([c.cast(pa.string()) if pa.types.is_large_string(c.type) else c for c in columns], names=["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, its occurrences ``n`` and documents ``docs`` there; a null term for each group."""
    ship(docs.sparkSession)
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    shards = texts.mapInArrow(_count, "lang string, source string, term string, n bigint, docs bigint")
    return shards.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The kept terms of ``term_counts``: ``lang``, ``source``, ``term``, ``n``, the language's occurrences ``lang_n``,
    and ``first``: 1 in one row of each (lang, term). A term has one row for each source at most."""
    term = Window.partitionBy("lang", "term")
    rows = counts.where("term IS NOT NULL").select(
        "lang", "source", "term", "n", F.sum("n").over(term).alias("lang_n"), F.sum("docs").over(term).alias("lang_docs"),
        (F.col("source") == F.min("source").over(term)).cast("int").alias("first"),
    )
    return rows.where(F.col("lang_docs") >= min_docs).drop("lang_docs")


def share(count: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE (count + 1) / (total + terms))."""
    return F.expr(f"1L + ({SCALE}BD * CAST({count} + 1 AS DECIMAL(19, 0))) DIV CAST({total} + {terms} AS DECIMAL(20, 0))")


def divergence(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) DIV {q}")


def _groups(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """Every (lang, source) with its kept occurrences ``total`` in ``size`` rows, the language's ``lang_total``, kept
    ``terms`` and number of ``sources``, and the ``blocks`` and ``tiles`` to compare them in."""
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("size"), F.sum("first").alias("own"))
    groups = counts.where("term IS NULL").select("lang", "source").join(sums, ["lang", "source"], "left").na.fill(0)
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("own").alias("terms"), F.count(F.lit(1)).alias("sources"))
    rows = groups.drop("own").join(langs, "lang")
    return rows.withColumns(
        {
            "blocks": F.ceil(F.col("terms") * F.col("sources") / CELLS).cast("int"),
            "tiles": F.ceil(F.col("sources") / TILE).cast("int"),
        }
    )


def _compare(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums of f over the terms of a block, from each source of the tile to every source."""
    sources, p0 = right["source"].combine_chunks(), right["p0"].to_numpy()
    mine = np.flatnonzero(right["mine"].to_numpy())
    term = left["term"].combine_chunks().dictionary_encode()
    shares = np.repeat(p0[:, None], len(term.dictionary), 1)
    shares[pc.index_in(left["source"].combine_chunks(), sources).to_numpy(), term.indices.to_numpy()] = left["p"].to_numpy()
    out = np.empty((len(mine), len(sources)), np.int64)
    for k, g in enumerate(mine):
        apart = shares[g] - shares
        out[k] = (apart * apart // shares).sum(1)
    from_, to = np.repeat(mine, len(sources)), np.tile(np.arange(len(sources)), len(mine))
    lang = pa.repeat(right["lang"][0] if len(sources) else pa.scalar(None, pa.string()), len(from_))
    return pa.table({"lang": lang, "source": sources.take(pa.array(from_)), "item": sources.take(pa.array(to)), "value": out.ravel()})


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: for each (lang, source) the other sources of its
    language by their divergence (part ``pair``, all of them), and the ``top_terms`` terms that it uses most beyond its
    language (part ``term``)."""
    counts = staged(term_counts(docs), "term-counts")
    kept = staged(kept_terms(counts, min_docs), "kept-terms")
    groups = staged(_groups(counts, kept), "term-groups")
    rows = join_groups(kept, groups.where("size > 0"), ["lang", "source"], "size")

    terms = rows.select("lang", "source", F.col("term").alias("item"), share("n", "total", "terms").alias("p"), share("lang_n", "lang_total", "terms").alias("q"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = terms.where("p > q").select("lang", "source", "item", divergence("p", "q").alias("value")).withColumn("rank", F.row_number().over(best))

    tile = F.explode(F.expr("sequence(0, tiles - 1)")).alias("tile")
    left = rows.select(
        "lang", "source", "term", share("n", "total", "terms").alias("p"), F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), tile
    )
    right = groups.where("blocks > 0").select("*", tile).select(
        "lang", "source", "tile", share("0", "total", "terms").alias("p0"),
        (F.pmod(F.xxhash64("source"), F.col("tiles")) == F.col("tile")).alias("mine"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
    )
    key = ["lang", "block", "tile"]
    sums = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_compare, "lang string, source string, item string, value bigint")
    others = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").withColumn("value", F.lit(0).cast("long"))
    pairs = others.unionByName(sums).where("source != item").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(best))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank").unionByName(
        terms.where(F.col("rank") <= top_terms).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    )
