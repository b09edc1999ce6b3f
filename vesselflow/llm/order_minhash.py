"""Near-duplicate detection by Order MinHash.

Of a text's k-mers (WORDS consecutive words, each labelled with its occurrence number in the text) each of
SKETCHES hash functions takes the KEPT smallest and keeps them in text order; equal ordered samples make two texts
candidates. Texts in another order of the same words differ, so a collision speaks of edit similarity. Candidates
are verified by banded alignment of their whole word sequences: 1 - edits / longer length >= SIMILARITY.

Short texts have too few k-mers to sample, so their keys lose no similar pair: where both have at most FEW words, the
subsequences that are left without the words that may be edited; else, where both have at most SHORT words, all
k-mers of the length that as many edits can't all break.

Texts with equal words are one node; a text is in a bucket for each of its keys. A node is compared with the smallest
of its buckets' smallest nodes, then with those of them that are in another class still. Nodes of another class than
their bucket's smallest node (the rest) are joined exactly with all nodes of such buckets: an edit breaks two pairs of
adjacent words at most, so texts this similar share one of their rarest such pairs (each takes two fifths of its own).
Only nodes with a rare word pair in common whose lengths and remaining pairs allow the similarity are aligned, and only
where the links so far leave them in different classes. How rare a pair is may be told in any order that is the same for
all nodes: the pairs of use (to nodes of several classes, one of the rest) are counted exactly, and the order is by a
table of SLOTS to MOST_SLOTS of those counts, so the pairs of no use never leave the task. Two nodes with several rare pairs
in common meet once for each run of them, as where they also have the last pair in common they have met before. Before that, nodes are compared with the smallest node that has the pair, so that large classes
are whole and form no pairs; unlike texts with the same rare pair do form pairs there: as rows where at most MANY nodes have it, else block by block within
tasks, in the square of their number. Hot buckets, word pairs and centres are split. Classes are the connected components of the verified links.

Words are runs of letters, digits and non-ASCII characters, A-Z lowered. Texts without words (null, empty) are equal
to each other. Texts of so few words that none may be edited have no keys. Each row gets its class, repeated ones
too; a class is named by its smallest ``doc_id``, null ids aside. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vesselflow.llm.components import FEW, components, follow
from vesselflow.llm.stage import HOT_SHARE, filter_bits, join_groups, key_filter, passes_filter, ship, staged, unstage, whole_text, without
from vesselflow.llm.textbatch import SpanHasher, chunks, mix64, release_memory, repeats, spans, windows

WORDS = 5
SKETCHES = 64
KEPT = 2
SIMILARITY = 0.8
#: Words of the longest texts that are keyed by subsequences (two edits at most), and by all k-mers.
BRIEF, SHORT = 14, 40
#: Slots for the counts of word pairs of use, by hash (two bytes each): sixteen for a pair, between these.
SLOTS, MOST_SLOTS = 1 << 20, 1 << 23
#: Edits that are looked for by the furthest reach.
REACH = 32
#: Nodes that meet in a word pair's join at most; those of a pair in more are compared block by block.
MANY = 64
#: Nodes and words of a block, about.
BLOCK_NODES, BLOCK_WORDS = 512, 1 << 17

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_GAP = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_ODD = mix64(np.arange(1, SKETCHES + 1, dtype=np.uint64)) | np.uint64(1)
_TURN = mix64(np.arange(101, 101 + SKETCHES, dtype=np.uint64))


def samples(kmers: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """(n, SKETCHES) hashes of the ordered samples. ``kmers``: labelled k-mers' hashes in text order; rows ascending,
    each of the n rows with one at least."""
    first = np.searchsorted(rows, np.arange(n))
    counts = np.diff(np.append(first, len(rows)))
    out = np.empty((n, SKETCHES), np.uint64)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    for k in range(SKETCHES):
        value = (kmers ^ _TURN[k]) * _ODD[k]
        value ^= value >> np.uint64(32)
        value = value * _ODD[k]
        taken = np.zeros((KEPT, n), np.int64)
        for r in range(KEPT):
            least = np.minimum.reduceat(value, first)
            at = np.flatnonzero(value == np.repeat(least, counts))
            row = rows[at]
            at = at[np.concatenate(([True], row[1:] != row[:-1]))]
            taken[r] = np.where(least == top, -1, at)
            value[at] = top
        taken.sort(axis=0)
        key = np.full(n, _TURN[k])
        for r in range(KEPT):
            key = mix64(key ^ np.where(taken[r] < 0, np.uint64(0), kmers[taken[r]]))
        out[:, k] = key
    return out


def _limit(n: int) -> int:
    """Edits that the similarity allows at most where the longer text has ``n`` words."""
    return int((1 - SIMILARITY) * n + 1e-9)


def _hashed(kind: int, words: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(words.tobytes(), digest_size=8, salt=bytes([kind])).digest(), "little", signed=True)


def short_keys(words: np.ndarray) -> list[int]:
    """Keys of a text of at most SHORT words. Two such texts that have the similarity share one: of the longer's n words
    n - edits stay, in order, in both; they lie in edits + 1 runs at most, the longest of which has at least the k-mer's
    length."""
    n = len(words)
    found = set()
    for m in {k - _limit(k) for k in range(n, BRIEF + 1) if _limit(k)}:
        if m <= n:
            found.update(_hashed(m, words[list(kept)]) for kept in combinations(range(n), m))
    for size in {-(-(k - _limit(k)) // (_limit(k) + 1)) for k in range(max(n, BRIEF + 1), SHORT + 1) if n >= k - _limit(k)}:
        found.update(_hashed(BRIEF + size, words[i : i + size]) for i in range(n - size + 1))
    return sorted(found)


def _read(texts: pa.Array, with_words: bool, with_keys: bool) -> pa.Array:
    same, lengths, words_out, keys = [], [], [], []
    for lo, hi, raw, at in chunks(texts):
        n = hi - lo
        buf = _FOLD[raw]
        starts, ends, rows = spans(buf, at, _GAP)
        words = SpanHasher(buf)(starts, ends)
        counts = np.bincount(rows, minlength=n)
        edges = np.concatenate(([0], np.cumsum(counts)))
        if with_keys:
            keys += _keys(words, rows, counts, edges)
        small = words.astype(np.uint32)
        for r in range(n):
            a, b = edges[r], edges[r + 1]
            same.append(hashlib.blake2b(words[a:b].tobytes(), digest_size=16).digest())
            if with_words:
                words_out.append(small[a:b].tobytes())
        lengths.append(counts)
    release_memory()
    parts = {"same": pa.array(same, pa.binary()), "n_words": pa.array(np.concatenate(lengths) if lengths else [], pa.int64())}
    if with_words:
        parts["words"] = pa.array(words_out, pa.binary())
    if with_keys:
        parts["keys"] = pa.array(keys, pa.list_(pa.int64()))
    return pa.StructArray.from_arrays(list(parts.values()), names=list(parts))


def _keys(words: np.ndarray, rows: np.ndarray, counts: np.ndarray, edges: np.ndarray) -> list[list[int]]:
    """The keys of each text. ``words``: their words' hashes, of the texts ``rows``; each has ``counts`` from ``edges`` on."""
    sketch: list[list[int]] = [[] for _ in counts]
    sampled = counts + _limit(SHORT + 1) > SHORT  # may be similar to a text of more than SHORT words
    have = np.flatnonzero(sampled)
    if len(have):
        kmer, first = windows(words, rows, WORDS)
        kmer_rows = rows[first]
        kmer, kmer_rows = kmer[sampled[kmer_rows]], kmer_rows[sampled[kmer_rows]]
        _, number = repeats(kmer, kmer_rows)
        labelled = mix64(kmer + number.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
        found = samples(labelled, np.searchsorted(have, kmer_rows), len(have)).view(np.int64)
        for r, row in zip(have.tolist(), found, strict=True):
            sketch[r] = row.tolist()
    for r in np.flatnonzero((counts > 0) & (counts <= SHORT)).tolist():
        sketch[r] = sketch[r] + short_keys(words[edges[r] : edges[r + 1]])
    return sketch


def _sketch(texts: pa.Array) -> pa.Array:
    return _read(texts, True, True)


def _keyed(texts: pa.Array) -> pa.Array:
    return _read(texts, False, True)


def _worded(texts: pa.Array) -> pa.Array:
    return _read(texts, True, False)


def edits(a: list[int], b: list[int], limit: int) -> int | None:
    """Word edits (insert, delete, replace) between ``a`` and ``b``; None if over ``limit``. A few are found by the furthest reach,
    whose steps grow with their square; more by columns."""
    found = _by_reach(a, b, min(limit, REACH))
    return _by_columns(a, b, limit) if found is None and limit > REACH else found


def _by_columns(a: list[int], b: list[int], limit: int) -> int | None:
    """``edits`` column by column of the table of distances (one for each of ``b``), whose steps up and down are the bits of two numbers."""
    m, left, score = len(a), len(b), len(a)
    if abs(m - left) > limit:
        return None
    if not m:
        return left
    places: dict[int, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    mask, last = (1 << m) - 1, 1 << (m - 1)
    up, down = mask, 0
    for w in b:
        equal = places.get(w, 0)
        level = equal | down
        same = (((equal & up) + up) ^ up) | equal
        right, back = down | (mask & ~(same | up)), up & same
        if right & last:
            score += 1
        elif back & last:
            score -= 1
        left -= 1
        if score - left > limit:
            return None
        right = (right << 1 | 1) & mask
        up, down = (back << 1) & mask | (mask & ~(level | right)), right & level
    return score if score <= limit else None


def _by_reach(a: list[int], b: list[int], limit: int) -> int | None:
    """``edits`` by diagonals: those within the band that ``limit`` allows are followed, each to its furthest reach for a number of edits."""
    m, n = len(a), len(b)
    goal = n - m
    if abs(goal) > limit:
        return None
    a, b = [*a, -1], [*b, -2]  # ends that equal nothing
    far = -m - n - 2
    at = limit + 2  # the place of diagonal 0; two more on each side are never reached
    reach = [far] * (2 * at + 1)
    i = 0
    while a[i] == b[i]:
        i += 1
    reach[at] = i
    for e in range(limit + 1):
        if reach[at + goal] >= m:
            return e
        room = limit - e - 1
        lo, hi = max(-e - 1, goal - room, -m), min(e + 1, goal + room, n)
        new = [far] * (2 * at + 1)
        for k in range(lo, hi + 1):
            i, under, over = reach[at + k] + 1, reach[at + k - 1], reach[at + k + 1] + 1
            if under > i:
                i = under
            if over > i:
                i = over
            if i < 0 or i + k < 0:
                continue
            if i > m:
                i = m
            if i + k > n:
                i = n - k
            while a[i] == b[i + k]:
                i += 1
            new[at + k] = i
        reach = new
    return None


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """1 - edits / longer length of two word sequences, or 0.0 where it is below ``least``."""
    longer = max(len(a), len(b))
    if not longer:
        return 1.0
    limit = int((1 - least) * longer + 1e-9)
    if abs(len(a) - len(b)) > limit:
        return 0.0
    # each edit takes at most one word from the common ones
    values, n = np.unique(np.concatenate((a, b)), return_counts=True)
    in_a = np.bincount(np.searchsorted(values, a), minlength=len(values))
    if longer - int(np.minimum(in_a, n - in_a).sum()) > limit:
        return 0.0
    found = edits(a.tolist(), b.tolist(), limit)
    return 0.0 if found is None else 1.0 - found / longer


def _verify(a: pa.Array, b: pa.Array) -> pa.Array:
    pairs = zip(a.to_pylist(), b.to_pylist(), strict=True)
    found = [similarity(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)) for x, y in pairs]
    release_memory()
    return pa.array(found, pa.float64())


def verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The ``pairs`` (``a``, ``b``: nodes) that align, with their ``similarity``. ``words``: ``same`` (unique), ``words``.
    A centre ``a`` of more than a thousandth of the pairs is copied so that its pairs spread over tasks."""
    centres = staged(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")), "centres")
    total = centres.agg(F.sum("n")).first()[0] or 0
    centres = centres.withColumn("salts", F.floor(F.col("n") / F.lit(max(1, total // 1000))) + 1)
    salted = join_groups(pairs, centres, ["a"], "n", "inner", FEW).select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt"))
    with_b = salted.join(words.select(F.col("same").alias("b"), F.col("words").alias("words_b")), "b")
    of_a = words.select(F.col("same").alias("a"), F.col("words").alias("words_a")).join(centres.select("a", "salts"), "a")
    of_a = of_a.select("a", "words_a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    score = F.arrow_udf(_verify, "double")("words_a", "words_b")
    return with_b.join(of_a, ["a", "salt"]).select("a", "b", score.alias("similarity")).where(F.col("similarity") > 0)


def _with_centre(members: DataFrame, buckets: DataFrame) -> DataFrame:
    """``members`` with the columns of their bucket, those in none left out; each is joined once. The keys of hot buckets, HOT_SHARE at
    most, tell which members take theirs by broadcast. At most FEW buckets are broadcast as they are."""
    n, total = buckets.agg(F.count(F.lit(1)), F.sum("n")).first()
    if n <= FEW:
        return members.join(F.broadcast(buckets), "key")
    hot = F.col("key").isin([r["key"] for r in buckets.where(F.col("n") > total // HOT_SHARE).select("key").collect()])
    cold = members.where(~hot).join(buckets.where(~hot), "key")
    return members.where(hot).join(F.broadcast(buckets.where(hot)), "key").unionByName(cold)


def _bucketed(members: DataFrame) -> DataFrame:
    """Each member's bucket centre: the rows of ``members`` (``key``, ``same``, ``n_words``) with ``a`` and ``n_words_a``.
    Most keys are a node's own: keys alone are counted first, and only members whose key the filter has go on."""
    shared = staged(members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "shared-keys")
    bits = filter_bits(shared.count())
    members = staged(passes_filter(members, F.col("key"), key_filter(shared, F.col("key"), bits), "met", bits).where("met").drop("met"), "members")
    buckets = staged(
        members.groupBy("key").agg(F.min("same").alias("a"), F.min_by("n_words", "same").alias("n_words_a"), F.count(F.lit(1)).alias("n")).where("n > 1"),
        "buckets",
    )
    out = staged(_with_centre(members, buckets).where("a != same").drop("n"), "bucket-pairs")
    unstage(shared, members, buckets)
    return out


def _among(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``same`` and ``words`` of the ``rows`` of at least the ``nodes`` (``same``; staged)."""
    hashed, bits = F.xxhash64("same"), filter_bits(nodes.count())
    return passes_filter(rows.select("same", "words"), hashed, key_filter(nodes, hashed, bits), "wanted", bits).where("wanted").drop("wanted")


def _words_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``same`` and ``words`` of at least the ``nodes`` (``text_hash``: of a text of theirs; staged), each node once. Only the
    texts with such a hash are read into words, again, so that the words of the others lie on no disk."""
    text, bits = whole_text(), filter_bits(nodes.count())
    wanted = passes_filter(docs.select(text.alias("text")), F.xxhash64("text"), key_filter(nodes, F.col("text_hash"), bits), "wanted", bits).where("wanted")
    each = F.arrow_udf(_worded, "struct<same: binary, n_words: bigint, words: binary>")
    return wanted.select(each("text").alias("s")).select("s.same", "s.words").groupBy("same").agg(F.first("words").alias("words"))


def _word_pairs_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of adjacent words in the nodes (hashes that only equal pairs with equal labels share, nearly: each is
    labelled with its occurrence number in the node), their nodes' places, and how many each node has."""
    each = [np.frombuffer(x, np.uint32) for x in words.to_pylist()]
    n = np.array([max(0, len(x) - 1) for x in each], np.int64)
    rows = np.repeat(np.arange(len(each)), n)
    first = np.concatenate([*(x[:-1] for x in each), np.zeros(0, np.uint32)]).astype(np.uint64)
    second = np.concatenate([*(x[1:] for x in each), np.zeros(0, np.uint32)]).astype(np.uint64)
    pairs = mix64(first << np.uint64(32) | second)
    _, number = repeats(pairs, rows)
    return mix64(pairs + number.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)), rows, n


def _pair_lists(words: pa.Array) -> pa.Array:
    """For each node its word pairs."""
    pairs, _, n = _word_pairs_of(words)
    edges = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
    out = pa.ListArray.from_arrays(pa.array(edges), pa.array(pairs.view(np.int64)))
    release_memory()
    return out


def _rarest(words: pa.Array, levels: np.ndarray, marks: np.ndarray) -> pa.Array:
    """For each node its first word pairs by level and hash, as many as ``rare_words`` needs: how many have level 0 (of
    no use to a join), and the others in order. A pair has its slot's level if the slot is marked as its own or as shared."""
    pairs, rows, n = _word_pairs_of(words)
    at = (pairs % np.uint64(len(levels))).astype(np.int64)
    level, mark = levels[at], marks[at]
    level[(mark != 0) & (mark != (pairs >> np.uint64(56)).astype(np.uint8))] = 0
    order = np.lexsort((pairs, level, rows))
    pairs, level = pairs[order], level[order]
    first = np.concatenate(([0], np.cumsum(n)))
    taken = 2 * np.floor((n + 1) * (1 - SIMILARITY) + 1e-9).astype(np.int64) + 2
    keep = (np.arange(len(pairs)) - first[rows] < taken[rows]) & (level > 0)
    edges = np.concatenate(([0], np.cumsum(np.bincount(rows[keep], minlength=len(n))))).astype(np.int32)
    skipped = np.bincount(rows[level == 0], minlength=len(n))
    kept = pa.ListArray.from_arrays(pa.array(edges), pa.array(pairs[keep].view(np.int64)))
    release_memory()
    return pa.StructArray.from_arrays([pa.array(skipped, pa.int64()), kept], names=["skipped", "words"])


def _most(n: str):
    """Edits that the similarity allows at most where the longer text has ``n`` words."""
    return F.floor(F.col(n) * (1 - SIMILARITY) + 1e-9)


def _useful(rows: DataFrame) -> DataFrame:
    """The word pairs of ``rows`` (``word``, ``label``, ``rest``) that a node of the rest and one with another label have,
    and their ``uses``. Labels are told apart by 64 bits."""
    mark = F.xxhash64("label")
    seen = rows.groupBy("word").agg(F.min(mark).alias("least"), F.max(mark).alias("most"), F.max("rest").alias("of_rest"), F.count(F.lit(1)).alias("uses"))
    return seen.where((F.col("least") != F.col("most")) & F.col("of_rest")).select("word", "uses")


def _levels(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """For each slot a byte that grows with the uses of its word pairs (the least of them), 0 where none is of use; and the
    upper byte of its pair's hash, 0 where several pairs are there."""
    each = F.arrow_udf(_pair_lists, "array<bigint>")("words")
    useful = staged(_useful(words.select("label", "rest", F.explode(each).alias("word"))), "rest-useful")
    slots, pairs = SLOTS, useful.count()
    while slots < MOST_SLOTS and slots < 16 * pairs:
        slots *= 2
    # as unsigned numbers: slots are powers of two, so the lower bits tell
    mark = F.shiftrightunsigned("word", 56)
    level = F.least(F.lit(127), F.floor(F.log2("uses") * 4))
    table = useful.groupBy(F.col("word").bitwiseAND(F.lit(slots - 1)).cast("int").alias("slot")).agg(
        F.max(level).cast("byte").alias("level"), F.when(F.min(mark) == F.max(mark), F.min(mark)).otherwise(0).cast("short").alias("mark")
    )
    found = table.toArrow()
    unstage(useful)
    levels, marks = np.zeros(slots, np.uint8), np.zeros(slots, np.uint8)
    at = found["slot"].to_numpy()
    levels[at], marks[at] = found["level"].to_numpy(), found["mark"].to_numpy()
    return levels, marks


def rare_words(words: DataFrame) -> DataFrame:
    """The rarest pairs of adjacent words of each of the nodes ``words`` (``same``, ``words``, ``rest``, ``label``; staged)
    that a node of the ``rest`` may share with another: ``word``, its ``rank``, the ``last`` such pair before it (null for the
    first), and the node's columns. Staged.

    Of texts whose longer one has n words, of which d may be edited, n - 1 - 2d word pairs at least are common. That bound
    for a longer partner is lower by one at most, so 2d + 2 of each node's own are enough to hold a common one."""
    shared = words.sparkSession.sparkContext.broadcast(_levels(words))
    found = F.arrow_udf(lambda x: _rarest(x, *shared.value), "struct<skipped: bigint, words: array<bigint>>")("words")
    each = words.select("same", "rest", "label", (F.octet_length("words") / 4).cast("long").alias("n_words"), found.alias("found"))
    both = F.arrays_zip(F.col("found.words").alias("word"), F.concat(F.array(F.lit(None).cast("long")), F.col("found.words")).alias("last"))
    each = each.select("same", "rest", "label", "n_words", "found.skipped", F.posexplode(F.slice(both, F.lit(1), F.size("found.words"))).alias("at", "one"))
    return staged(each.select("one.word", "same", "rest", "label", "n_words", (F.col("skipped") + F.col("at") + 1).alias("rank"), "one.last"), "rest-rare")


def _between(rare: DataFrame) -> DataFrame:
    """The rows of ``rare`` (staged) whose word pair a node of the rest and one with another label have, and few others:
    a filter tells. Staged."""
    useful = staged(_useful(rare).select("word"), "rest-words")
    bits = filter_bits(useful.count())
    out = staged(passes_filter(rare, F.col("word"), key_filter(useful, F.col("word"), bits), "useful", bits).where("useful").drop("useful"), "rest-between")
    unstage(rare, useful)
    return out


def word_pairs(rare: DataFrame) -> DataFrame:
    """All pairs (``a``, ``b``) of a node of the ``rest`` and a node with another label, of the nodes whose ``rare_words``
    these are, that can have the similarity: none that has it is left out. Behind the first word pair that both hold
    (rare ones first) both still have as many as must be common. Where the rare pair before is the same in both nodes they
    have met there, with more pairs behind it. Two nodes with the same ``group`` (a column that may be missing, null: none) are left
    to ``block_links``."""
    if "group" not in rare.columns:
        rare = rare.withColumn("group", F.lit(None).cast("long"))
    other = rare.select("word", F.col("same").alias("b"), F.col("group").alias("group_b"), F.col("rest").alias("rest_b"), F.col("label").alias("label_b"), F.col("n_words").alias("n_b"), F.col("rank").alias("rank_b"), F.col("last").alias("last_b"))
    once = (F.col("label") != F.col("label_b")) & ((F.col("a") < F.col("b")) | ~F.col("rest_b"))
    once &= F.col("group").isNull() | ~F.col("group").eqNullSafe(F.col("group_b"))
    fresh = F.col("last").isNull() | F.col("last_b").isNull() | (F.col("last") != F.col("last_b"))
    pairs = rare.where("rest").withColumnRenamed("same", "a").join(other, "word").where(once & fresh).withColumn("longer", F.greatest("n_words", "n_b"))
    left = F.least(F.col("n_words") - F.col("rank"), F.col("n_b") - F.col("rank_b"))
    pairs = pairs.where(left >= F.col("longer") - 1 - 2 * _most("longer"))
    fits = F.least("n_words", "n_b") >= F.col("longer") - _most("longer")
    return pairs.where(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _split(rare: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``rare`` (staged) whose word pair at most MANY nodes have (a few of them may go with the others), and the nodes of the
    others: ``same``, ``rest``, ``label``, ``n_words``, ``found`` (those word pairs) and ``group`` (the least of them). Both staged."""
    many = staged(rare.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MANY).select("word"), "rest-many")
    bits = filter_bits(many.count())
    marked = staged(passes_filter(rare, F.col("word"), key_filter(many, F.col("word"), bits), "many", bits), "rest-split")
    nodes = marked.where("many").groupBy("same", "rest", "label", "n_words").agg(F.collect_set("word").alias("found"))
    out = staged(marked.where("NOT many").drop("many"), "rest-few"), staged(nodes.withColumn("group", F.array_min("found")), "rest-grouped")
    unstage(rare, many, marked)
    return out


def _compared(block: pa.Table) -> pa.Table:
    """The links between the nodes of two blocks (``first``: of the one, if any), or within one: of another label, one of the rest.
    Each edit takes at most one word from the common ones: these are counted for all pairs, and only those with enough are aligned."""
    first = block["first"].to_numpy()
    block = block.take(np.argsort(~first, kind="stable"))
    same, words = block["same"].to_pylist(), [np.frombuffer(x, np.uint32) for x in block["words"].to_pylist()]
    _, label = np.unique(np.array([x.hex() for x in block["label"].to_pylist()]), return_inverse=True)
    rest, n = block["rest"].to_numpy(), np.array([len(x) for x in words], np.int64)
    split = int(first.sum())
    start = split if split < len(n) else 0
    rows = np.repeat(np.arange(len(n)), n)
    each = np.concatenate(words).astype(np.uint64)
    _, token = np.unique(each << np.uint64(32) | repeats(each, rows)[1].astype(np.uint64), return_inverse=True)
    edges = np.concatenate(([0], np.cumsum(n)))
    held = np.zeros(len(token), np.int32)
    a, b, found = [], [], []
    for i in range(split if start else len(n)):
        at = np.arange(start or i + 1, len(n))
        longer = np.maximum(n[i], n[at])
        most = ((1 - SIMILARITY) * longer + 1e-9).astype(np.int64)
        at = at[(label[at] != label[i]) & (rest[at] | rest[i]) & (longer - np.minimum(n[i], n[at]) <= most)]
        if not len(at):
            continue
        held[token[edges[i] : edges[i + 1]]] = 1
        lo = at[0]
        common = np.add.reduceat(held[token[edges[lo] :]], edges[lo:-1] - edges[lo])[at - lo]
        held[token[edges[i] : edges[i + 1]]] = 0
        longer = np.maximum(n[i], n[at])
        for j in at[longer - common <= ((1 - SIMILARITY) * longer + 1e-9).astype(np.int64)].tolist():
            score = similarity(words[i], words[j])
            if score > 0:
                a.append(min(same[i], same[j]))
                b.append(max(same[i], same[j]))
                found.append(score)
    release_memory()
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "similarity": pa.array(found, pa.float64())})


def block_links(nodes: DataFrame, words: DataFrame) -> DataFrame:
    """The links (``a``, ``b``, ``similarity``) of a node of the rest and one with another label among the ``nodes`` of ``_split``: of all
    pairs with one of their frequent word pairs in common, and of others. ``words``: one row for each node at least of theirs.

    Nodes of a group (most nodes with the same passage are in one) are dealt to blocks, and each two blocks whose groups have a word pair
    in common are compared in a task: the pairs of a group are the square of its size still, but no rows. A node is copied
    for each block that its own meets."""
    size = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_NODES, F.sum("n_words") / BLOCK_WORDS)).alias("blocks")
    groups = staged(
        nodes.groupBy("group").agg(size, F.count(F.lit(1)).alias("n"), F.min("label").alias("least"), F.max("label").alias("most"), F.max("rest").alias("of_rest")),
        "rest-groups",
    )
    have = staged(nodes.select("group", F.explode("found").alias("word")).distinct(), "rest-group-words")
    meet = have.join(have.withColumnRenamed("group", "other"), "word").select("group", "other").distinct()
    other = groups.select(F.col("group").alias("other"), F.col("blocks").alias("others"), F.col("least").alias("least_o"), F.col("most").alias("most_o"), F.col("of_rest").alias("of_rest_o"))
    meet = meet.join(groups, "group").join(other, "other").where("(of_rest OR of_rest_o) AND (least != most OR least_o != most_o OR least != least_o)")
    meet = staged(meet.groupBy("group", "n", "blocks").agg(F.collect_list(F.struct("other", "others")).alias("meets")), "rest-meets")
    dealt = staged(_among(words, nodes).join(nodes.drop("found", "n_words"), "same"), "rest-dealt")
    dealt = join_groups(dealt, meet, ["group"], "n", "inner").withColumn("block", F.pmod(F.xxhash64("same"), F.col("blocks")))
    dealt = dealt.select("same", "rest", "label", "words", "group", "block", F.explode("meets").alias("with"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("with.others") - 1)).alias("at"))
    own, with_ = F.struct("group", "block"), F.struct(F.col("with.other").alias("group"), F.col("at").alias("block"))
    dealt = dealt.select("same", "rest", "label", "words", (own <= with_).alias("first"), F.least(own, with_).alias("lo"), F.greatest(own, with_).alias("hi"))
    return dealt.groupBy("lo", "hi").applyInArrow(_compared, "a binary, b binary, similarity double")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The ``pairs`` (``a``, ``b``) whose nodes the links so far leave in different classes."""
    parents, few = labels.withColumnRenamed("label", "parent"), labels.count() <= FEW
    marked = pairs.withColumns({"of_a": F.col("a"), "of_b": F.col("b")})
    if few:
        return follow(follow(marked, "of_a", parents, few), "of_b", parents, few).where("of_a != of_b").select("a", "b")
    marked = staged(marked, "pair-labels")
    for c in ("of_a", "of_b"):
        last, marked = marked, staged(follow(marked, c, parents), "pair-labels")
        unstage(last)
    return marked.where("of_a != of_b").select("a", "b")


def _aligned(candidates: DataFrame, words: DataFrame) -> DataFrame:
    """The staged ``candidates`` that are links, staged. ``words``: one row for each node at least of theirs."""
    ends = staged(candidates.select(F.col("a").alias("same")).union(candidates.select("b")).distinct(), "ends")
    out = staged(verified(candidates, _among(words, ends)), "verified")
    unstage(ends)
    return out


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``class_id``, ``class_size`` (rows), ``n_links`` (verified links of
    its text with other texts)."""
    return _classes(docs).select("doc_id", "class_id", "class_size", "n_links")


def _classes(docs: DataFrame) -> DataFrame:
    """As ``near_duplicates``, with ``text_hash``."""
    ship(docs.sparkSession)
    sketch = F.arrow_udf(_keyed, "struct<same: binary, n_words: bigint, keys: array<bigint>>")
    text = whole_text()
    rows = staged(docs.select("doc_id", F.xxhash64(text).alias("text_hash"), sketch(text).alias("s")).select("doc_id", "text_hash", "s.*"), "sketches")
    nodes = staged(
        rows.groupBy("same").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("size"), F.min("text_hash").alias("text_hash"), F.first("n_words").alias("n_words"), F.first("keys").alias("keys")),
        "nodes",
    )
    members = nodes.select("same", "n_words", F.explode("keys").alias("key")).select("key", "same", "n_words")
    pairs = _bucketed(members)
    # from here on only the words of nodes that met another are read, and of the rows their ids
    slim = staged(rows.select("doc_id", "text_hash", "same"), "slim-rows")
    few = staged(nodes.select("same", "least_id", "size", "text_hash"), "slim-nodes")
    unstage(rows, nodes)
    rows, nodes = slim, few
    met = nodes.join(pairs.select("same").union(pairs.select("a")).distinct(), "same", "left_semi")
    met = staged(met.select("text_hash"), "met-nodes")
    words = staged(_words_of(docs, met), "words")
    unstage(met)
    fits = F.least("n_words", "n_words_a") >= F.lit(SIMILARITY) * F.greatest("n_words", "n_words_a") - 1e-9
    candidates = staged(pairs.where(fits).select("a", F.col("same").alias("b")).distinct(), "candidates")
    # each node with its smallest centre first; then with the centres of other classes
    tried = staged(candidates.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "first-candidates")
    links = _aligned(tried, words)
    labels = components(links)
    others = staged(_apart(candidates.join(tried, ["a", "b"], "left_anti"), labels), "candidates")
    found = _aligned(others, words)
    links, tried = links.unionByName(found), tried.unionByName(others)
    labels = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(found.select("a", "b")))
    apart = _apart(pairs.select("a", F.col("same").alias("b")).distinct(), labels)
    unsettled = staged(pairs.join(apart.withColumnRenamed("b", "same"), ["a", "same"], "left_semi").select("key", "same"), "unsettled")
    if not unsettled.isEmpty():
        near = staged(pairs.join(unsettled.select("key").distinct(), "key", "left_semi").select("same", "a").distinct(), "near")
        ends = unsettled.select("same", F.lit(True).alias("rest"))
        for c in ("same", "a"):
            ends = ends.union(near.select(F.col(c), F.lit(False)))
        ends = ends.groupBy("same").agg(F.max("rest").alias("rest")).join(labels.withColumnRenamed("node", "same"), "same", "left")
        ends = staged(ends.withColumn("label", F.coalesce("label", "same")), "rest")
        rare, grouped = _split(_between(rare_words(staged(words.join(ends, "same"), "rest-nodes"))))
        # first each node with the smallest that has the word pair, so that large classes are whole before pairs are formed
        by_group = grouped.select(F.col("group").alias("key"), "same", "n_words")
        by_word = _bucketed(rare.select(F.col("word").alias("key"), "same", "n_words").union(by_group)).where(fits)
        pairs = by_word.select("a", F.col("same").alias("b")).distinct()
        for c in ("a", "b"):
            pairs = pairs.join(ends.select(F.col("same").alias(c), F.col("label").alias(f"label_{c}")), c)
        pairs = pairs.where("label_a != label_b").select("a", "b")
        for last in (False, True):
            if last:
                now = labels.select(F.col("node").alias("same"), "label").join(grouped.select("same", "group"), "same", "full")
                now = rare.drop("label").join(now, "same", "left")
                pairs = word_pairs(_between(staged(now.withColumn("label", F.coalesce("label", "same")), "rest-rare")))
                grouped = grouped.drop("label").join(labels.select(F.col("node").alias("same"), "label"), "same", "left")
                grouped = staged(grouped.withColumn("label", F.coalesce("label", "same")), "rest-grouped")
            candidates = staged(pairs.join(tried, ["a", "b"], "left_anti"), "candidates")
            found = _aligned(candidates, words)
            if last:
                found = staged(found.union(block_links(grouped, words)).distinct(), "verified")
            links, tried = links.unionByName(found), tried.unionByName(candidates)
            labels = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(found.select("a", "b")))
    degree = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    marked = labels.join(degree, "node").select(F.col("node").alias("same"), "label", "n_links")
    named = staged(nodes.select("same", "least_id", "size").join(marked, "same", "left").withColumn("label", F.coalesce("label", "same")), "labelled")
    classes = staged(
        named.groupBy("label").agg(F.min("least_id").alias("class_id"), F.sum("size").alias("class_size"), F.count(F.lit(1)).alias("n_nodes")), "classes"
    )
    by_node = staged(join_groups(named, classes, ["label"], "n_nodes", "inner").select("same", "size", "class_id", "class_size", F.coalesce("n_links", F.lit(0)).alias("n_links")), "by-node")
    return join_groups(rows.select("doc_id", "text_hash", "same"), by_node, ["same"], "size", "inner")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each class the row with the smallest ``doc_id``. An id
    on rows of several texts goes only where that text's row goes: what goes is told by the id and the text's hash
    (``without``). Rows of a class without any id all stay."""
    gone = _classes(docs).where(~F.col("doc_id").eqNullSafe(F.col("class_id")))
    gone = gone.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    return without(docs, staged(gone.distinct(), "near-gone"), F.xxhash64(whole_text("row.text")))
