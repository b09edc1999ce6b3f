"""Source divergence audit, SimHash near-duplicates and hard negatives, against brute force and awkward tables."""

import collections
import random
import re
import sys

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vesselflow.llm import bond_scan, pivot_simhash, term_pointers
from vesselflow.llm.queries import REGISTRY
from vesselflow.llm import textbatch
from vesselflow.llm.stage import staged
from vesselflow.llm.textbatch import spans, utf8

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n bigint, fp string, term string, value int, label int, docs string"
EXTRA = (9, "x", "y", 7, 3, "z")
LONG = "Lorem ipsum dolor sit amet " * 20_000
ROWS = [
    (1, None, None, None, *EXTRA),
    (2, "", "en", "a", *EXTRA),
    (3, LONG, "en", "a", *EXTRA),
    (4, LONG, "en", "a", *EXTRA),
    (4, LONG, "en", "b", *EXTRA),
    (None, "no id lorem ipsum", "en", "b", *EXTRA),
    (6, "É́ 漢字 🎉 LOREM ipsum \x1c\x85 İSTANBUL ς\r\n\tLorem", "en", "c", *EXTRA),
    (7, "one two", None, "c", *EXTRA),
    (8, "ONE\ntwo ", None, "d", *EXTRA),
    (9, "one two", None, "", *EXTRA),
    (10, "z" * 300_000 + " one", "de", "a", *EXTRA),
    (11, "7 8 9 !", "fr", "a", *EXTRA),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- op11 ---------------------------------------------------------------------
@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abABcdefgh é漢-"), max_size=40), max_size=6))
def test_pointers_are_sorted_by_term(texts):
    buf, at = utf8(pa.array(texts, pa.string()))
    buf = term_pointers.LOWER[buf]
    starts, ends, _ = spans(buf, at, ~term_pointers.IN_TERM)
    order, run = term_pointers.sort_pointers(buf, starts, ends)
    terms = [buf[starts[k] : ends[k]].tobytes() for k in order]
    assert terms == sorted(terms) and sorted(order) == list(range(len(starts)))
    ranks = {t: k for k, t in enumerate(sorted(set(terms)))}
    assert run.tolist() == [ranks[t] for t in terms]


def brute_audit(rows, min_docs=3, top=200):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))) for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = collections.Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t in df if df[t] >= min_docs)
        count = {s: collections.Counter(t for d in own if d[1] == s for t in d[2]) for s in {d[1] for d in own}}
        total = sum(count.values(), collections.Counter())

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        q = shares(total)
        for s, c in count.items():
            p = shares(c)
            f = lambda t, q: (p[t] - q[t]) ** 2 // q[t]  # noqa: B023, E731
            pairs = [(-sum(f(t, o) for t in kept), x) for x in count if x != s for o in [shares(count[x])]]
            terms = sorted((-f(t, q), t.encode()) for t in kept if c[t] and p[t] > q[t])[:top]
            out |= {(lang, s, "pair", x, -v, k + 1) for k, (v, x) in enumerate(sorted(pairs, key=lambda y: (y[0], y[1].encode())))}
            out |= {(lang, s, "term", x.decode(), -v, k + 1) for k, (v, x) in enumerate(terms)}
    return out


def audited(docs, **kw):
    rows = term_pointers.audit(docs, **kw).collect()
    assert len(set(rows)) == len(rows)
    return {tuple(r) for r in rows}


def test_audit_of_awkward_rows(spark, odd, empty, monkeypatch):
    rows = [(r[1], r[2], r[3]) for r in ROWS]
    want = brute_audit(rows)
    assert {x[2] for x in want} == {"pair", "term"}
    assert audited(odd) == want
    assert audited(odd.repartition(5)) == want
    assert audited(empty) == set()
    assert audited(odd.where("doc_id = 11")) == set()
    assert audited(odd, min_docs=1, top_terms=2) == brute_audit(rows, 1, 2)
    monkeypatch.setattr(term_pointers, "CELLS", 3)
    monkeypatch.setattr(term_pointers, "TILE", 1)
    assert audited(odd) == want


def test_audit_of_documents_in_small_shards(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text", "lang", "source")
    rows = [tuple(r) for r in docs.collect()]
    assert audited(docs.repartition(7)) == brute_audit(rows)


def test_shards_add_up():
    table = pa.table({"lang": ["en", "en", "de"], "source": ["a", "b", "a"], "text": ["x y x", "X", "x"]})
    whole = [b.to_pylist() for b in term_pointers._count(iter(table.to_batches()))]
    rows = sorted(tuple(r.values()) for b in whole for r in b if r["term"])
    assert rows == [("de", "a", "x", 1, 1), ("en", "a", "x", 2, 1), ("en", "a", "y", 1, 1), ("en", "b", "x", 1, 1)]
    assert sorted((r["lang"], r["source"]) for b in whole for r in b if r["term"] is None) == [("de", "a"), ("en", "a"), ("en", "b")]
    assert list(term_pointers._count(iter(table.slice(0, 0).to_batches()))) == []


# --- op12 ---------------------------------------------------------------------
@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=100), max_size=8))
def test_xxh64(items):
    buf = np.frombuffer(b"".join(items), np.uint8)
    at = np.cumsum([0, *map(len, items)])
    for seed in (0, 42):
        assert textbatch.xxh64(buf, at[:-1], at[1:], seed).tolist() == [xxhash.xxh64_intdigest(x, seed=seed) for x in items]


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]).encode(), seed=42) for k in range(max(len(words) - 2, 1))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aBc é漢 \n\t"), max_size=30) | st.none(), max_size=6))
def test_fingerprints(texts):
    got = pivot_simhash.fingerprints(pa.array(texts, pa.string())).to_numpy().view(np.uint64)
    assert got.tolist() == [brute_fingerprint(t) for t in texts]


def brute_components(fps):
    """The smallest fingerprint that links lead to."""
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in root:
        for b in root:
            if (a ^ b).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {x: find(x) for x in root}


def near_fps(n, seed, flips=3):
    """Chains of fingerprints with up to ``flips`` bits changed, and strangers."""
    draw = random.Random(seed)
    out = {0, (1 << 64) - 1}
    while len(out) < n:
        out.add(draw.getrandbits(64) if draw.random() < 0.3 else draw.choice(sorted(out)) ^ sum(1 << b for b in draw.sample(range(64), draw.randint(1, flips + 1))))
    return sorted(out)


@pytest.mark.parametrize("sizes", [[0, 1, 5, 64, 2], [65, 3, 300], [400]])
def test_spanning_links(sizes):
    fps = [x for k, n in enumerate(sizes) for x in (near_fps(n, k) if n > 1 else range(n))]
    _, wide = pivot_simhash.references()
    table = np.array([[(x ^ w).bit_count() for w in wide] for x in fps], np.int8)
    i, j = pivot_simhash.spanning_links(np.array(fps, np.uint64), table, np.array(sizes))
    at = np.cumsum([0, *sizes])
    for lo, hi in zip(at, at[1:]):
        own = [(a, b) for a, b in zip(i, j) if lo <= a < hi]
        assert all(lo <= b < hi for _, b in own)
        root = pivot_simhash.hook(np.arange(hi), np.array([a for a, _ in own], int), np.array([b for _, b in own], int))
        want = brute_components(fps[lo:hi])
        for a in range(lo, hi):
            for b in range(lo, a):
                assert (root[a] == root[b]) == (want[fps[a]] == want[fps[b]])


@pytest.mark.parametrize("chunk", [8192, 20])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, chunk):
    monkeypatch.setattr(pivot_simhash, "CHUNK", chunk)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    fps = sorted({*near_fps(300, 7), *(k << 40 for k in range(1 << 9))})
    rows = pivot_simhash.links(spark.createDataFrame([(signed(x),) for x in fps], "fp bigint")).collect()
    unsigned = lambda x: x % (1 << 64)
    assert all((unsigned(r.a) ^ unsigned(r.b)).bit_count() for r in rows)
    place = {x: k for k, x in enumerate(fps)}
    root = pivot_simhash.hook(np.arange(len(fps)), *(np.array([place[unsigned(r[k])] for r in rows]) for k in range(2)))
    want = brute_components(fps)
    assert {(fps[k], fps[r]) for k, r in enumerate(root)} == set(want.items())


def test_simhash_of_awkward_rows(spark, odd, empty):
    rows = pivot_simhash.near_duplicates(odd).collect()
    fps = [brute_fingerprint(r[1]) for r in ROWS]
    want = brute_components(fps)
    ids = collections.defaultdict(list)
    for r, x in zip(ROWS, fps):
        ids[want[x]].append(r[0])
    expected = sorted((str(r[0]), f"{x:016x}", min(i for i in ids[want[x]] if i is not None), len(ids[want[x]])) for r, x in zip(ROWS, fps) if any(i is not None for i in ids[want[x]]))
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id, r.component_size) for r in rows if r.component_id is not None)
    assert got == expected and len(rows) == len(ROWS)
    assert [r.doc_id for r in rows if r.component_id is None] == [None]
    assert pivot_simhash.near_duplicates(empty).collect() == []


def test_simhash_query_against_all_pairs(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    want = brute_components(set(fps.values()))
    first = {}
    for i in sorted(fps, reverse=True):
        first[want[fps[i]]] = i
    rows = REGISTRY["op12_pivot_simhash"](spark, SF_SMALL).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{x:016x}", first[want[x]]) for i, x in fps.items()}
    assert len(rows) == len(fps)


# --- op13 ---------------------------------------------------------------------
VECTORS = "vec_id bigint, embedding array<float>, label int, row int, score string, windows int, shard int"


def brute_negatives(rows, is_anchor):
    """Rows as (id, label, integer components)."""
    out = []
    width = max((len(v) for _, _, v in rows), default=0)
    vectors = np.array([[*v, *[0] * (width - len(v))] for _, _, v in rows], dtype=object).reshape(len(rows), width)
    for a, (i, label, _) in enumerate(rows):
        if not is_anchor(i):
            continue
        score = [sum(int(x) * int(y) for x, y in zip(vectors[a], vectors[b])) for b in range(len(rows))]
        order = sorted(range(len(rows)), key=lambda b: (-score[b], rows[b][0], b))
        positives = [b for b in order if b != a and rows[b][1] == label][:5]
        for p in positives:
            negatives = [b for b in order if rows[b][1] != label and 50 * score[p] <= 100 * score[b] <= 95 * score[p]][:3]
            out += [(i, rows[p][0], k + 1, rows[b][0], score[p], score[b]) for k, b in enumerate(negatives)]
    return sorted(out)


def mined(table, is_anchor):
    return sorted(tuple(r) for r in bond_scan.hard_negatives(bond_scan.participants(table), is_anchor).collect())


@pytest.mark.parametrize("block", [4096, 7])
def test_hard_negatives_of_awkward_rows(spark, monkeypatch, block):
    monkeypatch.setattr(bond_scan, "BLOCK", block)
    monkeypatch.setattr(bond_scan, "ANCHOR_BLOCK", 3)
    draw = random.Random(3)
    extra = (1, "x", 2, 3)
    vectors = [[draw.gauss(0.3, 0.4) for _ in range(draw.choice([5, 12, 12, 12]))] for _ in range(60)]
    rows = [(k, v, draw.randrange(3), *extra) for k, v in enumerate(vectors)]
    rows += [(100 + k, vectors[1], k % 2, *extra) for k in range(20)] + [rows[1], rows[1], (200, [], 1, *extra), (201, [0.0] * 12, 1, *extra)]
    bad = [(202, None, 1, *extra), (203, [1.0, None], 1, *extra), (204, [float("nan")], 1, *extra), (205, [float("-inf"), 1.0], 1, *extra), (206, vectors[0], None, *extra), (None, vectors[0], 1, *extra)]
    quantised = [(i, label, [int(np.floor(256.0 * float(np.float32(x)))) for x in v]) for i, v, label, *_ in rows]
    table = spark.createDataFrame(rows[:40] + bad + rows[40:], VECTORS).coalesce(1)
    want = brute_negatives(quantised, lambda i: i % 4 == 1)
    assert len(want) > 100
    assert mined(table, F.col("vec_id") % 4 == 1) == want
    assert mined(table.repartition(4).where("vec_id < 60"), F.col("vec_id") % 4 == 0) == brute_negatives([q for q in quantised if q[0] < 60], lambda i: i % 4 == 0)
    assert mined(table.where("vec_id >= 202"), F.lit(True)) == []
    assert mined(table.where("vec_id = 200"), F.lit(True)) == []
    assert mined(spark.createDataFrame([], VECTORS), F.lit(True)) == []


@pytest.mark.parametrize("scale", [1, 1000, 100_000])  # numbers that single and double precision hold, and others
def test_hard_negatives_over_many_blocks(spark, monkeypatch, scale):
    monkeypatch.setattr(bond_scan, "BLOCK", 400)
    monkeypatch.setattr(bond_scan, "ANCHOR_BLOCK", 10)
    monkeypatch.setattr(bond_scan, "ANCHOR_PART", 2)
    draw = random.Random(4)
    vectors = [[scale * draw.gauss(0.1, 0.3) for _ in range(8)] for _ in range(1000)]
    vectors += [vectors[k % 3] for k in range(400)]
    rows = [(k, v, draw.choice([-1, 2, 2, 3]), 1, "x", 2, 3) for k, v in enumerate(vectors)]
    quantised = [(i, label, [int(np.floor(256.0 * float(np.float32(x)))) for x in v]) for i, v, label, *_ in rows]
    want = brute_negatives(quantised, lambda i: i % 40 == 0)
    assert len(want) > 200
    assert mined(spark.createDataFrame(rows, VECTORS).repartition(2), F.col("vec_id") % 40 == 0) == want


def test_large_scores_of_other_labels_are_refused(spark):
    rows = [(k, [x], k, 1, "x", 2, 3) for k, x in enumerate([2.0, 1e16])]
    with pytest.raises(PythonException, match="must fit a long"):
        mined(spark.createDataFrame(rows, VECTORS), F.col("vec_id") == 0)


def test_blocks_meet_without_the_driver(spark):
    """However small Spark takes the tables for: a row of anchors goes beside each of the blocks."""
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"
    vectors = [(k, [0.1] * 12, k % 3, 1, "x", 2, 3) for k in range(60)]
    rows = bond_scan.participants(spark.createDataFrame(vectors, VECTORS))
    blocks, anchors = (staged(rows.mapInArrow(bond_scan._packed(n), bond_scan._BLOCK_TYPE), "test") for n in (7, 3))
    cells = bond_scan.cells(anchors, blocks)
    for met in (cells, bond_scan.hard_negatives(rows, F.lit(True))):
        assert "Broadcast" not in met._jdf.queryExecution().executedPlan().toString()
    assert cells.select("a_rows", "rows").distinct().count() == cells.count() == anchors.count() * blocks.count()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(-300, 300), min_size=9, max_size=9), min_size=1, max_size=30), st.integers(0, 29), st.integers(-50_000, 200_000))
def test_scan_keeps_the_best_and_the_windows(vectors, query, positive):
    matrix = np.array(vectors, np.int64).T
    query %= len(vectors)
    block = bond_scan.VerticalBlock(matrix, matrix)
    score = matrix.T @ matrix[:, query]
    alive, exact = block.scan(query, np.arange(len(vectors)), bond_scan.best(5))
    assert (exact == score[alive]).all()
    assert sorted(exact, reverse=True)[:5] == sorted(score, reverse=True)[:5]
    lo, hi = bond_scan.window(positive)
    alive, exact = block.scan(query, np.arange(len(vectors)), bond_scan.best_in([(lo, hi)], 3))
    assert (exact == score[alive]).all()
    assert sorted(exact[(exact >= lo) & (exact <= hi)])[-3:] == sorted(s for s in score if 50 * positive <= 100 * s <= 95 * positive)[-3:]


def test_large_components_are_exact_or_refused():
    big = np.array([[2**28 + 1], [1]], np.int64)
    alive, score = bond_scan.VerticalBlock(big, big).scan(0, np.arange(1), bond_scan.best(5))
    assert score.tolist() == [(2**28 + 1) ** 2 + 1]
    with pytest.raises(OverflowError):
        bond_scan.VerticalBlock(big * 2**4, big * 2**4)


def test_modules_are_found():
    assert {"op11_source_divergence", "op12_pivot_simhash", "op13_hard_negatives"} <= set(REGISTRY) and "vesselflow.llm.bond_scan" in sys.modules
