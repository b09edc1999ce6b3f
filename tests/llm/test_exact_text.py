"""Texts that are written to collide: equality of words, lines, windows and whole texts is by their bytes."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from vesselflow.llm import order_minhash, quality_ledger, textbatch
from vesselflow.llm.textbatch import exact_ids, exact_windows

ROW = "doc_id bigint, text string"


def thue_morse(n):
    """A word of a and b, and its mirror image, whose sums of powers of any odd base agree modulo 2^64."""
    bits = [k.bit_count() & 1 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


A, B = thue_morse(1024)


def test_the_texts_collide_where_sums_decide():
    buf = np.frombuffer((A + B).encode(), np.uint8)
    at = np.array([0, 1024, 2048])
    x, y = textbatch.Hasher(buf)(at[:-1], at[1:])
    assert x == y and A != B
    assert len(set(textbatch.SpanHasher(buf)(at[:-1], at[1:]).tolist())) == 2


def test_lines_and_words_that_collide_are_not_repeats(spark):
    rows = spark.createDataFrame([(1, f"{A}\n{B}"), (2, f"{A}\n{A}"), (3, f"{A} {B} " * 4 + f"{B} {A} " * 4)], ROW)
    got = {r.doc_id: r for r in quality_ledger.ledger(rows).collect()}
    assert [got[k].n_dup_lines for k in (1, 2, 3)] == [0, 1, 0]
    assert [got[k].n_stutters for k in (1, 2, 3)] == [0, 1, 1]
    assert got[3].n_repeat_words == 0


def test_unlike_texts_that_collide_are_two_classes(spark):
    rows = [(1, " ".join(A)), (2, " ".join(B)), (3, f"one {A} two"), (4, f"one {B} two"), (5, f"one {A} two")]
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(spark.createDataFrame(rows, ROW)).collect()}
    # the letters of 1 and 2 differ in every place, though they are nearly each other's shift
    assert got[3] == got[5] == 3 and got[4] == 4
    assert got[2] == (1 if order_minhash.similarity(np.frombuffer(A.encode(), np.uint8), np.frombuffer(B.encode(), np.uint8)) else 2)
    left = order_minhash.drop_near_duplicates(spark.createDataFrame(rows[2:], ROW))
    assert sorted(r.doc_id for r in left.collect()) == [3, 4]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["", "a", "b", "ab", "ba", "abababab", "babababa", A[:64], B[:64]]), max_size=30))
def test_exact_ids_and_windows(words):
    buf = np.frombuffer("".join(words).encode(), np.uint8)
    at = np.cumsum([0, *map(len, words)])
    ids = exact_ids(buf, at[:-1], at[1:])
    assert all((x == y) == (a == b) for x, a in zip(words, ids) for y, b in zip(words, ids))
    rows = np.arange(len(words)) // 11
    for size in (1, 3, 8):
        keys, first = exact_windows(ids, rows, size)
        want = [k for k in range(len(words) - size + 1) if rows[k] == rows[k + size - 1]]
        assert first.tolist() == want
        grams = [tuple(words[k : k + size]) for k in want]
        assert all((x == y) == (a == b) for x, a in zip(grams, keys) for y, b in zip(grams, keys))


def test_hashes_that_collide_are_told_apart(monkeypatch):
    real = textbatch.xxh64
    monkeypatch.setattr(textbatch, "xxh64", lambda buf, s, e, seed=0: real(buf, s, e, seed) % np.uint64(2 if seed < 3 else 1 << 60))
    buf = np.frombuffer(b"aabbccaa", np.uint8)
    at = np.arange(0, 9, 2)
    ids = textbatch.exact_ids(buf, at[:-1], at[1:]).tolist()
    assert ids[0] == ids[3] and len(set(ids)) == 3


def test_empty_texts_have_no_ids():
    none = np.zeros(0, np.int64)
    assert len(exact_ids(np.zeros(0, np.uint8), none, none)) == 0
    assert quality_ledger._measure(pa.array([None, "", " "], pa.string())).field("n_words").to_pylist() == [0, 0, 0]
