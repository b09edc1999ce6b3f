"""The training-data operators against SQL, brute force, round trips, and awkward tables."""

import collections
import hashlib
import os
import random
import re
import sys
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as E
import corpus_pipeline
from oracle_check import duck, rows_of
from vesselflow.llm import components, exact_dedup, licenses, line_runs, order_minhash, packing, quality_ledger, token_counts, token_files, toxicity, viterbi
from vesselflow.llm.queries import ORACLE_SQL, PIECES, REGISTRY, WORD_BPE
from vesselflow.llm.stage import join_groups, key_filter, passes_filter, stage_path
from vesselflow.llm.textbatch import Hasher, spans, utf8
from vesselflow.llm.word_ids import word_ids

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_tokens string, kept string, `group` int"
LONG = "lorem ipsum dolor sit amet " * 20_000
LINE = "this line is long enough to be a key of its own, surely"
ROWS = [
    (1, None, None, None, None, "x", "y", 1),
    (2, "", "en", "a", 0, None, None, None),
    (3, LONG, "en", "a", 1, "x", "y", 1),
    (4, LONG, "en", "a", 1, "x", "y", 1),
    (4, LONG, "en", "a", 1, "x", "y", 1),
    (5, "Some Text, some TEXT\n\n  \n" + LINE, "en", "b", 1, "x", "y", 1),
    (6, "some text, some text\n\n  \n" + LINE, None, "b", 1, "x", "y", 1),
    (None, "no id here\n" + LINE, "en", "b", 1, "x", "y", 1),
    (7, "é́ 漢字 🎉 <|endoftext|> ▁ \x1c\x85 İSTANBUL ς\r\n\t" + LINE, "en", "b", 1, "x", "y", 1),
    (8, LINE + "\n " + LINE.upper() + "\t\n" + "z" * 5000, "en", "b", 1, "x", "y", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas()


def result(spark, name):
    return REGISTRY[name](spark, SF_SMALL).toPandas()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    assert rows_of(REGISTRY[name](spark, SF_SMALL).toPandas()) == rows_of(duck(SF_SMALL).execute(ORACLE_SQL[name]).df())


def test_every_operator_and_the_pipeline_are_registered():
    assert {int(n[2:].split("_")[0]) for n in REGISTRY} == set(range(1, 14))
    assert set(REGISTRY) | {"pipeline"} <= set(E.queries())


# --- helpers ---------------------------------------------------------------------
def test_join_groups_and_filter_lose_nothing(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 700).alias("k"), "id")
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    want = rows.join(groups, "k").select("k", "id", "n", "top")
    assert sorted(join_groups(rows, groups, ["k"], "n").select("k", "id", "n", "top").collect()) == sorted(want.collect())
    some = rows.where("k % 7 = 3").select("k").distinct()
    marked = passes_filter(rows, F.xxhash64("k"), key_filter(some, F.xxhash64("k")), "maybe")
    assert marked.count() == 5000
    assert marked.where("k % 7 = 3 and not maybe").count() == 0
    assert marked.where("k % 7 <> 3 and maybe").count() < 100


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=20), max_size=6))
def test_spans_and_hashes(texts):
    buf, at = utf8(pa.array(texts, pa.string()))
    blank = quality_ledger.BLANK
    starts, ends, rows = spans(buf, at, blank)
    raw = buf.tobytes()
    want = [(r, w) for r, t in enumerate(texts) for w in re.findall(rb"[^\x20\x09-\x0d]+", t.encode())]
    assert [(r, raw[a:b]) for a, b, r in zip(starts, ends, rows)] == want
    by = collections.defaultdict(set)
    for (_, w), h in zip(want, Hasher(buf)(starts, ends).tolist()):
        by[w].add(h)
    assert all(len(x) == 1 for x in by.values())
    assert len({next(iter(x)) for x in by.values()}) == len(by)


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + k, 101 + k) for k in range(20)] + [(200, 300 + k) for k in range(30)]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    assert got == {x: root(x) for x in list(parent)}


# --- 1, 2: pieces ------------------------------------------------------------------
@pytest.fixture(scope="module")
def encoder():
    return viterbi.encoder(PIECES)


def test_viterbi_is_the_best_segmentation(encoder):
    score = dict(zip(encoder.model.pieces, encoder.model.scores))
    pieces = {encoder.model.pieces[k].replace("▁", " ") for k in encoder.model.normal}

    def best(word):
        top = [0.0] + [-1e18] * len(word)
        for j in range(1, len(word) + 1):
            for i in range(max(0, j - 16), j):
                if word[i:j] in pieces:
                    top[j] = max(top[j], top[i] + score[word[i:j].replace(" ", "▁")])
            if word[j - 1] not in pieces:
                top[j] = max(top[j], top[j - 1] + encoder.unknown)
        return top[-1]

    rng = random.Random(1)
    words = [" " + "".join(rng.choice("theranding ofé漢🎉.,") for _ in range(rng.randint(0, 14))) for _ in range(400)]
    ids, scores = encoder.solve([w.encode() for w in words])
    assert scores.tolist() == [best(w) for w in words]
    assert all(encoder.decode(np.frombuffer(i, encoder.dtype).tolist()) == w[1:] for w, i in zip(words, ids))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_pieces_round_trip(text):
    e = viterbi.encoder(PIECES)
    assert e.decode(np.frombuffer(e.encode([text])[0], e.dtype).tolist()) == text.replace("▁", " ")


def test_encode_then_decode_columns(spark, odd):
    rows = viterbi.decode(viterbi.encode(odd, PIECES), PIECES).select("text", "decoded", "piece_ids").collect()
    assert all(r["decoded"] == (r["text"] or "").replace("▁", " ") for r in rows)


def test_token_counts_are_the_librarys(spark, small, odd, empty):
    library = token_counts.lengths(PIECES).model.library
    got = result(spark, "op2_token_counts").sort_values("doc_id")
    small = small.sort_values("doc_id")
    assert got["n_tokens"].tolist() == [len(library.encode(t or "")) for t in small["text"]]
    rows = token_counts.with_counts(odd, PIECES, "count").select("text", "count", "n_tokens").collect()
    assert [r["count"] for r in rows] == [len(library.encode(r["text"] or "")) for r in rows]
    assert token_counts.with_counts(empty, PIECES, "count").count() == 0


# --- 3: licences ------------------------------------------------------------------
def test_licence_lines_are_found_and_only_they(spark, small):
    got = result(spark, "op3_license_scan").set_index("doc_id")
    named = {"gpl-3.0": "GNU General Public License, version 3", "cc-by-nc": "CC BY-NC 4.0", "mit": "MIT License", "apache-2.0": "Apache License, Version 2.0"}
    for doc, text in zip(small["doc_id"], small["text"]):
        want = sorted(k for k, words in named.items() if words in (text or ""))
        assert [x for x in got.loc[doc, "families"].split(",") if x] == want
    talk = small.set_index("doc_id")["text"].fillna("").str.contains("All rights reserved", regex=False)
    assert (got["n_unknown"] > 0)[talk[talk].index].all()
    assert (got["n_unknown"] > 0)[talk[~talk].index].mean() < 0.01


def test_licence_scan_of_awkward_rows(spark, odd, empty):
    model = licenses.train(odd)
    assert licenses.scan(odd, model).where("n_known > 0").count() == 0
    assert licenses.scan(empty, model).count() == 0
    docs = spark.createDataFrame([(1, "x\nReleased under the MIT License.\ny"), (2, "Licensed under the Frobozz Magic License")], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in licenses.scan(docs, model).collect()}
    assert got[1]["families"] == ["mit"]
    assert got[2]["families"] == []


def test_classifier_names_every_wording_in_corpus_text(spark, small):
    model = licenses.train(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    around = [x for x in "\n".join(small["text"].fillna("")).split("\n") if 60 < len(x) < 200]
    each = [(family, text) for family, texts in licenses.TEMPLATES.items() for text in texts]
    rows = [(n, f"{around[2 * n]}\n\n{text}\n\n{around[2 * n + 1]}") for n, (_, text) in enumerate(each)]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()}
    named = [family in got[n]["families"] for n, (family, _) in enumerate(each)]
    assert np.mean(named) >= 0.95, [x for x, ok in zip(each, named, strict=True) if not ok]
    assert sum(got[n]["n_known"] for n in got) <= len(each) + 1


def test_training_takes_whole_lines_within_its_bounds(spark, monkeypatch):
    lines = ["ü" * 3000, "word " * 100, "x" * 40_000]
    drawn = []
    monkeypatch.setattr(licenses, "fit", lambda some: drawn.extend(some))
    licenses.train(spark.createDataFrame([(1, "\n".join(lines))], "doc_id bigint, text string"))
    assert sorted(drawn) == sorted(lines[:2])


WRAPPED = {
    "gpl-3.0": """/* This program is free software: you can redistribute it and/or modify it
 * under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 */""",
    "gpl-2.0": """# This program is free software; you can redistribute it and/or modify it
# under the terms of the GNU General Public License as published by
# the Free Software Foundation; either version 2 of the License, or
# (at your option) any later version.""",
    "bsd": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction""",
}


def test_wrapped_licence_paragraphs_are_found_whole(spark, small):
    model = licenses.train(spark.createDataFrame(small[["doc_id", "text"]], "doc_id bigint, text string"))
    filler = "\n".join(["some line of other words here"] * 3)
    rows, want = [], {}
    for family, text in WRAPPED.items():
        for form in (text, text.replace("\n", " "), f"{filler}\n{text}\n{filler}", f"{filler}\n\n{text}\n\n{filler}", f"{'other words ' * 100}{text} {'other words ' * 100}"):
            want[len(rows)] = [family]
            rows.append((len(rows), form))
    want[len(rows)] = sorted(WRAPPED)
    rows.append((len(rows), "\n\n".join(WRAPPED.values())))
    want[len(rows)] = ["isc"]
    rows.append((len(rows), f"{WRAPPED['isc']}\n{WRAPPED['isc']}"))
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()}
    assert {k: r["families"] for k, r in got.items()} == want
    assert all(r["n_known"] == len(want[k]) for k, r in got.items())


# --- 4, 6: exact copies and lines ------------------------------------------------------
def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_exact_copies_of_awkward_rows(spark, odd, empty):
    got = sorted((r["doc_id"] or 0, r["keep_id"] or 0, r["group_size"], r["kept"]) for r in exact_dedup.exact_copies(odd).collect())
    groups = collections.defaultdict(list)
    for r in ROWS:
        groups[fold(r[1])].append(r[0] or 0)
    want = sorted((d, max(g), len(g), d == max(g)) for g in groups.values() for d in g)
    assert got == want
    assert exact_dedup.exact_copies(empty).count() == 0
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted(d for d, top, _, _ in want if d == top)


def brute_lines(rows, min_docs):
    keys = collections.defaultdict(list)
    split = [(d, (t or "").split("\n")) for d, t in rows]
    key = lambda line: fold(line.strip(" \t\n\x0b\x0c\r"))
    for n, (d, lines) in enumerate(split):
        for k in {key(x) for x in lines if len(key(x)) >= 40}:
            keys[k].append((d if d is not None else -1, "" if d is not None else lines))
    keys = {k: [d for n, (d, own) in enumerate(v) if (d, own) not in v[:n]] for k, v in keys.items()}
    hot = {k: max(v) for k, v in keys.items() if len(v) >= min_docs}
    out = []
    for d, lines in split:
        stay = [x for x in lines if key(x) not in hot or hot[key(x)] == (d if d is not None else -1)]
        out.append((d or 0, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out)


@pytest.mark.parametrize("fanout", [2, 5])
def test_line_runs_in_batches(spark, odd, empty, fanout):
    batches = [odd.where("doc_id <= 3"), odd.where("doc_id > 3 and doc_id <= 6"), empty, odd.where("doc_id > 6"), odd.where("doc_id is null")]
    got = line_runs.dedup_lines(odd, batches, min_docs=3, fanout=fanout)
    assert sorted((r["doc_id"] or 0, r["n_lines"], r["n_dropped"], r["kept"]) for r in got.collect()) == brute_lines([r[:2] for r in ROWS], 3)
    assert line_runs.dedup_lines(empty, [empty]).count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("llm_line_run")]


def test_line_dedup_of_repeated_ids_equals_sql(spark):
    rows = [(d, f"{LINE}\nalone {d} {n}") for n, d in enumerate((1, 1, 2, 3, 4))] + [(d, LINE * 2) for d in (1, 1, 5, 6, 7, 8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.execute(ORACLE_SQL["op6_line_dedup"]).df()
    batches = line_runs.input_batches(docs)
    assert len(batches) > 1 and sum(b.count() for b in batches) == len(rows)
    got = line_runs.dedup_lines(docs, batches, fanout=2).toPandas()
    by_id = got.groupby("doc_id")[["n_lines", "n_dropped"]].sum()
    assert by_id.to_dict() == want.set_index("doc_id")[["n_lines", "n_dropped"]].to_dict()
    assert by_id["n_dropped"].sum() == 5  # the second line, in documents 1 (two rows), 5, 6, 7


def test_runs_hold_each_key_once_and_compact(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    batches = line_runs.input_batches(docs)
    assert len(batches) == line_runs.BATCHES
    assert sorted(r[0] for b in batches for r in b.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())
    runs = line_runs.LineRuns(spark)
    for batch in batches:
        runs.add(batch)
        runs.compact()
    assert [len(x) for x in runs.levels] == [1, 1] and runs.increments[1]
    keys = [r["key"] for x in runs.names() for r in spark.table(x).select("key").collect()]
    assert len(keys) == len(set(keys))
    whole = line_runs.LineRuns(spark).counts_of(docs)
    assert sorted(map(tuple, runs.frequent(1).collect())) == sorted(map(tuple, whole.collect()))
    assert "Exchange" not in runs.frequent(1)._jdf.queryExecution().executedPlan().toString()
    runs.close()


def test_anti_join_gives_new_lines_only(spark):
    lines = [f"{k} {LINE}" for k in range(6)]
    docs = lambda first, some: spark.createDataFrame([(first, "\n".join(some))], "doc_id bigint, text string")
    runs = line_runs.LineRuns(spark, fanout=2)
    counts = []
    for first, some in ((1, lines[:3]), (2, lines[2:5]), (3, lines[:6])):
        counts.append(runs.add(docs(first, some)).count())
        runs.compact()
    assert counts == [3, 2, 1]
    assert {r["n_docs"] for r in runs.frequent(1).collect()} == {1, 2, 3}
    runs.close()


# --- 5: near copies ---------------------------------------------------------------
def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=9), st.lists(st.integers(0, 3), max_size=9), st.integers(0, 9))
def test_banded_alignment(a, b, limit):
    d = levenshtein(a, b)
    assert order_minhash.edits(a, b, limit) == (d if d <= limit else None)


def test_near_copies_are_grouped_and_others_are_not(spark, odd, empty):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    docs, group = [], {}
    for k in range(30):
        base = [word() for _ in range(rng.choice([60, 300, 900]))]
        for c in range(rng.choice([1, 3, 12])):
            text = base[:]
            for _ in range(len(base) // 30 if c else 0):
                text[rng.randrange(len(text))] = word()
            group[len(docs)] = k
            docs.append((len(docs), " ".join(text)))
    shared = " ".join(word() for _ in range(100))  # a common passage is no near copy
    for k in range(40):
        group[len(docs)] = 1000 + k
        docs.append((len(docs), shared + " " + " ".join(word() for _ in range(100))))
    got = order_minhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    first = {}
    for d, g in sorted(group.items()):
        first.setdefault(g, d)
    assert {r["doc_id"]: r["class_id"] for r in got} == {d: first[g] for d, g in group.items()}
    rows = order_minhash.near_duplicates(odd).collect()
    assert len(rows) == len(ROWS)
    assert sorted((r["doc_id"], r["class_id"]) for r in rows if r["doc_id"] in (1, 2, 3, 4, 5, 6)) == [(1, 1), (2, 1), (3, 3), (4, 3), (4, 3), (5, 5), (6, 5)]
    assert order_minhash.near_duplicates(empty).count() == 0
    assert order_minhash.drop_near_duplicates(odd).columns == odd.columns


def test_word_pairs_lose_no_similar_pair_of_the_rest(spark):
    rng = random.Random(8)
    texts = []
    for n in (1, 4, 5, 9, 10, 30, 60, 60):
        base = [rng.randrange(12) if n < 60 else rng.randrange(90) for _ in range(n)]
        for edits in (0, n // 10, n // 5, n // 4):
            for _ in range(3):
                text = list(base)
                for _ in range(edits):
                    text[rng.randrange(len(text))] = rng.randrange(100)
                if len(text) > 5 and rng.random() < 0.3:
                    del text[rng.randrange(len(text))]
                texts.append(tuple(text))
    texts = sorted(set(texts))
    nodes = [(bytes([k]), k % 3 > 0, bytes([k // 5 if k % 2 else 200 + k % 3]), np.array(t, np.uint32).tobytes()) for k, t in enumerate(texts)]
    assert len(nodes) < 200
    words = spark.createDataFrame(nodes, "same binary, rest boolean, label binary, words binary")
    pairs = order_minhash.word_pairs(order_minhash.rare_words(words)).collect()
    got = {(r["a"][0], r["b"][0]) for r in pairs}
    assert len(got) == len(pairs) and all(a < b for a, b in got)
    want = {
        (a, b)
        for a in range(len(nodes))
        for b in range(a + 1, len(nodes))
        if (nodes[a][1] or nodes[b][1]) and nodes[a][2] != nodes[b][2]
        and order_minhash.similarity(np.array(texts[a], np.uint32), np.array(texts[b], np.uint32)) > 0
    }
    assert len(want) > 40 and want <= got


def test_only_word_pairs_that_classes_share_go_to_the_join(spark, monkeypatch):
    rng = random.Random(12)
    own = [[rng.randrange(10**6) for _ in range(40)] for _ in range(20)]
    passage = [rng.randrange(10**6) for _ in range(60)]
    node = lambda k, label: (bytes([k]), True, bytes([label]), np.array([*own[k % 20], 10**6 + k, *passage], np.uint32).tobytes())
    columns = "same binary, rest boolean, label binary, words binary"
    nodes = [node(k, k % 20) for k in range(60)]
    rare = order_minhash.rare_words(spark.createDataFrame(nodes, columns))
    # 39 pairs of the class and 2 of the text go first, so one of the passage is left among the 42 that a text needs
    assert rare.count() == 60
    nodes.append(node(60, 99))  # like three texts of another class
    for slots in (order_minhash.SLOTS, 16):
        monkeypatch.setattr(order_minhash, "SLOTS", slots)
        monkeypatch.setattr(order_minhash, "MOST_SLOTS", slots)
        pairs = order_minhash.word_pairs(order_minhash.rare_words(spark.createDataFrame(nodes, columns))).collect()
        assert {(bytes([k]), bytes([60])) for k in (0, 20, 40)} <= {(r["a"], r["b"]) for r in pairs}


def test_texts_with_a_common_passage_form_no_rows_by_pairs(spark, monkeypatch):
    passage = [f"p{k}" for k in range(45)]
    texts = [passage + [f"t{k}w{i}" for i in range(15)] for k in range(110)]
    texts += [passage[:20] + t[:2] + passage[22:] + t[45:] for t in texts[:10]]
    texts += [passage + t[45:52] + [f"u{k}w{i}" for i in range(8)] for k, t in enumerate(texts[20:30])]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id bigint, text string")
    made, staged = [], order_minhash.staged

    def kept(df, name):
        out = staged(df, name)
        if name == "candidates":
            made.append(out.count())
        return out

    monkeypatch.setattr(order_minhash, "staged", kept)
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(docs).collect()}
    words = {w: k for k, w in enumerate({w for t in texts for w in t})}
    each = [np.array([words[w] for w in t], np.uint32) for t in texts]
    want = list(range(len(each)))
    for b in range(len(each)):
        for a in range(b):
            if order_minhash.similarity(each[a], each[b]) > 0 and want[a] != want[b]:
                lo, hi = sorted((want[a], want[b]))
                want = [lo if x == hi else x for x in want]
    assert got == dict(enumerate(want)) and len(set(want)) < len(want)
    assert made[-1] < len(texts)  # not about half the square of the texts with the passage


@pytest.mark.parametrize("block", (5, 512))
def test_blocks_find_all_links(spark, monkeypatch, block):
    monkeypatch.setattr(order_minhash, "BLOCK_NODES", block, raising=False)
    rng = random.Random(22)
    texts = []
    for k in range(90):
        base = [rng.randrange(8 + 10 * (k % 3)) for _ in range(rng.choice((10, 30, 60)))] if k % 9 == 0 else list(base)
        for _ in range(len(base) // 8):
            base[rng.randrange(len(base))] = rng.randrange(90)
        texts.append(tuple(base))
    texts = sorted(set(texts))
    nodes = [(bytes([k]), rng.random() < 0.6, bytes([k // 3 if k % 2 else 200 + k % 3]), len(t), [k % 4, 4 + k % 2, 6], k % 4) for k, t in enumerate(texts)]
    words = [(n[0], np.array(t, np.uint32).tobytes()) for n, t in zip(nodes, texts, strict=True)]
    grouped = spark.createDataFrame(nodes, "same binary, rest boolean, label binary, n_words bigint, found array<bigint>, group bigint")
    found = order_minhash.block_links(grouped, spark.createDataFrame(words, "same binary, words binary")).collect()
    got = {(r["a"][0], r["b"][0]): r["similarity"] for r in found}
    score = lambda a, b: order_minhash.similarity(np.array(texts[a], np.uint32), np.array(texts[b], np.uint32))
    pairs = [(a, b) for b in range(len(nodes)) for a in range(b) if (nodes[a][1] or nodes[b][1]) and nodes[a][2] != nodes[b][2]]
    want = {(a, b): score(a, b) for a, b in pairs if score(a, b) > 0}
    assert len(want) > 20 and got == want and len(found) == len(got)


def test_edits_by_columns_equal_those_by_reach():
    rng = random.Random(23)
    for _ in range(400):
        a = [rng.randrange(6) for _ in range(rng.randrange(80))]
        b = [x if rng.random() < 0.6 else rng.randrange(6) for x in a[rng.randrange(3) :]]
        d = order_minhash._by_reach(a, b, 200)
        for limit in range(max(0, d - 1), d + 2):
            want = d if d <= limit else None
            assert order_minhash._by_columns(a, b, limit) == want == order_minhash.edits(a, b, limit)


def similar_pairs(found):
    """(first, second, similarity) of all pairs of the sketched texts that are similar, by brute force."""
    words = [np.frombuffer(x["words"], np.uint32) for x in found]
    for a in range(len(words)):
        for b in range(a):
            if 0.8 * max(len(words[a]), len(words[b])) - 1e-9 <= min(len(words[a]), len(words[b])) and found[a]["same"] != found[b]["same"]:
                s = order_minhash.similarity(words[a], words[b])
                if s > 0:
                    yield a, b, s


def test_similar_texts_share_a_key():
    draw = random.Random(5)
    met = collections.defaultdict(list)
    for least, most in ((5, 14), (15, 32), (33, 100), (101, 600)):
        for share in (0.1, 0.15, 0.2):
            texts = []
            for _ in range(200):
                words = [f"w{draw.randrange(5000)}" for _ in range(draw.randint(least, most))]
                other = list(words)
                for i in draw.sample(range(len(words)), int(share * len(words) + 1e-9)):
                    other[i] = f"x{draw.randrange(10**9)}"
                texts += [" ".join(words), " ".join(other)]
            found = order_minhash._sketch(pa.array(texts)).to_pylist()
            met[least, share] = [bool(set(a["keys"]) & set(b["keys"])) or a["same"] == b["same"] for a, b in zip(found[::2], found[1::2], strict=True)]
    recall = {k: float(np.mean(v)) for k, v in met.items()}
    assert all(r == 1 for (least, _), r in recall.items() if least < 33), recall
    assert all(r >= (0.85 if share == 0.2 else 0.97) for (_, share), r in recall.items()), recall


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=40), st.lists(st.tuples(st.integers(0, 2), st.integers(0, 40), st.integers(0, 99)), max_size=8))
def test_short_similar_texts_share_a_key_always(words, changes):
    other = list(words)
    for kind, i, word in changes:
        other[i : i + (kind > 0)] = [word] if kind < 2 else []
    a, b = (np.array(x, np.uint64) for x in (words, other[:40]))
    if len(b) and not np.array_equal(a, b) and order_minhash.similarity(a, b) > 0:
        assert set(order_minhash.short_keys(a)) & set(order_minhash.short_keys(b))


def test_similar_documents_of_a_table_share_a_key():
    import pyarrow.parquet as pq

    docs = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].combine_chunks()
    found = order_minhash._sketch(docs).to_pylist()
    pairs = list(similar_pairs(found))
    missed = [(a, b, s) for a, b, s in pairs if not set(found[a]["keys"]) & set(found[b]["keys"])]
    assert len(pairs) > 50 and not missed, (len(pairs), missed)


def test_short_texts_with_a_changed_word_are_grouped(spark):
    docs, want = [], {}
    for k, n in enumerate(range(5, 13)):
        words = [f"t{k}w{i}" for i in range(n)]
        docs += [(10 * k, " ".join(words)), (10 * k + 1, " ".join([*words[: n // 2], "other", *words[n // 2 + 1 :]]))]
        want |= {10 * k: 10 * k, 10 * k + 1: 10 * k}
    got = order_minhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == want


def test_bucket_of_many_classes_is_compared_whole(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage = [word() for _ in range(80)]  # most samples of every text fall into it: one bucket, many classes
    docs = []
    for k in range(12):
        own = [word() for _ in range(45)]
        for c in range(3):
            own[c] = word()
            docs.append((10 * k + c, " ".join(passage + own)))
    got = {r["doc_id"]: r for r in order_minhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert {d: r["class_id"] for d, r in got.items()} == {d: d // 10 * 10 for d, _ in docs}
    assert all(r["class_size"] == 3 and r["n_links"] > 0 for r in got.values())


def test_near_dedup_drops_only_the_row_of_the_copied_text(spark):
    rng = random.Random(10)
    words = ["".join(rng.choice("klmnopqrst") for _ in range(6)) for _ in range(120)]
    copy, alone, other = " ".join(words), " ".join(reversed(words)), " ".join(words[:10] * 3)
    near = " ".join([*words[:60], "another", *words[61:]])
    docs = [(1, copy, 1), (None, near, 2), (None, alone, 3), (7, near, 4), (7, other, 5)]
    left = order_minhash.drop_near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string, __n int"))
    assert sorted(r["__n"] for r in left.collect()) == [1, 3, 5]



# --- 7: toxicity -----------------------------------------------------------------
def test_toxicity_learns_words_and_keeps_its_hands_off_held_out_rows(spark, odd, empty):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["ta", "lo", "mi", "ne", "ru"]) for _ in range(3))
    docs = [(k, " ".join([word() for _ in range(60)] + (["blockhead", "dimwit"] if k % 4 == 0 else []))) for k in range(400)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(200)] + [(5, None), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(table, labels)
    got = {r["doc_id"]: r["s"] for r in table.select("doc_id", toxicity.scored(table, model).alias("s")).collect()}
    assert all((got[k] >= 0.7) == (k % 4 == 0) for k in range(200, 400))
    scores = [r[0] for r in odd.select(toxicity.scored(odd, model)).collect()]
    assert len(scores) == len(ROWS) and all(0 <= s <= 1 for s in scores)
    assert toxicity.drop_toxic(odd, model).columns == odd.columns
    assert toxicity.drop_toxic(empty, model).count() == 0
    none = toxicity.train(empty, labels)
    assert odd.select(toxicity.scored(odd, none).alias("s")).where("s > 0.01").count() == 0


def test_toxicity_query(spark):
    got = result(spark, "op7_toxicity")
    assert got["held_out"].tolist() == [zlib.crc32(str(d).encode()) % 3 == 1 for d in got["doc_id"]]
    assert (got["predicted"] == (got["score"] >= 0.7)).all()


# --- 8, 9: token ids ---------------------------------------------------------------
@settings(max_examples=500, deadline=None)
@given(st.text(st.one_of(st.sampled_from(list(" \t\n'’.,!?-_abcSTREAVEMDLLéÉßſİıΑΣς́̈\x1c\x85　<|>0123½²ﬁŉǅ漢🎉")), st.characters(exclude_categories=["Cs"])), max_size=30))
def test_word_ids_are_the_librarys(text):
    words = word_ids(WORD_BPE)
    assert np.frombuffer(words.encode(text.encode()), words.dtype).tolist() == words.library.encode(text, add_special_tokens=False).ids


def library_ids(text, end):
    return np.array([*word_ids(WORD_BPE).library.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_token_files_hold_every_document(spark, small, odd, empty):
    got = result(spark, "op8_token_files").sort_values("doc_id")
    start = 0
    for row, text in zip(got.itertuples(), small.sort_values("doc_id")["text"], strict=True):
        ids = library_ids(text, 2)
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(ids))
        start += len(ids)
    out = stage_path(spark, "test-tokens")
    token_files.write_tokens(odd, WORD_BPE, out)
    rows = token_files.digest(spark, out).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted((r[0] for r in ROWS), key=lambda d: d or 0)
    assert sum(r["n_tokens"] for r in rows) == sum(len(library_ids(r[1], 2)) for r in ROWS)
    out = stage_path(spark, "test-tokens")
    token_files.write_tokens(empty, WORD_BPE, out)
    assert token_files.digest(spark, out).count() == 0


def check_packing(rows, texts):
    ids = {d: library_ids(t, 1) for d, t in texts.items()}
    spent = collections.Counter()
    sequences = collections.defaultdict(list)
    for r in rows:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own)
        assert zlib.crc32(own[r["start"] : r["start"] + r["length"]]) == r["ids_crc32"]
        spent.update((r["doc_id"], k) for k in range(r["start"], r["start"] + r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert all(sum(k[0] == d for k in spent) == len(x) for d, x in ids.items() if len(x) < 5000)
    assert len(set(spent.values())) == 1
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0


def test_packing(spark, small, odd, empty):
    check_packing(REGISTRY["op9_packing"](spark, SF_SMALL).collect(), dict(zip(small["doc_id"], small["text"])))
    once = odd.where("doc_id is null or doc_id <> 4")
    check_packing(packing.packed(once, WORD_BPE).collect(), {r[0]: r[1] for r in ROWS if r[0] != 4})
    twice = packing.packed(odd.where("doc_id = 4"), WORD_BPE)
    assert twice.agg(F.sum("length")).first()[0] == 2 * len(library_ids(LONG, 1))
    assert packing.packed(empty, WORD_BPE).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=40))
def test_pack_places_each_token_once(lengths):
    sequences = packing.pack(lengths, 16)
    cover = collections.Counter((i, k) for s in sequences for i, a, n in s for k in range(a, a + n))
    assert cover == collections.Counter((i, k) for i, n in enumerate(lengths) for k in range(n))
    assert all(sum(n for _, _, n in s) in (1, 2, 4, 8, 16) for s in sequences)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=40))
def test_tournament_tree_is_first_fit(lengths):
    fit, rooms = packing.FirstFit(len(lengths), 16), []
    for n in lengths:
        want = next((k for k, r in enumerate(rooms) if r >= n), len(rooms))
        if want == len(rooms):
            rooms.append(16)
        rooms[want] -= n
        assert fit.place(n) == want


# --- 10: quality -----------------------------------------------------------------
def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = collections.defaultdict(list)
    for k in range(len(words) - 7):
        at[tuple(words[k : k + 8])].append(k)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    cover = {j for v in at.values() if len(v) > 1 for k in v for j in range(k, k + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover)


def test_quality_measures(spark, small, odd, empty):
    got = result(spark, "op10_quality_ledger").set_index("doc_id")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for doc, text in zip(small["doc_id"], small["text"]):
        want = brute_measures(text)
        assert tuple(got.loc[doc, names]) == want
        assert got.loc[doc, "base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
    assert not (got["kept"] & got["base_failed"]).any()
    rows = quality_ledger.ledger(odd).select(*names).collect()
    assert sorted(map(tuple, rows)) == sorted(brute_measures(r[1]) for r in ROWS)
    assert quality_ledger.ledger(empty).count() == 0
    assert quality_ledger.keep_good(odd).columns == odd.columns


def test_clean_texts_of_other_scripts_and_with_long_words_are_kept(spark):
    draw = random.Random(10)
    word = lambda letters, least, most: "".join(draw.choices(letters, k=draw.randint(least, most)))
    spaced = lambda letters, n: " ".join(word(letters, 3, 9) for _ in range(n))
    han = [chr(c) for c in range(0x4E00, 0x5200)]
    thai = [chr(c) for c in range(0x0E01, 0x0E2F)]
    latin, capitals = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    acronyms = " NATO USB "
    url = "https://example.org/?q=" + word(latin, 2000, 2000)
    clean = {
        "cyrillic": spaced("абвгдежзиклмнопрст", 300) + acronyms,
        "greek": spaced("αβγδεζηθικλμνξοπρστ", 300) + acronyms,
        "arabic": spaced("ابتثجحخدذرزسشصضطظعغ", 300) + acronyms,
        "chinese": "。 ".join(word(han, 30, 60) for _ in range(40)) + acronyms,
        "chinese paragraphs": "\n".join(word(han, 1100, 1200) for _ in range(25)),
        "thai": " ".join(word(thai, 30, 60) for _ in range(40)),
        "long url": spaced(latin, 20_000) + " " + url,
        "url in a short text": spaced(latin, 30) + " " + url[:900],
    }
    junk = {
        "shouted": spaced(capitals, 300),
        "long words": " ".join(word(latin, 30, 60) for _ in range(60)),
        "base64": spaced(latin, 30) + " " + word(latin + capitals, 50_000, 50_000),
    }
    docs = spark.createDataFrame([(0, k, v) for k, v in (clean | junk).items()], "doc_id int, name string, text string")
    kept = {r["name"] for r in quality_ledger.keep_good(docs).collect()}
    assert kept == set(clean)
    old = {r["name"] for r in quality_ledger.keep_good(docs, quality_ledger.POLICY_2).collect()}
    assert not old & set(junk) and old < set(clean)


def test_ablations(spark):
    rules = [r for r in quality_ledger.RULES if r.name in ("too_few_words", "symbols")]
    a, b = (1 << r.bit for r in rules)
    book = spark.createDataFrame([(0,), (a,), (a,), (b,), (a | b,)], "failed bigint")
    got = quality_ledger.ablations(book, quality_ledger.Policy("t", tuple(r.name for r in rules)))
    assert {r["rule"]: (r["fail"], r["fail_only_this"], r["kept_without"]) for r in got.collect()} == {rules[0].name: (3, 2, 3), rules[1].name: (2, 1, 2)}


# --- pipeline --------------------------------------------------------------------
def test_pipeline_against_its_parts(spark, small):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    tox = result(spark, "op7_toxicity")
    good = set(tox[tox["predicted"] == 0]["doc_id"])
    book = result(spark, "op10_quality_ledger")
    good &= set(book[book["kept"]]["doc_id"])
    text = {d: t or "" for d, t in zip(small["doc_id"], small["text"]) if d in good}
    top = {}
    for d, t in text.items():
        h = hashlib.sha256(fold(t).encode()).hexdigest()
        top[h] = max(top.get(h, d), d)
    near = order_minhash.near_duplicates(docs.where(F.col("doc_id").isin(sorted(top.values())))).collect()
    want = {r["doc_id"] for r in near if r["doc_id"] == r["class_id"]}
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in rows} == want
    assert sum(r["length"] for r in rows) == sum(len(library_ids(text[d], 1)) for d in want)


def test_a_workers_piece_cache_is_bounded():
    from vesselflow.llm import word_ids

    assert 2 * word_ids.GENERATION * 300 <= 100 << 20
    words, whole = word_ids.WordIds(WORD_BPE, 10), word_ids.WordIds(WORD_BPE)
    texts = [f"w{k} v{k % 7}".encode() for k in range(100)]
    assert [words.encode(t) for t in texts] == [whole.encode(t) for t in texts]
    assert len(words) <= 10 and len(words.old) <= 10


def test_tokenizer_files_are_where_the_package_says():
    assert WORD_BPE == public_tokenizers.path("word_bpe_49k.json")
