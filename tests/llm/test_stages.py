"""Pipeline stages on awkward rows: clashing column names, repeated rows, nulls, empty tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vesselflow.llm import exact_dedup, order_minhash, packing, quality_ledger, toxicity
from vesselflow.llm.queries import WORD_BPE
from vesselflow.llm.stage import filter_bits, staged, without

NAMES = ["row", "id", "hash", "maybe", "__hash", "__measures", "__toxicity", "__bucket", "__byte", "__bit", "__gone_id", "measures", "toxicity", "a.b", "text_hash", "same", "key"]
WORDS = " ".join(f"word{k}" for k in range(60))
TEXTS = [(1, None), (2, ""), (3, WORDS), (4, WORDS.upper()), (4, WORDS.upper()), (None, WORDS + " tail"), (6, WORDS.replace("word7 ", "other ")), (7, "short text")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, *(f"{n} {k}" for n in NAMES)) for k, (i, t) in enumerate(TEXTS)]
    return staged(spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in NAMES)), "stage-test")


MODEL = (np.zeros(1 << toxicity.BITS, np.float32), -3.0)
STAGES = {
    "toxicity": lambda d: toxicity.drop_toxic(d, MODEL),
    "quality": quality_ledger.keep_good,
    "exact": exact_dedup.drop_copies,
    "near": order_minhash.drop_near_duplicates,
}


@pytest.mark.parametrize(("stage", "left"), [("toxicity", range(8)), ("quality", [2, 5, 6]), ("exact", [1, 3, 4, 5, 6, 7]), ("near", [0, 2, 7])])
def test_clashing_columns_come_through(docs, stage, left):
    out = STAGES[stage](docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert sorted(int(r["row"].split()[1]) for r in rows) == list(left)
    assert all(r[n] == f"{n} {r['row'].split()[1]}" for r in rows for n in NAMES)
    assert STAGES[stage](docs.where("doc_id > 99")).collect() == []


def test_without_removes_by_id_and_text(docs):
    gone = staged(docs.where("doc_id = 4 OR doc_id IS NULL OR doc_id = 3").select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") == 3, 0).otherwise(F.xxhash64("text")).cast("long").alias("hash")).distinct(), "gone")
    left = without(docs, gone, F.xxhash64("row.text"))
    assert sorted(str(r.doc_id) for r in left.collect()) == ["1", "2", "3", "6", "7"]


def test_filters_grow_with_their_keys():
    assert filter_bits(0) == filter_bits(500_000) == 1 << 23
    assert filter_bits(1_000_000) == 1 << 24 and filter_bits(10**12) == 1 << 26


def test_equal_rows_are_packed_in_many_groups(spark):
    docs = staged(spark.range(3000).select(F.when(F.col("id") < 2000, 5).otherwise(F.col("id")).alias("doc_id"), F.lit("one text for all").alias("text")), "pack-test")
    rows = packing.packed(docs, WORD_BPE, group_docs=100).collect()
    groups = [r.sequence_id >> 23 for r in rows if r.doc_id == 5]
    assert len(set(groups)) >= 25 and max(groups.count(g) for g in set(groups)) < 200
    assert sum(r.length for r in rows) == 3000 * rows[0].doc_tokens


def test_repeated_labelled_rows_teach_once(spark):
    docs = [(k, ("nasty slur words here " if k % 2 else "kind and calm prose here ") * 5 + str(k)) for k in range(40)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id bigint, toxic int")
    once = spark.createDataFrame(docs, "doc_id bigint, text string")
    often = spark.createDataFrame(docs + [docs[3]] * 200, "doc_id bigint, text string")
    a, b = toxicity.train(once, labels), toxicity.train(often, labels)
    assert (a[0] == b[0]).all() and a[1] == b[1]


def test_pipeline_stages_on_awkward_rows(spark, docs, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "toxicity_model", lambda *_: MODEL)
    for table in (docs, docs.where("doc_id > 99")):
        now = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = staged(stage(spark, now, "unused"), name)
            assert now.columns == docs.columns
        packed = corpus_pipeline.STAGES[-1][1](spark, now, "unused").collect()
        assert [r.doc_id for r in now.collect()] == ([3] if table is docs else [])
        assert {r.doc_id for r in packed} == {r.doc_id for r in now.collect()}


def test_join_groups_makes_no_row_twice(spark):
    from vesselflow.llm.stage import join_groups, staged

    hot = [(1, k) for k in range(50)]
    rows = staged(spark.createDataFrame([*hot, *((k, k) for k in range(100, 2200)), (7, 7)], "key int, row int"), "test-rows")
    groups = staged(rows.where("key != 7").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("row").alias("most")), "test-groups")
    want = sorted((k, r, 49 if k == 1 else r) for k, r in [*hot, *((k, k) for k in range(100, 2200))])
    for few in (0, 10_000):
        for how, more in (("inner", []), ("left", [(7, 7, None)])):
            found = join_groups(rows, groups, ["key"], "n", how, few)
            assert sorted((r["key"], r["row"], r["most"]) for r in found.collect()) == sorted([*want, *more])
            plan = found._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("LeftOuter") == (how == "left")  # only the join that was asked for
            assert plan.count("Join ") == (1 if few else 3)


def test_only_words_of_met_nodes_are_written_and_small_tables_are_broadcast(spark, monkeypatch):
    from vesselflow.llm import components

    texts = [" ".join(f"t{k}w{i}" for i in range(60)) for k in range(40)]
    near = [t.replace("w30 ", "other ") for t in texts[:4]]
    docs = staged(spark.createDataFrame([*enumerate([*texts, *near, texts[0], texts[1].upper()])], "doc_id bigint, text string"), "words-test")
    want = {d: d for d in range(40)} | {40: 0, 41: 1, 42: 2, 43: 3, 44: 0, 45: 1}
    written = []

    def kept(df, name):
        out = staged(df, name)
        written.append((name, out.columns, out.count()))
        return out

    for module in (order_minhash, components):
        monkeypatch.setattr(module, "staged", kept)
    counts = []
    for few in (components.FEW, 0):
        monkeypatch.setattr(components, "FEW", few)
        monkeypatch.setattr(order_minhash, "FEW", few)
        assert {r.doc_id: r.class_id for r in order_minhash.near_duplicates(docs).collect()} == want
        assert [name for name, columns, _ in written if "words" in columns] == ["words"]
        assert [n for name, _, n in written if name == "words"] == [8]
        counts.append(len(written))
        assert (few == 0) == any(name == "parents" for name, *_ in written)
        written.clear()
    assert counts[0] < 0.7 * counts[1]


def test_members_meet_their_bucket_by_no_anti_join(spark, monkeypatch):
    from vesselflow.llm import components

    assert order_minhash.FEW == components.FEW == 50_000
    rows = [(1, bytes([0, k]), 9) for k in range(50)] + [(k, bytes([k % 3, k // 256, k % 256]), 9) for i in range(2) for k in range(100 + i, 2200)]
    members = staged(spark.createDataFrame(sorted(set(rows) | {(k, b"\x09", 9) for k in range(100, 2200)}), "key bigint, same binary, n_words bigint"), "members-test")
    plans = {}

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return staged(df, name)

    monkeypatch.setattr(order_minhash, "staged", kept)
    monkeypatch.setattr(order_minhash, "unstage", lambda *tables: None)
    found = []
    for few in (components.FEW, 0):
        monkeypatch.setattr(order_minhash, "FEW", few)
        got = order_minhash._bucketed(members).collect()
        found.append(sorted((r["key"], bytes(r["same"]), bytes(r["a"])) for r in got))
        assert "LeftAnti" not in plans["bucket-pairs"]
        assert plans["bucket-pairs"].count("Join ") == (1 if few else 2)
    assert found[0] == found[1] and len(found[0]) == 49 + 2100
