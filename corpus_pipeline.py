"""From raw documents to packed training sequences: five stages over the operators of ``vesselflow.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept; ``run`` writes each result as
Parquet in the shared folder and reads it back as the next stage's input. All but the last return the columns they got.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vesselflow.llm import exact_dedup, order_minhash, packing, quality_ledger, toxicity
from vesselflow.llm.queries import WORD_BPE, documents, toxicity_model
from vesselflow.llm.stage import staged


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity_model(spark, docs, sf_dir))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_ledger.keep_good(docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return order_minhash.drop_near_duplicates(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, WORD_BPE, end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("packing", packing_stage),
]

#: A trained classifier, Order MinHash and a tokenizer are not SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
