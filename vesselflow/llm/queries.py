"""Registered queries of the training-data operators, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vesselflow.llm import bond_scan, exact_dedup, licenses, line_runs, order_minhash, packing, pivot_simhash, quality_ledger, term_pointers, token_counts, token_files, toxicity, viterbi
from vesselflow.llm.stage import stage_path, whole_text

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        REGISTRY[name] = fn
        if oracle:
            ORACLE_SQL[name] = oracle
        return fn

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query(
    "op4_exact_dedup",
    """
    WITH d AS (
      SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
      FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
    FROM d WINDOW w AS (PARTITION BY text_sha256)
    """,
)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_copies(documents(spark, sf_dir), digest_all=True)
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.col("full_hash").alias("text_sha256"))


@query(
    "op6_line_dedup",
    """
    WITH l AS (
      SELECT doc_id, i, lines[i] AS line, translate(trim(lines[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
    f AS (SELECT key, max(doc_id) AS max_doc FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    m AS (SELECT l.doc_id, l.i, l.line, coalesce(f.max_doc <> l.doc_id, false) AS gone FROM l LEFT JOIN f USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id
    """,
)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = line_runs.dedup_lines(docs, line_runs.input_batches(docs))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op10_quality_ledger",
    # the rules of policy 3 beyond the base, from the same measurements; a window of 8 words is the list of them
    """
    WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, string_split(text, chr(10)) AS lines FROM t),
    l AS (SELECT *, list_filter(lines, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS own FROM w),
    u AS (SELECT r, word, octet_length(encode(regexp_replace(word, '[^\\x00-\\x7F]', '', 'g'))) AS n_ascii, length(word) AS chars
          FROM (SELECT r, unnest(words) AS word FROM w)),
    c AS (SELECT r, sum(chars) AS word_chars, max(chars) AS max_word_chars,
            count(*) FILTER (2 * n_ascii > chars) AS n_ascii_words,
            coalesce(sum(least(chars, 40)) FILTER (2 * n_ascii > chars), 0) AS ascii_word_chars,
            coalesce(sum(chars) FILTER (2 * n_ascii > chars AND chars > 1000), 0) AS giant_chars FROM u GROUP BY r),
    g AS (SELECT r, i, list_slice(words, i, i + 7) AS gram FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
    x AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
    p AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 8)) AS j FROM x) GROUP BY r),
    m AS (
      SELECT l.doc_id, len(words) AS n_words, coalesce(c.word_chars, 0)::BIGINT AS word_chars, coalesce(max_word_chars, 0) AS max_word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(own) - len(list_distinct(own)) AS n_dup_lines,
        coalesce(p.n_repeat_words, 0) AS n_repeat_words, len(own) AS n_lines,
        length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters,
        len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS n_stutters,
        coalesce(n_ascii_words, 0) AS n_ascii_words, coalesce(ascii_word_chars, 0) AS ascii_word_chars, coalesce(giant_chars, 0) AS giant_chars
      FROM l LEFT JOIN c USING (r) LEFT JOIN p USING (r)),
    f AS (
      SELECT *, (n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT + 4 * (10 * n_symbols > 3 * n_words)::BIGINT
        + 8 * (10 * n_dup_lines > 5 * n_lines)::BIGINT + 16 * (word_chars < 2 * n_words)::BIGINT + 32 * (word_chars > 20 * n_words)::BIGINT
        + 64 * (10 * n_upper > 6 * n_letters)::BIGINT + 128 * (max_word_chars > 1000)::BIGINT + 256 * (100 * n_stutters > 30 * n_words)::BIGINT
        + 512 * (10 * n_upper > 6 * n_letters AND 2 * n_letters > word_chars)::BIGINT
        + 1024 * (ascii_word_chars > 20 * n_ascii_words AND 2 * n_ascii_words > n_words)::BIGINT + 2048 * (2 * giant_chars > word_chars)::BIGINT AS failed
      FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed & 3871 = 0 AS kept, failed
    FROM f
    """,
)
def op10_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality_ledger.ledger(documents(spark, sf_dir))
    base = ~quality_ledger.passes(quality_ledger.BASE, F.col("failed"))
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        (~base & quality_ledger.passes(quality_ledger.POLICY, F.col("failed"))).alias("kept"), "failed",
    )


WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stage_path(spark, "token-files")
    token_files.write_tokens(documents(spark, sf_dir), WORD_BPE, out, end_id=2)
    return token_files.digest(spark, out)


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), WORD_BPE, end_id=1)


PIECES = public_tokenizers.path("piece_bpe_32k.model")


@query("op1_piece_encoding")
def op1_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = viterbi.round_trip(documents(spark, sf_dir), PIECES)
    return rows.select("doc_id", "n_pieces", "pieces_crc32", F.col("same").alias("round_trip"))


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_counts.with_counts(documents(spark, sf_dir).select("doc_id", "text"), PIECES)
    return rows.select("doc_id", F.octet_length(whole_text()).cast("long").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """Trained without the held-out rows."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.train(docs, labels.where(~held_out()))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    score = toxicity.scored(docs, toxicity_model(spark, docs, sf_dir))
    return docs.select("doc_id", held_out().alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int")
    )


@query("op5_order_minhash")
def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(documents(spark, sf_dir))


@query("op3_license_scan")
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = licenses.scan(docs, licenses.train(docs))
    return rows.select("doc_id", F.array_join("families", ",").alias("families"), "n_known", "n_unknown")


@query(
    "op11_source_divergence",
    """
    WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text, row_number() OVER () AS doc FROM documents),
    t AS (
      SELECT lang, source, doc, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
      FROM d),
    c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT doc) AS docs FROM t GROUP BY ALL),
    k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 3),
    v AS (SELECT lang, count(*) AS terms, sum(n) AS total FROM k GROUP BY lang),
    g AS (SELECT DISTINCT lang, source FROM d),
    n AS (SELECT g.lang, g.source, coalesce(sum(c.n) FILTER (k.term IS NOT NULL), 0) AS total
          FROM g LEFT JOIN c USING (lang, source) LEFT JOIN k USING (lang, term) GROUP BY ALL),
    p AS (
      SELECT n.lang, n.source, k.term, coalesce(c.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (n.total + v.terms)::HUGEINT AS p,
        1 + (1000000000::HUGEINT * (k.n + 1)) // (v.total + v.terms)::HUGEINT AS q
      FROM n JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
    pairs AS (
      SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    r AS (
      SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE n > 0 AND p > q),
    o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM r)
    SELECT * FROM o WHERE part = 'pair' OR rank <= 200
    """,
)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_pointers.audit(documents(spark, sf_dir))


@query("op12_pivot_simhash")
def op12_pivot_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_simhash.near_duplicates(documents(spark, sf_dir))


@query(
    "op13_hard_negatives",
    """
    WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.vector, r.vector)::BIGINT AS score
      FROM v a JOIN v r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
    p AS (
      SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank,
      s.vec_id AS negative_id, positive_score, s.score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
    QUALIFY rank <= 3
    """,
)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    rows = bond_scan.participants(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label)
    return bond_scan.hard_negatives(rows, F.col("vec_id") % 50 == 0)
