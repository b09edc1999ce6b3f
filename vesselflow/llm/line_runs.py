"""Line deduplication with levelled sorted runs, in DataFrame operations only.

A run is a bucketed table sorted by the 16-byte hash of a line's key, with the number of rows that hold the line and
the largest of their ids. A new batch of documents is aggregated to such rows first and merge-anti-joined with the runs:
lines never seen before become a run of level 0, lines that a run holds become increments beside it. No key is in two
runs. When a level has ``fanout`` runs they, and their increments, are compacted into one of the next level. All tables
of a store share bucketing, so no join and no compaction shuffles what is already in the runs (of the increments, a
compaction does); they lie in the shared folder that ``spark.checkpoint.dir`` names.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lowered. Keys of at least
``min_chars`` code points in at least ``min_docs`` documents lose all their lines except in the document with
the largest id. Null or empty text is one empty line. Rows that share an id are one document: their lines stay in each
of them if theirs is the largest id. Rows without an id are documents told apart by their texts, and rank below all
others. The runs count rows, which can only be more; the ids behind the keys found often enough are counted exactly
at the end. Empty tables give empty results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vesselflow.llm.stage import ascii_lower, delete, join_groups, key_filter, passes_filter, stage_path, staged, whole_text

#: Characters of [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
MIN_CHARS = 40
MIN_DOCS = 5
FANOUT = 3
BATCHES = 4


def line_hashes(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """For each line its key's hash (32 hex digits), or '' where the key is too short."""
    lines = F.split(ascii_lower(text), "\n", -1)
    key = lambda line: F.btrim(line, F.lit(BLANKS))
    return F.transform(lines, lambda x: F.when(F.char_length(key(x)) >= min_chars, F.md5(key(x).cast("binary"))).otherwise(F.lit("")))


class LineRuns:
    """The levelled runs of a store of line hashes. ``close()`` drops its tables."""

    def __init__(self, spark: SparkSession, min_chars: int = MIN_CHARS, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.min_chars, self.fanout = spark, min_chars, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        #: Tables of each level: runs, and the increments of keys that an earlier run holds.
        self.levels: list[list[str]] = []
        self.increments: list[list[str]] = []
        self._paths: dict[str, str] = {}

    def counts_of(self, batch: DataFrame) -> DataFrame:
        """The batch's rows of a run. A line repeated in a row counts once; counts are combined before the shuffle."""
        keys = F.array_distinct(line_hashes(whole_text(), self.min_chars))
        return (
            batch.select("doc_id", F.explode(keys).alias("key"))
            .where("key != ''")
            .groupBy(F.unhex("key").alias("key"))
            .agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("max_doc"))
        )

    def _write(self, rows: DataFrame, kind: str) -> str:
        name = f"llm_line_{kind}_{uuid.uuid4().hex}"
        self._paths[name] = stage_path(self.spark, f"line-{kind}")
        rows.write.bucketBy(self.buckets, "key").sortBy("key").format("parquet").option("path", self._paths[name]).saveAsTable(name)
        return name

    def _union(self, names: list[str]) -> DataFrame:
        out = self.spark.table(names[0])
        for x in names[1:]:
            out = out.unionAll(self.spark.table(x))
        return out

    def _compacted(self, kind: str, names: list[str]) -> DataFrame:
        """Runs hold different keys and only go together; increments are added up. Spark 4.1 takes the union of bucketed
        scans for bucketed but reads them one after the other, so a group by their key would be split: it gets a key of its own."""
        rows = self._union(names)
        if kind == "run":
            return rows
        key = F.concat("key", F.lit(b"")).alias("key")
        return rows.groupBy(key).agg(F.sum("n_docs").alias("n_docs"), F.max("max_doc").alias("max_doc"))

    def _counted(self, run: str) -> DataFrame:
        """A run with the increments of its keys (merge join with each table of them, on the shared buckets)."""
        out = self.spark.table(run)
        for x in (x for level in self.increments for x in level):
            more = self.spark.table(x).select("key", F.col("n_docs").alias("n2"), F.col("max_doc").alias("m2"))
            out = out.join(more.hint("merge"), "key", "left").select(
                "key", (F.col("n_docs") + F.coalesce("n2", F.lit(0))).alias("n_docs"), F.greatest("max_doc", "m2").alias("max_doc")
            )
        return out

    def names(self) -> list[str]:
        return [x for level in self.levels for x in level]

    def add(self, batch: DataFrame) -> DataFrame:
        """Add a batch and return its keys that no earlier run holds (merge anti join by run): the keys of its own run."""
        earlier = self.names()
        run = self._write(self.counts_of(batch), "run")
        known = None
        if earlier:
            counted, fresh = run, self.spark.table(run)
            for x in earlier:
                fresh = fresh.join(self.spark.table(x).select("key").hint("merge"), "key", "left_anti")
            run = self._write(fresh, "run")
            others = self.spark.table(counted).join(self.spark.table(run).select("key").hint("merge"), "key", "left_anti")
            known = self._write(others, "increments")
            self._drop([counted])
        if not self.levels:
            self.levels.append([])
            self.increments.append([])
        self.levels[0].append(run)
        self.increments[0] += [known] if known else []
        return self.spark.table(run).select("key")

    def compact(self) -> None:
        """Merge each full level into one run of the next, and drop its tables."""
        k = 0
        while k < len(self.levels):
            if len(self.levels[k]) >= self.fanout:
                if k + 1 == len(self.levels):
                    self.levels.append([])
                    self.increments.append([])
                for kind, levels in (("run", self.levels), ("increments", self.increments)):
                    old = levels[k]
                    levels[k] = []
                    if old:
                        levels[k + 1].append(self._write(self._compacted(kind, old), kind))
                        self._drop(old)
            k += 1

    def frequent(self, min_docs: int) -> DataFrame:
        """Keys found in at least ``min_docs`` rows over all runs: ``key``, ``n_docs``, ``max_doc``."""
        each = [self._counted(x).where(F.col("n_docs") >= min_docs) for x in self.names()]
        out = each[0]
        for x in each[1:]:
            out = out.unionAll(x)
        return out

    def _drop(self, names: list[str]) -> None:
        for x in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {x}")
            delete(self.spark, self._paths.pop(x))

    def close(self) -> None:
        self._drop(list(self._paths))
        self.levels, self.increments = [], []


def input_batches(docs: DataFrame, batches: int = BATCHES) -> list[DataFrame]:
    """All of ``docs`` in about ``batches`` ranges of ``doc_id`` (a number) with nearly as many rows each; rows without an
    id are in the first. The ranges come from quantiles over all ids, and reach a Parquet scan as filters."""
    cuts = docs.approxQuantile("doc_id", [k / batches for k in range(1, batches)], 0.01)
    cuts = sorted({int(x) for x in cuts})
    own = F.col("doc_id")
    if not cuts:
        return [docs]
    inner = [docs.where((own > low) & (own <= high)) for low, high in zip(cuts[:-1], cuts[1:], strict=True)]
    return [docs.where(own.isNull() | (own <= cuts[0])), *inner, docs.where(own > cuts[-1])]


def kept_lines(lines: Column, gone: Column) -> Column:
    """``lines`` without the positions (from 0, ascending) in ``gone``: the slices between them, so the work is
    linear in the lines."""
    ends = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))
    return F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.size(gone) + 1),
            lambda i: F.slice(lines, F.element_at(ends, i) + 2, F.element_at(ends, i + 1) - F.element_at(ends, i) - 1),
        )
    )


def dedup_lines(
    docs: DataFrame, batches: list[DataFrame], min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, fanout: int = FANOUT
) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_lines``, ``n_dropped``, ``kept`` (its text with the lines
    that stay). ``batches`` together hold each row of ``docs`` once, in order of arrival."""
    spark = docs.sparkSession
    runs = LineRuns(spark, min_chars, fanout)
    try:
        for batch in batches:
            runs.add(batch)
            runs.compact()
        frequent = staged(runs.frequent(min_docs), "lines-frequent")
    finally:
        runs.close()

    hashes = F.col("key").cast("binary")
    shared = key_filter(frequent, F.xxhash64(hashes))
    base = docs.select("doc_id", whole_text().alias("text"))
    lines = base.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(line_hashes(F.col("text"), min_chars)).alias("pos", "hex")
    ).where("hex != ''")
    lines = lines.select("doc_id", "text_hash", "pos", F.unhex("hex").alias("key"))
    maybe = passes_filter(lines, F.xxhash64("key"), shared, "maybe").where("maybe").drop("maybe")
    maybe = staged(maybe, "lines-maybe")
    # of the keys in enough rows, those in enough documents
    nameless = F.when(F.col("doc_id").isNull(), F.col("text_hash")).alias("nameless")
    by_doc = maybe.groupBy("key", "doc_id", nameless).agg(F.count(F.lit(1)).alias("n"))
    by_key = by_doc.groupBy("key").agg(F.sum("n").alias("n_lines_of_key"), F.count(F.lit(1)).alias("n_ids"))
    groups = by_key.where(F.col("n_ids") >= min_docs).drop("n_ids").join(frequent, "key")
    found = join_groups(maybe, staged(groups, "lines-groups"), ["key"], "n_lines_of_key", how="inner")
    gone = (
        found.where(~F.col("doc_id").eqNullSafe(F.col("max_doc")))
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    )

    rows = base.withColumn("text_hash", F.xxhash64("text"))
    same = rows["doc_id"].eqNullSafe(gone["doc_id"]) & (rows["text_hash"] == gone["text_hash"])
    split = F.split("text", "\n", -1)
    left = rows.join(gone, same, "left").select(
        rows["doc_id"], "text", F.coalesce("gone", F.array().cast("array<int>")).alias("gone"), split.alias("lines")
    )
    return left.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
        F.when(F.size("gone") == 0, F.col("text")).otherwise(F.array_join(kept_lines(F.col("lines"), F.col("gone")), "\n")).alias("kept"),
    )
