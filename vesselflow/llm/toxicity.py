"""Toxicity: a linear classifier over character n-grams whose features are scaled by naive Bayes log-count ratios.

A feature is the share of an n-gram (hashed, 3 to 6 bytes of the folded text) among a text's characters, times
the n-gram's log ratio of smoothed counts in toxic and other texts. Logistic regression with L2 and balanced
classes is fitted on the scaled features by one task, on at most about TRAIN_DOCS labelled rows (drawn by the
hash of their ids); labels, ids, sources and languages are no features. The weights (1 MB) are broadcast and every
whole text is scored where it is read.

Null and empty texts get the score of no features. Labels of an id are combined (toxic if one row says so); null
labels don't count. Without labels of both classes the score is the share of toxic labels (0 without any). Each row
is scored, repeated ones too; empty tables give empty results; other columns stay as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vesselflow.llm.stage import ship, whole_rows, whole_text
from vesselflow.llm.textbatch import chunks, release_memory, utf8

#: Labelled rows that the classifier is fitted on, about (the bound of its sample).
TRAIN_DOCS = 8000
SIZES = (3, 4, 5, 6)
BITS = 18
THRESHOLD = 0.7
#: Features in fewer training texts, or with a smaller log ratio, are left out.
MIN_TEXTS, MIN_RATIO = 8, 1.5
MIN_LENGTH = 20
STEPS, RATE, RIDGE = 150, 0.1, 1e-3

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_FOLD[[b for b in range(128) if not chr(b).isalnum()]] = 0x20


def _folded(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts lowered (A-Z), with a space for each run of anything but letters and digits, and around each text."""
    n = len(at) - 1
    place = np.arange(len(buf)) + 2 * np.repeat(np.arange(n), np.diff(at)) + 1
    out = np.full(len(buf) + 2 * n, 0x20, np.uint8)
    out[place] = _FOLD[buf]
    bounds = at + 2 * np.arange(n + 1)
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 0x20) | (out[:-1] != 0x20)
    keep[bounds[:-1]] = True
    return out[keep], np.concatenate(([0], np.cumsum(keep)))[bounds]


def _grams(text: np.ndarray, size: int) -> np.ndarray:
    """The feature of the n-gram at each position."""
    n = max(0, len(text) - size + 1)
    h = np.zeros(n, np.uint32)
    for k in range(size):
        h = h * np.uint32(0x01000193) + text[k : k + n]
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * size)
    return (h >> np.uint32(32 - BITS)).astype(np.int32)


def _features(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of one folded text and their shares (percent)."""
    found, counts = np.unique(np.concatenate([_grams(text, s) for s in SIZES]), return_counts=True)
    return found, counts * (100.0 / max(len(text), MIN_LENGTH))


def fit(texts: pa.Array, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights by feature, and the bias."""
    y = labels.astype(float)
    size, positive = 1 << BITS, float(y.mean()) if len(y) else 0.0
    if not 0 < positive < 1:
        return np.zeros(size, np.float32), 50.0 if positive == 1 else -50.0
    buf, at = utf8(texts)
    each = lambda: (_features(_folded(buf[a:b], np.array([0, b - a]))[0]) for a, b in zip(at[:-1], at[1:], strict=True))
    mass, seen = np.zeros((2, size)), np.zeros(size, np.int64)
    for (found, share), label in zip(each(), labels, strict=True):
        mass[int(label)][found] += share
        seen[found] += 1
    mass += mass.sum() / max(1, int(seen.sum()))  # smoothed by the mean share of a feature that occurs
    ratio = np.log(mass[1] / mass[1].sum()) - np.log(mass[0] / mass[0].sum())
    ratio[(seen < MIN_TEXTS) | (np.abs(ratio) < MIN_RATIO)] = 0
    columns, values, lengths = [], [], []
    for found, share in each():
        use = ratio[found] != 0
        columns.append(found[use])
        values.append((share[use] * ratio[found[use]]).astype(np.float32))
        lengths.append(int(use.sum()))
    row, column, value = np.repeat(np.arange(len(y)), lengths), np.concatenate(columns), np.concatenate(values)
    balance = np.where(y == 1, 0.5 / positive, 0.5 / (1 - positive)) / len(y)
    w, bias = np.zeros(size), 0.0
    past, past_bias = np.full(size, 1e-8), 1e-8
    for _ in range(STEPS):
        score = np.bincount(row, value * w[column], len(y)) + bias
        error = (1 / (1 + np.exp(-np.clip(score, -500, 500))) - y) * balance
        slope = np.bincount(column, value * error[row], size) + RIDGE * w
        past += slope * slope
        w -= RATE * slope / np.sqrt(past)
        past_bias += error.sum() ** 2
        bias -= RATE * error.sum() / np.sqrt(past_bias)
    return (w * ratio).astype(np.float32), float(bias)


def train(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_DOCS) -> tuple[np.ndarray, float]:
    """The classifier from the texts of ``docs`` that ``labels`` (``doc_id``, ``toxic``) covers."""
    spark = docs.sparkSession
    ship(spark)
    marks = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = bound / max(1, marks.count())
    drawn = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    sample = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(drawn), "doc_id")
    # repeated rows teach once, so that what is drawn bounds the one training task
    sample = sample.groupBy("doc_id", F.xxhash64("text").alias("text_hash")).agg(F.first("text").alias("text"), F.first("toxic").alias("toxic")).drop("text_hash")

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        weights, bias = fit(rows["text"].combine_chunks(), rows["toxic"].to_numpy())
        release_memory()
        return pa.table({"weights": pa.array([weights.tobytes()], pa.binary()), "bias": [bias]})

    model = sample.groupBy(F.lit("all").alias("all")).applyInArrow(run, "weights binary, bias double").first()
    return (np.frombuffer(bytes(model["weights"]), np.float32), model["bias"]) if model else fit(pa.array([], pa.string()), np.zeros(0))


def _scores(shared):
    def score(texts: pa.Array) -> pa.Array:
        weights, bias = shared.value
        out = np.zeros(len(texts))
        for lo, hi, buf, at in chunks(texts):
            text, bounds = _folded(buf, at)
            total = np.zeros(hi - lo)
            for size in SIZES:
                sums = np.concatenate(([0.0], np.cumsum(weights[_grams(text, size)], dtype=np.float64)))
                first = np.minimum(bounds[:-1], len(sums) - 1)
                total += sums[np.clip(bounds[1:] - size + 1, first, len(sums) - 1)] - sums[first]
            total *= 100.0 / np.maximum(np.diff(bounds), MIN_LENGTH)
            out[lo:hi] = 1 / (1 + np.exp(-np.clip(total + bias, -500, 500)))
        return pa.array(np.round(out, 9))

    return score


def scored(docs: DataFrame, model: tuple[np.ndarray, float]) -> Column:
    """The score of ``docs``' texts, 0 to 1."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return F.arrow_udf(_scores(shared), "double")(whole_text())


def drop_toxic(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    return whole_rows(docs, toxicity=scored(docs, model)).where(F.col("toxicity") < threshold).select("row.*")
