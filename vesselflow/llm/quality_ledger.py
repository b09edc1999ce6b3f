"""Quality rules as a bitmask ledger.

``ledger`` evaluates every rule once for each document and stores the measurements and one bit for each rule that
fails. A policy is a versioned set of rules: applying one, or comparing many, needs only bit operations on the
ledger. ``ablations`` tells for each rule of a policy how many documents fail it, fail only it, and would be kept
without it, from one aggregation over distinct masks.

Lines, words and windows are compared by numbers that equal bytes, and only they, share.

Words are ``[^\\x20\\x09-\\x0D]+``. A rule on letter case or on the length of words judges only what is written in ASCII,
since other scripts have other letters, and some no blanks between words: an ASCII word is one of whose characters
more than half are ASCII. Null text has no words. Each row is judged by itself: repeated rows get equal
results, empty tables give empty ones. Texts are worked on whole; memory is a multiple of a chunk (512 KB) or of the
longest text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vesselflow.llm.stage import ship, whole_rows, whole_text
from vesselflow.llm.textbatch import chunks, exact_ids, exact_windows, per_row, release_memory, repeats, spans

WINDOW = 8
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "max_word_chars", "n_stutters", "n_ascii_words", "ascii_word_chars", "giant_chars")
#: ``ascii_word_chars`` counts so many characters of an ASCII word at most: a few URLs don't make a text's words long.
MOST_CHARS = 40
#: ``giant_chars`` counts the characters of ASCII words with more characters than this.
GIANT = 1000
_TYPE = "struct<" + ", ".join(f"{m}: bigint" for m in MEASURES) + ">"


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails`` (SQL over the measurements) is true."""

    bit: int
    name: str
    fails: str


#: Bits are never given to another rule; new rules take new bits. Bits 5 to 7 stay for policy 2: they fail clean texts
#: of other scripts, and long texts for one long word.
RULES = (
    Rule(0, "too_few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > 3 * n_words"),
    Rule(3, "duplicate_lines", "10 * n_dup_lines > 5 * n_lines"),
    Rule(4, "mean_word_short", "word_chars < 2 * n_words"),
    Rule(5, "mean_word_long", "word_chars > 20 * n_words"),
    Rule(6, "upper_case", "10 * n_upper > 6 * n_letters"),
    Rule(7, "giant_word", "max_word_chars > 1000"),
    Rule(8, "stutter", "100 * n_stutters > 30 * n_words"),
    Rule(9, "ascii_upper_case", "10 * n_upper > 6 * n_letters and 2 * n_letters > word_chars"),
    Rule(10, "ascii_words_long", "ascii_word_chars > 20 * n_ascii_words and 2 * n_ascii_words > n_words"),
    Rule(11, "giant_words", "2 * giant_chars > word_chars"),
)


@dataclass(frozen=True)
class Policy:
    """A document is rejected if it fails one of the policy's rules."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {r.name: r.bit for r in RULES}
        return sum(1 << bits[name] for name in self.rules)


BASE = Policy("base", ("too_few_words", "repeated_windows"))
POLICY_2 = Policy("2", tuple(r.name for r in RULES if r.bit < 9))
POLICY = Policy("3", tuple(r.name for r in RULES if r.bit not in (5, 6, 7)))


def _measure(array: pa.Array) -> pa.Array:
    out = {m: np.zeros(len(array), np.int64) for m in MEASURES}
    for lo, hi, buf, at in chunks(array):
        n = hi - lo
        starts, ends, rows = spans(buf, at, BLANK)
        put = lambda name, values: out[name].__setitem__(slice(lo, hi), values)  # noqa: B023, E731
        by_byte = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[at])  # noqa: B023, E731
        lead = (buf & 0xC0) != 0x80
        put("n_words", np.bincount(rows, minlength=n))
        put("word_chars", by_byte(lead & ~BLANK[buf]))
        put("n_symbols", by_byte(SYMBOL[buf]))
        upper = (buf >= 0x41) & (buf <= 0x5A)
        put("n_upper", by_byte(upper))
        put("n_letters", by_byte(upper | ((buf >= 0x61) & (buf <= 0x7A))))
        code_points = np.concatenate(([0], np.cumsum(lead, dtype=np.int64)))
        longest = np.zeros(n, np.int64)
        chars = code_points[ends] - code_points[starts]
        np.maximum.at(longest, rows, chars)
        put("max_word_chars", longest)
        ascii_before = np.concatenate(([0], np.cumsum(buf < 0x80, dtype=np.int64)))
        in_ascii = 2 * (ascii_before[ends] - ascii_before[starts]) > chars
        put("n_ascii_words", per_row(in_ascii, rows, n))
        put("ascii_word_chars", per_row(np.where(in_ascii, np.minimum(chars, MOST_CHARS), 0), rows, n))
        put("giant_chars", per_row(np.where(in_ascii & (chars > GIANT), chars, 0), rows, n))

        l0, l1, line_rows = spans(buf, at, NEWLINE)
        words_before = np.searchsorted(starts, l0)
        with_word = np.searchsorted(starts, l1) > words_before
        l0, l1, line_rows = l0[with_word], l1[with_word], line_rows[with_word]
        put("n_lines", np.bincount(line_rows, minlength=n))
        again, _ = repeats(exact_ids(buf, l0, l1), line_rows)
        put("n_dup_lines", per_row(again, line_rows, n))

        words = exact_ids(buf, starts, ends)
        stutter = np.zeros(len(words), bool)
        stutter[1:] = (words[1:] == words[:-1]) & (rows[1:] == rows[:-1])
        put("n_stutters", np.bincount(rows, weights=stutter, minlength=n).astype(np.int64))
        keys, first = exact_windows(words, rows, WINDOW)
        again, _ = repeats(keys, rows[first])
        if again.any():
            own = _with_copy(keys, rows[first], again)
            cover = np.zeros(len(starts) + 1, np.int64)
            np.add.at(cover, first[own], 1)
            np.add.at(cover, first[own] + WINDOW, -1)
            put("n_repeat_words", per_row(np.cumsum(cover[:-1]) > 0, rows, n))
    release_memory()
    return pa.StructArray.from_arrays([pa.array(out[m]) for m in MEASURES], names=list(MEASURES))


def _with_copy(keys: np.ndarray, rows: np.ndarray, again: np.ndarray) -> np.ndarray:
    """All items whose key occurs twice or more in their own row."""
    order = np.lexsort((keys, rows))
    k, r, a = keys[order], rows[order], again[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
    group = np.cumsum(new) - 1
    twice = np.bincount(group, weights=a) > 0
    out = np.empty(len(k), bool)
    out[order] = twice[group]
    return out


def failure_bits(measures: str = "measures") -> Column:
    """One bit for each failed rule."""
    names = re.compile(r"\b(" + "|".join(MEASURES) + r")\b")
    out = F.lit(0).cast("long")
    for r in RULES:
        fails = F.expr(names.sub(rf"{measures}.\1", r.fails))
        out = out.bitwiseOR(F.when(fails, F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return out


def ledger(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, the measurements, ``failed`` (bits)."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", F.arrow_udf(_measure, _TYPE)(whole_text()).alias("measures"))
    return rows.select("doc_id", "measures.*", failure_bits().alias("failed"))


def passes(policy: Policy, failed: Column) -> Column:
    return failed.bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def ablations(book: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of ``policy``: documents that fail it, that fail only it, and that the policy without it keeps."""
    masks = book.groupBy(F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long")).alias("failed")).agg(F.count(F.lit(1)).alias("n"))
    own = [r for r in RULES if policy.mask >> r.bit & 1]
    rules = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in own])).alias("r")
    by = masks.select("failed", "n", rules)
    bit = F.col("r.bit")
    return by.groupBy(F.lit(policy.version).alias("policy"), F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("failed").bitwiseAND(bit) != 0, F.col("n")).otherwise(0)).alias("fail"),
        F.sum(F.when(F.col("failed") == bit, F.col("n")).otherwise(0)).alias("fail_only_this"),
        F.sum(F.when(F.col("failed").bitwiseAND(F.bitwise_not(bit)) == 0, F.col("n")).otherwise(0)).alias("kept_without"),
    )


def keep_good(docs: DataFrame, policy: Policy = POLICY) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    ship(docs.sparkSession)
    rows = whole_rows(docs, measures=F.arrow_udf(_measure, _TYPE)(whole_text()))
    return rows.where(passes(policy, failure_bits("measures"))).select("row.*")
