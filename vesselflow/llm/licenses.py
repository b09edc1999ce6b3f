"""Licence scan: a trained paragraph classifier with a calibrated unknown class and a template comparison.

Paragraphs are runs of lines that hold words, so wrapped wordings are whole. In each, the stretches of words that hold most
of the k-grams of a template are judged first; of stretches that overlap, the one that holds the largest share of
its template. Lines without a stretch that counts are judged by themselves. A softmax regression over hashed word 1- to 3-grams tells licence families, "unknown" (licence
talk of no known family) and "none" apart. It is trained on the templates below (words dropped, replaced or
surrounded by corpus words), on made-up licence names for "unknown", and on at most NONE_LINES lines of the corpus, whole
ones of at most NONE_BYTES bytes, for "none". Its temperature is fitted on held-out examples, and a family's probability
must reach a threshold that the held-out examples set. A family stands only if the stretch or line also holds most of the
k-grams of one of its templates; where it doesn't, it counts as unknown. Each family counts once for a paragraph.

Null and empty texts have no paragraphs. Each row is scanned, repeated ones too; empty tables give empty results;
other columns are not read.
"""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vesselflow.llm.stage import ship, whole_text
from vesselflow.llm.textbatch import Hasher, chunks, spans, windows

# Wordings by which public licences are named.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "gpl-2.0": [
        "licensed under the GNU General Public License, version 2",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "lgpl": [
        "licensed under the GNU Lesser General Public License",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license",
        "Released under the BSD 3-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "licensed under the Mozilla Public License, version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "cc0": ["Released under CC0 1.0 Universal", "dedicated to the public domain under the Creative Commons CC0 1.0 dedication"],
    "isc": ["Released under the ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "proprietary": ["All rights reserved. Unauthorized copying of this file is strictly prohibited", "Proprietary and confidential. All rights reserved"],
}
CLASSES = [*TEMPLATES, "unknown", "none"]
_TALK = ["Licensed under the {} License", "distributed under the terms of the {} Licence", "This work is released under the {} public license, version {}", "see the {} licence for terms of use"]

BITS = 16
GRAMS = (1, 2, 3)
NONE_LINES = 3000
#: Bytes of the longest lines that are drawn for training, so that the sample has at most 48 MB.
NONE_BYTES = 1 << 14
EXAMPLES = 60
#: One of so many examples is held out.
HELD_OUT = 4
STEPS, RATE, RIDGE = 200, 0.3, 1e-4
#: Share of a template's 2-grams that a paragraph must hold.
CONFIRMED = 0.6
#: Words of a stretch, at most, for each word of the template.
STRETCH = 1.5
#: Probability of "unknown" from which a paragraph counts as licence talk, at least and at most; between them the
#: highest that a held-out corpus line gets.
UNKNOWN_FROM, UNKNOWN_TO = 0.9, 0.995
#: Share of held-out "none" and "unknown" examples that may pass as a family, at most.
MISTAKES = 0.005

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_GAP = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LINE = np.zeros(256, bool)
_LINE[0x0A] = True


def _grams(buf: np.ndarray, at: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """For each n-gram size, hashes and paragraphs (rows of ``at``)."""
    folded = _FOLD[buf]
    starts, ends, rows = spans(folded, at, _GAP)
    words = Hasher(folded)(starts, ends)
    out = []
    for size in GRAMS:
        keys, first = windows(words, rows, size)
        out.append((keys, rows[first]))
    return out, len(at) - 1


def _strings(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)


def _bins(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - BITS)).astype(np.int64)


class Classifier:
    """Weights by feature and class (the last row is the bias), temperature, threshold, and the templates' 2-grams."""

    def __init__(self, weights: np.ndarray, temperature: float = 1.0, threshold: float = 0.5, unknown: float = UNKNOWN_FROM):
        self.weights, self.temperature, self.threshold, self.unknown = weights, temperature, threshold, unknown
        self.templates = {}
        for family, texts in TEMPLATES.items():
            grams, n = _grams(*_strings(texts))
            keys, rows = grams[1]
            self.templates[family] = [set(keys[rows == k].tolist()) for k in range(n)]

        each = [(CLASSES.index(f), t) for f, ts in self.templates.items() for t in ts]
        self.sizes = np.array([len(t) for _, t in each])
        pairs = sorted((key, k) for k, (_, t) in enumerate(each) for key in t)
        self.gram_keys = np.array([key for key, _ in pairs], np.uint64)
        self.gram_templates = np.array([k for _, k in pairs], np.int64)

    def stretches(self, buf: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row, paragraph, start, end) of the stretches that hold most of a template, without overlaps."""
        folded = _FOLD[buf]
        starts, ends, rows = spans(folded, at, _GAP)
        if not len(starts):
            return []
        line = np.cumsum(buf == 0x0A)[starts]
        paragraph = np.cumsum(np.concatenate(([False], (line[1:] > line[:-1] + 1) | (rows[1:] != rows[:-1]))))
        keys, first = windows(Hasher(folded)(starts, ends), paragraph, 2)
        lo, hi = np.searchsorted(self.gram_keys, keys, "left"), np.searchsorted(self.gram_keys, keys, "right")
        hit = np.flatnonzero(hi > lo)
        n = (hi - lo)[hit]
        which = np.repeat(lo[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        template, place, key = self.gram_templates[which], np.repeat(first[hit], n), np.repeat(keys[hit], n)
        order = np.lexsort((place, template, paragraph[place]))
        template, place, key = template[order], place[order], key[order]
        group = paragraph[place] * len(self.sizes) + template
        edges = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True]))) if len(group) else np.zeros(1, np.int64)
        by_paragraph = defaultdict(list)  # a template once in each
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            t = int(template[a])
            if b - a < CONFIRMED * self.sizes[t]:
                continue
            best, held, left = (0, 0, 0), defaultdict(int), a
            for right in range(a, b):
                held[key[right]] += 1
                while place[right] - place[left] > STRETCH * self.sizes[t] or held[key[left]] > 1:
                    held[key[left]] -= 1
                    if not held[key[left]]:
                        del held[key[left]]
                    left += 1
                best = max(best, (len(held), -int(place[left]), int(place[right]) + 1), key=lambda x: x[0])
            share = best[0] / self.sizes[t]
            if share >= CONFIRMED:
                by_paragraph[int(paragraph[place[a]])].append((share, int(self.sizes[t]), -best[1], best[2]))
        out = []
        for number, found in by_paragraph.items():
            taken = []
            for _, _, a, b in sorted(found, key=lambda x: (-x[0], -x[1], x[2])):
                if all(b < x or y < a for x, y in taken):
                    taken.append((a, b))
                    out.append((int(rows[a]), number, int(starts[a]), int(ends[b])))
        return out

    def logits(self, buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        grams, n = _grams(buf, at)
        total, sizes = np.zeros((n, len(CLASSES))), np.zeros(n)
        for keys, rows in grams:
            sums = np.concatenate((np.zeros((1, len(CLASSES))), np.cumsum(self.weights[_bins(keys)], axis=0, dtype=np.float64)))
            edges = np.searchsorted(rows, np.arange(n + 1))
            total += sums[edges[1:]] - sums[edges[:-1]]
            sizes += np.diff(edges)
        return (total / np.sqrt(np.maximum(sizes, 1))[:, None] + self.weights[-1]) / self.temperature, grams

    def families(self, buf: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The class number of each paragraph, after threshold and template comparison."""
        logits, grams = self.logits(buf, at)
        p = _softmax(logits)
        best = p.argmax(axis=1)
        none, unknown = len(CLASSES) - 1, len(CLASSES) - 2
        keys, rows = grams[1]
        for k in np.flatnonzero(best < unknown):
            a, b = np.searchsorted(rows, [k, k + 1])
            held = set(keys[a:b].tolist())
            close = max((len(held & t) / max(1, len(t)) for t in self.templates[CLASSES[best[k]]]), default=0)
            if p[k, best[k]] < self.threshold or close < CONFIRMED:
                best[k] = unknown if 1 - p[k, none] >= self.unknown else none
        best[(best == unknown) & (1 - p[:, none] < self.unknown)] = none
        return best


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _examples(lines: list[str], seed: int) -> tuple[list[str], np.ndarray]:
    """Paragraphs and their classes: varied templates, made-up licence names, and corpus lines."""
    draw = random.Random(seed)
    words = [w for line in lines for w in line.split()] or ["text"]
    some = lambda most: " ".join(draw.choice(words) for _ in range(draw.randint(0, most)))
    texts, classes = [], []
    for k, family in enumerate(TEMPLATES):
        for n in range(EXAMPLES):
            source = TEMPLATES[family][(n + n // HELD_OUT) % len(TEMPLATES[family])].split()  # each both trained on and held out
            kept = [w for w in source if draw.random() > (0.05 if n % 2 else 0.0)]
            texts.append(f"{some(8 if n % 3 else 0)} {' '.join(kept)} {some(8 if n % 5 else 0)}")
            classes.append(k)
    for n in range(EXAMPLES * 2):
        texts.append(f"{some(6)} {_TALK[n % len(_TALK)].format(draw.choice(words), draw.choice(words))} {some(6)}")
        classes.append(len(CLASSES) - 2)
    texts += lines
    classes += [len(CLASSES) - 1] * len(lines)
    return texts, np.array(classes)


def fit(lines: list[str], seed: int = 7) -> Classifier:
    """A classifier trained on the templates and on corpus ``lines`` that hold no template's 2-grams in number."""
    model = Classifier(np.zeros(((1 << BITS) + 1, len(CLASSES)), np.float32))
    if lines:
        (_, (keys, rows), _), n = _grams(*_strings(lines))
        edges = np.searchsorted(rows, np.arange(n + 1))
        sets = [set(keys[a:b].tolist()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        everything = [t for ts in model.templates.values() for t in ts]
        lines = [x for x, s in zip(lines, sets, strict=True) if not any(len(s & t) >= 0.5 * len(t) for t in everything)]
    texts, classes = _examples(lines, seed)
    train = np.arange(len(texts)) % HELD_OUT != 0
    weights = _descend([t for t, use in zip(texts, train, strict=True) if use], classes[train])
    model = Classifier(weights)
    logits, _ = model.logits(*_strings([t for t, use in zip(texts, train, strict=True) if not use]))
    truth = classes[~train]
    losses = {t: -np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0)}
    temperature = min(losses, key=losses.get)
    p = _softmax(logits / temperature)[truth >= len(TEMPLATES), : len(TEMPLATES)].max(axis=1, initial=0)
    threshold = max(0.5, float(np.quantile(p, 1 - MISTAKES)) if len(p) else 0.5)
    talk = 1 - _softmax(logits / temperature)[truth == len(CLASSES) - 1, -1]
    return Classifier(weights, temperature, min(threshold, 0.95), float(np.clip(talk.max(initial=0), UNKNOWN_FROM, UNKNOWN_TO)))


def _descend(texts: list[str], classes: np.ndarray) -> np.ndarray:
    grams, n = _grams(*_strings(texts))
    column = np.concatenate([_bins(k) for k, _ in grams])
    row = np.concatenate([r for _, r in grams])
    value = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=n), 1))[row]
    used, column = np.unique(column, return_inverse=True)
    count = len(CLASSES)
    w, past = np.zeros((len(used) + 1, count)), np.full((len(used) + 1, count), 1e-6)
    truth = np.eye(count)[classes]
    balance = (1 / np.bincount(classes, minlength=count).clip(1))[classes][:, None] / count
    for _ in range(STEPS):
        logits = np.zeros((n, count))
        for k in range(count):
            logits[:, k] = np.bincount(row, value * w[column, k], n)
        error = (_softmax(logits + w[-1]) - truth) * balance
        slope = RIDGE * w
        for k in range(count):
            slope[:-1, k] += np.bincount(column, value * error[row, k], len(used))
        slope[-1] = error.sum(axis=0)
        past += slope * slope
        w -= RATE * slope / np.sqrt(past)
    out = np.zeros(((1 << BITS) + 1, count), np.float32)
    out[used], out[-1] = w[:-1], w[-1]
    return out


def train(docs: DataFrame, bound: int = NONE_LINES, most: int = NONE_BYTES) -> Classifier:
    """Trained on the templates and on about ``bound`` whole lines of ``docs`` of at most ``most`` bytes, drawn by their
    hash (the bounds of the sample)."""
    lines = docs.select(F.explode(F.split(whole_text(), "\n", -1)).alias("line")).where("trim(line) != ''")
    lines = lines.where(F.octet_length("line") <= most)
    n = lines.count()
    drawn = lines.where(F.pmod(F.xxhash64("line"), F.lit(1 << 20)) <= int(min(1.0, bound / max(1, n)) * (1 << 20)))
    some = drawn.distinct().orderBy(F.xxhash64("line"), "line").limit(bound)
    return fit(sorted(r["line"] for r in some.collect()))


def _scan(shared):
    def scan(texts: pa.Array) -> pa.Array:
        model: Classifier = shared.value
        out = []
        for lo, hi, buf, at in chunks(texts, 1 << 18):
            starts, ends, rows = spans(buf, at, _LINE)
            found = defaultdict(lambda: defaultdict(int))
            if len(starts):
                none = len(CLASSES) - 1
                covered, known = np.zeros(len(starts), bool), set()
                stretches = model.stretches(buf, at)
                if stretches:
                    held = [buf[a:b].tobytes() for _, _, a, b in stretches]
                    edges = np.concatenate(([0], np.cumsum([len(x) for x in held]))).astype(np.int64)
                    judged = model.families(np.frombuffer(b"".join(held), np.uint8), edges)
                    for (row, paragraph, a, b), best in zip(stretches, judged.tolist(), strict=True):
                        if best != none:
                            covered[np.searchsorted(starts, a, "right") - 1 : np.searchsorted(starts, b)] = True
                            if (paragraph, best) not in known:
                                known.add((paragraph, best))
                                found[row][CLASSES[best]] += 1
                lines = np.append(starts, len(buf))  # a line's feed goes with it and is no word
                best = model.families(buf[starts[0] :], lines - starts[0])
                for k in np.flatnonzero((best != none) & ~covered):
                    found[int(rows[k])][CLASSES[best[k]]] += 1
            for r in range(hi - lo):
                got = dict(found.get(r, {}))
                unknown = got.pop("unknown", 0)
                out.append({"families": sorted(got), "n_known": sum(got.values()), "n_unknown": unknown})
        return pa.array(out, pa.struct([("families", pa.list_(pa.string())), ("n_known", pa.int64()), ("n_unknown", pa.int64())]))

    return scan


def scan(docs: DataFrame, model: Classifier) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``families`` (sorted), ``n_known`` and ``n_unknown`` paragraphs."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = "struct<families: array<string>, n_known: bigint, n_unknown: bigint>"
    return docs.select("doc_id", F.arrow_udf(_scan(shared), kind)(whole_text()).alias("s")).select("doc_id", "s.*")
