"""Licence scans with a trained paragraph classifier.

A multinomial logistic regression over sparse word n-grams assigns paragraphs to
licence families or to the unknown class.  It is trained on variations of known
notices against a bounded sample of corpus lines; a temperature and the least
probability of a family are set on held-out rows, so that unknown text stays
unknown.  A predicted paragraph counts once a comparison with the family's
notices confirms it; stretches that share their words with a notice are
classified by themselves too, so a short notice counts in a line of any length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Notices of well-known licences.
NOTICES: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" '
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause License.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution.",
    ),
    "BSL-1.0": (
        "Boost Software License - Version 1.0 - August 17th, 2003",
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
        'documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software',
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC0": (
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ),
    "GPL-2.0": (
        "Licensed under the GNU General Public License, version 2.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or any later version.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies.",
    ),
    "LGPL": (
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "The MIT License (MIT)",
        "Licensed under the terms of the MIT license.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "Mozilla Public License Version 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "Proprietary": (
        "All rights reserved.",
        "Proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ),
    "Public-Domain": (
        "This work is in the public domain.",
        "This is free and unencumbered software released into the public domain.",
    ),
}
FAMILIES = tuple(NOTICES)
UNKNOWN = len(FAMILIES)

#: Bounds of the fit: corpus lines that are sampled, rows made per notice, gradient steps.
SAMPLE_LINES = 2000
ROWS_PER_NOTICE = 40
STEPS = 150
#: Share of held-out unknown rows that may be taken for a family.
FALSE_ALARMS = 0.002
#: Longer paragraphs are classified in windows of so many words, half overlapping.
WINDOW = 40
#: A core runs from one word pair that a notice has to another one, over the notice's
#: length and this share more at most; a run of such pairs ends at a gap of so many words.
REACH, RUN_GAP = 0.25, 4
#: It is confirmed if it holds this share of the neighbouring word pairs of the shorter
#: of core and notice, and of the words of the shorter one, in order.
COMMON_PAIRS = 0.6
CONFIRMED = 0.8
#: Words that must be common: this share of the notice, or so many of a long one.
LEAST_SHARE, LEAST_WORDS = 0.8, 10

_WORDS = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.casefold())


class Model:
    """n-gram weights; features are n-gram counts per word, the share of words
    outside the notices' vocabulary, and a constant."""

    def __init__(self, vocabulary: dict[str, int], pairs: np.ndarray, triples: np.ndarray):
        self.vocabulary, self.pairs, self.triples = vocabulary, pairs, triples
        self.n = len(vocabulary) + len(pairs) + len(triples) + 2
        self.weights = np.zeros((self.n, UNKNOWN + 1), np.float32)
        self.temperature, self.least = 1.0, 0.5

    @classmethod
    def of_notices(cls) -> Model:
        notices = [words_of(t) for family in FAMILIES for t in NOTICES[family]]
        vocabulary = {w: k for k, w in enumerate(sorted({w for n in notices for w in n}))}
        v = len(vocabulary)
        ids = [[vocabulary[w] for w in n] for n in notices]
        pairs = np.unique([a * v + b for n in ids for a, b in zip(n, n[1:], strict=False)])
        triples = np.unique([(a * v + b) * v + c for n in ids for a, b, c in zip(n, n[1:], n[2:], strict=False)])
        return cls(vocabulary, pairs, triples)

    def features(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first word, feature) of all known n-grams of a word id sequence (-1: unknown)."""
        v = len(self.vocabulary)
        known = ids >= 0
        at, found, offset = [np.flatnonzero(known)], [ids[known]], v
        two = known[:-1] & known[1:]
        for size, table in ((2, self.pairs), (3, self.triples)):
            ok = np.flatnonzero(two if size == 2 else two[:-1] & known[2:])
            key = ids[ok] * v + ids[ok + 1]
            key = key if size == 2 else key * v + ids[ok + 2]
            k = np.minimum(np.searchsorted(table, key), len(table) - 1)
            hit = table[k] == key
            at.append(ok[hit]), found.append(offset + k[hit])
            offset += len(table)
        return np.concatenate(at), np.concatenate(found)

    def logits(self, ids: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Class scores of the word ranges begin:end of one id sequence."""
        at, found = self.features(ids)
        order = np.argsort(at, kind="stable")
        at, total = at[order], np.zeros((len(at) + 1, UNKNOWN + 1))
        np.cumsum(self.weights[found[order]], axis=0, out=total[1:], dtype=np.float64)
        n = (end - begin)[:, None]
        out = (total[np.searchsorted(at, end)] - total[np.searchsorted(at, begin)]) / n
        seen = np.concatenate([[0], np.cumsum(ids >= 0)])
        share = 1 - (seen[end] - seen[begin])[:, None] / n
        return out + share * self.weights[-2] + self.weights[-1]

    def ids(self, words: list[str]) -> np.ndarray:
        get = self.vocabulary.get
        return np.fromiter([get(w, -1) for w in words], np.int64, len(words))

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def training_rows(lines: list[str], seed: int = 0) -> tuple[list[list[str]], np.ndarray]:
    """Varied notices with their families, and corpus lines and scrambled notices as unknown."""
    rng = np.random.default_rng(seed)
    corpus = [w for x in lines for w in words_of(x)] or ["the", "of", "and"]
    rows, labels = [], []

    def filler(n: int) -> list[str]:
        k = int(rng.integers(0, max(1, len(corpus) - n)))
        return corpus[k : k + n]

    for k, family in enumerate(FAMILIES):
        for notice in NOTICES[family]:
            whole = words_of(notice)
            for i in range(ROWS_PER_NOTICE):
                w = whole
                if i and len(w) > 8 and rng.random() < 0.5:  # a part, as of a wrapped line
                    n = int(rng.integers(len(w) // 2, len(w) + 1))
                    a = int(rng.integers(0, len(w) - n + 1))
                    w = w[a : a + n]
                if i and len(w) > 5 and rng.random() < 0.4:
                    w = [x for x in w if rng.random() > 0.08] or w
                if i % 2:
                    extra = filler(int(rng.integers(0, len(w) // 2 + 2)))
                    w = extra + w if rng.random() < 0.5 else w + extra
                rows.append(w[: 2 * WINDOW]), labels.append(k)
    bag = [w for f in FAMILIES for t in NOTICES[f] for w in words_of(t)]
    for x in lines:
        w = words_of(x)
        if w:
            rows.append(w[:WINDOW]), labels.append(UNKNOWN)
    for _ in range(max(200, len(lines) // 6)):
        n = int(rng.integers(2, 14))
        w = [bag[int(rng.integers(len(bag)))] if rng.random() < 0.5 else corpus[int(rng.integers(len(corpus)))] for _ in range(n)]
        rows.append(w), labels.append(UNKNOWN)
    return rows, np.array(labels)


def fit(lines: list[str], seed: int = 0) -> Model:
    """Model from a bounded list of corpus lines; lines that repeat a notice are set aside."""
    model = Model.of_notices()
    lines = [x for x in lines if all(matched(words_of(x), f) < CONFIRMED for f in range(UNKNOWN))]
    rows, labels = training_rows(lines, seed)
    x = np.zeros((len(rows), model.n), np.float32)
    for r, w in enumerate(rows):
        ids = model.ids(w)
        np.add.at(x[r], model.features(ids)[1], 1.0 / len(w))
        x[r, -2], x[r, -1] = 1 - (ids >= 0).mean(), 1.0
    held = np.random.default_rng(seed + 1).random(len(rows)) < 0.25
    y = np.eye(UNKNOWN + 1, dtype=np.float32)[labels]
    share = 1.0 / np.maximum(np.bincount(labels[~held], minlength=UNKNOWN + 1), 1)
    weight = share[labels[~held]]
    weight = (weight / weight.sum()).astype(np.float32)[:, None]
    a, b, w = x[~held], y[~held], model.weights
    velocity = np.zeros_like(w)
    for _ in range(STEPS):
        z = a @ (w + 0.9 * velocity)
        e = np.exp(z - z.max(axis=1, keepdims=True))
        grad = a.T @ ((e / e.sum(axis=1, keepdims=True) - b) * weight) + 1e-5 * w
        velocity = 0.9 * velocity - 30.0 * grad
        w += velocity
    z = x[held] @ w
    best = np.inf
    for t in np.geomspace(0.1, 4, 40):
        model.temperature, p = float(t), None
        p = model.probabilities(z)
        loss = -np.log(np.maximum(p[np.arange(len(p)), labels[held]], 1e-12)).mean()
        if loss < best:
            best, chosen = loss, float(t)
    model.temperature = chosen
    p = model.probabilities(z)
    alarms = np.sort(p[labels[held] == UNKNOWN][:, :UNKNOWN].max(axis=1))
    model.least = float(max(0.5, alarms[int(len(alarms) * (1 - FALSE_ALARMS)) - 1])) if len(alarms) else 0.5
    return model


def common(words: list[str], other: list[str]) -> int:
    """Length of the longest common word sequence."""
    row = [0] * (len(other) + 1)
    for w in words:
        last = 0
        for k, x in enumerate(other):
            keep = row[k + 1]
            row[k + 1] = last + 1 if w == x else max(keep, row[k])
            last = keep
    return row[-1]


def _pairs(words: list[str]) -> list[tuple[str, str]]:
    return list(zip(words, words[1:], strict=False))


#: Words and neighbouring word pairs of the notices, by family.
_NOTICES = [[(words_of(t), frozenset(_pairs(words_of(t)))) for t in NOTICES[f]] for f in FAMILIES]
_FAMILIES_OF: dict[tuple[str, str], frozenset[int]] = {
    p: frozenset(f for f in range(UNKNOWN) if any(p in theirs for _, theirs in _NOTICES[f])) for n in _NOTICES for _, all_ in n for p in all_
}


def _cores(hits: list[int], length: int) -> set[tuple[int, int]]:
    """(first, last) places in ``hits``: each longest stretch within a notice's reach, and
    each run without large gaps, as far as it goes within reach."""
    reach, out, j = int(length * (1 + REACH)) + 1, set(), -1
    for i in range(len(hits)):
        far = max(i, j)
        while far + 1 < len(hits) and hits[far + 1] + 2 - hits[i] <= reach:
            far += 1
        if far > j:
            out.add((i, far))
            j = far
    i = 0
    while i < len(hits):
        k = i
        while k + 1 < len(hits) and hits[k + 1] - hits[k] <= RUN_GAP and hits[k + 1] + 2 - hits[i] <= reach:
            k += 1
        out.add((i, k))
        i = k + 1
    return out


def cores(words: list[str], family: int) -> list[tuple[float, int, int]]:
    """(score, first, end) of the cores that share enough with a notice of the family:
    longest common word sequence of core and notice over the shorter of both."""
    out = []
    pairs = _pairs(words)
    for other, theirs in _NOTICES[family]:
        hits = [k for k, p in enumerate(pairs) if p in theirs]
        for i, j in _cores(hits, len(other)):
            first, end = hits[i], hits[j] + 2
            shared = len(set(pairs[first : end - 1]) & theirs)
            if shared < COMMON_PAIRS * min(len(set(pairs[first : end - 1])), len(theirs)):
                continue
            n = common(words[first:end], other)
            if n < min(LEAST_SHARE * len(other), LEAST_WORDS) or n < CONFIRMED * min(end - first, len(other)):
                continue
            while i < j and common(words[hits[i + 1] : end], other) == n:  # pairs beside the notice
                i += 1
            while i < j and common(words[hits[i] : hits[j - 1] + 2], other) == n:
                j -= 1
                end = hits[j] + 2
            first = hits[i]
            out.append((n / min(end - first, len(other)), first, end))
    return out


def compare(words: list[str], family: int) -> tuple[float, int, int]:
    """(score, first, end) of the best and longest of the unit's confirmed cores."""
    return max(cores(words, family), key=lambda x: (x[0], x[2] - x[1]), default=(0.0, 0, 0))


def matched(words: list[str], family: int) -> float:
    return compare(words, family)[0]


def _regions(model: Model, known: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Word ranges inside lines around word pairs of the notices, where two follow each other:
    a core has more than half of its pairs in common with a notice."""
    at, found = model.features(known)
    v = len(model.vocabulary)
    hits = np.sort(at[(found >= v) & (found < v + len(model.pairs))])
    line = np.searchsorted(bounds, hits, "right")
    inside = np.searchsorted(bounds, hits + 1, "right") == line  # not over a line's end
    hits, line = hits[inside], line[inside]
    if not len(hits):
        return
    longest = max(len(w) for n in _NOTICES for w, _ in n)
    apart = (np.diff(hits) > int(longest * (1 + REACH))) | (np.diff(line) > 0)
    for part in np.split(hits, np.flatnonzero(apart) + 1):
        if (np.diff(part) == 1).any():
            yield int(part[0]), int(part[-1]) + 2


def find(model: Model, text: str | None) -> tuple[int, list[tuple[int, int, str, float]]]:
    """(paragraphs, confirmed (start, end, family, probability)) of a text.

    Windows of the paragraphs are classified and compared with the notices of
    their family; so is each core of a notice by itself, however long the
    paragraph around it is.
    """
    if not text:
        return 0, []
    begin, end, place, words, lines, bounds = [], [], 0, [], [], []
    for line in text.split("\n"):
        w = words_of(line)
        if w:
            for a in range(0, max(1, len(w) - WINDOW // 2), WINDOW // 2) if len(w) > WINDOW else (0,):
                begin.append(len(words) + a), end.append(len(words) + min(len(w), a + WINDOW))
            bounds.append(len(words)), lines.append((place, line))
            words.extend(w)
        place += len(line) + 1
    if not lines:
        return 0, []
    known, starts = model.ids(words), np.array(bounds)

    def classes(low: list[int], high: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p = model.probabilities(model.logits(known, np.array(low), np.array(high)))
        family = p[:, :UNKNOWN].argmax(axis=1)
        top = p[np.arange(len(p)), family]
        return family, top, (top >= model.least) & (top > p[:, UNKNOWN])

    found: list[tuple[float, float, int, int, int]] = []  # score, probability, first, end, family
    family, top, sure = classes(begin, end)
    for k in np.flatnonzero(sure):
        for score, low, high in cores(words[begin[k] : end[k]], family[k]):
            found.append((score, float(top[k]), begin[k] + low, begin[k] + high, int(family[k])))
    single = []
    for low, high in _regions(model, known, starts):
        part = words[low:high]
        near = [f for p in _pairs(part) for f in _FAMILIES_OF.get(p, ())]
        for f in set(near):
            if near.count(f) > 1:
                single += [(score, low + a, low + b, f) for score, a, b in cores(part, f)]
    if single:
        family, top, sure = classes([x[1] for x in single], [x[2] for x in single])
        found += [(x[0], float(top[k]), x[1], x[2], x[3]) for k, x in enumerate(single) if sure[k] and family[k] == x[3]]
    chosen, owner = [], np.full(len(words), -1)  # the family that has a word
    for x in sorted(set(found), key=lambda x: (-x[0], x[2] - x[3], -x[1], x)):
        if np.isin(owner[x[2] : x[3]], (-1, x[4])).all():
            owner[x[2] : x[3]] = x[4]
            chosen.append(x)
    spans: list[tuple[int, int, str, float]] = []
    for _, p, low, high, f in sorted(chosen, key=lambda x: (x[2], x[3])):
        k = int(np.searchsorted(starts, low, "right")) - 1
        start, line = lines[k]
        places = [m.span() for m in _WORDS.finditer(line)]
        if len(places) != len(words_of(line)):  # case folding that changes words: the whole line
            places = [(0, len(line))] * len(words_of(line))
        first, last = start + places[low - bounds[k]][0], start + places[high - 1 - bounds[k]][1]
        if spans and spans[-1][2] == FAMILIES[f] and spans[-1][1] > first:  # overlapping cores
            spans[-1] = (spans[-1][0], max(spans[-1][1], last), FAMILIES[f], max(spans[-1][3], p))
        else:
            spans.append((first, last, FAMILIES[f], p))
    return len(lines), spans


def sample_lines(docs: DataFrame, text_col: str, n: int) -> list[str]:
    """Up to ``n`` distinct corpus lines, the first by hash, so every run draws the same.

    Only lines below a bound of the hash are ordered: as many as the number of all
    lines makes likely to be enough, or else eight times so many.
    """
    lines = docs.select(F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("line"))
    lines = lines.filter(F.length(F.trim("line")).between(3, 2000)).withColumn("h", F.xxhash64("line"))
    share = 4 * n / max(lines.count(), 1)
    while True:
        low = lines if share >= 1 else lines.filter(F.col("h") < F.lit(int(share * 2**64) - 2**63))
        found = [r["line"] for r in low.distinct().orderBy("h", "line").limit(n).collect()]
        if len(found) == n or share >= 1:
            return found
        share *= 8


_SCHEMA = "doc_id long, n_paragraphs long, licenses array<struct<start:bigint,end:bigint,family:string,probability:double>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """(doc_id, n_paragraphs, licenses) of every row; spans are code points.

    Without a model one is fitted on ``SAMPLE_LINES`` lines of the texts (length
    3 to 2,000; longer ones aren't sampled but are scanned).  Null, empty and
    blank texts have no paragraphs; repeated rows get equal results; an empty
    table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model or fit(sample_lines(docs, text_col, SAMPLE_LINES)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("start", pa.int64()), ("end", pa.int64()), ("family", pa.string()), ("probability", pa.float64())])
        )
        for batch in batches:
            rows = [find(shared.value, t.as_py()) for t in batch.column(1)]
            spans = [[dict(zip(("start", "end", "family", "probability"), s, strict=True)) for s in r[1]] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array(spans, kind)],
                names=["doc_id", "n_paragraphs", "licenses"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, _SCHEMA)


def op6_query(docs: DataFrame) -> DataFrame:
    listed = F.transform("licenses", lambda s: F.concat_ws(":", s["family"], s["start"], s["end"]))
    families = F.array_sort(F.array_distinct(F.transform("licenses", lambda s: s["family"])))
    return scan(docs).select(
        "doc_id", "n_paragraphs", F.array_join(families, ",").alias("families"), F.array_join(listed, ",").alias("spans")
    )
