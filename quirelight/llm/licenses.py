"""Licence scan by a trained paragraph classifier.

Paragraphs are lines; one of more than WINDOW words is read as windows of WINDOW words, WINDOW / 2 apart. Words are
runs of letters and digits, lower-cased. A paragraph's features are its word 1-grams and 2-grams that the TEMPLATES
know, as a sparse vector of length one. A multinomial logistic regression over the families and `unknown` is trained on
the driver: on the templates' sentences and on parts and damaged copies of them, against mixtures of their words and
SAMPLE_UNITS paragraphs (those of least hash in the whole text) of each of SAMPLE_DOCS documents at most (the first by a
hash of doc_id), less those that look like a template. A quarter of the examples is held out to set the temperature of
the probabilities and the least probability below which a paragraph is of the class unknown.

The regression decides: its most probable class, if that is a family of at least the least probability, is the
prediction. Comparison with templates only confirms it: the prediction stands if at least CONFIRM of the paragraph's
2-grams are in one template of that family, and is unknown otherwise. As no paragraph can be confirmed whose 2-grams are
less than CONFIRM in all templates together, only those that reach it need be classified; that count is made for every
paragraph of every text.

A notice within a longer line is confirmed by the share of its template instead: hits are 2-grams of the templates, those
of a line at most GAP apart are a cluster, and where more than CONFIRM of a template's 2-grams, among them one that no
other family has, stand at most GAP apart in a cluster, the words from the first to the last of them are classified as a
paragraph of their own, unless they overlap one that was found to be of the same family.

Cases: null, empty and word-less texts have no paragraphs; paragraphs of under three words are unknown; very long texts
are read whole; of families of equal probability the first in the templates' order is predicted; rows that repeat a
doc_id are scanned apart; an empty table trains on the templates alone and gives no rows; columns other than those named
are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelight.llm.common import bounded, narrow, small_batches, utf8
from quirelight.llm.text_hash import ALNUM, LOWER, Ranges, runs, words

WINDOW = 40
CONFIRM = 0.5
GAP = 4
SAMPLE_DOCS = 400
SAMPLE_UNITS = 8
COPIES = 20
SEED = 7
UNKNOWN = "unknown"

#: Notices and leading sentences of well-known licences, a list a family.
TEMPLATES: dict[str, list[str]] = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU General Public License, version 2.",
        "Licensed under the GPL version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "agpl": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "cc0": ["Dedicated to the public domain under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "SPDX-License-Identifier: CC0-1.0"],
    "isc": ["Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "SPDX-License-Identifier: ISC"],
    "unlicense": ["This is free and unencumbered software released into the public domain.", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, for any purpose, commercial or non-commercial, and by any means."],
    "proprietary": ["All rights reserved.", "Copyright. All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form without the prior written permission of the publisher."],
}
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def word_list(text: str) -> list[bytes]:
    return WORDS.findall(text.encode().translate(LOWER.tobytes()))


def grams(found: list[bytes]) -> list[tuple[bytes, ...]]:
    return [(w,) for w in found] + list(zip(found[:-1], found[1:], strict=True))


class Classifier:
    """The trained model; picklable, with plain arrays."""

    def __init__(self, unknown: list[list[bytes]], templates: dict[str, list[str]] = TEMPLATES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.names = [*templates, UNKNOWN]
        lists = [[word_list(t) for t in ts] for ts in templates.values()]
        self.bigrams = [[set(zip(t[:-1], t[1:], strict=True)) for t in ts] for ts in lists]
        self.known = {g: i for i, g in enumerate(sorted({g for ts in lists for t in ts for g in grams(t)}))}
        self.any_bigram = {g for ts in self.bigrams for t in ts for g in t}
        families = [set().union(*ts) for ts in self.bigrams]
        self.own = [f.difference(*[x for x in families if x is not f]) for f in families]
        pool = sorted({w for ts in lists for t in ts for w in t})
        examples: list[tuple[list[bytes], int]] = []
        for k, ts in enumerate(lists):
            for t in ts:
                examples += [(t, k)] * 5
                for _ in range(COPIES):  # a part of it, with a tenth of its words lost
                    n = int(rng.integers(max(2, len(t) * 2 // 3), len(t) + 1))
                    at = int(rng.integers(0, len(t) - n + 1))
                    examples.append(([w for w in t[at : at + n] if n < 6 or rng.random() > 0.1], k))
        n_known = len(examples)
        for i in range(n_known):  # words of templates in no order
            examples.append(([pool[j] for j in rng.integers(0, len(pool), 3 + i % 20)], len(lists)))
        examples += [(x, len(lists)) for x in unknown if self._share(x, self.any_bigram) < CONFIRM]
        rows = [self.features(w) for w, _ in examples]
        y = np.array([k for _, k in examples])
        held = rng.random(len(y)) < 0.25
        self.b = np.zeros((len(self.known) + 1, len(self.names)))  # the last row is the constant
        fitted = [i for i in range(len(rows)) if not held[i]]
        target, forward, backward = np.eye(len(self.names))[y[fitted]], *self._sparse([rows[i] for i in fitted])
        step, speed = 8.0, np.zeros_like(self.b)
        for _ in range(200):
            p = self._softmax(forward(self.b))
            speed = 0.9 * speed + backward(target - p) / len(fitted) - 1e-5 * self.b
            self.b = self.b + step * speed
        z = self._sparse([rows[i] for i in np.flatnonzero(held)])[0](self.b)
        self.temperature = min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0), key=lambda t: -np.log(self._softmax(z / t)[np.arange(held.sum()), y[held]] + 1e-12).sum())
        p = self._softmax(z / self.temperature)
        guess, sure = p.argmax(axis=1), p.max(axis=1)
        self.held_out_accuracy = float((guess == y[held]).mean())
        named = guess < len(lists)
        self.least = next((c for c in (0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9) if not (named & (sure >= c)).any() or (guess == y[held])[named & (sure >= c)].mean() >= 0.99), 0.95)

    def _sparse(self, rows: list[np.ndarray]):
        """Products of the rows (numbers of features, each with one value, and the constant) with a matrix of weights,
        and of their transpose with a matrix of residuals."""
        sizes = np.array([len(r) + 1 for r in rows])
        columns = np.concatenate([np.append(r, len(self.known)) for r in rows])
        values = np.concatenate([np.append(np.full(len(r), self._value(r)), 1.0) for r in rows])[:, None]
        begin, of = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(rows)), sizes)
        order = np.argsort(columns, kind="stable")
        used, first = np.unique(columns[order], return_index=True)

        def backward(residuals: np.ndarray) -> np.ndarray:
            out = np.zeros((len(self.known) + 1, residuals.shape[1]))
            out[used] = np.add.reduceat((values * residuals[of])[order], first)
            return out

        return lambda b: np.add.reduceat(values * b[columns], begin), backward

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    @staticmethod
    def _share(found: list[bytes], bigrams: set) -> float:
        own = list(zip(found[:-1], found[1:], strict=True))
        return sum(g in bigrams for g in own) / len(own) if own else 0.0

    def features(self, found: list[bytes]) -> np.ndarray:
        """The numbers of a paragraph's known 1-grams and 2-grams."""
        return np.array(sorted({i for g in grams(found) if (i := self.known.get(g)) is not None}), np.int64)

    @staticmethod
    def _value(features: np.ndarray) -> float:
        return 1 / max(1.0, np.sqrt(len(features)))

    def classify(self, found: list[bytes]) -> tuple[str, float]:
        """The predicted family, if a template of it confirms it, else unknown; and the calibrated probability."""
        at = self.features(found)
        p = self._softmax(((self.b[at] * self._value(at)).sum(axis=0) + self.b[-1])[None, :] / self.temperature)[0]
        k = int(p.argmax())
        if k < len(self.bigrams) and p[k] >= self.least and max(self._share(found, t) for t in self.bigrams[k]) >= CONFIRM:
            return self.names[k], float(p[k])
        return UNKNOWN, float(p[-1])

    def notices(self, found: list[bytes]) -> list[tuple[int, int, str, float]]:
        """First word, word after the last, family and probability of the notices in a cluster; none overlap."""
        pairs = list(zip(found[:-1], found[1:], strict=True))
        fits = []
        for ts, own in zip(self.bigrams, self.own, strict=True):
            for t in ts:
                at = np.array([i for i, g in enumerate(pairs) if g in t], np.int64)
                for part in np.split(at, np.flatnonzero(np.diff(at) > GAP) + 1):
                    there = {pairs[i] for i in part}
                    if len(there) > CONFIRM * len(t) and there & own:
                        fits.append((-len(there) / len(t), int(part[0]), int(part[-1]) + 2))
        out: list[tuple[int, int, str, float]] = []
        for _, lo, hi in sorted(fits):
            if all(hi <= a or b <= lo for a, b, _, _ in out):
                family, p = self.classify(found[lo:hi])
                if family != UNKNOWN:
                    out.append((lo, hi, family, p))
        return out


def paragraphs(row: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words and words after the last of all lines and, in long ones, windows. row, line: of each word."""
    first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (line[1:] != line[:-1]))))
    stop = np.append(first[1:], len(row))
    long = np.flatnonzero(stop - first > WINDOW)
    more_lo, more_hi = [], []
    for a, b in zip(first[long], stop[long], strict=True):
        begin = np.arange(a, b - WINDOW // 2, WINDOW // 2)
        more_lo.append(begin)
        more_hi.append(np.minimum(begin + WINDOW, b))
    short = np.ones(len(first), bool)
    short[long] = False
    return np.concatenate([first[short], *more_lo]), np.concatenate([stop[short], *more_hi])


def units(data: np.ndarray, offsets: np.ndarray, bigrams: np.ndarray, own: np.ndarray) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """Byte starts, byte ends and rows: of paragraphs and windows, at least CONFIRM of whose 2-grams are known; and of
    clusters of two or more known 2-grams, at least one of them a single family's."""
    starts, ends, row = words(data, offsets, ALNUM)
    if not len(starts) or not len(bigrams):
        return ((np.zeros(0, np.int64),) * 3,) * 2
    pair = runs(Ranges(data).of(starts, ends), 2)
    at = np.minimum(np.searchsorted(bigrams, pair), len(bigrams) - 1)
    hit = np.concatenate(([0], np.cumsum(bigrams[at] == pair)))
    line = np.concatenate(([0], np.cumsum(data == 0x0A)))[starts]
    lo, hi = paragraphs(row, line)
    keep = (hi - lo > 2) & (hit[hi - 1] - hit[lo] >= CONFIRM * (hi - lo - 1))
    lo, hi = lo[keep], hi[keep]
    place = np.flatnonzero((bigrams[at] == pair) & (row[1:] == row[:-1]) & (line[1:] == line[:-1]))
    apart = (np.diff(place) > GAP) | (np.diff(row[place]) != 0) | (np.diff(line[place]) != 0)
    begin = np.flatnonzero(np.concatenate(([True], apart))) if len(place) else np.zeros(0, np.int64)
    size = np.diff(np.append(begin, len(place)))
    some = np.add.reduceat(np.isin(pair[place], own), begin) if len(place) else size
    begin, size = begin[(size > 1) & (some > 0)], size[(size > 1) & (some > 0)]
    c_lo, c_hi = place[begin], place[begin + size - 1] + 1
    return (starts[lo], ends[hi - 1], row[lo]), (starts[c_lo], ends[c_hi], row[c_lo])


def _sampled(batches):
    """The SAMPLE_UNITS paragraphs of least hash of each document."""
    for batch in bounded(batches):
        data, offsets = utf8(batch.column("text"))
        data = LOWER[data]
        starts, ends, row = words(data, offsets, ALNUM)
        ids, texts = [], []
        if len(starts):
            lo, hi = paragraphs(row, np.concatenate(([0], np.cumsum(data == 0x0A)))[starts])
            a, b = starts[lo], ends[hi - 1]
            order = np.lexsort((a, Ranges(data).of(a, b), row[lo]))
            place = np.arange(len(order)) - np.searchsorted(row[lo][order], row[lo][order])
            for i in order[place < SAMPLE_UNITS]:
                ids.append(batch.column("doc_id")[int(row[lo[i]])].as_py())
                texts.append(data[a[i] : b[i]].tobytes().decode())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])


def scan(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """Per document row: doc_id, families (array, sorted), n_paragraphs (of a licence), and found: an array of
    (family, probability, text) in order."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = narrow(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    ids = docs.select(F.col("doc_id").alias("s_id")).where("s_id is not null").orderBy(F.xxhash64("s_id"), "s_id").limit(SAMPLE_DOCS).distinct()
    sample = docs.join(F.broadcast(ids), F.col("doc_id") == F.col("s_id"), "left_semi").mapInArrow(_sampled, "doc_id long, text string").distinct().orderBy("doc_id", "text")
    model = Classifier([w for r in sample.collect() if len(w := word_list(r.text)) > 1], templates)  # SAMPLE_UNITS paragraphs of a document stored once

    def hashes(bigrams: set) -> np.ndarray:
        joined = b"\n".join(b" ".join(g) for g in sorted(bigrams))
        data, offsets = np.frombuffer(joined, np.uint8), np.array([0, len(joined)])
        starts, ends, _ = words(data, offsets, ALNUM)
        return np.unique(runs(Ranges(data).of(starts, ends), 2)[::2])

    sent = spark.sparkContext.broadcast((model, hashes(model.any_bigram), hashes(set().union(*model.own))))

    def find(batches):
        model, bigrams, own = sent.value
        for batch in bounded(batches):
            data, offsets = utf8(batch.column("text"))
            data = LOWER[data]
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            places: list[list[tuple[int, int]]] = [[] for _ in range(batch.num_rows)]

            def add(r, a, b, family, p):
                found[r].append({"family": family, "probability": p, "text": data[a:b].tobytes().decode()})  # noqa: B023
                places[r].append((int(a), int(b)))  # noqa: B023

            whole, clusters = units(data, offsets, bigrams, own)
            for a, b, r in zip(*whole, strict=True):
                family, p = model.classify(WORDS.findall(data[a:b].tobytes()))
                if family != UNKNOWN:
                    add(r, a, b, family, p)
            for a, b, r in zip(*clusters, strict=True):
                at = list(WORDS.finditer(data[a:b].tobytes()))
                for lo, hi, family, p in model.notices([m.group() for m in at]):
                    begin, end = a + at[lo].start(), a + at[hi - 1].end()
                    if not any(x["family"] == family and begin < d and c < end for x, (c, d) in zip(found[r], places[r], strict=True)):
                        add(r, begin, end, family, p)
            for r in range(batch.num_rows):
                if len(found[r]) > 1:
                    found[r] = [found[r][i] for i in sorted(range(len(found[r])), key=places[r].__getitem__)]
            kind = pa.list_(pa.struct([("family", pa.string()), ("probability", pa.float64()), ("text", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([sorted({x["family"] for x in f}) for f in found], pa.list_(pa.string())), pa.array([len(f) for f in found], pa.int64()), pa.array(found, kind)],
                ["doc_id", "families", "n_paragraphs", "found"],
            )

    return docs.mapInArrow(find, "doc_id long, families array<string>, n_paragraphs long, found array<struct<family:string,probability:double,text:string>>")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.array_join("families", ",").alias("families"), "n_paragraphs", F.coalesce(F.array_max(F.transform("found", lambda x: x["probability"])), F.lit(0.0)).alias("probability"))
