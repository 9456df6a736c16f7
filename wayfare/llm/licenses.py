"""License scans: MinHash bands over overlapping windows find templates, shingle containment confirms them.

A template of n words is looked for in windows that begin every n // 8 words
and are long enough to hold n words with a quarter more between them.  Of each
window that shares a shingle with a template the task takes as many MinHash
values, each a band of its own, as it needs for a true match to share one with
probability ``1 - MISS``.  A shared band only names a candidate: a match has at
least ``percent`` of the template's shingles in the window itself.  Nothing is
shuffled; a hot text costs its own task what it costs once.

Words are runs of ASCII digits, ASCII letters (lower-cased) and characters
beyond ASCII; a template of fewer words than a shingle is one shingle of all
its words.  Null, empty and short texts match nothing they don't hold.  Repeated
rows are scanned each by itself; templates with equal words are reported each.
Other columns pass through; one named like the added column is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from wayfare.llm import anchors, flat

SHINGLE = 5
CONTAINED = 80  # percent
MISS = 1e-6

#: License notices as they stand in files and on pages, and sentences of the licenses' texts.  Fixed values.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    # Notices of one family are cut to the words that tell them apart: one other word leaves less than 80 % of the shingles.
    ("GPL-2.0-or-later", "terms of the GNU General Public License as published by the Free Software Foundation, either "
                         "version 2 of the License"),
    ("GPL-3.0-or-later", "terms of the GNU General Public License as published by the Free Software Foundation, either "
                         "version 3 of the License"),
    ("LGPL-2.0-or-later", "terms of the GNU Library General Public License as published by the Free Software Foundation, "
                          "either version 2 of the License"),
    ("LGPL-2.1-or-later", "terms of the GNU Lesser General Public License as published by the Free Software Foundation, "
                          "either version 2.1 of the License"),
    ("LGPL-3.0-or-later", "terms of the GNU Lesser General Public License as published by the Free Software Foundation, "
                          "either version 3 of the License"),
    ("AGPL-3.0-or-later", "terms of the GNU Affero General Public License as published by the Free Software Foundation, "
                          "either version 3 of the License"),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
                        "International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 "
                        "International License."),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
                "rights to this software to the public domain worldwide."),
    ("CC0-1.0-waiver", "has waived all copyright and related or neighboring rights to"),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License v1.0 which accompanies this distribution"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0 which is available at"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    # Sentences of the licenses' own texts.
    ("Apache-2.0-text", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR "
                        "USE, REPRODUCTION, AND DISTRIBUTION"),
    ("GPL-2.0-text", "This General Public License applies to most of the Free Software Foundation's software and to any "
                     "other program whose authors commit to using it."),
    ("GPL-3.0-text", "We, the Free Software Foundation, use the GNU General Public License for most of our software; it "
                     "applies also to any other work released this way by its authors."),
    ("LGPL-2.1-text", "This license, the Lesser General Public License, applies to some specially designated software "
                      "packages--typically libraries--of the Free Software Foundation and other authors who decide to use it."),
    ("LGPL-3.0-text", "This version of the GNU Lesser General Public License incorporates the terms and conditions of "
                      "version 3 of the GNU General Public License, supplemented by the additional permissions listed below."),
    ("AGPL-3.0-text", "specifically designed to ensure cooperation with the community in the case of network server software"),
    ("MPL-2.0-text", "means each individual or legal entity that creates, contributes to the creation of, or owns Covered "
                     "Software."),
    ("EPL-text", "any use, reproduction or distribution of the program constitutes recipient's acceptance of this agreement."),
    ("ISC-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                 "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-2-Clause", "in the documentation and/or other materials provided with the distribution. This software is provided "
                     "by the copyright holders"),
    ("BSD-3-Clause", "nor the names of its contributors may be used to endorse or promote products derived from this "
                     "software without specific prior written permission."),
    ("BSD-4-Clause", "All advertising materials mentioning features or use of this software must display the following "
                     "acknowledgement"),
    ("Zlib-text", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
                  "be held liable for any damages arising from the use of this software."),
    ("BSL-1.0-text", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
                     "software and accompanying documentation covered by this license"),
)

MATCHES = T.ArrayType(T.StructType([
    T.StructField("license", T.StringType(), False), T.StructField("word", T.LongType(), False),
    T.StructField("n_shingles", T.LongType(), False), T.StructField("n_found", T.LongType(), False),
]), False)


@dataclass(frozen=True)
class Template:
    name: str
    n_words: int
    shingles: np.ndarray  # sorted, distinct
    size: int  # words of a shingle
    values: np.ndarray  # one MinHash value for each band

    @property
    def step(self) -> int:
        return max(1, self.n_words // 8)

    @property
    def window(self) -> int:
        """Words of a window: wherever the template begins, some window holds it whole with a quarter more."""
        return self.n_words + self.n_words // 4 + self.step


def bands_needed(shingles: int, window_shingles: int, percent: int, miss: float) -> int:
    """Single-value bands with which a window that holds ``percent`` of the shingles shares one but for ``miss``."""
    held = -(-shingles * percent // 100)
    least = held / (window_shingles + shingles - held)
    return 1 if least >= 1 else math.ceil(math.log(miss) / math.log(1 - least))


def _mixers(n: int) -> np.ndarray:
    return np.random.default_rng(4242).integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1)


def _values(shingles: np.ndarray, count: int) -> np.ndarray:
    """MinHash values of each row of a matrix of shingles."""
    return np.stack([flat.mix(shingles ^ m).min(axis=-1) for m in _mixers(count)], axis=-1)


def prepare(templates: tuple[tuple[str, str], ...], shingle: int, percent: int, miss: float) -> list[Template]:
    """Templates with their shingles and bands; those without words are left out."""
    out = []
    for name, text in templates:
        raw, at = flat.flat_bytes(pa.array([text]))
        starts, ends, first = flat.word_spans(raw, at, flat.ALNUM_WORD)
        if not len(starts):
            continue
        words = flat.word_hashes(raw, starts, ends, flat.FOLDED_VALUES)
        size = min(shingle, len(words))
        shingles = np.unique(flat.Windows(words).all(size))
        shape = Template(name, len(words), shingles, size, np.zeros(0, np.uint64))
        count = bands_needed(len(shingles), shape.window - size + 1, percent, miss)
        out.append(Template(name, len(words), shingles, size, _values(shingles[None, :], count)[0]))
    return out


def find(texts: pa.Array, templates: list[Template], percent: int) -> tuple[np.ndarray, list[list[dict]]]:
    """Words of each text, and of each template its best window there, the first among equals."""
    raw, at = flat.flat_bytes(texts)
    starts, ends, first = flat.word_spans(raw, at, flat.ALNUM_WORD)
    words = flat.word_hashes(raw, starts, ends, flat.FOLDED_VALUES)
    found: list[list[dict]] = [[] for _ in range(len(texts))]
    windows = flat.Windows(words)
    for size in sorted({t.size for t in templates}):
        hashes = windows.all(size)
        known = np.unique(np.concatenate([t.shingles for t in templates if t.size == size]))
        place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        met = np.flatnonzero((known[place] == hashes) & anchors.whole(first, size)) if len(hashes) else np.zeros(0, np.int64)
        row = np.searchsorted(first, met, "right") - 1
        for template in (t for t in templates if t.size == size):
            _scan(template, hashes, met, row, first, percent, found)
    return np.diff(first), found


def _scan(template: Template, hashes, met, row, first, percent: int, found: list[list[dict]]) -> None:
    """Add the template's matches among the windows that hold one of the known shingles."""
    if not len(met):
        return
    reach = template.window - template.size + 1  # shingles of a window
    inner = met - first[row]
    last = inner // template.step
    count = np.minimum(last + 1, -(-reach // template.step))
    number = np.repeat(last - count + 1, count) + flat.ragged_arange(np.zeros(len(count), np.int64), count)
    rows = np.repeat(row, count)
    keep = inner.repeat(count) - number * template.step < reach
    pair = np.unique(np.stack([rows[keep], number[keep]]), axis=1)
    for part in range(0, pair.shape[1], 1 << 13):
        rows, begin = pair[0, part : part + (1 << 13)], pair[1, part : part + (1 << 13)] * template.step
        # a window at the end of its text has fewer shingles; its last one stands in for the missing
        place = np.minimum(begin[:, None] + np.arange(reach), (first[rows + 1] - first[rows] - template.size)[:, None])
        inside = hashes[place + first[rows][:, None]]
        candidate = (_values(inside, len(template.values)) == template.values).any(axis=1)
        rows, begin, inside = rows[candidate], begin[candidate], inside[candidate]
        held = (inside[:, :, None] == template.shingles).any(axis=1).sum(axis=1)
        for i in np.flatnonzero(100 * held >= percent * len(template.shingles)):
            match = {"license": template.name, "word": int(begin[i]), "n_shingles": len(template.shingles), "n_found": int(held[i])}
            own = found[rows[i]]
            if own and own[-1]["license"] == template.name:
                if own[-1]["n_found"] < match["n_found"]:
                    own[-1] = match
            else:
                own.append(match)


def scan(
    docs: DataFrame, *, text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, shingle: int = SHINGLE,
    percent: int = CONTAINED, miss: float = MISS, out: str = "licenses",
) -> DataFrame:
    """Add the best match of every template found in the whole text, by name, and ``n_words``."""
    prepared = sorted(prepare(templates, shingle, percent, miss), key=lambda t: t.name)
    docs = docs.drop(out, "n_words")
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType(), False), T.StructField(out, MATCHES, False)])
    kind = pa.list_(pa.field("element", pa.struct([
        pa.field("license", pa.string(), False), *(pa.field(n, pa.int64(), False) for n in ("word", "n_shingles", "n_found")),
    ]), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in flat.chunks(batches, text):
            n_words, found = find(rows.column(text), prepared, percent)
            matches = [sorted(x, key=lambda m: m["license"]) for x in found]
            yield rows.append_column("n_words", pa.array(n_words)).append_column(out, pa.array(matches, kind))

    return docs.mapInArrow(run, schema)
