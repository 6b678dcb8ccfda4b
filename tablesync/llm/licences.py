"""Operator 10: licence texts in documents, by Dice coefficient over word bigrams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.words import Words, run_hashes, word_blocks

_U = np.uint64

# Notices and texts of public licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES '
        "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
)


@dataclass
class Templates:
    names: list[str]
    grams: list[np.ndarray]
    every: np.ndarray  # all bigrams, sorted
    held: np.ndarray  # per template, which of them it holds

    @classmethod
    def of(cls, templates) -> Templates:
        """Templates without two words have no bigrams and match nothing."""
        names, grams = [], []
        for words in word_blocks(pa.array([t for _, t in templates], pa.string())):
            for k in range(words.hi - words.lo):
                found = np.unique(run_hashes(words.hashes[words.offsets[k] : words.offsets[k + 1]], 2))
                if len(found):
                    names.append(templates[words.lo + k][0])
                    grams.append(found)
        every = np.unique(np.concatenate([np.zeros(0, _U), *grams]))
        return cls(names, grams, every, np.array([np.isin(every, g) for g in grams]).reshape(len(grams), len(every)))


def _breaks(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of document k, which is not empty, before which a line and a paragraph end."""
    a, b = int(words.offsets[k]), int(words.offsets[k + 1])
    first, last = int(words.starts[a]), int(words.ends[b - 1])
    body = words.data[first:last]
    breaks = np.flatnonzero(body == 10)
    blank = np.concatenate([[0], np.cumsum((body != 32) & (body != 9) & (body != 10))])
    gaps = breaks[1:][blank[breaks[1:]] == blank[breaks[:-1]]] if len(breaks) > 1 else breaks[:0]
    lines = a + np.searchsorted(words.starts[a:b] - first, breaks)
    return lines, a + np.searchsorted(words.starts[a:b] - first, gaps)


def _units(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of the lines, paragraphs and whole text of document k, without empty ones."""
    a, b = int(words.offsets[k]), int(words.offsets[k + 1])
    if a == b:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lines, paragraphs = _breaks(words, k)
    ends = [np.concatenate([x, [b]]) for x in (lines, paragraphs, np.zeros(0, np.int64))]
    begins = [np.concatenate([[a], x[:-1]]) for x in ends]
    begin, end = np.concatenate(begins), np.concatenate(ends)
    return begin[end > begin], end[end > begin]


def _matches(words: Words, k: int, hits: np.ndarray, grams: np.ndarray, templates: Templates, threshold: float) -> dict[str, float]:
    """The best Dice coefficient of each licence that some unit of document k reaches the threshold for.

    A Dice coefficient of t asks that the smaller of two sets has at least t / (2 - t) times the size of the larger, and
    that they share t / 2 of both sizes: with the bigrams that occur in any template counted first, nearly every unit
    is ruled out before its set is built.
    """
    found: dict[str, float] = {}
    begin, end = _units(words, k)
    near = hits[np.maximum(end - 1, begin)] - hits[begin]
    low = threshold / (2 - threshold)
    for u in np.flatnonzero(near > 0):
        a, b, most = int(begin[u]), int(end[u]), int(near[u])
        if 2 * most < threshold * (most + min(len(g) for g in templates.grams)):
            continue
        own = None
        for name, gram in zip(templates.names, templates.grams, strict=True):
            if b - a - 1 < low * len(gram) or 2 * most < threshold * (low * len(gram) + len(gram)):
                continue
            own = np.unique(grams[a : b - 1]) if own is None else own
            if not low * len(gram) <= len(own) <= len(gram) / low:
                continue
            dice = 2 * len(np.intersect1d(own, gram, assume_unique=True)) / (len(own) + len(gram))
            if dice >= threshold:
                found[name] = max(found.get(name, 0.0), dice)
    return found


def _next_places(keys: np.ndarray, n_grams: int, span: int, starts: np.ndarray) -> np.ndarray:
    """Per start and bigram, its first place from there on, or ``span``; ``keys`` are bigram * (span + 1) + place, sorted."""
    base = np.arange(n_grams) * (span + 1)
    at = np.searchsorted(keys, base + starts[:, None])
    key = keys[np.minimum(at, len(keys) - 1)]
    return np.where((at < len(keys)) & (key < base + span + 1), key - base, span)


def _joined(words: Words, k: int, at: np.ndarray, hit: np.ndarray, grams: np.ndarray, templates: Templates, threshold: float, found: dict[str, float]) -> None:
    """Raise ``found`` to the best Dice coefficients of the runs of neighbouring lines of document k.

    A document that lacks t / (2 - t) of a template's bigrams is ruled out at once. A run is looked at only if its first line
    has a bigram of the template that does not come again in the run, and its last line one that was not there before: any
    other run is no better than the one without that line. So a template has few runs for each place of its bigrams.
    """
    a, b = int(words.offsets[k]), int(words.offsets[k + 1])
    places = np.flatnonzero(hit[a : max(b - 1, a)])
    low = threshold / (2 - threshold)
    least = np.array([int(np.ceil(low * len(g) - 1e-9)) for g in templates.grams])
    if not len(places) or len(places) < least.min():
        return
    here = at[a + places]
    enough = templates.held[:, np.unique(here)].sum(axis=1) >= least
    starts = None
    for t in np.flatnonzero(enough):
        name, size, need = templates.names[t], len(templates.grams[t]), max(int(least[t]), 1)
        if found.get(name) == 1.0:
            continue
        if starts is None:
            starts = np.unique(np.concatenate([[0], _breaks(words, k)[0] - a]))
            starts = starts[starts < b - a]
            ends = np.concatenate([starts[1:], [b - a]])
        mine = templates.held[t][here]
        own, which = np.unique(here[mine], return_inverse=True)
        span = b - a
        keys = np.sort(which * (span + 1) + places[mine])
        lines = np.unique(np.searchsorted(starts, places[mine], "right") - 1)
        for c in range(0, len(lines), 4096):
            part = lines[c : c + 4096]
            first = _next_places(keys, len(own), span, starts[part])
            again = _next_places(keys, len(own), span, ends[part])
            until = np.where(first < ends[part][:, None], again, 0).max(axis=1)
            first.sort(axis=1)
            for i in np.flatnonzero((first[:, need - 1] < span) & (first[:, need - 1] < until)):
                begin, f = int(starts[part[i]]), first[i]
                useful = f[need - 1 :]
                useful = useful[(useful < span) & (useful < until[i])]
                for end in np.unique(ends[np.searchsorted(starts, useful + 1, "right") - 1]):
                    n = len(np.unique(grams[a + begin : a + int(end) - 1]))
                    if n * low > size:
                        break
                    dice = 2 * int(np.searchsorted(f, end - 1)) / (n + size)
                    if dice >= threshold:
                        found[name] = max(found.get(name, 0.0), dice)


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """One row per document: doc_id, n_licences, licences (names, sorted, comma-joined), best, dice.

    Texts are normalised to words (A-Z lower-cased; runs of digits, letters and characters beyond ASCII). Every run of
    neighbouring lines, blank ones included, is compared with every (name, text) template, so every line, every paragraph,
    paragraphs that follow each other and the whole text: the Dice coefficient of their sets of word bigrams must reach ``threshold``. ``dice`` is the highest one, ``best`` its licence,
    the first by name among equals. A scan with no shuffle; the templates, a short list, go to every task.

    Null and empty texts, and units of fewer than two words, match nothing: n_licences 0, licences '', best and dice
    null. Repeated documents are judged row by row.
    """
    known = Templates.of([(n, t or "") for n, t in templates])
    id_type = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in word_blocks(batch.column(1)):
                grams = run_hashes(words.hashes, 2)
                at = np.minimum(np.searchsorted(known.every, grams), max(len(known.every) - 1, 0))
                hit = known.every[at] == grams if len(known.every) else np.zeros(len(grams), bool)
                hits = np.concatenate([[0], np.cumsum(hit)])
                rows = []
                for k in range(words.hi - words.lo):
                    found = _matches(words, k, hits, grams, known, threshold)
                    _joined(words, k, at, hit, grams, known, threshold, found)
                    best = min(found, key=lambda n: (-found[n], n), default=None)
                    rows.append((len(found), ",".join(sorted(found)), best, found.get(best)))
                n, names, best, dice = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(words.lo, words.hi - words.lo), pa.array(n, pa.int64()), pa.array(names, pa.string()),
                        pa.array(best, pa.string()), pa.array(dice, pa.float64()),
                    ],
                    names=["doc_id", "n_licences", "licences", "best", "dice"],
                )

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(scan, f"doc_id {id_type}, n_licences long, licences string, best string, dice double")
