"""License scans by Dice coefficient over word bigrams.

The units compared are the lines of a text, its paragraphs (lines between empty lines), the
whole text and, for notices that are none of these, windows of as many words as a template has.
A unit and a template are normalised to lower-case words without punctuation and
reduced to their sets of word bigrams; their likeness is 2 * common / (sizes of both). Since
common is at most the smaller size, a template is a candidate only if its size lies within
``threshold / (2 - threshold)`` of the unit's and the inverse; a unit that shares too few
bigrams with a template is never compared with it. Candidates are compared on their words.

Windows are looked at where so many of a template's bigrams lie within its length; the likeness of
all windows there follows from where each bigram enters and leaves them. Of adjacent windows that
match, the most alike is a unit, unless it overlaps a matching line, paragraph or text of as many
words or more, a more alike window of about its size, or a window too large to be compared with it.

Defined cases: null and empty texts have no unit; very long texts are scanned whole; units of one word have no bigram and match
nothing; ties between templates go to the name that sorts first; repeated rows get equal
results; an empty table gives an empty result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ridelake.llm.textbytes import PLAIN, Words, pair, pieces

THRESHOLD = 0.8

#: Wordings that licences are declared with and, from license_texts, whole licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Public-Domain": "This work is dedicated to the public domain under CC0 1.0.",
} | {
    file.name.removesuffix(".txt"): file.read_text(encoding="utf-8")
    for file in sorted(resources.files("ridelake.llm").joinpath("license_texts").iterdir(), key=lambda file: file.name)
    if file.name.endswith(".txt")
}


def _bigrams(words: Words) -> np.ndarray:
    """Name of the two words that start at every word but the last."""
    hashes = words.hashes()
    return pair(hashes[:-1], hashes[1:]) if len(hashes) > 1 else np.zeros(0, np.uint64)


def _set_of(words: list[bytes]) -> set[tuple[bytes, bytes]]:
    return set(zip(words, words[1:]))


def _units(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end word and text of all lines, paragraphs and whole texts that have two words or more."""
    data, at = words.bytes, words.text_at
    newline = np.flatnonzero(data == 0x0A)
    # A paragraph ends at a newline that follows another with only white space between.
    word_at = np.searchsorted(words.starts, newline)
    empty = np.zeros(len(newline), bool)
    if len(newline) > 1:
        solid = np.concatenate([[0], np.cumsum((data != 0x20) & ((data < 0x09) | (data > 0x0D)))])
        empty[1:] = solid[newline[1:]] == solid[newline[:-1]]
    cuts = [np.union1d(words.at, word_at), np.union1d(words.at, word_at[empty]), np.unique(words.at)]
    first = np.concatenate([c[:-1] for c in cuts])
    end = np.concatenate([c[1:] for c in cuts])
    kept = end - first >= 2
    first, end = first[kept], end[kept]
    text = np.searchsorted(words.at, first, side="right") - 1
    spans, where = np.unique(np.stack([first, end]), axis=1, return_index=True)
    return spans[0], spans[1], text[where]


class Matcher:
    def __init__(self, templates: dict[str, str], threshold: float):
        self.threshold = threshold
        self.names = sorted(templates)
        parsed = [Words(pa.array([templates[name]]), PLAIN, lower=True) for name in self.names]
        self.sets = [_set_of(self._words(w, 0, len(w))) for w in parsed]
        self.sizes = np.array([len(s) for s in self.sets])
        self.lengths = np.array([max(0, len(w) - 1) for w in parsed])
        bigrams = [np.unique(_bigrams(w)) for w in parsed]
        known = np.concatenate(bigrams or [np.zeros(0, np.uint64)])
        order = np.argsort(known, kind="stable")
        self.known, first = np.unique(known[order], return_index=True)
        #: The templates that hold a known bigram: those from its place in ``first`` to the next.
        self.first = np.append(first, len(known))
        self.holders = np.repeat(np.arange(len(bigrams)), [len(b) for b in bigrams])[order]
        self.bound = threshold / (2 - threshold)
        self.least, self.most = self.sizes * self.bound, self.sizes / self.bound
        #: Dice >= threshold needs at least so many common bigrams.
        self.needed = np.maximum(1, np.ceil(self.least - 1e-9).astype(np.int64))

    @staticmethod
    def _words(words: Words, first: int, end: int) -> list[bytes]:
        data = words.bytes
        return [data[a:b].tobytes() for a, b in zip(words.starts[first:end], words.ends[first:end])]

    def _places(self, names: np.ndarray, text_of: np.ndarray) -> list[np.ndarray]:
        """For every template the places of its bigrams, ascending."""
        place = np.minimum(np.searchsorted(self.known, names), len(self.known) - 1)
        at = np.flatnonzero((self.known[place] == names) & (text_of[:-1] == text_of[1:]))
        begin, n = self.first[place[at]], self.first[place[at] + 1] - self.first[place[at]]
        each = np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())
        holder = self.holders[each]
        order = np.argsort(holder, kind="stable")
        return np.split(np.repeat(at, n)[order], np.searchsorted(holder[order], np.arange(1, len(self.names))))

    def _dice(self, words: Words, first: int, end: int, j: int) -> float:
        unit = _set_of(self._words(words, first, end))
        return 2 * len(unit & self.sets[j]) / (len(unit) + len(self.sets[j]))

    def _windows(self, words: Words, names: np.ndarray, text_of: np.ndarray, j: int, at: np.ndarray) -> Iterator[tuple]:
        """text, first word, end word, likeness and name: the most alike of adjacent windows that match a template."""
        k, size = self.needed[j], self.lengths[j]
        if not size or len(at) < k:
            return
        head, last = at[: len(at) - k + 1], at[k - 1 :]
        near = (last - head < size) & (text_of[head] == text_of[last])
        head, last = head[near], last[near]
        if not len(head):
            return
        # Stretches in which a window can match; a text that is no longer than the template is a unit already.
        low = np.maximum(last - size + 1, words.at[text_of[head]])
        high = np.minimum(head + size, words.at[text_of[head] + 1] - 1)
        new = np.ones(len(low), bool)
        new[1:] = low[1:] > np.maximum.accumulate(high)[:-1]
        starts = np.flatnonzero(new)
        for a, b in zip(low[starts].tolist(), np.maximum.reduceat(high, starts).tolist()):
            n = b - a - size + 1
            if n < 1:
                continue
            part = names[a:b]
            order = np.argsort(part, kind="stable")
            before = np.full(len(part), -1)
            same = part[order[1:]] == part[order[:-1]]
            before[order[1:][same]] = order[:-1][same]
            mine = np.zeros(len(part), bool)
            mine[at[np.searchsorted(at, a) : np.searchsorted(at, b)] - a] = True
            # A bigram is new to the windows that start after its last occurrence and reach it.
            place = np.arange(len(part))
            enters, leaves = np.maximum(before, place - size) + 1, np.minimum(place, n - 1) + 1
            counts = []
            for some in (leaves > enters, (leaves > enters) & mine):
                change = np.bincount(enters[some], minlength=n + 1) - np.bincount(leaves[some], minlength=n + 1)
                counts.append(np.cumsum(change)[:n])
            dice = 2 * counts[1] / (counts[0] + self.sizes[j])
            good = np.flatnonzero(dice >= self.threshold)
            for run in np.split(good, np.flatnonzero(np.diff(good) > 1) + 1) if len(good) else ():
                first = a + int(run[np.argmax(dice[run])])
                end = first + int(size) + 1
                alike = self._dice(words, first, end, j)
                if alike >= self.threshold:
                    yield int(text_of[first]), first, end, alike, self.names[j]

    def best(self, texts: pa.Array) -> list[tuple[str | None, float, int]]:
        """Per text: the most alike template at or above the threshold, its likeness, and the units that match one."""
        out: list[tuple[str | None, float, int]] = [(None, 0.0, 0)] * len(texts)
        words = Words(texts, PLAIN, lower=True)
        names = _bigrams(words)
        if not len(names) or not self.names:
            return out
        text_of = words.text_of()
        places = self._places(names, text_of)
        first, end, text = _units(words)
        enough = np.array([np.searchsorted(at, end - 1) - np.searchsorted(at, first) for at in places]) >= self.needed[:, None]
        matched: dict[int, list[tuple[int, int]]] = {}

        def add(k: int, a: int, b: int, dice: float, name: str) -> None:
            best_name, best_dice, n = out[k]
            better = best_name is None or (-dice, name) < (-best_dice, best_name)
            out[k] = (name, dice, n + 1) if better else (best_name, best_dice, n + 1)
            matched.setdefault(k, []).append((a, b))

        for u in np.flatnonzero(enough.any(axis=0)).tolist():
            a, b = int(first[u]), int(end[u])
            templates = np.flatnonzero(enough[:, u])
            size = len(np.unique(names[a : b - 1]))
            templates = templates[(self.least[templates] <= size + 1e-9) & (size <= self.most[templates] + 1e-9)]
            likely = [(-self._dice(words, a, b, j), self.names[j]) for j in templates.tolist()]
            if likely and -min(likely)[0] >= self.threshold:
                add(int(text[u]), a, b, -min(likely)[0], min(likely)[1])
        windows = [found for j, at in enumerate(places) for found in self._windows(words, names, text_of, j, at)]
        rivals: dict[int, list[tuple]] = {}
        for k, a, b, dice, name in sorted(windows, key=lambda w: (-w[3], w[1] - w[2], w[4], w[1])):
            within = any(a < d and c < b and d - c >= b - a for c, d in matched.get(k, ()))
            near = [w for w in rivals.get(k, ()) if a < w[1] and w[0] < b]
            if not within and all(min(b - a, w[1] - w[0]) < self.bound * max(b - a, w[1] - w[0]) for w in near):
                rivals.setdefault(k, []).append((a, b, dice, name))
        for k, found in rivals.items():
            for a, b, dice, name in found:
                if not any(a < d and c < b and b - a < self.bound * (d - c) for c, d, _, _ in found):
                    add(k, a, b, dice, name)
        return out


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, license (the most alike template, null if none), dice and n_units (units that match a template)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(templates, threshold)
        for batch in batches:
            for piece in pieces(batch):
                names, dice, n = zip(*matcher.best(piece.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(names, pa.string()), pa.array(dice, pa.float64()), pa.array(n, pa.int64())],
                    ["doc_id", "license", "dice", "n_units"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, license string, dice double, n_units long")
