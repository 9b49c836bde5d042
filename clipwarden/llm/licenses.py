"""License notices: winnowed fingerprints pick candidates, banded alignment reports coverage and spans.

Texts are compared as words of letters and digits, lower-cased. Of each window of `WINDOW` grams of `GRAM`
words the least hash is a fingerprint; a stretch of `GRAM` + `WINDOW` - 1 equal words always has one. The
templates' fingerprints form an inverted index (bounded by the templates, a parameter). A fingerprint of a
text that is in the index names a template and a diagonal; near it, words are aligned within a band of
`BAND` insertions or deletions. A hit covers at least `COVERAGE` of the template's words; of hits that
overlap, the one with the most matched words stays.

Defined results: null, empty and short texts have no hit; a template that occurs several times has several
hits; ties go to the template that is named first; repeated rows give repeated hits; an empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clipwarden.llm.common import id_and_text, text_rows
from clipwarden.llm.words import WordHasher, blocks

GRAM, WINDOW, BAND, COVERAGE = 3, 2, 8, 0.6

# Notices of public licenses, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def comparable(text: bytes) -> bytes:
    """The text with A-Z lowered and every ASCII byte but letters and digits as a space; offsets stay."""
    table = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
    return text.lower().translate(table)


def fingerprints(grams: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the least gram of each window, the last one of equal ones."""
    if len(grams) <= window:
        return np.array([len(grams) - 1 - int(np.argmin(grams[::-1]))] if len(grams) else [], np.int64)
    spans = np.lib.stride_tricks.sliding_window_view(grams, window)
    last = window - 1 - np.argmin(spans[:, ::-1], 1)
    return np.unique(last + np.arange(len(spans)))


def align(text: np.ndarray, template: np.ndarray, diagonal: int, band: int = BAND) -> tuple[int, int, int]:
    """(matched words, first, end) of the best alignment of `template` to `text` near `diagonal`.

    Cell (i, k) stands for template word i against text word i + diagonal + k - band. A match scores 2, a word
    skipped or replaced -1; an alignment begins and ends with a match.
    """
    width = 2 * band + 1
    score, matched, first = np.zeros(width, int), np.zeros(width, int), np.full(width, -1)
    best = (0, 0, 0, 0)
    for i, word in enumerate(template.tolist()):
        new_score, new_matched, new_first = np.zeros(width, int), np.zeros(width, int), np.full(width, -1)
        for k in range(width):
            j = i + diagonal + k - band
            if not 0 <= j < len(text):
                continue
            options = []
            if int(text[j]) == word:
                options.append((score[k] + 2, matched[k] + 1, first[k] if score[k] > 0 else j))
            elif score[k] > 1:
                options.append((score[k] - 1, matched[k], first[k]))
            if k + 1 < width and score[k + 1] > 1:  # a template word is left out
                options.append((score[k + 1] - 1, matched[k + 1], first[k + 1]))
            if k and new_score[k - 1] > 1:  # a text word is put in
                options.append((new_score[k - 1] - 1, new_matched[k - 1], new_first[k - 1]))
            if options:
                new_score[k], new_matched[k], new_first[k] = max(options, key=lambda o: (o[0], o[1]))
                if int(text[j]) == word and new_score[k] > best[0]:
                    best = (int(new_score[k]), int(new_matched[k]), int(new_first[k]), j + 1)
        score, matched, first = new_score, new_matched, new_first
    return best[1:]


class Index:
    """Inverted index from fingerprints to (template, place)."""

    def __init__(self, templates: Sequence[tuple[str, str]], hasher: WordHasher) -> None:
        self.names, self.words = [n for n, _ in templates], []
        self.places: dict[int, list[tuple[int, int]]] = {}
        for t, (_, text) in enumerate(templates):
            found = hasher([comparable(text.encode())])
            self.words.append(found.hashes)
            grams = found.windows(GRAM, 9)
            for at in fingerprints(grams).tolist():
                self.places.setdefault(int(grams[at]), []).append((t, at))
        self.hashes = np.array(sorted(self.places), np.uint64)

    def hits(self, words: np.ndarray, grams: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(template, matched, first, end) in words, without overlaps."""
        near = sorted({(t, (place - p) // BAND) for place in at.tolist() for t, p in self.places[int(grams[place])]})
        found = set()
        for t, step in near:
            left = words.copy()
            while True:  # what is found is struck out, until no further copy lies near
                matched, first, end = align(left, self.words[t], step * BAND + BAND // 2, BAND + BAND // 2)
                if not matched or matched < COVERAGE * len(self.words[t]):
                    break
                found.add((t, matched, first, end))
                left[first:end] = 0
        kept: list[tuple[int, int, int, int]] = []
        for hit in sorted(found, key=lambda h: (-h[1], h[3] - h[2], h[0], h[2])):
            if all(hit[3] <= k[2] or hit[2] >= k[3] for k in kept):
                kept.append(hit)
        return sorted(kept, key=lambda h: h[2])


def scan(
    df: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per hit: doc_id, license, template (its number), matched_words, coverage, start_char, end_char."""
    templates = tuple(templates)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        index = Index(templates, hasher)
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        names = ["doc_id", "license", "template", "matched_words", "coverage", "start_char", "end_char"]
        for keys, texts in blocks(text_rows(batches)):
            found = hasher([comparable(t) for t in texts])
            grams = found.windows(GRAM, 9)
            in_index = np.flatnonzero(np.isin(grams, index.hashes))
            if not len(in_index):
                continue
            owner = np.searchsorted(found.first, in_index, side="right") - 1
            begins = np.cumsum([0] + [len(t) + 1 for t in texts])
            out = []
            for i in np.unique(owner).tolist():
                a, z = int(found.first[i]), int(found.first[i + 1])
                own = grams[a : max(a, z - GRAM + 1)]
                at = np.intersect1d(fingerprints(own), in_index[owner == i] - a)
                if not len(at):
                    continue
                for t, matched, first, end in index.hits(found.hashes[a:z], own, at):
                    bounds = [int(found.starts[a + first] - begins[i]), int(found.ends[a + end - 1] - begins[i])]
                    chars = [len(texts[i][:b].decode()) for b in bounds]
                    out.append((keys[i], index.names[t], t, matched, matched / len(index.words[t]), *chars))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return id_and_text(df, id_col, text_col).mapInArrow(
        run,
        "doc_id bigint, license string, template int, matched_words bigint, coverage double, "
        "start_char bigint, end_char bigint",
    )
