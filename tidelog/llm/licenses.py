"""License scans: winnowed fingerprints find candidates, banded alignment measures them.

Texts are compared by normalised words (lower case, ASCII punctuation left out).  Of
every ``SPREAD`` successive hashes of ``GRAM`` words the smallest is a fingerprint;
an inverted index maps it to places in templates.  A document's fingerprints are
looked up, hits of a template along one diagonal are a candidate, and a banded
alignment of template and document gives matched words and the span.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import rolling, rows_of, text_bytes, word_hashes

# a copy of GRAM + SPREAD - 1 words shares a fingerprint for sure
GRAM, SPREAD = 3, 3
# templates of fewer words are found by each of their shorter grams: edits leave few of the longer ones
SHORT, SHORT_GRAM = 24, 2
# how far an alignment may leave the diagonal, in words; less for short templates
BAND = 8

_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_WORD = re.compile(rb"[^ ]+")

# fixed values: usual notices, as their licenses word them
TEMPLATES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
    "MIT line": "Released under the MIT License.",
    "MIT permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "ISC permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution."
    ),
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "GPL-2.0 notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version."
    ),
    "LGPL-3.0 notice": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version."
    ),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "CC BY 4.0 line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC BY 4.0 short line": "Licensed under CC BY 4.0.",
    "CC BY-ND 4.0 line": "Licensed under CC BY-ND 4.0.",
    "CC BY-SA 4.0 line": "Licensed under CC BY-SA 4.0.",
    "CC BY-NC 4.0 line": "Licensed under CC BY-NC 4.0.",
    "Unlicense notice": "This is free and unencumbered software released into the public domain.",
}


@dataclass(frozen=True)
class Match:
    template: int
    start: int  # words of the document
    end: int
    matched: int


def fingerprints(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the smallest of every ``SPREAD`` successive grams, of equal ones the last."""
    grams = rolling(hashes, min(GRAM, max(1, len(hashes))))
    if len(grams) <= SPREAD:
        at = np.arange(len(grams))
        at = at[grams == grams.min()][-1:] if len(grams) else at
        return at, grams[at]
    n = len(grams) - SPREAD + 1
    least, chosen = grams[:n].copy(), np.zeros(n, np.int64)
    for k in range(1, SPREAD):
        following = grams[k : k + n]
        better = following <= least
        np.copyto(least, following, where=better)
        chosen[better] = k
    at = np.unique(np.arange(n) + chosen)
    return at, grams[at]


def all_grams(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of every short gram."""
    grams = rolling(hashes, min(SHORT_GRAM, max(1, len(hashes))))
    return np.arange(len(grams)), grams


class Index:
    """Templates by fingerprint."""

    def __init__(self, words: list[np.ndarray], chosen: list[int], prints):
        self.prints = prints
        index: dict[int, list[tuple[int, int]]] = {}
        for t in chosen:
            for at, h in zip(*prints(words[t]), strict=True):
                index.setdefault(int(h), []).append((t, int(at)))
        self.index = index
        self.keys = np.sort(np.fromiter(index, np.uint64, len(index)))

    def hits(self, hashes: np.ndarray) -> set[tuple[int, int]]:
        """Templates that share a fingerprint with a document, and on which diagonal."""
        places, found = self.prints(hashes)
        if not len(self.keys) or not len(found):
            return set()
        near = np.searchsorted(self.keys, found).clip(max=len(self.keys) - 1)
        some = np.flatnonzero(self.keys[near] == found)
        return {(t, int(places[i]) - at) for i in some for t, at in self.index[int(found[i])]}


def band_of(template: Sequence[int]) -> int:
    return min(BAND, len(template) // 4 + 1)


def align(template: Sequence[int], words: Sequence[int], diagonal: int) -> tuple[int, int, int]:
    """Most words of the template found in order near a diagonal, and their first and last place.

    ``diagonal`` is a document's place less the template's.  Returns matched words,
    start and end in the document; of equally good ones the one that ends first.
    """
    band = band_of(template)
    width = 2 * band + 1
    # score, and where its first match is; one cell for each offset from the diagonal
    scores, starts = [0] * width, [-1] * width
    best = (0, 0, 0)
    for i, w in enumerate(template):
        new, new_starts = [0] * width, [-1] * width
        for k in range(width):
            j = i + diagonal + k - band
            score, start = scores[k + 1] if k + 1 < width else 0, starts[k + 1] if k + 1 < width else -1
            if k and new[k - 1] > score:
                score, start = new[k - 1], new_starts[k - 1]
            if 0 <= j < len(words) and words[j] == w and scores[k] + 1 > score:
                score, start = scores[k] + 1, starts[k] if scores[k] else j
                if score > best[0]:
                    best = (score, start, j + 1)
            new[k], new_starts[k] = score, start
        scores, starts = new, new_starts
    return best


class Scanner:
    """Templates with their inverted index."""

    def __init__(self, templates: dict[str, str], min_coverage: float):
        self.names = list(templates)
        self.min_coverage = min_coverage
        self.words = word_hashes([t.encode().translate(_NORMAL) for t in templates.values()])
        short = [t for t, w in enumerate(self.words) if len(w) < SHORT]
        long = [t for t, w in enumerate(self.words) if len(w) >= SHORT]
        self.indexes = [Index(self.words, short, all_grams), Index(self.words, long, fingerprints)]

    def scan(self, hashes: np.ndarray) -> list[Match]:
        """Matches in a document's word hashes; where some overlap, the longest stays, of equal ones that with more of its template."""
        if not len(hashes):
            return []
        hits = sorted(set().union(*(index.hits(hashes) for index in self.indexes)))
        matches = set()
        last: tuple[int, int] | None = None
        for t, diagonal in hits:
            # diagonals of one copy lie within a band of the first of them
            size, band = len(self.words[t]), band_of(self.words[t])
            if last and last[0] == t and diagonal - last[1] <= band // 2:
                continue
            last = (t, diagonal)
            low = max(0, diagonal - band)
            part = hashes[low : max(0, diagonal + size + band)].tolist()
            matched, start, end = align(self.words[t].tolist(), part, diagonal - low)
            if matched >= self.min_coverage * size and end - start <= size + band:
                matches.add(Match(t, low + start, low + end, matched))
        kept: list[Match] = []
        taken = np.zeros(len(hashes), bool)
        for m in sorted(matches, key=lambda m: (-m.matched, len(self.words[m.template]), m.end - m.start, m.start, m.template)):
            if not taken[m.start : m.end].any():
                taken[m.start : m.end] = True
                kept.append(m)
        return sorted(kept, key=lambda m: m.start)


FOUND = (
    "doc_id bigint, license string, coverage double, matched_words int, template_words int, "
    "start_word int, end_word int, start_char int, end_char int"
)


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, min_coverage: float = 0.8) -> DataFrame:
    """One row per license text found: ``doc_id, license, coverage, matched_words,
    template_words, start_word, end_word, start_char, end_char``.

    ``coverage`` is the share of the template's words that the document has in order;
    spans are in normalised words and in characters of the whole text.  Documents stay
    where they are; templates, at most a megabyte of them, go along with the code.
    Null and empty texts have no license; repeated rows are reported each.
    """
    templates = TEMPLATES if templates is None else templates
    if sum(map(len, templates.values())) > 1 << 20:
        raise ValueError("templates have more than a megabyte; scan with them in parts")
    scanners: list[Scanner] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not scanners:
            scanners.append(Scanner(templates, min_coverage))
        scanner = scanners[0]
        kinds = [pa.int64(), pa.string(), pa.float64(), *[pa.int32()] * 6]
        names = [f.split()[0] for f in FOUND.split(", ")]
        for ids, texts in rows_of(batches, "doc_id", "text"):
            rows = []
            normals = [t.translate(_NORMAL) for t in texts]
            for doc_id, text, normal, hashes in zip(ids, texts, normals, word_hashes(normals), strict=True):
                matches = scanner.scan(hashes)
                places = [m.span() for m in _WORD.finditer(normal)] if matches else []
                for m in matches:
                    size = len(scanner.words[m.template])
                    ends = places[m.start][0], places[m.end - 1][1]
                    chars = (len(text[:e].decode()) for e in ends)
                    rows.append((doc_id, scanner.names[m.template], m.matched / size, m.matched, size, m.start, m.end, *chars))
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes()).mapInArrow(run, FOUND)
