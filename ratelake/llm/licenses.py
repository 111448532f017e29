"""License scans: MinHash bands over overlapping text windows, then exact shingle containment.

A template is a list of words. Texts are read as words too, and windows as long as a template slide over
them in steps of at most an eighth of its shingles, so some window is off by a sixteenth at most and is like
the template to 0.88 where the text holds it whole. Twelve bands of two minima retrieve a window of likeness
J with probability 1 - (1 - J**2)**12: 0.9999 at 0.75, 0.99 at 0.56. Around a retrieved window the template's
five-word shingles are looked up one by one; a share of SIMILARITY or more is a finding.

Templates are a bounded list, so their bands travel with the task; texts are never exchanged.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm.common import table, utf8

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 2
#: Words of short texts that are scanned together.
TOGETHER = 30_000
#: Words whose hash a task keeps; beyond, it starts anew.
CACHE = 400_000
WORD = re.compile(rb"[a-z0-9\x80-\xff]+")

#: Notices and texts of public licenses by SPDX id, fixed values.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
}


def _words(text: str) -> list[bytes]:
    return WORD.findall(text.lower().encode())


def _shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 32-bit hash of each `width` words in turn, from the words' hashes."""
    count = len(hashes) - width + 1
    mixed = np.zeros(max(count, 0), np.uint64)
    for i in range(width if count > 0 else 0):
        mixed = (mixed ^ hashes[i : i + count]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed >> np.uint64(16)).astype(np.uint32)


class Scanner:
    """The templates by number of shingles, with the minima of their bands."""

    def __init__(self, templates: Mapping[str, list[str]], shingle: int = SHINGLE, similarity: float = SIMILARITY):
        self.shingle, self.similarity = shingle, similarity
        random = np.random.default_rng(1)
        self.factors = random.integers(1 << 31, size=BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.known: dict[bytes, int] = {}
        self.classes: dict[int, list[tuple[str, np.ndarray, list[np.uint32]]]] = {}
        for name, texts in sorted(templates.items()):
            for text in texts:
                words = _words(text)
                own = _shingles(self.hashes(words), min(shingle, len(words)))
                if len(words) < shingle:
                    raise ValueError(f"a template of {name} has fewer words than a shingle")
                signature = [(own * f).min() for f in self.factors]
                self.classes.setdefault(len(own), []).append((name, np.unique(own), signature))

    def hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > CACHE:
            known.clear()
        for word in set(words).difference(known):
            known[word] = zlib.crc32(word) | zlib.adler32(word) << 32
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def scan(self, words: list[bytes]) -> list[tuple[str, int, int, float]]:
        """(license, first word, word behind the last, containment) of each finding, by place."""
        return self.scan_many([words])[0]

    def scan_many(self, texts: list[list[bytes]]) -> list[list[tuple[str, int, int, float]]]:
        """The findings of each text. Windows slide over all texts at once; a finding lies within one."""
        gap = [b"\n"] * self.shingle  # no word, so no shingle of two texts is one of a template
        starts, joined = [], []
        for words in texts:
            starts.append(len(joined))
            joined += words
            joined += gap
        joined += gap[:1] * max(self.classes)  # so that a window fits on a text shorter than its template
        shingles = _shingles(self.hashes(joined), self.shingle)
        hits = self._retrieved(shingles)
        found: list[list] = [[] for _ in texts]
        for name, own, width, places in hits:
            for place in places:
                # The window may reach over an edge, so each text it touches is looked at.
                first = max(0, int(np.searchsorted(starts, place - width // 2, "right")) - 1)
                last = int(np.searchsorted(starts, place + width + width // 2, "left"))
                for text in range(first, last):
                    low, high = starts[text], starts[text] + len(texts[text]) - self.shingle + 1
                    for _, a, b, share in self._verified(name, own, shingles, place, width, low, high):
                        found[text].append((name, a - low, b - low, share))
        return [self._settled(own) for own in found]

    def _retrieved(self, shingles: np.ndarray) -> list[tuple[str, np.ndarray, int, list[int]]]:
        """(license, its shingles, their number, window places) wherever a band of a template's minima fits."""
        n = len(shingles)
        hit = {(w, t): None for w, templates in self.classes.items() if w <= n for t in range(len(templates))}
        for band in range(0, BANDS * ROWS, ROWS):
            match: dict = {}
            for row in range(band, band + ROWS):
                levels = {1: shingles * self.factors[row]}
                for width, templates in self.classes.items():
                    if width > n:
                        continue
                    half = 1 << (width.bit_length() - 1)
                    while half not in levels:
                        done = max(levels)
                        levels[2 * done] = np.minimum(levels[done][:-done], levels[done][done:])
                    step, count, level = max(1, width // 8), n - width + 1, levels[half]
                    least = np.minimum(level[:count:step], level[width - half : width - half + count : step])
                    for t, (_, _, signature) in enumerate(templates):
                        same = least == signature[row]
                        match[width, t] = same if (width, t) not in match else match[width, t] & same
            for key, same in match.items():
                hit[key] = same if hit[key] is None else hit[key] | same
        out = []
        for (width, t), same in hit.items():
            name, own, _ = self.classes[width][t]
            places = (np.nonzero(same)[0] * max(1, width // 8)).tolist()
            if places:
                out.append((name, own, width, places))
        return out

    def _verified(self, name: str, own: np.ndarray, shingles: np.ndarray, start: int, width: int, floor: int, end: int) -> list:
        """The stretch of at most 1.25 widths around a window that holds most of a template, if it is enough."""
        low, high = max(floor, start - width // 2), min(end, start + width + width // 2)
        here = np.nonzero(np.isin(shingles[low:high], own))[0] + low
        best = (0.0, 0, 0)
        longest = width + width // 4
        for i in range(len(here)):
            inside = here[i : np.searchsorted(here, here[i] + longest)]
            share = len(np.unique(shingles[inside])) / len(own)
            if share > best[0]:
                best = (share, int(inside[0]), int(inside[-1]) + self.shingle)
        return [(name, best[1], best[2], best[0])] if best[0] >= self.similarity else []

    @staticmethod
    def _settled(found: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
        """Of findings that overlap the one with more words and then the larger share stays."""
        kept: list[tuple[str, int, int, float]] = []
        taken: list[tuple[int, int]] = []
        for one in sorted(set(found), key=lambda f: (-(f[2] - f[1]) * f[3], f)):
            if all(one[2] <= a or one[1] >= b for a, b in taken):
                kept.append(one)
                taken.append((one[1], one[2]))
        return sorted(kept, key=lambda f: f[1])


def _groups(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Texts with their words, together until they have TOGETHER words; a longer text stands alone."""
    group, size = [], 0
    for doc_id, raw in rows:
        raw = raw.as_py().lower()  # bytes: A-Z only, so no place moves
        words = WORD.findall(raw)
        if group and size + len(words) > TOGETHER:
            yield group
            group, size = [], 0
        group.append((doc_id, raw, words))
        size += len(words)
    if group:
        yield group


def licenses(
    docs: DataFrame, templates: Mapping[str, list[str]] = TEMPLATES, shingle: int = SHINGLE, similarity: float = SIMILARITY
) -> DataFrame:
    """(doc_id, license, start, end, containment) of each finding in the whole texts of `docs`.

    start and end are code points, end exclusive. Only doc_id and text are read; a text that is NULL, empty
    or shorter than a shingle has no findings, and neither has an empty table. Repeated rows repeat their
    findings. Very long texts are cut into overlapping windows, all of which are looked up. Of findings that overlap
    one stays. Words are runs of ASCII letters and digits and of all
    characters beyond ASCII, in lower case, so marks and line ends between words don't count.
    """
    templates = dict(templates)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, shingle, similarity)
        for batch in batches:
            rows = []
            for group in _groups(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)):
                for (doc_id, raw, _), hits in zip(group, scanner.scan_many([words for _, _, words in group]), strict=True):
                    if not hits:
                        continue
                    places = [m.span() for m in WORD.finditer(raw)]
                    for name, first, last, share in hits:
                        a, b = places[first][0], places[last - 1][1]
                        start = len(raw[:a].decode("utf-8", "replace"))
                        rows.append((doc_id, name, start, start + len(raw[a:b].decode("utf-8", "replace")), share))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "license", "start", "end", "containment"],
            )

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text")).alias("text"))
    return read.mapInArrow(work, "doc_id long, license string, start long, end long, containment double")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice in the documents."""
    return licenses(table(spark, sf_dir, "documents"))
