"""License scans: MinHash bands over overlapping text windows retrieve license templates.

A text is cut into shingles of five words. Windows a little longer than a template, set at
steps of a quarter of it, are summed up by MinHash; the bands are chosen so that a window
around a passage with 0.8 of a template's shingles shares a band with it almost surely.
Templates that a window retrieves are verified by exact shingle containment.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import values

SHINGLE = 5
#: Shingles of the templates that one pass over the texts looks for; a larger catalogue takes several.
PASS_SHINGLES = 200_000
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

# Notices and telling sentences of well-known public licenses. A text under BSD-3-Clause
# holds the conditions of BSD-2-Clause too, so both are named; one under BSD-2-Clause names it alone.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-2-Clause", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
)


def shingles_of(text: str | None) -> np.ndarray:
    """Hashes of the runs of five words, in order; a shorter text is one shingle, none is empty."""
    words = WORD.findall((text or "").encode().lower())
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    size = min(SHINGLE, len(words))
    out = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for i in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(out)]
    return _mixed(out ^ np.uint64(size))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def band_settings(similarity: float, miss: float = 1e-4, most_rows: int = 4) -> tuple[int, int]:
    """(bands, rows) with the fewest hashes so that sets of this Jaccard similarity miss each other with less than ``miss``."""
    if similarity >= 1:
        return 1, 1
    choices = [(ceil(log(miss) / log(1 - similarity**rows)), rows) for rows in range(1, most_rows + 1)]
    return min(choices, key=lambda c: (c[0] * c[1], -c[1]))


@dataclass(frozen=True)
class Template:
    license: str
    shingles: np.ndarray


@dataclass(frozen=True)
class Layout:
    """Windows of ``reach`` blocks of ``step`` shingles, one at each block, for a class of template sizes."""

    step: int
    reach: int
    bands: int
    rows: int


def layout(size: int, containment: float) -> Layout:
    """Windows for a template of ``size`` shingles: a quarter longer than the class's largest.

    Sizes are classed in steps of a quarter, so the number of layouts grows with the logarithm
    of the largest template. The similarity guaranteed is that of the class's smallest.
    """
    least, top = 1, 1
    while top < size:
        least = top + 1
        top = max(top + 1, top * 5 // 4)
    step = max(1, top // 4)
    reach = -(-top // step) + (step > 1)
    shared = ceil(containment * least)
    return Layout(step, reach, *band_settings(shared / (reach * step + least - shared)))


class Scanner:
    """Finds the templates of a catalogue in texts."""

    def __init__(self, templates: list[Template], containment: float = 0.8):
        self.templates, self.containment = templates, containment
        classes: dict[Layout, list[int]] = {}
        for i, t in enumerate(templates):
            classes.setdefault(layout(len(t.shingles), containment), []).append(i)
        most = max((c.bands * c.rows for c in classes), default=0)
        self.factors = np.random.default_rng(20).integers(1, 1 << 63, size=most, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.keys = {}
        for c, ids in classes.items():
            minima = [np.array([self._hashed(templates[t].shingles, i).min() for t in ids]) for i in range(c.bands * c.rows)]
            self.keys[c] = [(np.sort(k), np.array(ids)[np.argsort(k, kind="stable")]) for k in self._bands(minima, c.rows)]
        self.sets = [np.unique(t.shingles) for t in templates]

    def _hashed(self, shingles: np.ndarray, i: int) -> np.ndarray:
        x = shingles * self.factors[i]
        return x ^ (x >> np.uint64(32))

    def _bands(self, minima: list[np.ndarray], rows: int) -> Iterator[np.ndarray]:
        for b in range(0, len(minima), rows):
            key = minima[b]
            for m in minima[b + 1 : b + rows]:
                key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + m)
            yield key

    def find(self, texts: list[str | None]) -> list[list[tuple[int, int, int, float]]]:
        """For each text, (template, first shingle, shingles, containment) of the best place of each template in it.

        The texts' shingles are laid end to end. A window may reach into a neighbouring text,
        which takes no passage out of its reach; the verification stays inside one text.
        """
        parts = [shingles_of(t) for t in texts]
        ends = np.cumsum([len(p) for p in parts])
        found: list[dict[int, tuple[int, int, int, float]]] = [{} for _ in texts]
        shingles = np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)
        if not len(shingles):
            return [[] for _ in texts]
        hashed = [self._hashed(shingles, i) for i in range(len(self.factors))]
        for c, tables in self.keys.items():
            starts = np.arange(0, len(shingles), c.step)
            minima = []
            for x in hashed[: c.bands * c.rows]:
                least = x if c.step == 1 else np.minimum.reduceat(x, starts)
                over = least.copy()
                for shift in range(1, min(c.reach, len(least))):
                    np.minimum(over[:-shift], least[shift:], out=over[:-shift])
                minima.append(over)
            for key, (known, ids) in zip(self._bands(minima, c.rows), tables):
                at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                for window in np.flatnonzero(known[at] == key).tolist():
                    lo, hi = np.searchsorted(known, key[window], "left"), np.searchsorted(known, key[window], "right")
                    first, last = window * c.step, min((window + c.reach) * c.step, len(shingles))
                    for doc in range(int(np.searchsorted(ends, first, "right")), int(np.searchsorted(ends, last - 1, "right")) + 1):
                        begin = int(ends[doc]) - len(parts[doc])
                        for t in ids[lo:hi].tolist():
                            self._verify(t, parts[doc], max(0, first - begin), last - begin, found[doc])
        return [sorted(f.values()) for f in found]

    def _verify(self, t: int, shingles: np.ndarray, start: int, end: int, found: dict) -> None:
        here, wanted = shingles[start:end], self.sets[t]
        inside = np.isin(here, wanted)
        share = len(np.unique(here[inside])) / len(wanted)
        if share < self.containment:
            return
        at = np.flatnonzero(inside)
        new = (t, start + int(at[0]), int(at[-1] - at[0]) + 1, share)
        if t not in found or (-share, new[1], new[2]) < (-found[t][3], found[t][1], found[t][2]):
            found[t] = new


def catalogue(templates) -> list[Template]:
    """Templates with a word, in a fixed order; equal ones of one license count once."""
    out = {(name, shingles.tobytes()): Template(name, shingles) for name, text in templates if len(shingles := shingles_of(text))}
    return list(out.values())


def scan(docs: DataFrame, templates=TEMPLATES, id_column: str = "doc_id", text_column: str = "text", containment: float = 0.8) -> DataFrame:
    """Rows (id, licenses, matches, best): for each document the sorted licenses whose template it holds.

    ``matches`` counts the templates found and ``best`` is the largest share of a template's
    shingles. Null and empty texts match nothing. A template of fewer than five words is one
    shingle, found only in a text of just these words. Repeated rows give repeated results;
    an empty table or catalogue gives rows without licenses. ``templates`` are pairs (license,
    text) of any number: each row meets all of them in one task, PASS_SHINGLES at a time, so
    tables of the whole catalogue are in each worker's memory (some 150 bytes a shingle).
    """
    known = catalogue(templates)
    passes: list[list[Template]] = [[]]
    for t in known:
        if passes[-1] and sum(len(x.shingles) for x in passes[-1]) + len(t.shingles) > PASS_SHINGLES:
            passes.append([])
        passes[-1].append(t)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(_searcher(passes, containment), "id long, licenses array<string>, matches long, best double")


def _group(texts: Iterator, most: int = 2_000_000) -> list:
    """The next texts of some two million characters together."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text or "")
        if size >= most:
            break
    return group


def _searcher(passes: list[list[Template]], containment: float):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanners = [Scanner(templates, containment) for templates in passes]
        for batch in batches:
            texts = values(batch.column(1))
            found: list[list[tuple[str, float]]] = []
            while group := _group(texts):
                by_pass = [s.find(group) for s in scanners]
                found += [[(s.templates[m[0]].license, m[3]) for s, f in zip(scanners, by_pass) for m in f[i]] for i in range(len(group))]
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([sorted({name for name, _ in f}) for f in found], pa.list_(pa.string())),
                pa.array([len(f) for f in found], pa.int64()),
                pa.array([max((share for _, share in f), default=0.0) for f in found], pa.float64()),
            ], ["id", "licenses", "matches", "best"])

    return of_batches
