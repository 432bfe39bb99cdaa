"""Licence texts inside documents, by MinHash bands over overlapping windows.

Templates and documents are words of letters and digits in lower case. A
template is the set of its five-word shingles; templates are put in classes by
powers of two of their size, and each class reads documents in windows of twice
its size that overlap by half, so a template that occurs lies whole in a window
and makes up at least a quarter of it. With bands of one row the chance that no
band of such a window meets the template is at most 0.75 ** BANDS (one in
90,000). Windows that meet a template are verified: the share of the template's
shingles in the window, exactly, is at least ``LEAST``. Windows of one template
that follow each other are one find.

The templates are a small table, measured before it is sent to the tasks.

Defined cases: a null text or one below five words has no licence; templates
below five words are refused; rows that share a doc_id are searched each by
itself; a null doc_id is reported as null; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from odsflow.llm.text import mix, shingles, slices, span_hash, text_bytes, words

SIZE = 5
BANDS = 40
LEAST = 0.8
TEMPLATE_BYTES = 8 << 20

#: Notices and opening passages of public licences.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "MIT notice": "Released under the MIT License",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "BSD text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
}


def _lookups() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A") : ord("Z") + 1] += 32
    gap = np.ones(256, bool)
    for low, high in (("0", "9"), ("A", "Z"), ("a", "z")):
        gap[ord(low) : ord(high) + 1] = False
    gap[0x80:] = False
    return lower, gap


_LOWER, _GAP = _lookups()


def licence_shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = text_bytes(texts)
    starts, ends, first = words(data, bounds, _GAP[data])
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    return shingles(span_hash(_LOWER[data], starts, ends), first, SIZE)


def _minima(found: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The least value of each hash function in each span of ``found`` that begins at ``edges``."""
    out = np.empty((BANDS, len(edges)), np.uint64)
    for band in range(BANDS):
        # A cheap family: one multiplication per function over already mixed values.
        factor = np.uint64((2 * band + 1) * 0x9E3779B97F4A7C15 % 2**64 | 1)
        out[band] = np.minimum.reduceat(found * factor, edges)
    return out


class Templates:
    def __init__(self, texts: dict[str, str], least: float):
        self.names = list(texts)
        found, at = licence_shingles(pa.array(list(texts.values())))
        self.sets = [np.unique(found[a:b]) for a, b in zip(at, at[1:])]
        if any(not len(s) for s in self.sets):
            raise ValueError("a template needs five words")
        self.least = least
        self.classes = defaultdict(list)
        for i, own in enumerate(self.sets):
            self.classes[max(4, 1 << (len(own) - 1).bit_length())].append(i)
        self.bands = {}
        for size, members in self.classes.items():
            minima = [_minima(self.sets[i], np.array([0]))[:, 0] for i in members]
            table = [(band, value, i) for i, row in zip(members, minima) for band, value in enumerate(row)]
            keys = mix(np.array([v for _, v, _ in table], np.uint64) + np.array([b for b, _, _ in table], np.uint64))
            by = np.argsort(keys, kind="stable")
            self.bands[size] = (keys[by], np.array([i for _, _, i in table])[by])

    def search(self, texts: pa.Array) -> list[tuple[int, int, int, int, float]]:
        """(row, template, first word, end word, containment)."""
        found, at = licence_shingles(texts)
        out = []
        if not len(found):
            return out
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        for size, (keys, owners) in self.bands.items():
            # Blocks of ``size`` shingles; a window is a block and the next of the same text.
            place = np.arange(len(found)) - at[:-1][row]
            edges = np.flatnonzero(place % size == 0)
            minima = _minima(found, edges)
            follows = np.zeros(len(edges), bool)
            follows[:-1] = row[edges[1:]] == row[edges[:-1]]
            joined = minima.copy()
            joined[:, :-1] = np.where(follows[:-1], np.minimum(minima[:, :-1], minima[:, 1:]), minima[:, :-1])
            met = set()
            for band in range(BANDS):
                asked = mix(joined[band] + np.uint64(band))
                low, high = np.searchsorted(keys, asked), np.searchsorted(keys, asked, side="right")
                for window in np.flatnonzero(high > low).tolist():
                    met.update((int(owners[k]), window) for k in range(low[window], high[window]))
            stops = np.append(edges[1:], len(found))
            last = None
            for template, window in sorted(met):
                begin = edges[window]
                end = stops[window + 1] if follows[window] else stops[window]
                hits = np.flatnonzero(np.isin(found[begin:end], self.sets[template]))
                share = len(np.unique(found[begin:end][hits])) / len(self.sets[template])
                if share < self.least:
                    continue
                first = int(place[begin + hits[0]])
                stop = int(place[begin + hits[-1]]) + SIZE
                own = (int(row[begin]), template)
                if last == own and first < out[-1][3]:
                    _, _, before, until, best = out[-1]
                    out[-1] = (*own, before, max(until, stop), max(best, share))
                else:
                    out.append((*own, first, stop, share))
                last = own
        return out


def find_licences(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """doc_id, licence, first_word, end_word and containment of every licence text in a document."""
    texts = TEMPLATES if templates is None else templates
    if sum(len(t.encode()) for t in texts.values()) > TEMPLATE_BYTES:
        raise ValueError(f"templates above {TEMPLATE_BYTES} bytes")
    known = Templates(texts, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            hits = known.search(part.column("text"))
            columns = list(zip(*hits)) if hits else [()] * 5
            ids = part.column("doc_id").take(pa.array(columns[0], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([known.names[i] for i in columns[1]], pa.string()),
                    pa.array(columns[2], pa.int64()),
                    pa.array(columns[3], pa.int64()),
                    pa.array(columns[4], pa.float64()),
                ],
                names=["doc_id", "licence", "first_word", "end_word", "containment"],
            )

    schema = "doc_id long, licence string, first_word long, end_word long, containment double"
    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, schema)
