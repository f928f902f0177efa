"""License scans: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lendgrid.llm.frames import slices
from lendgrid.llm.words import number_texts, plain_words

SHINGLE = 5
CONTAINMENT = 0.8
#: Bands of one row each. A window as long as the template that holds 0.8 of its shingles has a Jaccard similarity of 2/3 at
#: least, and is retrieved with probability 1 - (1/3)**12 > 0.999998; an exact copy always.
BANDS = 12

#: Public license notices (fixed values).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

_FACTORS = np.random.default_rng(5).integers(1, 1 << 63, BANDS, np.uint64) * np.uint64(2) + np.uint64(1)
_NEVER = np.uint64((1 << 64) - 1)


def shingles(words: list[str]) -> list[tuple[str, ...]]:
    """The shingles of a text in order; a shorter text is one shingle."""
    return [tuple(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))] if words else []


def _shingle_numbers(words: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """A number for the ``width`` words from each place on; places near the end of a text get the largest number."""
    n = len(words)
    out = np.full(n, _NEVER)
    if n >= width:
        value = np.zeros(n - width + 1, np.uint64)
        for i in range(width):
            value = (value ^ words[i:n - width + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(31)
        out[:len(value)] = value
        last = np.concatenate([np.arange(max(0, e - width + 1), e) for e in ends.tolist()]) if len(ends) else np.empty(0, np.int64)
        out[last] = _NEVER
    return out


def _rank(numbers: np.ndarray, band: int) -> np.ndarray:
    mixed = numbers * _FACTORS[band]
    mixed ^= mixed >> np.uint64(32)
    mixed[numbers == _NEVER] = _NEVER
    return mixed


class _Templates:
    def __init__(self, templates):
        self.names = [name for name, _ in templates]
        self.words = [plain_words(text) for _, text in templates]
        self.shingles = [set(shingles(w)) for w in self.words]
        # templates of fewer than SHINGLE words are looked up by their own length
        self.classes: dict[tuple[int, int], list[tuple[int, list[int]]]] = {}
        for t, words in enumerate(self.words):
            if words:
                width = min(SHINGLE, len(words))
                flat, ends = number_texts(pa.array([" ".join(words)], pa.string()))
                own = _shingle_numbers(flat, ends, width)
                own = own[own != _NEVER]
                self.classes.setdefault((width, len(own)), []).append((t, [int(_rank(own, b).min()) for b in range(BANDS)]))


def _window_minima(ranks: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
    """The smallest rank of the windows of each size; windows at the end are shorter."""
    out, level, have = {}, ranks, 1
    for size in sorted(sizes):
        while 2 * have <= size:
            level = np.minimum(level, np.concatenate([level[have:], np.full(min(have, len(level)), _NEVER)]))
            have *= 2
        rest = size - have
        out[size] = np.minimum(level, np.concatenate([level[rest:], np.full(min(rest, len(level)), _NEVER)])) if rest else level
    return out


def _scan(batches, templates):
    known = _Templates(templates)
    for part in slices(batches, "text", 2 << 20):
        ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
        flat, ends = number_texts(part.column(1))
        candidates: dict[tuple[int, int], set[int]] = {}
        for width in sorted({w for w, _ in known.classes}):
            values = _shingle_numbers(flat, ends, width)
            sizes = [m for w, m in known.classes if w == width]
            for band in range(BANDS):
                for size, minima in _window_minima(_rank(values, band), sizes).items():
                    for t, ranks in known.classes[width, size]:
                        at = np.flatnonzero(minima == np.uint64(ranks[band]))
                        for doc, place in zip(np.searchsorted(ends, at, "right").tolist(), at.tolist()):
                            candidates.setdefault((doc, t), set()).add(place)
        found: dict[tuple[int, str], list] = {}
        cache: dict[int, list[str]] = {}
        for (doc, t), places in candidates.items():
            words = cache.get(doc) or cache.setdefault(doc, plain_words(texts[doc]))
            begin = int(ends[doc - 1]) if doc else 0
            own, length = known.shingles[t], len(known.words[t])
            for place in sorted(places):
                window = shingles(words[place - begin:place - begin + length])
                share = len(own.intersection(window)) / len(own)
                if share >= CONTAINMENT:
                    found.setdefault((doc, known.names[t]), []).append((place - begin, place - begin + length, share))
        rows = []
        for (doc, name), spans in sorted(found.items()):
            spans.sort()
            runs, stop = 0, -1
            for a, b, _ in spans:
                runs += a >= stop
                stop = max(stop, b)
            rows.append((ids[doc], name, max(s for _, _, s in spans), runs, spans[0][0]))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(zip(*rows) if rows else [[]] * 5, (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()))],
                                         names=["doc_id", "license", "containment", "n_places", "first_word"])


def scan_licenses(docs: DataFrame, templates=TEMPLATES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id license containment n_places first_word``: one row for each license found in a row's text.

    Windows as long as a template slide over all words (lower case, without punctuation at their ends). A window is verified if
    it shares a template's smallest shingle rank in one of ``BANDS`` bands; a verified window holds ``CONTAINMENT`` or more of
    the template's 5-word shingles. ``n_places`` counts separate places and ``first_word`` is the first one's first word.
    Texts without words have no row; repeated rows are scanned each. Templates are a short, fixed table, the only thing that
    tasks are sent; texts are scanned where they are read.
    """
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return texts.mapInArrow(lambda batches: _scan(batches, templates), "doc_id long, license string, containment double, n_places long, first_word long")
