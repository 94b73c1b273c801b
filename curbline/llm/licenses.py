"""Licence scans: units of a text compared with licence templates by Dice coefficient over word bigrams.

Texts and templates are lower-cased and cut to words. A unit is a sentence, a line or the whole text, or
a window: any run of words, whatever line breaks it crosses. Windows are also compared with full texts.
The Dice coefficient of two bigram sets of sizes a and b is at least t only if each size is within
t / (2 - t) of the other and the overlap is at least t * (a + b) / 2; units that share too few bigrams
with all templates together, and templates of the wrong size, are never compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm import textbytes as tb

LEAST_DICE = 0.8
LEVELS = ("sentence", "line", "text")

# fixed values: the usual short notices of public licences
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Released under the ISC License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

#: read by the driver only
FULL_TEXTS = tuple((path.stem, path.read_text()) for path in sorted(Path(__file__).with_name("license_texts").glob("*.txt")))

_BREAK_AFTER = np.isin(np.arange(256), np.frombuffer(b".!?", dtype=np.uint8))


def unit_starts(data: np.ndarray, bounds: np.ndarray, level: str) -> np.ndarray:
    """Offsets at which the level's units begin; a sentence ends at a blank after . ! or ?"""
    if level == "text":
        return bounds[:-1]
    ends = data == 10
    if level == "sentence":
        blank = (data == 32) | (data == 9)
        ends[1:] |= blank[1:] & _BREAK_AFTER[data[:-1]]
    return np.unique(np.concatenate([bounds[:-1], np.flatnonzero(ends) + 1]))


def bigram_sets(texts: Sequence[str]) -> list[np.ndarray]:
    """The bigram hashes of each text, sorted, each once."""
    sets = []
    for _, _, data, bounds in tb.slices(pa.array(texts, pa.string()), most=1):
        data = tb.LOWER[data]
        starts, ends, _ = tb.words(data, bounds, tb.ALNUM)
        sets.append(np.unique(tb.gram_hashes(tb.span_hashes(tb.prefix_sums(data), starts, ends), 2)))
    return sets


def windows(grams: np.ndarray, template: np.ndarray, least: float) -> list[tuple[int, int, float]]:
    """Closest windows of one text: first and last bigram and Dice, none overlapping, from the left.

    The closest window begins and ends with a shared bigram, and with the first of its kind in it, as any
    other end could be cut off without loss; so only these are tried, each with all sizes in bounds.
    """
    size = len(template)
    fewest, most = size * least / (2 - least), size * (2 - least) / least
    hit = np.isin(grams, template)
    order = np.argsort(grams, kind="stable")
    previous = np.full(len(grams), -1)
    same = grams[order[1:]] == grams[order[:-1]]
    previous[order[1:][same]] = order[:-1][same]
    at = np.flatnonzero(hit)
    found: list[tuple[int, int, float]] = []
    after = -1
    for first in at.tolist():
        if first <= after:
            continue
        length = 2 * int(most) + 2
        while True:
            new = previous[first : first + length] < first
            sizes = np.cumsum(new)
            if sizes[-1] > most or first + length >= len(grams):
                break
            length *= 2
        shared = np.cumsum(new & hit[first : first + length])
        if shared[-1] < fewest:
            continue
        dice = np.where(sizes <= most, 2 * shared / (sizes + size), 0)
        end = int(dice.argmax())
        if dice[end] < least:
            continue
        # a later start before the end may be closer
        found.append((first, first + end, float(dice[end])))
        if dice[end] == 1:
            after = first + end
    kept: list[tuple[int, int, float]] = []
    for first, last, dice in sorted(found, key=lambda w: (-w[2], w[0])):
        if all(last < a or first > b for a, b, _ in kept):
            kept.append((first, last, dice))
    return sorted(kept)


def matcher(
    templates: Sequence[tuple[str, str]], least: float, full: Sequence[tuple[str, str]] = ()
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    sets = bigram_sets([text for _, text in templates])
    known = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
    sizes = np.array([len(s) for s in sets])
    smallest = sizes[sizes > 0].min() if (sizes > 0).any() else 1
    largest = sizes.max(initial=0)
    most = largest * (2 - least) / least
    # the least overlap of any match: least * (a + b) / 2 with b the smallest template and a its smallest partner
    few = least * smallest / (2 - least)
    table = np.zeros(1 << 16, dtype=bool)
    table[(known & np.uint64(0xFFFF)).astype(np.int64)] = True
    every = [*templates, *full]
    all_sets = [*sets, *bigram_sets([text for _, text in full])]
    fewest = np.array([len(s) * least / (2 - least) for s in all_sets])
    # each bigram of any template, and which templates have it
    grams_of, template_of = np.concatenate([known[:0], *all_sets]), np.repeat(np.arange(len(all_sets)), [len(s) for s in all_sets])
    order = np.argsort(grams_of, kind="stable")
    grams_of, template_of = grams_of[order], template_of[order]
    all_known = np.unique(grams_of)
    wide = np.zeros(1 << 16, dtype=bool)
    wide[(all_known & np.uint64(0xFFFF)).astype(np.int64)] = True
    match = pa.struct(
        [("level", pa.string()), ("start", pa.int32()), ("license", pa.string()), ("dice", pa.float64())]
    )

    def best(grams: np.ndarray) -> tuple[int, float]:
        """The closest template, the first of equals, and its coefficient; -1 if none is close enough."""
        found, score = -1, 0.0
        for i, template in enumerate(sets):
            a, b = len(grams), len(template)
            if not b or a * least > b * (2 - least) or b * least > a * (2 - least):
                continue
            dice = 2 * np.isin(grams, template, assume_unique=True).sum() / (a + b)
            if dice >= least and dice > score:
                found, score = i, float(dice)
        return found, score

    def in_windows(own: np.ndarray) -> list[tuple[int, int, float, int]]:
        """The windows of one text, closest first, and of equals the larger."""
        shared = np.unique(own)
        a, b = np.searchsorted(grams_of, shared), np.searchsorted(grams_of, shared, "right")
        counts = np.bincount(np.concatenate([template_of[:0], *[template_of[x:y] for x, y in zip(a, b) if x < y]]), minlength=len(every))
        likely = np.flatnonzero((counts > 0) & (counts >= fewest))
        found = [(*window, i) for i in likely.tolist() for window in windows(own, all_sets[i], least)]
        return sorted(found, key=lambda w: (-w[2], w[0] - w[1], w[0], w[3]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in tb.slices(batch.column(1)):
                data = tb.LOWER[data]
                starts, ends, of = tb.words(data, bounds, tb.ALNUM)
                grams = tb.gram_hashes(tb.span_hashes(tb.prefix_sums(data), starts, ends), 2)
                at = starts[: len(grams)]
                met = np.flatnonzero(wide[(grams & np.uint64(0xFFFF)).astype(np.int64)])
                met = met[np.isin(grams[met], all_known)]
                met = met[of[met] == of[met + 1]]
                hit = np.flatnonzero(table[(grams & np.uint64(0xFFFF)).astype(np.int64)])
                hit = hit[np.isin(grams[hit], known)]
                found: list[list] = [[] for _ in range(end - first)]
                taken = np.zeros(len(starts), dtype=bool)
                for level in LEVELS if len(hit) else ():
                    units = unit_starts(data, bounds, level)
                    unit_of = np.searchsorted(units, starts, side="right") - 1
                    inside = hit[unit_of[hit] == unit_of[hit + 1]]
                    shared = np.bincount(unit_of[inside], minlength=len(units))
                    for unit in np.flatnonzero(shared >= few):
                        a, b = np.searchsorted(unit_of, [unit, unit + 1])
                        own = np.unique(grams[a : b - 1])
                        if len(own) > most or len(own) * least > shared[unit] * (2 - least):
                            continue
                        which, dice = best(own)
                        if which >= 0:
                            text = int(of[a])
                            taken[a:b] = True
                            found[text].append(
                                {"level": level, "start": int(units[unit] - bounds[text]), "license": templates[which][0], "dice": dice}
                            )
                # a text is searched only if it has enough of some template's bigrams
                for text in np.flatnonzero(np.bincount(of[met], minlength=end - first) >= fewest[fewest > 0].min(initial=np.inf)).tolist():
                    a, b = np.searchsorted(of, [text, text + 1])
                    for left, right, dice, which in in_windows(grams[a : b - 1]):
                        own = slice(a + left, a + right + 2)
                        if 2 * taken[own].sum() >= right + 2 - left:
                            continue
                        taken[own] = True
                        found[text].append(
                            {"level": "window", "start": int(starts[a + left] - bounds[text]), "license": every[which][0], "dice": dice}
                        )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(found, pa.list_(match))], names=["id", "matches"]
                )

    return work


def scan(
    df: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    least: float = LEAST_DICE,
    doc_id: str = "doc_id",
    text: str = "text",
    full: Sequence[tuple[str, str]] = FULL_TEXTS,
) -> DataFrame:
    """One row per text: its id and `matches`, every unit whose closest template has a Dice of `least` or more.

    A match has its level (sentence, line, text or window), the byte its unit starts at, the licence and
    the coefficient. Windows are compared with `full` too, and reported where less than half of their
    words are in matches of the other levels or in closer windows. Units of fewer than two words have no bigrams and never match. Null and empty texts
    have no matches; rows with equal ids are separate texts; other columns are not read.
    """
    kind = df.schema[doc_id].dataType.simpleString()
    shape = f"id {kind}, matches array<struct<level:string,start:int,license:string,dice:double>>"
    found = df.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string")).mapInArrow(matcher(templates, least, full), shape)
    return found.select(F.col("id").alias(doc_id), "matches")
