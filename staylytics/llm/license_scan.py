"""License scan: winnowed fingerprints of templates pick candidates, banded alignment reports spans and coverage.

Templates and texts are sequences of words (runs of letters and digits, A-Z lower-cased). Of every ``window`` neighbouring
grams of words the one with the smallest hash is a fingerprint (``winnowed``), so two sequences that share a run of
``gram + window - 1`` words share a fingerprint. A match at ``least`` may miss n - need of a template's n words; unless words are
inserted in the text, its equal words then hold a run of ceil(need / (n - need + 1)), and gram and window of each template are chosen
to fit that run (``run_length``). The fingerprints form an inverted index.

Matches that winnowing cannot promise to find, of templates whose run is a single word or with words inserted in every run, come
from a supplement that is exact: a match holds one at least of any n - need + 1 places of the template, so the words at so many of
its places, rare ones first, are looked up as well. What they hit outside the matches found so far is aligned too.

The neighbourhoods of the hits are aligned with the template inside a band around the diagonals hit, and what is left on
both sides of an alignment again, until nothing reaches ``least``. The template set is a parameter and bounds the index; texts
are only mapped, never shuffled.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import cache
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylytics.llm import text as tx

GRAM = 3  # words of a fingerprint, fewer where a template's run is shorter
BAND = 8  # words an alignment may drift beyond the diagonals hit
MATCH, OTHER, GAP = 2, -1, -1  # scores of the alignment

# Short notices and opening passages of widespread licenses; whole texts and headers lie in ``licenses``.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 opening": "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0",
    "BSD opening": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met",
    "CC-BY": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL opening": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by the Free Software Foundation",
    "ISC opening": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
    "the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT opening": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    "(the \"Software\"), to deal in the Software without restriction",
    "MPL-2.0 opening": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense opening": "This is free and unencumbered software released into the public domain.",
}


@cache
def production() -> dict[str, str]:
    """``TEMPLATES``, every whole license text ("<license> text") and every standard header ("<license> header")."""
    files = {f.name: f for f in resources.files("staylytics.llm").joinpath("licenses").iterdir() if f.name.endswith(".txt")}
    named = {n.removesuffix(".txt").replace(".header", " header") if ".header" in n else n.removesuffix(".txt") + " text": n for n in sorted(files)}
    return TEMPLATES | {name: files[n].read_text(encoding="utf-8") for name, n in named.items()}


@dataclass(frozen=True)
class Index:
    names: list[str]
    words: list[np.ndarray]
    vocabularies: list[tuple[np.ndarray, np.ndarray]]  # distinct words, ascending, and how often
    needs: list[int]  # equal words of a match
    places: dict[int, list[tuple[int, int]]]  # fingerprint: (template, place)
    prints: np.ndarray  # all of them, ascending
    grams: dict[tuple[int, int], tuple[np.ndarray, dict[int, list[tuple[int, int]]]]]  # by gram and window: hashes, (template, place)


def run_length(n: int, need: int) -> int:
    """Words in a row that ``need`` equal ones of ``n`` must hold: n - need others cut them in so many runs and one."""
    return -(-need // (n - need + 1))


def winnowed(words: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the fingerprints: the smallest gram hash of every window, the last of equal ones."""
    if len(words) < gram + window - 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    rolled = np.zeros(len(words) - gram + 1, np.uint64)
    for k in range(gram):
        rolled = tx.mix(rolled + words[k : k + len(rolled)])
    seen = np.lib.stride_tricks.sliding_window_view(rolled, window)[:, ::-1]
    places = np.unique(np.arange(len(seen)) + window - 1 - seen.argmin(1))
    return places, rolled[places]


def index(templates: Mapping[str, str], least: float) -> Index:
    """Templates without words have no fingerprints and are never found."""
    names = sorted(templates)
    words = []
    for name in names:
        _, data, offsets = next(tx.pieces(pa.array([templates[name]])))
        words.append(tx.terms(data, offsets)[0])
    common = Counter(w for t in words for w in t.tolist())
    needs = [max(1, math.ceil(least * len(t) - 1e-9)) for t in words]
    places = defaultdict(list)
    grams: dict[tuple[int, int], dict[int, list]] = defaultdict(lambda: defaultdict(list))
    for t, hashed in enumerate(words):
        run = run_length(len(hashed), needs[t]) if len(hashed) else 0
        if run > 1:
            shape = min(GRAM, run), run - min(GRAM, run) + 1
            for at, value in zip(*(x.tolist() for x in winnowed(hashed, *shape)), strict=True):
                grams[shape][value].append((t, at))
        rare = sorted(range(len(hashed)), key=lambda i: (common[int(hashed[i])], i))
        for at in rare[: len(hashed) - needs[t] + 1]:
            places[int(hashed[at])].append((t, at))
    vocabularies = [np.unique(t, return_counts=True) for t in words]
    by_shape = {shape: (np.array(sorted(found), np.uint64), dict(found)) for shape, found in grams.items()}
    return Index(names, words, vocabularies, needs, dict(places), np.array(sorted(places), np.uint64), by_shape)


def align(template: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int, int]:
    """Best local alignment with (text place - template place) between ``low`` and ``high``.

    Returns (score, equal words, first and last + 1 word of the text); of equal scores the one that ends first.
    """
    low, high = max(low, -len(template)), min(high, len(text))
    width = high - low + 1
    best = (0, 0, 0, 0)
    if width <= 0:
        return best
    across = np.arange(width)
    padded = np.zeros(len(template) + width + 1, text.dtype)  # words at low, low + 1, ...
    a, b = max(0, low), min(len(text), low + len(padded))
    padded[a - low : b - low] = text[a:b]
    score, same, start = np.zeros((3, width + 1), np.int64)  # of the row above, by diagonal; one closed diagonal at the end
    for i, word in enumerate(template):
        j = across + i + low
        equal = padded[i : i + width] == word
        fresh = score[:-1] == 0
        cell = score[:-1] + np.where(equal, MATCH, OTHER)
        hits, first = np.where(fresh, 0, same[:-1]) + equal, np.where(fresh, j, start[:-1])
        up = score[1:] + GAP
        better = (up > cell) & (score[1:] > 0)
        cell, hits, first = np.where(better, up, cell), np.where(better, same[1:], hits), np.where(better, start[1:], first)
        cell[(j < 0) | (j >= len(text)) | (cell < 0)] = 0
        slope = cell - GAP * across
        top = np.maximum.accumulate(slope)
        source = np.maximum.accumulate(np.where(slope == top, across, 0))
        row = top + GAP * across
        row[(j < 0) | (j >= len(text)) | (row < 0)] = 0
        score[:-1], same[:-1], start[:-1] = row, hits[source], first[source]
        k = int(row.argmax())
        if row[k] > best[0]:
            best = (int(row[k]), int(same[k]), int(start[k]), int(j[k]) + 1)
    return best


def _codes(hashed: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """Place of each word among the distinct ones, their number if it is none of them."""
    at = np.minimum(np.searchsorted(distinct, hashed), len(distinct) - 1)
    return np.where(distinct[at] == hashed, at, len(distinct))


def _common(codes: np.ndarray, times: np.ndarray) -> int:
    """Words in common with a template, each counted as often as both have it: no alignment has more equal words."""
    return int(np.minimum(np.bincount(codes, minlength=len(times) + 1)[:-1], times).sum())


def _within(template: np.ndarray, times: np.ndarray, need: int, text: np.ndarray, codes: np.ndarray, ats: np.ndarray, diagonals: np.ndarray, lo: int, hi: int) -> list[tuple[int, int, int]]:
    """(equal words, first word, last word + 1) of the matches between ``lo`` and ``hi``: the best, then those beside it."""
    out, open_ = [], [(lo, hi)]
    while open_:
        a, b = open_.pop()
        x, y = np.searchsorted(ats, (a, b))
        if x == y or b - a < need or _common(codes[a:b], times) < need:
            continue
        low, high = int(diagonals[x:y].min()) - BAND - a, int(diagonals[x:y].max()) + BAND - a
        _, equal, first, end = align(template, text[a:b], low, high)
        if not equal:
            continue
        if equal >= need:
            out.append((equal, a + first, a + end))
        open_ += [(a, a + first), (a + end, b)]
    return out


def _hits(at: np.ndarray, values: np.ndarray, known: np.ndarray, places: dict[int, list[tuple[int, int]]], out: dict[int, list]) -> None:
    """Add (place in the text, diagonal) of the values that the index knows, by template."""
    if not len(known) or not len(values):
        return
    here = np.flatnonzero(known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values)
    for x, value in zip(at[here].tolist(), values[here].tolist(), strict=True):
        for t, place in places[value]:
            out[t].append((x, x - place))


def _aligned(found: list[tuple[int, int]], template: np.ndarray, times: np.ndarray, need: int, hashed: np.ndarray, codes: np.ndarray, lo: int, hi: int) -> list[tuple[int, int, int]]:
    """(equal words, first word, last word + 1) of the matches between ``lo`` and ``hi`` around hits that lie there."""
    n, out = len(template), []
    regions: list[list[int]] = []
    for diagonal in sorted({d for _, d in found}):
        a, b = max(lo, diagonal - BAND), min(hi, diagonal + n + BAND)
        if a >= b:
            continue
        if regions and a <= regions[-1][1]:
            regions[-1][1] = max(b, regions[-1][1])
        else:
            regions.append([a, b])
    ats, diagonals = np.array(sorted(found), np.int64).T
    half = 3 * n + 2 * BAND  # no alignment of positive score is longer than 3 n
    for a, b in regions:
        while b - a >= need:
            end = min(b, a + 2 * half)
            matches = _within(template, times, need, hashed, codes, ats, diagonals, a, end)
            whole = [m for m in matches if end == b or m[1] < a + half]
            out += whole
            a = b if end == b else max([a + half, *(m[2] for m in whole)])
    return out


def scan(hashed: np.ndarray, ix: Index) -> list[tuple[int, int, int, int]]:
    """(template, equal words, first word, last word + 1) of every match that has the words its template needs."""
    printed: dict[int, list] = defaultdict(list)
    for shape, (known, places) in ix.grams.items():
        _hits(*winnowed(hashed, *shape), known, places, printed)
    single: dict[int, list] = defaultdict(list)
    _hits(np.arange(len(hashed)), hashed, ix.prints, ix.places, single)
    out = []
    for t in sorted({*printed, *single}):
        template, need = ix.words[t], ix.needs[t]
        if len(hashed) < need:
            continue
        distinct, times = ix.vocabularies[t]
        codes = _codes(hashed, distinct)
        if _common(codes, times) < need:
            continue
        matches = _aligned(printed[t], template, times, need, hashed, codes, 0, len(hashed)) if printed[t] else []
        # the supplement, between the matches that fingerprints led to
        lo, more = 0, []
        for _, first, end in [*sorted(matches, key=lambda m: m[1]), (0, len(hashed), len(hashed))]:
            rest = [h for h in single[t] if lo <= h[0] < first] if first - lo >= need else []
            if rest:
                more += _aligned(rest, template, times, need, hashed, codes, lo, first)
            lo = end
        out += [(t, *m) for m in matches + more]
    return sorted(out, key=lambda m: (m[2], m[3], m[0]))


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] | None = None, least: float = 0.8) -> DataFrame:
    """One row per match in the rows of ``docs`` (doc_id, text): doc_id, license, start, length, matched, words, coverage.

    ``start`` and ``length`` are code points of the whole text; ``coverage`` is the share of the template's ``words`` that
    the alignment pairs with equal words, at least ``least``. Templates are matched each by itself: a license text is found as
    its opening and as a whole, and of two versions of a header the one with the higher coverage is meant. Matches of one template never overlap. Null and empty texts
    give no row; repeated rows are scanned each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index(production() if templates is None else templates, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        for batch in batches:
            rows = []
            for first, data, offsets in tx.pieces(batch.column("text")):
                hashed, places, starts, ends = tx.terms(data, offsets)
                for i in range(len(offsets) - 1):
                    a, b = places[i], places[i + 1]
                    found = scan(hashed[a:b], ix)
                    if not found:
                        continue
                    points = np.concatenate([[0], np.cumsum((data[offsets[i] : offsets[i + 1]] & 0xC0) != 0x80)])
                    for t, equal, x, y in found:
                        start, end = points[starts[a + x] - offsets[i]], points[ends[a + y - 1] - offsets[i]]
                        n = len(ix.words[t])
                        rows.append((first + i, ix.names[t], int(start), int(end - start), equal, n, equal / n))
            taken = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(taken), *(pa.array([r[k] for r in rows], kind) for k, kind in
                 ((1, pa.string()), (2, pa.int64()), (3, pa.int64()), (4, pa.int64()), (5, pa.int64()), (6, pa.float64())))],
                names=["doc_id", "license", "start", "length", "matched", "words", "coverage"],
            )

    schema = "doc_id long, license string, start long, length long, matched long, words long, coverage double"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
