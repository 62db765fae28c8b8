"""License scans: winnowed template fingerprints pick candidates, banded alignment decides.

Words are runs of letters and digits (bytes over 127 count as letters; A-Z as a-z).  Coverage of an alignment is
matched words / (template words + words inserted between them), and ``MIN_COVERAGE`` of it is reported.  A template of m
words then has so few breaks that some run of its words stands unbroken in the text: ``unbroken(m)`` words, 2 to 4.
The hashes of K words in a row (K = 2 or 3) of every template are winnowed (the smallest of each two neighbours
stays; short templates keep all), so that any such run holds one, into an inverted index hash -> (template, place).
All word runs of a text are looked up: every alignment that is covered enough has a candidate.  A candidate
whose surroundings don't hold enough of the template's words is dropped; around the diagonal of the others the
template is aligned with the text inside a band as wide as the drift that coverage allows.

Words that tell licenses apart have to match: numbers (versions), the family's word (Lesser, Affero), the third
clause's words; and no word may stand between GNU and the next.  Of findings that overlap in a text the one with
most matched words, less inserted ones, stays.

Word and run hashes are computed for a whole batch with array operations; only candidates reach Python
code.  The index holds the templates alone, a fixed few thousand entries.

Cases: null, empty and unlicensed texts have no row.  Equal candidates go by template order; repeated rows
and null ids give rows of their own.  An empty table gives an empty result.  Very long texts go whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

MIN_COVERAGE = 0.8

#: Wording of public license notices.
NOTICES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
           "files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, "
           "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
           "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
           "shall be included in all copies or substantial portions of the Software.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
           "provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
                    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
                    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
                    "with the distribution.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the "
                  "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
                    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
                    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
                    "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used "
                    "to endorse or promote products derived from this software without specific prior written permission.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
               "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
               "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
               "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
                 "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
                 "commercial or non-commercial, and by any means.",
}
#: Names that stand in one-line statements.
NAMES = {
    "MIT": ("the MIT License",),
    "Apache-2.0": ("the Apache License, Version 2.0",),
    "GPL-2.0": ("the GNU General Public License, version 2",),
    "GPL-3.0": ("the GNU General Public License, version 3",),
    "LGPL-2.1": ("the GNU Lesser General Public License, version 2.1",),
    "LGPL-3.0": ("the GNU Lesser General Public License, version 3",),
    "AGPL-3.0": ("the GNU Affero General Public License, version 3",),
    "MPL-2.0": ("the Mozilla Public License, version 2.0",),
    "BSD-2-Clause": ("the BSD 2-Clause License",),
    "BSD-3-Clause": ("the BSD 3-Clause License",),
}
#: Words that tell a license from its neighbours.
DECIDING = (b"lesser", b"affero", b"neither", b"endorse", b"mit", b"apache", b"mozilla")
WORD = re.compile(rb"[a-z0-9\x80-\xff]+")


def templates() -> list[tuple[str, str]]:
    """(license, wording): the notices, then one-line statements by rule."""
    out = list(NOTICES.items())
    names = {**NAMES, **{f"CC-{kind}-4.0": (f"CC {kind} 4.0",) for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")}}
    for spdx, wordings in names.items():
        out += [(spdx, f"{verb} under {w}") for w in wordings for verb in ("licensed", "released", "distributed")]
    return out


@dataclass(frozen=True)
class Settings:
    min_coverage: float = MIN_COVERAGE


def unbroken(m: int, coverage: float = MIN_COVERAGE) -> int:
    """Length of a run of template words that stands unbroken in any text that covers a template of ``m`` words enough:
    the least, over the numbers of missed and inserted words that coverage allows, of matched words / (breaks + 1), rounded up."""
    least = m
    for missed in range(m + 1):
        for inserted in range(m + 1):
            if m - missed >= coverage * (m + inserted) - 1e-9:
                least = min(least, -(-(m - missed) // (missed + inserted + 1)))
    return least


_BASE, _MIX = 0x9E3779B97F4A7C15 | 1, np.uint64(0xD6E8FEB86659FD93)
_INVERSE = pow(_BASE, -1, 1 << 64)
_KIND = np.array([chr(b).isascii() and chr(b).isalnum() or b > 127 for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n + 1, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


class Powers:
    """Powers of the hash base and of its inverse (modulo 2^64), grown on demand."""

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            self.up, self.down = _powers(_BASE, 2 * n), _powers(_INVERSE, 2 * n)
        return self.up[:n + 1], self.down[:n + 1]


_POWERS = Powers()


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words in a byte array."""
    inside = np.concatenate([[False], _KIND[data], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    up, down = _POWERS.upto(len(data) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((_LOWER[data] + np.uint64(1)) * up[:len(data)], dtype=np.uint64)])
    h = (total[end] - total[start]) * down[start]
    return start, end, (h ^ (h >> np.uint64(29))) * _MIX


def run_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` words in a row."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    weight, out = _powers(_BASE, k), np.zeros(n, np.uint64)
    for j in range(k):
        out += h[j:j + n] * weight[j]
    return (out ^ (out >> np.uint64(31))) * _MIX


class Index:
    """Templates and, for each run length K, the sorted hashes of their winnowed runs with template and place."""

    def __init__(self, s: Settings = Settings()):
        self.s, self.templates = s, templates()
        texts = [t.lower().encode() for _, t in self.templates]
        self.words = [word_hashes(np.frombuffer(t, np.uint8))[2] for t in texts]
        plain = [WORD.findall(t) for t in texts]
        self.must = [np.array([any(48 <= c < 58 for c in w) or w in DECIDING or (b"cc" in ws and len(w) == 2) for w in ws]) for ws in plain]
        # a name's place in its list: 1, 2 and 3 before the clauses are no versions
        for ws, must in zip(plain, self.must):
            if b"redistribution" in ws:
                must[[w.isdigit() for w in ws]] = False
        self.tight = [np.array([w == b"gnu" for w in ws]) for ws in plain]
        self.band = [max(3, -(-len(w) // 4)) for w in self.words]
        found: dict[int, list] = {}
        for t, w in enumerate(self.words):
            run = unbroken(len(w), s.min_coverage)
            k, window = (3, 2) if run >= 4 else (max(1, run), 1)
            g = run_hashes(w, k)
            places = {a + int(np.argmin(g[a:a + window])) for a in range(max(1, len(g) - window + 1))}
            found.setdefault(k, []).extend((int(g[p]), t, p) for p in sorted(places))
        self.runs = {}
        for k, rows in sorted(found.items()):
            rows.sort()
            keys, flags = np.array([r[0] for r in rows], np.uint64), np.zeros(1 << 16, bool)
            flags[(keys >> np.uint64(48)).astype(np.int64)] = True       # cheap first test on the top bits
            self.runs[k] = (flags, keys, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))

    def candidates(self, g: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """(place in the text, template, place in the template) of every hash of ``k`` words that is in the index."""
        flags, keys, owner, place = self.runs[k]
        at = np.flatnonzero(flags[(g >> np.uint64(48)).astype(np.int64)])
        low, high = np.searchsorted(keys, g[at], "left"), np.searchsorted(keys, g[at], "right")
        return [(int(p), int(owner[j]), int(place[j])) for p, a, b in zip(at, low, high) for j in range(a, b)]


def align(template: np.ndarray, text: np.ndarray, shift: int, band: int) -> list[tuple[int, int]]:
    """(template word, text word) of every match, in order: fewest edits inside the band, the text's ends free.

    Row i of the table is after i template words; column c is text place i + shift - band + c."""
    m, width = len(template), 2 * band + 1
    cost = np.zeros(width, np.int64)
    moves = np.zeros((m, width), np.int8)                            # 0 pair, 1 template word left out, 2 text word left out
    offset = np.arange(width)
    far = 1 << 30
    for i in range(m):
        place = i + shift - band + offset                           # text word paired in this column
        there = (place >= 0) & (place < len(text))
        same = np.zeros(width, bool)
        same[there] = text[place[there]] == template[i]
        pair = np.where(there, cost + ~same, far)
        skip = np.append(cost[1:], far) + 1                          # same text place, one row up: column c + 1
        best = np.minimum(pair, skip)
        along = np.minimum.accumulate(best - offset) + offset
        moves[i] = np.where(along < best, 2, np.where(pair <= skip, 0, 1))
        cost = along
    c, i, hits = int(cost.argmin()), m - 1, []
    while i >= 0:
        if moves[i, c] == 0:
            p = i + shift - band + c
            if 0 <= p < len(text) and text[p] == template[i]:
                hits.append((i, p))
            i -= 1
        elif moves[i, c] == 1:
            i, c = i - 1, c + 1
        else:
            c -= 1
    return hits[::-1]


def accepted(index: Index, t: int, hits: list[tuple[int, int]]) -> int:
    """Matched less inserted words of an alignment with template ``t``; 0 if it isn't covered enough or another license is meant."""
    if not hits:
        return 0
    i, p = (np.array(x) for x in zip(*hits))
    m, inserted = len(index.words[t]), int(np.maximum(np.diff(p) - np.diff(i), 0).sum())
    if len(i) < index.s.min_coverage * (m + inserted) - 1e-9:
        return 0
    matched = np.zeros(m, bool)
    matched[i] = True
    if not matched[index.must[t]].all():
        return 0
    after = np.flatnonzero(index.tight[t][i[:-1]])
    if ((p[after + 1] - p[after]) != (i[after + 1] - i[after])).any():
        return 0
    return len(i) - inserted


def scan(index: Index, words: np.ndarray, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(template, matched words, first, last word) of the findings of one text, apart from each other."""
    tried, good = set(), []
    for place, t, at in sorted(found):
        w, shift = index.words[t], place - at
        if (t, shift) in tried:
            continue                                                 # the same diagonal, seen from another run
        tried.add((t, shift))
        band = index.band[t]
        low, high = max(0, shift - band), min(len(words), shift + len(w) + band)
        near, often = np.unique(words[low:high], return_counts=True)
        own, need = np.unique(w, return_counts=True)
        at_ = np.minimum(np.searchsorted(near, own), max(0, len(near) - 1))
        if np.minimum(often[at_], need)[near[at_] == own].sum() < index.s.min_coverage * len(w) - 1e-9:
            continue                                                 # too few of its words are there at all
        hits = align(w, words[low:high], shift - low, band)
        score = accepted(index, t, hits)
        if score:
            good.append((score, t, len(hits), low + hits[0][1], low + hits[-1][1]))
    good.sort(key=lambda x: (-x[0], len(index.words[x[1]]), x[1], x[3]))
    kept: list[tuple[int, int, int, int]] = []                       # (first, last, template, matched), apart and in order
    for _, t, n, a, b in good:
        i = bisect_left(kept, (a,))
        if (i == 0 or kept[i - 1][1] < a) and (i == len(kept) or kept[i][0] > b):
            kept.insert(i, (a, b, t, n))
    return [(t, n, a, b) for a, b, t, n in kept]


_INDEXES: dict[Settings, Index] = {}


def _run(s: Settings, group_bytes: int = 1 << 21):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if s not in _INDEXES:
            _INDEXES[s] = Index(s)
        index = _INDEXES[s]
        for batch in batches:
            column = pc.fill_null(batch.column(1).cast(pa.binary()), b"")
            size, a = pc.binary_length(column).to_numpy(), 0
            while a < len(column):
                n = max(1, int(np.searchsorted(np.cumsum(size[a:] + 1), group_bytes)))
                texts = column.slice(a, n).to_pylist()
                yield _scan_group(index, batch.column(0).slice(a, n), texts)
                a += n

    return run


def _scan_group(index: Index, ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)        # a word never crosses the zero byte
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
    start, end, h = word_hashes(data)
    owner = np.searchsorted(begin, start, "right") - 1
    by_text: dict[int, list[tuple[int, int, int]]] = {}
    for k in index.runs:
        for p, t, at in index.candidates(run_hashes(h, k), k):
            if owner[p] == owner[p + k - 1]:
                by_text.setdefault(int(owner[p]), []).append((p, t, at))
    rows: list[tuple] = []
    for i, found in sorted(by_text.items()):
        first, last = np.searchsorted(owner, [i, i + 1])
        for t, n, a, b in scan(index, h[first:last], [(p - first, t, at) for p, t, at in found]):
            a, b = int(start[first + a] - begin[i]), int(end[first + b] - begin[i])
            chars = [len(texts[i][:x].decode("utf-8", "ignore")) for x in (a, b)]
            rows.append((i, index.templates[t][0], t, *chars, n, len(index.words[t])))
    cols = list(zip(*rows)) if rows else [()] * 7
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.string()), *(pa.array(c, pa.int64()) for c in cols[2:]),
         pa.array([n / m for n, m in zip(cols[5], cols[6])], pa.float64())],
        names=["id", "license", "template", "start", "end", "matched_words", "template_words", "coverage"])


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per finding: id, license, template, start and end (code points), matched_words, template_words, coverage."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(_run(settings), f"id {kind}, license string, template long, start long, end long, matched_words long, template_words long, coverage double")
    return out.withColumnRenamed("id", id_col)
