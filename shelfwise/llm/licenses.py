"""License scan by conditional compression.

Blocks are runs of words around a cue word, over line ends: every word that a notice holding the cue could have.
Each block is compressed alone and with each template as a raw zstandard dictionary, and the templates are ranked by the
bytes they save. In that order they are confirmed: a notice is a stretch of the block that is the template but
for few words replaced, left out or put in, and which they are is found exactly and returned. A template that saves
nothing ends the search, for a notice of it would repeat most of its words. Of notices that overlap, the one whose
words the template compresses most stays. Where no notice is, the template that saves most is named, with its
differences, as unconfirmed.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import slices

#: Notices of well-known licenses (fixed values).
TEMPLATES = {
    "MIT": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC0-1.0": ["This work is dedicated to the public domain under CC0 1.0 Universal."],
    "ISC": ["Released under the ISC License.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "MIT-0": [], "Apache-1.1": ["Licensed under the Apache License, Version 1.1."],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License."], "BSD-3-Clause": ["Released under the BSD 3-Clause License."],
    "MPL-1.1": ["Licensed under the Mozilla Public License, Version 1.1."],
}
TEMPLATES["MIT"].append(
    TEMPLATES["MIT"][1] + ", including without limitation the rights to use, copy, modify, merge, publish, distribute, "
    "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions:")
for _name, _kind, _version in (("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.0", "Library ", "2"), ("LGPL-2.1", "Lesser ", "2.1"),
                               ("LGPL-3.0", "Lesser ", "3"), ("AGPL-3.0", "Affero ", "3")):
    _either = (f"you can redistribute it and/or modify it under the terms of the GNU {_kind}General Public License as published "
               f"by the Free Software Foundation, either version {_version} of the License")
    TEMPLATES.setdefault(_name, []).extend(t for t in (
        f"This work is licensed under the GNU {_kind}General Public License, version {_version}.",
        f"This program is free software: {_either}", f"This program is free software: {_either}, or (at your option) any later "
        "version.") if t not in TEMPLATES.get(_name, []))
for _name, _kind in (("SA", "ShareAlike"), ("ND", "NoDerivatives"), ("NC-SA", "NonCommercial-ShareAlike"),
                     ("NC-ND", "NonCommercial-NoDerivatives")):
    TEMPLATES[f"CC-BY-{_name}-4.0"] = [f"Licensed under CC BY-{_name} 4.0.", "This work is licensed under a Creative Commons "
                                       f"Attribution-{_kind} 4.0 International License."]
_CLAUSES = (
    TEMPLATES["BSD"][0] + ":",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.",
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.")
for _n in (2, 3):
    for _clauses in (_CLAUSES[:_n + 1], [c.lstrip("123. ") for c in _CLAUSES[:_n + 1]]):
        TEMPLATES[f"BSD-{_n}-Clause"].append(" ".join(_clauses))
TEMPLATES |= {
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0.", "Boost Software License - Version 1.0 - August 17th, 2003"],
    "EUPL-1.2": ["Licensed under the EUPL, Version 1.2", "Licensed under the EUPL, Version 1.2 or - as soon they will be approved by "
                 "the European Commission - subsequent versions of the EUPL"],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
                "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0 "
                "which is available at"],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
             "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
             "following restrictions:"],
}
for _name in TEMPLATES:
    if _name != "BSD":
        TEMPLATES[_name] += [f"SPDX-License-Identifier: {_name}", f"Licensed under {_name}."]
#: Words that join the names of licenses in one notice.
JOINING = frozenset("or and".split())
CUE = (r"(?i)licen[sc]|copyright|permission\W+is\W+hereby|redistribut|public\W+domain|creative\W+commons|"
       r"\bcc\W+by|\bcc[ -]?0|spdx")
#: A template of this many words may differ in one, of twice as many in two.
PER_EDIT = 5
#: Bytes that a template must save on a block before a notice of it is looked for.
LEAST_SAVED = 1
SLICE_BYTES = 4 << 20
FOUND = ("doc_id long, line long, block long, text string, license string, saved double, coverage double, "
         "missing array<string>, added array<string>, confirmed boolean")
WORD = re.compile(r"[^\W_]+(?:\.[^\W_]+)*")
#: Words that tell licenses apart, beside version numbers: they must be the template's, none more or less.
TELLING = frozenset("mit apache gnu gpl lgpl agpl lesser library affero mozilla mpl bsd isc cc cc0 creative commons "
                    "nc sa nd noncommercial sharealike noderivatives noderivs clause eclipse epl eupl boost bsl zlib unlicense".split())
VERSION = re.compile(r"v?(\d+(?:\.\d+)*?)(?:\.0)*")
NEVER = 1 << 20  # edits


def words(text: str) -> list[str]:
    return [_word(w) for w in WORD.findall(text)]


def _word(word: str) -> str:
    """Lower case; versions without a v and zeros at the end."""
    version = VERSION.fullmatch(word.lower())
    return version[1] if version else word.lower()


def _tells(word: str) -> bool:
    return word in TELLING or word[0].isdigit() and bool(VERSION.fullmatch(word))


@functools.cache
def _templates() -> list[tuple[str, list[str], Counter]]:
    return [(name, words(t), Counter(words(t))) for name, texts in TEMPLATES.items() for t in texts]


@functools.cache
def _span() -> int:
    """Most words that a notice can have."""
    return max(len(want) + len(want) // PER_EDIT for _, want, _ in _templates())


@functools.cache
def _compressors() -> tuple:
    import zstandard as z

    dicts = [z.ZstdCompressionDict(t.lower().encode(), dict_type=z.DICT_TYPE_RAWCONTENT)
             for texts in TEMPLATES.values() for t in texts]
    return z.ZstdCompressor(level=19), [z.ZstdCompressor(level=19, dict_data=d) for d in dicts]


@functools.lru_cache(maxsize=10_000)
def reductions(block: str) -> tuple[int, list[int]]:
    """The block's compressed size, and the bytes that each template saves of it as a dictionary."""
    alone, each = _compressors()
    data = block.lower().encode("utf-8", "surrogatepass")
    size = len(alone.compress(data))
    return size, [size - len(c.compress(data)) for c in each]


def ranking(block: str) -> list[int]:
    """Templates by the bytes they save on the block, most first."""
    saves = reductions(block)[1]
    return sorted(range(len(saves)), key=lambda k: (-saves[k], k))


def places(want: list[str], have: list[str], most: int, strict: bool = True) -> list[tuple]:
    """(edits, start, end, missing, added) of the stretches of ``have`` that are ``want`` but for at most ``most``
    words replaced, left out or put in (``strict``: none that tells licenses apart). Of stretches that overlap the
    one with the fewest stays."""
    drop, put = ([NEVER if strict and _tells(w) else 1 for w in x] for x in (want, have))
    rows = [[0] * (len(have) + 1)]
    for i, w in enumerate(want, 1):
        up, out_ = rows[-1], drop[i - 1]
        left = up[0] + out_
        row = [left]
        for j, h in enumerate(have):
            left = min(up[j] + (0 if w == h else max(out_, put[j])), up[j + 1] + out_, left + put[j])
            row.append(left)
        rows.append(row)
    out: list[tuple] = []
    for edits, j in sorted((c, -j) for j, c in enumerate(rows[-1]) if c <= most):
        i, j, missing, added = len(want), -j, [], []
        end = j
        while i:
            differ = max(drop[i - 1], put[j - 1]) if j and want[i - 1] != have[j - 1] else 0
            if j and rows[i][j] == rows[i - 1][j - 1] + differ:
                i, j = i - 1, j - 1
                if differ:
                    missing.append(want[i])
                    added.append(have[j])
            elif rows[i][j] == rows[i - 1][j] + drop[i - 1]:
                i -= 1
                missing.append(want[i])
            else:
                j -= 1
                added.append(have[j])
        if all(j >= o[2] or end <= o[1] for o in out):
            out.append((edits, j, end, missing[::-1], added[::-1]))
    return out


def confirmed(have: list[str], text_of: Callable[[int, int], str], least: int = LEAST_SAVED) -> list[tuple]:
    """(saved bytes, start, end, template, missing, added) of the notices in the block ``have``, whatever their template;
    ``text_of(start, end)`` is the text of a stretch of it. Templates are taken by their rank down to the
    first that saves less than ``least`` bytes."""
    held, found = Counter(have), []
    block = text_of(0, len(have))
    saves = reductions(block)[1]
    for k in ranking(block):
        if saves[k] < least:
            break
        _, want, count = _templates()[k]
        most = len(want) // PER_EDIT
        if all(w in held for w in count if _tells(w)) and sum((count & held).values()) >= len(want) - most:  # else not there
            found += [(reductions(text_of(a, b))[1][k], a, b, k, m, x) for _, a, b, m, x in places(want, have, most)]
    return found


def best_apart(found: Iterable[tuple], taken: bytearray) -> list[tuple]:
    """Of notices that overlap, those that save most; ties: fewer differences, the longer, the first. ``taken`` marks the
    words they have."""
    out = []
    for n in sorted(found, key=lambda n: (-n[0], len(n[4]) + len(n[5]), n[1] - n[2], n[1], n[3])):
        if not any(taken[n[1]:n[2]]):
            taken[n[1]:n[2]] = b"\x01" * (n[2] - n[1])
            out.append(n)
    return out


def _row(block: str, k: int, missing: list[str], added: list[str], sure: bool) -> tuple:
    name, want, _ = _templates()[k]
    size, saves = reductions(block)
    return name, saves[k] / size, 1 - len(missing) / len(want), list(missing), list(added), sure


@functools.cache
def _names() -> list[tuple[list[str], int]]:
    """Words of each license's short name, longest first, and its shortest template."""
    plans = _templates()
    short = {n: min((k for k in range(len(plans)) if plans[k][0] == n), key=lambda k: len(plans[k][1])) for n in TEMPLATES}
    return sorted(((words(n), k) for n, k in short.items()), key=lambda x: -len(x[0]))


def _joined(have: list[str], end: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, template) of the names that are joined by "or" or "and" to a notice that ends before ``end``."""
    while end < len(have) and have[end] in JOINING:
        name = next(((n, k) for n, k in _names() if have[end + 1: end + 1 + len(n)] == n), None)
        if name is None:
            return
        yield end + 1, end + 1 + len(name[0]), name[1]
        end += 1 + len(name[0])


@functools.lru_cache(maxsize=10_000)
def identify(block: str) -> tuple:
    """(license, saved share, coverage, missing words, added words, confirmed) of one block: of its best notice, else of
    the template that saves most."""
    spans = [m.span() for m in WORD.finditer(block)]
    have = words(block)
    sure = best_apart(confirmed(have, lambda a, b: block[spans[a][0]:spans[b - 1][1]] if b > a else ""), bytearray(len(have)))
    if sure:
        _, _, _, k, missing, added = sure[0]
        return _row(block, k, missing, added, True)
    k = ranking(block)[0]
    _, _, _, missing, added = places(_templates()[k][1], have, len(_templates()[k][1]), False)[0]
    return _row(block, k, missing, added, False)


def notices(text: str, cue: str = CUE, least: int = LEAST_SAVED) -> list[tuple]:
    """(line, block, text, license, saved, coverage, missing, added, confirmed) of a document; see ``scan``."""
    spans = [m.span() for m in WORD.finditer(text)]
    starts, have = [a for a, _ in spans], [_word(text[a:b]) for a, b in spans]
    cues = sorted({bisect_right(starts, m.start()) - 1 for m in re.finditer(cue, text)} - {-1})
    ends = [m.start() for m in re.finditer("\n", text)]
    span, runs = _span(), []
    for c in cues:  # a notice that holds word c lies in these
        lo, hi = max(0, c - span + 1), min(len(have), c + span)
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = hi
        else:
            runs.append([lo, hi])
    found = set()
    for lo, hi in runs:  # any ``span`` words stand whole in one window
        for at in range(lo, max(lo + 1, hi - span), span):
            window = lambda a, b, at=at: text[starts[at + a]:spans[at + b - 1][1]] if b > a else ""
            for n, a, b, k, m, x in confirmed(have[at:min(hi, at + 2 * span)], window, least):
                found.add((n, at + a, at + b, k, tuple(m), tuple(x)))
    taken, rows = bytearray(len(have)), []
    for _, a, b, k, m, x in best_apart(found, taken):
        if cues[bisect_left(cues, a):bisect_left(cues, b)]:
            block = text[starts[a]:spans[b - 1][1]]
            rows.append((bisect_left(ends, starts[a]), a, block, *_row(block, k, m, x, True)))
            for a2, b2, k2 in _joined(have, b):
                if not any(taken[a2:b2]):
                    taken[a2:b2] = b"\x01" * (b2 - a2)
                    more = text[starts[a2]:spans[b2 - 1][1]]
                    rows.append((bisect_left(ends, starts[a2]), a2, more, *_joined_row(more, k2)))
    heads, done = [], 0  # stretches of a line's other words with a cue
    for c in cues:
        if not taken[c] and c >= done:
            line = bisect_left(ends, starts[c])
            first = max(done, bisect_left(starts, ends[line - 1]) if line else 0)
            last = bisect_left(starts, ends[line]) if line < len(ends) else len(have)
            lo = taken.rfind(1, first, c) + 1 or first
            a = c - (c - lo) % span
            done = taken.find(1, a, min(a + span, last))
            done = min(a + span, last) if done < 0 else done
            heads.append((line, a, text[starts[a]:spans[done - 1][1]]))
    rows = sorted([*rows, *((*h, *identify(h[2])) for h in heads)], key=lambda r: r[:2])
    count: Counter = Counter()
    out = []
    for line, _, *rest in rows:
        out.append((line, count[line], *rest))
        count[line] += 1
    return out


def _joined_row(block: str, k: int) -> tuple:
    """A license that a notice names beside another: its name is whole, so nothing is missing."""
    size, saves = reductions(block)
    return _templates()[k][0], saves[k] / size, 1.0, [], [], True


def scan(docs: DataFrame, cue: str = CUE) -> DataFrame:
    """One row per notice that holds a cue word, and one per line (of a long line: per stretch of it) with a cue word
    outside of all notices: doc_id, line (where it begins), block (numbers in a line), text, license (best template),
    saved (share of the compressed size), coverage (share of its words), missing and added words, confirmed.

    Documents without a cue word give no row, so null, empty and clean texts give none; equal blocks each give
    their row; names joined to a notice by "or" or "and" are notices of their own; ties in size go to the earlier template; repeated rows and null ids keep theirs; very long texts
    and lines are read whole; an empty table gives an empty result; other columns are ignored.
    """
    told = docs.filter(F.col("text").rlike(cue)).select(F.col("doc_id").cast("long"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE_BYTES):
            rows = [(doc, *n) for doc, text in zip(*(b.column(k).to_pylist() for k in range(2))) for n in notices(text, cue)]
            columns = list(zip(*rows)) if rows else [()] * len(_FOUND)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)

    return told.mapInArrow(run, FOUND)


_FOUND = pa.schema([("doc_id", pa.int64()), ("line", pa.int64()), ("block", pa.int64()), ("text", pa.string()),
                    ("license", pa.string()), ("saved", pa.float64()), ("coverage", pa.float64()),
                    ("missing", pa.list_(pa.string())), ("added", pa.list_(pa.string())), ("confirmed", pa.bool_())])
