"""License scans by conditional compression.

A block of text around licence words is compressed alone and with each template as a
zstandard raw dictionary. The templates are ranked by the bytes they save and confirmed
in that order, to the end of the ranking: a template is confirmed where nearly all of its
words stand in order and every word that tells licences apart (versions, numbers, ``not``,
``non-commercial`` and the like) agrees exactly. A confirmed place takes its words, and
templates further down find notices only in what is left. The differences are returned.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import lru_cache

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from formwork.llm.frames import map_text

#: Usual wordings of licence notices (fixed values).
TEMPLATES: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "BSD-2-Clause": ("Released under the BSD 2-Clause License.", "Released under the Simplified BSD License."),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-NC-ND-4.0": ("Licensed under CC BY-NC-ND 4.0.",),
    "CC-BY-NC-SA-4.0": ("Licensed under CC BY-NC-SA 4.0.",),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.",),
    "CC-BY-SA-3.0": ("Licensed under CC BY-SA 3.0.",),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": ("Licensed under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "ISC": ("Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
#: Words that tell licences apart: they must agree, whatever else differs.
TELLING = frozenset("affero apache bsd cc0 clause creative gnu isc lesser mit mozilla nc nd noncommercial not sa sharealike simplified by attribution unencumbered waived".split())

_HINT = re.compile(r"licen[cs]|copyright|permission|redistribut|public domain|free software|spdx", re.IGNORECASE)
_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
#: Characters before and after a hint that belong to its block, lines permitting.
REACH = 700
#: The share of a template's words that must be found.
MIN_WORDS_FOUND = 0.85
LEVEL = 9


def words_of(text: str) -> list[tuple[str, int, int]]:
    return [(m.group().lower(), *m.span()) for m in _WORD.finditer(text)]


def _telling(word: str) -> bool:
    return word in TELLING or word[0].isdigit()


@dataclass
class Template:
    name: str
    words: list[str]
    press: zstandard.ZstdCompressor


@lru_cache(maxsize=1)
def templates() -> list[Template]:
    out = []
    for name, wordings in TEMPLATES.items():
        for text in wordings:
            known = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            out.append(Template(name, [w for w, _, _ in words_of(text)], zstandard.ZstdCompressor(level=LEVEL, dict_data=known)))
    return out


@lru_cache(maxsize=1)
def _alone() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL)


def blocks(text: str) -> list[tuple[int, int]]:
    """Stretches of text around licence words, merged where they touch."""
    out: list[tuple[int, int]] = []
    for m in _HINT.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        while 0 < a and text[a - 1].isalnum() and a < m.start():
            a += 1
        while b < len(text) and text[b].isalnum() and b > m.end():
            b -= 1
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def savings(block: str) -> list[tuple[int, Template]]:
    """All templates by the bytes each saves as a dictionary, most first (ties: longest)."""
    data = block.encode("utf-8", "surrogatepass")
    alone = len(_alone().compress(data))
    saved = [(alone - len(t.press.compress(data)), t) for t in templates()]
    return sorted(saved, key=lambda s: (-s[0], -len(s[1].words)))


def align(want: list[str], own: list[str], start: int) -> list[tuple[int, int]] | None:
    """Pairs (word of the block, word of the template) of the best alignment that begins
    at ``start``: most words found, then fewest added, then latest. No telling word may be left over on
    either side; None where too few words are found."""
    n = len(want)
    may_miss = n - math.ceil(MIN_WORDS_FOUND * n)
    last = max((j for j, w in enumerate(want) if _telling(w)), default=-1)
    best = None
    # by words of the template passed: (found, -added, pairs as a chain)
    states: dict[int, tuple] = {}
    for i in range(start, min(len(own), start + n + 2 * max(2, n // 5))):
        word = own[i]
        then = {} if _telling(word) or i == start else {j: (found, less - 1, chain) for j, (found, less, chain) in states.items()}
        begin = [(0, (0, 0, None))] if i == start else sorted(states.items())
        for j, (found, less, chain) in begin:
            # template words from j on that may be missing, up to the next equal one
            while j < n and j - found <= may_miss:
                if want[j] == word:
                    new = (found + 1, less, (chain, (i, j)))
                    if j + 1 not in then or new[:2] >= then[j + 1][:2]:
                        then[j + 1] = new
                    if j >= last and new[0] >= n - may_miss and (best is None or new[:2] > best[:2]):
                        best = new
                if _telling(want[j]):
                    break
                j += 1
        states = then
        if not states:
            break
    if best is None:
        return None
    pairs, chain = [], best[2]
    while chain:
        chain, pair = chain
        pairs.append(pair)
    return pairs[::-1]


def confirm(template: Template, words: list[tuple[str, int, int]]) -> list[tuple[int, int, list[str], list[str]]]:
    """(first word, last word + 1, missing words, added words) of every place where the
    wording of the template stands among the words of a block, best first."""
    own = [w for w, _, _ in words]
    want = template.words
    n = len(want)
    there = set(own)
    telling = {w for w in want if _telling(w)}
    if not telling <= there or sum(w in there for w in want) < MIN_WORDS_FOUND * n:
        return []
    heads = set()
    for w in want[: n - math.ceil(MIN_WORDS_FOUND * n) + 1]:
        heads.add(w)
        if w in telling:
            break
    reach = n + 2 * max(2, n // 5)
    out = []
    for start, w in enumerate(own):
        if w not in heads or not telling.issubset(own[start : start + reach]):
            continue
        if pairs := align(want, own, start):
            first, last = pairs[0][0], pairs[-1][0] + 1
            found, used = {j for _, j in pairs}, {i for i, _ in pairs}
            out.append((first, last, [w for j, w in enumerate(want) if j not in found], [own[i] for i in range(first, last) if i not in used]))
    return sorted(out, key=lambda h: (len(h[2]), len(h[3]), h[0]))


def find_notices(text: str) -> list[tuple[str, int, int, int, list[str], list[str]]]:
    """(licence, start, end, bytes saved, missing words, added words) of the notices of
    a text, by start. Confirmed notices are blanked and their block searched again."""
    out = []
    for a, b in blocks(text) if _HINT.search(text) else []:
        block = text[a:b]
        words = words_of(block)
        while True:
            taken = bytearray(len(words))
            for saved, t in savings(block):
                for first, last, missing, added in confirm(t, words):
                    if not any(taken[first:last]):
                        taken[first:last] = b"\1" * (last - first)
                        out.append((t.name, a + words[first][1], a + words[last - 1][2], saved, missing, added))
            if not any(taken):
                break
            at, left = 0, []
            for k, (_, start, end) in enumerate(words):
                if taken[k]:
                    left += [block[at:start], " " * (end - start)]
                    at = end
            block = "".join([*left, block[at:]])
            words = [w for k, w in enumerate(words) if not taken[k]]
    return sorted(out, key=lambda n: (n[1], n[0]))


NOTICE = T.StructType([
    T.StructField("license", T.StringType()),
    T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()),
    T.StructField("bytes_saved", T.LongType()),
    T.StructField("missing", T.ArrayType(T.StringType())),
    T.StructField("added", T.ArrayType(T.StringType())),
])


def scan_licenses(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Licence notices of every whole text: adds ``notices`` (licence, start and end in
    code points, bytes saved, missing and added words), by start. A clashing name is
    replaced. Null and empty texts and texts without a licence word have none; repeated
    rows give repeated results; no rows give no rows."""

    def make():
        def run(texts: list[str]):
            for t in texts:
                yield ([dict(zip(NOTICE.names, n)) for n in find_notices(t)],)

        return run

    return map_text(docs, text_col, T.StructType([T.StructField("notices", T.ArrayType(NOTICE))]), make)
