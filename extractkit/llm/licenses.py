"""License notices by conditional compression.

A candidate block is a stretch of a text that keeps enough neighbouring words of some template,
near each other, to be its wording with at most a fifth of the words changed; it is as long as that template and a fifth
more on either side.  Which words name a license plays no part here.  The block is compressed by zstandard alone and with
each template as raw dictionary, and templates rank by how many bytes they save.  In that order they are compared word by
word, and the first that is confirmed wins the block; the differences (substituted, added or left-out words) are the result.  It is confirmed
if at most a fifth of its words differ and none of the words that name the license and its version does.  Of overlapping notices the one
that saves most bytes stays.  SPDX lines name their licenses themselves; they are read by a pattern and reported as a kind of their own.

No block is lost: a change breaks at most two pairs of neighbouring words and moves what follows by at most one place, so with k
changes in n words n - 1 - 2k pairs stay, k places apart at most.  Likewise a text without any of k + 1 words of each
template is passed over before Python, by plain substring search.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from extractkit.llm.common import small_batches
from extractkit.session import spread

#: license -> (wording, the words that must be there as they are).  Common notices.
TEMPLATES = {
    "MIT": ("Released under the MIT License.", {"mit"}),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", {"apache", "2.0"}),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", {"gnu", "general", "public", "3"}),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.", {"gnu", "lesser", "3"}),
    "BSD-3-Clause": ("Use of this source code is governed by a BSD style license with three clauses.", {"bsd", "three"}),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", {"cc", "by", "4.0"}),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", {"cc", "by-sa", "4.0"}),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", {"cc", "by-nc", "4.0"}),
    "CC0-1.0": ("Released into the public domain under CC0 1.0 Universal.", {"cc0", "1.0"}),
}
_GNU = (
    "This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation; "
    "either version {2} of the License, or (at your option) any later version."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution."
)
_CC = "This work is licensed under a Creative Commons {} 4.0 International License."
#: Further wordings, as (license, wording, the words that must be there): headers and short texts as they are in use.
WORDINGS = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the "
     "Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
     "permit persons to whom the Software is furnished to do so, subject to the following conditions:", {"permission", "granted", "charge", "sublicense"}),
    ("MIT", "This project is licensed under the MIT License.", {"mit"}),
    ("MIT", "Licensed under the MIT license.", {"mit"}),
    ("MIT", "Distributed under the MIT License.", {"mit"}),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file.", {"mit-style"}),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
     "permission notice appear in all copies.", {"permission", "fee", "granted", "purpose"}),
    ("BSD-2-Clause", _BSD, {"redistribution", "source", "binary", "forms"}),
    ("BSD-3-Clause", _BSD + " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without "
     "specific prior written permission.", {"redistribution", "source", "binary", "neither", "endorse", "promote"}),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License.", {"bsd", "2-clause"}),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License.", {"bsd", "3-clause"}),
    ("BSD-style", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", {"bsd-style"}),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
     "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", {"apache", "2.0"}),
    ("Apache-2.0", "This project is licensed under the Apache License 2.0.", {"apache", "2.0"}),
    ("Apache-2.0", "Released under the Apache 2.0 License.", {"apache", "2.0"}),
    *[(f"{short}-{version}.{minor}-or-later", _GNU.format(noun, name, number), words | {number})
      for noun, short, name, words, versions in (
          ("program", "GPL", "General Public License", {"gnu", "general", "public"}, ("2", "3")),
          ("library", "LGPL", "Lesser General Public License", {"gnu", "lesser"}, ("2.1", "3")),
          ("program", "AGPL", "Affero General Public License", {"gnu", "affero"}, ("3",)),
      ) for number in versions for version, minor in [(number + ".0").split(".")[:2]]],
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", {"mozilla", "public", "2.0"}),
    ("CC-BY-4.0", _CC.format("Attribution"), {"creative", "commons", "attribution", "4.0"}),
    ("CC-BY-SA-4.0", _CC.format("Attribution-ShareAlike"), {"creative", "commons", "attribution-sharealike", "4.0"}),
    ("CC-BY-NC-4.0", _CC.format("Attribution-NonCommercial"), {"creative", "commons", "attribution-noncommercial", "4.0"}),
    ("CC-BY-ND-4.0", _CC.format("Attribution-NoDerivatives"), {"creative", "commons", "attribution-noderivatives", "4.0"}),
    ("CC-BY-NC-SA-4.0", _CC.format("Attribution-NonCommercial-ShareAlike"), {"creative", "commons", "attribution-noncommercial-sharealike", "4.0"}),
    ("CC-BY-NC-ND-4.0", _CC.format("Attribution-NonCommercial-NoDerivatives"), {"creative", "commons", "attribution-noncommercial-noderivatives", "4.0"}),
    *[(f"CC-{x.upper()}-4.0", f"Licensed under CC {x.upper()} 4.0.", {"cc", x, "4.0"}) for x in ("by-nd", "by-nc-sa")],
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", {"waived", "copyright", "neighboring"}),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", {"unencumbered", "public", "domain"}),
]
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() \t-]+)", re.IGNORECASE)
#: An id, not an operator nor the exception after WITH.
_SPDX_ID = re.compile(r"\bWITH[ \t]+\S+|\b(?:AND|OR)\b|([A-Za-z0-9][A-Za-z0-9.+-]*)")
SHARE = 0.2
#: Too frequent in any English text to tell that a notice may be there.
FREQUENT = frozenset("a all an and any are be by can following for from has have in into is may must not of on or other our that the this to under use used with without work you".split())
_WORD = re.compile(r"[A-Za-z0-9]+(?:[.-][A-Za-z0-9]+)*")
OUTPUT = "doc_id long, license string, kind string, start long, end long, n_changes int, changes array<string>, saved_bytes int"


def words_of(text: str) -> list[tuple[str, int, int]]:
    """Lower-cased words with their places."""
    return [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


def differences(template: list[str], block: list[str]) -> tuple[int, int, list[str]]:
    """The place in ``block`` that is nearest to the template, and the changes of words there.

    ``(first, behind, changes)``: least number of changes, then the earliest end and latest start.
    """
    n, m = len(template), len(block)
    cost = [[0] * (m + 1)]
    for i in range(1, n + 1):
        row, above = [i], cost[-1]
        for j in range(1, m + 1):
            row.append(min(above[j - 1] + (template[i - 1] != block[j - 1]), above[j] + 1, row[j - 1] + 1))
        cost.append(row)
    end = j = min(range(m + 1), key=lambda k: (cost[n][k], k))
    i, changes = n, []
    while i:
        if j and cost[i][j] == cost[i - 1][j - 1] + (template[i - 1] != block[j - 1]):
            i, j = i - 1, j - 1
            if template[i] != block[j]:
                changes.append(f"{template[i]}>{block[j]}")
        elif cost[i][j] == cost[i - 1][j] + 1:
            i -= 1
            changes.append(f"-{template[i]}")
        else:
            j -= 1
            changes.append(f"+{block[j]}")
    return j, end, changes[::-1]


def _spdx(text: str) -> list[tuple]:
    """The licenses of the SPDX lines, each at its id; an expression may go over the whole line."""
    found = []
    for line in _SPDX.finditer(text):
        behind = line.start(1)
        for m in _SPDX_ID.finditer(line[1]):
            # Words after a whole expression are no part of it.
            if m[1] and found and found[-1][2] >= line.start(1) and not re.search(r"\b(AND|OR)\b", text[behind : line.start(1) + m.start()]):
                break
            if m[1]:
                behind = line.start(1) + m.end()
                found.append((m[1].rstrip("."), "spdx", line.start(1) + m.start(1), line.start(1) + m.start(1) + len(m[1].rstrip(".")), 0, (), None))
    return found


class LicenseScanner:
    """``templates``: license -> (wording, words that must be there); ``wordings``: further ones of any license."""

    def __init__(self, templates: dict[str, tuple[str, set[str]]], wordings: list[tuple[str, str, set[str]]] = ()):
        every = [(name, *x) for name, x in templates.items()] + list(wordings)
        self.licenses = [name for name, _, _ in every]
        self.templates = [([w for w, _, _ in words_of(text)], names) for _, text, names in every]
        if any(len(words) < 5 for words, _ in self.templates):
            raise ValueError("a template needs five words")
        self.pairs = defaultdict(set)
        for k, (words, _) in enumerate(self.templates):
            for at, pair in enumerate(zip(words, words[1:])):
                self.pairs[pair].add((k, at))
        self.plain = zstandard.ZstdCompressor(level=3)
        self.given = [
            zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for _, text, _ in every
        ]

    def scan(self, text: str) -> list[tuple]:
        """``(license, kind, start, end, n_changes, changes, saved_bytes)`` of the notices of a whole text, in order, none overlapping."""
        words = words_of(text)
        plain = [w for w, _, _ in words]
        found = {self._best(text, words, plain[low:high], low) for low, high in self.blocks(plain)} - {None}
        out = _spdx(text)
        for notice in sorted(found, key=lambda x: (-x[6], x[4], x[2], x[3], x[0])):
            if all(notice[3] <= o[2] or notice[2] >= o[3] for o in out):
                out.append(notice)
        return sorted(out, key=lambda x: x[2])

    def blocks(self, plain: list[str]) -> set[tuple[int, int]]:
        """Stretches of words that keep enough neighbouring words of some template."""
        shifts: dict[int, list[int]] = defaultdict(list)
        for i, pair in enumerate(zip(plain, plain[1:])):
            for k, at in self.pairs.get(pair, ()):
                shifts[k].append(i - at)
        out = set()
        for k, places in shifts.items():
            n = len(self.templates[k][0])
            slack = int(SHARE * n)
            least = n - 1 - 2 * slack
            places.sort()
            behind = -1
            for at in range(len(places) - least + 1):
                # The pairs of one notice lie within ``slack`` places; each of them gives a block.
                if places[at + least - 1] - places[at] <= slack:
                    top = bisect_right(places, places[at] + slack)
                    out.update((max(0, p - slack), min(len(plain), p + n + slack)) for p in set(places[max(at, behind) : top]))
                    behind = top
        return out

    def sizes(self, block: bytes) -> list[int]:
        """The block compressed with each template as dictionary."""
        return [len(given.compress(block)) for given in self.given]

    def _best(self, text: str, words: list, plain: list[str], low: int) -> tuple | None:
        """The notice of a block: the first by rank that its words confirm."""
        block = text[words[low][1] : words[low + len(plain) - 1][2]].lower().encode()
        alone = len(self.plain.compress(block))
        there = set(zip(plain, plain[1:]))
        ranks = defaultdict(list)
        for k, size in enumerate(self.sizes(block)):
            if size < alone:
                ranks[size].append(k)
        for size in sorted(ranks):
            found = []
            for k in ranks[size]:
                template = self.templates[k][0]
                # With fewer pairs kept, more than may change has changed.
                kept = sum(pair in there for pair in zip(template, template[1:]))
                notice = self.confirmed(k, plain) if kept >= len(template) - 1 - 2 * int(SHARE * len(template)) else None
                if notice:
                    first, end, changes = notice
                    found.append((self.licenses[k], "wording", words[low + first][1], words[low + end - 1][2], len(changes), tuple(changes), alone - size))
            if found:
                return min(found, key=lambda x: (x[4], x[2] - x[3], x[0]))
        return None

    def confirmed(self, k: int, plain: list[str]) -> tuple[int, int, list[str]] | None:
        """Place and changes of template ``k`` in a block, if it is that license's wording."""
        template, names = self.templates[k]
        first, end, changes = differences(template, plain)
        lost = {c.split(">")[0].lstrip("-") for c in changes if not c.startswith("+")}
        return (first, end, changes) if len(changes) <= SHARE * len(template) and not lost & names else None

    def needed(self) -> list[str]:
        """Words of which every text with a notice holds one: of each template more than may change in it."""
        open_ = {k: [int(SHARE * len(words)) + 1, Counter(words)] for k, (words, _) in enumerate(self.templates)}
        out: list[str] = []
        while open_:
            # A longer word holds a shorter one that is part of it, so the shorter one stands for both.
            every = {w for _, words in open_.values() for w in words if w not in FREQUENT and len(w) > 2} or {w for _, words in open_.values() for w in words}
            gain = {w: sum(min(least, sum(n for x, n in words.items() if w in x)) for least, words in open_.values()) for w in every}
            word = min(gain, key=lambda w: (-gain[w], -len(w), w))
            out.append(word)
            for k, (least, words) in list(open_.items()):
                least -= sum(n for x, n in words.items() if word in x)
                if least <= 0:
                    del open_[k]
                else:
                    open_[k] = [least, Counter({x: n for x, n in words.items() if word not in x})]
        return out


def scan_licenses(documents: DataFrame, templates: dict = TEMPLATES, wordings: list = WORDINGS) -> DataFrame:
    """A row for each notice: document, license, kind (``wording`` or ``spdx``), place (characters from 0), changed words, bytes saved.

    Null, empty and other texts without a notice give no rows; repeated rows give theirs each;
    a null ``doc_id`` stays null; other columns are ignored.
    """
    small_batches(documents.sparkSession)
    low = F.lower("text")
    needed = ["spdx-license-identifier:", *LicenseScanner(templates, wordings).needed()]
    possible = reduce(Column.__or__, [low.contains(w) for w in needed if not any(x != w and x in w for x in needed)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = LicenseScanner(templates, wordings)
        for batch in batches:
            rows = [(d, *n) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()) for n in scanner.scan(t)]
            columns = list(zip(*rows)) or [()] * 8
            types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], [f.split()[0] for f in OUTPUT.split(", ")])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return spread(docs, "doc_id").where(possible).mapInArrow(run, OUTPUT)
