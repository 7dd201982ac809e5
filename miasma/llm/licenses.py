"""License scans by conditional compression.

A block of text that repeats a license template compresses to almost nothing once the compressor
knows the template. So each candidate block is compressed twice, plainly and with a template as
zstandard raw dictionary; templates are ranked by the share of bytes saved. The winner must then
hold up word by word: the exact differences between its wording and the block's are worked out, and
the block counts as that license only if few words differ, and none that names a license or its
version (``NAMES``, and any word with a digit). The differences are part of the result.

Candidates are cues, words that licenses speak of. The block for a template is the span of words
around a cue that aligns with the template at the fewest differences, wherever it begins and ends
within a line and over however many lines it runs; words before and behind it count for nothing.
Cues are found in Catalyst expressions, so only documents with one reach Python. One pass, no
shuffle.

Defined cases: null and empty texts give no row; a cue inside a block already confirmed starts no
block of its own; of several templates that hold up at a cue the one with most words in common
counts, then by savings, fewer differences and name; documents that repeat give their rows each;
input columns beside id and text are ignored. Case and punctuation are not compared.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import cached_property

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from miasma.llm.common import slices, texts_of

CUE = r"(?i)licen[sc]e|copyright|rights reserved|spdx|creative commons|\bcc by|public domain|without warranty|hereby granted|redistribution and use|free software"
MIN_SAVED = 0.25
MAX_DIFFERENT = 0.25

# Words that tell licenses apart; one that differs is another license.
NAMES = frozenset("""mit x11 expat apache gnu gpl lgpl agpl lesser library affero free bsd isc mozilla mpl eclipse epl cc by by-sa by-nc
    by-nd by-nc-sa by-nc-nd attribution attribution-sharealike attribution-noncommercial attribution-noderivatives attribution-noderivs
    attribution-noncommercial-sharealike attribution-noncommercial-noderivatives attribution-noncommercial-noderivs sharealike
    noncommercial noderivatives noderivs zero unlicense boost clause simplified revised new original clear artistic zlib not no non""".split())

# Public wordings of common licenses and notices.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "BSD-2-Clause OR BSD-3-Clause": [  # their first sentence is the same
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "EPL-1.0": ["All rights reserved. This program and the accompanying materials are made available under the terms of the "
                "Eclipse Public License v1.0 which accompanies this distribution"],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0."],
    "CC0-1.0": ["This work has been dedicated to the public domain under CC0 1.0.", "under CC0 1.0 Universal Public Domain Dedication license"],
    "all-rights-reserved": ["All rights reserved."],
}
# The two clauses that both BSD licenses have, and the third.
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: {} Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. {} Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.")
_BSD_3 = (" {} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
          "products derived from this software without specific prior written permission.")
_BSD_END = " This software is provided by the copyright holders and contributors \"as is\""
# Names by which a license is given, after "under the".
_TITLES = {
    "MIT": ["MIT License", "MIT/X11 License", "Expat License"],
    "Apache-2.0": ["Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License", "Apache License v2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Revised BSD License", "BSD-3-Clause License"],
    "ISC": ["ISC License"], "Unlicense": ["Unlicense license"], "BSL-1.0": ["Boost Software License 1.0"],
    "MPL-1.1": ["Mozilla Public License 1.1", "Mozilla Public License, version 1.1"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL 2.0 license", "MPL-2.0 license"],
    "EPL-1.0": ["Eclipse Public License 1.0", "Eclipse Public License, version 1.0", "Eclipse Public License v1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License, version 2.0", "Eclipse Public License v2.0"],
}
_GNU = {"GPL": ("GNU General Public License", "2.0 3.0"), "AGPL": ("GNU Affero General Public License", "3.0"),
        "LGPL": ("GNU Lesser General Public License", "2.1 3.0")}
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
       "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
       "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}


def _complete() -> None:
    """Wordings that differ by name and version only."""
    def add(name: str, *texts: str) -> None:
        own = TEMPLATES.setdefault(name, [])
        own += [t for t in texts if t not in own]

    for name, titles in _TITLES.items():
        add(name, *(f"under the {t}" for t in titles), f"SPDX-License-Identifier: {name}")
    add("CC0-1.0", "SPDX-License-Identifier: CC0-1.0")
    for numbers in (("", ""), ("1.", "2.")):
        add("BSD-2-Clause", _BSD.format(*numbers) + _BSD_END)
        add("BSD-3-Clause", _BSD.format(*numbers) + _BSD_3.format("3." if numbers[0] else ""))
    for short, (title, versions) in _GNU.items():
        for version in versions.split():
            name, numbers = f"{short}-{version}", {version, version.removesuffix(".0")}
            add(name, *(f"SPDX-License-Identifier: {name}{end}" for end in ("", "-only", "-or-later")))
            for n in sorted(numbers):
                add(name, f"This work is licensed under the {title}, version {n}.", f"Licensed under the {title}, version {n}.",
                    f"under the {title} v{n}", f"under the {title} {n}", f"under the {short}v{n} license", f"under the {short} v{n} license",
                    f"under the {short} {n} license", f"under the {short}-{n} license", f"under the GNU {short} version {n} license")
                for either in ("", " either"):
                    add(name, "you can redistribute it and/or modify it under the terms of the "
                              f"{title} as published by the Free Software Foundation,{either} version {n} of the License")
                add(name, "This program is free software: you can redistribute it and/or modify it under the terms of the "
                          f"{title} as published by the Free Software Foundation, either version {n} of the License, or "
                          "(at your option) any later version.")
    add("LGPL-2.0", "under the GNU Library General Public License, version 2",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.")
    for kind, title in _CC.items():
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            name = f"CC-{kind}-{version}"
            end = {"4.0": " International", "3.0": " Unported"}.get(version, " Generic")
            titles = {title, title.replace("NoDerivatives", "NoDerivs")}
            add(name, f"Licensed under CC {kind} {version}.", f"under the CC {kind} {version} license", f"under a CC-{kind}-{version} license",
                f"SPDX-License-Identifier: {name}",
                *(text for t in sorted(titles) for text in (
                    f"This work is licensed under a Creative Commons {t} {version}{end} License.",
                    f"under a Creative Commons {t} {version} License", f"Creative Commons {t} {version}{end}")))


_complete()
_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


class Template:
    def __init__(self, name: str, text: str):
        self.name, self.text, self.words = name, text, words(text)
        self.names = frozenset(w for w in self.words if names_a_license(w))
        self.counts, self.limit = Counter(self.words), int(MAX_DIFFERENT * len(self.words))
        self.reach = len(self.words) + self.limit

    @cached_property
    def compressor(self) -> zstandard.ZstdCompressor:
        known = zstandard.ZstdCompressionDict(" ".join(self.words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return _compressor(known)


def _compressor(known: zstandard.ZstdCompressionDict | None = None) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=3, dict_data=known, write_checksum=False, write_content_size=False,
                                    write_dict_id=False)


def templates(source: dict[str, list[str]] = TEMPLATES) -> list[Template]:
    return [Template(name, text) for name, texts in source.items() for text in texts]


def names_a_license(word: str) -> bool:
    return word in NAMES or any(c.isdigit() for c in word)


def differences(block: list[str], template: list[str]) -> list[str]:
    """Exact differences in wording: ``-word`` only in the template, ``+word`` only in the block."""
    out = []
    for kind, a, b, c, d in SequenceMatcher(None, template, block, autojunk=False).get_opcodes():
        if kind != "equal":
            out += [f"-{w}" for w in template[a:b]] + [f"+{w}" for w in block[c:d]]
    return out


def aligned(template: list[str], region: list[str], at: int, limit: int) -> tuple[int, int] | None:
    """The span of ``region`` over word ``at`` that differs from the template by the fewest words
    left out or put in, at most ``limit``."""
    cost, start = [0] * (len(region) + 1), list(range(len(region) + 1))
    for i, word in enumerate(template, 1):
        above, from_above = cost, start
        cost, start = [i], [0]
        for j, other in enumerate(region, 1):
            if word == other:
                cost.append(above[j - 1])
                start.append(from_above[j - 1])
            elif above[j] <= cost[j - 1]:
                cost.append(above[j] + 1)
                start.append(from_above[j])
            else:
                cost.append(cost[j - 1] + 1)
                start.append(start[j - 1])
    found = [(c, j - b, b, j) for j, (c, b) in enumerate(zip(cost, start)) if c <= limit and b <= at < j]
    return min(found)[2:] if found else None


class Scanner:
    def __init__(self, source: dict[str, list[str]] = TEMPLATES):
        self.templates, self.plain, self.cue = templates(source), _compressor(), re.compile(CUE)

    def scan(self, text: str) -> Iterator[tuple[int, int, str, str, int, int, float, list[str]]]:
        """(line, lines, license, block, plain bytes, conditional bytes, share saved, differences)."""
        starts, ends = array("Q"), array("Q")
        for m in _WORD.finditer(text):
            starts.append(m.start())
            ends.append(m.end())
        after, line, counted, last = 0, 0, 0, -1
        for cue in self.cue.finditer(text):
            at = bisect_right(ends, cue.start())
            if at < after or at == last or at == len(starts):
                continue
            last = at
            found = self._best(text, starts, ends, at, after)
            if found:
                first, after, *rest = found
                begin, end = starts[first], ends[after - 1]
                line, counted = line + text.count("\n", counted, begin), begin
                while end < len(text) and not (text[end].isalnum() or text[end].isspace()):
                    end += 1
                block = text[begin:end]
                yield line, block.count("\n") + 1, rest[0], " ".join(block.split()), *rest[1:]

    def _best(self, text: str, starts: array, ends: array, at: int, after: int) -> tuple | None:
        """The template that holds up in its wording around a cue, with its span of words."""
        most = max(t.reach for t in self.templates)
        low = max(after, at - most)
        near = [text[starts[i]:ends[i]].lower() for i in range(low, min(len(starts), at + most))]
        seen = set(near)
        best = key = None
        for t in self.templates:
            if not t.names <= seen or sum(n for w, n in t.counts.items() if w not in seen) > t.limit:
                continue
            shift = max(0, at - low - t.reach)
            span = aligned(t.words, near[shift:at - low + t.reach], at - low - shift, t.limit)
            if not span:
                continue
            block = near[shift + span[0]:shift + span[1]]
            differ = differences(block, t.words)
            if len(differ) > t.limit or any(names_a_license(d[1:]) for d in differ):
                continue
            data = " ".join(block).encode()
            plain, given = len(self.plain.compress(data)), len(t.compressor.compress(data))
            saved = 1 - given / plain
            same = len(t.words) - sum(d[0] == "-" for d in differ)
            rank = (-same, -saved, len(differ), t.name)
            if saved >= MIN_SAVED and (key is None or rank < key):
                key = rank
                best = low + shift + span[0], low + shift + span[1], t.name, plain, given, saved, differ
        return best


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         source: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """One row per license block: (id, line, n_lines, license, block, plain_bytes,
    conditional_bytes, saved, differences)."""
    names = ["id", "line", "n_lines", "license", "block", "plain_bytes", "conditional_bytes", "saved", "differences"]
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(source)
        for batch in slices(batches, "text"):
            ids, rows = [], []
            for i, text in enumerate(texts_of(batch.column("text"))):
                for row in scanner.scan(text.decode("utf-8", "replace")):
                    ids.append(i)
                    rows.append(row)
            columns = list(zip(*rows)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(ids, pa.int64())), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.filter(F.col("text").rlike(CUE)).mapInArrow(
        run, f"id {kind}, line int, n_lines int, license string, block string, plain_bytes int, "
             "conditional_bytes int, saved double, differences array<string>")
