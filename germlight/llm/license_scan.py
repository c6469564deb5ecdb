"""License scans by conditional compression.

Lines that speak of licences, with neighbouring lines that mostly use the templates' vocabulary, form candidate blocks. Each block is compressed alone, and
with each template as a raw Zstandard dictionary; the share of bytes that the dictionary saves ranks the templates. In that order every template whose telling
words the block has is checked by its exact wording: the words around each place of a telling word are aligned with the template, which is confirmed if they
have all of its telling words and, of the rest, enough. So a notice counts in a long line or among others as it does alone. Titles must be whole, and so must
identifiers in a machine-readable line and headings, which have a line of their own. A notice whose verb is negated is none. The differences are reported: words of the template that
the passage lacks, and those it changes. A match whose words are all part of another licence's longer one doesn't count. Of a licence's matches in one block the one that saves most is
reported, of those that tie the earlier template's: matches are counted by block and licence, not by notice. Time is linear in a text's lines.

Defined cases: a null or empty text, or one without such lines, has no blocks; repeated rows are each scanned; lines and texts of any length are whole; an
empty table gives an empty result; a null doc_id passes through; columns other than the named ones are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, replace
from difflib import SequenceMatcher
from functools import lru_cache
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from germlight.llm._shared import table

#: Public licence notices, and the words (with their number) without which a notice isn't that licence's.
TEMPLATES: tuple[tuple[str, str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache 2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.', "apache 2.0"),
    ("MIT", "Released under the MIT License.", "mit"),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.', "sublicense deal"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "with without fee"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.", "redistributions binary"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "redistributions endorse"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License.", "bsd 3-clause"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", "general public 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", "general public 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "general public 3"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "general public 2"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3.", "lesser public 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3.", "affero public 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "mozilla 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0.", "cc by 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", "cc by-sa 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", "cc by-nc 4.0"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0.", "cc by-nc-sa 4.0"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0.", "cc by-nd 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "commons attribution 4.0 international"),
    ("CC0-1.0", "This work has been dedicated to the public domain under CC0 1.0 Universal.", "cc0 1.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", "unencumbered public domain"),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1.", "lesser public 2.1"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "lesser public 2.1"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/", "eclipse public 2.0"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0.", "boost 1.0"),
    ("BSL-1.0", 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:', "organization transmit derivative"),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software.", "misrepresented alter freely"),
    ("Apache-2.0", "Licensed under the Apache 2.0 License.", "apache 2.0"),
    ("GPL-2.0", "Licensed under GPL-2.0.", "gpl-2.0"),
    ("GPL-2.0", "Licensed under the GPLv2.", "gplv2"),
    ("GPL-3.0", "Licensed under GPL-3.0.", "gpl-3.0"),
    ("GPL-3.0", "Licensed under the GPLv3.", "gplv3"),
    ("LGPL-2.1", "Licensed under LGPL-2.1.", "lgpl-2.1"),
    ("LGPL-2.1", "Licensed under the LGPLv2.1.", "lgplv2.1"),
    ("LGPL-3.0", "Licensed under LGPL-3.0.", "lgpl-3.0"),
    ("LGPL-3.0", "Licensed under the LGPLv3.", "lgplv3"),
    ("AGPL-3.0", "Licensed under AGPL-3.0.", "agpl-3.0"),
    ("AGPL-3.0", "Licensed under the AGPLv3.", "agplv3"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "commons attribution-sharealike 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "commons attribution-noncommercial 4.0"),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "commons attribution-noncommercial-sharealike 4.0"),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "commons attribution-noderivatives 4.0"),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", "commons attribution-noncommercial-noderivatives 4.0"),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0.", "cc by-nc-nd 4.0"),
    ("CC-BY-3.0", "Licensed under CC BY 3.0.", "cc by 3.0"),
    ("CC-BY-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License.", "commons attribution 3.0"),
    ("CC-BY-SA-3.0", "Licensed under CC BY-SA 3.0.", "cc by-sa 3.0"),
    ("CC-BY-SA-3.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.", "commons attribution-sharealike 3.0"),
    ("Artistic-2.0", "Distributed under the Artistic License 2.0.", "artistic 2.0"),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.", "with without fee"),
    ("BSD-3-Clause-Clear", "Redistribution and use in source and binary forms, with or without modification, are permitted (subject to the limitations in the disclaimer below) provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. No express or implied licenses to any party's patent rights are granted by this license.", "redistributions endorse patent"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License.", "bsd 2-clause"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0.", "mozilla 2.0"),
)
#: Titles of licence texts. They count where all their words follow each other.
TITLES: tuple[tuple[str, str], ...] = (
    ("MIT", "The MIT License (MIT)"),
    ("ISC", "ISC License"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("CC-BY-NC-SA-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International"),
    ("CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International"),
    ("CC-BY-NC-ND-4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International"),
)
#: Names that say so where they have a line of their own.
ALONE: tuple[tuple[str, str], ...] = (
    ("MIT", "MIT License"),
    ("MIT", "The MIT License"),
    ("Apache-2.0", "Apache License 2.0"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause-Clear", "The Clear BSD License"),
    ("0BSD", "BSD Zero Clause License"),
    ("Artistic-2.0", "The Artistic License 2.0"),
    ("Unlicense", "The Unlicense"),
    ("Zlib", "zlib License"),
    ("GPL-2.0", "GNU General Public License v2.0"),
    ("GPL-3.0", "GNU General Public License v3.0"),
    ("LGPL-2.1", "GNU Lesser General Public License v2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License v3.0"),
    ("AGPL-3.0", "GNU Affero General Public License v3.0"),
)
#: The tag of a machine-readable licence line, what joins identifiers there, and the endings of one licence's other identifiers.
TAG, JOINING, ENDINGS = "spdx-license-identifier", frozenset(("or", "and", "with")), ("", "-only", "-or-later")
TRIGGER = re.compile(r"licen[cs]e|copyright|warrant(?:y|ies)|redistribut|permission(?:\s+notice)?\s+is\s+hereby|permission\s+to\s+use|public\s+domain|free\s+software|spdx|creative\s+commons|cc0", re.I)
#: Least share of a template's words; share of template words that joins a line to a block.
LEAST_WORDS, VOCABULARY_SHARE, LEVEL = 0.7, 0.6, 9
#: Words that separate licences of one family: a notice doesn't go on past one that its template doesn't have.
CONTRADICTING = frozenset(
    "apache mit isc bsd mozilla lesser affero by-sa by-nc by-nc-sa by-nd by-nc-nd noncommercial sharealike noderivatives attribution-sharealike attribution-noncommercial "
    "attribution-noncommercial-sharealike attribution-noderivatives attribution-noncommercial-noderivatives 3.0 4.0".split()
)
#: What negates a notice's verb, words that may stand between them, and those verbs.
NEGATING, BETWEEN = frozenset("not never cannot isn aren wasn weren longer neither nor".split()), frozenset("been be being currently yet t".split())
VERBS = frozenset("licensed released distributed dedicated granted permitted available".split())

_WORD = re.compile(r"[^\W_]+(?:[.\-/][^\W_]+)*")


@dataclass(frozen=True)
class Match:
    license: str
    template: int
    saved: float
    words: float
    missing: tuple[str, ...] = ()
    changed: tuple[str, ...] = ()
    #: Places, among the block's words, of those that the template has.
    at: frozenset[int] = frozenset()


@dataclass
class _Template:
    license: str
    words: list[str]
    telling: frozenset[str]
    compressor: object
    kind: str = "notice"


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


@lru_cache(maxsize=1)
def _templates() -> tuple[list[_Template], frozenset[str]]:
    import zstandard

    named = dict.fromkeys(name for name, *_ in TEMPLATES)
    tags = [(name, f"{TAG} {name.lower()}{ending}") for name in named for ending in (ENDINGS if "GPL" in name else ("",))]
    made = []
    for kind, name, text, telling in [("notice", *x) for x in TEMPLATES] + [("title", *x, x[1]) for x in TITLES] + [("alone", *x, x[1]) for x in ALONE] + [("tag", *x, x[1]) for x in tags]:
        words = words_of(text)
        data = " ".join(words).encode()
        # Raw dictionaries have a least size; zeros in front of a short notice match nothing in a text.
        raw = zstandard.ZstdCompressionDict(bytes(max(0, 64 - len(data))) + data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        made.append(_Template(name, words, frozenset(words_of(telling)), zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_dict_id=False), kind))
    return made, frozenset(w for t in made for w in t.words)


def candidate_blocks(text: str | None) -> list[str]:
    """Blocks of consecutive lines around those that speak of licences."""
    if not text or not TRIGGER.search(text):
        return []
    _, vocabulary = _templates()
    blocks: list[list[str]] = []
    lines = text.split("\n")
    ends, marks = list(accumulate(len(x) + 1 for x in lines)), [False] * len(lines)
    for m in TRIGGER.finditer(text):  # words of one may stand on two lines
        for i in range(bisect_right(ends, m.start()), bisect_right(ends, m.end() - 1) + 1):
            marks[i] = True

    def joins(i: int) -> bool:
        words = words_of(lines[i])
        return bool(words) and sum(w in vocabulary for w in words) >= VOCABULARY_SHARE * len(words)

    until = -1
    for i, marked in enumerate(marks):
        if not marked or i <= until:
            continue
        first = i
        while first > until + 1 and joins(first - 1):
            first -= 1
        last = i
        while last + 1 < len(lines) and (marks[last + 1] or joins(last + 1)):
            last += 1
        blocks.append(lines[first : last + 1])
        until = last
    return ["\n".join(b) for b in blocks]


def _around(words: list[str], vocabulary: frozenset[str]) -> list[str]:
    """Of a long block, the words from the first to the last run that templates share: notices often end a line of other text."""
    shared = [i for i in range(len(words) - 1) if words[i] in vocabulary and words[i + 1] in vocabulary]
    return words[shared[0] : shared[-1] + 2] if shared else words


def ranked(block: str) -> list[tuple[float, int]]:
    """(share of bytes saved, template) of every template, best first."""
    import zstandard

    templates, vocabulary = _templates()
    data = " ".join(_around(words_of(block), vocabulary)).encode()
    alone = len(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False).compress(data))
    saved = [(1 - len(t.compressor.compress(data)) / alone, i) for i, t in enumerate(templates)]
    return sorted(saved, key=lambda x: (-x[0], x[1]))


def passages(words: list[str], template: int, starts: frozenset[int] = frozenset()) -> Iterator[Match]:
    """The confirmed matches of a template with passages of a block's words, in order. starts: places where lines start, and the end."""
    t = _templates()[0][template]
    if t.kind == "notice":
        yield from _notices(words, t, template)
    elif t.kind in ("title", "alone"):
        n = len(t.words)
        for at in (i for i, w in enumerate(words) if w == t.words[0] and words[i : i + n] == t.words):
            if t.kind == "alone" and not (at in starts and at + n in starts):
                continue
            yield Match(t.license, template, 0.0, 1.0, at=frozenset(range(at, at + n)))
    else:
        known = {x.words[1] for x in _templates()[0] if x.kind == "tag"}
        for at in (i for i, w in enumerate(words) if w == TAG):
            for i in range(at + 1, len(words)):
                if words[i] == t.words[1]:
                    yield Match(t.license, template, 0.0, 1.0, at=frozenset((at, i)))
                if not (words[i] in known or words[i] in JOINING or words[i].endswith("exception")):
                    break


def _notices(words: list[str], t: _Template, template: int) -> Iterator[Match]:
    """Passages around the rarest of the telling words, up to words that contradict the template, aligned word by word."""
    anchor, reach, need, after = min(t.telling, key=words.count), 2 * len(t.words), LEAST_WORDS * len(t.words), 0
    others = CONTRADICTING - set(t.words)
    borders = [-1, *(i for i, w in enumerate(words) if w in others), len(words)]
    for at in (i for i, w in enumerate(words) if w == anchor):
        if at < after:
            continue
        k = bisect_right(borders, at)
        low, high = max(after, at - reach, borders[k - 1] + 1), min(at + reach + 1, borders[k])
        part = words[low:high]
        have = set(part)
        if not t.telling <= have or sum(w in have for w in t.words) < need:
            continue
        ops = SequenceMatcher(None, t.words, part, autojunk=False).get_opcodes()
        equal = [x for x in ops if x[0] == "equal"]
        shared = [w for _, i1, i2, _, _ in equal for w in t.words[i1:i2]]
        if len(shared) < need or not t.telling <= set(shared):
            continue
        first, last = equal[0][3], equal[-1][4]
        after = low + last
        if _negated(part, frozenset(j for _, _, _, j1, j2 in equal for j in range(j1, j2))):
            continue
        inside = lambda op, j1, j2: op == "replace" and first <= j1 and j2 <= last  # noqa: B023, E731
        missing = tuple(w for op, i1, i2, j1, j2 in ops if op in ("delete", "replace") and not inside(op, j1, j2) for w in t.words[i1:i2])
        changed = tuple(f"{' '.join(t.words[i1:i2])} -> {' '.join(part[j1:j2])}" for op, i1, i2, j1, j2 in ops if inside(op, j1, j2))
        yield Match(t.license, template, 0.0, len(shared) / len(t.words), missing, changed, frozenset(low + j for _, _, _, j1, j2 in equal for j in range(j1, j2)))


def _negated(words: list[str], matched: frozenset[int]) -> bool:
    """Whether a word that isn't the template's negates one of its verbs."""
    for j in matched:
        if words[j] in VERBS:
            i = j - 1
            while i >= 0 and i not in matched and words[i] in BETWEEN:
                i -= 1
            if i >= 0 and i not in matched and words[i] in NEGATING:
                return True
    return False


def _own(every: list[Match]) -> list[Match]:
    """Those whose words aren't all part of another licence's longer match: of the matches that have one of its words, only."""
    having: dict[int, list[Match]] = {}
    for m in every:
        for i in m.at:
            having.setdefault(i, []).append(m)
    return [m for m in every if not any(m.at < x.at and m.license != x.license for x in having[min(m.at)])]


def scan(text: str | None) -> tuple[int, list[Match]]:
    """Number of candidate blocks, and their confirmed matches: of each licence in a block the one that saves most."""
    blocks, found = candidate_blocks(text), []
    for block in blocks:
        words = words_of(block)
        have = set(words)
        starts = frozenset(accumulate((len(words_of(line)) for line in block.split("\n")), initial=0))
        told = {i for i, t in enumerate(_templates()[0]) if t.telling <= have}
        every = [replace(m, saved=saved) for saved, i in (ranked(block) if told else ()) if i in told for m in passages(words, i, starts)]
        best: dict[str, Match] = {}
        for m in _own(every):
            best.setdefault(m.license, m)
        found += best.values()
    return len(blocks), found


_SCHEMA = "n_blocks long, licenses string, n_matches long, saved double, n_missing long, n_changed long"


def scanned(text: Column) -> Column:
    """A struct: blocks, distinct licences (sorted, comma-joined), matches, most bytes saved, and words missing and passages changed over all matches."""

    @F.pandas_udf(_SCHEMA)
    def each(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            n, found = scan(t)
            rows.append((n, ",".join(sorted({m.license for m in found})), len(found), max((m.saved for m in found), default=0.0), sum(len(m.missing) for m in found), sum(len(m.changed) for m in found)))
        return pd.DataFrame(rows, columns=["n_blocks", "licenses", "n_matches", "saved", "n_missing", "n_changed"])

    return each(text)


def matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each confirmed match: id, block (its number in the text), license, saved, words, missing, changed."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for key, text in zip(frame["id"], frame["text"]):
                for k, block in enumerate(candidate_blocks(text)):
                    _, found = scan(block)
                    if found:
                        yield pd.DataFrame([(key, k, m.license, m.saved, m.words, " ".join(m.missing), "; ".join(m.changed)) for m in found], columns=["id", "block", "license", "saved", "words", "missing", "changed"])

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").rlike(f"(?i){TRIGGER.pattern}"))
    return rows.mapInPandas(each, f"id {kind}, block int, license string, saved double, words double, missing string, changed string").withColumnRenamed("id", id_col)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the summary of `scanned` of every row; a narrow plan."""
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    return docs.select(F.col(id_col), scanned(F.col(text_col)).alias("_s")).select(id_col, *(f"_s.{x}" for x in names))


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
