"""Characters that the regex module and a tokenizer's library put in different classes.

Which characters are letters or numbers depends on the Unicode version of whoever is asked, and pieces of a text on that. A library is asked once a process, about all
characters that regex takes for letters or numbers and that Unicode 3.2, which every library contains, doesn't. Those that it judges otherwise are replaced, one by one,
by stand-ins of the class that it sees, before regex splits a text; the pieces are then cut from the text itself, at the same places.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cached_property

#: A letter, a number and a symbol, of all versions; none takes part in a contraction.
LETTER, NUMBER, SYMBOL = "é", "²", "§"
#: Bytes of UTF-8 that lead no character from U+0540 on; those before are the same in all versions.
OLD_BYTES = bytes(range(0xD5))


def doubtful() -> dict[str, str]:
    """Characters that Unicode 3.2 has no letter or number class for, with regex's own class."""
    import regex

    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    old = unicodedata.ucd_3_2_0.category
    return {c: kind for kind, found in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}")) for c in regex.findall(found, every) if old(c)[0] not in "LN"}


def stand_ins(pieces_among: Callable[[str, list[str]], set[str]]) -> dict[int, str]:
    """str.translate table; pieces_among(text, candidates): which candidates are whole pieces of text by the library."""
    found = doubtful()
    forms = {c: [f"{space}{x}{c}{x}" for x in (LETTER, NUMBER) for space in (" ", "")] for c in found}
    whole = pieces_among("".join(x[i] for x in forms.values() for i in (0, 2)), [t for x in forms.values() for t in x])
    seen = {c: LETTER if whole.intersection(x[:2]) else NUMBER if whole.intersection(x[2:]) else SYMBOL for c, x in forms.items()}
    return {ord(c): seen[c] for c, kind in found.items() if seen[c] != kind}


class Splitter:
    """findall of a pattern without groups, by the library's classes; the library is asked when the first text comes that has a character of later alphabets."""

    def __init__(self, pattern: str, pieces_among: Callable[[str, list[str]], set[str]]):
        import regex

        self.findall, self.finditer, self.pieces_among = regex.compile(pattern).findall, regex.compile(pattern).finditer, pieces_among

    @cached_property
    def table(self) -> dict[int, str]:
        return stand_ins(self.pieces_among)

    @cached_property
    def odd(self) -> frozenset[str]:
        return frozenset(map(chr, self.table))

    def __call__(self, text: str) -> list[str]:
        # Most texts are told by their bytes alone.
        if text.isascii() or not text.encode("utf-8", "replace").translate(None, OLD_BYTES) or self.odd.isdisjoint(text):
            return self.findall(text)
        return [text[m.start() : m.end()] for m in self.finditer(text.translate(self.table))]
