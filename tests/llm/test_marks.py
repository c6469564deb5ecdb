"""License notices in long lists, short forms and negated; pages in forms, deep nesting, hidden text and unmarked comments."""

import time
import tracemalloc

import pytest

from germlight.llm import html_text, license_scan

LONG = " ".join("The quick brown fox is in the garden and it was with the dog that they have been to see on".split() * 3)


def found(text):
    return sorted({m.license for m in license_scan.scan(text)[1]})


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]),
        ("Creative Commons Attribution-NonCommercial 4.0 International License", ["CC-BY-NC-4.0"]),
        ("Licensed under the Apache 2.0 license", ["Apache-2.0"]),
        ("Licensed under GPL-3.0", ["GPL-3.0"]),
        ("licensed under CC BY 3.0", ["CC-BY-3.0"]),
        ("Licensed under CC BY 3.0. Node 4.0 is needed.", ["CC-BY-3.0"]),
        ("MIT License\n\nCopyright (c) 2020 A", ["MIT"]),
        ("People like the MIT License for this", []),
        ("Not released under the MIT License.", []),
        ("This work is not licensed under the GNU General Public License, version 2.", []),
        ("It is no longer licensed under the Apache License, Version 2.0.", []),
        ("Nobody is liable, not ever. Released under the MIT License.", ["MIT"]),
    ],
)
def test_short_forms_and_negation(text, expected):
    assert found(text) == expected


def test_every_template_alone_is_its_licence():
    for name, text, _ in license_scan.TEMPLATES:
        assert found(text) == [name], text
    for name, text in license_scan.ALONE:
        assert found(text) == [name], text


def test_own_is_the_pairwise_definition():
    texts = [text for _, text, _ in license_scan.TEMPLATES]
    words = license_scan.words_of("\n".join(texts[::2] + texts[1::3]))
    every = [m for i in range(len(license_scan._templates()[0])) for m in license_scan.passages(words, i)]
    assert len(every) > 40
    assert license_scan._own(every) == [m for m in every if not any(m.at < x.at and m.license != x.license for x in every)]


def test_long_lists_take_linear_time():
    def seconds(n):
        start = time.process_time()
        assert found("\n".join(["Released under the MIT License."] * n)) == ["MIT"]
        return time.process_time() - start

    seconds(500)
    assert seconds(16_000) < 12 * max(seconds(4_000), 0.1)


def test_forms_around_a_page_are_no_forms():
    text = html_text.main_text
    assert text(f'<form id="aspnetForm"><input type=hidden name=v><div class=menu><a href=x>Home</a></div><p>{LONG}</p><p>Short.</p><input name=q></form>') == f"{LONG} Short."
    assert text(f"<form><fieldset><p>{LONG}</p></fieldset></form>") == LONG
    assert text(f"<p>{LONG}</p><form><p>{LONG[:200]}</p><input><input></form>") == LONG
    assert text(f"<form><p>{LONG}</p>{'<input name=a>' * 5}</form>") == ""
    assert text(f"<form><nav><p>{LONG}</p></nav><p>Name</p><input></form>") == ""


def test_hidden_text_and_comment_sections():
    text = html_text.main_text
    assert text(f'<div><p>{LONG}</p><p style="color: red; display: none">{LONG}</p></div>') == LONG
    assert text(f'<div style="display:block"><p>{LONG}</p></div>') == LONG
    assert text(f"<div><p>{LONG}</p></div><section><h3>Comments</h3><div><p>{LONG}</p></div></section>") == LONG
    assert text(f"<article><p>{LONG}</p><section><h3>12 comments</h3><div><p>{LONG}</p></div></section></article>") == LONG
    assert text(f"<article><h1>Python</h1><section><h3>Comments</h3><p>{LONG}</p></section></article>") == f"Python Comments {LONG}"
    assert text(f"<div><p>{LONG}</p><h3>Comments</h3><p>{LONG}</p></div>") == f"{LONG} Comments {LONG}"


@pytest.mark.parametrize("html", ["<nav>", "<form>", "<div style='display:none'>", "<p><table><div></section>", "<main><nav><h1>a"])
def test_deep_nesting_takes_linear_memory(html):
    def peak(n):
        tracemalloc.start()
        html_text.main_text(html * n)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    assert peak(20_000) < 6 * peak(5_000)
    assert peak(20_000) < 64 << 20
