"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level markup, with ends of elements that are left out. The first pass decides a block by where it stands (menus, forms, footers and
the like, by element, role, or class and id words; a form or marked element that holds the main element or an article's title isn't what its mark says, unless it is of readers' comments; nor is a
form or fieldset around most of the page's text that has few controls for it; a section that begins with a heading of comments is of readers), by its link
density, its length and its density of stop words. Long blocks inside an article or main element need no stop words, and neither do those of a page in a
language whose stop words aren't listed; scripts without spaces are measured in characters. Short or middling blocks stay undecided, and in the second pass take the label of the nearest decided block, those of an article that of its nearest
one inside. Kept blocks are joined in page order. Time and memory are linear in the page, however deep its elements are nested.

Defined cases: a null or empty html has an empty text; unclosed or stray tags, comments and quotes are read as far as they go; where no block is
decided, those inside an article or main element are kept and others are not; repeated rows are each extracted; pages of any length are whole; an empty
table gives an empty result; a null page_id or url passes through; columns other than the named ones are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from germlight.llm._shared import table

#: Elements by their part in a page, and words of class, id and role that mark what isn't the article.
RAW = frozenset("script style noscript template textarea title iframe object svg canvas select math audio video".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog button fieldset label".split())
CONTENT = frozenset("article main".split())
CONTAINERS = frozenset("html body div section article main nav header footer aside form menu dialog ul ol dl table tbody thead tfoot tr td th blockquote figure details fieldset".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr address figcaption caption summary center option button label".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("br img input hr meta link area base col embed source track wbr".split())
#: What an element's start ends when it is still open, and the elements past which it ends nothing.
ENDS = {
    **dict.fromkeys(BLOCKS - frozenset("html body li dt dd tr td th tbody thead tfoot option button label caption".split()), (frozenset(["p"]), frozenset("td th caption table button".split()))),
    **dict.fromkeys(["li"], (frozenset(["li"]), frozenset("ul ol menu table td th".split()))),
    **dict.fromkeys(["dt", "dd"], (frozenset(["dt", "dd"]), frozenset("dl table td th".split()))),
    **dict.fromkeys(["td", "th"], (frozenset(["td", "th", "caption"]), frozenset("tr table".split()))),
    **dict.fromkeys(["tr"], (frozenset(["tr", "caption"]), frozenset(["table"]))),
    **dict.fromkeys(["tbody", "thead", "tfoot"], (frozenset(["tbody", "thead", "tfoot", "caption", "tr"]), frozenset(["table"]))),
    "option": (frozenset(["option"]), frozenset("table td th".split())),
    "a": (frozenset(["a"]), BLOCKS),
}
WORDS_AGAINST = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies copyright "
    "disclaimer discussion disqus feedback footer gdpr login menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup "
    "privacy promo promoted promotion related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar "
    "topbar widget widgets alert complementary contentinfo".split()
)
#: Of a compound mark such as site-footer, the words that may stand beside one against; with any other the compound says something else.
BESIDE = frozenset(
    "area article articles aside bar block body bottom box boxes button buttons card cards center col column container content desktop entry fixed form global group holder "
    "home icons inner item items js layout left link links list lower main middle mobile module news nojs outer page panel policy post posts primary reader readers region right row "
    "secondary section site slot small stories story sub text thread title top trail unit upper user users view wrap wrapper".split()
)
#: Against a block only outside an article: an article may have a head of its own. Against an article or main element itself.
OUTSIDE_AGAINST, READERS = frozenset("header masthead".split()), frozenset("comment comments reply replies respond disqus".split())
STOP_WORDS = frozenset(
    (
        "the of and to in is was that it for on with as are be this by at from or have not but they which you an were their has will would can if "
        "der die das und den dem des ein eine einer ist im von zu mit für auf nicht sich es auch als an werden aus er hat dass sie nach bei um am sind noch wie einem "
        "le la les de des du un une et est en que qui dans pour pas sur au avec ce il elle sont plus par ne se aux cette "
        "el los las del y que en un una por con no para es se al lo como más su sus o pero este esta"
    ).split()
)
#: Elements that may be wrapped around a whole page, and what makes them a form after all. Hidden controls don't count.
WRAPPERS, CONTROLS = frozenset("form fieldset".split()), frozenset("input select textarea button".split())
LINK_DENSITY, LINK_LIST, SHORT, LONG, STOPS_LOW, STOPS_HIGH = 0.4, 0.8, 10, 25, 0.1, 0.2

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
_END = {tag: re.compile(rf"</{tag}\b[^>]*>?", re.I) for tag in RAW}
_MARKS = re.compile(r"""(?:^|[\s"'/])(class|id|role|aria-hidden|hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?(?=[\s/]|$)""", re.I)
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
_HIDDEN_CONTROL = re.compile(r"""(?:^|[\s"'/])type\s*=\s*["']?hidden\b""", re.I)
#: Headings of readers' comments: those that nothing else has, and those that an article's own section may have.
_COMMENTS = re.compile(r"(?:\d+ (?:reader )?(?:comments?|replies|responses)|(?:reader )?comments? \(\d+\)|reader comments|leave a (?:comment|reply)|(?:post|add) a comment|join the (?:conversation|discussion))\W*", re.I)
_COMMENTS_OUTSIDE = re.compile(r"(?:comments?|replies|responses|discussion)\W*", re.I)
_PART = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
#: Characters of scripts that put no spaces between words; two or so are a word.
_UNSPACED = re.compile("[฀-໿က-႟ក-៿぀-ヿ㐀-鿿豈-﫿\U00020000-\U0003ffff]")
_STRIPPED = ".,;:!?\"'()#*$%&|-"


@dataclass
class Block:
    text: str
    link_chars: int
    content: bool
    against: bool
    heading: bool
    keep: bool | None = None
    words: int = 0
    stops: int = 0

    @property
    def links(self) -> float:
        return self.link_chars / max(1, len("".join(self.text.split())))


@dataclass(eq=False)
class _Mark:
    """That an element holds something else than the article, and the mark of what it is in."""

    outer: _Mark | None
    lasting: bool  # what it holds can't refute it
    wraps: bool = False
    holds: bool = True
    asked: bool = False  # refuted already, as far as that goes, with all outer ones
    against: bool = False
    words: int = 0
    long: bool = False
    controls: int = 0


@dataclass(eq=False)
class _Element:
    tag: str
    content: bool
    link: bool
    mark: _Mark | None  # its own, or that of what it is in
    first: int = 0  # number of the block that it begins with


def _marked(value: str, words: frozenset[str]) -> bool:
    """Whether one of the marks says so: all its parts are of words, or some and the rest of BESIDE."""
    for mark in value.split():
        parts = [x for x in _PART.findall(_CAMEL.sub(" ", mark).lower()) if len(x) > 1 and not x.isdigit()]
        if any(x in words for x in parts) and all(x in words or x in BESIDE for x in parts):
            return True
    return False


def _against(tag: str, attributes: str, inside: bool) -> str:
    """Whether an element holds something else than the article: by its name or state, by its marks (which what it holds may refute), or not."""
    if tag in BOILERPLATE or (tag == "header" and not inside):
        return "mark" if tag in WRAPPERS else "name"
    if not attributes or tag in ("html", "body"):
        return ""
    found = ""
    for name, value in _MARKS.findall(attributes):
        name, value = name.lower(), unescape(value.strip("\"'"))
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return "name"
        if name == "style":
            found = "mark" if _UNSEEN.search(value) else found
        elif name != "aria-hidden":
            if _marked(value, READERS):
                return "name"  # comments have titles and articles of their own
            if tag not in CONTENT and _marked(value, WORDS_AGAINST if inside else WORDS_AGAINST | OUTSIDE_AGAINST):
                found = "mark"
    return found


def blocks_of(html: str) -> list[Block]:
    """The page's blocks of text, those of boilerplate elements included. Elements whose end is left out end where their container or the next one of their kind says so."""
    found: list[tuple[Block, _Mark | None]] = []
    marks: list[_Mark] = []  # outer ones first
    text: list[str] = []
    open_ = [_Element("", False, False, None)]
    places: dict[str, list[int]] = {}  # of the open elements, by tag and of all blocks
    block_places: list[int] = []
    link_chars, heading, at = 0, False, 0

    def put(part: str) -> None:
        nonlocal link_chars
        if part:
            part = unescape(part)
            text.append(part)
            if open_[-1].link:
                link_chars += len("".join(part.split()))

    def flush() -> None:
        nonlocal link_chars
        if text:
            if whole := " ".join("".join(text).split()):
                if heading:
                    comments(whole)
                found.append((Block(whole, link_chars, open_[-1].content, False, heading), open_[-1].mark))
            text.clear()
            link_chars = 0

    def mark(k: int, lasting: bool, wraps: bool = False) -> None:
        """Marks the open elements from place k on, and what they will hold."""
        marks.append(_Mark(open_[k - 1].mark, lasting, wraps))
        for e in open_[k:]:
            e.mark = marks[-1]

    def comments(title: str) -> None:
        """Marks the section that begins with this heading, if that is one of readers' comments."""
        k = max((places[h][-1] for h in HEADINGS if places.get(h)), default=0) - 1
        if k > 0 and open_[k].tag in ("section", "div", "aside") and open_[k].first == len(found) and (_COMMENTS.fullmatch(title) or (not open_[k].content and _COMMENTS_OUTSIDE.fullmatch(title))):
            mark(k, True)

    def close(k: int) -> None:
        """Ends the elements from place k on."""
        if any(e.tag in BLOCKS or e.mark is not open_[k - 1].mark for e in open_[k:]):
            flush()
        for e in open_[k:]:
            places[e.tag].pop()
            if e.tag in BLOCKS:
                block_places.pop()
        del open_[k:]

    def place(tags: frozenset[str], borders: frozenset[str]) -> int:
        """Where the innermost open element of tags is, unless one of borders is further in; 0 if there is none."""
        k = max((places[t][-1] for t in tags if places.get(t)), default=0)
        if not k:
            return 0
        edge = (block_places[-1] if block_places else 0) if borders is BLOCKS else max((places[t][-1] for t in borders if places.get(t)), default=0)
        return k if k >= edge else 0

    while m := _TOKEN.search(html, at):
        put(html[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                put(m[0][9:].removesuffix("]]>"))
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in RAW and not closing and not attributes.endswith("/"):
            end = _END[tag].search(html, at)
            at = end.end() if end else len(html)
            continue
        if tag == "br":
            put(" ")
        elif closing:
            if tag in BLOCKS:
                flush()
                heading = False
            # The end of an inline element ends no block that was begun in it.
            borders = frozenset(("table", "td", "th") if tag not in ("table", "tr", "td", "th", "tbody", "thead", "tfoot", "html", "body") else ("table",) if tag != "table" else ())
            if k := place(frozenset((tag,)), borders if tag in BLOCKS else BLOCKS):
                close(k)
        else:
            if tag in ENDS and (k := place(*ENDS[tag])):
                close(k)
            if tag in BLOCKS:
                flush()
                heading = tag in HEADINGS
            top = open_[-1]
            content = top.content or tag in CONTENT
            if tag == "main" or (tag == "h1" and content):
                outer = top.mark  # what holds the article itself isn't what its mark says
                while outer is not None and not outer.asked:
                    outer.asked, outer.holds = True, outer.holds and outer.lasting
                    outer = outer.outer
            if tag in CONTROLS and top.mark is not None and not _HIDDEN_CONTROL.search(attributes):
                top.mark.controls += 1
            if tag not in VOID and not attributes.endswith("/"):
                kind = _against(tag, attributes, content)
                if kind and tag not in BLOCKS:
                    flush()
                open_.append(_Element(tag, content, top.link or tag == "a", top.mark, len(found)))
                places.setdefault(tag, []).append(len(open_) - 1)
                if tag in BLOCKS:
                    block_places.append(len(open_) - 1)
                if kind:
                    mark(len(open_) - 1, kind == "name" or bool(top.content and tag not in CONTENT), tag in WRAPPERS)
    put(html[at:])
    flush()
    _unwrap(found, marks)
    for m in marks:
        m.against = m.holds or (m.outer is not None and m.outer.against)
    for b, m in found:
        b.against = m is not None and m.against
    return [b for b, _ in found]


def _unwrap(found: list[tuple[Block, _Mark | None]], marks: list[_Mark]) -> None:
    """Refutes the marks of forms and fieldsets that are wrapped around the page: with more than half of the text that nothing else is against, a long block, and LONG words a control."""
    if not any(m.wraps and m.holds for m in marks):
        return
    for m in marks:
        m.against = (m.holds and not m.wraps) or (m.outer is not None and m.outer.against)
    total = 0
    for b, m in found:
        if (m is None or not m.against) and b.links <= LINK_DENSITY:
            _measure(b)
            total += b.words
            if m is not None:
                m.words, m.long = m.words + b.words, m.long or b.words >= LONG
    for m in reversed(marks):
        if m.outer is not None and not m.against:
            m.outer.words, m.outer.long, m.outer.controls = m.outer.words + m.words, m.outer.long or m.long, m.outer.controls + m.controls
        if m.wraps and m.long and 2 * m.words > total and m.words >= LONG * m.controls:
            m.holds = False


def _measure(b: Block) -> None:
    words = b.text.split()
    b.stops = sum(w.strip(_STRIPPED).lower() in STOP_WORDS for w in words)
    b.words = max(len(words), len(_UNSPACED.findall(b.text)) // 2)


def _first(b: Block, known: bool) -> bool | None:
    """The first pass: a block's own label, or none. known: whether the page is in a language whose stop words are listed."""
    if b.against:
        return False
    density = b.stops / max(1, b.words)
    if b.content:
        # An article may link much and use few stop words: only long lists of links are decided against it.
        if b.links > LINK_LIST:
            return False if b.words >= LONG else None
        return True if b.words >= LONG or (b.words >= SHORT and (density >= STOPS_LOW or not known)) else None
    if b.links > LINK_DENSITY:
        return False
    if "©" in b.text and b.words < LONG:
        return False
    if b.words < SHORT:
        return None
    if not known:
        return True if b.words >= LONG else None
    if density >= STOPS_HIGH:
        return True if b.words >= LONG else None
    return None if density >= STOPS_LOW else False


def _known(blocks: list[Block]) -> bool:
    """Whether the text that may be the article has enough of the listed stop words for them to tell."""
    some = [b for b in blocks if not b.against and b.links <= LINK_DENSITY and b.words >= SHORT]
    return 2 * sum(b.stops for b in some) >= STOPS_LOW * sum(b.words for b in some)


def _nearest(labels: list[bool | None], order: range) -> list[tuple[int, bool | None]]:
    """(distance, label) of the nearest decided block at or before each place of order."""
    found: list[tuple[int, bool | None]] = [(len(labels), None)] * len(labels)
    last = (len(labels), None)
    for i in order:
        last = (0, labels[i]) if labels[i] is not None else (last[0] + 1, last[1])
        found[i] = last
    return found


def classify(blocks: list[Block]) -> list[Block]:
    """Both passes; sets keep. Blocks of an article listen to its other blocks alone, and are kept if none is decided."""
    for b in blocks:
        _measure(b)
    known, n = _known(blocks), len(blocks)
    first = [_first(b, known) for b in blocks]
    inside = [x if b.content and not b.against else None for x, b in zip(first, blocks)]
    sides = {content: (_nearest(labels, range(n)), _nearest(labels, range(n - 1, -1, -1))) for content, labels in ((False, first), (True, inside))}
    for i, b in enumerate(blocks):
        (p, left), (q, right) = (side[i] for side in sides[b.content])
        if first[i] is not None:
            b.keep = first[i]
        elif left is None or right is None:
            b.keep = b.content if left is right else left if right is None else right
        elif b.heading:
            b.keep = right
        else:
            b.keep = (left and right) if p == q else left if p < q else right
    return blocks


def main_text(html: str | None) -> str:
    return " ".join(b.text for b in classify(blocks_of(html or "")) if b.keep)


def extracted(html: Column) -> Column:
    @F.pandas_udf("string")
    def each(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(x) for x in pages], dtype=object)

    return each(html)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text and n_chars of every row; a narrow plan."""
    rows = pages.select(F.col(id_col), F.col(url_col), extracted(F.col(html_col)).alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))


def op6_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
