"""Main text of HTML pages by tag-path ratios.

A page is read into blocks of text.  Blocks with the same root-to-leaf path of tags are
one group: its ratios are the text length and the number of punctuation marks per block,
links left out.  Both are smoothed over neighbouring blocks in page order, fused by
their geometric mean and held against a threshold that depends on their spread; the
paths above it are content.  The content's container is the ``article`` or ``main`` that
holds most of it, else the smallest element that holds all of it.  The container limits
the candidates.  In it, blocks on content paths are the text, and headings; of the others
those that are mostly no link, in an ``article`` or ``main`` wherever they stand, else where
they are siblings of content.  So short paragraphs stay, lists of links and adverts go.

Parts that are menus, headers, footers or sidebars by their tag never are text.  Forms,
dialogs, roles (search, banner) and words of a class or id (sidebar, notice, comments) are
weaker: they count only for elements that hold neither the largest ``article`` or ``main``
nor most of the page's unlinked text and punctuation.  So does a first heading that
speaks of nothing but comments.

Per-page work is a small function over one string; Spark moves no rows.  Broken markup
is read as browsers do: missing end tags are implied, an unfinished tag at the end is
dropped, a lone ``<`` is text.

NULL and empty pages and pages without text give an empty text.  Long pages are read
whole.  Repeated rows give equal texts.  An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Tags and class words with a fixed meaning in HTML and in common page templates.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe noembed noframes svg math select object canvas audio video button".split())
OUTSIDE = frozenset("nav aside footer menu header head".split())
OUTSIDE_WEAK = frozenset("form dialog search".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
OUTSIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion sidebar nav navbar navigation menu "
    "breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay comment "
    "comments commentlist reply replies discussion disqus respond share sharing social related recommended newsletter "
    "subscribe subscription signup login pagination pager toolbar disclaimer copyright banner widget form".split()
)
COMMENT_WORDS = frozenset("comment comments reply replies response responses leave post a your all no so far".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
_TAG = re.compile(
    r"<!--(?:.*?-->|.*)|<!\[CDATA\[(?:.*?\]\]>|.*)|<[!?][^>]*+>|</?+([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>", re.S
)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?(?=[\s/]|$)""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class _Element:
    __slots__ = ("tag", "parent", "outside", "path", "named")

    def __init__(self, tag, parent, outside, path, named=False):
        self.tag, self.parent, self.outside, self.path, self.named = tag, parent, outside, path, named


def _marked(tag: str, attributes: str) -> tuple[bool, str, bool]:
    """Whether an element is marked as outside the article, its class for the path, and whether its names say so."""
    outside, name, named = tag in OUTSIDE, "", tag in OUTSIDE_WEAK
    if attributes and tag not in ("html", "body"):
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key == "hidden" or key == "aria-hidden" and value == "true":
                outside = True
            elif key == "role":
                named = named or tag not in ("article", "main") and value.lower() in OUTSIDE_ROLES
            elif key in ("class", "id"):
                if key == "class":
                    name = "." + value.strip().lower()
                if tag not in ("article", "main"):
                    named = named or any(w.lower() in OUTSIDE_WORDS for w in _WORDS.findall(value))
    return outside, name, named


class _Page:
    """Blocks of text in page order: ``(element, text, length outside links)``."""

    def __init__(self, source: str):
        self.blocks: list[tuple[_Element, str, int]] = []
        root = _Element("", None, False, "")
        self.named = False
        self.stack: list[tuple[str, _Element]] = [("", root)]
        self.parts: list[str] = []
        self.links = self.linked = 0
        at, n = 0, len(source)
        while at < n:
            low = source.find("<", at)
            if low < 0:
                self.text(source[at:])
                break
            if low > at:
                self.text(source[at:low])
            m = _TAG.match(source, low)
            if m is None:
                follow = source[low + 1 : low + 2]
                if follow.isalpha() and follow.isascii() or follow in ("/", "!", "?") and source.find(">", low) < 0:
                    if source.find(">", low) < 0:
                        break
                    at = source.find(">", low) + 1  # a quote that is never closed
                    continue
                if follow in ("/", "!", "?"):
                    at = source.find(">", low) + 1
                    continue
                self.text("<")
                at = low + 1
                continue
            at = m.end()
            if m[1] is None:
                if source.startswith("<![CDATA[", low):
                    self.parts.append(source[low + 9 : at].removesuffix("]]>"))
                continue
            tag = m[1].lower()
            if source[low + 1] == "/":
                self.close(tag)
            elif tag in RAW:
                if not m[2].rstrip().endswith("/") or tag not in ("svg", "math"):
                    end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
                    at = end.end() if end else n
                self.parts.append(" ")
            else:
                self.open(tag, m[2])
        self.flush()

    def text(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        self.parts.append(text)
        if self.links:
            self.linked += len(text.strip())

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.titled(text)
            self.blocks.append((self.stack[-1][1], text, max(0, len(text) - self.linked)))
        self.parts, self.linked = [], 0

    def titled(self, text: str) -> None:
        """A part whose first block is a heading about comments is marked like one with such a name."""
        element = self.stack[-1][1]
        part = element.parent
        if element.tag in HEADINGS and part is not None and part.parent is not None and part.tag not in ("article", "main", "body", "html"):
            words = [w.lower() for w in re.findall(r"[^\W\d_]+", text)]
            if words and COMMENT_WORDS.issuperset(words) and any(w[:4] in ("comm", "repl", "resp") for w in words):
                if not any(_inside(e, {part}) for e, _, _ in self.blocks):
                    part.named = self.named = True

    def open(self, tag: str, attributes: str) -> None:
        if tag == "br" or tag in VOID:
            if tag == "hr":
                self.flush()
            self.parts.append(" ")
            return
        if tag in BLOCKS:
            self.flush()
            if tag in _CLOSES:
                closed, within = _CLOSES[tag]
                self.pop_to(closed, within)
            else:
                self.pop_to({"p"}, {"td", "th", "table", "button"})
            above = self.stack[-1][1]
            outside, name, named = _marked(tag, attributes)
            self.named = self.named or named
            if tag == "header" and self.within(above, ("article", "main")):
                outside = False
            self.stack.append((tag, _Element(tag, above, above.outside or outside, f"{above.path}/{tag}{name}", named)))
        else:
            if tag == "a":
                self.links += 1
            outside, name, named = _marked(tag, attributes)
            above = self.stack[-1][1]
            if (outside or named) and not above.outside:
                self.flush()  # a marked inline element is a block of its own
                above = _Element(tag, above, outside, f"{above.path}/{tag}{name}", named)
                self.named = self.named or named
            self.stack.append((tag, above))

    @staticmethod
    def within(element: _Element | None, tags: tuple) -> bool:
        while element is not None:
            if element.tag in tags:
                return True
            element = element.parent
        return False

    def pop_to(self, tags: set, within: set) -> None:
        """Close the nearest of ``tags``, not looking beyond ``within``."""
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] in tags:
                self.drop(i)
                return
            if self.stack[i][0] in within:
                return

    def drop(self, i: int) -> None:
        self.links -= sum(t == "a" for t, _ in self.stack[i:])
        del self.stack[i:]

    def close(self, tag: str) -> None:
        if tag == "br":
            self.parts.append(" ")
        if tag == "p" and not any(t == "p" for t, _ in self.stack):
            self.flush()
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                if tag in BLOCKS or self.stack[i][1] is not self.stack[i - 1][1]:
                    self.flush()
                self.drop(i)
                return
            if tag not in BLOCKS and self.stack[i][0] in BLOCKS:
                return


def _smooth(values: np.ndarray) -> np.ndarray:
    """A Gaussian over two neighbours on either side."""
    kernel = np.exp(-0.5 * np.arange(-2, 3) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel, "full")[2:-2]
    return np.convolve(values, kernel, "full")[2:-2] / weight


def content_paths(blocks: list[tuple[_Element, str, int]], spread: float = 0.5) -> dict[str, float]:
    """The fused score of each path that is above the threshold."""
    paths: dict[str, list[float]] = {}
    for element, text, plain in blocks:
        total = paths.setdefault(element.path, [0, 0, 0, 0])
        total[0] += 1
        total[1] += plain
        total[3] += len(text)
        total[2] += len(PUNCTUATION.findall(text)) if plain else 0
    lengths = _smooth(np.array([paths[e.path][1] / paths[e.path][0] for e, _, _ in blocks]))
    marks = _smooth(np.array([paths[e.path][2] / paths[e.path][0] for e, _, _ in blocks]))
    fused: dict[str, list[float]] = {}
    for (element, _, _), a, b in zip(blocks, lengths, marks, strict=True):
        fused.setdefault(element.path, []).append(float(np.sqrt(a * b)))
    # Smoothing must not lift paths that are mostly links, such as menus.
    scores = {p: sum(v) / len(v) if 2 * paths[p][1] > paths[p][3] else 0.0 for p, v in fused.items()}
    values = np.array(list(scores.values()))
    threshold = min(values.mean(), spread * values.std()) if len(values) > 1 else 0.0
    return {p: s for p, s in scores.items() if s >= threshold and s > 0} or {p: s for p, s in scores.items() if s == values.max()}


def _open_blocks(page: _Page) -> list[tuple[_Element, str, int]]:
    """Blocks that neither a tag or role nor the names of an element put outside.

    Names don't count on an element that holds the largest article or main, or more than
    half of the unlinked text and punctuation; the latter only if no article or main stands
    free of such names, as an advert may be longer than a short article.
    """
    blocks = [b for b in page.blocks if not b[0].outside]
    if not page.named:
        return blocks
    held: dict[_Element, list[int]] = {}
    for element, text, plain in blocks:
        marks, up = len(PUNCTUATION.findall(text)) if plain else 0, element
        while up is not None:
            total = held.setdefault(up, [0, 0])
            total[0] += plain
            total[1] += marks
            up = up.parent
    whole = [sum(b[2] for b in blocks), sum(len(PUNCTUATION.findall(b[1])) for b in blocks if b[2])]
    leads = [max((e for e in held if e.tag == tag), key=lambda e: held[e][0], default=None) for tag in ("article", "main")]
    most = max((held[e][0] for e in leads if e is not None), default=0)
    spared, free = set(), False
    for lead in leads:
        if lead is not None and 3 * held[lead][0] >= most:
            above, up = set(), lead
            while up is not None:
                above.add(up)
                up = up.parent
            free = free or not any(e.named for e in above)
            spared |= above
    shut: dict[_Element, bool] = {}

    def closed(element: _Element) -> bool:
        chain, up = [], element
        while up is not None and up not in shut:
            chain.append(up)
            up = up.parent
        state = shut[up] if up is not None else False
        for e in reversed(chain):
            large = not free and 2 * held[e][0] > whole[0] and 2 * held[e][1] >= whole[1]
            state = state or e.named and e not in spared and not large
            shut[e] = state
        return state

    return [b for b in blocks if not closed(b[0])]


def main_text(source: str | None) -> str:
    """The blocks of the article, one per line."""
    page = _Page(source or "")
    blocks = _open_blocks(page)
    if not blocks:
        return ""
    content = content_paths(blocks)
    mass: dict[_Element, float] = {}
    chosen = [b for b in blocks if b[0].path in content]
    for element, text, _ in chosen:
        up = element
        while up is not None:
            mass[up] = mass.get(up, 0.0) + len(text)
            up = up.parent
    whole = sum(len(b[1]) for b in chosen)
    for tag in ("article", "main"):
        named = {e: m for e, m in mass.items() if e.tag == tag and not _Page.within(e.parent, (tag,))}
        if named and sum(named.values()) >= 0.5 * whole:
            most = max(named.values())
            kept = {e for e, m in named.items() if 3 * m >= most}
            return "\n".join(
                text for element, text, plain in blocks
                if _inside(element, kept) and (element.path in content or element.tag in HEADINGS or 2 * plain > len(text))
            )
    near = {b[0].parent for b in chosen if b[0].parent is not None}
    first = next(i for i, b in enumerate(blocks) if b[0].path in content)
    best = max(mass, key=lambda e: (mass[e], len(e.path)))
    out = []
    for i, (element, text, plain) in enumerate(blocks):
        sibling = element.parent in near and plain * 2 > len(text) and _inside(element, {best})
        heading = element.tag in HEADINGS and (i > first or element.parent in near or i + 1 == first)
        if element.path in content or sibling or heading:
            out.append(text)
    return "\n".join(out)


def _inside(element: _Element | None, kept: set) -> bool:
    while element is not None:
        if element in kept:
            return True
        element = element.parent
    return False


def extract(pages: DataFrame, body: str = "html") -> DataFrame:
    """``pages`` without ``body`` but with ``main_text``."""
    rest = [c for c in pages.columns if c not in (body, "main_text")]
    rows = pages.select(*[F.col(f"`{c}`") for c in rest], F.col(body).alias("main_text"))

    def read(batches):
        for batch in batches:
            texts = pa.array([main_text(t.as_py()) for t in batch.column(len(rest))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], texts], batch.schema.names)

    return rows.mapInArrow(read, rows.schema)
