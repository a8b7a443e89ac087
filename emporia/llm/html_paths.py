"""Main text of web pages by tag-path ratios.

Each page is read into its text blocks; a block's *path* is the chain of tags
from the root to it (inline markup left out). For each path of a page the
text length and the punctuation marks of all its blocks are summed and divided
by the number of blocks. Article paragraphs share a path with long, punctuated
text; menus, notices and footers have paths with short text and few marks.

The length ratio is smoothed along the page with a short Gaussian window, so a short
paragraph among long ones counts with them, and fused with the path's own punctuation ratio
by their product (less what lies in links, and weighted down where a site's class or
id names speak of adverts, menus, comments and the like) and cut at a threshold that
follows the page's own spread. Blocks at or above it are content.

What is content decides what else stays, so that short headings, list items and last words are
kept with the text they belong to:

* the *container* is the smallest sectioning element that holds nearly all
  selected text. All its blocks stay, except in inner containers whose names are weighted
  down and that hold no content themselves;
* a sectioning element outside of it that holds content directly stays likewise;
* a heading in front of content stays, wherever it stands.

Nothing else does. If the container is the whole page, only sections that hold content
directly stay. Elements that by their own tag or role are no article (nav, footer,
aside, form, script, a page's header, hidden ones) are left out before all this.

Output text: character references decoded, white space in a block as one
space, blocks trimmed and joined in page order by one space.

Pages are independent: no shuffle, no state; memory is one Arrow batch.

Defined results: a null or empty page gives an empty text; a page without markup is
all content. Broken markup (unclosed or stray tags, unquoted attributes, an
unended comment) is read as browsers do in the common cases. Extra columns are
not read; repeated rows give repeated results; an empty table an empty result. Very
long pages are read whole, in time that grows with their length and nesting.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import map_rows

#: The threshold, as a share of the fused ratios' standard deviation with a part of their mean (pages of
#: equal paragraphs have hardly any deviation).
THRESHOLD = 0.5
OF_MEAN = 0.2
#: Weights of a block, its neighbours and theirs.
SMOOTH = np.exp(-np.arange(-2, 3) ** 2 / 2.0)
#: Share of the selected text that the container has to hold.
HOLDS = 0.9
#: Weight of what stands in an element whose names speak of boilerplate.
NAMED_WEIGHT = 0.01

# Element names of HTML, by what they mean for reading.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp svg math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img".split())
SECTION = frozenset("html body article main section div td center blockquote".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog button select option fieldset input object embed head "
                        "figure-menu noscript script style".split())
#: An opening tag of the key closes an open element of these names, up to a section.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that, with such names, are a part of the page of their own; a paragraph or list item is not.
HOLDERS = SECTION | {"ul", "ol", "dl", "table", "figure"}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words in class or id that speak of boilerplate; they weigh a block down and decide nothing by themselves.
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|banner|breadcrumbs?|comments?|commentlist|contentinfo|cookies?|"
    r"consent|disqus|dialog|footer|footnav|form|gdpr|hidden|login|masthead|menu|modal|nav|navbar|navigation|newsletter|"
    r"notices?|notification|pagination|popup|popover|promo|promotion|recommended|recommendations|related|replies|reply|"
    r"respond|search|share|sharing|sidebar|signup|skip|social|sponsor|sponsored|subscribe|subscription|tags|toolbar|"
    r"topbar|widget|widgets|complementary|alert|paywall|outbrain|taboola)(?:$|[\s_-])", re.I)

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
MARKS = re.compile(r"[.,;:!?。，、；：！？…·،؟।]")


class Element:
    __slots__ = ("tag", "parent", "boilerplate", "path", "weight", "inner")

    def __init__(self, tag: str, parent: Element | None, boilerplate: bool, named: str = "", suspect: bool = False):
        self.tag, self.parent = tag, parent
        self.boilerplate = boilerplate or (parent is not None and parent.boilerplate)
        step = f"{tag}.{named}" if named else tag
        above = parent.path if parent else ""
        self.path = above if tag in INLINE else f"{above}/{step}"
        self.weight = (parent.weight if parent else 1.0) * (NAMED_WEIGHT if suspect else 1.0)
        #: How many containers with such names the element stands in.
        self.inner = (parent.inner if parent else 0) + (suspect and tag in HOLDERS)


class Block:
    __slots__ = ("element", "text", "linked")

    def __init__(self, element: Element):
        self.element, self.text, self.linked = element, [], 0


def _read_attributes(tag: str, attributes: str, parent: Element) -> tuple[bool, str, bool]:
    """(no article by tag, role or being hidden; the class for its path; whether its names speak of boilerplate)."""
    if tag in BOILERPLATE:
        return True, "", False
    if tag == "header":  # a page's header, but not an article's
        e = parent
        while e and e.tag not in ("article", "main", "section"):
            e = e.parent
        if e is None:
            return True, "", False
    if not attributes or tag in ("html", "body"):
        return False, "", False
    named, suspect = "", False
    for name, double, single, bare in ATTRIBUTE.findall(attributes):
        name = name.lower()
        value = double or single or bare
        if name == "role" and value.lower() in ROLES:
            return True, named, suspect
        if name in ("class", "id") and value:
            named = named or (value if name == "class" else "")
            suspect = suspect or bool(NAMED.search(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value)))
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True, named, suspect
        elif name == "style" and re.search(r"display\s*:\s*none", value):
            return True, named, suspect
    return False, named, suspect


def blocks(html: str) -> list[Block]:
    """The page's text blocks in order, each with its innermost block element."""
    root = Element("html", None, False)
    stack = [root]
    out: list[Block] = []
    open_block: Block | None = None
    links = 0

    def text(part: str) -> None:
        nonlocal open_block
        if open_block is None:
            if not part or part.isspace():
                return
            e = stack[-1]
            while e.tag in INLINE and e.parent:
                e = e.parent
            # boilerplate by an inline element's names still counts
            if stack[-1].boilerplate and not e.boilerplate:
                e = stack[-1]
            open_block = Block(e)
            out.append(open_block)
        elif stack[-1].boilerplate != open_block.element.boilerplate:
            open_block = None
            text(part)
            return
        open_block.text.append(part)
        if links:
            open_block.linked += len(part)

    at, end = 0, len(html)
    while at < end:
        m = TOKEN.search(html, at)
        if m is None:
            text(html[at:])
            break
        if m.start() > at:
            text(html[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:  # comment, doctype
            continue
        tag = tag.lower()
        if m[1] or m[4]:  # end tag
            if tag == "br":
                open_block = None
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    links -= sum(e.tag == "a" for e in stack[k:])
                    del stack[k:]
                    break
                if tag in INLINE and stack[k].tag not in INLINE:
                    break
                if tag == "p" and stack[k].tag in SECTION:
                    break
            if tag not in INLINE:
                open_block = None
            continue
        attributes = m[3] or m[6] or ""
        if tag in RAW:
            if not attributes.endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                at = close.end() if close else end
            if tag not in ("noscript", "svg", "math"):
                open_block = None
            continue
        if tag in VOID:
            if tag not in ("img", "wbr", "input"):
                open_block = None
            continue
        if tag == "body" or tag == "html":
            open_block = None
            continue
        if tag not in INLINE:
            open_block = None
            closing, scope = CLOSES.get(tag), SCOPES.get(tag, ())
            for k in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph; li ends li
                name = stack[k].tag
                if name == "p" or (closing and name in closing):
                    links -= sum(e.tag == "a" for e in stack[k:])
                    del stack[k:]
                    if not closing:
                        break
                elif name in scope or (not closing and name not in INLINE):
                    break
        stack.append(Element(tag, stack[-1], *_read_attributes(tag, attributes, stack[-1])))
        if tag == "a":
            links += 1
    return out


def live_blocks(html: str | None) -> list[tuple[Block, str]]:
    """The page's blocks that may be content, with their cleaned texts."""
    found = []
    for b in blocks(html or ""):
        clean = " ".join(unescape("".join(b.text)).split())
        if clean and not b.element.boilerplate:
            found.append((b, clean))
    return found


def fused_ratios(live: list[tuple[Block, str]]) -> np.ndarray:
    """The fused, weighted ratio of each block: path sums, the length smoothed along the page, multiplied."""
    total = defaultdict(lambda: [0, 0, 0, 0])  # blocks, text, marks and linked text of each path
    for b, t in live:
        s = total[b.element.path]
        s[0] += 1
        s[1] += len(t)
        s[2] += len(MARKS.findall(t))
        s[3] += min(b.linked, len(t))
    of = [total[b.element.path] for b, _ in live]
    length = np.array([s[1] / s[0] for s in of])
    marks = np.array([(1 + s[2]) / s[0] for s in of])
    free = np.array([1 - s[3] / max(1, s[1]) for s in of])
    weight = np.array([b.element.weight for b, _ in live])
    n, reach = len(live), len(SMOOTH) // 2
    near = lambda x: np.convolve(x, SMOOTH)[reach:reach + n]
    return near(length) / near(np.ones(n)) * marks * free * weight


def cut(fused: np.ndarray, threshold: float = THRESHOLD) -> float:
    return threshold * (fused.std() + OF_MEAN * fused.mean())


def _section(e: Element) -> Element:
    """The sectioning element that holds an element, or the root."""
    while e.tag not in SECTION and e.parent:
        e = e.parent
    return e


def main_text(html: str | None, threshold: float = THRESHOLD) -> str:
    """The main text of one page."""
    live = live_blocks(html)
    if not live:
        return ""
    fused = fused_ratios(live)
    content = fused >= cut(fused, threshold)

    # The smallest sectioning element that holds nearly all selected text, and the sections that hold some directly.
    held: dict[Element, int] = defaultdict(int)
    direct = set()
    for (b, t), is_content in zip(live, content):
        if is_content:
            e = _section(b.element)
            direct.add(e)
            while e:
                if e.tag in SECTION or e.parent is None:
                    held[e] += len(t)
                e = e.parent
    if not held:
        return ""
    enough = HOLDS * max(held.values())
    container = max((e for e in held if held[e] >= enough), key=_depth)
    whole = {e for e in (container, *direct) if e.parent}  # never all of the page

    def stays(b: Block) -> bool:
        e = _section(b.element)
        if e in direct:
            return True
        while e:
            if e in whole:
                return b.element.inner == e.inner
            e = e.parent
        return False

    keep = [bool(c) or stays(b) for (b, _), c in zip(live, content)]
    for k in range(len(live) - 2, -1, -1):  # from the end, so that a heading before a heading counts
        keep[k] = keep[k] or (keep[k + 1] and _heading(live[k][0].element))
    return " ".join(t for (_, t), k in zip(live, keep) if k)


def _heading(e: Element) -> bool:
    return e.tag in HEADINGS and e.weight == 1


def _depth(e: Element) -> int:
    d = 0
    while e.parent:
        d, e = d + 1, e.parent
    return d


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row for each row of ``pages``."""
    def make():
        def step(batch):
            for i in range(0, batch.num_rows, 512):
                some = batch.slice(i, 512)
                texts = [main_text(t.as_py()) for t in some.column(2)]
                yield {"page_id": some.column(0), "url": some.column(1), "text": texts, "n_chars": [len(t) for t in texts]}
        return step

    return map_rows(pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                                 F.col(html_col).alias("html")),
                    "page_id long, url string, text string, n_chars long", make)
