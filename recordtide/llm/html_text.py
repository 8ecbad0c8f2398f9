"""Main text of web pages by composite text density.

A page becomes a tree of elements. What is boilerplate by its element (menus, footers, forms, scripts and the like) or by a
name of its class, id or role (advert, site-footer, comments, ...) is left out. Names of states (with-sidebar, comments-open)
mark nothing, nor do any names on articles, main elements and an element that holds a main heading and most of the page's text.
Of each remaining element the composite density is worked out: characters per tag, scaled down where links hold much of the text
or many of the tags. The element whose children have the greatest sum of densities leads to the main text, which is the outermost
article or main element around it. Without one, it is the outermost block around it on the way up to which no block beside the
way holds mostly links. On the way from the body, the least density, with boilerplate counted, is the threshold: an element
beside the way that is as dense as that or is a heading or paragraph, and does not hold mostly links, belongs to the text too.

Character references are decoded, white space becomes one space, blocks are joined by one space; inline elements join without.
Unclosed elements end where a browser would end them, a tag cut off at the end of a page is dropped, and raw text (scripts,
styles, titles) ends at its own closing tag only. Null and empty pages have an empty text. Null ids and urls pass through,
repeated rows are read each for itself, other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordtide.llm.words import batches

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/<>]*+)([^<>]*+)>"
    r"|<(?=/?[a-zA-Z])",
    re.DOTALL,
)
# The same pieces without quoted attributes, and the characters that tell where a tag with them ends.
_SIMPLE = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/<>]*+)([^<>]*+)>", re.DOTALL)
_TAG_START = re.compile(r"<(?=[!?]|/?[a-zA-Z])")
_TURN = re.compile(r"[<>\"'\s/]")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.IGNORECASE)
_CUT_TAG = re.compile(r"</?[a-zA-Z!][^<>]*\Z")

#: Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th"
    " thead tr ul".split()
)
SKIPPED = frozenset(
    "head nav footer aside form script style noscript template iframe object embed svg canvas button select input textarea menu"
    " dialog title audio video map".split()
)
#: Words of class, id and role names that mark boilerplate.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice"
    " notices alert popup modal overlay newsletter subscribe signup paywall sidebar aside nav navbar navigation menu breadcrumb"
    " breadcrumbs footer masthead toolbar comment comments commentlist respond replies disqus discussion share sharing social related recommended"
    " widget widgets pagination pager skip complementary contentinfo".split()
)
#: Beginnings and ends of names that tell a state, and ends of names that tell the article.
STATES_FIRST = frozenset("has with without no not is show hide".split())
STATES_LAST = frozenset("open opened closed enabled disabled on off active inactive visible hidden allowed".split())
ARTICLES = frozenset(("article", "main"))
#: Headings and paragraphs, whose links do not make them menus.
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote".split())
_ENDS_P = BLOCKS - {"br", "option", "legend", "body", "html", "head"}
_SELF_CLOSING = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
_SCOPES = frozenset("body article section div main td th ul ol dl table blockquote aside nav header footer form li figure".split())


class Element:
    __slots__ = ("tag", "parent", "content", "skipped", "chars", "tags", "link_chars", "link_tags", "density", "total", "marked", "titled", "least")

    def __init__(self, tag: str, parent: Element | None, skipped: bool, marked: bool = False):
        self.tag, self.parent, self.skipped, self.marked = tag, parent, skipped or marked, marked and not skipped
        self.content: list[str | Element] = []


def _marked(attributes: str) -> bool:
    if "=" not in attributes:
        return False
    names = " ".join(name.strip("\"'") for name in _NAMES.findall(attributes)).lower()
    return any(_marks(name) for name in names.split())


def _marks(name: str) -> bool:
    words = [word for word in re.split(r"[^a-z0-9]+", name) if word]
    if not words or words[-1] in ARTICLES:
        return False
    if len(words) > 1 and (words[0] in STATES_FIRST or words[-1] in STATES_LAST):
        return False
    return words[0] in MARKS or words[-1] in MARKS


def _close(node: Element, tags: tuple[str, ...], stop: frozenset[str]) -> Element:
    """The parent of the nearest open element of ``tags`` that no element of ``stop`` encloses; else ``node``."""
    at: Element | None = node
    while at is not None and at.parent is not None:
        if at.tag in tags:
            return at.parent
        if at.tag in stop:
            break
        at = at.parent
    return node


def tag_ends(page: str, start: int) -> dict[int, tuple[int, int]]:
    """For the tags from ``start`` on whose quotes match: place of ``<`` -> end of the name, and place of the closing ``>``.

    One pass from the end, which knows for each place where a tag would end if the place lay outside of quotes, in double
    or in single ones.
    """
    bare = double = single = None
    last = before_last = (len(page), None)  # the two nearest places to the right that end a name
    ends = {}
    for turn in reversed([m.start() for m in _TURN.finditer(page, start)]):
        char = page[turn]
        if char == "<" and page[turn + 1 : turn + 2] not in ("!", "?"):
            name_end, closing = before_last if page[turn + 1 : turn + 2] == "/" else last
            if closing is not None:
                ends[turn] = name_end, closing
        elif char == "<":
            continue
        elif char == '"':
            bare, double = double, bare
        elif char == "'":
            bare, single = single, bare
        else:
            bare = turn if char == ">" else bare
            last, before_last = (turn, bare), last
    return ends


def tokens(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Comments and tags in order: ``start, end, slash, name, attributes``, the name empty for comments and declarations.

    ``send`` moves on to a later place. A page on which some tag does not close is read on by means of ``tag_ends``, since
    looking for the end of each such tag would take a time that grows with the square of the page.
    """
    at, ends = 0, None
    while ends is None:
        token = _TOKEN.search(page, at)
        if not token:
            return
        if token.end() == token.start() + 1:
            at, ends = token.start(), tag_ends(page, token.start())
            break
        end, tag, attributes = token.group(1, 2, 3) if token.group(2) else token.group(4, 5, 6)
        at = (yield token.start(), token.end(), end or "", tag or "", attributes or "") or token.end()
    while start := _TAG_START.search(page, at):
        at = start.start()
        if at in ends:
            name_end, closing = ends[at]
            slash = "/" if page[at + 1] == "/" else ""
            found = at, closing + 1, slash, page[at + 1 + len(slash) : name_end], page[name_end:closing]
        elif simple := _SIMPLE.match(page, at):
            found = at, simple.end(), simple.group(1) or "", simple.group(2) or "", simple.group(3) or ""
        else:
            at += 1
            continue
        at = (yield found) or found[1]


def parse(page: str) -> Element:
    """The tree of a page."""
    root = Element("html", None, False)
    node, at = root, 0
    page = _CUT_TAG.sub("", page)
    found = tokens(page)
    while True:
        try:
            start, after, end, tag, attributes = found.send(None if not at else at)
        except StopIteration:
            start = None
        text = page[at:start]
        if text:
            node.content.append(html.unescape(text))
        if start is None:
            return root
        at = after
        if not tag:
            continue
        tag = tag.lower()
        if end:
            if tag == "br":
                node.content.append(" ")
            else:
                node = _close(node, (tag,), _SCOPES - {tag} if tag not in _SCOPES else frozenset())
            continue
        if tag in ("html", "body"):
            node = _close(node, ("head",), frozenset()) if tag == "body" else node
            continue
        if tag in _ENDS_P:
            node = _close(node, ("p",), _SCOPES)
        if tag in _SELF_CLOSING:
            node = _close(node, _SELF_CLOSING[tag], frozenset(("ul", "ol", "dl", "table", "select")))
        skipped = tag in SKIPPED or (tag == "header" and not _within(node, ("article", "main")))
        child = Element(tag, node, skipped, tag not in ARTICLES and _marked(attributes))
        node.content.append(child)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.IGNORECASE).search(page, at)
            at = close.end() if close else len(page)
        elif tag not in VOID and not (attributes.endswith("/") and _within(child, ("svg", "math"))):
            node = child  # elsewhere a closing slash means nothing


def _within(node: Element | None, tags: tuple[str, ...]) -> bool:
    while node is not None:
        if node.tag in tags:
            return True
        node = node.parent
    return False


def _ordered(root: Element, everything: bool = False) -> list[Element]:
    """Elements that are not left out, or all of them, parents first."""
    out = [root]
    for node in out:
        out.extend(child for child in node.content if isinstance(child, Element) and (everything or not child.skipped))
    return out


def spare(root: Element) -> None:
    """Takes marks off elements that hold a main heading, article or main element and most of the page's text outside links.

    ``least`` of each element becomes its density with boilerplate counted.
    """
    nodes = weigh(root, everything=True)
    for node in nodes:
        node.titled, node.least = node.tag == "h1" or node.tag in ARTICLES, node.density
    for node in reversed(nodes[1:]):
        node.parent.titled |= node.titled
    plain = root.chars - root.link_chars
    for node in nodes:
        if node.marked and node.titled and 2 * (node.chars - node.link_chars) > plain:
            node.skipped = False


def weigh(root: Element, everything: bool = False) -> list[Element]:
    """Works out counts and densities of all elements; returns them, parents first."""
    nodes = _ordered(root, everything)
    for node in nodes:
        node.chars = sum(len(part.strip()) for part in node.content if isinstance(part, str))
        node.tags = node.link_tags = 0
        node.link_chars = node.chars if node.tag == "a" else 0
    for node in reversed(nodes):
        if node.tag == "a":
            node.link_chars = node.chars
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags + (node.tag == "a")
    all_links = root.link_chars / max(1, root.chars)
    for node in nodes:
        node.total = 0.0
        node.density = 0.0
        if node.chars:
            chars, tags = node.chars, max(1, node.tags)
            links, link_tags, plain = max(1, node.link_chars), max(1, node.link_tags), max(1, chars - node.link_chars)
            # The base grows with the links: where there are many, the same grade counts for less.
            base = math.log(chars / plain * node.link_chars + all_links * chars + math.e) + 1
            node.density = chars / tags * math.log(chars / links * tags / link_tags + 1) / math.log(base)
    for node in nodes[1:]:
        if node.tag in BLOCKS:  # an inline element is part of its block, not a block beside others
            _block_of(node.parent).total += node.density
    return nodes


def _block_of(node: Element) -> Element:
    while node.tag not in BLOCKS and node.parent is not None:
        node = node.parent
    return node


def _mostly_links(node: Element) -> bool:
    return node.tag in BLOCKS and node.tag not in PROSE and node.tag != "header" and 2 * node.link_chars > node.chars


def _beside(node: Element, way: list[Element]) -> list[Element]:
    return [child for child in node.content if isinstance(child, Element) and not child.skipped and child not in way]


def main_elements(root: Element) -> list[Element]:
    """The main text around the element of greatest density sum and the elements beside its way to the body that belong to it."""
    spare(root)
    nodes = weigh(root)
    best = max(nodes, key=lambda node: node.total)
    if not best.total:
        best = max(nodes, key=lambda node: node.density)
    way, at = [best], best
    while at.parent is not None:
        at = at.parent
        way.append(at)
    top = max((k for k, node in enumerate(way) if node.tag in ARTICLES), default=None)
    if top is None:
        top = 0
        while top + 2 < len(way) and not any(map(_mostly_links, _beside(way[top + 1], way))):
            top += 1
    threshold = min(node.least for node in way)
    beside = {
        id(child)
        for node in way[top + 1 :]
        for child in _beside(node, way)
        if child.chars and not _mostly_links(child) and (child.density >= threshold or child.tag in PROSE)
    }
    return [node for node in _page_order(root) if node is way[top] or id(node) in beside]


def _page_order(root: Element) -> Iterator[Element]:
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(child for child in reversed(node.content) if isinstance(child, Element) and not child.skipped)


def text_of(element: Element) -> str:
    """The text of an element: white space as one space, a space around blocks, nothing around inline elements."""
    out: list[str] = []
    stack: list[Element | str] = [element]
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            out.append(part)
        elif part.skipped or part.tag in BLOCKS:
            out.append(" ")
            if not part.skipped:
                stack.append(" ")
                stack.extend(reversed(part.content))
        else:
            stack.extend(reversed(part.content))
    return " ".join("".join(out).split())


def main_text(page: str | None) -> str:
    if not page:
        return ""
    return " ".join(filter(None, (text_of(element) for element in main_elements(parse(page)))))


_TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extract(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for part in parts:
            for page_id, url, page in zip(*(part.column(i) for i in range(3))):
                text = main_text(page.as_py())
                yield page_id.as_py(), url.as_py(), text, len(text)

    yield from batches(rows(), _TEXTS)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page."""
    columns = [F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")]
    return pages.select(*columns).mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
