"""HTML main text by tag-path ratios.

A page is cut into text nodes, each with the path of block tags from the root (a tag's first class or id is part of
its name). Per path, over the whole page, text length and punctuation are summed and divided by the number
of nodes (text-to-tag-path and punctuation-to-tag-path ratios). The two are fused, the fused ratios smoothed over
neighbouring nodes, and nodes above a share of the page's deviation are content. What the kept paths have in common is the content's root, which
an ``article`` or ``main`` with the larger part of the text is by itself: below it all paths stay (lists, tables,
short paragraphs) but those that are mostly links.

Nodes below tags, roles or class names that stand for menus, headers and footers of a page, sidebars, notices, adverts,
forms, scripts, styles and comments never compete; only whole first names count, and not those of an element that holds the article or
most of the text. Where ``article`` or ``main`` elements hold the larger part of the text, only those do.

Defined results: a null or empty page, or one without content nodes, has an empty text; a page that breaks off, unclosed and
misnested tags, and tags without their ``>`` are read as browsers do, near enough; repeated rows give repeated rows; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatsieve.llm.shared import batch_of, texts_of

SPREAD = 2
CUT = 0.35
LINKS = 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</(?P<close>[A-Za-z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<open>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?=[\s=/]|$)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SPACE = re.compile(r"\s+")
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# What may end a path below the content's root.
_LEAVES = _HEADINGS | {"p", "pre", "blockquote", "ul", "ol", "li", "dl", "dt", "dd", "table", "caption", "thead", "tbody", "tfoot", "tr", "td", "th", "figure", "figcaption"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
}
_DROPPED = {"nav", "footer", "aside", "form", "head", "menu", "dialog", "button", "select", "option", "svg", "canvas", "object", "audio", "video", "map", "fieldset"} | (_RAW - {"xmp"})
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "form", "menu", "menubar", "toolbar"}
_NAMED = r"ads?|adverts?|advertisements?|adsense|banners?|sponsor(?:ed|s)?|promo(?:tion)?s?|sidebars?|side|aside|nav|navbar|navigation|menus?|menubar|breadcrumbs?|topbar|toolbar|header|masthead|footer|foot|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|newsletter|subscribe|subscription|signup|sign[-_]up|login|comments?|commentlist|replies|reply|respond|disqus|discussion|share|sharing|social|related|recommended|recommendations?|widgets?|tags|pagination|pager|skip[-_]?link|search|legal|copyright|disclaimer"
_AROUND = r"site|page|global|main|top|bottom|left|right|primary|secondary|sticky|fixed|reader|user|article|post|entry|story|section|content|author|web|google|the"
_PARTS = r"box|slot|wrap|wrapper|container|list|section|block|area|bar|unit|inner|outer|panel|column|col|links?|icons?|buttons?|btns?|form|items?|posts|articles|stories|content|title|text|thread|policy|message|\d+|top|bottom|left|right|main|primary|secondary|space|zone|group|row|card"
# A whole name: words that stand for boilerplate, with none but words of place and form around them.
_NAMES = re.compile(rf"(?:(?:{_AROUND})[-_]*)*(?:{_NAMED})\d*(?:[-_]+(?:{_NAMED}|{_PARTS})\d*)*", re.I)
# The head of the article itself, which holds its title.
_OWN_HEAD = re.compile(r"(?:article|post|entry|story|section|content)[-_]+header", re.I)
# In an article, an id of a section is mostly its title; these are parts of the page in any case.
_SURE = re.compile(rf"(?:(?:{_AROUND})[-_]*)*(?:ads?|adverts?|advertisements?|sidebars?|comments?|commentlist|respond|disqus|newsletter|related[-_](?:posts|articles|stories|links))(?:[-_]+(?:{_PARTS}))*", re.I)
# An opening tag of the first kind ends an open element of the second.
_ENDS = {
    **dict.fromkeys(("address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"), {"p"}),
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}, "body": {"head"},
}
_WALLS = {"table", "ul", "ol", "dl", "div", "article", "section", "main", "body", "td", "th", "blockquote", "aside", "nav", "header", "footer", "form"}
_LIST_WALLS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "body": {"html"}}
_PUNCTUATION = re.compile(r"[.,;:!?…¿¡。，、！？；：\"“”«»()—–-]")


@dataclass
class Element:
    tag: str
    name: str
    dropped: bool
    inside: bool
    linked: bool
    named: tuple[int, ...] = ()  # the elements around, and itself, that a name marks as boilerplate
    articles: tuple[int, ...] = ()


@dataclass
class Node:
    """One block's text."""

    path: tuple[str, ...]
    tag: str
    text: str
    inside: bool
    links: int
    named: tuple[int, ...] = ()
    articles: tuple[int, ...] = ()


def _boilerplate(key: str, value: str, tag: str, inside: bool) -> bool:
    """Whether the first name of a class or id stands for boilerplate."""
    first = value.split()[0] if value.split() else ""
    if tag in ("html", "body", "article", "main") or _OWN_HEAD.fullmatch(first):
        return False
    if key == "id" and (tag in _HEADINGS or first.lower() == "discussion"):
        return False
    return (_SURE if key == "id" and inside and tag == "section" else _NAMES).fullmatch(first) is not None


def _element(tag: str, attrs: str, above: Element | None, number: int) -> Element:
    """The element that opens at ``number``; what only its name marks is not dropped yet."""
    name, dropped, named = tag, tag in _DROPPED, False
    inside = tag in ("article", "main") or bool(above and above.inside)
    if tag == "header" and not (above and above.inside):
        dropped = True
    if attrs and not dropped:
        for m in _ATTRIBUTE.finditer(attrs):
            key, value = m[1].lower(), (m[2] or "").strip("\"'")
            if key in ("class", "id"):
                if value and name == tag:
                    name = f"{tag}.{value.split()[0].lower()}" if value.split() else tag
                named |= _boilerplate(key, value, tag, inside)
            elif key == "role":
                dropped |= value.lower() in _ROLES
                inside |= value.lower() in ("main", "article")
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true" and tag not in _INLINE):
                dropped = True
            elif key == "style":
                dropped |= re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) is not None
    if above and above.dropped:
        dropped = True
    own = (number,)
    return Element(
        tag, name, dropped, inside, tag == "a" or bool(above and above.linked),
        (above.named if above else ()) + own * named, (above.articles if above else ()) + own * (tag in ("article", "main")),
    )


def _unnamed(found: list[Node]) -> list[Node]:
    """``found`` without what a name marks. A name does not count where its element holds the page's article, or most of its text."""
    if not any(n.named for n in found):
        return found
    outside = sum(len(n.text) for n in found if not n.named)
    within: dict[int, int] = {}
    articles: dict[int, int] = {}
    for node in found:
        for at in node.named:
            within[at] = within.get(at, 0) + len(node.text)
        for at in node.articles:
            articles[at] = articles.get(at, 0) + len(node.text)
    page = sum(len(n.text) for n in found)
    largest = max(articles, key=lambda at: (articles[at], -at), default=None)
    held = {at for n in found if largest in n.articles for at in n.named if at < largest} if largest is not None and 4 * articles[largest] >= page else set()
    # The text of an article outside of all names is the page's, however long its comments are.
    plain = sum(len(n.text) for n in found if n.articles and not n.named)
    most = {at for at, size in within.items() if 2 * size > outside + size and 2 * size > page and not (plain and 2 * plain > outside)}
    return [n for n in found if all(at in held or at in most for at in n.named)]


def nodes(page: str) -> list[Node]:
    """The page's blocks of text that may be content, in order."""
    stack: list[Element] = []
    out: list[Node] = []
    held: list[str] = []
    links = 0

    def flush() -> None:
        nonlocal links
        if held:
            text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
            held.clear()
            if text:
                blocks = [e for e in stack if e.tag not in _INLINE]
                top = blocks[-1].tag if blocks else ""
                out.append(Node(tuple(e.name for e in blocks), top, text, bool(stack and stack[-1].inside), links, *((stack[-1].named, stack[-1].articles) if stack else ())))
            links = 0

    def say(text: str) -> None:
        nonlocal links
        if text and not (stack and stack[-1].dropped):
            held.append(text)
            links += len(text.strip()) if stack and stack[-1].linked else 0

    def close(tags: set[str], walls: set[str]) -> None:
        for at in range(len(stack) - 1, -1, -1):
            if stack[at].tag in tags:
                flush()
                del stack[at:]
                close(tags, walls)
                return
            if stack[at].tag in walls:
                return

    at = 0
    while m := _TOKEN.search(page, at):
        say(page[at : m.start()])
        at = m.end()
        if m["open"]:
            tag = m["open"].lower()
            if tag in _ENDS:
                close(_ENDS[tag], _LIST_WALLS.get(tag, _WALLS))
            if tag in _VOID:
                if tag in ("br", "hr"):
                    held.append(" ") if held else None
                    if tag == "hr":
                        flush()
                continue
            if tag not in _INLINE:
                flush()
            element = _element(tag, m["attrs"], stack[-1] if stack else None, at)
            if tag in _RAW:
                end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
                at = end.start() if end else len(page)
                stack.append(element)
                continue
            if not (m["attrs"].endswith("/") and tag in ("svg", "path")):
                stack.append(element)
        elif m["close"]:
            tag = m["close"].lower()
            if any(e.tag == tag for e in stack):
                if tag not in _INLINE:
                    flush()
                    while stack.pop().tag != tag:
                        pass
                else:
                    for place in range(len(stack) - 1, -1, -1):
                        if stack[place].tag == tag:
                            del stack[place]
                            break
                        if stack[place].tag not in _INLINE:
                            break
    say(page[at:])
    flush()
    return _unnamed(out)


def _root(paths: set[tuple[str, ...]]) -> tuple[str, ...]:
    """The element that holds all of ``paths``."""
    low, high = min(paths), max(paths)
    size = next((k for k, (a, b) in enumerate(zip(low, high, strict=False)) if a != b), min(len(low), len(high)))
    while size and low[size - 1].split(".")[0] in _LEAVES:
        size -= 1
    return low[:size]


def _without_links(found: list[Node]) -> list[Node]:
    """``found`` without the paths that are mostly links; headings stay, and all if nothing else is there."""
    sums: dict[tuple[str, ...], list[int]] = {}
    for node in found:
        total = sums.setdefault(node.path, [0, 0])
        total[0] += node.links
        total[1] += len(node.text)
    kept = [n for n in found if n.tag in _HEADINGS or sums[n.path][0] <= LINKS * sums[n.path][1]]
    return kept if any(n.tag not in _HEADINGS for n in kept) else found


def chosen(found: list[Node]) -> list[Node]:
    """The content nodes of a page: an article's, or those below the root of the paths chosen by their ratios."""
    if 2 * sum(len(n.text) for n in found if n.inside) > sum(len(n.text) for n in found):
        return _without_links([n for n in found if n.inside])
    if len(found) < 2:
        return found
    sums: dict[tuple[str, ...], list[float]] = {}
    for node in found:
        total = sums.setdefault(node.path, [0.0, 0.0, 0.0])
        total[0] += len(node.text)
        total[1] += len(_PUNCTUATION.findall(node.text))
        total[2] += 1
    text = np.array([sums[n.path][0] / sums[n.path][2] for n in found])
    marks = np.array([sums[n.path][1] / sums[n.path][2] for n in found])
    fused = text * (1.0 + marks) ** 0.5
    reach = np.arange(-SPREAD, SPREAD + 1)
    kernel = np.exp(-0.5 * (reach / max(SPREAD / 2, 1e-9)) ** 2)
    weight = np.convolve(np.ones(len(fused)), kernel, "full")[SPREAD:-SPREAD]
    smooth = np.convolve(fused, kernel, "full")[SPREAD:-SPREAD] / weight
    # A path stands or falls by its nodes' mean, weighed by their length.
    value: dict[tuple[str, ...], list[float]] = {}
    for node, ratio in zip(found, smooth, strict=True):
        total = value.setdefault(node.path, [0.0, 0.0])
        total[0] += ratio * len(node.text)
        total[1] += len(node.text)
    limit = CUT * min(float(smooth.std()), float(smooth.mean()))
    kept = {p for p, (total, size) in value.items() if total / size >= limit}
    holders, root = {p[:-1] for p in kept}, _root(kept)
    return _without_links([n for n in found if n.path[: len(root)] == root or (n.tag in _HEADINGS and n.path[:-1] in holders)])


def main_text(page: str) -> str:
    """The main text of one page: its content blocks joined by one space."""
    return " ".join(n.text for n in chosen(nodes(page)))


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(raw.decode("utf-8", "replace")) for raw in texts_of(batch["html"])]
            texts = [t.encode("utf-8", "replace").decode() for t in texts]
            yield batch_of(schema, page_id=batch["page_id"], url=batch["url"], text=texts, n_chars=[len(t) for t in texts])

    columns = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return columns.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op7_html(spark, sf_dir: str) -> DataFrame:
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
