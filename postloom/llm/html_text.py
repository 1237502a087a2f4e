"""Main text of web pages by tree scoring.

A page is read into a tree (elements without end tags are closed as HTML does). Parts that
are never the article go by tag, role, or words of class and id. Every paragraph then
passes points for its length and commas to its ancestors, in full to the parent, half to
the grandparent, a third of that and so on above, less its link density. The best
container, discounted by its own link density, is kept with those siblings that score well
or are plain paragraphs; a container inside an `article` element stands for that element.
Lists and boxes in it that are mostly links go. Points reach `LEVELS` ancestors. If nothing is
left of a page, it is read again with only those parts gone that are never shown: its article
may stand in a form, or under a name that elsewhere means an advert.

A page is one row and one value, so pages are scored side by side with no shuffle.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batch, chunks

# Fixed values of HTML and of common page vocabulary.
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section"
    " select summary table tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCK - frozenset("body br caption html legend option tbody td tfoot th thead tr".split())
CLOSED_BY = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "tbody": (frozenset({"thead", "tbody", "tfoot"}), frozenset({"table"})),
    "tfoot": (frozenset({"thead", "tbody", "tfoot"}), frozenset({"table"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
    "body": (frozenset({"head"}), frozenset({"html"})),
}
SCOPE = frozenset("html table td th caption button object template".split())
NEVER = RAW | frozenset(
    "head nav footer aside form button input select option datalist dialog menu svg math canvas audio video object"
    " embed applet map fieldset legend label output progress meter search".split()
)
NEVER_SHOWN = RAW | frozenset("head nav select option datalist svg math canvas audio video object embed applet map".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split()
)
UNWANTED = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertisements advertising advertorial sponsor sponsored sponsors promo promos"
    " promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay lightbox"
    " newsletter subscribe subscription signup login paywall sidebar sidebars aside rail menu menus nav navbar"
    " navigation breadcrumb breadcrumbs pagination pager footer foot masthead topbar toolbar comment comments"
    " commentlist disqus discussion replies reply respond responses related recommended recommendations more share sharing"
    " shares social socials widget widgets skyscraper outbrain taboola shoutbox form search skip hidden".split()
)
MAYBE = frozenset("header head meta tags".split())
WANTED = frozenset("article body content entry main post text story page".split())
KEPT = frozenset("html body article main".split())
BASE = {
    "article": 10, "main": 8, "div": 5, "section": 3, "pre": 3, "td": 3, "blockquote": 3,
    "address": -3, "ol": -3, "ul": -3, "dl": -3, "dd": -3, "dt": -3, "li": -3, "form": -3,
    "h1": -5, "h2": -5, "h3": -5, "h4": -5, "h5": -5, "h6": -5, "th": -5,
}

# As HTML reads marks: a quote opens a value only behind an equals sign, `<!-->` is a whole
# comment, and a mark that the page's end cuts off is none. Possessive, so that nothing is read twice.
_MARK = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
# What a layout has or lacks says nothing of the element itself.
_LAYOUT = re.compile(r"(?:^|(?<=\s))(?:has|with|no|without)[-_]\S+", re.I)
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: Ancestors that a paragraph's points reach; the seventh would get a twenty-first of them.
LEVELS = 6


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "drop", "size", "links", "score")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.drop = False
        self.size = self.links = 0
        self.score = None


def parse(page: str) -> Node:
    root = Node("html", "", None)
    here, at = root, 0
    depth_open: list[Node] = [root]
    # Places of each tag in the open stack, so that finding one doesn't walk it.
    places: dict[str, list[int]] = {"html": [0]}

    def close_to(k: int) -> None:
        nonlocal here
        for node in depth_open[k:]:
            places[node.tag].pop()
        del depth_open[k:]
        here = depth_open[-1]

    def last(tags: frozenset) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def find(tags: frozenset, stop: frozenset) -> int:
        """The innermost open element of those tags, if it is not outside of a stop; or 0."""
        k = last(tags)
        return k if k and k >= last(stop) else 0

    while True:
        m = _MARK.search(page, at)
        if m is None:
            here.children.append(page[at:])
            return root
        if m.start() > at:
            here.children.append(page[at : m.start()])
        at = m.end()
        if m[2] is None or page[at - 1] != ">":
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in ("html", "body"):
                continue  # what follows still belongs to the page
            k = find(frozenset({tag}), SCOPE - {tag} if tag not in SCOPE else frozenset({"html"}))
            if k:
                close_to(k)
            continue
        if tag == "html":
            root.attrs = root.attrs or m[3]
            continue
        if tag in ENDS_P:
            k = find(frozenset({"p"}), SCOPE)
            if k:
                close_to(k)
        if tag in CLOSED_BY:
            k = find(*CLOSED_BY[tag])
            if k:
                while k > 1 and depth_open[k - 1].tag in CLOSED_BY[tag][0]:
                    k -= 1
                close_to(k)
        node = Node(tag, m[3], here)
        here.children.append(node)
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK and tag not in RAW:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        places.setdefault(tag, []).append(len(depth_open))
        depth_open.append(node)
        here = node


def unwanted(node: Node, in_article: bool, again: bool = False) -> bool:
    """Whether a node is no part of an article; the second time, only if it is never shown."""
    tag = node.tag
    if tag in (NEVER_SHOWN if again else NEVER):
        return True
    if tag == "header" and not in_article and not again:
        return True
    if not node.attrs or node.attrs.isspace():
        return False
    attrs = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(node.attrs)}
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or _HIDDEN.search(attrs.get("style", "")):
        return True
    if tag in KEPT or again:
        return False
    if attrs.get("role", "").lower() in ROLES:
        return True
    names = _LAYOUT.sub("", f"{attrs.get('class', '')} {attrs.get('id', '')}")
    words = {w.lower() for w in _NAME_WORDS.findall(names)}
    return bool(words & UNWANTED or words & MAYBE and not words & WANTED and not in_article)


def measure(root: Node, again: bool = False) -> list[Node]:
    """Mark what goes, count text and link text of the rest; nodes in page order."""
    order: list[Node] = []
    todo: list[tuple[Node, bool, bool]] = [(root, False, False)]
    inside_link: dict[int, bool] = {}
    while todo:
        node, in_article, in_link = todo.pop()
        if node is not root and unwanted(node, in_article, again):
            node.drop = True
            continue
        in_article = in_article or node.tag in ("article", "main")
        in_link = in_link or node.tag == "a"
        order.append(node)
        if in_link:
            inside_link[id(node)] = True
        for child in reversed(node.children):
            if isinstance(child, Node):
                todo.append((child, in_article, in_link))
    for node in reversed(order):
        own = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        node.size += own
        if id(node) in inside_link:
            node.links = node.size
        if node.parent is not None:
            node.parent.size += node.size
            node.parent.links += node.links
    return order


def density(node: Node) -> float:
    return node.links / node.size if node.size else 0.0


def paragraphs(order: list[Node]) -> Iterator[Node]:
    """Paragraphs, and elements with text of their own that act as one."""
    for node in order:
        if node.tag in ("p", "pre", "td", "blockquote", "dd") or node.tag in ("div", "section", "article", "main", "body", "li"):
            if node.tag == "p" or any(isinstance(c, str) and not c.isspace() and c for c in node.children):
                yield node


def text_of(node: Node) -> Iterator[str]:
    """Text pieces with their references decoded, blanks around blocks."""
    todo: list[Node | str] = [node]
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            yield html.unescape(part) if "&" in part else part
        elif not part.drop:
            edge = [" "] if part.tag in BLOCK else []
            todo += edge
            todo += reversed(part.children)
            todo += edge


def container(order: list[Node]) -> list[Node]:
    """The best container and the siblings that belong to it, in page order."""
    scored: dict[int, Node] = {}
    for p in paragraphs(order):
        raw = " ".join("".join(text_of(p) if p.tag == "p" else (c for c in p.children if isinstance(c, str))).split())
        if not raw:
            continue
        points = (len(raw) >= 25) + raw.count(",") + min(len(raw) / 100, 3.0) + 0.01
        points *= 1 - density(p)
        up = p.parent if p.tag in ("p", "pre", "li", "dd") and p.parent is not None else p
        for level in range(LEVELS):
            if up is None:
                break
            if up.score is None:
                up.score = float(BASE.get(up.tag, 0))
                scored[id(up)] = up
            up.score += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            up = up.parent
    if not scored:
        return [n for n in order if n.tag in ("article", "main")][:1] or order[:1]
    final = {k: n.score * (1 - density(n)) for k, n in scored.items()}
    place = {id(n): i for i, n in enumerate(order)}
    top = max(scored.values(), key=lambda n: (final[id(n)], -place[id(n)]))
    up = top
    while up is not None:
        if up.tag == "article":
            top = up
            break
        up = up.parent
    if top.parent is None or top.tag in ("body", "html"):
        return [top]
    least = max(10.0, 0.2 * final.get(id(top), 0.0))
    kept = []
    for node in top.parent.children:
        if not isinstance(node, Node) or node.drop:
            continue
        if node is top or final.get(id(node), 0.0) >= least and node.tag not in ("ul", "ol", "table"):
            kept.append(node)
        elif node.tag == "p" and top.tag != "article":
            long = node.size > 80
            text = " ".join("".join(text_of(node)).split())
            if long and density(node) < 0.25 or not long and not node.links and re.search(r"[.!?](\s|$)", text):
                kept.append(node)
        elif node.tag in ("h1", "h2") and top.tag != "article" and node.size and density(node) < 0.5:
            kept.append(node)
    return kept


def main_text(page: str | None) -> str:
    """The article's text: references decoded, blanks and line breaks as one blank."""
    if not page:
        return ""
    return _article(page, False) or _article(page, True)


def _article(page: str, again: bool) -> str:
    order = measure(parse(page.replace("\0", "")), again)
    kept = container(order)
    for node in order:
        if node.tag in ("ul", "ol", "dl", "table", "div", "section") and node.links and density(node) > 0.5:
            if node not in kept:
                node.drop = True
    return " ".join("".join(piece for node in kept for piece in text_of(node)).split())


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.large_string())])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text (the main text) of every row of `pages` (page_id, url, html).

    Null or empty html gives an empty text; so does a page without text. Null ids and urls
    are kept, repeated rows are extracted each, other columns are dropped, an empty table
    gives an empty table. Html is read whole, however long.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in chunks(b.column(2)):
                part = b.slice(lo, hi - lo)
                texts = [main_text(h) for h in part.column(2).to_pylist()]
                yield batch(_OUT, page_id=part.column(0), url=part.column(1).cast(pa.string()), text=texts)

    own = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"], pages["html"])
    return own.mapInArrow(run, "page_id LONG, url STRING, text STRING")
