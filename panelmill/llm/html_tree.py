"""Main text of web pages by scoring the element tree.

Paragraphs give points for their length and commas to the elements around them; the share of text inside links takes
points away. The best container and those of its siblings that score well are kept, without the boilerplate in them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)|</?[a-zA-Z][^>]*(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes object".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption head option select".split())
#: Elements that are never part of an article.
SKIP = frozenset(
    "nav footer aside form head script style noscript iframe template button select option input textarea menu dialog object annotation annotation-xml "
    "metadata desc".split())
ROLE = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Whole words of class and id names, after splitting at anything but letters and at capitals.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs sidebar sidebars aside footer masthead topbar toolbar comment comments disqus reply replies respond cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "widget widgets rail adsbygoogle pagination pager skip tags tagcloud outbrain taboola disclaimer alert".split())
#: Of these, the ones that are said of nothing else: an element in an article that is named by them alone is left out however long it is.
SURE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle sponsored comment comments disqus cookie cookies consent gdpr newsletter sidebar "
    "sidebars nav navbar breadcrumb breadcrumbs outbrain taboola pagination popup modal".split())
#: Elements that hold an article's own text: their names say nothing (headings often have ids made of their words).
CONTENT = frozenset("h1 h2 h3 h4 h5 h6 p li td th tr dt dd figure figcaption blockquote pre html body article main".split())
FORM = frozenset("form button select".split())
SHORT = 200  # characters; an element in an article with a doubtful name is left out if it has fewer, or holds links or a form
#: Words of an article's names, and words after which a name tells of what is beside or in an element, as in "no-sidebar".
GOOD = frozenset("article content main post entry story body text".split())
ABOUT = frozenset("has no with without".split())
SPLIT_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: A menu without a name is one of these that holds little but links.
LISTS = frozenset("ul ol dl div section table".split())
#: An open element of these kinds ends where one of the others starts.
CLOSED_BY = {
    "p": BLOCK, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody"]), "th": frozenset(["td", "th", "tr", "tbody"]),
}
SCOPE = {"li": frozenset(["ul", "ol", "menu"]), "tr": frozenset(["table"]), "td": frozenset(["table"]), "th": frozenset(["table"])}


class Node:
    __slots__ = ("tag", "skip", "hint", "parent", "items", "score", "chars", "linked", "links", "commas", "doubt", "form")

    def __init__(self, tag: str, parent: Node | None, skip: bool, hint: float = 0.0, doubt: bool = False) -> None:
        self.tag, self.parent, self.skip, self.hint, self.doubt = tag, parent, skip, hint, doubt
        self.items: list[Node | str] = []
        self.clear()

    def clear(self) -> None:
        self.score = 0.0
        self.chars = self.linked = self.links = self.commas = self.form = 0


def boilerplate(tag: str, attributes: str, inside: bool) -> tuple[bool, float, bool]:
    """Whether an element is left out, what its names add to its score, and whether they leave it in doubt.

    ``inside`` an article, or what is named like one, mixed names such as "share-prices" say nothing.
    """
    if tag in SKIP:
        return True, 0.0, False
    if tag == "header":
        return not inside, 0.0, False  # a header inside the article holds its title
    if not attributes.strip(" \t\r\n/"):
        return False, {"article": 25.0, "main": 25.0}.get(tag, 0.0), False
    found = {k.lower(): unescape(a or b or c or "") for k, a, b, c in ATTRIBUTE.findall(attributes)}
    role = found.get("role", "").lower()
    if role in ROLE or "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True, 0.0, False
    style = found.get("style", "").replace(" ", "").lower()
    if "display:none" in style or "visibility:hidden" in style:
        return True, 0.0, False
    names = []
    for name in (found.get("class", "") + " " + found.get("id", "")).split():
        parts = [w.lower() for w in SPLIT_NAME.findall(name)]
        names.append(set(parts[:next((i for i, w in enumerate(parts) if w in ABOUT), len(parts))]))
    words = set().union(*names)
    plain = any(n and n <= NAMES for n in names)  # a name of boilerplate words only
    # a name of article words only, such as "main-content", outweighs mixed names but not one of boilerplate words only
    article = any(n and n <= GOOD for n in names) and not plain
    doubt = False
    if tag not in CONTENT:
        if inside:
            own = [] if article else [n for n in names if n & NAMES and n <= NAMES | GOOD]  # "comments", "post-comments"
            if any(n & SURE for n in own):
                return True, 0.0, False
            doubt = bool(own)
        elif words & NAMES and not article or words == {"header"}:
            return True, 0.0, False
    good = bool(words & GOOD) or role in ("main", "article")
    return False, 25.0 if good or tag in ("article", "main") else 0.0, doubt


def holds_article(node: Node) -> bool:
    return node.hint > 0 and node.tag not in ("html", "body")


def parse_tree(html: str) -> Node:
    root = Node("", None, False)
    stack = [root]
    main = 0  # open elements that are, or are named like, an article
    at, n = 0, len(html)
    while at < n:
        m = TOKEN.search(html, at)
        if m is None:
            stack[-1].items.append(html[at:])
            break
        if m.start() > at:
            stack[-1].items.append(html[at:m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        closing, tag, attributes = m.group(1), m.group(2).lower(), m.group(3)
        if closing:
            if tag == "br":
                stack[-1].items.append(" ")
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    main -= sum(holds_article(x) for x in stack[k:])
                    del stack[k:]
                    break
                if tag not in BLOCK and stack[k].tag in BLOCK:
                    break  # an inline end tag does not close blocks
                if SCOPE.get(tag) and stack[k].tag in SCOPE[tag]:
                    break
            continue
        if tag in BLOCK:
            for k in range(len(stack) - 1, 0, -1):
                if tag in CLOSED_BY.get(stack[k].tag, ()):
                    main -= sum(holds_article(x) for x in stack[k:])
                    del stack[k:]
                    break
                if stack[k].tag in BLOCK and stack[k].tag not in CLOSED_BY:
                    break
        if tag in VOID:
            stack[-1].items.append(Node("hr", stack[-1], True) if tag == "hr" else " " if tag == "br" else "")
            continue
        if tag in RAW:
            if not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|$)", re.I).search(html, at)
                at = end.end() if end else n
            continue
        node = Node(tag, stack[-1], *boilerplate(tag, attributes, main > 0))
        stack[-1].items.append(node)
        stack.append(node)
        main += holds_article(node)
    return root


def order(root: Node) -> list[Node]:
    """All kept nodes, parents first; boilerplate and what is in it is left out. No recursion: trees may be deep."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if not node.skip:
            out.append(node)
            todo += [x for x in node.items if isinstance(x, Node)]
    return out


def blocks(root: Node, menus: bool = False) -> list[str]:
    """The texts of the blocks under a node, in page order, empty ones left out.

    With ``menus`` lists of links before the first paragraph and after the last one are left out too.
    """
    out: list[tuple[str, bool, bool]] = []  # text, whether in a paragraph, whether in a list of links
    parts: list[str] = []
    dense = [0]

    def close(tag: str) -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            out.append((text, not dense[0] and tag in ("p", "blockquote", "pre"), bool(dense[0])))

    todo: list = [(root, False)]
    while todo:
        x, ends = todo.pop()
        if isinstance(x, str):
            parts.append(unescape(x))
        elif x.skip:
            if x.tag in BLOCK:
                close("")
        elif x.tag not in BLOCK:
            todo += [(y, False) for y in reversed(x.items)]
        else:
            links = x.tag in LISTS and x.links > 2 and x.linked > 0.8 * x.chars
            close(x.tag if ends else "")
            if ends:
                dense[0] -= links
            else:
                dense[0] += links
                todo.append((x, True))
                todo += [(y, False) for y in reversed(x.items)]
    close("")
    if menus:
        texts = [i for i, (_, paragraph, _) in enumerate(out) if paragraph] or [i for i, (_, _, link) in enumerate(out) if not link]
        if texts:
            out = [x for i, x in enumerate(out) if not x[2] or texts[0] < i < texts[-1]]
    return [text for text, _, _ in out]


def measure(root: Node) -> list[Node]:
    """All kept nodes with their characters, links and commas."""
    nodes = order(root)
    for node in nodes:
        node.clear()
    for node in reversed(nodes):
        own = "".join(x for x in node.items if isinstance(x, str))
        text = " ".join(unescape(own).split())
        node.chars += len(text)
        node.commas += text.count(",")
        node.form += any(isinstance(x, Node) and x.tag in FORM for x in node.items)
        if node.tag == "a":
            node.linked, node.links = node.chars, 1
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
            node.parent.links += node.links
            node.parent.form += node.form
            if node.tag not in BLOCK:
                node.parent.commas += node.commas
    return nodes


def main_text(html: str) -> str:
    """The blocks of the best container and of its good siblings, joined by line feeds; "" if there is no text."""
    root = parse_tree(html)
    nodes = measure(root)
    doubtful = [x for x in nodes if x.doubt and (x.chars < SHORT or x.linked > 0.5 * x.chars or x.form)]
    if doubtful:
        for x in doubtful:
            x.skip = True
        nodes = measure(root)
    for node in nodes:
        if node.tag in ("p", "pre", "blockquote", "td", "h1", "h2", "h3", "li", "dd") or node.tag in BLOCK and any(
                isinstance(x, str) and x.strip() for x in node.items):
            if node.chars:
                points = (1 + node.commas + min(node.chars / 100, 3)) * (1 - node.linked / node.chars)
                up, share = (node.parent if node.tag not in ("div", "section", "article", "main", "body") else node), 1.0
                for _ in range(3):
                    if up is None:
                        break
                    up.score += points * share
                    up, share = up.parent, share / 2
    held = [x for x in nodes if x.score > 0 and x.chars]
    if not held:
        return "\n".join(blocks(nodes[0], True)) if nodes else ""
    value = {id(x): (x.score + (x.hint if x.score > 0 else 0)) * (1 - x.linked / x.chars) for x in held}
    best = max(held, key=lambda x: value[id(x)])  # the first of equals: the outer one
    around = best
    while around is not None and not around.hint:
        around = around.parent
    best = around or best  # of a part of an article, the article
    if best.parent is None:
        return "\n".join(blocks(best, not best.hint))
    around = [x for x in best.parent.items if (not x.skip if isinstance(x, Node) else x.strip())]
    least = 0.2 * value[id(best)]
    if best.hint:
        least = max(10, least)
    kept = []
    for x in around:
        dense = x.linked / x.chars if isinstance(x, Node) and x.chars else 1.0
        kept.append(x is best or isinstance(x, Node) and (value.get(id(x), 0) >= least and dense < 0.3 or (
            x.tag == "p" and best.tag not in ("article", "main") and dense < 0.25 and x.chars > 80)))
    if not best.hint:  # headings, bare text and unlinked paragraphs beside what is kept belong to it
        small = [isinstance(x, str) or x.tag not in BLOCK and not x.linked or x.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6") and not x.linked for x in around]
        for places in (range(1, len(around)), range(len(around) - 2, -1, -1)):
            step = -1 if places.step > 0 else 1
            for i in places:
                kept[i] = kept[i] or small[i] and kept[i + step]
    out = []
    parts = Node("", None, False)  # bare text and inline elements are one block until the next block
    for x, keep in zip(around, kept):
        if keep:
            parts.items.append(x)
        else:
            out += blocks(parts, not best.hint)
            parts.items = []
    return "\n".join(out + blocks(parts, not best.hint))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points of the text).

    Null or empty html and pages without any text outside boilerplate give an empty text. Character references are
    decoded, white space in a block becomes one space, blocks are joined by one line feed. Pages are read whole, and
    unclosed or cut-off markup is closed where HTML closes it.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [main_text(x) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(extract, f"page_id {kind}, url string, text string, n_chars bigint")
