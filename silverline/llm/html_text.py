"""Main text of web pages by composite text density.

Markup becomes a tree with implied end tags. Every node gets its characters per tag, lowered by the
share of its characters and tags that belong to links. A parent's density sum adds up its children;
the node with the largest sum holds the main text. The least density on the path from the body to it
is the threshold that other parts of the page must reach. Parts chosen inside an <article> grow to it.

Parts beside the main text count for nothing: elements such as <nav>, hidden ones, and those whose
class or id names such a part, unless these wrap the main text.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame

from silverline.llm.common import map_rows

SCHEMA = "page_id long, url string, text string, n_chars long"

# Elements by their part in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Elements that are never main text.
ASIDE = frozenset(
    "head script style textarea title xmp iframe noembed noframes noscript nav footer aside form button select option menu dialog "
    "template svg canvas object audio video datalist".split()
)
# Words in class or id that name a part of the page beside its main text.
BESIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar nav navbar navigation menu "
    "breadcrumb breadcrumbs footer masthead cookie cookies consent notice notices notification gdpr popup modal overlay newsletter "
    "subscribe subscription signup share sharing social related recommended recommendations comment comments commentlist discussion "
    "disqus reply replies respond widget pagination pager toolbar login skip".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# What a start tag closes when it is still open, and what stops the search for it.
CLOSES = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "tbody": (frozenset({"thead", "tbody", "tfoot"}), frozenset({"table"})),
    "tfoot": (frozenset({"thead", "tbody", "tfoot"}), frozenset({"table"})),
    "option": (frozenset({"option"}), frozenset({"select"})),
    "body": (frozenset({"head"}), frozenset()),
}
_P = (frozenset({"p"}), frozenset({"table", "td", "th", "button", "article", "section", "div", "body", "html"}))

_TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE = re.compile(r"</?([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Tree:
    """Nodes in document order, and the text and block breaks between them."""

    def __init__(self) -> None:
        self.tag = ["#root"]
        self.parent = [-1]
        self.beside = [False]
        self.named = [False]  # by class or id alone
        self.first = [0]  # of the node's events
        self.last = [0]
        self.events: list[tuple[int, str | None]] = []  # (node, text), or (node, None) for a block break

    def open(self, tag: str, parent: int, beside: bool, named: bool = False) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.beside.append(beside)
        self.named.append(named)
        self.first.append(len(self.events))
        self.last.append(len(self.events))
        return len(self.tag) - 1


def _pieces(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes): text, open, close."""
    at, size, quotes_close = 0, len(page), True
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            yield "text", page[at:], ""
            return
        if mark > at:
            yield "text", page[at:mark], ""
        if page.startswith("<!--", mark):
            end = page.find("-->", mark + 4)
            at = size if end < 0 else end + 3
            continue
        if page[mark + 1 : mark + 2] in ("!", "?"):
            end = page.find(">", mark)
            at = size if end < 0 else end + 1
            continue
        match = _TAG.match(page, mark) if quotes_close else None
        if match is None:
            loose = _LOOSE.match(page, mark)
            if loose is None:
                if page[mark + 1 : mark + 2] == "/" or page[mark + 1 : mark + 2].isalpha():
                    if page.find(">", mark) < 0:
                        return  # a tag that never ends
                yield "text", "<", ""
                at = mark + 1
                continue
            quotes_close = False  # a quote stays open: from here tags end at the first >
            match = loose
        name = match[1].lower()
        at = match.end()
        if page[mark + 1] == "/":
            yield "close", name, ""
            continue
        yield "open", name, match[2]
        if name in RAW and not match[2].endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\b", re.IGNORECASE).search(page, at)
            at = size if end is None else end.start()


def _is_beside(tag: str, attributes: str, inside_article: bool) -> tuple[bool, bool]:
    """Whether an element lies beside the main text, and whether its class or id says so."""
    if tag in ASIDE or (tag == "header" and not inside_article):
        return True, False
    if not attributes or tag in ("html", "body", "article", "main"):
        return False, False
    named = False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id"):
            words = {w.lower() for w in _WORD.findall(value)}
            named = named or bool(words & BESIDE) or ("header" in words and not inside_article and tag != "h1")
        elif name == "role" and value.lower() in ROLES:
            return True, named
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, named
        elif name == "style" and "display:none" in value.replace(" ", "").lower():
            return True, named
    return False, named


def _apply_names(tree: Tree) -> None:
    """Parts named beside the main text become it, save wrappers of the main text.

    A wrapper holds a <main>, or an <article> with at least half the unlinked text of the longest; on
    pages without either, more than half of the page's unlinked text.
    """
    if not any(tree.named):
        return
    n = len(tree.tag)
    sizes, linked = [0] * n, [False] * n
    for node in range(1, n):
        linked[node] = linked[tree.parent[node]] or tree.tag[node] == "a"
    for node, text in tree.events:
        if text and not tree.beside[node] and not linked[node]:
            sizes[node] += len("".join(text.split()))
    for node in range(n - 1, 0, -1):
        sizes[tree.parent[node]] += sizes[node]
    seen = [k for k in range(1, n) if not tree.beside[k] and sizes[k]]
    longest = max((sizes[k] for k in seen if tree.tag[k] == "article"), default=0)
    kept = [k for k in seen if tree.tag[k] == "main" or (tree.tag[k] == "article" and 2 * sizes[k] >= longest)]
    wraps = [False] * n
    for node in kept:
        up = tree.parent[node]
        while up > 0 and not wraps[up]:
            wraps[up] = True
            up = tree.parent[up]
    for node in range(1, n):
        wrapper = wraps[node] if kept else 2 * sizes[node] > sizes[0]
        if tree.beside[tree.parent[node]] or (tree.named[node] and not wrapper):
            tree.beside[node] = True


def parse(page: str) -> Tree:
    """The tree of a page; start tags close what they imply, end tags close down to their element."""
    tree, stack, articles = Tree(), [0], 0
    open_tags: dict[str, int] = {}

    def shut(down_to: int) -> None:
        nonlocal articles
        while len(stack) > down_to:
            node = stack.pop()
            tag = tree.tag[node]
            open_tags[tag] -= 1
            articles -= tag in ("article", "main")
            if tag in BLOCKS:
                tree.events.append((node, None))
            tree.last[node] = len(tree.events)

    def close_open(tags: frozenset[str], until: frozenset[str]) -> None:
        if not any(open_tags.get(t) for t in tags):
            return
        for place in range(len(stack) - 1, 0, -1):
            tag = tree.tag[stack[place]]
            if tag in tags:
                shut(place)
                return
            if tag in until:
                return

    for kind, name, attributes in _pieces(page):
        if kind == "text":
            tree.events.append((stack[-1], name))
        elif kind == "close":
            if open_tags.get(name):
                place = len(stack) - 1
                while tree.tag[stack[place]] != name:
                    place -= 1
                shut(place)
            elif name in ("p", "br"):
                tree.events.append((stack[-1], None if name == "p" else " "))
        else:
            if name in BLOCKS:
                close_open(*_P)
            if name in CLOSES:
                close_open(*CLOSES[name])
            if name in VOID:
                tree.events.append((stack[-1], None if name == "hr" else " " if name == "br" else ""))
                node = tree.open(name, stack[-1], True)
                continue
            beside, named = _is_beside(name, attributes, articles > 0)
            if name in BLOCKS:
                tree.events.append((stack[-1], None))
            node = tree.open(name, stack[-1], beside or tree.beside[stack[-1]], named)
            stack.append(node)
            open_tags[name] = open_tags.get(name, 0) + 1
            articles += name in ("article", "main")
    shut(1)
    tree.last[0] = len(tree.events)
    _apply_names(tree)
    return tree


def densities(tree: Tree, body: int) -> list[float]:
    """Composite text density of every node; parts beside the main text count for nothing."""
    n = len(tree.tag)
    chars, linked, tags, links = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for node in range(1, n):
        in_link[node] = in_link[tree.parent[node]] or tree.tag[node] == "a"
    for node, text in tree.events:
        if text and not tree.beside[node]:
            size = len("".join(text.split()))
            chars[node] += size
            linked[node] += size * in_link[node]
    for node in range(n - 1, 0, -1):
        if not tree.beside[node]:
            up = tree.parent[node]
            chars[up] += chars[node]
            linked[up] += linked[node]
            tags[up] += tags[node] + 1
            links[up] += links[node] + (tree.tag[node] == "a")
    body_share = linked[body] / max(1, chars[body])
    found = [0.0] * n
    for node in range(n):
        c, lc, t, lt = chars[node], linked[node], max(1, tags[node]), max(1, links[node])
        if c:
            base = math.log(c / max(1, c - lc) * lc + body_share * c + math.e)
            found[node] = c / t * math.log(max(1.0, c / max(1, lc) * t / lt) + 1e-9, max(base, 1.0 + 1e-9))
    return found


def _ancestors(tree: Tree, node: int) -> Iterator[int]:
    while node >= 0:
        yield node
        node = tree.parent[node]


def main_parts(tree: Tree) -> list[int]:
    """The nodes whose subtrees are the main text, in page order."""
    n = len(tree.tag)
    body = next((k for k in range(n) if tree.tag[k] == "body"), 0)
    density = densities(tree, body)
    sums = [0.0] * n
    best = list(range(n))
    for node in range(n - 1, 0, -1):
        if not tree.beside[node]:
            up = tree.parent[node]
            sums[up] += density[node]
    for node in range(n - 1, 0, -1):
        up = tree.parent[node]
        if not tree.beside[node] and sums[best[node]] >= sums[best[up]]:
            best[up] = best[node]
    target = best[body] if sums[best[body]] > 0 else body
    path = [node for node in _ancestors(tree, target) if tree.tag[node] not in ("html", "#root") or node == body]
    threshold = min(density[node] for node in path)
    after = list(range(1, n + 1))  # the first node past each subtree; nodes are in document order
    for node in range(n - 1, 0, -1):
        up = tree.parent[node]
        after[up] = max(after[up], after[node])
    taken = [False] * n
    chosen = []
    for node in [target, *range(body, after[body])]:
        if taken[node] or tree.beside[node] or density[node] < threshold or not density[node]:
            continue
        part = best[node] if sums[best[node]] > 0 else node
        if not taken[part]:
            chosen.append(part)
            taken[part : after[part]] = [True] * (after[part] - part)
    parts: list[int] = []
    for part in sorted({next((k for k in _ancestors(tree, node) if tree.tag[k] == "article"), node) for node in chosen}):
        if not parts or part >= after[parts[-1]]:
            parts.append(part)
    return parts


def extract(page: str) -> str:
    """Blocks of the main text, one a line."""
    tree = parse(page)
    lines: list[str] = []
    for part in main_parts(tree):
        block: list[str] = []
        for node, text in [*tree.events[tree.first[part] : tree.last[part]], (part, None)]:
            if text is None:
                line = " ".join(html.unescape("".join(block)).split())
                if line:
                    lines.append(line)
                block = []
            elif not tree.beside[node]:
                block.append(text)
    return "\n".join(lines)


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page, each by itself and whole.

    NULL html counts as empty and gives empty text; a NULL id or url stays NULL; repeated rows each
    get a row; an empty table gives no rows; columns other than page_id, url and html are not looked at.
    Of nodes with equal sums the one deepest and first in the page is taken.
    """

    def make() -> Callable[[list[dict]], list[dict]]:
        def one(row: dict) -> dict:
            text = extract(row["html"] or "")
            return {"page_id": row["page_id"], "url": row["url"], "text": text, "n_chars": len(text)}

        return lambda rows: [one(row) for row in rows]

    return map_rows(pages.select("page_id", "url", "html"), make, SCHEMA)
