"""Main text of web pages by composite text density.

The page becomes a tree of elements (end tags that HTML lets writers leave out are supplied, stray ones are
ignored). What is never main text goes first: scripts, styles, menus, headers, footers and sidebars. Forms, and elements
whose class, id or role names a notice, advert, sidebar or reader comment, go too if they hold less than ``MUCH`` of
the page's text that is no link, or if an article stands outside of them; else their children are judged. A block of
reader comments goes whatever its size; ``comments-open`` and the like name no such block. A header inside an article
is the article's. If nothing were left, no name counts. Each element that is left
gets a *density*: its characters per tag, corrected by the ratio of link to other text. The sum of the
densities of an element's children is high where much text lies together. The subtree with the highest sum
gives a threshold, the lowest density on its path to the body. The main text is the highest element on that path
with more than this one branch of text: an article, one with text of its own, with another child that reaches the
threshold, or with at least ``BESIDE`` as much text beside the path. Of it only lists and sections that are mostly
links and below the threshold go. Without such an element the subtree of the highest sum is the main text.

Blocks (paragraphs, headings, list items, table rows, ...) are one line each; white space inside a block is one
space, a line break of the page included. Character references are decoded. Null or empty pages have no text.
Deep nesting and very long pages cost linear time; the tree is walked without recursion.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clinspark.llm.common import Work, append_columns

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table"
    " tbody tfoot thead tr ul".split()
)
#: Elements that may be chosen as main text; others are parts of what such an element says.
HOLDERS = frozenset("body div section article main center td details".split())
#: Elements that go from main text if they are mostly links.
LISTS = HOLDERS | frozenset("ul ol dl menu table".split())
#: So much text beside the densest subtree, as a share of its own, belongs to the main text.
BESIDE = 0.1
#: Elements that a start tag ends, up to the nearest of the second set.
CLOSES = {
    **dict.fromkeys(BLOCK - {"html", "body"}, (frozenset(["p"]), frozenset(["button", "table", "td", "th", "caption"]))),
    "li": (frozenset(["li", "p"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd", "p"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd", "p"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th", "p"]), frozenset(["table"])),
    "td": (frozenset(["td", "th", "p"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th", "p"]), frozenset(["tr", "table"])),
    "tbody": (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th", "p"]), frozenset(["table"])),
    "thead": (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th", "p"]), frozenset(["table"])),
    "tfoot": (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th", "p"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "body": (frozenset(["head"]), frozenset()),
}
#: An end tag does not reach beyond these.
FENCES = frozenset(["table", "td", "th", "caption", "body", "html"])
NEVER = frozenset(
    "head script style noscript template title nav header footer aside button select option input textarea"
    " iframe object embed svg canvas audio video menu dialog map".split()
)
#: An element with this share of the page's text is no mere notice, whatever its name.
MUCH = 1 / 3
#: Words of a class, id or role that name what is no main text.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion promoted"
    " nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar"
    " header masthead footer colophon contentinfo complementary search"
    " sidebar aside widget related recommended recommendations trending popular"
    " cookie cookies consent gdpr notice notices alert popup modal overlay paywall newsletter subscribe signup"
    " comment comments commentlist disqus respond replies reply share sharing social login".split()
)
#: Of these, names that inside of an article are the article's own.
HEADER_WORDS = frozenset(["header", "masthead"])
#: First words of the name of a block of reader comments, and last words of a name that says how things stand.
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond replies".split())
STATE_WORDS = frozenset("open closed enabled disabled allowed on off none count".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|([^<]+|<)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"[ \t\n\r\f\v\xa0]+")


class Node:
    """An element; ``parts`` holds its texts and children in page order."""

    __slots__ = ("tag", "parent", "parts", "named", "comment", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, named: bool = False, comment: bool = False) -> None:
        self.tag, self.parent, self.parts, self.named, self.comment = tag, parent, [], named, comment


def attributes_of(text: str) -> dict[str, str]:
    """Attributes of a start tag; of two with one name the first counts."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), value.strip("\"'"))
    return found


def is_aside(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether the element is never main text; a header inside of an article is the article's own."""
    if tag in NEVER:
        return tag != "header" or not in_article
    if tag in ("html", "body", "article", "main"):
        return False
    return "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"


def is_comment(attributes: dict[str, str]) -> bool:
    """Whether a class or id names reader comments, and not whether comments are open."""
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = [w.lower() for w in _WORD.findall(name)]
        if words and words[0] in COMMENT_WORDS and words[-1] not in STATE_WORDS:
            return True
    return False


def is_named(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether the element's name says that it is no main text."""
    if tag in ("html", "body", "article", "main"):
        return False
    words = {w.lower() for n in ("class", "id", "role") for w in _WORD.findall(attributes.get(n, ""))}
    return tag == "form" or not words.isdisjoint(ASIDE_WORDS - HEADER_WORDS if in_article else ASIDE_WORDS)


def drop_named(root: Node) -> None:
    """Takes out the elements that are judged by their names."""
    nodes = in_page_order(root)
    if not any(n.named or n.comment for n in nodes):
        return
    plain, articles, links, believed = {}, {}, {}, {}
    for node in nodes:
        above = node.parent
        links[node] = node.tag == "a" or above is not None and links[above]
        believed[node] = node.named or node.comment or above is not None and believed[above]
    for node in reversed(nodes):
        plain[node] = sum(plain[p] if isinstance(p, Node) else 0 if links[node] else len(_SPACE.sub("", p)) for p in node.parts)
        inside = sum(articles[p] for p in node.parts if isinstance(p, Node))
        articles[node] = plain[node] if node.tag in ("article", "main") and not believed[node] else inside
    total = plain[root]
    gone: set[Node] = set()
    todo: list[tuple[Node, int]] = [(root, 0)]
    while todo:
        node, around = todo.pop()  # around: characters of the article that the node stands in
        if node.tag in ("article", "main") and not around:
            around = plain[node]
        outside = articles[root] - max(around, articles[node])
        if node.comment or node.named and (
                plain[node] < MUCH * total or outside >= total / 10 or node.tag == "form" and outside):
            gone.add(node)
        else:
            todo += [(p, around) for p in node.parts if isinstance(p, Node)]
    if total and sum(plain[n] for n in gone) == total:
        return
    for node in {n.parent for n in gone}:
        node.parts = [p for p in node.parts if not isinstance(p, Node) or p not in gone]


def parse(page: str) -> Node:
    """The tree of the page without what is never main text."""
    root = Node("#", None)
    node, at, dropped, dropped_at = root, 0, None, 0  # dropped: the element whose content is being left out, and its depth
    stack = [root]
    depths: defaultdict[str, list[int]] = defaultdict(list)  # of the open elements of each name

    def deepest(tags: Iterable[str]) -> int:
        return max((depths[t][-1] for t in tags if depths[t]), default=0)

    def close(depth: int) -> None:
        for gone in reversed(stack[depth:]):
            depths[gone.tag].pop()
        del stack[depth:]

    while at < len(page):
        token = _TOKEN.match(page, at)
        if token is None:  # an unfinished tag at the end
            break
        at = token.end()
        end, tag, attributes, text = token.groups()
        if text is not None:
            if dropped is None:
                node.parts.append(text)
            continue
        if tag is None:
            if token[0].startswith("<![CDATA[") and dropped is None:
                node.parts.append(html.escape(token[0][9:].removesuffix("]]>"), quote=False))
            continue
        tag = tag.lower()
        if end:
            depth = deepest([tag])
            if depth and (tag in FENCES or depth > deepest(FENCES)):
                close(depth)
        else:
            if tag in ("html", "body") and depths[tag]:
                continue
            ended, fence = CLOSES.get(tag, (frozenset(), frozenset()))
            while (depth := deepest(ended)) > deepest(fence):
                close(depth)
                if tag in ("li", "p", "option", "body") or tag in BLOCK and ended == {"p"}:
                    break
            if dropped is not None and (len(stack) <= dropped_at or stack[dropped_at] is not dropped):
                dropped = None
            above, names = stack[-1], attributes_of(attributes)
            in_article = bool(depths["article"] or depths["main"])
            aside = is_aside(tag, names, in_article)
            seen = dropped is None and not aside
            comment = seen and tag not in ("html", "body", "main") and is_comment(names)
            made = Node(tag, above, seen and is_named(tag, names, in_article), comment)
            if tag in RAW and not attributes.rstrip().endswith("/"):
                last = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
                content = page[at:last.start()] if last else page[at:]
                at = page.find(">", last.start()) + 1 or len(page) if last else len(page)
                if dropped is None and not aside and not made.named:
                    above.parts.append(content)
                continue
            if dropped is None and not aside:
                above.parts.append(made)
            if tag not in VOID and not attributes.rstrip().endswith("/"):
                depths[tag].append(len(stack))
                stack.append(made)
                if dropped is None and aside:
                    dropped, dropped_at = made, len(stack) - 1
        if dropped is not None and (len(stack) <= dropped_at or stack[dropped_at] is not dropped):
            dropped = None
        node = stack[-1]
    drop_named(root)
    return root


def in_page_order(top: Node) -> list[Node]:
    found, todo = [], [top]
    while todo:
        node = todo.pop()
        found.append(node)
        todo += [p for p in reversed(node.parts) if isinstance(p, Node)]
    return found


def measure(root: Node) -> tuple[list[Node], Node]:
    """Characters, tags and densities of all elements; the elements in page order, and the body."""
    nodes = in_page_order(root)
    body = next((n for n in nodes if n.tag == "body"), root)
    for node in nodes:
        node.chars = sum(len(_SPACE.sub("", p)) for p in node.parts if isinstance(p, str))
        node.tags = node.link_chars = node.link_tags = 0
        node.density = node.total = 0.0
    for node in reversed(nodes):
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        if node.parent is not None:
            above = node.parent
            above.chars += node.chars
            above.tags += node.tags + 1
            above.link_chars += node.link_chars
            above.link_tags += node.link_tags
    share = body.link_chars / max(body.chars, 1)
    for node in reversed(nodes):
        if node.chars:
            c, t, lc, lt = node.chars, max(node.tags, 1), node.link_chars, max(node.link_tags, 1)
            base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
            node.density = c / t * math.log(c / max(lc, 1) * t / lt + 1) / math.log(base + 1)
        if node.parent is not None:  # inline markup belongs to its block
            node.parent.total += node.density if node.tag in BLOCK or node.tag in HOLDERS else node.total
    return nodes, body


def main_nodes(root: Node) -> list[Node]:
    """The subtrees that hold the main text, in page order."""
    nodes, body = measure(root)
    within = in_page_order(body)
    best = max((n for n in within if n is body or n.tag in HOLDERS), key=lambda n: n.total)
    if best.total == 0:
        return [body]
    threshold, node = best.density, best
    while node is not body:
        node = node.parent
        threshold = min(threshold, node.density)
    path = [best]
    while path[-1] is not body:
        path.append(path[-1].parent)
    path.reverse()
    for at, node in enumerate(path[:-1]):
        if _branches(node, path[at + 1], best, threshold):
            for own, below in zip(path[at:], path[at + 1:]):
                own.parts = [p for p in own.parts if isinstance(p, str) or p is below or not _is_menu(p, threshold)]
            return [node]
    return [best]


def _branches(node: Node, below: Node, best: Node, threshold: float) -> bool:
    """Whether main text stands in ``node`` outside of its child ``below``."""
    if node.tag in ("article", "main"):
        return True
    if node.tag != "body" and any(isinstance(p, str) and _SPACE.sub("", p) for p in node.parts):
        return True
    others = [p for p in node.parts if isinstance(p, Node) and p is not below]
    beside = sum(p.chars - p.link_chars for p in others)
    return beside >= BESIDE * (best.chars - best.link_chars) or any(p.density >= threshold for p in others)


def _is_menu(node: Node, threshold: float) -> bool:
    return node.tag in LISTS and node.link_chars * 2 > node.chars and node.density < threshold


def blocks(top: Node) -> list[str]:
    """Texts of the blocks of a subtree."""
    found: list[str] = []
    own: list[str] = []

    def end() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(own))).strip()
        if text:
            found.append(text)
        own.clear()

    todo: list[Node | str | None] = [top]
    while todo:
        part = todo.pop()
        if part is None:
            end()
        elif isinstance(part, str):
            own.append(part)
        elif part.tag in BLOCK:
            end()
            todo.append(None)
            todo += reversed(part.parts)
        else:
            if part.tag in ("br", "td", "th"):
                own.append(" ")
            todo += reversed(part.parts)
    end()
    return found


def main_text(page: str | None) -> str:
    if not page:
        return ""
    return "\n".join(b for node in main_nodes(parse(page)) for b in blocks(node))


def _texts() -> Work:
    return lambda pages: [[main_text(p) for p in pages]]


def extract_text(pages: DataFrame, *, html_column: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the string column ``out``: the main text of each."""
    return append_columns(pages, html_column, [T.StructField(out, T.StringType())], _texts)
