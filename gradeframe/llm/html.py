"""The main text of web pages, by composite text density."""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import column, map_texts, ship_by_value

# How HTML elements behave.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe title textarea xmp noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody tfoot thead tr ul".split()
)
_SPACE = frozenset("br td th caption img".split())
# An element of the first kind ends an open one of the second kinds.
_ENDS = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr",),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
_KEEPS = frozenset("article main section div table ul ol dl body aside nav footer header form td th blockquote".split())
# What is never part of an article, by element, role, or a word of class or id.
_DROPPED = frozenset(
    "script style noscript template iframe head nav aside footer form button select input textarea svg math canvas "
    "object audio video dialog menu title".split()
)
_DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar alert alertdialog dialog toolbar".split()
)
_DROPPED_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adbox|banner|promo\w*|sponsor\w*|comments?|commentlist|disqus|respond|replies|"
    r"cookies?|consent|gdpr|notices?|alert|newsletter|subscri\w+|sidebar|side-bar|menu|nav|navbar|navigation|"
    r"breadcrumbs?|share|sharing|social|related|recommend\w*|footer|popup|modal|pagination|pager|masthead|"
    r"site-header|page-header|topbar|toolbar|skip-link)(?=$|[\s_-])|^widget$",
    re.I,
)
# Words by which a class says that something else is around, or how a page is laid out.
_WRAPPERS = re.compile(
    r"(?:.*[_-])?(?:has|have|no|not|with|without|hide)[_-].*|layout[_-].*|.*[_-](?:layout|page|body)", re.I
)
# Words of that list that a name of several words may hold without being such a part ("market-share"),
# unless it ends in the second kind ("legal-notice").
_DOUBTFUL_WORDS = re.compile(r"notices?|alert|menu|share|sharing|social|related|recommend\w*", re.I)
_SURE_ENDS = re.compile(r".*[_-](?:notices?|alert|menu)", re.I)
_DOUBTFUL, _SURE = 1, 2
_SENTENCE_ENDS = frozenset(".!?:;\u2026\u3002\"'\u201d\u2019)")
_RIGHTS = re.compile(r"\W*(?:\u00a9|\(c\)|copyright\b)|.*\ball rights reserved\b", re.I | re.S)
# What may stay open in a head.
_HEAD = frozenset("base link meta title style script noscript template head".split())
# An unwanted element with less plain text than this is never the article.
_LEAST = 140
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_EXEMPT = frozenset("html body main article".split())

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>", re.S
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)


class Node:
    """An element with what its subtree holds."""

    __slots__ = ("tag", "parent", "first", "last", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, first: int) -> None:
        self.tag, self.parent, self.first, self.last = tag, parent, first, -1
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _unwanted(tag: str, attributes: str, inside_article: bool) -> int:
    """Whether an element is no part of an article: 0, ``_DOUBTFUL`` or ``_SURE``."""
    if tag in _DROPPED or tag == "header" and not inside_article:
        return _SURE
    if tag in _EXEMPT or not attributes:
        return 0
    found = 0
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return _SURE
        if name == "role" and value.lower() in _DROPPED_ROLES:
            return _SURE
        # The id of a heading is made of its words.
        if name == "class" or name == "id" and tag not in _HEADINGS:
            found = max([found, *map(_judged, value.split())])
    return found


def _judged(name: str) -> int:
    """What one name of a class or id says, as in ``_unwanted``."""
    words = [w.strip("_-") for w in _DROPPED_WORDS.findall(name)]
    if not words or _WRAPPERS.fullmatch(name):
        return 0
    doubtful = name not in words and not _SURE_ENDS.fullmatch(name) and all(map(_DOUBTFUL_WORDS.fullmatch, words))
    return _DOUBTFUL if doubtful else _SURE


_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=$|[\s=/])|aria-hidden\s*=\s*[\"']?true)", re.I)


class Dropped:
    """An unwanted element that its class, role or being a form makes one, or one inside it:
    where it starts, its plain text and that of links, how the plain text ends, and what
    says that an article is in it."""

    __slots__ = ("at", "doubtful", "chars", "linked", "marks", "ending")

    def __init__(self, at: int, doubtful: bool, chars: int, linked: int, marks: int) -> None:
        self.at, self.doubtful, self.ending = at, doubtful, ""
        self.chars, self.linked, self.marks = -chars, -linked, -marks

    def is_prose(self) -> bool:
        """Mostly plain text, that is long or ends like a sentence."""
        return 2 * self.linked < self.chars and (self.chars >= _LEAST or self.ending in _SENTENCE_ENDS)


def parse(page: str) -> tuple[list[Node], list[str | None]]:
    """The elements of a page in order, and its text runs (None: a block ends or starts).

    Comments, unwanted elements and markup are left out. Elements that are never closed
    end where HTML lets them, at the latest with the page. A form, or an element unwanted
    by class, id or role, stays if it holds most of the page's plain text (that of no link
    and no unwanted element of another kind) and either little is left
    without it, or only inside it there is an ``article``, ``main`` or ``h1``. An element
    whose name only contains such a word among others, as "related-work" does, stays if it
    is prose.
    """
    nodes, runs, dropped, chars, marks = _parse(page, frozenset())
    if not dropped:
        return nodes, runs
    kept = sum(len("".join(r.split())) for r in runs if r)
    kept_marks = any(n.tag in _MARKS for n in nodes)
    spared = frozenset(
        d.at
        for d in dropped
        if d.doubtful
        and d.is_prose()
        or 2 * d.chars > chars
        and d.chars >= _LEAST
        and (kept < _LEAST or d.marks and not kept_marks)
    )
    return _parse(page, spared)[:2] if spared else (nodes, runs)


_MARKS = frozenset(["article", "main", "h1"])


def _parse(page: str, spared: frozenset[int]) -> tuple[list[Node], list[str | None], list[Dropped], int, int]:
    """One reading of a page in which the elements that start at ``spared`` are not dropped;
    also what was dropped by class, role or as a form, and the plain text and marks of all."""
    dropped: list[Dropped] = []
    open_dropped: list[tuple[int, Dropped]] = []
    chars = linked = marks = 0
    ending = ""  # the last plain character
    in_link = False  # whether a link is what bars
    barred = 0  # how deep the stack was when a link or an element that always goes began
    nodes, runs = [Node("html", None, 0)], []
    stack, at, size = [nodes[0]], 0, len(page)
    skipped = 0  # how deep the stack was when an unwanted element began, 0 outside
    articles = 0  # open articles and mains

    def close(depth: int) -> None:
        nonlocal skipped, articles, barred, in_link
        while len(stack) > depth:
            node = stack.pop()
            node.last = len(runs)
            if node.tag in ("article", "main"):
                articles -= 1
            if node.tag in _BLOCK and not skipped:
                runs.append(None)
            if skipped and len(stack) < skipped:
                skipped = 0
            if barred and len(stack) < barred:
                barred, in_link = 0, False
            while open_dropped and len(stack) < open_dropped[-1][0]:
                d = open_dropped.pop()[1]
                d.chars += chars
                d.linked += linked
                d.marks += marks
                d.ending = ending if d.chars else ""

    while at < size:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else size
        if stop > at and stack[-1].tag == "head" and not page[at:stop].isspace():
            close(len(stack) - 1)
        if stop > at and not skipped:
            runs.append(html.unescape(page[at:stop]))
        plain = "".join(page[at:stop].split()) if stop > at and (in_link or not barred) else ""
        if plain and barred:
            linked += len(plain)
        elif plain:
            chars += len(plain)
            ending = plain[-1]
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    close(depth)
                    break
                if tag not in _BLOCK and stack[depth].tag in _BLOCK:
                    break
            continue
        if stack[-1].tag == "head" and tag not in _HEAD:
            close(len(stack) - 1)
        if tag in ("html", "head", "body") and tag != "head":
            if tag == "body" and not any(n.tag == "body" for n in stack):
                stack.append(Node(tag, stack[-1], len(runs)))
                nodes.append(stack[-1])
            continue
        # What this element ends.
        ended = _ENDS.get(tag, ()) or (("p",) if tag in _BLOCK else ())
        for depth in range(len(stack) - 1, 0, -1) if ended else ():
            if stack[depth].tag in ended:
                close(depth)
                break
            if stack[depth].tag in _KEEPS:
                break
        bad = 0 if barred or m.start() in spared else _unwanted(tag, m[3], articles > 0)
        unwanted = bool(bad) and not skipped
        if tag in _RAW:
            end = re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if not skipped and not unwanted:
            if tag in _BLOCK:
                runs.append(None)
            elif tag in _SPACE:
                runs.append(" ")
        if tag in _VOID or m[3].endswith("/") and tag not in _BLOCK:
            continue
        node = Node(tag, stack[-1], len(runs))
        stack.append(node)
        articles += tag in ("article", "main")
        if bad and (tag not in _DROPPED or tag == "form") and tag != "header" and not _HIDDEN.search(m[3]):
            dropped.append(Dropped(m.start(), bad == _DOUBTFUL, chars, linked, marks))
            open_dropped.append((len(stack), dropped[-1]))
        elif not barred and (bad or tag == "a"):
            barred, in_link = len(stack), not bad
        marks += tag in _MARKS and not barred
        if unwanted:
            skipped = len(stack)
        elif not skipped:
            nodes.append(node)
    close(0)
    return nodes, runs, dropped, chars, marks


def _measure(nodes: list[Node], runs: list[str | None]) -> Node:
    """Work out the density of every element and the sum of its children's."""
    before = [0]
    for run in runs:
        before.append(before[-1] + (len("".join(run.split())) if run else 0))
    for node in nodes:
        node.chars = before[node.last] - before[node.first]
    for node in reversed(nodes):
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        if node.parent:
            up = node.parent
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    body = next((n for n in nodes if n.tag == "body"), nodes[0])
    linked = body.link_chars / max(1, body.chars)
    for node in reversed(nodes):
        if node.chars:
            tags, links, link_tags = max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
            plain = max(1, node.chars - node.link_chars)
            base = math.log(math.log(node.chars / plain * links + linked * node.chars + math.e))
            node.density = node.chars / tags * math.log(max(1.0, node.chars * tags / (links * link_tags))) / base
        if node.parent:
            node.parent.total += node.density
    return body


def select(nodes: list[Node], runs: list[str | None]) -> Node:
    """The element that holds the article.

    It is the one with the largest sum of child densities. The lowest density on its path
    to the body is the threshold: an element around it is taken instead if its other
    children of at least that density hold a third as much text, which is how an article
    in several sections stays whole. Inside an ``article`` or ``main``, all of that counts.
    """
    body = _measure(nodes, runs)
    best = max(nodes, key=lambda n: n.total) if any(n.total for n in nodes) else body
    path = []
    node = best
    while node and node is not body:
        path.append(node)
        node = node.parent
    named = [n for n in path if n.tag == "article"] or [n for n in path if n.tag == "main"]
    if named:
        return named[-1]
    threshold = min(n.density for n in [*path, body])
    children: dict[int, list[Node]] = {}
    for n in nodes:
        children.setdefault(id(n.parent), []).append(n)
    while best is not body and best.parent:
        beside = sum(n.chars for n in children[id(best.parent)] if n is not best and n.density >= threshold)
        if 3 * beside < best.chars:
            break
        best = best.parent
    return best


def _is_plain(node: Node) -> bool:
    return node.chars > 0 and 2 * node.link_chars < node.chars


def _more_articles(best: Node, nodes: list[Node]) -> list[Node]:
    """Articles beside the chosen one, in its ``main`` or its parent, that are no teasers:
    mostly plain text, and at least a third as much as in the chosen one."""
    if best.tag != "article":
        return []
    holder = up = best.parent
    while up:
        holder = up if up.tag == "main" else holder
        up = up.parent
    found: list[Node] = []
    for n in nodes:
        inside = n.tag == "article" and holder and holder.first <= n.first and n.last <= holder.last
        if not inside or best.first <= n.first < best.last or found and n.first < found[-1].last:
            continue
        if _is_plain(n) and 3 * n.chars >= best.chars:
            found.append(n)
    return found


def _outermost(best: Node) -> Node:
    """The element itself, or the outermost below the body that holds no other text."""
    while best.parent and best.parent.tag not in ("html", "body") and best.parent.chars == best.chars:
        best = best.parent
    return best


def _leads(best: Node, nodes: list[Node]) -> list[Node]:
    """Headings and paragraphs before the chosen element, beside it, and an ``h1`` further up."""
    if best.tag in ("html", "body", "article", "main"):
        return []
    around, up = {}, best.parent
    while up:
        around[id(up)] = up is best.parent
        up = up.parent
    found = []
    for n in nodes:
        if n is best:
            break
        beside = around.get(id(n.parent))
        if _is_plain(n) and (n.tag == "h1" and beside is not None or beside and (n.tag in _HEADINGS or n.tag == "p")):
            found.append(n)
    return found


def _closings(best: Node, nodes: list[Node], runs: list[str | None]) -> list[Node]:
    """Paragraphs after the chosen element, beside it, with the headings above them; notes
    on rights are none, and neither are paragraphs with links directly in the body."""
    if best.tag in ("html", "body", "article", "main"):
        return []
    found, headings = [], []
    for n in nodes:
        if n.parent is not best.parent or n.first < best.last or n is best:
            continue
        if n.tag in _HEADINGS and _is_plain(n):
            headings.append(n)
        elif n.tag in ("p", "blockquote") and _is_plain(n):
            text = "".join(r or " " for r in runs[n.first : n.last])
            if not _RIGHTS.match(text) and not (n.link_tags and n.parent.tag in ("html", "body")):
                found += [*headings, n]
            headings = []
        elif n.tag in _BLOCK:
            headings = []
    return found


def main_text(page: str) -> str:
    """The article of a page: blocks joined by line feeds, white space within one made single."""
    nodes, runs = parse(page)
    node = select(nodes, runs)
    blocks, open_block = [], []
    outer = _outermost(node)
    parts = [*_leads(outer, nodes), node, *_closings(outer, nodes, runs), *_more_articles(node, nodes)]
    parts.sort(key=lambda n: n.first)
    for run in (r for n in parts for r in [*runs[n.first : n.last], None]):
        if run is None:
            block = " ".join("".join(open_block).split())
            if block:
                blocks.append(block)
            open_block = []
        else:
            open_block.append(run)
    return "\n".join(blocks)


def extract(pages: DataFrame, page: str = "html", output: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``output``, the main text, to the columns ``keep`` (default: all but ``page``).

    One row in, one row out; NULL and empty pages give ''. A column that is already called
    ``output`` is replaced. Pages are worked on where they are read.
    """
    names = [c for c in pages.columns if c not in (page, output)] if keep is None else keep
    source = pages.select(*[column(pages, c).alias(f"__{c}") for c in names], column(pages, page).alias("text"))

    def run(texts: list[str]) -> list[pa.Array]:
        return [pa.array([main_text(t) for t in texts], pa.string())]

    found = map_texts(source, run, "main string")
    return found.select(*[column(found, f"__{c}").alias(c) for c in names], F.col("main").alias(output))


ship_by_value(__name__)
