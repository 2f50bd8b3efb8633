"""Main text of web pages by wrapper induction.

The different pages of a host are dealt into groups of bounded size.  In each group the DOM trees
are aligned with those of several of its pages by simple tree matching (Yang, 1991): nodes that keep the same text in
nearly all pages are the host's template, the varying ones are slots.  The text of a page is
that of its varying slots, less menus, notices and the like, which vary but are never content,
and within the article where a page marks one: of several, that with the most varying text.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# HTML's element kinds, and words in class and id that mark what isn't content.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
_SKIPPED = frozenset(
    "head title script style noscript template iframe object embed svg canvas math form button "
    "select option textarea input label fieldset nav header footer aside menu dialog audio video "
    "map datalist".split()
)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr img nobr".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
_NOISE = frozenset(
    "ad ads advert adverts advertisement adsbygoogle sponsor sponsored promo promotion banner "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar "
    "cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe signup "
    "login comment comments disqus respond replies share sharing social related recommended "
    "recommendations widget pagination pager skip toolbar copyright legal".split()
)
#: What a compound that begins with one of these may end with and still be a box of that kind.
_BOXES = frozenset(
    "list box wrap wrapper container area section block slot bar item items link links panel "
    "group zone unit form button buttons inner outer holder row count message placeholder".split()
)
#: Words that on a heading or a paragraph tell its look or its topic.
_TOPICS = frozenset("header masthead sharing share social promotion legal".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PROSE = _HEADINGS | {"p", "blockquote", "pre", "figcaption"}
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar toolbar dialog alert "
    "alertdialog".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_CLASS_WORD = re.compile(r"[a-z]+")
_NUMBER = re.compile(r"\d+")


@dataclass(frozen=True)
class Induction:
    """Parameters of the induction; the defaults are those of the registered query."""

    #: Different pages of a host in one group, on average, and rows of a page that stay apart.
    pages: int = 24
    copies: int = 4
    #: Least number of different pages, and least share of them, to call a text constant.
    least: int = 4
    share: float = 0.8
    #: Pages that others are aligned with to judge their slots.
    judges: int = 3
    #: Entries of the table that matches two child lists; larger ones are never held whole.
    cells: int = 1 << 20


@dataclass
class Node:
    tag: str
    kind: str = ""
    noise: bool = False
    children: list["Node"] = field(default_factory=list)
    #: Text nodes have no tag.
    text: str = ""
    template: bool = False
    #: Hash of the subtree's elements and the number of its nodes.
    shape: int = 0
    size: int = 1


def parse(html: str) -> Node:
    """A DOM tree; forgiving of unclosed and stray tags, as browsers are."""
    root = Node("#root")
    stack = [root]
    at = 0
    while True:
        match = _TOKEN.search(html, at)
        if not match:
            _text(stack[-1], html[at:])
            return root
        if match.start() > at:
            _text(stack[-1], html[at : match.start()])
        at = match.end()
        if match[2] is None:
            continue
        tag = match[2].lower()
        if match[1]:
            _close(stack, tag)
            continue
        if tag in _CLOSES_P:
            _close_paragraph(stack)
        elif tag in ("li", "dt", "dd", "option", "tr", "td", "th"):
            _close_item(stack, tag)
        kind, noise = _attributes(tag, match[3]) if match[3] else ("", False)
        if tag == "article":
            # Posts often carry their number, which sets equal places of two pages apart.
            kind = _NUMBER.sub("", kind)
        node = Node(tag, kind, noise or tag in _SKIPPED)
        stack[-1].children.append(node)
        if tag in _RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
        elif tag not in _VOID and not match[3].endswith("/"):
            stack.append(node)


def _text(node: Node, raw: str) -> None:
    if raw:
        node.children.append(Node("", text=unescape(raw) if "&" in raw else raw))


def _close(stack: list[Node], tag: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return


def _close_paragraph(stack: list[Node]) -> None:
    """A block ends an open paragraph, with whatever inline elements are open in it."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == "p":
            del stack[i:]
            return
        if stack[i].tag not in _INLINE:
            return


_ITEMS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",),
          "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}


def _close_item(stack: list[Node], tag: str) -> None:
    same = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in same:
            del stack[i:]
            return
        if stack[i].tag in _ITEMS[tag]:
            return


def _attributes(tag: str, raw: str) -> tuple[str, bool]:
    """Class and id words as one key for matching, and whether they mark noise.

    A word marks noise by itself or as the head of a compound that ends with another such word
    or with a kind of box: ``comment-list`` does, ``no-sidebar``, ``has-menu`` and
    ``header-image-caption`` do not.
    """
    words: list[str] = []
    noise = False
    for match in _ATTRIBUTE.finditer(raw):
        name, value = match[1].lower(), (match[2] or "").strip("\"'").lower()
        if name in ("class", "id"):
            words += value.split()
        elif name == "role":
            noise |= value in _ROLES
        elif name == "hidden":
            noise = True
        elif name == "aria-hidden":
            noise |= value == "true"
        elif name == "style":
            noise |= "display:none" in value.replace(" ", "")
    if tag not in ("html", "body", "article", "main"):
        noise |= any(_marks_noise(w, tag) for w in words)
    return " ".join(words), noise


def _marks_noise(word: str, tag: str) -> bool:
    parts = _CLASS_WORD.findall(word)
    if not parts or parts[0] not in _NOISE or tag in _PROSE and parts[0] in _TOPICS:
        return False
    return len(parts) == 1 or parts[-1] in _NOISE or parts[-1] in _BOXES


def shaped(root: Node) -> None:
    """Give every node a hash of its subtree's elements; texts count as present only."""
    work = [(root, False)]
    while work:
        node, done = work.pop()
        if done:
            node.shape = hash((node.tag, node.kind, tuple(c.shape for c in node.children)))
            node.size = 1 + sum(c.size for c in node.children)
        else:
            work.append((node, True))
            work += [(c, False) for c in node.children]


def _alike(a: Node, b: Node) -> bool:
    return a.tag == b.tag and a.kind == b.kind


Sizes = dict[tuple[int, int], int]


def matching(
    a: Node, b: Node, limits: Induction, sizes: Sizes | None = None
) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: the size of the largest matching that keeps order and ancestry,
    and its pairs of nodes.

    Trees of equal shape match whole, children of equal shape at either end of two lists are
    paired off first, and the size for two other shapes is computed once and kept in ``sizes``.
    """
    sizes = {} if sizes is None else sizes
    if not _alike(a, b):
        return 0, []
    _measured(a, b, sizes)
    pairs: list[tuple[Node, Node]] = []
    work = [(a, b)]
    while work:
        a, b = work.pop()
        pairs.append((a, b))
        if a.shape == b.shape:
            work += zip(a.children, b.children)
            continue
        head, tail = _ends(a.children, b.children)
        work += zip(a.children[:head], b.children[:head])
        work += zip(a.children[len(a.children) - tail :], b.children[len(b.children) - tail :])
        left, right = _between(a, b)
        work += _paired(left, right, limits.cells, sizes)
    return len(pairs), pairs


def _ends(left: list[Node], right: list[Node]) -> tuple[int, int]:
    """How many children of two lists have equal shapes from the first on, and to the last."""
    shorter = min(len(left), len(right))
    head = 0
    while head < shorter and left[head].shape == right[head].shape:
        head += 1
    tail = 0
    while tail < shorter - head and left[-1 - tail].shape == right[-1 - tail].shape:
        tail += 1
    return head, tail


def _between(a: Node, b: Node) -> tuple[list[Node], list[Node]]:
    head, tail = _ends(a.children, b.children)
    return a.children[head : len(a.children) - tail], b.children[head : len(b.children) - tail]


def _measured(a: Node, b: Node, sizes: Sizes) -> None:
    """Put the sizes for two trees, and for the pairs below that they rest on, into ``sizes``."""
    work = [(a, b)]
    while work:
        a, b = work[-1]
        if (a.shape, b.shape) in sizes or a.shape == b.shape:
            work.pop()
            continue
        left, right = _between(a, b)
        kinds = {y.shape: y for y in right}.values()
        missing = [
            (x, y)
            for x in {x.shape: x for x in left}.values()
            for y in kinds
            if x.shape != y.shape and (x.shape, y.shape) not in sizes and _alike(x, y)
        ]
        if missing:
            work += missing
            continue
        work.pop()
        head, tail = _ends(a.children, b.children)
        ends = a.children[:head] + a.children[len(a.children) - tail :]
        inner = int(_last_row(left, right, sizes)[-1]) if left and right else 0
        sizes[a.shape, b.shape] = 1 + sum(x.size for x in ends) + inner


def _gain(x: Node, y: Node, sizes: Sizes) -> int:
    if x.shape == y.shape:
        return x.size
    return sizes[x.shape, y.shape] if _alike(x, y) else 0


def _rows(left: list[Node], right: list[Node], sizes: Sizes) -> Iterator[np.ndarray]:
    """Rows of the table that matches two lists, after each node of the left one."""
    kinds = {y.shape: y for y in right}
    number = {shape: k for k, shape in enumerate(kinds)}
    place = np.fromiter((number[y.shape] for y in right), np.int64, len(right))
    gains: dict[int, np.ndarray] = {}
    row = np.zeros(len(right) + 1, np.int64)
    for x in left:
        if x.shape not in gains:
            each = np.fromiter((_gain(x, y, sizes) for y in kinds.values()), np.int64, len(kinds))
            gains[x.shape] = each[place]
        best = row.copy()
        np.maximum(row[1:], row[:-1] + gains[x.shape], out=best[1:])
        row = np.maximum.accumulate(best)
        yield row


def _last_row(left: list[Node], right: list[Node], sizes: Sizes) -> np.ndarray:
    row = np.zeros(len(right) + 1, np.int64)
    for row in _rows(left, right, sizes):
        pass
    return row


def _paired(
    left: list[Node], right: list[Node], cells: int, sizes: Sizes
) -> list[tuple[Node, Node]]:
    """Pairs of the best matching of two lists.

    A table of more than ``cells`` entries is cut by Hirschberg's method, which halves the left
    list and finds where the best matching cuts the right one, from rows alone.
    """
    pairs: list[tuple[Node, Node]] = []
    work = [(left, right)]
    while work:
        left, right = work.pop()
        if not left or not right:
            continue
        if len(left) > 1 and len(left) * len(right) > cells:
            half = len(left) // 2
            upper = _last_row(left[:half], right, sizes)
            lower = _last_row(left[half:][::-1], right[::-1], sizes)[::-1]
            cut = int((upper + lower).argmax())
            work += [(left[:half], right[:cut]), (left[half:], right[cut:])]
            continue
        table = [np.zeros(len(right) + 1, np.int64), *_rows(left, right, sizes)]
        i, j = len(left), len(right)
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((left[i], right[j]))
    return pairs


def _own_text(node: Node) -> str:
    return " ".join(node.text.split())


def _texts(root: Node) -> set[str]:
    found, stack = set(), [root]
    while stack:
        node = stack.pop()
        stack += node.children
        if not node.tag:
            found.add(_own_text(node))
    return found - {""}


def induce(pages: list[Node], parameters: Induction) -> None:
    """Mark the text nodes of each page that belong to the template of the group.

    A text node is constant if it keeps its text in nearly all of the pages; equal pages count
    once, so that copies of an article do not make it a template.  Every page is aligned with
    as many different ones (the bases) as a constant text can be missing in, and one more: it
    is in one of them, whichever pages deviate.  A base without a text that so many pages
    hold somewhere is passed over.
    """
    if len(pages) < parameters.least:
        return
    numbers: dict[str, int] = {}
    bases: list[Node] = []
    numbered = []
    for page in pages:
        whole = "\n".join(_blocks(page, False))
        if whole not in numbers:
            bases.append(page)
        numbered.append((numbers.setdefault(whole, len(numbers)), page))
    needed = max(parameters.least, math.ceil(parameters.share * len(numbers)))
    if len(numbers) < needed:
        return
    bases = bases[: len(numbers) - needed + 1]
    held: dict[str, set[int]] = defaultdict(set)
    for number, page in numbered:
        for text in _texts(page):
            held[text].add(number)
    common = {text for text, some in held.items() if len(some) >= needed}
    sizes: Sizes = {}
    for base in bases:
        if not common.intersection(_texts(base)):
            continue
        aligned: dict[int, list[tuple[int, Node]]] = defaultdict(list)
        texts: dict[int, str] = {}
        for number, page in numbered:
            for x, y in matching(base, page, parameters, sizes)[1]:
                if x.tag:
                    continue
                if id(x) not in texts:
                    texts[id(x)] = _own_text(x)
                text = texts[id(x)]
                if text in common and (x.text == y.text or text == _own_text(y)):
                    aligned[id(x)].append((number, y))
        for same in aligned.values():
            if len({number for number, _ in same}) >= needed:
                for _, y in same:
                    y.template = True


def judge(pages: list[Node], parameters: Induction) -> None:
    """Take slots of a site that hold no article for noise, by what they hold on all its pages.

    Pages without a marked article are aligned with a few of them; what is aligned with one
    element of a base is a slot.  Beside a slot of prose, with paragraphs or headings on most
    pages, one that is mostly links is a menu; one that never has a paragraph or a heading and
    comes to less than a quarter of the prose is a notice, an advert or a footer.
    """
    bare = [p for p in pages if not any(n.tag in ("article", "main") for n in _nodes(p))]
    if len(bare) < parameters.least:
        return
    held = {id(n): has for p in bare for n, has in _holdings(p)}
    sizes: Sizes = {}
    for base in bare[: parameters.judges]:
        slots: dict[int, list[Node]] = defaultdict(list)
        for page in bare:
            for x, y in matching(base, page, parameters, sizes)[1]:
                if x.tag and x.tag not in _INLINE and x.tag not in _PROSE:
                    slots[id(x)].append(y)
        for parent in _nodes(base):
            own = [c for c in parent.children if id(c) in slots and not c.noise]
            total = {id(c): np.sum([held[id(y)] for y in slots[id(c)]], axis=0) for c in own}
            prose = {k: t[0] for k, t in total.items() if 2 * t[2] > len(slots[k]) and 2 * t[1] < t[0]}
            if not prose or len(own) < 2:
                continue
            most = max(prose.values())
            for c in own:
                chars, linked, with_prose = total[id(c)]
                if 5 * linked > 3 * chars or (not with_prose and 4 * chars < most):
                    for y in slots[id(c)]:
                        y.noise = True


def _nodes(root: Node) -> Iterator[Node]:
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack += node.children


def _holdings(root: Node) -> Iterator[tuple[Node, np.ndarray]]:
    """Of every element its characters, those of them in links, and whether it has prose."""
    found: dict[int, np.ndarray] = {}
    work = [(root, False)]
    while work:
        node, done = work.pop()
        if not done:
            work.append((node, True))
            work += [(c, False) for c in node.children if not c.noise]
            continue
        if not node.tag:
            found[id(node)] = np.array([len(_own_text(node)), 0, 0])
            continue
        has = np.zeros(3, np.int64)
        for child in node.children:
            if not child.noise:
                has = has + found[id(child)]
        if node.tag == "a":
            has[1] = has[0]
        has[2] = has[2] > 0 or (node.tag in _PROSE and has[0] > 0)
        found[id(node)] = has
        yield node, has
    # Elements of noise hold nothing that counts.
    for node in _nodes(root):
        if node.tag and id(node) not in found:
            yield node, np.zeros(3, np.int64)


def _spare(root: Node) -> None:
    """Take no element for noise that holds the article.

    That is the marked one, where no other stands outside noise.  On a page without a mark it is
    what holds the only first-level heading and a paragraph; failing that, on a page of noise
    alone, the element with the most varying text.
    """
    order, above = [], {id(root): root}
    stack = [root]
    while stack:
        node = stack.pop()
        order.append(node)
        for child in node.children:
            above[id(child)] = node
            stack.append(child)
    if any(_outermost(root, tag) for tag in ("article", "main")):
        return
    varying: dict[int, int] = defaultdict(int)
    for node in reversed(order):
        if not node.tag and not node.template:
            varying[id(node)] = len(_own_text(node))
        if node is not root:
            varying[id(above[id(node)])] += varying[id(node)]

    def spare(node: Node) -> None:
        while node is not root:
            node.noise = False
            node = above[id(node)]

    marked = [n for n in order if n.tag in ("article", "main") and varying[id(n)]]
    if marked:
        spare(max(marked, key=lambda n: varying[id(n)]))
        return
    boxes = [n for n in order if n.noise and (n.tag == "form" or n.tag not in _SKIPPED)]
    if not any(varying[id(n)] for _, n in _outermost(root, "h1")):
        for box in boxes:
            tags = {n.tag for n in _nodes(box) if varying[id(n)]}
            if "h1" in tags and "p" in tags:
                spare(box)
                return
    if boxes and not _blocks(root):
        # The outermost of equals: it comes first.
        spare(max(boxes, key=lambda n: varying[id(n)]))


def _outermost(root: Node, tag: str) -> list[tuple[tuple[str, ...], Node]]:
    """The outermost elements of a tag outside noise, each with its path of elements."""
    found: list[tuple[tuple[str, ...], Node]] = []
    stack: list[tuple[tuple, Node]] = [((), root)]
    while stack:
        path, node = stack.pop()
        if node.tag == tag and not node.noise:
            found.append((_flat(path, node), node))
        elif node is root or not node.noise or node.tag in ("html", "body"):
            stack += [((path, node), c) for c in reversed(node.children) if c.tag]
    return found


def _flat(path: tuple, node: Node) -> tuple[str, ...]:
    """Elements from the root down, numbers in their classes and ids left out."""
    out = []
    while True:
        out.append(f"{node.tag} {_NUMBER.sub('', node.kind)}")
        if not path:
            return tuple(out)
        path, node = path


def _article(root: Node) -> list[Node]:
    """The marked article, or the whole page.

    Of several outermost articles it is the one with the most varying text, with those of the
    same place and class; a main element with more text outside its articles than that comes
    before them.
    """
    marked = {tag: _outermost(root, tag) for tag in ("article", "main")}
    if sum(map(len, marked.values())) == 1:
        return [n for nodes in marked.values() for _, n in nodes]
    length = {id(n): sum(map(len, _blocks(n))) for nodes in marked.values() for _, n in nodes}
    all_ = sum(length[id(n)] for _, n in marked["article"])
    chosen: list[Node] = []
    for tag, nodes in marked.items():
        if not nodes:
            continue
        best, _ = max(nodes, key=lambda found: length[id(found[1])])
        same = [n for path, n in nodes if path == best]
        size = sum(length[id(n)] for n in same)
        if not chosen or size - all_ > sum(length[id(n)] for n in chosen):
            chosen = same
    return chosen or [root]


def _blocks(root: Node, wrapped: bool = True) -> list[str]:
    """Texts of the blocks below a node, in page order, without noise and template.

    A block is template if all of its text nodes are; constant words inside a varying
    paragraph are its own.
    """
    out: list[str] = []
    open_: list[Node] = []

    def flush() -> None:
        text = " ".join("".join([n.text for n in open_]).split())
        if text and not (wrapped and all(n.template or not n.text.strip() for n in open_)):
            out.append(text)
        open_.clear()

    work: list[tuple[Node, bool]] = [(root, False)]
    while work:
        node, done = work.pop()
        if done:
            flush()
        elif not node.tag:
            open_.append(node)
        elif node.noise and wrapped:
            if node.tag not in _INLINE:
                flush()
        else:
            if node.tag not in _INLINE:
                flush()
                work.append((node, True))
            work += [(c, False) for c in reversed(node.children)]
    flush()
    return out


def main_text(root: Node) -> str:
    """Text of the article without template; all of the article where nothing else is in it."""
    _spare(root)
    parts = _article(root)
    if parts[0] is not root and not any(map(_blocks, parts)):
        for part in parts:
            stack = [part]
            while stack:
                node = stack.pop()
                node.template = False
                stack += node.children
    return "\n".join(line for part in parts for line in _blocks(part))


def host(url: str) -> Column:
    """Host of a URL in lower case without its port; empty where there is none."""
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


def extracted(
    pages: DataFrame,
    parameters: Induction = Induction(),
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """One row per page: id, url, ``text`` and ``n_chars``.

    The different pages of a host are dealt by a hash of their html into groups of about
    ``parameters.pages``, so a hot host is many groups, copies do not crowd out the pages that
    tell its template, and a page's text does not depend on how Spark cuts its partitions.  Of
    a page with more than ``parameters.copies`` copies one is worked on and the others take
    its text.  Pages without a host are a host.  A null html gives an empty text; repeated
    rows stay.
    """
    types = dict(pages.dtypes)
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
        host(url_col).alias("host"), F.coalesce(F.md5(F.col(html_col)), F.lit("")).alias("page"),
    )
    distinct = stored(rows.groupBy("host", "page").agg(F.count(F.lit(1)).alias("n")), "html-pages")
    sizes = stored(
        distinct.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / parameters.pages).alias("groups")),
        "html-hosts",
    )
    copied = stored(
        distinct.where(F.col("n") > parameters.copies).select("host", "page"), "html-copied"
    )

    def extract(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("page", kind="stable")
        # Rows of the same page share its tree.
        trees = {page: parse(h) if h else Node("#root") for page, h in zip(group["page"], group["html"])}
        for tree in trees.values():
            shaped(tree)
        filled = [t for t in trees.values() if t.children]
        induce(filled, parameters)
        judge(filled, parameters)
        texts = {page: main_text(t) for page, t in trees.items()}
        return pd.DataFrame(
            {"id": group["id"], "url": group["url"], "host": group["host"], "page": group["page"],
             "text": group["page"].map(texts)}
        )

    def texts_of(some: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64("page"), "groups")
        return (
            some.join(sizes, "host")
            .withColumn("part", part)
            .groupBy("host", "part")
            .applyInPandas(extract, f"id {types[id_col]}, url string, host string, page string, text string")
        )

    if copied.isEmpty():
        out = texts_of(rows)
    else:
        key = ["host", "page"]
        many = rows.join(copied, key, "left_semi")
        one = many.groupBy(*key).agg(F.first("html").alias("html")).select(
            F.lit(None).cast(types[id_col]).alias("id"), F.lit(None).cast("string").alias("url"), "html", *key
        )
        some = rows.join(copied, key, "left_anti").select("id", "url", "html", *key)
        found = stored(texts_of(some.unionByName(one)), "html-texts")
        single = found.join(copied, key, "left_anti")
        shared = found.join(copied, key, "left_semi").select(*key, "text")
        out = single.unionByName(many.select("id", "url", *key).join(shared, key).select(*single.columns))
    return out.select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "text",
        F.length("text").cast("long").alias("n_chars"),
    )
