"""Main text of HTML pages by composite text density.

Every element gets its characters per tag, adjusted by how much of it is link text; an element's
density sum adds up its children's. The element of the greatest sum is the core of the article. The least
density on the path from it to the body is the threshold: what stands beside the path counts as
content if its density reaches it, be it an element or a run of strings and inline elements, whose
density is that of an element around them. If the core lies in an article or main element, that element
is the content. Navigation, headers, footers, sidebars, forms, scripts and the like are taken out before,
by element, role, or a word of their class or id. A word whose elements hold most of the page's text that
is not link text, and most of that in its article and main elements, names its layout and takes nothing out.

Text comes out in blocks: character references decoded, white space within a block turned into one
space, blocks joined in page order by a line feed. Null and pages without text give the empty string.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never article text.
NOISE = frozenset(
    "nav header footer aside form script style noscript template button select option textarea iframe "
    "svg canvas object dialog menu head title audio video datalist".split()
)
BLOCK = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 "
    "h4 h5 h6 hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split()
)
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice notices "
    "newsletter subscribe subscription signup popup modal comment comments disqus replies reply share sharing "
    "social related recommended widget pagination pager toolbar skip".split()
)
CONTENT = frozenset(["article", "main"])
#: Noise that may stand around a whole page.
AROUND = frozenset(["form", "header", "nav", "aside", "dialog"])
#: Elements that hold text without tags.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: Open elements that a start tag ends: any open paragraph, and an equal element up to its container.
_ENDS_P = BLOCK | NOISE - frozenset("script style template noscript button select option iframe svg canvas object audio video datalist".split())
_SIBLINGS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}


class Node:
    __slots__ = ("tag", "noise", "around", "level", "marks", "content", "block", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density", "sum")

    def __init__(self, tag: str, parent: Node | None, noise: bool, content: bool):
        self.tag, self.parent, self.noise, self.content = tag, parent, noise, content
        self.around, self.level = noise and tag in AROUND, 0 if parent is None else parent.level + 1
        self.marks: frozenset[str] = frozenset()
        self.block = tag in BLOCK
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_GAP = re.compile(r"[\s/]*")
_SPACE = re.compile(r"\s*")
_ATTRIBUTE = re.compile(r"=?[^\s/>=]*")
_BARE = re.compile(r"[^\s>]*")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in RAW}


class _Scanner:
    """Tags and text of a page, each character looked at a bounded number of times.

    What has once been searched for in vain up to the end is not searched for again.
    """

    def __init__(self, page: str):
        self.page, self.lost = page, set()

    def _find(self, what: str, start: int) -> int:
        if what in self.lost:
            return -1
        at = self.page.find(what, start)
        if at < 0:
            self.lost.add(what)
        return at

    def _attributes(self, at: int) -> tuple[list[tuple[str, str | None]], int]:
        """Attributes from ``at`` on, and where the tag ends; -1 if it does not."""
        page, found = self.page, []
        while True:
            at = _GAP.match(page, at).end()
            if at >= len(page):
                return found, -1
            if page[at] == ">":
                return found, at + 1
            name = _ATTRIBUTE.match(page, at)
            at, value = _SPACE.match(page, name.end()).end(), None
            if page[at : at + 1] == "=":
                at = _SPACE.match(page, at + 1).end()
                quote = page[at : at + 1]
                end = self._find(quote, at + 1) if quote in ("'", '"') and quote else -1
                if end < 0:
                    bare = _BARE.match(page, at)
                    value, at = bare.group(), bare.end()
                else:
                    value, at = page[at + 1 : end], end + 1
            found.append((name.group().lower(), None if value is None else unescape(value)))

    def feed(self, tree: _Tree) -> None:
        page, at = self.page, 0
        while at < len(page):
            begin = self._find("<", at)
            if begin < 0:
                tree.handle_data(unescape(page[at:]))
                return
            after = page[begin + 1 : begin + 2]
            is_end = after == "/"
            name = _NAME.match(page, begin + 1 + is_end)
            if name is None and after not in ("!", "?", "/") or not after:
                tree.handle_data(unescape(page[at : begin + 1]))  # no tag, so it is text
                at = begin + 1
                continue
            if begin > at:
                tree.handle_data(unescape(page[at:begin]))
            if name is None:
                at = self._after_declaration(begin)
            else:
                tag = name.group().lower()
                attributes, at = self._attributes(name.end())
                if at < 0:
                    return  # a tag that the page's end cuts short
                if is_end:
                    tree.handle_endtag(tag)
                else:
                    tree.handle_starttag(tag, attributes)
                    at = self._after_raw(tag, at, tree)

    def _after_declaration(self, begin: int) -> int:
        """Where a comment, a document type, or something like them ends."""
        if self.page.startswith("<!--", begin):
            if self.page.startswith((">", "->"), begin + 4):
                return self.page.index(">", begin) + 1
            end = self._find("-->", begin + 4)
            if end >= 0:
                return end + 3
        end = self._find(">", begin)
        return len(self.page) if end < 0 else end + 1

    def _after_raw(self, tag: str, at: int, tree: _Tree) -> int:
        """The end of an element without tags; one that is never closed holds tags, or the rest if it is a script or style."""
        if tag not in RAW:
            return at
        end = None if tag in self.lost else _RAW_END[tag].search(self.page, at)
        if end is None:
            self.lost.add(tag)
            tree.handle_endtag(tag)
            return len(self.page) if tag in ("script", "style") else at
        if end.start() > at:
            tree.handle_data(self.page[at : end.start()])
        return end.start()


class _Tree:
    """A tree of elements and strings; closes what HTML lets authors leave open."""

    def __init__(self):
        self.root = self.at = Node("#root", None, False, False)
        self.open: dict[str, list[Node]] = {}  # open elements by tag, outermost first
        self.marked: list[Node] = []
        self.around: list[Node] = []

    def _open(self, tag: str, noise: bool, content: bool) -> None:
        node = Node(tag, self.at, noise, content)
        self.at.children.append(node)
        self.at = node
        self.open.setdefault(tag, []).append(node)

    def _close_to(self, node: Node) -> None:
        while True:
            gone, self.at = self.at, self.at.parent
            self.open[gone.tag].pop()
            if gone is node:
                return

    def _end(self, tags: frozenset, stop: frozenset) -> None:
        """Close the outermost open element of ``tags`` that lies within the nearest of ``stop``."""
        level = max((self.open[t][-1].level for t in stop if self.open.get(t)), default=0)
        found = None
        for own in (self.open.get(t) for t in tags):
            place = bisect_right(own, level, key=lambda n: n.level) if own else 0
            if own and place < len(own) and (found is None or own[place].level < found.level):
                found = own[place]
        if found is not None:
            self._close_to(found)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            self.at.children.append(" " if tag != "hr" else "\n")
            return
        if tag in _ENDS_P and self.open.get("p"):
            self._end(frozenset(["p"]), _SCOPE)
        if tag in _SIBLINGS:
            self._end(*_SIBLINGS[tag])
        noise, content, marks = tag in NOISE, tag in CONTENT, set()
        for name, value in attrs:
            if not value:
                noise = noise or name == "hidden"
            elif name in ("class", "id"):
                # A word of the name tells, as in "page-sidebar"; the body and articles keep theirs.
                if tag not in _KEPT:
                    marks.update(NOISE_WORDS.intersection(_words(value)))
            elif name == "role":
                noise = noise or value.lower() in NOISE_ROLES
                content = content or value.lower() in CONTENT
            elif name == "aria-hidden":
                noise = noise or value.lower() == "true"
            elif name == "style":
                noise = noise or bool(_HIDDEN.search(value.lower()))
        self._open(tag, noise, content)
        if marks and not noise:
            self.at.marks = frozenset(marks)
            self.marked.append(self.at)
        if self.at.around:
            self.around.append(self.at)

    def handle_endtag(self, tag: str) -> None:
        if self.open.get(tag):
            self._close_to(self.open[tag][-1])

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


_SCOPE = frozenset("td th table caption button article section main body html".split())
_KEPT = frozenset("html body article main".split())
_WORD = re.compile("[a-z0-9]+")
_CAMEL = re.compile("([a-z0-9])([A-Z])")
_ABOUT = re.compile(r"\b(?:has|with|without|no|non|is)[-_]\S*")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def _words(names: str) -> list[str]:
    """Words of class names; names such as "has-sidebar" tell about something else."""
    return _WORD.findall(_ABOUT.sub(" ", _CAMEL.sub(r"\1-\2", names).lower()))


def _settle_marks(tree: _Tree) -> None:
    """Elements marked by a word are noise, unless the word's elements hold most of the text that is not link text,
    both of the page and, if there are any, of its article and main elements."""
    words = frozenset().union(*(n.marks for n in tree.marked))
    total, held = [0, 0], {word: [0, 0] for word in words}
    stack = [(tree.root, frozenset(), False)]
    while stack:
        node, marks, inside = stack.pop()
        marks, inside = marks | node.marks, inside or node.content
        for child in node.children:
            if isinstance(child, str):
                n = len(child.strip())
                for count in (total, *(held[word] for word in marks)):
                    count[0] += n
                    count[1] += n * inside
            elif not child.noise and child.tag != "a":
                stack.append((child, marks, inside))
    layout = {
        word for word, (n, own) in held.items() if 2 * n > total[0] and (2 * own > total[1] or not total[1])
    }
    for node in tree.marked:
        node.noise = not node.marks <= layout


def _settle_around(tree: _Tree) -> None:
    """A form, header and the like that holds most of the page's text that is not link text, and most of that in
    its article and main elements if there are any, is no noise."""
    counts = {}  # text of every element, and what of it lies in article and main elements
    order = []
    stack = [(tree.root, False)]
    while stack:
        node, inside = stack.pop()
        inside = inside or node.content
        n = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        counts[id(node)] = [n, n * inside]
        order.append(node)
        stack.extend(
            (c, inside) for c in node.children if not isinstance(c, str) and c.tag != "a" and (c.around or not c.noise)
        )
    for node in reversed(order):
        if node.parent is not None:
            above = counts[id(node.parent)]
            above[0] += counts[id(node)][0]
            above[1] += counts[id(node)][1]
    total, own = counts[id(tree.root)]
    for node in tree.around:
        n, content = counts.get(id(node), (0, 0))
        node.noise = not (2 * n > total and (2 * content > own or not own))


def _in_order(root: Node) -> list[Node]:
    """Elements from the root down, without those that are noise and what they hold."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(c for c in reversed(node.children) if not isinstance(c, str) and not c.noise)
    return out


def _measure(nodes: list[Node]) -> None:
    for node in reversed(nodes):  # children before parents
        for child in node.children:
            if isinstance(child, str):
                node.chars += len(child.strip())
            elif not child.noise:
                node.block = node.block or child.block
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.chars if child.tag == "a" else child.link_chars
                node.link_tags += child.link_tags + (child.tag == "a")
    body = nodes[0]
    ratio = body.link_chars / max(body.chars, 1)
    for node in nodes:
        node.density = composite_density(node.chars, node.tags, node.link_chars, node.link_tags, ratio)
    for node in nodes:
        node.sum = sum(c.density for c in node.children if not isinstance(c, str) and not c.noise)


def composite_density(chars: int, tags: int, link_chars: int, link_tags: int, ratio: float) -> float:
    """C/T times the logarithm of (C/LC)(T/LT) to a base that grows with the share of link text.

    ``ratio`` is the body's share of link text; zero divisors count as 1.
    """
    if not chars:
        return 0.0
    per_tag = chars / max(tags, 1)
    base = math.log(chars / max(chars - link_chars, 1) * link_chars + ratio * chars + math.e)
    inner = chars / max(link_chars, 1) * max(tags, 1) / max(link_tags, 1)
    return per_tag * math.log(max(inner, 1.0)) / math.log(max(base, 1.0 + 1e-9)) if base > 1 else per_tag * math.log(max(inner, 1.0) + 1)


def _content(nodes: list[Node]) -> set[int | tuple[int, int]]:
    """Ids of the elements whose whole text (without noise) is content, and of others with the place of a child that is."""
    core = max(nodes, key=lambda n: n.sum)  # the first of equal ones, so the outermost
    if not core.sum:
        return {id(nodes[0])}
    path = [core]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min((n.density for n in path if n.tag not in ("#root", "html")), default=0.0)
    inner = [n for n in path if n.content]
    if inner:
        # Others belong to the page's content if they are as dense as what stands around the core, or half as dense
        # as the one it lies in: of two alike, one is always below their mean.
        own = {id(n) for n in path}
        top = inner[-1]
        least = min(threshold, top.density / 2)
        within = {id(n) for n in _in_order(top)}
        return {id(top)} | {
            id(n) for n in nodes if n.content and id(n) not in own and id(n) not in within and n.density >= least
        }
    taken = {id(core)}
    on_path = {id(n) for n in path}
    ratio = nodes[0].link_chars / max(nodes[0].chars, 1)
    for node in path[1:]:
        for run in _runs(node, on_path):
            if _run_density([node.children[k] for k in run], ratio) >= threshold:
                taken.update((id(node), k) for k in run)
        taken.update(
            id(c)
            for c in node.children
            if not isinstance(c, str) and not c.noise and id(c) not in on_path
            and (c.density >= threshold or c.tag in ("h1", "h2", "h3", "h4", "h5", "h6"))
        )
    return taken


def _runs(node: Node, on_path: set[int]) -> Iterator[list[int]]:
    """Places of strings and inline elements of a node between its blocks and the path; line breaks do not part them."""
    run: list[int] = []
    for place, child in enumerate(node.children):
        if isinstance(child, str):
            run.append(place)
        elif child.noise:
            continue
        elif child.block or id(child) in on_path:
            if run:
                yield run
            run = []
        else:
            run.append(place)
    if run:
        yield run


def _run_density(run: list[Node | str], ratio: float) -> float:
    inline = [c for c in run if not isinstance(c, str)]
    return composite_density(
        sum(len(c.strip()) if isinstance(c, str) else c.chars for c in run),
        sum(c.tags + 1 for c in inline),
        sum(c.chars if c.tag == "a" else c.link_chars for c in inline),
        sum(c.link_tags + (c.tag == "a") for c in inline),
        ratio,
    )


def extract(html: str) -> str:
    tree = _Tree()
    _Scanner(html).feed(tree)
    if tree.around:
        _settle_around(tree)
    if tree.marked:
        _settle_marks(tree)
    nodes = _in_order(tree.root)
    _measure(nodes)
    taken = _content(nodes)
    blocks: list[list[str]] = [[]]
    # A stack of what is still to come: strings, elements, and ends of blocks.
    stack: list[tuple[Node | str | None, bool]] = [(tree.root, False)]
    while stack:
        item, inside = stack.pop()
        if item is None or item == "\n" and inside:
            blocks.append([])
        elif isinstance(item, str):
            if inside:
                blocks[-1].append(item)
        elif not item.noise:
            inside = inside or id(item) in taken
            if item.tag in BLOCK:
                blocks.append([])
                stack.append((None, False))
            stack.extend(
                (c, inside or (id(item), k) in taken) for k, c in reversed(list(enumerate(item.children)))
            )
    lines = (" ".join("".join(parts).split()) for parts in blocks)
    return "\n".join(line for line in lines if line)


def main_text(pages: DataFrame) -> DataFrame:
    """A row per page: page_id, url, text, n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h.as_py() or "") for h in batch["html"]]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
