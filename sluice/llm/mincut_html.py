"""Main text of web pages by minimum cut (operator 7).

A page becomes its text blocks in page order.  A classifier over each block's place in
the DOM, link share and wording gives the cost of calling it content and that of
calling it boilerplate; these are the capacities of its edges to the two terminals.
Blocks next to each other, and blocks that follow one another in the same container,
are joined by smoothness edges that weaken with their distance in the DOM.  A maximum
flow finds the cheapest cut; blocks on the content side, in page order, are the text.

White space inside a block, line breaks by ``br`` too, becomes one space; blocks are
joined by a line feed.  Text of scripts, styles, forms and other elements that are not
running text never forms a block.

Results for edge cases: null and empty pages, and pages without text, have an empty
text of 0 characters; unclosed and crossing tags are repaired as browsers do in simple
cases; repeated rows give repeated rows; null ids and URLs pass; an empty table gives
an empty table; other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sluice.llm.common import arrow_map, id_field

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_NOT_WORD = re.compile(r"[^a-z0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())  # text up to the end tag
SILENT = frozenset(
    "script style template noscript head title textarea select option optgroup datalist button input label legend "
    "fieldset iframe object embed applet svg math canvas audio video map noembed noframes progress meter".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br".split()
)
# a start tag on the left closes an open element on the right, if nothing of the last set stands between
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
KEEPS_P = INLINE | {"p"}

BOILER_TAGS = frozenset("nav footer aside form menu dialog header".split())
BOILER_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form tablist status".split()
)
CONTENT_TAGS = frozenset(("article", "main"))
# parts of class and id names, whole or as the beginning of a part
BOILER_WORDS = frozenset(
    "ad ads adv adsense adbox adslot adunit banner masthead topbar toolbar nav navbar menu menubar sidebar side rail aside "
    "footer foot bottom copyright legal cookie cookies consent gdpr privacy notice alert warning popup modal overlay dialog toast "
    "promo promotion sponsor sponsored outbrain taboola related recommended recommendation recommendations more teaser trending popular "
    "social share sharing follow newsletter subscribe subscription signup login register paywall breadcrumb breadcrumbs crumbs "
    "pagination pager paging tags tagcloud widget comment comments commentlist reply replies respond disqus discussion feedback "
    "form search searchbox skip disclaimer hidden".split()
)
BOILER_STARTS = ("advert", "sponsor", "cookie", "comment", "breadcrumb", "sidebar", "footer", "subscri", "newsletter", "promo", "navig")
CONTENT_WORDS = frozenset("article content post entry story main text body prose".split())
LAYOUT_WORDS = frozenset("has with without no".split())  # what follows tells the layout of the element, not its role
# parts that say nothing about what an element holds, so that the part before them names it
FRAME_WORDS = frozenset(
    "area bar block box btn button buttons col column container desktop group head header heading icon icons inner item items left link "
    "links list main mobile outer page pages panel posts region right row section site slot stories title top unit wrap wrapper zone".split()
)
STYLE_WORDS = frozenset("text bg border color font".split())  # what follows is a look: "text-warning"
# words that name a place or a topic as often as furniture of the page
HINT_WORDS = frozenset("more side bottom foot legal popular".split())
# containers that hold articles of others beside the page's own
OTHERS = frozenset("comment comments commentlist reply replies respond disqus discussion related recommended recommendation recommendations "
                   "trending popular teaser".split())  # fmt: skip


class Node:
    """An open element: what its place says about the text in it."""

    __slots__ = ("tag", "up", "depth", "boiler", "content", "silent", "number", "wraps", "mark", "lead", "off", "others", "hint", "hinted", "story")

    def __init__(self, tag: str, up: Node | None, number: int):
        self.tag, self.up, self.number = tag, up, number
        self.depth = up.depth + 1 if up else 0
        self.boiler = up.boiler if up else False
        self.content = up.content if up else False
        self.silent = up.silent if up else False
        self.wraps = False
        self.mark = ""  # what makes this very element boilerplate: "tag" (or role) or "class"
        self.lead = 0  # 2: main, 1: article, -1: content by class, -2: h1
        self.off = False  # a class mark that does not count, as the element wraps the page's content
        self.others = False
        self.hint = False  # a class that may name boilerplate or a topic
        self.hinted = up.hinted if up else False
        self.story = up.story if up else False  # within an article element


def _is_boiler(word: str) -> bool:
    return word in BOILER_WORDS or word.startswith(BOILER_STARTS)


def _named(parts: list[str]) -> str:
    """What one class name tells by its parts: "firm" if the part that names the element
    is a word for boilerplate, "hint" if another part is, else nothing."""
    if not any(map(_is_boiler, parts)):
        return ""
    parts = [w.rstrip("0123456789") or w for w in parts]
    if parts[0] in STYLE_WORDS and len(parts) > 1:
        return "hint"
    named = [w for w in parts if w not in CONTENT_WORDS and (w not in FRAME_WORDS or _is_boiler(w)) and len(w) > 1 and not w.isdigit()]
    last = named[-1] if named else parts[-1]
    return "firm" if _is_boiler(last) and last not in HINT_WORDS else "hint"


def _names(attributes: str) -> tuple[set[str], str, bool, str]:
    """Parts of class and id, the role, whether the element is hidden, and what its names
    tell of boilerplate."""
    words, role, hidden, told = set(), "", False, ""
    for m in _ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
        if name in ("class", "id"):
            for part in _CAMEL.sub("-", value).lower().split():
                parts = []
                for word in _NOT_WORD.split(part):
                    if word in LAYOUT_WORDS:
                        break
                    if word:
                        parts.append(word)
                words.update(parts)
                if parts and told != "firm":
                    told = _named(parts) or told
        elif name == "role":
            role = value.strip().lower()
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (
            name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)
        ):
            hidden = True
    return words, role, hidden, told


def _place(node: Node, attributes: str) -> None:
    tag = node.tag
    words, role, hidden, told = _names(attributes) if attributes.strip(" /\n\t\r") else (set(), "", False, "")
    if tag in SILENT or hidden:
        node.silent = True
    if tag in CONTENT_TAGS or role in ("main", "article"):
        node.content = True
        node.lead = 2 if "main" in (tag, role) else 1
        node.story = node.story or "article" in (tag, role)
        return
    if tag == "h1":
        node.lead = -2
    if tag in ("body", "html"):
        return
    if tag == "header" and node.content:
        pass  # the heading of an article
    elif tag in BOILER_TAGS or role in BOILER_ROLES:
        node.boiler, node.mark = True, "tag"
    if told == "firm":
        node.boiler, node.mark = True, node.mark or "class"
        node.others = bool(words & OTHERS)
    elif words & CONTENT_WORDS and not words & BOILER_WORDS - HINT_WORDS:
        node.content = True
        node.lead = node.lead or -1
    elif told:
        node.hint = node.hinted = True


class Block:
    """Text between block boundaries, with what the classifier looks at."""

    __slots__ = ("text", "node", "link_share", "heading")

    def __init__(self, text: str, node: Node, link_share: float):
        self.text, self.node, self.link_share = text, node, link_share
        self.heading = len(node.tag) == 2 and node.tag[0] == "h" and node.tag[1].isdigit()


def text_blocks(page: str) -> list[Block]:
    """The page's blocks in order."""
    out: list[Block] = []
    number = 0
    node = Node("", None, 0)
    pieces: list[str] = []
    linked = links = 0
    block_node = node
    leads: list[Node] = []

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                share = linked / max(1, sum(len(p) - p.count(" ") for p in pieces))
                out.append(Block(text, block_node, min(1.0, share)))
            pieces.clear()
        linked = 0

    def container(n: Node) -> Node:
        while n.tag in INLINE and n.up:
            n = n.up
        return n

    def close(tag: str) -> None:
        """Ends the nearest open ``tag`` and what is open inside it."""
        nonlocal node, links
        n = node
        while n and n.tag != tag:
            n = n.up
        if n is None or n.up is None:
            return
        while True:
            if node.tag == "a":
                links -= 1
            done = node is n
            node = node.up
            if done:
                return

    def text(raw: str) -> None:
        nonlocal linked, block_node
        if not node.silent and raw:
            if not pieces:
                block_node = container(node)
            plain = html.unescape(raw) if "&" in raw else raw
            pieces.append(plain)
            if links:
                linked += len(plain) - plain.count(" ")

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, ends = m[2].lower(), bool(m[1])
        inline = tag in INLINE
        if tag == "br":
            if pieces:
                pieces.append(" ")
            continue
        if not inline:
            flush()
        if ends:
            if tag == "p" and not _is_open(node, "p"):
                continue
            close(tag)
            continue
        if tag in CLOSES:
            shut, until = CLOSES[tag]
            n = node
            while n and n.tag not in until:
                if n.tag in shut:
                    close(n.tag)
                    break
                n = n.up
        if tag not in INLINE and _is_open(node, "p"):
            close("p")
        if tag in VOID:
            continue
        number += 1
        node = Node(tag, node, number)
        _place(node, m[3])
        if tag == "h1" or (node.content and not node.up.content):
            n = node.up
            while n:
                if n.tag == "form":
                    n.wraps = True
                n = n.up
        if node.lead and not node.silent:
            leads.append(node)
        if tag == "a":
            links += 1
        if tag in RAW and not m[3].endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else size
    flush()
    _take_marks_off(out, leads)
    _take_hints_off(out, leads)
    return out


def _path(node: Node) -> Iterator[Node]:
    n = node
    while n:
        yield n
        n = n.up


def _by_tag(node: Node) -> bool:
    return any(n.mark == "tag" and not (n.tag == "form" and n.wraps) for n in _path(node))


def _take_marks_off(blocks: list[Block], leads: list[Node]) -> None:
    """A class that names boilerplate does not count on a container that wraps the
    page's own article, main element or heading: it tells the layout then ("has-sidebar").
    Articles in containers beside the page's own text (comments, related stories)
    leave the marks as they are."""
    leads = [n for n in leads if n.boiler or n.lead]
    if not any(n.up.boiler and any(p.mark == "class" for p in _path(n.up)) for n in leads):
        return
    leads = [n for n in leads if not _by_tag(n)]
    if any(n.lead > 0 for n in leads):
        ranked = {n: n.lead for n in leads if n.lead > 0}
        for h in leads:
            if h.lead == -2:
                ranked |= {n: 2 for n in _path(h) if n in ranked}
    else:
        ranked = {n: 1 for n in leads}
    size: dict[Node, float] = {}
    total = 0.0
    live: set[Node] = set()  # those with text that no mark takes
    for b in blocks:
        if _by_tag(b.node):
            continue
        own = len(b.text) * (1 - b.link_share)
        total += own
        free = not _in_boilerplate(b.node)
        for n in _path(b.node):
            size[n] = size.get(n, 0.0) + own
            if free and n in ranked and own >= 20:
                live.add(n)
    caught = [n for n in ranked if any(p.mark == "class" for p in _path(n.up))]
    for lead in sorted(caught, key=lambda n: (-ranked[n], -size.get(n, 0.0))):
        marks = [p for p in _path(lead.up) if p.mark == "class"]
        if all(p.off for p in marks):
            continue
        around = set(_path(lead.up))
        beside = max((ranked[n] for n in live - around), default=0)
        most = 2 * size.get(marks[-1], 0.0) >= total
        if live & around:
            wraps = most and not beside and not any(p.others for p in marks)
        else:
            wraps = ranked[lead] == 2 > beside or (most and not beside)
        if wraps:
            for p in marks:
                p.off = True
            live.add(lead)


def _take_hints_off(blocks: list[Block], leads: list[Node]) -> None:
    """A hint tells nothing of an element around the page's article, main element or
    heading, or around half of its text."""
    if not any(b.node.hinted for b in blocks):
        return
    around = {n for lead in leads for n in _path(lead.up)}
    size: dict[Node, int] = {}
    total = 0
    for b in blocks:
        if not _in_boilerplate(b.node):
            total += len(b.text)
            for n in _path(b.node):
                if n.hint:
                    size[n] = size.get(n, 0) + len(b.text)
    for n, own in size.items():
        if n in around or 2 * own >= total:
            n.hint = False


def _is_open(node: Node, tag: str) -> bool:
    """Whether a ``tag`` is open within the nearest container that bounds it."""
    n = node
    while n:
        if n.tag == tag:
            return True
        if n.tag not in INLINE:
            return False
        n = n.up
    return False


def _in_boilerplate(node: Node) -> bool:
    """Boilerplate by place; a form around the whole page does not count, nor does the
    class of an element around its content."""
    n = node
    while n and n.boiler:
        if n.mark and not n.off and not (n.tag == "form" and n.wraps):
            return True
        n = n.up
    return False


def content_score(block: Block, any_content: bool) -> float:
    """Log odds that a block is main text, from its place, tag, length, last character,
    link share and wording.  ``any_content``: the page marks some container as its main
    content.  Only places that name boilerplate firmly decide alone; what a hint, a link
    or a short line says, neighbouring blocks can overrule in the cut."""
    words = block.text.count(" ") + 1
    score = -0.5 if any_content else 1.0
    if _in_boilerplate(block.node):
        score -= 8.0
    elif block.node.content:
        score += 4.0
    elif any_content:
        score -= 3.0
    if block.node.boiler and any(n.off for n in _path(block.node)):
        score -= 0.5
    hinted = block.node.hinted and any(n.hint for n in _path(block.node))
    if hinted:
        score -= 2.5
    if block.node.tag in ("p", "blockquote", "pre"):
        score += 1.0
    if block.heading:
        score += 0.8
    score += min(2.0, 0.5 * math.log1p(words) - 0.8)
    if block.text[-1] in ".!?…:;\"'”»)。！？":
        score += 0.5
    # lists of links are usual in an article, and menus outside of one
    score -= (2.5 if block.node.story and not hinted else 4.0) * block.link_share * (words < 40)
    if block.text[0] in "©" or "all rights reserved" in block.text[:200].lower():
        score -= 4.0
    return score


def dom_distance(a: Node, b: Node) -> int:
    """Steps between two elements through their nearest common ancestor."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.up
        else:
            b = b.up
        steps += 1
    return steps


class FlowGraph:
    """Maximum flow by shortest augmenting levels (Dinic), for cuts of small graphs."""

    def __init__(self, n: int):
        self.edges: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[float] = []

    def add(self, a: int, b: int, forth: float, back: float = 0.0) -> None:
        self.edges[a].append(len(self.to))
        self.edges[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.room += [forth, back]

    def levels(self, source: int) -> list[int]:
        level = [-1] * len(self.edges)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in self.edges[a]:
                b = self.to[e]
                if self.room[e] > 1e-9 and level[b] < 0:
                    level[b] = level[a] + 1
                    queue.append(b)
        return level

    def source_side(self, source: int, sink: int) -> list[bool]:
        """Which nodes stay with the source in a minimum cut."""
        to, room = self.to, self.room
        while (level := self.levels(source))[sink] >= 0:
            turn = [0] * len(self.edges)
            path: list[int] = []
            a = source
            while True:
                if a == sink:
                    flow = min(room[e] for e in path)
                    for e in path:
                        room[e] -= flow
                        room[e ^ 1] += flow
                    back = next(i for i, e in enumerate(path) if room[e] <= 1e-9)
                    a = to[path[back] ^ 1]
                    del path[back:]
                    continue
                edges = self.edges[a]
                while turn[a] < len(edges):
                    e = edges[turn[a]]
                    if room[e] > 1e-9 and level[to[e]] == level[a] + 1:
                        break
                    turn[a] += 1
                if turn[a] < len(edges):
                    path.append(edges[turn[a]])
                    a = to[path[-1]]
                elif a == source:
                    break
                else:
                    level[a] = -1
                    a = to[path.pop() ^ 1]
        return [x >= 0 for x in self.levels(source)]


SMOOTH = 3.0  # capacity between neighbouring blocks of the same container


def main_blocks(blocks: list[Block]) -> list[bool]:
    """Which blocks are content, by minimum cut."""
    n = len(blocks)
    if not n:
        return []
    firm = [_in_boilerplate(b.node) for b in blocks]
    marked = any(b.node.content and not f for b, f in zip(blocks, firm))
    graph = FlowGraph(n + 2)
    source, sink = n, n + 1
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        s = max(-30.0, min(30.0, content_score(b, marked)))
        graph.add(source, i, math.log1p(math.exp(s)))  # paid if it is called boilerplate
        graph.add(i, sink, math.log1p(math.exp(-s)))  # paid if it is called content
        # a place that names boilerplate firmly is a border: nothing is smooth across it
        if i and firm[i - 1] == firm[i]:
            w = SMOOTH / (1 + dom_distance(blocks[i - 1].node, b.node))
            graph.add(i - 1, i, w, w)
        parent = b.node.up.number if b.node.up else 0
        j = last.get(parent)
        if j is not None and j != i - 1 and firm[j] == firm[i]:
            w = SMOOTH / (2 + dom_distance(blocks[j].node, b.node))
            graph.add(j, i, w, w)
        last[parent] = i
    return graph.source_side(source, sink)[:n]


def main_text(page: str) -> str:
    blocks = text_blocks(page)
    return "\n".join(b.text for b, keep in zip(blocks, main_blocks(blocks)) if keep)


def _extract(names: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h or "") for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=names,
            )

    return run


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id, url, text, n_chars`` for every row of ``pages``."""
    schema = StructType([
        id_field(pages, id_col), id_field(pages, url_col),
        StructField("text", StringType()), StructField("n_chars", LongType()),
    ])
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.transform(arrow_map, _extract(schema.names), schema)
