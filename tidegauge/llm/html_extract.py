"""Main text of web pages by a minimum cut between content and boilerplate.

A page is cut into blocks of text. A linear classifier on tags, names of classes, links and length
says what it costs to call a block content or boilerplate; these costs are the capacities of its
edges to the two terminals. Blocks that follow one another, and blocks that share a close ancestor
in the document tree, are tied by smoothness edges. The minimum cut, found by a maximum flow,
is the labelling with the least total cost: a short paragraph between long ones stays, a long
notice between links goes.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
SKIPPED = frozenset(
    "script style noscript template head title svg iframe object select textarea button canvas".split()
)
#: Their content is not markup, and ends at their own end tag only.
RAW = frozenset("script style textarea title iframe noscript xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre"
    " section summary table tbody td tfoot th thead tr ul caption".split()
)
#: What an opening tag closes when it is still open.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
IN_HEAD = frozenset("base link meta noscript script style template title".split())
_SCOPE = frozenset("table td th button object".split())

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_UNPAIRED = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)")
_VALUE = re.compile(r"=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_HIDDEN = re.compile(r"(?:^|[\s/])hidden(?=[\s/]|$)", re.I)
_NO_DISPLAY = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: Parts of names (class, id, role) that speak against or for content; stated by hand.
PLAIN_NAMES = re.compile(
    r"(?<![a-z])(?:(?:with|without|has|no)[-_]?[a-z]+|(?:article|content|entry|main|post|story)[-_]*header|side[-_]by[-_]side"
    r"|[a-z]+[-_](?:fixed|sticky|enabled|disabled|open|opened|closed|collapsed|expanded|visible)(?![a-z]))",
    re.I,
)
BAD_NAMES = re.compile(
    r"(?<![a-z])(?:ads?|advert\w*|banner\w*|breadcrumbs?|comments?|commentlist|consent"
    r"|cookies?|copyright|disclaimer|discussion|disqus|footer|foot|footnav|gdpr|header|login|masthead|menu\w*|modal|nav\w*"
    r"|newsletter|notices?|notifications?|overlay|pagination|pager|popup|privacy|promo\w*|recommend\w*|related|replies"
    r"|reply|respond|responses?|search|share|sharing|sidebar\w*|side|signup|skip|social|sponsor\w*|subscribe"
    r"|subscription|tags|teaser|toast|toolbar|topbar|widgets?|alert|complementary|contentinfo|navigation)"
    r"(?![a-z])",
    re.I,
)
GOOD_NAMES = re.compile(
    r"(?<![a-z])(?:article\w*|body|content|entry|main|post|story|text)(?![a-z])", re.I
)
BAD_TAGS = {"nav": 9.0, "footer": 9.0, "aside": 8.0, "form": 9.0, "menu": 8.0, "dialog": 8.0, "header": 5.0}
CONTROLS = frozenset("input select textarea button".split())
GOOD_TAGS = {"article": 6.0, "main": 4.0}

# The classifier: weights of the log-odds that a block is content, stated by hand.
BIAS = -0.6
PER_LOG_LENGTH = 0.45
LINKS = -4.0
PARAGRAPH = 1.0
HEADING = 0.6
BAD_NAME = -8.0
GOOD_NAME = 2.0
# A mark against an element counts less the more of the page's text it holds: wholly up to this share, not at all if
# it holds everything. It does not count either if the page's heading or its main part is inside, and a form
# counts as one by its controls: so many characters to a control are text that a form was put around.
WHOLE_SHARE = 0.7
PER_CONTROL = 300
# Smoothness between neighbours in the page, and between blocks by their depth of common ancestor.
ADJACENT = 0.4
NEAR = 1.6
FAR_DECAY = 0.4


class Block(NamedTuple):
    text: str
    linked: int
    tag: str
    path: tuple[int, ...]
    marks: tuple[float, float]


class _Node(NamedTuple):
    tag: str
    number: int
    bad: float
    good: float
    skip: bool


class _Marked:
    """An element with a mark against it, and what is found inside."""

    def __init__(self, tag: str, bad: float):
        self.tag, self.bad = tag, bad
        self.chars = self.controls = 0
        self.main = False

    def weight(self, chars: int) -> float:
        """The mark, by the share of the page's ``chars`` characters."""
        if self.main or (self.tag == "form" and self.controls and self.chars > PER_CONTROL * self.controls):
            return 0.0
        share = self.chars / max(chars, 1)
        return self.bad * min(1.0, (1.0 - share) / (1.0 - WHOLE_SHARE))


def _names(attributes: str) -> str:
    found = []
    for m in _ATTRIBUTE.finditer(attributes):
        if m[1].lower() in ("class", "id", "role"):
            found.append(m[2] or m[3] or m[4] or "")
    return PLAIN_NAMES.sub(" ", re.sub(r"([a-z])([A-Z])", r"\1 \2", " ".join(found)))


def _hidden(attributes: str) -> bool:
    return bool(_HIDDEN.search(_VALUE.sub("=", attributes)) or _NO_DISPLAY.search(attributes))


def _hidden_control(attributes: str) -> bool:
    return any(m[1].lower() == "type" and (m[2] or m[3] or m[4] or "").lower() == "hidden" for m in _ATTRIBUTE.finditer(attributes))


def blocks(page: str) -> list[Block]:
    """The blocks of text of a page in page order. Unclosed and stray tags are put up with."""
    found: list[Block] = []
    held: list[list[_Marked]] = []  # of each block the marked elements around it
    marked: dict[int, _Marked] = {}
    stack: list[_Node] = []
    parts: list[str] = []
    linked = 0
    number = 0
    links = 0
    skipping = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                boxes = [n for n in stack if n.tag in BLOCK]
                around = [marked[n.number] for n in stack if n.number in marked]
                for element in around:
                    element.chars += len(text)
                good = max((n.good for n in stack), default=0.0)
                tag = boxes[-1].tag if boxes else ""
                found.append(Block(text, linked, tag, tuple(n.number for n in boxes), (0.0, good)))
                held.append(around)
            parts.clear()
        linked = 0

    def text_seen(raw: str) -> None:
        nonlocal linked
        if raw and not skipping:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if links:
                linked += len(text.strip())

    def pop_to(depth: int) -> None:
        nonlocal skipping, links
        while len(stack) > depth:
            node = stack[-1]
            if node.tag in BLOCK:
                flush()
            stack.pop()
            skipping -= node.skip
            links -= node.tag == "a"

    at = 0
    size = len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            text_seen(page[at:])
            break
        if lt > at:
            text_seen(page[at:lt])
        m = _TAG.match(page, lt) or _UNPAIRED.match(page, lt)
        if m is None:
            text_seen("<")
            at = lt + 1
            continue
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                text_seen(m[0][9:].removesuffix("]]>"))
            continue
        tag, attributes = m[2].lower(), m[3]
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag), None)
            if depth is not None:
                pop_to(depth)
            elif tag == "p":
                flush()
            continue
        if tag == "br":
            parts.append("\n")
            continue
        if stack and stack[-1].tag == "head" and tag not in IN_HEAD:
            pop_to(len(stack) - 1)
        if tag in BLOCK:
            if tag in CLOSES:
                ends, scope = CLOSES[tag]
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i].tag in scope:
                        break
                    if stack[i].tag in ends:
                        pop_to(i)
                        break
            else:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i].tag in _SCOPE:
                        break
                    if stack[i].tag == "p":
                        pop_to(i)
                        break
            flush()
        if tag in CONTROLS and not skipping and not _hidden_control(attributes):
            for node in stack:
                if node.number in marked:
                    marked[node.number].controls += 1
        elif tag in ("h1", "main"):
            for node in stack:
                if node.number in marked:
                    marked[node.number].main = True
        if tag in VOID:
            continue
        number += 1
        names = _names(attributes) if attributes.strip() else ""
        bad = -BAD_TAGS.get(tag, 0.0)
        if tag == "header" and any(n.tag in ("article", "main") for n in stack):
            bad = 0.0
        good = GOOD_TAGS.get(tag, 0.0)
        if names and tag not in ("body", "html"):
            if BAD_NAMES.search(names):
                bad = min(bad, BAD_NAME)
            elif GOOD_NAMES.search(names):
                good = max(good, GOOD_NAME)
        skip = tag in SKIPPED or bool(attributes and _hidden(attributes))
        if attributes.endswith("/") and tag not in BLOCK and tag not in RAW:
            continue
        stack.append(_Node(tag, number, bad, good, skip))
        if bad:
            marked[number] = _Marked(tag, bad)
        skipping += skip
        links += tag == "a"
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            if tag not in SKIPPED and close:
                text_seen(page[at : close.start()])
            at = close.start() if close else size
    pop_to(0)
    flush()
    chars = sum(len(b.text) for b in found)
    weights = {id(m): m.weight(chars) for m in marked.values()}
    return [
        b._replace(marks=(min((weights[id(m)] for m in around), default=0.0), b.marks[1]))
        for b, around in zip(found, held, strict=True)
    ]


def content_score(block: Block) -> float:
    """Log-odds of the classifier that a block is content."""
    length = len(block.text)
    bad, good = block.marks
    share = min(1.0, block.linked / length)
    score = BIAS + PER_LOG_LENGTH * math.log2(1 + length / 20) + LINKS * share * share
    if block.tag in ("p", "blockquote", "pre"):
        score += PARAGRAPH
    elif block.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        score += HEADING
    return score + (bad or good)


def _ties(found: list[Block]) -> Iterator[tuple[int, int, float]]:
    """Smoothness edges: by adjacency in the page, and to the last block before under the same parent
    and the same grandparent. There are at most three per block."""
    last: dict[tuple[int, ...], int] = {}
    for i, block in enumerate(found):
        if i:
            yield i - 1, i, ADJACENT
        for up in (1, 2):
            if len(block.path) > up:
                above = block.path[:-up]
                if above in last:
                    yield last[above], i, NEAR * FAR_DECAY ** (up - 1)
                last[above] = i


def minimum_cut(costs: list[tuple[float, float]], ties: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes lie on the source's side of a minimum cut.

    ``costs`` holds for each node the capacity from the source and to the sink, ``ties`` the
    capacities between nodes in both directions. The flow is raised level graph by level graph.
    Of several minimum cuts the one with the fewest nodes at the source is taken.
    """
    n = len(costs)
    source, sink = n, n + 1
    to: list[int] = []
    capacity: list[float] = []
    edges: list[list[int]] = [[] for _ in range(n + 2)]

    def add(a: int, b: int, forth: float, back: float) -> None:
        edges[a].append(len(to))
        to.append(b)
        capacity.append(forth)
        edges[b].append(len(to))
        to.append(a)
        capacity.append(back)

    for i, (content, other) in enumerate(costs):
        through = min(content, other)  # flows straight through the node
        if content > through:
            add(source, i, content - through, 0.0)
        elif other > through:
            add(i, sink, other - through, 0.0)
    for a, b, weight in ties:
        add(a, b, weight, weight)
    least = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in edges[a]:
                if capacity[e] > least and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        following = [0] * (n + 2)
        while True:
            path: list[int] = []
            a = source
            while a != sink:
                while following[a] < len(edges[a]):
                    e = edges[a][following[a]]
                    if capacity[e] > least and level[to[e]] == level[a] + 1:
                        break
                    following[a] += 1
                if following[a] < len(edges[a]):
                    path.append(edges[a][following[a]])
                    a = to[path[-1]]
                elif path:
                    a = to[path.pop() ^ 1]
                    following[a] += 1
                else:
                    break
            if a != sink:
                break
            flow = min(capacity[e] for e in path)
            for e in path:
                capacity[e] -= flow
                capacity[e ^ 1] += flow


def labels(found: list[Block]) -> list[bool]:
    """True for each block that is content."""
    scores = [content_score(b) for b in found]
    if len(found) == 1 and found[0].linked < len(found[0].text):
        return [True]  # a page of one block is its text, unless that is a link
    costs = [(max(s, 0.0), max(-s, 0.0)) for s in scores]
    return minimum_cut(costs, list(_ties(found)))


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    return "\n".join(b.text for b, kept in zip(found, labels(found), strict=True) if kept)


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of each page.

    Each page is worked on alone, so there is no shuffle. A null or empty page has an empty text,
    repeated rows are each answered, null ids and addresses are passed on, other columns are
    not read, and an empty table gives no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(page) for page in batch["html"]]
            yield pd.DataFrame(
                {
                    "page_id": batch["page_id"].astype("Int64"),
                    "url": batch["url"],
                    "text": texts,
                    "n_chars": [len(t) for t in texts],
                }
            )

    columns = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return columns.mapInPandas(run, "page_id bigint, url string, text string, n_chars bigint")
