"""Main text of HTML pages by a tree-structured graphical model over DOM nodes.

Each element and each run of text is a node that is content or not. Nodes have potentials from what is seen of them (tag,
class and id words, links, length, punctuation), parent and child have joint ones; both are learned by counting on
labelled pages. Messages go up from the leaves and down from the root (sum-product, exact on a tree); a run of text is
kept if its marginal is over one half. Scripts, styles, comments and the head are never text. Time and memory are in
proportion to a page, whatever it holds.

Character references are decoded; white space inside a block becomes one blank, blocks are trimmed and joined by one
newline; nothing else is dropped or cut. Null and empty html give an empty text. Rows stand for themselves, repeated ones
too; page_id and url are passed on whatever they hold. Other columns don't matter; an empty table gives an empty one.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.llm.html_pages import labelled_pages

# Kinds of elements in HTML. What is neither below is inline, formulas and drawings too.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style head title iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frame frameset h1 h2 h3 h4 h5 h6 header hgroup hr html input legend li main menu nav ol optgroup option p pre search section "
    "select summary table tbody td textarea tfoot th thead tr ul".split()
)
#: An element that a start tag of one of these ends, if it is open within its list or table.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = ("ul", "ol", "dl", "table", "body", "html")

_OPEN = re.compile(r"<(?:(!--)|[!?]|(/?)([a-zA-Z][^\s/>]*))")
#: The end of a tag, or one attribute: name, then a value in quotes, a quote that is never closed, or a value without.
_ATTRIBUTE = re.compile(r"""[\s/]*(?:(>)|([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|(["'])|([^\s>]*)))?)""")
_LONG_NUMBER = re.compile(r"&#[0-9]{8,}")
_WORD = re.compile(r"[a-z]+")


@dataclass
class Node:
    tag: str
    parent: int
    words: tuple[str, ...] = ()
    label: str | None = None
    text: list[str] = field(default_factory=list)
    linked: int = 0


@dataclass
class _Open:
    """The open elements, and for each tag the depths at which it is open: nothing here depends on how many are."""

    nodes: list[Node]
    path: list[int] = field(default_factory=lambda: [0])
    depths: dict[str, list[int]] = field(default_factory=dict)

    def push(self, node: int) -> None:
        self.depths.setdefault(self.nodes[node].tag, []).append(len(self.path))
        self.path.append(node)

    def nearest(self, tags: tuple[str, ...]) -> int:
        """Depth of the innermost element with one of the tags; 0 if none is open."""
        return max((d[-1] for t in tags if (d := self.depths.get(t))), default=0)

    def close(self, depth: int) -> None:
        """Closes the element at that depth and all within; the root stays."""
        while len(self.path) > max(1, depth):
            self.depths[self.nodes[self.path.pop()].tag].pop()


def _attributes(page: str, at: int) -> tuple[int, list[tuple[str, str]]]:
    """Where the tag ends whose name ends at `at`, -1 if nowhere, and its attributes. Quotes may hold anything."""
    found = []
    while m := _ATTRIBUTE.match(page, at):
        at = m.end()
        if m.group(1):
            return at, found
        if m.group(5):
            return -1, found
        found.append((m.group(2), m.group(3) or m.group(4) or m.group(6) or ""))
    return -1, found


def parse(page: str) -> list[Node]:
    """Block elements and runs of text (tag #text) in page order, parents first. Inline elements join their block's text.

    One pass without going back: time is in proportion to the page. A tag or comment without an end reaches to the page's.
    """
    nodes = [Node("#root", -1)]
    stack = _Open(nodes)
    links, run = 0, -1
    at, size = 0, len(page)
    headless = False
    while at <= size:
        m = _OPEN.search(page, at)
        text = page[at : m.start() if m else size]
        if text:
            if run < 0 and not text.isspace():
                nodes.append(Node("#text", stack.path[-1]))
                run = len(nodes) - 1
            if run >= 0:
                decoded = entities.unescape(_LONG_NUMBER.sub("&#99999999", text)) if "&" in text else text
                nodes[run].text.append(decoded)
                if links:
                    nodes[run].linked += len(decoded.strip())
        if not m:
            break
        name = (m.group(3) or "").lower()
        if not name:
            mark = "-->" if m.group(1) else ">"
            # A comment may be <!--> too.
            end = page.find(mark, m.start() + 2)
            at = end + len(mark) if end >= 0 else size + 1
            continue
        closing = bool(m.group(2))
        at, attributes = _attributes(page, m.end())
        if at < 0:
            break
        if name in RAW:
            if not closing and page[at - 2] != "/" and not (name == "head" and headless):
                end = _ends(name).search(page, at)
                headless = headless or not end
                at = end.end() if end else (at if name == "head" else size)
            continue
        if name not in BLOCKS:
            if name == "br":
                if run >= 0:
                    nodes[run].text.append(" ")
            elif name == "a":
                links = max(0, links + (-1 if closing else 1))
            continue
        run = -1
        if closing:
            if depth := stack.nearest((name,)):
                stack.close(depth)
                links = 0
            continue
        if nodes[stack.path[-1]].tag == "p":
            stack.close(len(stack.path) - 1)
            links = 0
        ended = stack.nearest(ENDS.get(name, ()))
        if ended and ended > stack.nearest(SCOPE):
            stack.close(ended)
            links = 0
        words, label = [name], None
        for key, value in attributes:
            key = key.lower()
            if key == "data-y":
                label = value
            elif key in ("class", "id", "role"):
                words += ["." + w for w in _WORD.findall(value.lower())]
        if name not in VOID:
            nodes.append(Node(name, stack.path[-1], tuple(words), label))
            stack.push(len(nodes) - 1)
    return nodes


@cache
def _ends(name: str) -> re.Pattern:
    return re.compile(rf"</{name}\s*>" + (r"|(?=<body[\s>])" if name == "head" else ""), re.I)


def block(node: Node) -> str:
    return " ".join("".join(node.text).split())


#: Elements that may begin another part of a page. Fixed values.
CONTAINERS = frozenset("div section article main header footer nav aside form fieldset details dialog".split())
LISTS = frozenset("ul ol dl table".split())


def kind(node: Node) -> str:
    """Which joint potential holds between a node and its parent: text and plain blocks rarely differ from it."""
    return "#text" if node.tag == "#text" else "part" if node.tag in CONTAINERS else "list" if node.tag in LISTS else "block"


def features(node: Node) -> list[str]:
    if node.tag != "#text":
        return list(dict.fromkeys(node.words)) or [node.tag]
    text = block(node)
    linked = min(4, 5 * node.linked // max(1, len(text)))
    marks = sum(text.count(c) for c in ".,;:!?")
    return ["#text", f"link{linked}", f"long{min(6, len(text).bit_length() // 2)}", f"marks{min(3, marks)}"]


@dataclass
class Model:
    """Logarithms of odds by feature, and for each kind of child those of its label given its parent's."""

    odds: dict[str, float]
    pair: dict[str, tuple[float, float, float, float]]
    root: tuple[float, float]

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability that each node is content, by one upward and one downward pass."""
        n = len(nodes)
        own = [(0.0, sum(self.odds.get(f, 0.0) for f in features(v))) for v in nodes]
        own[0] = self.root
        pair = [self.pair[kind(v)] for v in nodes]
        up = [[a, b] for a, b in own]  # what a node and all below it say of its label
        sent = [(0.0, 0.0)] * n
        for k in range(n - 1, 0, -1):
            a, b = up[k]
            p00, p01, p10, p11 = pair[k]
            sent[k] = message = (_add(p00 + a, p01 + b), _add(p10 + a, p11 + b))
            above = up[nodes[k].parent]
            above[0] += message[0]
            above[1] += message[1]
        down = [(0.0, 0.0)] * n
        out = [0.0] * n
        for k in range(n):
            if k:
                parent = nodes[k].parent
                a = up[parent][0] - sent[k][0] + down[parent][0]
                b = up[parent][1] - sent[k][1] + down[parent][1]
                p00, p01, p10, p11 = pair[k]
                top = max(a, b)  # only differences matter, and sums stay small
                a, b = a - top, b - top
                down[k] = (_add(a + p00, b + p10), _add(a + p01, b + p11))
            d = up[k][1] + down[k][1] - up[k][0] - down[k][0]
            out[k] = 1 / (1 + math.exp(-d)) if d > -700 else 0.0
        return out


def _add(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


@cache
def learned() -> Model:
    """Counts on the labelled pages, each with a little added; then the odds climb the likelihood of the labels.

    The gradient of a feature's odds is the sum, over nodes with it, of label less marginal.
    """
    data = []
    seen, size = (Counter(), Counter()), [0, 0]
    pairs = Counter()
    for page in labelled_pages():
        nodes = parse(page)
        labels = []
        for v in nodes:
            labels.append(int(v.label) if v.label is not None else labels[v.parent] if labels else 0)
        data.append((nodes, labels))
        for v, y in zip(nodes[1:], labels[1:], strict=True):
            size[y] += 1
            seen[y].update(features(v))
            pairs[kind(v), labels[v.parent], y] += 1
    few = 0.3
    odds = {f: math.log((seen[1][f] + few) / (size[1] + few)) - math.log((seen[0][f] + few) / (size[0] + few)) for f in seen[0] | seen[1]}
    pair = {
        k: tuple(math.log((pairs[k, a, b] + few) / (pairs[k, a, 0] + pairs[k, a, 1] + 2 * few)) for a in (0, 1) for b in (0, 1))
        for k in ("#text", "block", "list", "part")
    }
    model = Model(odds, pair, (0.0, -2.0))
    for _ in range(50):
        slope: Counter = Counter()
        for nodes, labels in data:
            for v, y, p in zip(nodes[1:], labels[1:], model.marginals(nodes)[1:], strict=True):
                for f in features(v):
                    slope[f] += y - p
        for f, d in slope.items():
            odds[f] += max(-0.5, min(0.5, 0.5 * d))
    return model


def main_text(page: str | None, model: Model) -> str:
    if not page:
        return ""
    nodes = parse(page)
    sure = model.marginals(nodes)
    return "\n".join(b for v, p in zip(nodes, sure, strict=True) if v.tag == "#text" and p > 0.5 and (b := block(v)))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    model = learned()  # a few hundred numbers, sent along with the task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(t, model) for t in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
