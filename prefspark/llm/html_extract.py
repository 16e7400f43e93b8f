"""Main text of web pages by message passing over the DOM tree (operator 2).

A page is a tree of block elements. Each has a hidden state, content or not; the model is

    P(states) ~ prod over parent-child pairs psi(parent, child | child's tag class)
                * prod over nodes phi(features | state)

Features are the words of class and id (or the tag, where there are none) and the link share of
the own text. Both potentials are smoothed frequencies counted by Spark over labelled pages, in which
``data-main="1"`` or ``"0"`` on an element labels it and what it contains (1 from the root). Sum-product messages
go up from the leaves and down from the root; a block is kept if its content marginal is at
least one half. Features fall into ``BUCKETS`` hashed cells, so the model that travels to the
workers has a fixed size whatever it was trained on.

Each page is read once, in place. Time is linear in the size of a page.
"""

from __future__ import annotations

import html
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefspark.llm.common import strings, text_of
from prefspark.llm.labelled_pages import labelled_pages

BUCKETS = 1 << 14
SMOOTH = 0.5
FAINT = 0.05
# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style template textarea title iframe select button".split())
FOREIGN = frozenset("math svg".split())  # what is in them is part of the line
INLINE = frozenset("audio canvas math noscript object svg video a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = frozenset("address article aside blockquote center details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
HOLDS = frozenset("ul ol dl table tbody thead tr body html article section main div nav aside footer header".split())
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
ATTR = re.compile(r"([a-zA-Z_:][-a-zA-Z0-9_:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
NAME = re.compile(r"[a-z]{2,}")
STOPS = re.compile(r"[.,;:!?\u3002\u3001](?:\s|$)")
#: Stands for class names the model has not seen; a name that labelled pages use for them.
UNSEEN = "zzunseen"


class Node:
    __slots__ = ("parent", "tag", "names", "label", "chars", "linked", "stops", "blocks")

    def __init__(self, parent: int, tag: str, names: list[str], label: int) -> None:
        self.parent, self.tag, self.names, self.label = parent, tag, names, label
        self.chars = self.linked = self.stops = 0
        self.blocks: list[int] = []


def parse(page: str) -> tuple[list[Node], list[list]]:
    """The block elements in page order and the text blocks ``[node, pieces]``."""
    nodes = [Node(-1, "#root", [], 1)]  # elements around the labelled ones may hold content
    blocks: list[list] = []
    stack = [("#root", 0)]  # open elements with their block node
    held: Counter = Counter()  # open elements by tag
    implied = -1  # node of text that stands in no element
    links = 0
    current: list | None = None
    at = 0

    def text(s: str) -> None:
        nonlocal current, implied
        if not s.strip():
            if current is not None and s:
                current[1].append(" ")
            return
        s = html.unescape(s)
        node = stack[-1][1]
        if not node:
            if implied < 0:
                nodes.append(Node(0, "#text", [], 1))
                implied = len(nodes) - 1
            node = implied
        if current is None or current[0] != node:
            current = [node, []]
            blocks.append(current)
            nodes[node].blocks.append(len(blocks) - 1)
        current[1].append(s)
        n = nodes[node]
        size = len(s)
        n.chars += size
        n.stops += len(STOPS.findall(s))
        if links:
            n.linked += size

    def leave(k: int) -> None:
        """Close the open elements from place ``k`` on."""
        nonlocal links
        for t, _ in stack[k:]:
            held[t] -= 1
            links -= t == "a"
        del stack[k:]

    while True:
        m = TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            return nodes, blocks
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:  # an end tag closes up to its element, if that is open
            if not held[tag]:
                if tag == "p":
                    current = None
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    leave(k)
                    if tag not in INLINE and not (held["math"] or held["svg"]):
                        current = None
                    break
                if tag in INLINE and stack[k][0] not in INLINE and not (held["math"] or held["svg"]):
                    break
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*(?:>|$)", re.I).search(page, at) if not m[3].endswith("/") else None
            if end is not None:
                at = end.end()
            elif not m[3].endswith("/") and tag in ("script", "style"):
                at = len(page)
            continue
        if tag in INLINE or tag in VOID or held["math"] or held["svg"]:
            if m[3].endswith("/") and tag not in VOID:
                continue
            if tag == "br":
                if current is not None:
                    current[1].append(" ")
            elif tag in VOID:
                if tag == "hr":
                    current = None
            else:
                stack.append((tag, stack[-1][1]))
                held[tag] += 1
                links += tag == "a"
            continue
        # A block element: close what it implies, then open it.
        closing = CLOSES.get(tag, set()) | ({"p"} if tag in ENDS_P else set())
        for k in range(len(stack) - 1, 0, -1):
            t = stack[k][0]
            if t in closing:
                leave(k)
                break
            if t in HOLDS and t not in closing:
                break
        current = None
        names, label = [], None
        if m[3]:
            if HIDDEN.search(m[3]):
                names.append("hidden")
            for a in ATTR.finditer(m[3]):
                key = a[1].lower()
                value = a[2] or a[3] or a[4] or ""
                if key in ("class", "id", "role", "itemprop", "aria-label"):
                    names += NAME.findall(value.lower())
                elif key == "data-main":
                    label = int(value == "1")
        parent = stack[-1][1]
        if label is None:
            label = nodes[parent].label
        nodes.append(Node(parent, tag, names, label))
        stack.append((tag, len(nodes) - 1))
        held[tag] += 1


def cell(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % BUCKETS


def features(n: Node, known: dict[int, float] | None = None) -> list[tuple[str, str]]:
    """(group, feature): a feature's frequency is taken among the elements of its group.

    Names and the share of the text in links. With ``known`` (a model's cells), names it has not seen count as ``UNSEEN``, once.
    """
    names = [f"name={x}" for x in dict.fromkeys(n.names)]
    if known is not None and names:
        names = [x for x in names if cell(x) in known] or [f"name={UNSEEN}"]
    out = [("any", x) for x in names] or [(f"tag={n.tag}", f"unnamed={n.tag}")]
    if n.chars:
        out.append((f"text={n.tag}", f"link={n.tag}/{4 * n.linked // n.chars}"))
    return out


def groups(n: Node) -> list[str]:
    return ["any", f"tag={n.tag}"] + ([f"text={n.tag}"] if n.chars else [])


def edge(parent: Node, child: Node) -> str:
    """The class of a parent-child pair that its potential depends on: tags, and whether the child is named."""
    return f"{parent.tag if parent.tag in HOLDS else '*'}>{child.tag}{'.' if child.names else ''}"


def train(labelled: DataFrame, html_col: str = "html") -> dict:
    """Potentials from labelled pages: log-ratios of features and 2x2 tables of pairs."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c: Counter = Counter()
        for b in batches:
            for page in b["html"]:
                nodes, _ = parse(page)
                for n in nodes[1:]:
                    for g in groups(n):
                        c["g", cell(g), 0, n.label] += 1
                    for g, f in features(n):
                        c["f", cell(f), cell(g), n.label] += 1
                    up = nodes[n.parent]
                    c["e", cell(edge(up, n)), up.label, n.label] += 1
        kind, *numbers = zip(*[(*k, v) for k, v in c.items()]) if c else [()] * 5
        yield pd.DataFrame({"kind": strings(kind), **{name: np.array(x, np.int64) for name, x in zip(("cell", "up", "y", "n"), numbers)}})

    rows = labelled.select(text_of(html_col).alias("html")).mapInPandas(count, "kind string, cell int, up int, y int, n bigint")
    got = {(r["kind"], r["cell"], r["up"], r["y"]): r["n"] for r in rows.groupBy("kind", "cell", "up", "y").agg(F.sum("n").alias("n")).collect()}  # a few rows per cell
    ratio = {}
    for c, g in {k[1:3] for k in got if k[0] == "f"}:
        p = [(got.get(("f", c, g, y), 0) + SMOOTH) / (got.get(("g", g, 0, y), 0) + 2 * SMOOTH) for y in (0, 1)]
        # What tells next to nothing counts as nothing: an article may have thousands of equal parts.
        ratio[c] = r if abs(r := math.log(p[1] / p[0])) >= FAINT else 0.0
    pairs = {}
    every = np.array([[sum(got.get(("e", c, u, y), 0) for c in {k[1] for k in got if k[0] == "e"}) + SMOOTH for y in (0, 1)] for u in (0, 1)])
    every = every / every.sum(axis=1, keepdims=True)
    for c in {k[1] for k in got if k[0] == "e"}:
        t = np.array([[got.get(("e", c, u, y), 0) for y in (0, 1)] for u in (0, 1)]) + 4 * SMOOTH * every
        pairs[c] = (t / t.sum(axis=1, keepdims=True)).tolist()
    return {"ratio": ratio, "pairs": pairs, "every": every.tolist()}


def marginals(nodes: list[Node], model: dict) -> list[float]:
    """Probability of content of every node, by one upward and one downward pass.

    Children follow their parents in ``nodes``. Messages are scaled to sum to 1.
    """
    n = len(nodes)
    ratio, pairs, every = model["ratio"], model["pairs"], model["every"]
    belief = []  # phi times the messages of the children
    psi = [every] * n
    for i, node in enumerate(nodes):
        r = sum(ratio.get(cell(f), 0.0) for _, f in features(node, ratio)) if i else 0.0
        r = max(-30.0, min(30.0, r))
        p = 1 / (1 + math.exp(-r))
        belief.append([1 - p, p] if i else [0.0, 1.0])
        if i:
            psi[i] = pairs.get(cell(edge(nodes[node.parent], node)), every)
    up = [(0.5, 0.5)] * n
    for i in range(n - 1, 0, -1):
        b, t = belief[i], psi[i]
        m0 = t[0][0] * b[0] + t[0][1] * b[1]
        m1 = t[1][0] * b[0] + t[1][1] * b[1]
        up[i] = (m0 / (m0 + m1), m1 / (m0 + m1))
        parent = belief[nodes[i].parent]
        parent[0] *= up[i][0]
        parent[1] *= up[i][1]
        s = parent[0] + parent[1]
        parent[0] /= s
        parent[1] /= s
    full = [belief[0]] + [None] * (n - 1)
    for i in range(1, n):
        f, u, t, b = full[nodes[i].parent], up[i], psi[i], belief[i]
        rest0, rest1 = f[0] / max(u[0], 1e-300), f[1] / max(u[1], 1e-300)  # without the child's own message
        d0 = (rest0 * t[0][0] + rest1 * t[1][0]) * b[0]
        d1 = (rest0 * t[0][1] + rest1 * t[1][1]) * b[1]
        s = d0 + d1
        full[i] = [d0 / s, d1 / s] if s > 0 else [0.5, 0.5]
    return [f[1] for f in full]


def main_text(page: str, model: dict) -> str:
    nodes, blocks = parse(page)
    p = marginals(nodes, model)
    out = []
    for node, pieces in blocks:
        # Text in no element at all counts only if it holds a sentence.
        if node and p[node] >= 0.5 and (nodes[node].tag != "#text" or nodes[node].stops):
            s = " ".join("".join(pieces).split())
            if s:
                out.append(s)
    return "\n\n".join(out)


def extract(pages: DataFrame, model: dict, html_col: str = "html") -> DataFrame:
    """``pages`` without its other columns changed, plus ``main_text``.

    A null or empty page has empty text. Text outside every element is that of an implied body.
    A block whose probability is one half is kept. Unclosed and stray tags are accepted. Repeated
    rows repeat their result.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([main_text(x, shared.value) for x in b], dtype=object)

    return pages.withColumn("main_text", F.pandas_udf(run, "string")(text_of(html_col)))


def fit(spark: SparkSession) -> dict:
    return train(labelled_pages(spark))


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    out = extract(pages, fit(spark))
    return out.select("page_id", "url", F.col("main_text").alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
