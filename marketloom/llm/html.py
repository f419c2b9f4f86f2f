"""Main text of web pages: a tree-structured graphical model over the DOM, exact marginals by sum-product."""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, partial
from math import exp, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from marketloom.llm.html_labels import PAGES

# Element kinds of HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math xmp noembed noframes".split())
SILENT = RAW | {"head", "select", "option", "object", "canvas", "audio", "video", "map"}
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
ITEMS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S
)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_LABEL = re.compile(r"data-y=(\d)")
_WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
GOOD = frozenset("article content entry post story body main text page blog".split())
BAD = frozenset(
    "ad ads advert advertisement adverts sponsor sponsored promo promotion banner nav navigation navbar menu breadcrumb breadcrumbs footer foot header "
    "masthead sidebar side aside widget comment comments disqus reply replies respond review reviews discussion cookie cookies consent notice "
    "alert popup modal share sharing social related recommended newsletter subscribe subscription login signup form search pagination pager "
    "copyright legal toolbar logo skip outbrain taboola".split()
)
STRONG = frozenset("ad ads advert advertisement adverts comment comments disqus cookie consent sidebar footer nav menu sponsored newsletter promo related reviews notice".split())
GROUPS = {"article": 0, "main": 1, "section": 2, "div": 2, "p": 3, "pre": 3, "blockquote": 3, "h1": 4, "h2": 4, "h3": 4, "h4": 4, "h5": 4, "h6": 4, "ul": 5, "ol": 5, "li": 5, "dl": 5, "dt": 5, "dd": 5, "nav": 6, "menu": 6, "header": 7, "footer": 8, "aside": 9, "form": 10, "button": 10, "fieldset": 10, "dialog": 10, "table": 11, "tr": 11, "td": 11, "th": 11, "tbody": 11, "body": 12, "html": 12, "": 12, "#text": 13}
FEATURES = 15 + 9


@dataclass(slots=True)
class Node:
    tag: str  # "#text": a run of text inside one element, up to the next block
    parent: int
    names: str = ""
    label: int = 0
    silent: bool = False
    length: int = 0  # characters of text at or below
    linked: int = 0  # of those, inside links
    sentences: int = 0  # ends of sentences
    children: list[int] = field(default_factory=list)


def parse(page: str, label: int = 0) -> tuple[list[Node], list[tuple[int, str, bool]]]:
    """Block elements and runs of text in page order (0 is the page itself) and pieces of text: (run, raw text, starts a block).
    Inline elements don't become nodes. Missing end tags close where HTML closes them; a cut last tag is dropped."""
    nodes = [Node("", -1, label=label)]
    stack = [(0, "")]  # (node, tag); inline elements carry the node they are in
    pieces: list[tuple[int, str, bool]] = []
    links = 0
    fresh, at, size = True, 0, len(page)
    run = 0

    def text(s: str) -> None:
        nonlocal fresh, run
        node = stack[-1][0]
        n = len(s.strip())
        if nodes[node].silent or not (n or not fresh):
            return
        if fresh or nodes[run].parent != node:
            run = len(nodes)
            nodes[node].children.append(run)
            nodes.append(Node("#text", node, label=nodes[node].label))
        pieces.append((run, s, fresh))
        fresh = False
        nodes[run].length += n
        nodes[run].sentences += s.count(". ") + s.count("! ") + s.count("? ") + s.rstrip().endswith((".", "!", "?", "\u3002"))
        if links:
            nodes[run].linked += n

    def close(k: int) -> None:
        nonlocal links, fresh
        for _, tag in stack[k:]:
            links -= tag == "a"
            fresh |= tag not in INLINE
        del stack[k:]

    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None or (m[5] and page[at - 1 : at] != ">"):
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][1] == tag:
                    close(k)
                    break
                if tag in INLINE and stack[k][1] not in INLINE:
                    break
            else:
                fresh |= tag == "p"
            continue
        rest = m[3] if m[2] else m[6]
        if tag == "br":
            text(" ")
            continue
        if tag in VOID:
            fresh |= tag == "hr"
            continue
        if tag in INLINE:
            stack.append((stack[-1][0], tag))
            links += tag == "a"
            continue
        if tag in CLOSES_P or tag in ITEMS:
            peers, scope = ITEMS.get(tag, ({"p"}, frozenset()))
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][1] in peers:
                    close(k)
                    if tag in ITEMS:
                        break
                elif stack[k][1] in scope or (tag not in ITEMS and stack[k][1] not in INLINE):
                    break
        fresh = True
        parent = stack[-1][0]
        node = Node(tag, parent, silent=nodes[parent].silent or tag in SILENT, label=nodes[parent].label)
        if rest:
            node.names = " ".join(a or b or c for a, b, c in _NAMES.findall(rest))
            if y := _LABEL.search(rest):
                node.label = int(y[1])
        nodes[parent].children.append(len(nodes))
        nodes.append(node)
        if tag in RAW:
            if tag not in ("svg", "math"):  # their text isn't markup; it ends at the next end tag of the name
                end = re.compile("</" + tag, re.I).search(page, at)
                at = end.start() if end else size
        stack.append((len(nodes) - 1, tag))
    for node in reversed(nodes[1:]):
        nodes[node.parent].length += node.length
        nodes[node.parent].linked += node.linked
        nodes[node.parent].sentences += node.sentences
    return nodes, pieces


def features(node: Node, total: int) -> np.ndarray:
    x = np.zeros(FEATURES)
    x[GROUPS.get(node.tag, 14)] = 1
    words = {w.lower() for w in _WORDS.findall(node.names)} if node.names else ()
    x[15] = bool(words) and not GOOD.isdisjoint(words) and BAD.isdisjoint(words)
    x[16] = bool(words) and not BAD.isdisjoint(words)
    x[17] = bool(words) and not STRONG.isdisjoint(words)
    x[18] = log1p(node.length) / 6
    x[19] = node.linked / node.length if node.length else 0.0
    x[20] = node.length / total if total else 0.0
    x[21] = min(1.0, 40 * node.sentences / node.length) if node.length else 0.0
    x[22] = node.tag == "#text" and node.linked == node.length
    x[23] = 1.0
    return x


@dataclass
class Model:
    weights: np.ndarray  # log potential of "content" against "not" from an element's features
    link: tuple[np.ndarray, np.ndarray]  # 2 x 2 log potentials, parent's label by child's label, of elements and of runs of text

    def marginals(self, nodes: list[Node]) -> list[float]:
        """P(content) of every node: messages from the leaves up, then from the root down."""
        n, total = len(nodes), nodes[0].length
        unary = (np.array([features(x, total) for x in nodes]) @ self.weights).tolist()
        potentials = [[c for row in np.exp(m).tolist() for c in row] for m in self.link]
        kinds = [potentials[x.tag == "#text"] for x in nodes]
        up = [0.0] * n  # log odds a node's subtree gives its own label
        message = [0.0] * n  # log odds it sends its parent
        for i in range(n - 1, -1, -1):
            if nodes[i].silent:
                continue
            up[i] += unary[i]
            a00, a01, a10, a11 = kinds[i]
            odds = exp(max(-40.0, min(40.0, up[i])))
            message[i] = log((a10 + a11 * odds) / (a00 + a01 * odds))
            if i:
                up[nodes[i].parent] += message[i]
        belief = up[:]
        for i in range(1, n):
            p = nodes[i].parent
            a00, a01, a10, a11 = kinds[i]
            odds = exp(max(-40.0, min(40.0, belief[p] - message[i])))
            belief[i] += log((a01 + a11 * odds) / (a00 + a10 * odds))
        return [1 / (1 + exp(-max(-40.0, min(40.0, b)))) for b in belief]


@lru_cache(maxsize=1)
def trained(steps: int = 1500, rate: float = 0.05, ridge: float = 0.02) -> Model:
    """Maximum likelihood on the labelled pages: the gradient is what the labels show of each feature and pair of labels less what
    the model expects, by the same messages up and down, here for all pages at once and one level of the trees at a time."""
    xs, ys, parent, kind, depth = [], [], [], [], []
    for label, page in PAGES:
        nodes, _ = parse(page, label)
        at: dict[int, int] = {}
        for i, node in enumerate(nodes):
            if not node.silent:
                at[i] = len(ys)
                xs.append(features(node, nodes[0].length))
                ys.append(node.label)
                parent.append(at.get(node.parent, -1))
                kind.append(int(node.tag == "#text"))
                depth.append(depth[parent[-1]] + 1 if i else 0)
    x, y, parent, kind, depth = np.array(xs), np.array(ys), np.array(parent), np.array(kind), np.array(depth)
    levels = [np.flatnonzero(depth == d) for d in range(1, depth.max() + 1)]
    child = np.flatnonzero(parent >= 0)
    seen = np.zeros((2, 2, 2))
    np.add.at(seen, (kind[child], y[parent[child]], y[child]), 1)

    theta = np.zeros(FEATURES + 8)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        link = theta[FEATURES:].reshape(2, 2, 2)
        e = np.exp(link)[kind]  # per node: its parent's label by its own
        up, message = x @ theta[:FEATURES], np.zeros(len(y))
        for rows in reversed(levels):
            odds = np.exp(np.clip(up[rows], -40, 40))
            message[rows] = np.log((e[rows, 1, 0] + e[rows, 1, 1] * odds) / (e[rows, 0, 0] + e[rows, 0, 1] * odds))
            np.add.at(up, parent[rows], message[rows])
        belief, pairs = up.copy(), np.zeros((len(y), 2, 2))
        for rows in levels:
            above = np.exp(np.clip(belief[parent[rows]] - message[rows], -40, 40))
            own = np.exp(np.clip(up[rows], -40, 40))
            both = e[rows] * np.stack([np.ones_like(above), above], axis=1)[:, :, None] * np.stack([np.ones_like(own), own], axis=1)[:, None, :]
            pairs[rows] = both / both.sum(axis=(1, 2), keepdims=True)
            belief[rows] = np.log((both[:, 0, 1] + both[:, 1, 1]) / (both[:, 0, 0] + both[:, 1, 0]))
        expected = np.zeros((2, 2, 2))
        np.add.at(expected, kind[child], pairs[child])
        p = 1 / (1 + np.exp(-np.clip(belief, -40, 40)))
        slope = np.concatenate([x.T @ (y - p), (seen - expected).ravel()]) - ridge * theta
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta = theta + rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return Model(theta[:FEATURES], tuple(theta[FEATURES:].reshape(2, 2, 2)))


def extract(page: str | None, model: Model, level: float = 0.5) -> str:
    """Blocks of text of the runs whose marginal exceeds ``level``, white space made single."""
    if not page:
        return ""
    nodes, pieces = parse(page)
    p = model.marginals(nodes)
    blocks: list[str] = []
    held: list[str] = []
    for node, raw, starts in [*pieces, (0, "", True)]:
        if starts and held:
            if block := " ".join(_html.unescape("".join(held)).split()):
                blocks.append(block)
            held = []
        if p[node] > level:
            held.append(raw)
    return "\n\n".join(blocks)


def _run(batches: Iterator[pa.RecordBatch], model: Model, at: int, name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(x, model) for x in batch.column(at).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, name])


def main_text(pages: DataFrame, html_col: str = "html", column: str = "main_text") -> DataFrame:
    """All columns of ``pages`` and the main text ("" where there is none, also for null and empty pages).
    Rows are neither merged nor dropped."""
    run = partial(_run, model=trained(), at=pages.columns.index(html_col), name=column)
    return pages.mapInArrow(run, StructType([*pages.schema.fields, StructField(column, StringType())]))
