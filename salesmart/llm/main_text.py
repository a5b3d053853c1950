"""Main text of HTML pages by minimum-cut labelling (operator 10).

A page is cut into blocks: text between block-level tags, with its path of
open elements. Each block is a node; labelling it content or boilerplate has a
cost, and these costs are its capacities to the two terminals:

* the costs are minus the log probabilities of a logistic classifier over text
  features (length, link share, punctuation, words, capitals), trained on blocks whose
  elements tell (inside <article> or <main> against <nav>, <footer> ...) of a
  bounded sample of pages (``sample_pages``, by hash of the html);
* what the path says comes on top: the innermost telling element or, weaker than the classifier can be, class name.

Smoothness edges join neighbours in page order and the closest blocks with the
same parent element; their capacity grows with the share of the path in common.
The maximum flow (Dinic's algorithm) gives the cheapest labelling; the content
blocks are joined in page order.

A page is a row of its own, so pages spread over all tasks. Character
references are decoded, white space inside a block becomes one space, <br> too.
Null, empty or tagless html: no blocks, or one block of plain text. Unclosed,
misnested and cut-off tags are accepted. Only raw text (script, style, title, textarea) and comments are no text of
the page; buttons, selects, objects, svg, templates and frames are blocks like others. Repeated rows give repeated results.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import slices

SAMPLE_PAGES = 400
# Element and class names by what they hold.
BLOCK_TAGS = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead
    tr ul""".split())
VOID_TAGS = frozenset("hr br img input meta link area base col embed source track wbr".split())
CONTENT_TAGS = frozenset("article main".split())
OTHER_TAGS = frozenset("""nav footer aside header form menu dialog fieldset button select label object svg template
    iframe noscript""".split())
OTHER_NAMES = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo cookie cookies consent
    notice notices gdpr popup modal newsletter subscribe sidebar side menu nav navbar navigation breadcrumb breadcrumbs
    header footer masthead comment comments reply replies respond disqus social share sharing related recommended
    widget login signup""".split())
# Words that leave a name of the above what it is (site-footer, ad-slot); any other word makes it unknown (has-sidebar).
NAME_PARTS = OTHER_NAMES | frozenset("""area articles bar bottom bottombar box buttons container content form global group inner item items
    left links list main middle outer overlay panel posts primary right secondary section site slot stories top unit wrap wrapper""".split())
HEADING_NAMES = frozenset("header masthead section content".split())
NAMED = 1 / 3
# Inside text; blocks of their own, telling -1, where they are closed and hold text.
EMBEDDED_TAGS = frozenset("button select object svg template iframe noscript".split())
CLOSES_P = BLOCK_TAGS - {"html", "body"}

# Raw text runs to its end tag or the end of the page; a self-closed or longer name (<title-bar>) opens none.
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(script|style|title|textarea)(?=[\s/>])(?!/>)[^>]*(?<![\s\"']/)>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^<>]*(?:>|\Z)|[^<]+|<", re.S | re.I)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
_PARTS = re.compile(r"[-_\d]+")


class Block:
    __slots__ = ("text", "path", "linked", "tell")

    def __init__(self, text: str, path: tuple, linked: int, tell: float):
        self.text, self.path, self.linked, self.tell = text, path, linked, tell


def _names(attrs: str, inside: float) -> bool:
    """Whether a whole class, id or role is a name of what is no content; in content a header is its heading."""
    for m in _ATTRIBUTE.finditer(attrs):
        if m[1].lower() in ("class", "id", "role"):
            for name in m[2].strip("\"'").lower().split():
                parts = {x for x in _PARTS.split(name) if x}
                if parts <= NAME_PARTS and parts & OTHER_NAMES and not (inside > 0 and parts <= HEADING_NAMES):
                    return True
    return False


def _telling(tag: str, attrs: str, inside: float) -> float:
    """1 if an element holds content, -1 if it doesn't, -NAMED if just its name says so, 0 if it doesn't tell;
    ``inside``: what is around it."""
    if tag in CONTENT_TAGS:
        return 1
    if tag in ("html", "body") or tag == "header" and inside > 0:
        return 0  # the whole page; an article's own heading
    if tag in OTHER_TAGS:
        return -1
    return -NAMED if attrs and _names(attrs, inside) else 0


def _embedded(tokens: list[re.Match]) -> set[int]:
    """Which tokens open or close an embedded element that is closed within its parent and holds text."""
    out: set[int] = set()
    stack: list[tuple[str, int, int]] = []  # tag, token, texts before it
    texts = 0
    for i, m in enumerate(tokens):
        tag = m[3] and m[3].lower()
        if tag is None:
            texts += (m[0][0] != "<" or m[0] == "<") and not m[0].isspace()
        elif tag in VOID_TAGS or tag not in BLOCK_TAGS and tag not in EMBEDDED_TAGS or m[4].endswith("/"):
            continue
        elif not m[2]:
            stack.append((tag, i, texts))
        elif any(s[0] == tag for s in stack):
            while (last := stack.pop())[0] != tag:
                pass
            if tag in EMBEDDED_TAGS and texts > last[2]:
                out |= {last[1], i}
    return out


def blocks(html: str) -> list[Block]:
    """The page's blocks in order. A path is the open block elements, as (tag, number in the page)."""
    tokens = list(_TOKEN.finditer(html))
    embedded = _embedded(tokens)
    out: list[Block] = []
    stack: list[tuple[str, int, float]] = []  # tag, number, what it tells (inherited)
    held: list[str] = []
    link = linked = number = 0

    def close() -> None:
        nonlocal linked
        text = " ".join(html_lib.unescape("".join(held)).split())
        if text:
            out.append(Block(text, tuple(s[1] for s in stack), min(linked, len(text)), stack[-1][2] if stack else 0))
        held.clear()
        linked = 0

    for i, m in enumerate(tokens):
        tag = m[3]
        if tag is None:
            piece = m[0]
            if piece[0] != "<" or piece == "<":
                held.append(piece)
                if link:
                    linked += len(piece)
            continue
        tag = tag.lower()
        if tag == "a":
            link = 0 if m[2] else 1
        elif tag in ("br", "option"):
            held.append(" ")
        elif tag in BLOCK_TAGS or i in embedded:
            close()
            link = 0
            if m[2]:
                if any(s[0] == tag for s in stack):
                    while stack.pop()[0] != tag:
                        pass
            else:
                while stack and stack[-1][0] == "p" and tag in CLOSES_P:
                    stack.pop()
                if tag in ("li", "dt", "dd", "td", "th", "tr") and stack and stack[-1][0] == tag:
                    stack.pop()
                if tag not in VOID_TAGS and not m[4].endswith("/"):
                    number += 1
                    inside = stack[-1][2] if stack else 0
                    stack.append((tag, number, _telling(tag, m[4], inside) or inside))
    close()
    return out


def features(b: Block) -> list[float]:
    n, words = len(b.text), b.text.count(" ") + 1
    stops = sum(b.text.count(c) for c in ".!?")
    return [1.0, min(np.log1p(n) / 6, 2.0), b.linked / n, min(words / 40, 3.0), min(stops / 5, 3.0),
            float(b.text[-1] in ".!?:"), sum(map(str.isupper, b.text)) / n,
            sum(c in "|©·»/" for c in b.text) / n]


def fit(pages: list[str], ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Logistic weights from the blocks whose elements tell; without both labels, an even classifier."""
    told = [(features(b), b.tell > 0) for page in pages for b in blocks(page) if b.tell]
    w = np.zeros(8)
    if len({y for _, y in told}) < 2:
        return w
    x, y = np.array([f for f, _ in told]), np.array([y for _, y in told], float)
    n = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(8), x.T @ (n * (p - y)) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Flow:
    """Maximum flow by Dinic's algorithm; node 0 is the source, node 1 the sink."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[float] = []

    def edge(self, a: int, b: int, there: float, back: float = 0.0) -> None:
        self.out[a].append(len(self.to))
        self.out[b].append(len(self.to) + 1)
        self.to += (b, a)
        self.room += (there, back)

    def _levels(self) -> list[int]:
        level, queue = [-1] * len(self.out), deque([0])
        level[0] = 0
        while queue:
            v = queue.popleft()
            for e in self.out[v]:
                if self.room[e] > 1e-9 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[v] + 1
                    queue.append(self.to[e])
        return level

    def run(self) -> list[bool]:
        """Pushes all flow; returns which nodes are on the source's side of the minimum cut."""
        while (level := self._levels())[1] >= 0:
            at = [0] * len(self.out)
            path: list[int] = []
            v = 0
            while True:
                if v == 1:
                    least = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    k = next(i for i, e in enumerate(path) if self.room[e] <= 1e-9)
                    v = self.to[path[k] ^ 1]
                    del path[k:]
                elif at[v] < len(self.out[v]):
                    e = self.out[v][at[v]]
                    if self.room[e] > 1e-9 and level[self.to[e]] == level[v] + 1:
                        path.append(e)
                        v = self.to[e]
                    else:
                        at[v] += 1
                elif path:
                    v = self.to[path.pop() ^ 1]
                    at[v] += 1
                else:
                    break
        return [x >= 0 for x in level]


def label(found: list[Block], weights: np.ndarray, smooth: float = 0.7, told: float = 12.0, outside: float = 3.0) -> list[bool]:
    """Which blocks are content: the minimum cut between the source (content) and the sink."""
    if not found:
        return []
    odds = np.clip(np.array([features(b) for b in found]) @ weights, -6, 6)
    has_main = any(b.tell > 0 for b in found)
    flow = Flow(len(found) + 2)
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        says = told * b.tell if b.tell else (-outside if has_main else 0.0)
        content, other = np.logaddexp(0, -odds[i]), np.logaddexp(0, odds[i])  # costs of the two labels
        # Cutting the edge from the source labels the block boilerplate, which costs what content evidence it has.
        flow.edge(0, i + 2, float(other) + max(says, 0.0))
        flow.edge(i + 2, 1, float(content) + max(-says, 0.0))
        parent = b.path[-2] if len(b.path) > 1 else 0
        for j in {i - 1, last.get(parent, -1)} - {-1}:
            common = sum(x == y for x, y in zip(b.path, found[j].path, strict=False))
            flow.edge(i + 2, j + 2, *[smooth * (1 + common) / (1 + max(len(b.path), len(found[j].path)))] * 2)
        last[parent] = i
    return flow.run()[2:]


def main_text(html: str, weights: np.ndarray) -> str:
    found = blocks(html)
    return "\n".join(b.text for b, keep in zip(found, label(found, weights), strict=True) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    rows = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"),
                        F.coalesce(pages[html_col], F.lit("")).alias("html"))
    # A hash share of the pages that holds the sample a few times over, then its first by hash: the driver gets
    # ``sample_pages`` pages, and few are looked at to find them, whatever the table's size.
    fair = rows.where(F.length("html").between(1, 100_000))
    share = min(1.0, 8 * sample_pages / max(1, rows.select(F.lit(1)).count()))
    taught = fair.where(F.pmod(F.xxhash64("html"), F.lit(1 << 30)) < int(share * (1 << 30))).select("html").orderBy(
        F.xxhash64("html"), "html").limit(sample_pages)
    weights = fit([r["html"] for r in taught.collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = [main_text(h, weights) for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = dict(rows.dtypes)
    return rows.mapInArrow(run, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")
