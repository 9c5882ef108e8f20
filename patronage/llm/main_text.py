"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks of text; every character of it is passed a bounded number of times. Every block has two costs, for being content and for being
boilerplate: the log odds of a classifier over its text plus fixed odds for its place in the page (in an
article, in a menu, ...). Neighbouring blocks, and blocks that share a container, are joined by edges
whose weight grows with the part of their path in the page that they share; an edge is paid when its
ends get different labels. The cheapest labelling is a minimum cut between the two labels: costs are
the capacities of the terminal edges, weights those between blocks. Blocks whose own costs outweigh
all their edges are decided at once (exactly), a maximum flow decides the rest.

The classifier is a logistic regression over measurements of a block's text only, learned from blocks
whose place in the page leaves no doubt, on about `SAMPLE` pages taken by a hash, each with at
most `SAMPLE_BLOCKS` blocks spread over it. All pages are labelled whole.

Names (class, id) of comments, adverts, notices, sharing and the like put a container and all in it, articles too,
outside for good, unless it wraps the page (holds <main>, or the h1 and most of the text). Names of a layout (sidebar,
header, menu) are odds that an article inside, or prose, outweighs.

Null, empty and broken pages have the text that is found, possibly none; one row per input row.
"""

from __future__ import annotations

import re
from collections import deque
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from patronage.llm.text import hashed_sample

SAMPLE, SAMPLE_BLOCKS = 1000, 200
#: weight of an edge between blocks of one container; odds are cut to this size
SMOOTH, MOST_ODDS = 1.5, 4.0

# fixed values: names of HTML elements
_BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
# without markup inside: to the next end tag
_RAW = set("script style textarea title noscript iframe xmp".split())
# with markup inside: to their own end tag
_SKIPPED = set("template svg math object select button canvas audio video".split())
_SELF_CLOSED = set("svg math iframe".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_CLOSED_BY_SELF = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
_OUTSIDE = set("nav footer aside form fieldset menu dialog search".split())
# words of a class or id, fixed values: what is never the article, and parts of a layout that may hold it
_CLOSED_NAMES = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|comments?|cookies?|consent|disqus|login|modal|newsletter|notice|overlay|popup|promo\w*|"
    r"related|replies|respond|share|sharing|signup|social|sponsor\w*|subscribe)(?:$|[-_\s])",
    re.I,
)
_LAYOUT_NAMES = re.compile(
    r"(?:^|[-_\s])(?:banner|breadcrumbs?|footer|header|hidden|masthead|menu|nav|navbar|navigation|pager|pagination|"
    r"sidebar|toolbar|topbar|widget)(?:$|[-_\s])",
    re.I,
)
_OUTSIDE_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

_OPENS = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
_MARK = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|$)", re.I)

# what a page has or lacks, not what the container is
_FEATURES = re.compile(r"(?:^|(?<=\s))(?:has|no|with|without)-\S*", re.I)

IN_ARTICLE, OPEN, NAMED, OUTSIDE = 1, 0, -1, -2
#: odds of the place of a block; those of a layout's class or id can be outweighed by the classifier and edges
PLACE_ODDS = {IN_ARTICLE: 6.0, OPEN: -0.5, NAMED: -3.0, OUTSIDE: -40.0}


class Container:
    """An element with blocks inside; a tree of them replaces the path of every block."""

    __slots__ = ("parent", "depth", "tag", "kind", "main", "heading", "chars", "place", "article")

    def __init__(self, parent: Container | None, tag: str, kind: str) -> None:
        self.parent, self.tag, self.kind = parent, tag, kind
        self.depth = parent.depth + 1 if parent else 1
        self.main, self.heading, self.chars = tag == "main" or kind == "main", tag == "h1", 0  # inside, too
        self.place, self.article = OPEN, False


@dataclass
class Block:
    text: str
    place: int
    container: Container
    linked: int  # characters inside links
    heading: bool


def _kind(tag: str, attributes: str) -> str:
    """What tag and attributes say: outside, closed or layout (by a name), main, article, or nothing; a <header> adds its tag."""
    if tag in _OUTSIDE:
        return "outside"
    kind = ""
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return "outside"
        if name == "role" and value.lower() in _OUTSIDE_ROLES:
            return "outside"
        if name in ("class", "id") and tag not in ("body", "html"):
            value = _FEATURES.sub("", value)
            if _CLOSED_NAMES.search(value):
                kind = "closed"
            elif kind != "closed" and _LAYOUT_NAMES.search(value):
                kind = "layout"
    if kind or tag == "header":
        return kind + tag if tag == "header" else kind
    if tag == "main" or re.search(r"\brole\s*=\s*[\"']?main\b", attributes, re.I):
        return "main"
    return tag if tag == "article" else ""


def _settle(made: list[Container], blocks: list[Block]) -> None:
    """The place of every container and block, from the whole page."""
    for block in blocks:
        block.container.chars += len(block.text)
    for c in reversed(made):
        if c.parent:
            c.parent.chars += c.chars
            c.parent.main |= c.main
            c.parent.heading |= c.heading
    whole = made[0].chars
    for c in made[1:]:
        above, place = c.parent, c.parent.place
        kind = c.kind
        if kind.startswith("closed") and (c.main or (c.heading and 2 * c.chars > whole)):
            kind = c.tag if c.tag in ("main", "article") else ""  # the page's wrapper
        if place != OUTSIDE:
            if kind in ("outside", "closed", "closedheader") or (kind.endswith("header") and place != IN_ARTICLE):
                place = OUTSIDE
            elif kind.startswith("layout"):
                place = NAMED
            elif kind in ("main", "article"):
                # a page wrapper's name does not hold for its article, but that of an article's part does
                place = place if place == NAMED and above.article else IN_ARTICLE
        c.place, c.article = place, above.article or place == IN_ARTICLE
    for block in blocks:
        block.place = block.container.place


class _Tags:
    """The tags of a page one after the other; every character is passed a bounded number of times."""

    def __init__(self, html: str) -> None:
        self.html = html
        self.last = {mark: html.rfind(mark) for mark in (">", '"', "'")}

    def next(self, at: int) -> tuple[int, int, bool, str | None, str] | None:
        """Start, end, whether it closes, name (None for comments and declarations) and attributes."""
        html = self.html
        while m := _OPENS.search(html, at):
            at = m.end()
            if m[1]:
                end = html.find("-->", at)
                return m.start(), end + 3 if end >= 0 else len(html), False, None, ""
            if at > self.last[">"]:
                return None  # nothing ends a tag any more
            end = html.index(">", at) if m[2] else self._end(at)
            return m.start(), end + 1, bool(m[3]), None if m[2] else m[4].lower(), "" if m[2] else html[at:end]
        return None

    def _end(self, at: int) -> int:
        """The mark that ends a tag: outside quotes; of a tag with an open quote the first one."""
        place = at
        while m := _MARK.search(self.html, place):
            mark = m[0]
            if mark == ">":
                return m.start()
            if m.start() >= self.last[mark]:
                break
            place = self.html.index(mark, m.end()) + 1
        return self.html.index(">", at)


def _raw_end(html: str, tag: str, at: int) -> int:
    """Where the text of a raw element that opened before `at` ends. Without an end tag of its own the
    element is empty, but scripts and styles reach to the end of the page."""
    if tag in ("script", "style"):
        end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
        return end.end() if end else len(html)
    end = re.compile(rf"<(/?){tag}(?:\s[^>]*)?/?>", re.I).search(html, at)
    return end.end() if end and end[1] else at


def _skips(html: str) -> dict[int, int]:
    """For elements of `_SKIPPED` that have an end tag inside the container they open in: where their
    opening tag ends, and where their end tag does."""
    found: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    opened: dict[str, int] = {}
    at = 0
    tags = _Tags(html)
    while m := tags.next(at):
        _, at, closing, tag, attributes = m
        if tag is None:
            continue
        if tag in _RAW and not closing:
            if not (tag in _SELF_CLOSED and attributes.endswith("/")):
                at = _raw_end(html, tag, at)
        elif tag not in _SKIPPED and (tag not in _BLOCKS or tag in _VOID):
            continue
        elif not closing:
            if not (tag in _SELF_CLOSED and attributes.endswith("/")):
                stack.append((tag, at))
                opened[tag] = opened.get(tag, 0) + 1
        elif opened.get(tag):
            while True:
                last, start = stack.pop()
                opened[last] -= 1
                if last == tag:
                    break
            if tag in _SKIPPED:
                found[start] = at
    return found


_ANY_SKIPPED = re.compile(rf"<(?:{'|'.join(sorted(_SKIPPED))})\b", re.I)


def page_blocks(html: str) -> list[Block]:
    """The blocks of text of a page in page order."""
    out: list[Block] = []
    made = [Container(None, "", "")]
    stack = [made[0]]
    opened: dict[str, int] = {}
    parts: list[str] = []
    linked, link, at = 0, 0, 0
    skips = _skips(html) if _ANY_SKIPPED.search(html) else {}
    tags = _Tags(html)

    def finish() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                heading = any(c.tag in ("h1", "h2", "h3", "h4", "h5", "h6") for c in stack[-3:])
                out.append(Block(text, OPEN, stack[-1], min(linked, len(text)), heading))
            parts.clear()
        linked = 0

    def text(part: str) -> None:
        nonlocal linked
        if part:
            parts.append(part)
            if link:
                linked += len(part.strip())

    def close(down_to: int) -> None:
        while len(stack) > down_to:
            opened[stack.pop().tag] -= 1

    while True:
        m = tags.next(at)
        if m is None:
            text(html[at:])
            finish()
            _settle(made, out)
            return out
        text(html[at : m[0]])
        _, at, closing, tag, attributes = m
        if tag is None:
            continue
        if tag in _RAW and not closing:
            if not (tag in _SELF_CLOSED and attributes.endswith("/")):
                at = _raw_end(html, tag, at)
            parts.append(" ")
        elif tag in _SKIPPED:
            at = at if closing else skips.get(at, at)
            parts.append(" ")
        elif tag == "a":
            link = 0 if closing else 1
        elif tag == "br":
            parts.append(" ")
        elif tag not in _BLOCKS:
            continue
        elif closing:
            finish()
            if opened.get(tag):
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
        else:
            finish()
            link = 0
            while len(stack) > 1 and stack[-1].tag == "p":
                close(len(stack) - 1)
            if tag in _CLOSED_BY_SELF:
                same = ("td", "th") if tag in ("td", "th") else ("dt", "dd") if tag in ("dt", "dd") else (tag,)
                if any(opened.get(t) for t in same):
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k].tag in _CLOSED_BY_SELF[tag]:
                            break
                        if stack[k].tag in same:
                            close(k)
                            break
            if tag in _VOID:
                continue
            container = Container(stack[-1], tag, _kind(tag, attributes))
            made.append(container)
            stack.append(container)
            opened[tag] = opened.get(tag, 0) + 1


MEASURES = 8


def measure(blocks: list[Block]) -> np.ndarray:
    """Measurements of the blocks' texts alone."""
    out = np.zeros((len(blocks), MEASURES))
    for k, b in enumerate(blocks):
        t, words = b.text, b.text.count(" ") + 1
        marks = sum(t.count(c) for c in ".,;:!?")
        odd = sum(t.count(c) for c in "|©®™»«•·›/")
        out[k] = (
            min(np.log1p(words), 6), b.linked / len(t), min(marks / words, 1), t[-1] in ".!?…:”\"'", min(odd / words, 1),
            min(len(t) / words / 10, 2), sum(map(str.isdigit, t)) / len(t), b.heading,
        )
    return out


@dataclass
class Classifier:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # bias last

    def odds(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -5, 5) @ self.weights[:-1] + self.weights[-1]
        return np.clip(z, -MOST_ODDS, MOST_ODDS)


def fit(x: np.ndarray, y: np.ndarray) -> Classifier:
    """Logistic regression with a ridge, by Newton's method; both kinds weigh the same."""
    if not len(y) or y.min() == y.max():
        return Classifier(np.zeros(MEASURES), np.ones(MEASURES), np.zeros(MEASURES + 1))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    a = np.concatenate([np.clip((x - mean) / scale, -5, 5), np.ones((len(x), 1))], axis=1)
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w = np.zeros(a.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (weight * (p - y)) + 0.01 * w
        hessian = (a * (weight * p * (1 - p))[:, None]).T @ a + 0.01 * np.eye(len(w))
        w = w - np.linalg.solve(hessian, gradient)
    return Classifier(mean, scale, w)


def _shared(a: Container, b: Container) -> int:
    """Depth of the innermost container around both."""
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
    return a.depth


def _edges(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """Edges between neighbours and, over other blocks, between neighbours inside a container."""
    found: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}

    def weight(i: int, j: int) -> float:
        a, b = blocks[i].container, blocks[j].container
        return SMOOTH * _shared(a, b) / max(a.depth, b.depth)

    for j, block in enumerate(blocks):
        if j:
            found[j - 1, j] = weight(j - 1, j)
        around = block.container
        for _ in range(3):
            i = last.get(id(around))
            if i is not None and (i, j) not in found:
                found[i, j] = weight(i, j) / 2
            last[id(around)] = j
            if around.parent is None:
                break
            around = around.parent
    return [(i, j, round(1000 * w)) for (i, j), w in found.items() if w > 0]


def minimum_cut(gain: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """The labels that minimise the sum of -gain over true labels plus the weights of edges whose ends differ.

    Integers; of several cheapest labellings the one with the fewest true labels.
    """
    n = len(gain)
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for i, j, w in edges:
        near[i][j] = near[i].get(j, 0) + w
        near[j][i] = near[j].get(i, 0) + w
    gain, label = list(gain), [None] * n
    queue = deque(range(n))
    while queue:  # a block whose gain outweighs its edges has that label in every cheapest cut
        i = queue.popleft()
        if label[i] is not None:
            continue
        total = sum(near[i].values())
        if gain[i] > total or gain[i] <= -total:
            label[i] = gain[i] > total
            for j, w in near[i].items():
                gain[j] += w if label[i] else -w
                del near[j][i]
                queue.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        for i, true in zip(rest, _flow_cut(rest, gain, near)):
            label[i] = true
    return label


def _flow_cut(rest: list[int], gain: list[int], near: list[dict[int, int]]) -> list[bool]:
    """Maximum flow by shortest augmenting paths over level graphs; true is what the source still reaches."""
    source, sink = len(rest), len(rest) + 1
    number = {i: k for k, i in enumerate(rest)}
    left: list[dict[int, int]] = [{} for _ in range(len(rest) + 2)]
    for i in rest:
        k = number[i]
        for j, w in near[i].items():
            left[k][number[j]] = w
        if gain[i] > 0:
            left[source][k], left[k][source] = gain[i], 0
        elif gain[i] < 0:
            left[k][sink], left[sink][k] = -gain[i], 0
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            a = queue.popleft()
            for b, room in left[a].items():
                if room > 0 and b not in level:
                    level[b] = level[a] + 1
                    queue.append(b)
        if sink not in level:
            return [k in level for k in range(len(rest))]
        ways = {a: iter(left[a]) for a in level}
        path = [source]
        while path:
            a = path[-1]
            if a == sink:
                flow = min(left[x][y] for x, y in zip(path, path[1:]))
                for x, y in zip(path, path[1:]):
                    left[x][y] -= flow
                    left[y][x] = left[y].get(x, 0) + flow
                path, ways[source] = [source], iter(left[source])
                continue
            for b in ways[a]:
                if left[a][b] > 0 and level.get(b) == level[a] + 1:
                    path.append(b)
                    break
            else:
                path.pop()
                level[a] = -1


def label_blocks(blocks: list[Block], classifier: Classifier) -> list[bool]:
    odds = classifier.odds(measure(blocks))
    gain = [round(1000 * (o + PLACE_ODDS[b.place])) for o, b in zip(odds.tolist(), blocks)]
    return minimum_cut(gain, _edges(blocks))


def train(pages: DataFrame) -> Classifier:
    sample = hashed_sample(pages.where("html is not null").select("page_id", "url", "html"), SAMPLE, "page_id", "url")

    def encode(batches):
        for batch in batches:
            rows = []
            for html in batch.column(0).to_pylist():
                sure = [b for b in page_blocks(html) if b.place in (IN_ARTICLE, OUTSIDE)]
                sure = [sure[k] for k in sorted({*np.linspace(0, len(sure) - 1, min(len(sure), SAMPLE_BLOCKS)).astype(int).tolist()})]
                x = np.column_stack([measure(sure), [b.place == IN_ARTICLE for b in sure]]) if sure else np.zeros((0, MEASURES + 1))
                rows.append(np.ascontiguousarray(x, dtype=np.float64).tobytes())
            yield pa.RecordBatch.from_pydict({"x": pa.array(rows, pa.binary())})

    rows = sample.select("html").mapInArrow(encode, "x binary").collect()
    table = np.frombuffer(b"".join(sorted(bytes(r["x"]) for r in rows)), dtype=np.float64).reshape(-1, MEASURES + 1)
    return fit(table[:, :-1], table[:, -1])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: the content blocks joined by empty lines."""
    classifier = pages.sparkSession.sparkContext.broadcast(train(pages))

    def extract(batches):
        for batch in batches:
            texts = []
            for html in batch.column(2).to_pylist():
                blocks = page_blocks(html or "")
                texts.append("\n\n".join(b.text for b, true in zip(blocks, label_blocks(blocks, classifier.value)) if true))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    texts = pages.select("page_id", "url", "html").mapInArrow(extract, "page_id bigint, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))
