"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text. A classifier gives each block the cost of calling it content or boilerplate; these are the
capacities to the two terminals of a graph whose other edges join neighbouring blocks, the heavier the closer they are in the
tree, and each block to the next one of the same parent, whatever stands between. The minimum cut, found by blocking flows over
breadth-first levels, is the labelling of least cost.

The classifier is a logistic model on the shape of a block (length, links, punctuation, stop signs, its place), fitted on a bounded sample of
pages (``SAMPLE_PAGES``) whose markup names the role of their blocks, plus fixed costs for what tags and their
names say. Where a tag leaves no doubt (scripts, menus and the like) the cost is beyond any cut. A form, and an element whose name tells of
something other than comments, counts as boilerplate only while it holds less than half of the page's text: larger ones wrap the page.

Defined results: a NULL or blank page has an empty text; markup that never closes ends with the page; an unclosed paragraph ends where the
next block starts; line breaks are white space within a block; repeated rows are extracted alike; an empty table gives an empty one.
Columns named like an added one are replaced.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfscout.llm.common import named, others, shared

SAMPLE_PAGES = 1000
ADDED = ("text", "n_chars")

# Names of the markup language by role.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math canvas object select button audio video".split())
NEVER = frozenset("nav footer aside menu dialog address".split())
FORMS = frozenset("form fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCKS - {"body", "html"}
# Words in class, id or role that tell what a block is.
BAD_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|banner\w*|breadcrumb\w*|comment\w*|contentinfo|cookie\w*|consent\w*|disqus\w*|dialog|footer\w*|form|header|"
    r"login|masthead|menu\w*|modal|nav\w*|newsletter|notice\w*|notification\w*|alert\w*|pagination|pager|popup\w*|promo\w*|recommend\w*|related|repl(?:y|ies)|"
    r"search|share|sharing|sidebar\w*|side|skip\w*|social\w*|sponsor\w*|subscribe|subscription|tags|toolbar|top-?bar|widget\w*)(?=$|[\s_-])",
    re.I,
)
COMMENT_NAMES = re.compile(r"(?:^|\s)(?:comments?(?:[_-]\w+)*|disqus\w*|repl(?:y|ies))(?=$|\s)", re.I)
# A name that only says what else stands on the page.
ABOUT_OTHERS = re.compile(r"(?:^|(?<=\s))(?:with|without|no|has|is|not)[_-]\S*", re.I)
GOOD_NAMES = re.compile(r"(?:^|[\s_-])(?:article\w*|body|content|entry|main|page|post|story|text)(?=$|[\s_-])", re.I)

SURE, TOLD = 50.0, 3.0
NEAR, FAR, ACROSS = 1.2, 0.25, 0.6
FEATURES = 8

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|([^<]+|<)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'=<>/]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s\"'>]+)))?|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)")
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
_SPACE = re.compile(r"\s+")
_STOPS = re.compile(r"[.,;:!?]")
_CLOSE = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)|\Z", re.I) for name in RAW}


class Block:
    __slots__ = ("text", "home", "linked", "cost", "heading")

    def __init__(self, text: str, home: int, linked: int, heading: bool):
        # The place of the block element it stands in, -1 outside of all.
        self.text, self.home, self.linked, self.heading = text, home, linked, heading
        self.cost = 0.0


class Element:
    __slots__ = ("name", "parent", "sure", "wide", "size", "block", "inside", "heading")

    def __init__(self, name: str, parent: int, above: Element | None):
        self.name, self.parent, self.size = name, parent, 0
        # What it says about all in it, and what it says unless it holds half of the page.
        self.sure = self.wide = 0.0
        self.block = name in BLOCKS
        self.inside = bool(above and above.inside)
        self.heading = name in HEADINGS or bool(above and above.heading)


class Page:
    """Blocks in page order with what the markup around them says (positive cost: boilerplate), and the tree of block elements."""

    def __init__(self, blocks: list[Block], up: list[int], depth: list[int]):
        self.blocks, self.up, self.depth = blocks, up, depth

    def steps(self, a: int, b: int) -> int:
        """Steps in the tree from one element to the other."""
        up, depth, n = self.up, lambda e: self.depth[e] if e >= 0 else 0, 0
        while a != b:
            if depth(a) >= depth(b):
                a = up[a]
            else:
                b = up[b]
            n += 1
        return n

    def edges(self) -> list[tuple[int, int, float]]:
        out, last = [], {}
        for i, block in enumerate(self.blocks):
            parent = self.up[block.home] if block.home >= 0 else -1
            if i:
                out.append((i - 1, i, NEAR / max(1, self.steps(self.blocks[i - 1].home, block.home) - 1) + FAR))
                if last.get(parent, i - 1) < i - 1:
                    out.append((last[parent], i, ACROSS))
            last[parent] = i
        return out


def attributes(inner: str) -> dict[str, str]:
    """Attributes by lower-case name; the first of a name counts."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(inner):
        if name:
            out.setdefault(name.lower(), next(filter(None, values), ""))
    return out


def _told(element: Element, inner: str) -> None:
    """Sets what the tag says about its content."""
    name = element.name
    told = attributes(inner) if inner.strip(" /") else {}
    if name in NEVER or "hidden" in told or told.get("aria-hidden", "").lower() == "true" or _UNSEEN.search(told.get("style", "")):
        element.sure += SURE
    elif name == "header" and not element.inside:
        element.sure += SURE
    elif name in FORMS:
        element.wide += SURE
    if name in ("article", "main"):
        element.sure, element.inside = element.sure - TOLD, True
    label = " ".join(filter(None, (told.get(x) for x in ("class", "id", "role"))))
    if not label or name in ("body", "html", "article", "main"):
        return
    label = ABOUT_OTHERS.sub("", label)
    said = BAD_NAMES.search(label)
    # The header of an article is part of it.
    if COMMENT_NAMES.search(label):
        element.sure += 4 * TOLD
    elif said and not (element.inside and said.group().strip(" _-").lower() == "header"):
        element.wide += 4 * TOLD
    elif GOOD_NAMES.search(label):
        element.sure -= TOLD


def parsed(page: str | None) -> Page:
    page = page or ""
    out: list[Block] = []
    elements: list[Element] = []
    # Where each block stands, open elements, how many of each name are open.
    places: list[int] = []
    stack: list[int] = []
    opened: Counter[str] = Counter()
    words: list[str] = []
    linked, at = 0, 0

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", "".join(words)).strip()
        if text:
            top = stack[-1] if stack else -1
            places.append(top)
            out.append(Block(text, -1, min(linked, len(text)), top >= 0 and elements[top].heading))
            if top >= 0:
                elements[top].size += len(text)
        words.clear()
        linked = 0

    def close(depth: int) -> None:
        for e in stack[depth:]:
            opened[elements[e].name] -= 1
        del stack[depth:]

    while (found := _TOKEN.match(page, at)) is not None and at < len(page):
        at = found.end()
        closing, name, inner, plain = found.groups()
        if plain is not None:
            text = references.unescape(plain)
            words.append(text)
            if opened["a"]:
                linked += len(text)
            continue
        if name is None:
            if found.group().startswith("<![CDATA["):
                words.append(found.group()[9:-3])
            continue
        name = name.lower()
        if name == "head":
            # All that can stand in a head is raw or void; anything else ends it, closed or not.
            continue
        if closing:
            if name in BLOCKS:
                flush()
            if opened[name]:
                depth = len(stack) - 1
                while elements[stack[depth]].name != name and (name in BLOCKS or not elements[stack[depth]].block):
                    depth -= 1
                if elements[stack[depth]].name == name:
                    close(depth)
            continue
        if name in RAW:
            if not inner.rstrip().endswith("/"):
                at = _CLOSE[name].search(page, at).end()
            continue
        if name == "br" or name == "wbr":
            words.append(" " if name == "br" else "")
            continue
        if name in BLOCKS:
            flush()
            if name in CLOSES_P:
                # A new block ends an open paragraph or item of the same list, with what was left open in it.
                same = {"p"} | ({name} if name in ("li", "td", "th", "tr", "dd", "dt", "option") else set())
                limit = len(stack) - 1
                while limit >= 0 and not elements[stack[limit]].block:
                    limit -= 1
                if limit >= 0 and elements[stack[limit]].name in same:
                    close(limit)
        if name in VOID or inner.rstrip().endswith("/"):
            continue
        parent = stack[-1] if stack else -1
        element = Element(name, parent, elements[parent] if parent >= 0 else None)
        _told(element, inner)
        opened[name] += 1
        stack.append(len(elements))
        elements.append(element)
    flush()
    # An element stands before all in it.
    total = sum(len(b.text) for b in out)
    for element in reversed(elements):
        if element.parent >= 0:
            elements[element.parent].size += element.size
    costs: list[float] = []
    up, depth, home = [], [], []
    for element in elements:
        wide = 0.0 if 2 * element.size >= total else element.wide
        costs.append((costs[element.parent] if element.parent >= 0 else 0.0) + element.sure + wide)
        above = home[element.parent] if element.parent >= 0 else -1
        if element.block:
            up.append(above)
            depth.append(depth[above] + 1 if above >= 0 else 1)
            above = len(up) - 1
        home.append(above)
    for block, place in zip(out, places):
        if place >= 0:
            block.cost, block.home = costs[place], home[place]
    return Page(out, up, depth)


def blocks_of(page: str | None) -> list[Block]:
    return parsed(page).blocks


def features(blocks: list[Block]) -> np.ndarray:
    rows = []
    for i, b in enumerate(blocks):
        size = len(b.text)
        words = b.text.count(" ") + 1
        rows.append(
            (1.0, math.log1p(words) / 5, b.linked / size, len(_STOPS.findall(b.text)) / words, size / words / 10,
             b.text[-1] in ".!?…", b.heading, i / len(blocks))
        )
    return np.array(rows, float).reshape(len(rows), FEATURES)


def fit_blocks(pages: list[str], steps: int = 300, rate: float = 0.5) -> np.ndarray:
    """Logistic weights for content, from blocks whose markup tells their role."""
    x, y = [], []
    for page in pages:
        blocks = blocks_of(page)
        told = [i for i, b in enumerate(blocks) if abs(b.cost) >= TOLD]
        x.append(features(blocks)[told])
        y += [blocks[i].cost < 0 for i in told]
    rows = np.concatenate([np.empty((0, FEATURES)), *x])
    truth = np.array(y, float)
    weights = np.zeros(FEATURES)
    if len(rows) and 0 < truth.sum() < len(truth):
        # Both classes weigh the same.
        share = np.where(truth > 0, 0.5 / truth.sum(), 0.5 / (len(truth) - truth.sum()))
        for _ in range(steps):
            guess = 1 / (1 + np.exp(-rows @ weights))
            weights -= rate * 10 * (rows.T @ (share * (guess - truth)) + 1e-3 * weights / 10)
    return weights


def least_cut(content: list[float], boilerplate: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: content) of least cost: ``content[i]`` is what it costs to call block i content."""
    n = len(content)
    # What a block takes from both terminals alike flows at once; the rest is left at one of them.
    left = [b - c for b, c in zip(boilerplate, content)]
    room: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, c in edges:
        room[i][j] = room[i].get(j, 0.0) + c
        room[j][i] = room[j].get(i, 0.0) + c
    tiny = 1e-9
    while True:
        # Levels by breadth from all blocks with flow left from the source.
        level = [-1] * n
        queue = [i for i in range(n) if left[i] > tiny]
        sources = list(queue)
        for i in queue:
            level[i] = 0
        ends = False
        for i in queue:
            ends = ends or left[i] < -tiny
            for j, c in room[i].items():
                if c > tiny and level[j] < 0:
                    level[j] = level[i] + 1
                    queue.append(j)
        if not ends:
            # What the source still reaches is content.
            return [x >= 0 for x in level]
        # A blocking flow: each edge is looked at once, unless flow goes through it.
        nexts = [list(r) for r in room]
        for source in sources:
            path = [source]
            while path and left[source] > tiny:
                i = path[-1]
                if left[i] < -tiny:
                    flow = min([left[source], -left[i], *(room[a][b] for a, b in zip(path, path[1:]))])
                    left[source] -= flow
                    left[i] += flow
                    for a, b in zip(path, path[1:]):
                        room[a][b] -= flow
                        room[b][a] += flow
                    # Back to where the path is full.
                    full = next((k for k, (a, b) in enumerate(zip(path, path[1:])) if room[a][b] <= tiny), len(path) - 1)
                    del path[full + 1 :]
                    continue
                while nexts[i] and not (level[nexts[i][-1]] == level[i] + 1 and room[i][nexts[i][-1]] > tiny):
                    nexts[i].pop()
                if nexts[i]:
                    path.append(nexts[i][-1])
                else:
                    path.pop()
                    if path:
                        nexts[path[-1]].pop()


def main_text(page: str | None, weights: np.ndarray) -> str:
    whole = parsed(page)
    blocks = whole.blocks
    if not blocks:
        return ""
    odds = np.clip(features(blocks) @ weights, -6, 6)
    costs = [b.cost - float(o) for b, o in zip(blocks, odds)]
    labels = least_cut([max(c, 0.0) for c in costs], [max(-c, 0.0) for c in costs], whole.edges())
    return "\n".join(b.text for b, kept in zip(blocks, labels) if kept)


def classifier(pages: DataFrame, html: str = "html", sample: int = SAMPLE_PAGES) -> np.ndarray:
    """Weights fitted on about ``sample`` pages picked by hash; repeats of a page are picked one by one."""
    total = pages.count()
    share = min(1.0, sample / total) if total else 1.0
    row = F.xxhash64(*[named(f.name) for f in pages.schema.fields if isinstance(f.dataType, T.AtomicType)])
    picked = pages.where(F.pmod(row, F.lit(1 << 53)) < F.lit(int(share * (1 << 53)))).select(named(html).alias("html"), row.alias("row"))

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts = [t for batch in batches for t in batch["html"] if t]
        weights = fit_blocks(texts)
        if texts and weights.any():
            yield pd.DataFrame({"n": [len(texts)], "weights": [weights]})

    # Every task fits its share of the sample; the mean by pages is the model.
    parts = picked.repartition(4, "row").select("html").mapInPandas(fitted, "n long, weights array<double>").collect()
    if not parts:
        return np.zeros(FEATURES)
    sizes = np.array([p["n"] for p in parts], float)
    return np.average(np.array([p["weights"] for p in parts]), axis=0, weights=sizes)


def extract(spark: SparkSession, pages: DataFrame, html: str = "html", weights: np.ndarray | None = None) -> DataFrame:
    """Add ``text`` and ``n_chars`` to every page."""
    model = shared(spark, classifier(pages, html) if weights is None else weights)
    read = F.pandas_udf(lambda column: pd.Series([main_text(t, model()) for t in column], dtype=object), T.StringType())
    body: Column = read(named(html))
    done = pages.select(*others(pages, ADDED), body.alias("text"))
    return done.withColumn("n_chars", F.char_length("text").cast("long"))
