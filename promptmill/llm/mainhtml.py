"""Main text of web pages: boosted trees score the nodes of the DOM, and a tree decoding picks the kept ones.

A page is parsed to block elements and units, runs of inline text between block boundaries.  Each node has features of
its subtree (text, links, density, punctuation, share of the page), of its attributes (tokens of class, id, role and
the like, in groups) and tag, its own and its ancestors', of depth, place and siblings.  Gradient-boosted trees with
logistic loss give each node the log-odds of holding main text.  Decoding keeps the set of nodes with the largest total
that never keeps a node whose ancestor is dropped, nor an element without a kept unit below; features and decoding run for a batch
of pages at once, level by level.

The trees are trained on ``TRAINING_PAGES`` generated pages (``training_pages``): articles in many layouts with menus,
headers, footers, sidebars, notices, adverts, forms and reader comments, since the tables hold no labels for pages.

A unit's character references are decoded, white space becomes one space, units are joined by a line feed.
Contents of script, style, title and textarea never are text, nor are those of svg, noscript, select and the like where the element is
closed; one that closes itself or is never closed hides nothing.

Defined results: null and blank html give the empty text; markup that breaks off counts as far as it goes, and a "<"
that opens no tag is text; pages of any length are read whole; repeated rows stay; other columns are not read; an empty table gives an empty
result.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.llm.common import arrow_schema, slices, texts

TRAINING_PAGES, TREES, DEPTH, BINS = 500, 60, 4, 32

_OPEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)|<[!?][^>]*(?:>|\Z)", re.S)
_REST = re.compile(r"""((?:[^>"']|"[^"]*"|'[^']*'|["'])*+)>""")
_PLAIN_REST = re.compile(r"([^<>]*)>")
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|itemprop|aria-label|data-[\w-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# raw text up to the end tag, however it looks
RAW = {"script", "style", "title", "textarea"}
# elements whose contents are not shown; the first three cannot hold one of their own kind
UNSEEN = ["noscript", "iframe", "select", "template", "svg", "canvas", "object"]
_UNSEEN_TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<({'|'.join(sorted(RAW))})\b.*?(?:</\1\s*>|\Z)|<(/?)({'|'.join(UNSEEN)})\b([^<>]*)>", re.S | re.I)
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# Kinds of nodes by tag; tags in no kind are inline and make no node of their own.
TAGS = [{"#text"}, {"p", "blockquote", "pre"}, {"h1"}, {"h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "dl", "menu"}, {"li", "dt", "dd"},
        {"table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"div", "section", "center", "body", "html", "main-part"}, {"article", "main"},
        {"nav"}, {"header", "hgroup"}, {"footer"}, {"aside"}, {"form", "fieldset", "dialog", "label", "button"}, {"figure", "figcaption", "details", "summary", "address", "head"}]
# Groups of attribute tokens.
TOKENS = [{"article", "content", "main", "post", "entry", "body", "story", "text", "page"}, {"nav", "navigation", "menu", "navbar", "breadcrumb", "breadcrumbs", "toc", "tabs"},
          {"header", "masthead", "top", "logo", "branding"}, {"footer", "bottom", "copyright", "colophon", "legal"},
          {"sidebar", "aside", "side", "widget", "related", "rail", "complementary", "recommended", "popular"},
          {"notice", "cookie", "cookies", "consent", "alert", "banner", "gdpr", "popup", "modal", "overlay", "warning"},
          {"ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion", "adsense", "commercial"},
          {"form", "search", "subscribe", "newsletter", "signup", "login", "contact"},
          {"comment", "comments", "reply", "replies", "respond", "disqus", "discussion", "reader", "readers", "feedback"},
          {"share", "social", "sharing", "follow", "tags", "meta", "byline", "author", "pagination", "pager"}]
KIND = {t: k for k, tags in enumerate(TAGS) for t in tags}
GROUP = {t: len(TAGS) + k for k, group in enumerate(TOKENS) for t in group}
BITS = len(TAGS) + len(TOKENS)
# An item ends an open one of its kind, if no list or table (row) stands between.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}}
_HOLDS = {"ul", "ol", "menu", "dl", "table"}


@lru_cache(100_000)
def _short_token_bits(value: str) -> int:
    return _token_bits(value)


def _token_bits(value: str) -> int:
    return sum({1 << GROUP[t.lower()] for t in _TOKEN.findall(value) if t.lower() in GROUP})


def _attribute_bits(source: str) -> int:
    bits = 0
    for _, value in _ATTRIBUTE.findall(source):
        bits |= _short_token_bits(value) if len(value) < 200 else _token_bits(value)
    return bits


def hidden_spans(source: str) -> dict[int, int]:
    """Where each closed unseen element starts and ends."""
    spans, open_ = {}, {name: [] for name in UNSEEN}
    for m in _UNSEEN_TAG.finditer(source):
        name = (m[3] or "").lower()
        if not name:
            continue
        if m[2]:
            if open_[name]:
                spans[open_[name].pop()] = m.end()
        elif not m[4].endswith("/"):
            if name in UNSEEN[:3]:
                open_[name].clear()
            open_[name].append(m.start())
    return spans


class Nodes:
    """The nodes of some pages in order; a parent stands before its children."""

    def __init__(self):
        self.page, self.parent, self.mask, self.text, self.link = [], [], [], [], []
        self.pages = 0

    def _node(self, parent: int, mask: int, text: str | None = None, link: int = 0) -> int:
        self.page.append(self.pages)
        self.parent.append(parent)
        self.mask.append(mask)
        self.text.append(text)
        self.link.append(link)
        return len(self.page) - 1

    def add(self, source: str) -> None:
        # open elements: name and node; an inline element has the node of the block around it
        stack: list[tuple[str, int]] = [("#root", self._node(-1, 0))]
        opened: dict[str, int] = {}
        run: list[str] = []
        at, end, linked, rest, hidden = 0, len(source), 0, _REST, None

        def flush() -> None:
            """Ends the run of inline text."""
            nonlocal linked
            if run:
                text = " ".join(html.unescape("".join(run)).split())
                run.clear()
                if text:
                    self._node(stack[-1][1], 1, text, min(linked, len(text)))
            linked = 0

        def close(names: set[str], holds: set[str] = frozenset()) -> None:
            """Closes the innermost of the names, with what is open inside, unless one of ``holds`` is nearer."""
            to = len(stack) - 1
            while to > 0 and stack[to][0] not in names:
                if stack[to][0] in holds:
                    return
                to -= 1
            if to > 0:
                if any(x[0] in KIND for x in stack[to:]):
                    flush()
                while len(stack) > to:
                    opened[stack.pop()[0]] -= 1

        while at < end:
            m = _OPEN.search(source, at)
            tag = rest.match(source, m.end()) if m and m[2] else None
            if m and m[2] and not tag:  # never ends: text; quotes can't be trusted from here on
                rest = _PLAIN_REST
                run.append(source[at:m.end()])
                linked += m.end() - at if opened.get("a") else 0
                at = m.end()
                continue
            piece = source[at:m.start() if m else end]
            if piece:
                run.append(piece)
                linked += len(piece) if opened.get("a") else 0
            if not m:
                break
            at = (tag or m).end()
            if not tag:  # a comment or declaration
                continue
            name = m[2].lower()
            if m[1]:
                if name in KIND:
                    flush()
                if opened.get(name):
                    close({name})
            elif name in RAW:
                found = re.compile(rf"</{name}\s*>", re.I).search(source, at)
                at = found.end() if found else end
            elif name in UNSEEN:
                hidden = hidden_spans(source) if hidden is None else hidden
                at = hidden.get(m.start(), at)
            elif name in VOID:
                run.append(" ")
                if name == "hr":
                    flush()
            else:
                node = stack[-1][1]
                if name in KIND:
                    flush()
                    if opened.get("p"):
                        close({"p"})
                    if name in _ENDS:
                        close(_ENDS[name], _HOLDS if name != "td" and name != "th" else _HOLDS | {"tr"})
                    node = self._node(stack[-1][1], 1 << KIND[name] | _attribute_bits(tag[1]))
                if not tag[1].endswith("/"):
                    stack.append((name, node))
                    opened[name] = opened.get(name, 0) + 1
        flush()
        self.pages += 1

    def arrays(self) -> tuple[np.ndarray, ...]:
        return np.array(self.page), np.array(self.parent), np.array(self.mask, np.int64)


def _levels(parent: np.ndarray) -> list[np.ndarray]:
    """Nodes by depth."""
    depth = np.zeros(parent.size, np.int64)
    for i, p in enumerate(parent.tolist()):
        if p >= 0:
            depth[i] = depth[p] + 1
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)


def _up(levels: list[np.ndarray], parent: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Sums over subtrees."""
    total = np.array(value, float)
    for level in reversed(levels[1:]):
        np.add.at(total, parent[level], total[level])
    return total


def features(nodes: Nodes) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """A row for each node; also the levels and the parents."""
    page, parent, mask = nodes.arrays()
    levels = _levels(parent)
    unit = np.array([t is not None for t in nodes.text])
    chars = np.array([len(t) if t else 0 for t in nodes.text])
    words = np.array([t.count(" ") + 1 if t else 0 for t in nodes.text])
    marks = np.array([sum(map(t.count, ".,;:!?")) if t else 0 for t in nodes.text])
    depth = np.zeros(page.size)
    above = np.zeros(page.size, np.int64)
    for d, level in enumerate(levels):
        depth[level] = d
        if d:
            above[level] = above[parent[level]] | mask[parent[level]]
    size, length, linked = (_up(levels, parent, x) for x in (np.ones(page.size), chars, nodes.link))
    units, said, marked = (_up(levels, parent, x) for x in (unit, words, marks))
    whole = np.maximum(length[levels[0]], 1)[page]
    start = np.cumsum(chars) - chars
    start = (start - start[levels[0]][page]) / whole
    order = np.lexsort((np.arange(page.size), parent))
    first = np.r_[True, np.diff(parent[order]) != 0]
    head = np.flatnonzero(first)
    count = np.diff(np.r_[head, order.size])
    siblings, place = np.empty(page.size), np.empty(page.size)
    siblings[order] = np.repeat(count, count)
    place[order] = np.arange(order.size) - np.repeat(head, count)
    near = np.zeros(page.size)
    same = np.r_[False, (np.diff(parent[order]) == 0)]
    near[order[1:]] = np.where(same[1:], length[order[:-1]], 0)
    columns = [depth, np.log1p(size), np.log1p(length), np.log1p(units), linked / np.maximum(length, 1), length / size, length / np.maximum(units, 1),
               marked / np.maximum(said, 1), length / np.maximum(said, 1), length / whole, start, np.log1p(siblings), place / siblings, np.log1p(near)]
    bits = np.arange(BITS)
    return np.column_stack([*columns, mask[:, None] >> bits & 1, above[:, None] >> bits & 1]), levels, parent


class Trees:
    """Gradient-boosted trees with logistic loss; each tree splits all its leaves to the same depth."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = 0.2):
        self.depth = depth
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) for j in range(x.shape[1])]
        codes = np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)])
        share = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        score = np.full(y.size, self.base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            g, h = p - y, p * (1 - p)
            column, edge = np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, np.inf)
            leaf = np.zeros(y.size, np.int64)
            for d in range(depth):
                n = 1 << d
                best, code = np.full(n, 1e-9), np.zeros(n, np.int64)
                for j, own in enumerate(self.edges):
                    if not own.size:
                        continue
                    cell = leaf * BINS + codes[:, j]
                    gs, hs = (np.bincount(cell, v, n * BINS).reshape(n, BINS) for v in (g, h))
                    gl, hl = gs.cumsum(1)[:, :own.size], hs.cumsum(1)[:, :own.size]
                    gt, ht = gs.sum(1)[:, None], hs.sum(1)[:, None]
                    gain = gl ** 2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt ** 2 / (ht + 1)
                    top = gain.argmax(1)
                    won = gain[np.arange(n), top]
                    for k in np.flatnonzero(won > best):
                        best[k], column[n - 1 + k], edge[n - 1 + k], code[k] = won[k], j, own[top[k]], top[k]
                at = n - 1 + leaf
                leaf = 2 * leaf + (x[np.arange(y.size), column[at]] > edge[at])
            gs, hs = np.bincount(leaf, g, 1 << depth), np.bincount(leaf, h, 1 << depth)
            value = -rate * gs / (hs + 1)
            self.trees.append((column, edge, value))
            score = score + value[leaf]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        score, rows = np.full(len(x), self.base), np.arange(len(x))
        for column, edge, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, column[at]] > edge[at])
            score += value[at - len(column)]
        return score


def decode(score: np.ndarray, unit: np.ndarray, levels: list[np.ndarray], parent: np.ndarray) -> np.ndarray:
    """Kept nodes: the set of largest total score that holds the ancestors of its nodes and no element without a unit below."""
    worth, gains, best = np.empty(score.size), np.zeros(score.size), np.full(score.size, -np.inf)
    only = np.full(score.size, -1)  # the child an element must take if none is a gain
    for d in range(len(levels) - 1, -1, -1):
        own = levels[d]
        worth[own] = np.where(unit[own], score[own], score[own] + np.where(gains[own] > 0, gains[own], best[own]))
        if d:
            above = parent[own]
            np.add.at(gains, above, np.maximum(worth[own], 0))
            np.maximum.at(best, above, worth[own])
            top = own[worth[own] == best[above]]
            only[parent[top]] = top
    kept = np.zeros(score.size, bool)
    kept[levels[0]] = True  # the root is no element of the page
    for d, own in enumerate(levels[1:]):
        above = parent[own]
        kept[own] = kept[above] & ((worth[own] > 0) | (gains[above] <= 0) & (only[above] == own) & (d > 0))
    return kept


_SYLLABLES = "an er on the re in th nd ou ha es ti ed sh or st ea ly ing der sch ent que ción é ü".split()


def _prose(r: random.Random, low: int, high: int) -> str:
    own = ["".join(r.choices(_SYLLABLES, k=r.choice([1, 2, 2, 3]))) for _ in range(r.randint(low, high))]
    for i in range(len(own)):
        if r.random() < 0.12 or i == len(own) - 1:
            own[i] += r.choice(".,.,.!?") if i < len(own) - 1 else r.choice(["", ".", "."])
    return " ".join(own).capitalize()


def _links(r: random.Random, low: int = 2, high: int = 9) -> str:
    made = [f'<a href="/{i}">{_prose(r, 1, 3)}</a>' for i in range(r.randint(low, high))]
    return "<ul>" + "".join(f"<li>{x}</li>" for x in made) + "</ul>" if r.random() < 0.6 else r.choice([" | ", " ", "<br>"]).join(made)


def _boxed(r: random.Random, tag: str, group: int, inside: str) -> str:
    """Boilerplate in its own element or in a plain one that its attributes tell."""
    token = r.choice(sorted(TOKENS[group]))
    token = r.choice([token, f"{token}-{r.choice(['box', 'area', 'wrap', 'top', 'list', '1'])}", f"site-{token}", f"{token}Block"])
    tag = tag if r.random() < 0.5 else r.choice(["div", "div", "section", "aside" if group in (4, 6) else "div"])
    named = f' {r.choice(["class", "id"])}="{token}"' if tag in ("div", "section") or r.random() < 0.4 else ""
    return f"<{tag}{named}>{inside}</{tag}>"


def _paragraphs(r: random.Random, count: int, low: int, high: int) -> str:
    made = [_prose(r, low, high) for _ in range(count)]
    return made[0] if count == 1 and r.random() < 0.4 else "".join(f"<p>{x}</p>" for x in made)


def training_page(r: random.Random) -> tuple[str, set[str]]:
    """A page, and the units of its main text."""
    kept: list[str] = []

    def main(tag: str, low: int, high: int) -> str:
        text = _prose(r, low, high)
        kept.append(text)
        own = text.split(" ")
        if len(own) > 8 and r.random() < 0.3:
            i = r.randrange(len(own) - 3)
            own[i] = r.choice(['<a href="/x">', "<b>", "<em>", "<span>"]) + own[i]
            own[i + 2] += "</" + re.findall(r"<(\w+)", own[i])[0] + ">"
        return f"<{tag}>{' '.join(own)}" + ("" if tag == "p" and r.random() < 0.1 else f"</{tag}>")

    boxes = {
        "advert": lambda: _boxed(r, "aside", 6, _paragraphs(r, r.randint(1, 2), 2, 30)),
        "notice": lambda: _boxed(r, "dialog", 5, _paragraphs(r, 1, 4, 40) + r.choice(["", "<button>" + _prose(r, 1, 2) + "</button>"])),
        "form": lambda: _boxed(r, "form", 7, f"<form><label>{_prose(r, 1, 6)}</label><input name=q><button>{_prose(r, 1, 2)}</button></form>" + r.choice(["", _paragraphs(r, 1, 3, 20)])),
        "side": lambda: _boxed(r, "aside", 4, r.choice(["", f"<h3>{_prose(r, 1, 4)}</h3>"]) + r.choice([_links(r), _paragraphs(r, r.randint(1, 3), 4, 40)])),
        "share": lambda: _boxed(r, "div", 9, r.choice([_links(r, 1, 4), _prose(r, 1, 8)])),
        "comments": lambda: _boxed(r, "section", 8, r.choice(["", f"<h3>{_prose(r, 1, 3)}</h3>"]) + "".join(
            r.choice(["<div>{}</div>", '<div class="comment">{}</div>', "<li>{}</li>", "<article>{}</article>"]).format(_paragraphs(r, r.randint(1, 2), 3, 80)) for _ in range(r.randint(1, 6)))),
    }
    inside = [main("h1", 2, 14)] if r.random() < 0.8 else []
    for _ in range(r.choice([1, 2, 3, 5, 8, 14, 25])):
        kind = r.random()
        if kind < 0.8:
            inside.append(main("p", 1, r.choice([3, 20, 80, 200])))
        elif kind < 0.87:
            inside.append(main(r.choice(["h2", "h3"]), 1, 8))
        elif kind < 0.91:
            inside.append(main("blockquote", 5, 50))
        elif kind < 0.95:
            inside.append("<ul>" + "".join(main("li", 2, 25) for _ in range(r.randint(2, 5))) + "</ul>")
        else:
            inside.append(boxes[r.choice(["advert", "advert", "share", "form", "side"])]())
    if r.random() < 0.25:
        inside.append(boxes[r.choice(["share", "comments", "side", "form"])]())
    tag = r.choice(["article", "article", "article", "main", "div", "div", "section", "td"])
    named = f' {r.choice(["class", "id"])}="{r.choice(sorted(TOKENS[0]))}{r.choice(["", "-body", "-wrap", " clearfix"])}"' if tag in ("div", "section", "td") and r.random() < 0.8 or r.random() < 0.2 else ""
    article = f"<{tag}{named}>{''.join(inside)}</{tag}>"
    if tag == "td":
        article = f"<table><tr><td>{_links(r)}</td>{article}</tr></table>"
    before = [_boxed(r, "nav", 1, _links(r))] if r.random() < 0.8 else []
    before += [_boxed(r, "header", 2, r.choice([f"<h1>{_prose(r, 1, 4)}</h1>", _paragraphs(r, 1, 1, 12), f'<a href="/">{_prose(r, 1, 3)}</a>']))] if r.random() < 0.4 else []
    before += [boxes[k]() for k in ("notice", "advert", "side", "form") if r.random() < 0.3]
    after = [boxes[k]() for k in ("comments", "side", "share", "advert", "form") if r.random() < 0.3]
    after += [_boxed(r, "footer", 3, r.choice(["&copy; ", "", ""]) + r.choice([_paragraphs(r, 1, 3, 30), _links(r) + _paragraphs(r, 1, 2, 15)]))] if r.random() < 0.85 else []
    r.shuffle(before)
    body = "".join([*before, article, *after])
    for _ in range(r.choice([0, 0, 1])):
        body = f"<div{r.choice(['', ' id=wrapper', ' class=container'])}>{body}</div>"
    return f"<!DOCTYPE html><html><head><title>{_prose(r, 2, 8)}</title><style>p{{}}</style></head><body>{body}</body></html>", set(kept)


@cache
def trained(pages: int = TRAINING_PAGES, seed: int = 11) -> Trees:
    r, nodes, good = random.Random(seed), Nodes(), []
    for _ in range(pages):
        source, kept = training_page(r)
        first = len(nodes.page)
        nodes.add(source)
        good += [t in kept if t is not None else False for t in nodes.text[first:]]
    x, levels, parent = features(nodes)
    y = (_up(levels, parent, np.array(good)) > 0).astype(float)
    return Trees(x, y)


def extract(sources: list[str], trees: Trees) -> list[str]:
    """The main texts of pages."""
    nodes = Nodes()
    for s in sources:
        nodes.add(s)
    x, levels, parent = features(nodes)
    kept = decode(trees.log_odds(x), np.array([t is not None for t in nodes.text]), levels, parent)
    out: list[list[str]] = [[] for _ in sources]
    for i in np.flatnonzero(kept).tolist():
        if nodes.text[i] is not None:
            out[nodes.page[i]].append(nodes.text[i])
    return ["\n".join(x) for x in out]


def main_texts(pages: DataFrame, key: str = "page_id", source: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """key, the ``keep`` columns and text of every row."""
    trees = trained()
    rows = pages.select(key, *keep, F.col(source).cast("string").alias("_source"))
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    out = arrow_schema("text string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            made = pa.array(extract(texts(b.column(b.num_columns - 1)), trees), pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], made], schema=pa.schema([*list(b.schema)[:-1], *out]))

    return rows.mapInArrow(run, ", ".join([*columns, "text string"]))


def op5_maintext(spark: SparkSession, sf: str) -> DataFrame:
    found = main_texts(spark.read.parquet(f"{sf}/pages.parquet"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
