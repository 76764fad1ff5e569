"""Main text of HTML pages by a tree-structured graphical model.

A tolerant scanner makes a tree of block elements; inline markup melts into the text around it, and only scripts, styles, forms with
their fields, the head, what is never shown (templates, frames) and comments are left out by form. As in HTML, a quote opens a value only
right after its equals sign; a quote that never closes is a character like others. Open elements are found by name, so a page costs
in proportion to its length whatever it nests or leaves open. Each node has a binary state, content or not. Its own evidence is a logistic model of its
tag, its class names, the text below it and the class names above it; parent and child are joined by potentials learned, for
each kind of parent, from how often states meet. Sum-product messages go up from the leaves and down from the root, over all nodes of a batch at once, level by level, and
give each node's marginal. Text whose node's marginal reaches THRESHOLD is the page's content, in page order.

The model is trained at the start of each query on TRAINING_PAGES labelled pages, which labelled_pages() makes by layout
rules (articles by element, by class or by neither, in wrappers of any depth, with menus, sidebars, adverts, notices, reader
comments, forms and broken markup).

A null, empty or wordless page gives an empty text; a page is never cut, so very long ones cost in proportion. Repeated rows
give equal texts, an empty table none. Other columns are carried; a column named content is replaced.
"""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.session import ship_package

TRAINING_PAGES, SEED, THRESHOLD = 600, 5, 0.4
#: Share of content in the text below a node from which the node counts as content when training.
PURE = 0.8
#: Kinds of HTML elements; fixed values of the standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title template xmp iframe noembed noframes".split())
DROPPED = frozenset("head form select datalist".split())
BLOCKS = frozenset("html body article section main header footer nav aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody thead tfoot tr td th caption blockquote pre figure figcaption address details summary hr center form fieldset head".split())
IN_HEAD = frozenset("base basefont bgsound link meta title script style noscript template noframes html head".split())
CLOSES_P = BLOCKS - frozenset(("html", "body", "head"))
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LISTS, CELLS = ("ul", "ol", "dl", "table", "select"), ("td", "th", "caption")
IN_TABLE = frozenset("table thead tbody tfoot tr td th caption".split())
TAG_GROUPS = ("p", "h1", "h2 h3 h4 h5 h6", "ul ol dl", "li dt dd", "div section center", "article", "main", "nav", "header", "footer", "aside", "table tbody thead tfoot tr td th caption", "blockquote pre figure figcaption", "html body")
#: Parts of class names and ids that tell of content or of other things.
GOOD = "article content story post entry body main text prose"
BAD = "nav menu sidebar side ad ads advert advertisement banner promo sponsor comment comments reply cookie consent notice notices alert popup modal footer header breadcrumb share social related widget newsletter subscribe login form pagination tags meta copyright toolbar"

_TAGS = {t: i for i, g in enumerate(TAG_GROUPS) for t in g.split()}
_good, _bad = frozenset(GOOD.split()), frozenset(BAD.split())
_markup = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)(?=[\s/>])|[^<]+|<", re.S)
_attribute = re.compile(r"[^>=]*+(?:(>)|=\s*+(?:([\"'])|[^\s>\"'][^\s>]*+)?+)?+")
_names = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_space = re.compile(r"[ \t\n\r\f\v\xa0 -   　]+")


@dataclass
class Page:
    """Nodes in page order, parents first: tag group, parent, class hints; and runs of text with the node that holds them."""

    tag: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    hints: list[tuple[int, int]] = field(default_factory=list)
    runs: list[tuple[int, str, int]] = field(default_factory=list)  # node, text, characters in links


class Tags:
    """Where the tags of a page end, each character looked at a bounded number of times."""

    def __init__(self, page: str) -> None:
        self.page, self.last, self.quotes = page, page.rfind(">"), {'"': True, "'": True}

    def end(self, at: int) -> int:
        """The place after the > that ends the tag whose name ends at a place; -1 if there is none."""
        if at > self.last:
            return -1
        found = self.by_rules(at) if any(self.quotes.values()) else -1
        return found if found >= 0 else self.page.find(">", at) + 1

    def by_rules(self, at: int) -> int:
        while at <= self.last:
            m = _attribute.match(self.page, at)
            at = m.end()
            if m[1]:
                return at
            if m[2] and self.quotes[m[2]]:
                close = self.page.find(m[2], at)
                if close < 0:
                    self.quotes[m[2]] = False  # none closes from here on
                else:
                    at = close + 1
        self.quotes = dict.fromkeys(self.quotes, False)  # the rest of the page would be one tag: from here on tags end at the next >
        return -1


class Open:
    """The open elements: a stack of tag and node (the parent's for inline ones), with the places of each name and of all blocks."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = [("", -1)]
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, name: str, node: int) -> None:
        self.at.setdefault(name, []).append(len(self.stack))
        if name in BLOCKS:
            self.blocks.append(len(self.stack))
        self.stack.append((name, node))

    def pop(self) -> str:
        name, _ = self.stack.pop()
        if name:
            self.at[name].pop()
            if name in BLOCKS:
                self.blocks.pop()
        return name

    def last(self, *names: str) -> int:
        """The place of the innermost open element of these names, 0 if there is none."""
        return max((x[-1] for n in names if (x := self.at.get(n))), default=0)

    def melt(self, place: int) -> None:
        """End an inline element without those within it."""
        name, node = self.stack[place]
        self.at[name].pop()
        self.stack[place] = ("", node)


def parse(page: str | None) -> Page:
    out = Page()
    if not page:
        return out
    tags, opened = Tags(page), Open()
    text: list[str] = []
    linked, in_link, dropped = 0, 0, 0
    pos = 0

    def flush() -> None:
        nonlocal linked
        if text:
            joined = _space.sub(" ", html.unescape("".join(text))).strip()
            if joined:
                out.runs.append((max(opened.stack[-1][1], 0), joined, linked))
            text.clear()
        linked = 0

    def say(what: str) -> None:
        nonlocal linked
        if not dropped:
            text.append(what)
            linked += len(what) if in_link else 0

    def node(tag: str, rest: str) -> int:
        words = set()
        for m in _names.finditer(rest):
            words.update(re.split(r"[^a-z]+", (m[1] or m[2] or m[3] or "").lower()))
        out.tag.append(_TAGS.get(tag, len(TAG_GROUPS)))
        out.parent.append(opened.stack[-1][1])
        out.hints.append((len(words & _good), len(words & _bad)))
        return len(out.tag) - 1

    def left(name: str) -> None:
        nonlocal in_link, dropped
        in_link -= name == "a"
        dropped -= name in DROPPED

    def close(depth: int) -> None:
        while len(opened.stack) > depth:
            if opened.stack[-1][0] in BLOCKS:
                flush()
            left(opened.pop())

    n = len(page)
    while pos < n:
        m = _markup.match(page, pos)
        name = m[2]
        end = tags.end(m.end()) if name else m.end()
        # </head> may be left out: it ends at the first text or element that can't stand in it
        if opened.stack[-1][0] == "head" and (not m[1] and name.lower() not in IN_HEAD if name else m[0][:2] not in ("<!", "<?") and m[0].strip()):
            close(len(opened.stack) - 1)
        if not name or end < 0:
            if m[0][0] != "<" or m[0] == "<" or name:
                say(m[0])
            pos = m.end()
            continue
        rest, pos, name = page[m.end() : end - 1], end, name.lower()
        if m[1]:
            if not (place := opened.last(name)):
                if name in BLOCKS:
                    flush()
            elif name not in BLOCKS:
                left(name)
                opened.melt(place)
            elif name in IN_TABLE or place > opened.last(*CELLS):  # what a cell holds doesn't end what holds the cell
                close(place)
            continue
        if name in VOID:
            if name == "hr":
                flush()
            elif name != "wbr":
                say(" ")
            continue
        if name in RAW:
            closing = re.compile(f"</{name}(?=[\\s/>]|\\Z)", re.I | re.A).search(page, pos)
            if name == "xmp":
                say(html.escape(page[pos : n if closing is None else closing.start()]))
            pos = n if closing is None else (page.find(">", closing.end()) + 1 or n)
            continue
        if rest.rstrip().endswith("/") and name not in BLOCKS:
            continue
        if name in CLOSES_P and opened.blocks and opened.stack[opened.blocks[-1]][0] == "p":
            close(opened.blocks[-1])
        if (same := SIBLINGS.get(name)) and (place := opened.last(*same)) > opened.last(*LISTS):
            close(place)
        if name in BLOCKS:
            flush()
            opened.push(name, node(name, rest))
        else:
            opened.push(name, opened.stack[-1][1])
        in_link += name == "a"
        dropped += name in DROPPED
    close(1)
    flush()
    if out.runs and not out.tag:
        node("body", "")
    return out


def node_features(p: Page) -> np.ndarray:
    """One row for each node: its tag, hints, and the text in and below it."""
    n, groups = len(p.tag), len(TAG_GROUPS) + 1
    own = np.zeros((n, 4))  # characters, characters in links, runs, ends of sentences
    for k, t, linked in p.runs:
        own[k] += (len(t), min(linked, len(t)), 1, t.count(".") + t.count("!") + t.count("?"))
    below = own.copy()
    for k in range(n - 1, 0, -1):
        if p.parent[k] >= 0:
            below[p.parent[k]] += below[k]
    total = max(own[:, 0].sum(), 1.0)
    hints = np.array(p.hints, float).reshape(n, 2) > 0
    above = np.zeros((n, 2))  # hints of the elements around a node, from the nearest on ever less
    for k in range(1, n):
        if p.parent[k] >= 0:
            above[k] = np.maximum(hints[p.parent[k]], above[p.parent[k]] * 0.8)
    x = np.zeros((n, groups + 10))
    x[np.arange(n), p.tag] = 1
    x[:, groups : groups + 2] = hints
    x[:, groups + 8 :] = above
    x[:, groups + 2] = np.log1p(own[:, 0]) / 5
    x[:, groups + 3] = own[:, 1] / np.maximum(own[:, 0], 1)
    x[:, groups + 4] = np.log1p(below[:, 0]) / 5
    x[:, groups + 5] = below[:, 1] / np.maximum(below[:, 0], 1)
    x[:, groups + 6] = below[:, 0] / total
    x[:, groups + 7] = np.log1p(below[:, 3]) / 3
    return x


def _log_sum(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


@dataclass
class TreeModel:
    weights: np.ndarray
    bias: float
    prior: float  # share of content nodes
    pair: np.ndarray  # log potential by kind of the parent, state of the parent and state of the child; without kinds if all are one

    def marginals(self, x: np.ndarray, parent: np.ndarray, kind: np.ndarray | None = None) -> np.ndarray:
        """Of content, by sum-product over a forest whose parents come first; parent is -1 at roots."""
        n = len(x)
        if not n:
            return np.zeros(0)
        z = x @ self.weights + self.bias
        unary = np.stack((np.zeros(n), np.clip(z, -30, 30)), 1)
        depth = np.zeros(n, np.int64)
        for k in range(n):
            if parent[k] >= 0:
                depth[k] = depth[parent[k]] + 1
        order = np.argsort(depth, kind="stable")
        levels = np.split(order, np.cumsum(np.bincount(depth))[:-1])
        pair = self.pair.reshape(-1, 2, 2)[np.zeros(n, np.int64) if kind is None else kind]
        up, sent = unary.copy(), np.zeros((n, 2))
        for rows in levels[:0:-1]:
            if len(rows) == 1:  # long chains are many levels of one node
                k, p = rows[0], parent[rows[0]]
                (a, b), ((c, d), (e, f)) = up[k].tolist(), pair[p].tolist()
                sent[k] = _log_sum(a + c, b + d), _log_sum(a + e, b + f)
                up[p] += sent[k]
                continue
            between = pair[parent[rows]]
            sent[rows] = np.logaddexp(up[rows, :1] + between[:, :, 0], up[rows, 1:] + between[:, :, 1])
            np.add.at(up, parent[rows], sent[rows])
        belief = up.copy()
        for rows in levels[1:]:
            if len(rows) == 1:
                k, p = rows[0], parent[rows[0]]
                (a, b), ((c, d), (e, f)) = (belief[p] - sent[k]).tolist(), pair[p].tolist()
                belief[k] += _log_sum(a + c, b + e), _log_sum(a + d, b + f)
                continue
            rest, between = belief[parent[rows]] - sent[rows], pair[parent[rows]]  # what the parent knows from elsewhere
            belief[rows] += np.logaddexp(rest[:, :1] + between[:, 0], rest[:, 1:] + between[:, 1])
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -60, 60)))


def labelled_pages(count: int = TRAINING_PAGES, seed: int = SEED) -> list[tuple[Page, np.ndarray]]:
    """Pages made by layout rules, with the state of each node. Words that start with k are content."""
    rng = np.random.Generator(np.random.PCG64(seed))
    tails = ["".join(x[:n]) for x, n in zip(rng.choice(list("aeioulnrst"), (4096, 8)), rng.integers(1, 9, 4096), strict=True)]
    says = lambda c, n: " ".join(c + tails[k] for k in rng.integers(0, len(tails), n))
    pick = lambda *x: x[rng.integers(len(x))]
    prose = lambda c, n: ". ".join(says(c, rng.integers(3, 18)) for _ in range(n)) + "."
    out = []

    def wrapped(inner: str, names: tuple[str, ...], most: int) -> str:
        """Some elements around inner that tell nothing, or its name."""
        for _ in range(rng.integers(0, most + 1)):
            inner = f"<div{pick('', f" id='{pick('page', 'wrapper', 'outer', 'primary', 'row', 'col')}'", f" class='{pick(*names)}'")}>{inner}</div>"
        return inner

    for _ in range(count):
        links = lambda least, most: "".join(f"<li{pick('', " class='item'")}><a href='/{k}'>{says('m', rng.integers(1, 6))}</a></li>" for k in range(rng.integers(least, most)))
        menu = f"<ul>{links(3, 12)}</ul>"
        bar = " | ".join(f"<a href='/{k}'>{says('m', rng.integers(1, 3))}</a>" for k in range(rng.integers(2, 9)))
        nav = pick(f"<nav>{pick(menu, bar)}</nav>", f"<div class='{pick('menu', 'nav', 'navbar top')}'>{pick(menu, bar)}</div>", f"<header><h1>{says('m', 2)}</h1>{menu}</header>", f"<header class='site-header'><div><p class='site-title'><a href='/'>{says('m', 2)}</a></p></div><nav>{menu}</nav></header>", f"<div class='header'><div class='logo'>{says('m', 3)}</div><div>{bar}</div></div>", menu, "")
        paragraphs = [pick(f"<p>{prose('k', rng.integers(1, 7))}</p>", f"<p><b>{prose('k', 1)}<br>", f"<p>{prose('k', rng.integers(1, 4))} <a href='x'>{says('k', 2)}</a> {says('k', 3)}.</p>", f"<p>{says('k', rng.integers(1, 80))}</p>", f"<p>{says('k', rng.integers(1, 3))}.</p>") for _ in range(rng.integers(1, 14))]
        for k in range(len(paragraphs)):
            if rng.random() < 0.15:
                paragraphs[k] = pick(f"<h2>{says('k', rng.integers(1, 6))}</h2>", f"<ul><li>{prose('k', 1)}</li><li>{says('k', rng.integers(2, 9))}</li></ul>", f"<blockquote>{pick(f'<p>{prose("k", 2)}</p>', prose('k', 1))}</blockquote>", f"<figure><img src='x'><figcaption>{says('k', rng.integers(2, 12))}</figcaption></figure>", f"<aside class='related'><p>{says('m', 6)}</p></aside>", f"<div class='{pick('ad', 'promo', 'notice', 'newsletter')}'>{pick(prose('m', 1), f'<p>{prose("m", 1)}</p>')}</div>", f"<table><tr><td>{says('k', 3)}</td><td>{says('k', 3)}</td></tr></table>")
        title = f"<h1>{says('k', rng.integers(2, 9))}</h1>"
        text = "".join(paragraphs)
        story = pick(title + text, f"{title}<div class='{pick('entry-content', 'story-body', 'post-body', 'text')}'>{text}</div>", f"<header class='entry-header'>{title}</header><div class='entry-content'>{text}</div>")
        story = pick(f"<article>{story}</article>", f"<main><article>{story}</article></main>", f"<div class='{pick('content', 'post-body', 'article-text', 'story')}'>{story}</div>", f"<main>{story}</main>", f"<article class='post'>{story}</article>", f"<section class='article-text'>{story}</section>", *[story] * 4)
        boxes = [f"<div class='{pick('ad', 'advert', 'banner')}'>{prose('m', rng.integers(1, 3))}</div>", f"<aside>{menu}<p>{prose('m', 1)}</p></aside>", f"<div class='{pick('cookie', 'notice', 'cookie-notice')}'><p>{prose('m', 1)}</p></div>", f"<div class='sidebar'><h3>{says('m', 2)}</h3><ul>{links(2, 9)}</ul></div>", f"<aside class='widget-area'><section class='widget'><h2>{says('m', 2)}</h2><ul>{links(2, 6)}</ul></section></aside>", f"<aside class='newsletter'><h3>{says('m', 1)}</h3><p>{prose('m', 1)}</p><form><input></form></aside>", f"<form><label>{says('m', 2)}</label><input></form>"]
        said = [pick(f"<p>{prose('m', rng.integers(1, 4))}</p>", f"<p>{says('m', rng.integers(2, 20))}</p>") for _ in range(rng.integers(1, 6))]
        comments = pick("".join(f"<div class='comment'>{c}</div>" for c in said), f"<ol class='comment-list'>{''.join(f"<li class='comment'>{c}</li>" for c in said)}</ol>", "".join(said))
        comments = pick(f"<section class='comments'><h3>{says('m', 1)}</h3>{comments}</section>", f"<div id='comments'>{comments}</div>", f"<div id='comments' class='comments-area'><h2>{says('m', 2)}</h2>{comments}<form class='comment-form'><label>x</label></form></div>", "", "")
        often = pick(0.0, 0.25, 0.25, 0.25)  # old pages have no boxes
        before = "".join(b for b in boxes if rng.random() < often)
        after = "".join(b for b in boxes if rng.random() < often)
        footer = pick(f"<footer>{prose('m', rng.integers(1, 6))}</footer>", f"<footer>&copy; {says('m', rng.integers(1, 20))}</footer>", f"<div class='footer'>{says('m', 6)}</div>", f"<footer><p>{prose('m', 1)}</p>{menu}</footer>", f"<footer class='site-footer'><div>{says('m', 5)}</div></footer>", f"<ul>{links(1, 4)}</ul>")
        if rng.random() < 0.5:
            story, comments = wrapped(story + comments, ("content", "site-content", "main", "inner"), 3), ""
        story = wrapped(story, ("content", "site-content", "main", "inner"), pick(0, 2))
        around = pick(0, 3, 3)
        nav, after, footer = wrapped(nav, ("row", "top"), 1), wrapped(after, ("row", "col"), 1), wrapped(footer, ("row", "bottom"), 1)
        page = parse(f"<!DOCTYPE html><html><head><title>{says('m', 4)}</title></head><body>{wrapped(nav + before + story + after + comments + footer, ('wrapper', 'container', 'inner'), around)}{pick('</body></html>', '')}")
        good, bad = np.zeros(len(page.tag)), np.zeros(len(page.tag))
        for k, t, _ in page.runs:
            (good if t[0] == "k" else bad)[k] += len(t)
        for k in range(len(page.tag) - 1, 0, -1):
            if page.parent[k] >= 0:
                good[page.parent[k]] += good[k]
                bad[page.parent[k]] += bad[k]
        out.append((page, ((good > 0) & (good >= PURE * (good + bad))).astype(float)))
    return out


def train(pages: list[tuple[Page, np.ndarray]], rounds: int = 20, ridge: float = 1e-5) -> TreeModel:
    """Logistic evidence by Newton steps; potentials from how often states meet below a parent of each kind, beyond chance."""
    x = np.concatenate([node_features(p) for p, _ in pages])
    y = np.concatenate([s for _, s in pages])
    a = np.hstack((x, np.ones((len(x), 1))))
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hess = (a * (q * (1 - q))[:, None]).T @ a / len(y) + ridge * np.eye(len(w))
        w -= np.linalg.solve(hess, a.T @ (q - y) / len(y) + ridge * w)
    meet = np.ones((len(TAG_GROUPS) + 1, 2, 2))
    for p, s in pages:
        for k, up in enumerate(p.parent):
            if up >= 0:
                meet[p.tag[up], int(s[up]), int(s[k])] += 1
    share = meet / meet.sum(2, keepdims=True)
    pair = np.log(share / (meet.sum((0, 1)) / meet.sum()))
    return TreeModel(w[:-1], float(w[-1]), float(y.mean()), pair)


@cache
def _trained(count: int, seed: int) -> TreeModel:
    return train(labelled_pages(count, seed))


def extract(pages: list[str | None], model: TreeModel, threshold: float = THRESHOLD) -> list[str]:
    """The content of each page; the nodes of all are judged together."""
    parsed = [parse(p) for p in pages]
    sizes = np.cumsum([0, *(len(p.tag) for p in parsed)])
    if not sizes[-1]:
        return [""] * len(pages)
    x = np.concatenate([node_features(p) for p in parsed if p.tag])
    parent = np.concatenate([np.where(np.array(p.parent) >= 0, np.array(p.parent) + s, -1) for p, s in zip(parsed, sizes, strict=False) if p.tag])
    kind = np.concatenate([p.tag for p in parsed if p.tag])
    content = model.marginals(x, parent, kind) >= threshold
    return ["\n\n".join(t for k, t, _ in p.runs if content[s + k]) for p, s in zip(parsed, sizes, strict=False)]


def extract_content(pages: DataFrame, source: str = "html", training_pages: int = TRAINING_PAGES, seed: int = SEED) -> DataFrame:
    """pages with content: the main text of each."""
    ship_package(pages.sparkSession)
    model = _trained(training_pages, seed)

    def work(column: pa.Array) -> pa.Array:
        texts, out, k = column.to_pylist(), [], 0
        while k < len(texts):
            size, j = 0, k
            while j < len(texts) and (j == k or size < 1_000_000):
                size += len(texts[j] or "")
                j += 1
            out += extract(texts[k:j], model)
            k = j
        return pa.array(out, pa.string())

    return pages.withColumn("content", F.arrow_udf(work, "string")(F.col(source)))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_content(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "url", F.col("content").alias("text"), F.length("content").cast("long").alias("n_chars"))
