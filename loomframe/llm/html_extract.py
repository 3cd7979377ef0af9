"""Main text of web pages: gradient-boosted trees over DOM-node features, and a hierarchical decoding.

Every block element and text block is a node. Trees give its log-odds of holding main text, from the density of its subtree, the
words in its attributes, its depth, its ancestors and its siblings. Decoding picks the set of nodes with the highest total in which
a kept node's parent is kept too, so an ancestor and a descendant never contradict each other; kept text blocks are the result.

The trees are fitted on a bounded sample of the pages themselves. Their labels come from marked-up article elements (else from the
element with the most paragraph text); each sampled page is also rebuilt with other wrappers and with menus, notices, adverts, forms,
sidebars and comments made of its own sentences, so that the trees learn from more layouts than the corpus shows.

Nulls and edge cases: a null html is empty and gives the empty text. Broken markup is read as browsers do (open paragraphs end
at the next block; a tag that nothing ends is text; elements that only show media hide nothing if they are not closed). Line breaks
(<br>) are white space inside their block. Very long pages are read whole, in time linear in their length, and their nodes are
decided in blocks of NODES. Repeated rows give equal texts. Without any page the trees are empty and keep every block. Columns of
the pages other than html are not looked at, whatever their names.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.llm.common import batches_of, col, written
from loomframe.llm.dom import NUMBERS, WIDTH, Page, features

# Pages that the trees are fitted on, and rebuilt forms of each.
SAMPLE, FORMS = 300, 3
TREES, DEPTH, RATE, BINS, LEAST = 40, 4, 0.25, 24, 20
# Nodes whose features are held at a time.
NODES = 20_000
MAIN, NOISE = "data-main-text", "data-other-text"


@dataclass
class BoostedTrees:
    """Complete trees of one depth: feature and threshold of each inner node, value of each leaf."""

    feature: np.ndarray  # trees x (2^depth - 1)
    threshold: np.ndarray
    value: np.ndarray  # trees x 2^depth
    start: float

    def decision(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), np.int64)
            while len(f) and at.size and at[0] < len(f):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += v[at - len(f)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> BoostedTrees:
    """Second-order boosting of the log loss, level by level: numbers in bins, yes/no features by matrix products."""
    numbers, yes = x[:, :NUMBERS], np.ascontiguousarray(x[:, NUMBERS:], np.float32)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in numbers.T]
    flat = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, numbers.T)], axis=1) + np.arange(NUMBERS) * BINS
    p0 = np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    score = np.full(len(y), np.log(p0 / (1 - p0)))
    start, trees, size, inner, leaves = float(score[0]), [], NUMBERS * BINS, 2 ** DEPTH - 1, 2 ** DEPTH
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        stats = [weight * (p - y), weight * p * (1 - p), np.ones(len(y))]  # gradients, curvatures, counts
        feature, threshold, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            nodes, base = 2 ** level, 2 ** level - 1
            key = ((at - base)[:, None] * size + flat).ravel()
            member = np.zeros((len(y), nodes), np.float32)
            member[np.arange(len(y)), at - base] = 1
            left, total = [], []
            for v in stats:
                binned = np.bincount(key, np.repeat(v, NUMBERS), nodes * size).reshape(nodes, NUMBERS, BINS)
                total.append(binned[:, :1].sum(axis=2))
                no = total[-1] - (member * v[:, None].astype(np.float32)).T @ yes
                left.append(np.concatenate([binned.cumsum(axis=2).reshape(nodes, -1), no], axis=1))
            (gl, hl, nl), (gt, ht, nt) = left, total
            gain = gl ** 2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt ** 2 / (ht + 1)
            gain[(nl < LEAST) | (nt - nl < LEAST)] = 0
            for k, b in enumerate(gain.argmax(axis=1).tolist()):
                j, c = divmod(b, BINS) if b < size else (NUMBERS + b - size, -1)
                if gain[k, b] > 1e-6 and (c < 0 or c < len(cuts[j])):
                    feature[base + k], threshold[base + k] = j, 0.5 if c < 0 else cuts[j][c]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > threshold[at])
        leaf = at - inner
        value = -RATE * np.bincount(leaf, stats[0], leaves) / (np.bincount(leaf, stats[1], leaves) + 1)
        score = score + value[leaf]
        trees.append((feature, threshold, value))
    return BoostedTrees(*(np.array(a) for a in zip(*trees)), start)


def matrix(pages: list[Page]) -> np.ndarray:
    return dense([f for p in pages for f in features(p)])


def dense(rows: list) -> np.ndarray:
    x = np.zeros((len(rows), WIDTH), np.float32)
    if rows:
        x[:, : len(rows[0][0])] = [r[0] for r in rows]
        x[np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows]), np.fromiter((j for r in rows for j in r[1]), np.int64)] = 1
    return x


def decode(page: Page, odds: np.ndarray) -> list[int]:
    """Text blocks of the best consistent choice; odds belong to nodes 1, 2, ..."""
    n = len(page.tags)
    best = np.concatenate([[0.0], odds]).tolist()
    for i in range(n - 1, 0, -1):  # children come after their parent
        if best[i] > 0:
            best[page.parents[i]] += best[i]
    kept, out = [True] + [False] * (n - 1), []
    for i in range(1, n):
        kept[i] = kept[page.parents[i]] and best[i] > 0
        if kept[i] and page.tags[i] == "#text":
            out.append(i)
    return out


def labels(page: Page) -> np.ndarray:
    """1 for nodes that hold main text: blocks inside the marked element and outside what is marked as other, and their ancestors."""
    n = len(page.tags)
    inside, y = [0] * n, np.zeros(n)
    for i in range(1, n):
        a = page.attrs[i]
        inside[i] = 0 if NOISE in a else 1 if MAIN in a else inside[page.parents[i]]
    for i in range(n - 1, 0, -1):
        if inside[i] and page.tags[i] == "#text":
            y[i] = 1
        if y[i]:
            y[page.parents[i]] = 1
    return y[1:]


ROOT = re.compile(r"<(article|main)\b([^>]*)>(.*?)(?=</\1\s*>)", re.DOTALL | re.IGNORECASE)
WRAPPERS = [("<article>", "</article>"), ('<main><article class="post">', "</article></main>"), ('<div class="content">', "</div>"), ("<div>", "</div>"),
            ('<div id="main-content" class="entry-content">', "</div>"), ('<section class="story-body">', "</section>"), ('<div class="post-body">', "</div>"),
            ('<div class="container"><main id="main">', "</main></div>"), ('<td class="body">', "</td>"), ("<section>", "</section>")]


def marked(source: str) -> str | None:
    """The page with its article element marked; None if it has none."""
    m = ROOT.search(source)
    return None if m is None else f"{source[:m.start()]}<{m[1]} {MAIN} {m[2]}>{source[m.start(3):]}"


def rebuilt(inner: str, sentences: list[str], draw: random.Random) -> str:
    """The article's markup in another layout, amid other text made of its own sentences."""
    some = lambda n: " ".join(draw.choice(sentences) for _ in range(n))
    word = lambda: draw.choice(sentences).split(" ")[0]
    links = lambda n: "".join(f'<li><a href="/{i}">{word()} {word()}</a></li>' for i in range(n))
    paras = lambda n: "".join(f"<p>{some(draw.randint(1, 4))}</p>" for _ in range(n))
    person = lambda: f'<div class="{draw.choice(["comment", "reply", "comment-body"])}"><b>{word()}</b> {paras(draw.randint(1, 3))}</div>'
    other = {
        "menu": lambda: draw.choice(["<nav {o}><ul>{l}</ul></nav>", '<div {o} class="menu"><ul>{l}</ul></div>', '<ul {o} id="navbar">{l}</ul>', "<nav {o}>{l}</nav>"]).replace("{l}", links(draw.randint(3, 9))),
        "header": lambda: draw.choice([f"<header {{o}}><h2>{some(1)}</h2><p>{some(1)}</p></header>", f'<div {{o}} id="header">{some(1)}</div>', f'<div {{o}} class="masthead"><h1>{word()}</h1>{some(1)}</div>']),
        "notice": lambda: draw.choice([f'<div {{o}} class="cookie-notice"><p>{some(2)}</p><button>OK</button></div>', f'<div {{o}} id="consent" role="dialog">{some(3)}<a href="/p">{word()}</a></div>', f'<div {{o}} class="notice">{some(1)}</div>', f'<p {{o}} class="alert">{some(2)}</p>']),
        "advert": lambda: draw.choice([f'<div {{o}} class="ad">{some(1)}</div>', f'<div {{o}} class="sponsored"><p>{some(2)}</p></div>', f'<aside {{o}} class="advert"><h3>{word()}</h3>{paras(1)}</aside>', f'<div {{o}} id="banner-promo">{some(2)}</div>', f'<section {{o}} class="advertisement">{paras(2)}</section>']),
        "form": lambda: draw.choice([f'<form {{o}}><label>{word()}</label><input name="q"><button>{word()}</button></form>', f'<form {{o}} class="newsletter"><p>{some(2)}</p><input><button>{word()}</button></form>', f'<div {{o}} class="subscribe"><form><p>{some(1)}</p><select><option>{word()}</option></select></form></div>']),
        "sidebar": lambda: draw.choice([f'<aside {{o}}><h3>{word()}</h3><ul>{links(4)}</ul>{paras(1)}</aside>', f'<div {{o}} class="sidebar">{paras(2)}<ul>{links(5)}</ul></div>', f'<aside {{o}} class="related">{paras(3)}</aside>', f'<div {{o}} id="rail"><div class="widget">{paras(2)}</div></div>']),
        "comments": lambda: draw.choice(['<section {o} class="comments"><h2>{w}</h2>{c}</section>', '<div {o} id="comments">{c}</div>', '<div {o} class="discussion"><ol>{c}</ol></div>', '<ul {o} class="comment-list">{c}</ul>']).replace("{w}", word()).replace("{c}", "".join(person() for _ in range(draw.randint(1, 6)))),
        "share": lambda: f'<div {{o}} class="share"><a href="#">{word()}</a> <a href="#">{word()}</a></div>',
        "footer": lambda: draw.choice([f"<footer {{o}}>&copy; {some(1)}</footer>", f'<div {{o}} class="footer">{paras(2)}<ul>{links(3)}</ul></div>', f'<footer {{o}}><p>{some(2)}</p>{paras(1)}</footer>']),
    }
    make = lambda k: other[k]().replace("{o}", NOISE)
    inner = f"<div>{inner}</div>" if draw.random() < 0.2 else inner
    within = draw.sample(["advert", "form", "share", "sidebar", "notice", "comments"], draw.randint(0, 2))
    pieces = re.split(r"(?=<p[ >])", inner)
    for k in within:
        if k == "comments":
            pieces.append(make(k))
        else:
            pieces.insert(draw.randint(1, len(pieces)), make(k))
    if draw.random() < 0.3:
        pieces.insert(0, f"<h1>{some(1)}</h1>")
    if draw.random() < 0.3:
        pieces.append(f"<ul>{''.join(f'<li>{some(1)}</li>' for _ in range(3))}</ul><blockquote>{some(2)}</blockquote>")
    before, after = draw.choice(WRAPPERS)
    before = before[::-1].replace(">", f" {MAIN}>"[::-1], 1)[::-1]
    tops = draw.sample(["menu", "header", "notice", "advert", "form", "sidebar"], draw.randint(1, 4))
    tails = draw.sample(["comments", "footer", "sidebar", "advert", "form", "share", "notice", "menu"], draw.randint(1, 5))
    body = "".join(map(make, tops)) + before + "".join(pieces) + after + "".join(map(make, tails))
    body = f'<div class="{draw.choice(["wrapper", "page", "container", "site"])}">{body}</div>' if draw.random() < 0.5 else body
    return f"<html><body>{body}</body></html>"


def training_pages(sources: list[str]) -> list[Page]:
    pages = []
    for i, source in enumerate(sources):
        draw = random.Random(i)
        m = marked(source)
        if m is None:  # the element with the most paragraph text
            page = Page(source)
            weight = [0] * len(page.tags)
            for j, t in enumerate(page.texts):
                weight[page.parents[j] if page.tags[page.parents[j]] != "p" else page.parents[page.parents[j]]] += len(t) - 2 * page.links[j]
            page.attrs[int(np.argmax(weight))] += " " + MAIN
            pages.append(page)
            continue
        pages.append(Page(m))
        inner = ROOT.search(source)[3]
        sentences = [s for s in re.split(r"(?<=[.!?])\s+|<[^>]*>", inner) if s and len(s) < 400 and s.strip()] or ["."]
        pages += [Page(rebuilt(inner, sentences, draw)) for _ in range(FORMS)]
    return pages


FITTED = pa.schema([("tree", pa.int32()), ("feature", pa.list_(pa.int32())), ("threshold", pa.list_(pa.float64())), ("value", pa.list_(pa.float64()))])


def fit_extractor(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE) -> BoostedTrees:
    """Fit the trees on `sample` distinct pages, drawn by hash (all if there are fewer)."""
    rows = pages.select(col(html_col).cast("string").alias("html")).filter("html IS NOT NULL").withColumn("h", F.xxhash64("html"))
    chosen = [r["h"] for r in rows.select("h").distinct().orderBy("h").limit(sample).collect()]  # of distinct pages: copies count once
    drawn = rows.filter(F.col("h").isin(chosen)).dropDuplicates(["h"]).orderBy("h")

    def train(batches):
        found = training_pages([t for b in batches for t in b.column(0).to_pylist()])
        if not found:
            return
        x, y = matrix(found), np.concatenate([labels(p) for p in found])
        sizes = np.concatenate([[len(t) for t in p.texts[1:]] for p in found])
        model = fit_trees(x, y, 1.0 + np.minimum(3.0, np.log1p(sizes) / 3))
        rows = list(zip(range(len(model.feature)), model.feature.tolist(), model.threshold.tolist(), model.value.tolist()))
        yield from batches_of(FITTED, list(zip(*rows, (-1, [], [], [model.start]))))

    # the sample is bounded: one task fits it
    table = written(drawn.select("html")).coalesce(1).mapInArrow(train, "tree int, feature array<int>, threshold array<double>, value array<double>").toPandas()
    if not len(table):
        return BoostedTrees(np.zeros((0, 0), np.int64), np.zeros((0, 0)), np.zeros((0, 1)), 1.0)
    trees = table[table["tree"] >= 0].sort_values("tree")
    start = float(table[table["tree"] < 0]["value"].iloc[0][0])
    return BoostedTrees(np.stack(trees["feature"]).astype(np.int64), np.stack(trees["threshold"]), np.stack(trees["value"]), start)


def odds_of(model: BoostedTrees, pages: list[Page]) -> np.ndarray:
    """Log-odds of all nodes of the pages, a block of nodes at a time."""
    rows = chain.from_iterable(features(p) for p in pages)
    parts = [np.zeros(0)]
    while block := list(islice(rows, NODES)):
        parts.append(model.decision(dense(block)))
    return np.concatenate(parts)


def extract(model: BoostedTrees, sources: list[str | None]) -> list[str]:
    """Main texts of pages; small ones are decided together."""
    out, pages, nodes = [], [], 0
    for k, source in enumerate(sources, 1):
        pages.append(Page(source or ""))
        nodes += len(pages[-1].tags) - 1
        if nodes < NODES and k < len(sources):
            continue
        odds, at = odds_of(model, pages), 0
        for page in pages:
            n = len(page.tags) - 1
            out.append("\n".join(page.texts[i] for i in decode(page, odds[at:at + n])))
            at += n
        pages, nodes = [], 0
    return out


def main_text(model: BoostedTrees, html: Column) -> Column:
    """The main text of an html column."""

    @F.pandas_udf("string")
    def run(sources: pd.Series) -> pd.Series:
        return pd.Series(extract(model, [s if isinstance(s, str) else "" for s in sources]))

    return run(html)
