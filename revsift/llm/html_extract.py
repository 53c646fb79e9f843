"""Main text of web pages: boosted trees over DOM-node features, then hierarchical decoding.

A small tolerant reader turns a page into a tree of elements.  Each element gets features of itself (tag family,
attribute tokens, depth), its subtree (text, links, density) and its siblings.  Gradient-boosted trees give the
log-odds that an element belongs to the article; the tree of elements is then decoded as a whole: a dropped element
drops everything below it, and among all such consistent choices the one of largest total log-likelihood is taken.

The trees are trained on pages built from a bounded sample of the table's own words: a page grammar wraps them in
varied article and boilerplate structures and knows which is which."""

from __future__ import annotations

import html as _html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revsift.llm import common as C

#: Words of each of the pages whose words feed the grammar (its vocabulary; extraction always reads whole pages).
WORDS_PER_PAGE = 400
#: Pages whose words feed the grammar, pages it builds, and trees fitted on them (bounds of the fit).
MAX_WORD_PAGES, TRAIN_PAGES, TREES, LEAVES_DEPTH, SHRINK = 200, 700, 40, 4, 0.25

# fixed values: HTML element groups
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is not page text, up to the closing tag or the end of the page, as in browsers.
RAW = frozenset("script style template textarea iframe title".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody "
                  "td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "summary"}
#: A start tag ends open elements of these names, up to the nearest of the scope after it.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
           "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"})}
TAG_FAMILIES = (("article", "main"), ("nav", "menu"), ("header",), ("footer",), ("aside",), ("form", "button", "input",
                "label", "fieldset", "dialog", "select", "option"), ("p", "blockquote", "pre", "figcaption", "figure"),
                ("h1", "h2", "h3", "h4", "h5", "h6"), ("ul", "ol", "li", "dl", "dd", "dt"), ("a",),
                ("div", "section", "span"), ("table", "tr", "td", "th", "tbody"), ("body", "html"))
ATTR_FAMILIES = (
    "content article post entry story main text body prose page wrapper container",
    "nav navigation navbar menu breadcrumb breadcrumbs pagination pager toc links tabs",
    "header head masthead topbar logo branding",
    "footer foot bottom copyright colophon legal",
    "sidebar side aside rail related recommended recommendations popular trending widget more",
    "ad ads advert advertisement adsense banner promo promotion sponsor sponsored sponsors",
    "cookie cookies consent notice alert popup modal overlay gdpr warning message announcement toast disclaimer",
    "comment comments reply replies respond discussion disqus feedback review reviews",
    "share social follow subscribe newsletter signup login search form tags meta byline author")
FAMILY_OF_TAG = {t: i for i, f in enumerate(TAG_FAMILIES) for t in f}
FAMILY_OF_ATTR = {t: i for i, f in enumerate(ATTR_FAMILIES) for t in f.split()}

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(?:!|\?)[^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|$)",
                    re.S)  # a quote that never closes is a character of its tag
_ATTR = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


class Page:
    """Elements in document order; ``parent`` 0 is the root.  ``runs``: (element, text, starts a block)."""

    __slots__ = ("tags", "attrs", "parent", "runs")

    def __init__(self, source: str):
        self.tags, self.attrs, self.parent, self.runs = ["html"], [""], [-1], []
        stack, at, n, fresh = [0], 0, len(source), True
        while at < n:
            m = _TOKEN.search(source, at)
            if m is None or m.end() == m.start():
                self._text(stack[-1], source[at:], fresh)
                break
            if m.start() > at:
                fresh = self._text(stack[-1], source[at:m.start()], fresh)
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                fresh = fresh or tag in BLOCK
                for i in range(len(stack) - 1, 0, -1):
                    if self.tags[stack[i]] == tag:
                        del stack[i:]
                        break
                continue
            if tag in BLOCK:
                fresh = True
            if tag == "br":
                self._text(stack[-1], " ", fresh)
            if tag in RAW:
                if not m[3].rstrip().endswith("/") or tag in ("script", "style"):
                    end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|$)", re.I).search(source, at)
                    at = end.end() if end else n
                continue
            if tag in ("html", "body", "head"):
                if tag == "body":
                    del stack[1:]
                elif tag == "html":
                    continue
            if tag in CLOSES_P:
                self._close(stack, {"p"}, {"table", "button", "td"})
            if tag in IMPLIED:
                self._close(stack, *IMPLIED[tag])
            if tag in VOID:
                continue
            self.tags.append(tag)
            self.attrs.append(m[3])
            self.parent.append(stack[-1])
            if not m[3].rstrip().endswith("/") or tag in BLOCK:
                stack.append(len(self.tags) - 1)

    def _close(self, stack, names, scope):
        for i in range(len(stack) - 1, 0, -1):
            tag = self.tags[stack[i]]
            if tag in names:
                del stack[i:]
                return
            if tag in scope:
                return

    def _text(self, node, raw, fresh) -> bool:
        text = _html.unescape(raw) if "&" in raw else raw
        self.runs.append((node, text, fresh))
        return fresh and not text.strip()

    def blocks(self, keep) -> list[str]:
        """Text of the kept elements by block, white space made single."""
        out, now = [], []
        for node, text, fresh in self.runs:
            if fresh:
                out.append("".join(now))
                now = []
            if keep[node]:
                now.append(text)
        out.append("".join(now))
        return [x for x in (_SPACE.sub(" ", b).strip() for b in out) if x]


def _attr_flags(raw: str) -> int:
    flags = 0
    for m in _ATTR.finditer(raw):
        for w in _WORDS.findall((m[1] or m[2] or m[3] or "").lower()):
            f = FAMILY_OF_ATTR.get(w)
            if f is not None:
                flags |= 1 << f
    return flags


N_TAGS, N_ATTRS = len(TAG_FAMILIES), len(ATTR_FAMILIES)
_NUMBERS = 16
N_FEATURES = N_TAGS + 2 * N_ATTRS + _NUMBERS


def features(page: Page) -> np.ndarray:
    """One row per element: own tag family and attribute families, attribute families of its ancestors, numbers."""
    n = len(page.tags)
    parent = np.array(page.parent)
    chars, links, marks = np.zeros(n), np.zeros(n), np.zeros(n)
    for node, text, _ in page.runs:
        size = len(text.strip())
        if size:
            chars[node] += size
            marks[node] += text.count(".") + text.count(",")
    family = np.array([FAMILY_OF_TAG.get(t, -1) for t in page.tags])
    is_a = np.array([t == "a" for t in page.tags])
    is_p = np.array([t == "p" for t in page.tags], float)
    flags = [_attr_flags(a) if a else 0 for a in page.attrs]
    links[is_a] = 1
    sub, sub_link, sub_marks, count, paras = chars.copy(), np.where(is_a, chars, 0.0), marks.copy(), np.ones(n), is_p.copy()
    n_links, kids, index, depth, above = links.copy(), np.zeros(n), np.zeros(n), np.zeros(n), [0] * n
    boiler_tag = np.isin(family, (1, 2, 3, 4, 5)).astype(float)
    under = np.zeros(n)
    article_above = np.zeros(n)
    for i in range(1, n):
        p = page.parent[i]
        index[i] = kids[p]
        kids[p] += 1
        depth[i] = depth[p] + 1
        above[i] = above[p] | flags[p]
        under[i] = max(under[p], boiler_tag[p])
        article_above[i] = max(article_above[p], float(family[p] == 0))
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        sub[p] += sub[i]
        sub_link[p] += sub[i] if is_a[i] else sub_link[i]
        sub_marks[p] += sub_marks[i]
        count[p] += count[i]
        paras[p] += paras[i]
        n_links[p] += n_links[i]
    up = np.maximum(parent, 0)
    x = np.zeros((n, N_FEATURES), np.float32)
    known = family >= 0
    x[np.flatnonzero(known), family[known]] = 1
    for f in range(N_ATTRS):
        x[:, N_TAGS + f] = [v >> f & 1 for v in flags]
        x[:, N_TAGS + N_ATTRS + f] = [v >> f & 1 for v in above]
    total = max(sub[0], 1.0)
    x[:, -_NUMBERS:] = np.stack([
        np.log1p(sub), np.log1p(chars), sub / total, sub / np.maximum(sub[up], 1.0), np.log1p(sub / count),
        sub_link / np.maximum(sub, 1.0), n_links / count, np.log1p(count), depth, index / np.maximum(kids[up], 1.0),
        np.log1p(kids[up]), np.log1p(paras), sub_marks / np.maximum(sub, 1.0), under, article_above,
        np.log1p(paras[up])], axis=1)
    return x


class Boosted:
    """Gradient-boosted regression trees for the logistic loss, on quantile-binned features, of one fixed depth."""

    def __init__(self, bins: int = 24):
        self.bins, self.trees, self.start, self.edges = bins, [], 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Boosted":
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(self.edges)], axis=1)
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(p / (1 - p)))
        out = np.full(len(y), self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-out))
            tree, leaf = self._grow(binned, p - y, p * (1 - p))
            self.trees.append(tree)
            out += tree[2][leaf]
        return self

    def _grow(self, binned, grad, hess):
        nodes = np.zeros(len(grad), np.int64)
        n_inner = (1 << LEAVES_DEPTH) - 1
        feature, threshold = np.zeros(n_inner, np.int64), np.full(n_inner, np.inf)
        for level in range(LEAVES_DEPTH):
            first = (1 << level) - 1
            at = nodes - first
            width = 1 << level
            best = np.zeros(width)
            cut = np.full(width, self.bins, np.int64)
            g_all = np.bincount(at, grad, width)
            h_all = np.bincount(at, hess, width)
            base = g_all ** 2 / (h_all + 1)
            for j in range(binned.shape[1]):
                size = len(self.edges[j]) + 1
                if size < 2:
                    continue
                key = at * size + binned[:, j]
                g = np.cumsum(np.bincount(key, grad, width * size).reshape(width, size), axis=1)[:, :-1]
                h = np.cumsum(np.bincount(key, hess, width * size).reshape(width, size), axis=1)[:, :-1]
                gain = (g ** 2 / (h + 1) + (g_all[:, None] - g) ** 2 / (h_all[:, None] - h + 1) - base[:, None])
                gain[(h < 1) | (h_all[:, None] - h < 1)] = 0
                k = gain.argmax(axis=1)
                better = gain[np.arange(width), k] > best + 1e-9
                best = np.where(better, gain[np.arange(width), k], best)
                cut = np.where(better, k, cut)
                feature[first:first + width][better] = j
            value = [self.edges[f][c] if b > 0 else np.inf
                     for f, c, b in zip(feature[first:first + width], cut, best)]
            threshold[first:first + width] = value
            # binned <= cut is the same as x <= edge, as searchsorted puts x == edge at the edge's own index
            go = binned[np.arange(len(nodes)), feature[nodes]] > np.where(best > 0, cut, self.bins)[at]
            nodes = 2 * nodes + 1 + go
        leaf = nodes - n_inner
        g, h = np.bincount(leaf, grad, n_inner + 1), np.bincount(leaf, hess, n_inner + 1)
        return (feature, threshold, -SHRINK * g / (h + 1)), leaf

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, threshold, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(LEAVES_DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += value[at - len(feature)]
        return out


def decode(parent: list[int], odds: np.ndarray) -> np.ndarray:
    """Most likely keep/drop choice in which everything below a dropped element is dropped; the root is kept."""
    keep_ll, drop_ll = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    best, gone = keep_ll.tolist(), drop_ll.tolist()
    n = len(parent)
    choice = [True] * n
    for i in range(n - 1, 0, -1):  # children come after their parents
        p = parent[i]
        choice[i] = best[i] > gone[i]
        best[p] += max(best[i], gone[i])
        gone[p] += gone[i]
    keep = [True] * n
    for i in range(1, n):
        keep[i] = choice[i] and keep[parent[i]]
    return np.array(keep)


# ---------------------------------------------------------------- training pages
_KEEP, _DROP = 1, 0


class Grammar:
    """Pages with known article parts, from a list of words."""

    def __init__(self, words: list[str], seed: int = 3):
        self.words, self.rng = words or ["word"], np.random.default_rng(seed)

    def pick(self, options):
        return options[int(self.rng.integers(len(options)))]

    def say(self, low, high) -> str:
        n = int(self.rng.integers(low, high + 1))
        w = [self.words[i] for i in self.rng.integers(len(self.words), size=n)]
        return _html.escape(" ".join(w)) + self.pick((".", "", "."))

    def attr(self, family: int, chance: float) -> str:
        if self.rng.random() > chance:
            return ""
        w = self.pick(ATTR_FAMILIES[family].split())
        extra = self.pick(("", "", "-box", "-1", "-wrap", " col", " block"))
        return f' {self.pick(("class", "class", "id"))}="{w}{extra}"'

    def links(self, low, high) -> str:
        n = int(self.rng.integers(low, high + 1))
        items = "".join(f'<li><a href="/{i}">{self.say(1, 3)}</a></li>' for i in range(n))
        return f"<ul>{items}</ul>" if self.rng.random() < 0.7 else items.replace("<li>", "").replace("</li>", " ")

    def boiler(self) -> str:
        kind = int(self.rng.integers(9))
        if kind == 0:
            tag = self.pick(("nav", "div", "menu", "nav"))
            return f"<{tag}{self.attr(1, 1.0 if tag == 'div' else 0.5)}>{self.links(3, 9)}</{tag}>"
        if kind == 1:
            tag = self.pick(("header", "div"))
            return f"<{tag}{self.attr(2, 1.0 if tag == 'div' else 0.4)}>{self.pick(('', '<h1>' + self.say(1, 4) + '</h1>'))}{self.say(2, 12)}</{tag}>"
        if kind == 2:
            tag = self.pick(("footer", "div", "footer"))
            return f"<{tag}{self.attr(3, 1.0 if tag == 'div' else 0.4)}>{self.pick(('', '&copy; '))}{self.pick(('<p>', ''))}{self.say(3, 25)}</{tag}>"
        if kind == 3:
            tag = self.pick(("aside", "div", "section"))
            inner = self.pick((self.links(3, 7), f"<h3>{self.say(1, 4)}</h3><p>{self.say(5, 40)}</p>"))
            return f"<{tag}{self.attr(4, 1.0 if tag != 'aside' else 0.5)}>{inner}</{tag}>"
        if kind == 4:
            tag = self.pick(("div", "section", "ins", "p"))
            return f"<{tag}{self.attr(5, 1.0)}>{self.say(2, 40)}{self.pick(('', '<a href=/>' + self.say(1, 3) + '</a>'))}</{tag}>"
        if kind == 5:
            tag = self.pick(("div", "section", "p", "dialog"))
            return f"<{tag}{self.attr(6, 1.0)}>{self.say(4, 30)}<button>{self.say(1, 2)}</button></{tag}>"
        if kind == 6:
            tag = self.pick(("div", "section", "ol", "ul"))
            item = "li" if tag in ("ol", "ul") else self.pick(("div", "article", "p", "section"))
            n = int(self.rng.integers(1, 7))
            inner = "".join(f"<{item}{self.attr(7, 0.6)}>{self.pick(('<b>' + self.say(1, 2) + '</b>', ''))}"
                            f"<p>{self.say(3, 60)}</p></{item}>" for _ in range(n))
            return f"<{tag}{self.attr(7, 1.0)}><h2>{self.say(1, 3)}</h2>{inner}</{tag}>"
        if kind == 7:
            return f"<form{self.attr(8, 0.5)}><label>{self.say(1, 4)}</label><input name=q><button>{self.say(1, 2)}</button></form>"
        tag = self.pick(("div", "ul", "p"))
        return f"<{tag}{self.attr(8, 1.0)}>{self.links(2, 6)}</{tag}>"

    def block(self) -> str:
        r = self.rng.random()
        if r < 0.62:
            text = self.say(*self.pick(((1, 6), (8, 60), (20, 140), (60, 400))))
            return self.pick((f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br></p>", f"<p><b>{text}<br>",
                              f"<p>{text} <a href=/x>{self.say(1, 4)}</a> <em>{self.say(1, 9)}</em></p>"))
        if r < 0.72:
            return f"<h{int(self.rng.integers(2, 5))}>{self.say(1, 9)}</h2>"
        if r < 0.80:
            return f"<ul>{''.join(f'<li>{self.say(2, 25)}</li>' for _ in range(int(self.rng.integers(2, 6))))}</ul>"
        if r < 0.86:
            return f"<blockquote>{self.pick(('<p>', ''))}{self.say(6, 60)}</blockquote>"
        if r < 0.91:
            return f"<table><tr><td>{self.say(1, 6)}<td>{self.say(1, 6)}<tr><td>{self.say(1, 6)}<td>{self.say(1, 6)}</table>"
        if r < 0.95:
            return f"<pre>{self.say(5, 60)}</pre>"
        return f"<div>{self.say(10, 120)}</div>"

    def page(self) -> str:
        """Source of a page whose article elements carry data-k."""
        n = int(self.rng.integers(0, 14))
        if self.rng.random() < 0.12:  # bare text, with or without a body and boilerplate around it
            inner = "".join(self.pick((self.block(), self.say(2, 80) + "<br>")) for _ in range(max(1, n // 2)))
            inner = re.sub(r"<([a-z][a-z0-9]*)", r"<\1 data-k", inner)
            return self.pick(("<body data-k>", "<div data-k>", "")) + inner + self.pick(("", "", self.boiler()))
        body = self.pick((f"<h1>{self.say(1, 14)}</h1>", "", f"<header><h1>{self.say(1, 14)}</h1></header>"))
        body = re.sub(r"<(h1|header)", r"<\1", body)
        inner = body + "".join(self.block() for _ in range(n))
        inner = re.sub(r"<([a-z][a-z0-9]*)", r"<\1 data-k", inner)
        inside = self.boiler() if self.rng.random() < 0.25 else ""
        tag = self.pick(("article", "main", "div", "section", "article", "div"))
        inner = f"<{tag} data-k{self.attr(0, 1.0 if tag in ('div', 'section') else 0.4)}>{inner}{inside}</{tag}>"
        for _ in range(int(self.rng.integers(0, 3))):
            tag = self.pick(("div", "main", "section"))
            side = self.boiler() if self.rng.random() < 0.4 else ""
            after = self.boiler() if self.rng.random() < 0.4 else ""
            inner = f"<{tag} data-k{self.attr(0, 0.6)}>{side}{inner}{after}</{tag}>"
        before = "".join(self.boiler() for _ in range(int(self.rng.integers(0, 5))))
        after = "".join(self.boiler() for _ in range(int(self.rng.integers(0, 5))))
        return f"<html><head><title>x</title></head><body data-k>{before}{inner}{after}</body></html>"


def train(words: list[str]) -> Boosted:
    grammar, xs, ys = Grammar(words), [], []
    for _ in range(TRAIN_PAGES):
        page = Page(grammar.page())
        xs.append(features(page))
        ys.append(np.array([True] + ["data-k" in a for a in page.attrs[1:]], float))
    return Boosted().fit(np.concatenate(xs), np.concatenate(ys))


def extract(source: str | None, odds) -> str:
    if not source:
        return ""
    page = Page(source)
    return "\n\n".join(page.blocks(decode(page.parent, odds)))


def extract_main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``page_id, url, text, n_chars``.

    A null or empty page, or one without kept text, gives an empty text; unclosed and unmatched tags are tolerated;
    repeated rows and null ids give a row each; other columns are not read; an empty table gives an empty result."""
    spark = C.prepare(df.sparkSession)
    pages = df.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                      F.col(html_col).cast("string").alias("html"))
    # the first words of a bounded sample of pages, whatever their markup: those of the smallest hashed ids
    known = pages.where("html is not null")
    least = known.select(F.xxhash64("page_id").alias("h")).orderBy("h").limit(MAX_WORD_PAGES).agg(F.max("h")).first()[0]
    some = [] if least is None else (
        known.where(F.xxhash64("page_id") <= least)
        .select(F.slice(F.split(F.regexp_replace("html", "<[^>]*>", " "), r"\s+"), 1, WORDS_PER_PAGE).alias("w"))
        .limit(MAX_WORD_PAGES).collect())
    words = sorted({w for r in some for w in r["w"] if w and "<" not in w and "&" not in w})
    model = C.Shared(spark, train(words))
    kind = dict(pages.dtypes)["page_id"]

    def run(batches):
        for b in batches:
            read = [Page(h) if h else None for h in b.column("html").to_pylist()]
            rows = [features(p) for p in read if p]
            odds = model.value.log_odds(np.concatenate(rows)) if rows else np.empty(0)
            out, at = [], 0
            for p in read:
                if p is None:
                    out.append("")
                    continue
                n = len(p.tags)
                out.append("\n\n".join(p.blocks(decode(p.parent, odds[at:at + n]))))
                at += n
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string()),
                                              pa.array([len(x) for x in out], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])
    return pages.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
