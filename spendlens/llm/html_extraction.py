"""Main text of web pages by a tree-structured graphical model.

A page's block elements and its text blocks are the nodes of a tree, each main text or not.
A node's own features (tag, names in class, id and role, length, links, punctuation) give its
potential; a table for each kind of child gives the potential of parent and child. Messages
passed upward and then downward (sum-product, exact on trees) yield each node's marginal; a
text block is kept from 0.5 on. The weights are trained on labelled pages by gradient
ascent of the likelihood, whose gradient is features less their expectation under the
marginals. Many pages are inferred together, level by level.

Markup is read to the end whatever it lacks: open elements, dropped ones too, end with their
parent, a block start ends an open paragraph, broken character references stay text.

Defined cases: null html is empty; pages without main text give an empty text; an empty
table gives an empty result; repeated rows are each extracted; further columns are ignored.
"""

from __future__ import annotations

import re
from functools import cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import small_batches
from spendlens.llm.labelled_pages import labelled_pages

_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Markup, scripts, styles, forms and what stands in for players and drawings; everything else may be text.
_SILENT = set("script style template head title svg iframe canvas select option button textarea datalist audio video".split())
#: Parts of drawings that may hold blocks of a page.
_PAGE_INSIDE = set("foreignobject desc title".split())
_INLINE = set("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small "
              "span strike strong sub sup time tt u var wbr noscript object map "
              "math semantics mrow mi mo mn ms mtext mspace msup msub msubsup mfrac msqrt mroot mstyle mover munder munderover "
              "mfenced mpadded menclose mtable mtr mtd mmultiscripts annotation".split())
_GROUPS = ["article main", "nav menu", "header", "footer", "aside", "form fieldset", "ul ol dl", "li dt dd", "p",
           "h1 h2", "h3 h4 h5 h6", "table tbody thead tr", "td th", "blockquote pre figure figcaption", "section", "div",
           "dialog"]
_GROUP = {t: i for i, g in enumerate(_GROUPS) for t in g.split()}
_NAMES = [
    "nav navigation navbar menu breadcrumb breadcrumbs topbar toolbar pagination pager",
    "header masthead banner logo", "footer copyright colophon contentinfo",
    "sidebar aside widget complementary rail", "ad ads advert adverts advertisement sponsor sponsored promo promotion adslot",
    "cookie cookies consent notice gdpr alert popup modal overlay dialog",
    "comment comments reply replies respond responses discussion disqus", "share sharing social follow",
    "related recommended recommendations more teaser trending popular", "newsletter subscribe signup subscription",
    "form search login register contact", "content article post entry story main text body prose", "meta byline tags tag author"]
_NAMED = {n: i for i, g in enumerate(_NAMES) for n in g.split()}
_SPLIT_NAMES = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")

_LEAF = len(_GROUPS) + 1  # after the groups and "other"
_FIRST_NAME = _LEAF + 1
_FIRST_COUNT = _FIRST_NAME + len(_NAMES)
FEATURES = _FIRST_COUNT + 8
#: Kinds of child with a table of their own: text block, text-like, list-like, section-like, the rest.
_KINDS = 5
_KIND = {**dict.fromkeys("p h1 h2 h3 h4 h5 h6 blockquote pre".split(), 1),
         **dict.fromkeys("ul ol dl li dt dd table tbody thead tr td th".split(), 2),
         **dict.fromkeys("article main section div".split(), 3)}


class Page(HTMLParser):
    """A page as arrays: for each node its parent, tag and names; leaves are text blocks."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.names, self.label, self.text, self.linked = [-1], ["body"], [()], [None], [""], [0]
        # block and silent elements; one without a node of its own stands with its parent's
        self.open: list[tuple[str, int]] = [("body", 0)]
        self.inline: list[str] = []
        self.silent = 0  # place of the outermost open element whose content is dropped, if any
        self.links = 0
        self.pieces: list[str] = []
        self.piece_links = 0
        self.feed(html)
        self.close()
        self.flush()

    def node(self, tag: str, names=(), label=None, text="", linked=0) -> int:
        self.parent.append(self.open[-1][1])
        for column, value in zip((self.tag, self.names, self.label, self.text, self.linked), (tag, names, label, text, linked)):
            column.append(value)
        return len(self.parent) - 1

    def flush(self) -> None:
        """Ends a text block."""
        if self.pieces:
            if text := " ".join("".join(self.pieces).split()):
                self.node("#text", text=text, linked=self.piece_links)
            self.pieces, self.piece_links = [], 0

    def push(self, tag: str, node: int, silent: bool = False) -> None:
        if silent and not self.silent:
            self.silent = len(self.open)
        self.open.append((tag, node))

    def cut(self, at: int) -> None:
        """Ends the open elements from ``at`` on."""
        del self.open[at:]
        if self.silent >= at:
            self.silent = 0

    def handle_starttag(self, tag, attrs):
        top, up = self.open[-1]
        if tag == "body" and self.silent:
            self.cut(self.silent)
        elif top == "head" and tag not in _VOID and tag not in _SILENT or tag == top and tag in ("option", "button"):
            self.cut(len(self.open) - 1)  # an end tag that may be left out
        if tag in _SILENT:
            self.push(tag, up, True)
            return
        if tag in _VOID or tag in _INLINE:
            if not self.silent:
                if tag in _VOID:
                    self.pieces.append(" ")
                    if tag == "hr":
                        self.flush()
                elif tag == "a":
                    self.links += 1
                    self.inline.append(tag)
            return
        end = self.ended(tag)
        if 0 < self.silent < end:
            if tag not in ("body", "html"):
                self.cut(end)
                self.push(tag, self.open[-1][1])
            return
        self.flush()
        if tag not in ("body", "html"):
            if end < len(self.open):
                self.cut(end)
                self.links = 0
            attrs = dict(attrs)
            found = " ".join(attrs.get(k) or "" for k in ("class", "id", "role")) if attrs else ""
            names = tuple({_NAMED[n] for n in _SPLIT_NAMES.split(found.lower()) if n in _NAMED}) if found else ()
            self.push(tag, self.node(tag, names, attrs.get("data-y")))

    def ended(self, tag: str) -> int:
        """From where on a start tag ends the open elements by itself."""
        closes = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
                  "th": ("td", "th")}.get(tag, ())
        end = len(self.open)
        if self.silent and tag in _GROUP:  # a block of the page is not part of a drawing
            for i in range(end - 1, self.silent - 1, -1):
                if self.open[i][0] == "svg":
                    end = i
                elif self.open[i][0] in _PAGE_INSIDE:
                    break
        for i in range(end - 1, 0, -1):
            name = self.open[i][0]
            if name == "p" or name in closes:
                end = i
            elif closes and name not in ("ul", "ol", "dl", "table", "div", "section", "article", "template"):
                continue
            else:
                break
        return end

    def handle_endtag(self, tag):
        if tag in _INLINE or tag in _VOID:
            if self.silent:
                return
            if tag == "a" and self.links:
                self.links -= 1
            elif tag == "br":
                self.pieces.append(" ")
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                if 0 < self.silent <= i:
                    self.cut(i)
                    return
                self.flush()
                self.cut(i)
                self.links = 0
                return
        if not self.silent:
            self.flush()

    def handle_data(self, data):
        if not self.silent:
            self.pieces.append(data)
            if self.links:
                self.piece_links += len(data)

    def unknown_decl(self, data):
        pass


class Forest:
    """Many pages' trees in arrays, with features."""

    def __init__(self, pages: list[Page]):
        sizes = [len(p.parent) for p in pages]
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(int)
        self.page = np.repeat(np.arange(len(pages)), sizes)
        parent = np.concatenate([np.array(p.parent) + f for p, f in zip(pages, first)])
        self.parent = np.where(np.concatenate([np.array(p.parent) for p in pages]) < 0, -1, parent)
        tags = [t for p in pages for t in p.tag]
        texts = [t for p in pages for t in p.text]
        n = len(tags)
        depth = np.zeros(n, int)
        for i, up in enumerate(self.parent.tolist()):  # parents stand before children
            if up >= 0:
                depth[i] = depth[up] + 1
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.cumsum(np.bincount(depth))[:-1])
        self.kind = np.array([0 if t == "#text" else _KIND.get(t, 4) for t in tags])
        self.is_text = self.kind == 0

        size = np.array([len(t) for t in texts], float)
        linked = np.minimum(np.array([x for p in pages for x in p.linked], float), size)
        marks = np.array([sum(map(t.count, ".,;:!?")) if t else 0 for t in texts], float)
        blocks = self.is_text.astype(float)
        prose = (size > 80) * (linked < 0.3 * size) * 1.0
        for level in self.levels[:0:-1]:
            for x in (size, linked, marks, blocks, prose):
                np.add.at(x, self.parent[level], x[level])
        x = np.zeros((n, FEATURES))
        x[np.arange(n), [_LEAF if t == "#text" else _GROUP.get(t, _LEAF - 1) for t in tags]] = 1
        for i, names in enumerate(nm for p in pages for nm in p.names):
            for name in names:
                x[i, _FIRST_NAME + name] = 1
        c = _FIRST_COUNT
        x[:, c] = 1
        x[:, c + 1] = np.log1p(size) / 5
        x[:, c + 2] = linked / np.maximum(size, 1)
        x[:, c + 3] = np.minimum(marks / np.maximum(size, 1) * 20, 2)
        x[:, c + 4] = self.is_text * (linked > 0.8 * size)
        x[:, c + 5] = np.log1p(prose)
        x[:, c + 6] = np.log1p(size / np.maximum(blocks, 1)) / 5 * ~self.is_text
        x[:, c + 7] = [bool(t) and t[-1] in ".!?:\"'" for t in texts]
        self.x, self.texts = x, texts


def marginals(forest: Forest, weights: np.ndarray, tables: np.ndarray):
    """Probability of main text for each node, and of each (parent, child) pair of labels; the log likelihood's constant.

    Sum-product in logs: up from the leaves, then down from the roots."""
    own = np.zeros((len(forest.parent), 2))
    own[:, 1] = forest.x @ weights
    belief, message = own.copy(), np.zeros_like(own)
    for level in forest.levels[:0:-1]:
        sent = np.logaddexp.reduce(tables[forest.kind[level]] + belief[level][:, None, :], axis=2)
        message[level] = sent
        np.add.at(belief, forest.parent[level], sent)
    total = np.logaddexp.reduce(belief[forest.levels[0]], axis=1).sum()
    full, pair = belief.copy(), np.zeros((len(own), 2, 2))
    for level in forest.levels[1:]:
        up = forest.parent[level]
        joint = (full[up] - message[level])[:, :, None] + tables[forest.kind[level]] + belief[level][:, None, :]
        full[level] = np.logaddexp.reduce(joint, axis=1)
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        pair[level] = joint / joint.sum(axis=(1, 2), keepdims=True)
    return 1 / (1 + np.exp(np.clip(full[:, 0] - full[:, 1], -50, 50))), pair, total


def train(htmls: list[str], rounds: int = 250, rate: float = 0.1, ridge: float = 1e-3):
    """Weights and tables from pages whose parts carry ``data-y``; what has no mark above it is not main text."""
    pages = [Page(h) for h in htmls]
    forest = Forest(pages)
    y = np.zeros(len(forest.parent), int)
    marks = [m for p in pages for m in p.label]
    for i, up in enumerate(forest.parent.tolist()):
        y[i] = int(marks[i]) if marks[i] is not None else y[up] if up >= 0 else 0
    child = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros((_KINDS, 2, 2))
    np.add.at(seen, (forest.kind[child], y[forest.parent[child]], y[child]), 1)
    theta = np.zeros(FEATURES + seen.size)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    target = forest.x.T @ y
    for step in range(1, rounds + 1):
        weights, tables = theta[:FEATURES], theta[FEATURES:].reshape(seen.shape)
        p, pair, _ = marginals(forest, weights, tables)
        expected = np.zeros_like(seen)
        np.add.at(expected, forest.kind[child], pair[child])
        g = np.concatenate([target - forest.x.T @ p, (seen - expected).ravel()]) / len(pages) - ridge * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta[:FEATURES], theta[FEATURES:].reshape(seen.shape)


@cache
def model():
    return train(labelled_pages())


def main_texts(htmls: list[str], weights: np.ndarray, tables: np.ndarray) -> list[str]:
    forest = Forest([Page(h) for h in htmls])
    p, _, _ = marginals(forest, weights, tables)
    out = [[] for _ in htmls]
    for i in np.flatnonzero(forest.is_text & (p >= 0.5)).tolist():
        out[forest.page[i]].append(forest.texts[i])
    return ["\n\n".join(blocks) for blocks in out]


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text (blocks joined by an empty line), n_chars (code points)."""
    small_batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(model())

    def run(batches):
        weights, tables = shared.value
        for batch in batches:
            htmls = [h or "" for h in batch.column(2).to_pylist()]
            texts = main_texts(htmls, weights, tables)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         F.col(html_col).cast("string").alias("html"))
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
