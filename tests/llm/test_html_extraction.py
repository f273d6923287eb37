import itertools

import numpy as np
import pytest

from spendlens.llm import html_extraction as H
from spendlens.llm.labelled_pages import labelled_pages


@pytest.fixture(scope="module")
def learnt():
    return H.model()


def slow_marginals(forest, weights, tables):
    """Over all labellings of one small tree."""
    n = len(forest.parent)
    unary = forest.x @ weights
    total, on = 0.0, np.zeros(n)
    for y in itertools.product((0, 1), repeat=n):
        s = sum(unary[i] for i in range(n) if y[i])
        s += sum(tables[forest.kind[i], y[forest.parent[i]], y[i]] for i in range(n) if forest.parent[i] >= 0)
        total += np.exp(s)
        on += np.exp(s) * np.array(y)
    return on / total, np.log(total)


def test_messages_equal_all_labellings():
    rng = np.random.default_rng(1)
    pages = ["<div><p>a b<p>c <a href=x>d</a></div><ul><li>e</li></ul>", "text<nav><a href=x>y</a></nav>", ""]
    weights, tables = rng.normal(size=H.FEATURES), rng.normal(size=(H._KINDS, 2, 2))
    together = H.Forest([H.Page(p) for p in pages])
    p, _, total = H.marginals(together, weights, tables)
    apart = [slow_marginals(H.Forest([H.Page(h)]), weights, tables) for h in pages]
    assert np.allclose(p, np.concatenate([a for a, _ in apart]))
    assert total == pytest.approx(sum(z for _, z in apart))


def test_held_out_labelled_pages(learnt):
    pages = [H.Page(h) for h in labelled_pages(80, seed=77)]
    forest = H.Forest(pages)
    y, marks = np.zeros(len(forest.parent), int), [m for p in pages for m in p.label]
    for i, up in enumerate(forest.parent.tolist()):
        y[i] = int(marks[i]) if marks[i] is not None else y[up] if up >= 0 else 0
    p, _, _ = H.marginals(forest, *learnt)
    text = forest.is_text
    assert ((p >= 0.5) == y)[text].mean() > 0.98


def test_markup(learnt):
    def text(html):
        return H.main_texts([html], *learnt)[0]

    body = "<p>One  two\nthree &amp; four, &eacute;&#33; five six seven eight.<br>Nine <b>ten<p>Next paragraph of words, it goes on."
    want = "One two three & four, é! five six seven eight. Nine ten\n\nNext paragraph of words, it goes on."
    assert text(f"<html><head><title>T</title><body><nav><a href=/>Home</a></nav><article>{body}</article></html>") == want
    assert text(f"<div class=content>{body}") == want
    assert text(f"<article><script>var a='</p>';</script><style>p{{}}</style><!-- no -->{body}<form>Mail</form></article>") == want
    page = (f"<html><title>T<nothing></title><div class=cookie-notice><p>We use cookies.</p></div><main>{body}</main>"
            "<section class=comments><h2>Comments</h2><div class=comment><p>I do not think so at all, sir.</p></div></section>"
            "<div class=sidebar><p>More words here.</p></div><footer>&copy; 2024</footer>")
    assert text(page) == want
    assert text("") == "" and text("<nav><ul><li><a href=x>Home</a></li></ul></nav>") == ""


def test_dropped_elements_without_end_tags(learnt):
    def text(html):
        return H.main_texts([html], *learnt)[0]

    body = "<p>One two three four, five six seven eight.<p>Next paragraph of words, it goes on."
    want = "One two three four, five six seven eight.\n\nNext paragraph of words, it goes on."
    assert text(f"<article>{body}</article>") == want
    silent = "select><option>a<option>b", "textarea>Note", "svg><g><path>", "map><area>", "template><li>Note"
    for start in ("button>Menu", "button>Menu<button>More", *silent):
        assert text(f"<div><{start}</div><article>{body}</article>") == want, start
        tag = start.split(">")[0]
        assert text(f"<div><{start}</{tag}></div><article>{body}</article>") == want, start
    assert text(f"<article><svg><path>{body}</article>") == want
    items = H.Page("<ul><li>A<template><li>No</li></template>B</ul>")
    assert [t for t in items.text if t] == ["AB"]


def test_only_what_is_named_goes(learnt):
    """Formulas, fallbacks and hidden blocks of an article are text of it."""
    def text(html):
        return H.main_texts([html], *learnt)[0]

    more = "<p>One two three four, five six seven eight.</p><p>Next paragraph of words, it goes on.</p>"
    rest = "One two three four, five six seven eight.\n\nNext paragraph of words, it goes on."
    assert text(f"<article>{more}<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be the sum of all terms, then.</p></article>") \
        == rest + "\n\nLet x=1 be the sum of all terms, then."
    assert text(f"<article>{more}<p hidden>A paragraph that is folded away, but is text.</p></article>") \
        == rest + "\n\nA paragraph that is folded away, but is text."
    for tag in ("noscript", "object", "map"):
        assert text(f"<article>{more}<p>Words <{tag}>and these ones too</{tag}> of the article, all of them.</p></article>") \
            == rest + "\n\nWords and these ones too of the article, all of them."


def test_text_of_the_articles(spark):
    """Whole texts against a plain reading of the pages' one article, on every page of the table."""
    import re
    from html import unescape

    rows = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    wrong = []
    for r in H.main_text(pages).collect():
        article = rows[r.page_id].html.split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|h2|h3|div|li|ul)\b[^>]*>", article)]
        if r.text != "\n\n".join(b for b in blocks if b):
            wrong.append(r.page_id)
    assert len(wrong) <= 0.01 * len(rows)


def test_broken_and_long_pages(learnt):
    odd = ["<", "<a", "&", "&#x110000;", "</div></p>", "<p" * 50, "<div>" * 3000 + "deep", "<b>" * 5000 + "x", "\x00<p>퟿",
           "<p>word " * 20_000, "<!-- open", "<script>open", "<ul><li>a<li>b<table><tr><td>c<td>d"]
    assert len(H.main_texts(odd, *learnt)) == len(odd)
    for h in odd:  # the same alone
        assert H.main_texts([h], *learnt) == H.main_texts([h, "<p>other</p>"], *learnt)[:1]


def test_whole_table_and_odd_rows(spark, small):
    rows = H.main_text(small("pages")).collect()
    html = {r.page_id: r.html for r in small("pages").collect()}
    assert len(rows) == len(html)
    for r in rows:
        assert r.n_chars == len(r.text) > 0
        article = html[r.page_id].split("<article>")[1].split("</article>")[0]
        assert len(r.text.split("\n\n")) == article.count("<p>") + 1 - article.count("<p></p>")
    odd = spark.createDataFrame([(1, None, None, "x"), (1, None, None, "x"), (None, "u", "", "x"), (2, "u", "   ", "x")],
                                "page_id long, url string, html string, text string")
    assert sorted(((r.page_id, r.url, r.text, r.n_chars) for r in H.main_text(odd).collect()), key=str) == sorted(
        [(1, None, "", 0), (1, None, "", 0), (None, "u", "", 0), (2, "u", "", 0)], key=str)
    assert H.main_text(odd.limit(0)).collect() == []
