"""Operator 13: parsing, decoding against brute force, given pages, and pages of unseen templates."""

import collections
import html
import itertools
import re
import time

import numpy as np
import pytest

from assay.llm.boosting import train
from assay.llm.dom import node_table, parse
from assay.llm.extraction import MIXED, Template, decode, extract, fit, main_texts, text_of, training_pages
from tests.llm.conftest import SF


def everything(source):
    page = parse(source)
    nodes, _ = node_table(page)
    return text_of(page, nodes, np.ones(len(nodes), bool))


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("plain &amp; &lt;b&gt; &am &eacute;", "plain & <b> &am é"),
        ("<p>one<p>two <b>bold<p>three</b></p>four", "one\ntwo bold\nthree\nfour"),
        ("<ul><li>a<li>b <i>c</i><li></ul>d", "a\nb c\nd"),
        ("x<script>var t='</p><p>no';</script>y<style>p{}</style><title>t</title>", "xy"),
        ("a<!-- <p>no</p> -->b<!-->c", "abc"),
        ("a  \n b<br>c&nbsp;d<br/>e", "a b c d e"),
        ("<p>a <span class='k'>b</span> c</p>", "a b c"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
        ("<div>a<div>b</div>c</div>", "a\nb\nc"),
        ("<p>a < b and 3<4 <a href='x>y'>link</a>", "a < b and 3<4 link"),
        ("<p>cut <a href=\"never closed", "cut"),
        ("<p>cut &quo", "cut &quo"),
        ("</p></div>text</b></html>more", "textmore"),
        ("<head><title>t</title></head><body>b", "b"),
        ("<head><meta charset=x><p>b", "b"),
        ("<form><input><select><option>no</select><button>yes</button></form>", "yes"),
    ],
)
def test_parse(source, text):
    assert everything(source) == text


def test_parse_is_linear():
    for source in ("<div>" * 100_000 + "x", "<p><b>" * 50_000 + "x", "<li>" * 100_000, "<" * 300_000, "<a \"" * 50_000, "</p>" * 100_000, "<!--" * 50_000):
        began = time.time()
        everything(source)
        assert time.time() - began < 20


def test_decode_is_the_best_consistent_choice():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n = int(rng.integers(1, 8))
        parent = np.array([-1, *(int(rng.integers(0, i)) for i in range(1, n))])
        # page order: a node follows its parent, so numbers of parents are smaller
        margin = rng.normal(0, 2, n)
        p = 1 / (1 + np.exp(-margin))
        leaf = [i not in set(parent.tolist()) for i in range(n)]
        best, score = None, -np.inf
        for choice in itertools.product((0, 1, 2), repeat=n):
            if any(c == 2 and leaf[i] for i, c in enumerate(choice)):
                continue
            if any(q >= 0 and choice[q] != 2 and choice[q] != choice[i] for i, q in enumerate(parent.tolist())):
                continue
            total = sum([np.log(1 - p[i]), np.log(p[i]), np.log(0.5) - MIXED][c] for i, c in enumerate(choice))
            if total > score + 1e-9:
                best, score = choice, total
        assert decode(parent, margin).tolist() == [c == 1 for c in best]


def test_trees_learn_interactions():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    trees = train(x[:2000], y[:2000])
    assert ((trees.margin(x[2000:]) > 0) == (y[2000:] > 0.5)).mean() > 0.97
    assert np.isfinite(train(x[:0], y[:0]).margin(x)).all()
    assert np.abs(train(np.ones((50, 2)), np.ones(50)).margin(np.ones((3, 2))) - 6.9).max() < 5


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


@pytest.fixture(scope="module")
def trees(pages):
    return fit(pages)


def article(source):
    """The article element's blocks; the given pages have nothing else in it."""
    body = re.search(r"<article>(.*?)(?:</article>|\Z)", source, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(x for x in blocks if x)


def test_given_pages(pages, trees):
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    got = {r["page_id"]: r for r in extract(pages, trees).collect()}
    assert {i: r["text"] for i, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) and r["url"] for r in got.values())


def test_without_the_article_element(pages, trees):
    """The given pages, their article renamed, with comments, notices and forms of their own text."""
    import random

    wrong = total = 0
    for k, r in enumerate(pages.limit(60).collect()):
        want = article(r["html"])
        rng = random.Random(k)
        made = Template(rng, want.split("\n"), want.split("\n"))
        made.plain = made.bare = False
        extra = made.comments() + made.notice() + made.form()
        source = r["html"].replace("<article>", '<div class="post-content">').replace("</article>", f"</div>{extra}")
        (got,) = main_texts([source], trees)
        a, b = collections.Counter(got.split("\n")), collections.Counter(want.split("\n"))
        wrong += sum(((a - b) + (b - a)).values())
        total += sum(b.values())
    assert wrong < 0.05 * total


def test_unseen_templates(pages, trees):
    """Made-up pages of other seeds: by block, precision and recall."""
    hit = found = there = 0
    for i, r in enumerate(pages.collect()):
        for source in training_pages(r["html"], 10**7 + i)[1:]:
            page = parse(source)
            nodes, _ = node_table(page)
            part = []
            for k, mark in enumerate(page.mark):
                up = part[page.parent[k]] if page.parent[k] >= 0 else False
                part.append(True if 'data-part="1"' in mark else False if 'data-part="0"' in mark else up)
            want = text_of(page, nodes, np.array([part[i] for i in nodes], bool)).split("\n")
            got = main_texts([source], trees)[0].split("\n")
            both = sum((collections.Counter(want) & collections.Counter(got)).values())
            hit, found, there = hit + both, found + len(got), there + len(want)
    assert hit > 0.95 * found and hit > 0.95 * there


def test_extraction_edges(spark, trees):
    rows = [(1, None), (2, ""), (3, "  \n "), (4, "<article></article>"), (None, "<article><p>x</p></article>"), (5, "<article><p>" + "long text, here. " * 100_000),
            (6, "<body><nav><a href=x>m</a></nav><article><h1>Title</h1><p>Some text &amp; more.</p></article>"), (6, "<body><nav><a href=x>m</a></nav><article><h1>Title</h1><p>Some text &amp; more.</p></article>")]
    df = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "CAST(NULL AS STRING) AS url", "1 AS text", "2 AS n_chars", "3 AS seed", "4 AS x")
    got = sorted((r["page_id"], r["text"], r["n_chars"], r["url"]) for r in extract(df, trees).collect())
    long = " ".join(("long text, here. " * 100_000).split())
    want = [(1, ""), (2, ""), (3, ""), (4, ""), (5, long), (6, "Title\nSome text & more."), (6, "Title\nSome text & more.")]
    assert got == [(i, t, len(t), None) for i, t in want]
    assert extract(df.limit(0), trees).collect() == []


def test_training_without_pages(spark, pages):
    none = fit(pages.limit(0))
    assert none.feature.shape[0] > 0
    body = "<nav><ul><li><a href=1>a b</a><li><a href=2>c d</a></ul></nav><article><h1>Head line here</h1><p>Some words of the text, and more of them. They go on.</p><p>More text, as it goes, on and on and on.</p></article><footer>&copy; me</footer>"
    assert main_texts([body], none)[0].startswith("Head line here\nSome words")
