"""Main text of web pages by boosted trees over DOM nodes and hierarchical decoding (operator 13).

Every node that holds text gets features - subtree density, link share, depth, sibling
statistics, groups of attribute tokens, its own and its ancestors' tags - and boosted trees give
the log odds that it belongs to the main text. Decoding then chooses for each node *in* (its
whole subtree is main text), *out* (nothing of it is) or *mixed* (its children decide), so that
the choices of ancestors and descendants cannot contradict each other and the sum of the nodes'
log likelihoods is the largest possible; a mixed node counts as an even chance and pays a small
penalty. It is exact: two passes over the tree.

The trees are trained on a bounded sample: the ``max_pages`` pages with the smallest hash of
their id, of at most ``max_bytes`` each. A page whose article or main element says what is main
text gives its own nodes, and its passages are dealt again into pages of random templates - other
wrappers and class names, with and without semantic tags, unclosed elements, menus, headers,
sidebars, adverts, notices, forms, footers and reader comments made of the same kind of passages -
whose labels are known. So wording decides nothing, and one missing tag or name can be made up
for by the others. Extraction covers every page and the whole html.

Blocks are runs of text between boundaries of block elements; character references are decoded,
white space inside a block becomes one blank, blocks are trimmed, empty ones left out, and the
rest is joined in page order by line feeds.

Edge cases: null and empty html have the empty text; rows with a null page_id are left out, rows
that repeat an id are extracted separately; pages cut in the middle end where they end; very long
pages are parsed whole in linear time; without sample pages the trees learn from templates around
a few filler words; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.boosting import Trees, train
from assay.llm.common import small_batches, steady, table, written
from assay.llm.dom import N_FEATURES, Page, features, node_table, parse

#: Bounds of the training sample: pages, bytes of a page, made-up pages for each, and nodes for the trees.
MAX_PAGES = 150
MAX_BYTES = 64 << 10
VARIANTS = 4
MAX_NODES = 30_000
#: What a node pays for being mixed, besides an even chance's log likelihood.
MIXED = 0.7
LABEL = "data-part"

FILLER = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua".split()


# ---- decoding -----------------------------------------------------------------------------


def decode(parent: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """Whether each node is *in*, for nodes in page order (``parent``: place of the parent, or -1)."""
    n = len(parent)
    p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
    inside, outside = np.log(np.maximum(p, 1e-9)).tolist(), np.log(np.maximum(1 - p, 1e-9)).tolist()
    mixed = [np.log(0.5) - MIXED] * n
    leaf = [True] * n
    up = parent.tolist()
    best = [0.0] * n
    choice = [0] * n
    for i in range(n - 1, -1, -1):
        options = (outside[i], inside[i], -np.inf if leaf[i] else mixed[i])
        choice[i] = max(range(3), key=options.__getitem__)
        best[i] = options[choice[i]]
        if up[i] >= 0:
            inside[up[i]] += inside[i]
            outside[up[i]] += outside[i]
            mixed[up[i]] += best[i]
            leaf[up[i]] = False
    for i in range(n):
        if up[i] >= 0 and choice[up[i]] != 2:
            choice[i] = choice[up[i]]
    return np.array(choice, np.int64) == 1


def text_of(page: Page, nodes: np.ndarray, keep: np.ndarray) -> str:
    """The kept runs' blocks, joined by line feeds."""
    blocks: dict[int, list[str]] = {}
    for i in nodes[keep].tolist():
        if page.tag[i] == "#run":
            blocks.setdefault(page.block[i], []).append(page.text[i])
    lines = (" ".join("".join(parts).split()) for _, parts in sorted(blocks.items()))
    return "\n".join(x for x in lines if x)


def main_texts(sources: list[str], trees: Trees) -> list[str]:
    """The main text of every page; nodes of many pages are scored together."""
    out: list[str] = []
    pages, tables, count = [], [], 0

    def finish():
        nonlocal pages, tables, count
        if not pages:
            return
        sizes = [len(t) for _, t in tables]
        base = np.repeat(np.cumsum([0, *sizes[:-1]]), sizes)
        margin = trees.margin(features(np.concatenate([t for _, t in tables]), base))
        at = 0
        for page, (nodes, raw) in zip(pages, tables, strict=True):
            keep = decode(raw[:, 0].astype(np.int64), margin[at : at + len(raw)])
            out.append(text_of(page, nodes, keep))
            at += len(raw)
        pages, tables, count = [], [], 0

    for source in sources:
        page = parse(source or "")
        found = node_table(page)
        pages.append(page)
        tables.append(found)
        count += len(found[0])
        if count >= 20_000:
            finish()
    finish()
    return out


# ---- training pages -------------------------------------------------------------------------


def passages(page: Page) -> tuple[list[str], list[str]] | None:
    """(passages of the main text, other passages) of a page with one article or main element of some length."""
    marked = [i for i, t in enumerate(page.tag) if t in ("article", "main")]
    tops = [i for i in marked if not any(page.tag[a] in ("article", "main") for a in _ancestors(page, i))]
    if len(tops) != 1:
        return None
    inner, other = [], []
    for i, t in enumerate(page.tag):
        if t == "#run":
            text = " ".join(page.text[i].split())
            if text:
                (inner if tops[0] in _ancestors(page, i) else other).append(text)
    return (inner, other) if inner else None


def _ancestors(page: Page, i: int) -> list[int]:
    out = []
    while (i := page.parent[i]) >= 0:
        out.append(i)
    return out


class Template:
    """A random page around given passages; ``data-part`` marks main text (1) and the rest (0)."""

    def __init__(self, rng: random.Random, main: list[str], other: list[str]):
        self.rng, self.main, self.other = rng, main, other
        self.plain = rng.random() < 0.3  # divisions instead of semantic elements
        self.bare = rng.random() < 0.2  # no names on boilerplate
        self.tight = rng.random() < 0.3  # end tags left out

    def words(self, low: int, high: int) -> str:
        source = self.rng.choice(self.main + self.other) if self.rng.random() < 0.9 else " ".join(FILLER)
        words = source.split() or FILLER
        n, at = self.rng.randint(low, high), self.rng.randrange(len(words))
        return html.escape(" ".join((words[at:] + words)[:n]))

    def tag(self, semantic: str, names: str, body: str, part: int | None = 0) -> str:
        rng = self.rng
        tag = rng.choice(["div", "div", "section"]) if self.plain or rng.random() < 0.25 else semantic
        attributes = ""
        if names and (tag in ("div", "section", "p", "span") and not self.bare or rng.random() < 0.3):
            name = rng.choice(names.split())
            name = rng.choice([name, name, f"{name} {rng.choice(['wrap', 'box', 'inner', 'c-1', 'left', 'block'])}", f"site-{name}", f"{name}-{rng.randint(1, 9)}"])
            attributes = f' {rng.choice(["class", "class", "id"])}="{name}"'
        mark = "" if part is None else f' {LABEL}="{part}"'
        return f"<{tag}{attributes}{mark}>{body}</{tag}>"

    def links(self, low: int, high: int, kind: str = "") -> str:
        rng = self.rng
        entries = [f'<a href="/{i}">{self.words(1, 4)}</a>' for i in range(rng.randint(low, high))]
        kind = kind or rng.choice(["ul", "ul", "ol", "div", "p"])
        if kind in ("ul", "ol"):
            closing = "" if self.tight else "</li>"
            return f"<{kind}>{''.join(f'<li>{e}{closing}' for e in entries)}</{kind}>"
        return f"<{kind}>{rng.choice([' ', ' | ', ' &middot; ']).join(entries)}</{kind}>"

    def paragraphs(self, count: int, low: int = 5, high: int = 50) -> str:
        return "".join(f"<p>{self.words(low, high)}</p>" for _ in range(count))

    # -- boilerplate

    def menu(self) -> str:
        return self.tag("nav", "nav navbar menu navigation topnav", self.links(2, 9))

    def header(self) -> str:
        body = f"<a href=\"/\">{self.words(1, 3)}</a>" + (f"<p>{self.words(2, 8)}</p>" if self.rng.random() < 0.5 else "")
        return self.tag("header", "header masthead banner topbar branding", body + (self.menu() if self.rng.random() < 0.5 else ""))

    def footer(self) -> str:
        body = f"&copy; {self.rng.choice(['2024 ', ''])}{self.words(2, 12)}"
        if self.rng.random() < 0.5:
            body = f"<p>{body}</p>" + self.links(2, 6)
        return self.tag("footer", "footer copyright legal colophon foot", body)

    def sidebar(self) -> str:
        body = "".join(
            f"<h3>{self.words(1, 4)}</h3>" + (self.links(2, 7) if self.rng.random() < 0.6 else self.paragraphs(self.rng.randint(1, 3), 4, 40))
            for _ in range(self.rng.randint(1, 3))
        )
        return self.tag("aside", "sidebar aside widget rail related recommended", body)

    def advert(self) -> str:
        inner = self.rng.choice([self.words(2, 30), f"<p>{self.words(3, 30)}</p>", f'<a href="/x">{self.words(2, 12)}</a>', f"<b>{self.words(1, 4)}</b> {self.words(3, 20)}"])
        return self.tag("aside", "ad ads advert advertisement sponsored promo promotion sponsor", inner)

    def notice(self) -> str:
        button = f"<button>{self.words(1, 2)}</button>" if self.rng.random() < 0.6 else ""
        return self.tag("div", "cookie consent notice alert modal popup newsletter subscribe paywall banner message", f"<p>{self.words(4, 35)}</p>{button}")

    def form(self) -> str:
        fields = "".join(f"<label>{self.words(1, 3)}</label><input name=\"f{i}\">" for i in range(self.rng.randint(1, 4)))
        note = f"<p>{self.words(3, 25)}</p>" if self.rng.random() < 0.5 else ""
        return f'<form action="/s" {LABEL}="0">{note}{fields}<button>{self.words(1, 2)}</button></form>'

    def comments(self) -> str:
        rng = self.rng
        kind, name = rng.choice(["div", "article", "li", "div"]), rng.choice(["comment", "reply", "comment-body", "comment even"])
        one = []
        for _ in range(rng.randint(1, 6)):
            who = rng.choice([f"<b>{self.words(1, 2)}</b>", f"<h4>{self.words(1, 2)}</h4>", f'<span class="author">{self.words(1, 2)}</span>', ""])
            text = rng.choice([self.words(3, 60), self.paragraphs(rng.randint(1, 3), 4, 60), self.paragraphs(1, 3, 60)])
            one.append(f'<{kind} class="{name}">{who}{text}</{kind}>')
        body = "".join(one)
        body = f"<ol>{body}</ol>" if kind == "li" else body
        title = f"<{(h := rng.choice(['h2', 'h3']))}>{self.words(1, 3)}</{h}>" if rng.random() < 0.7 else ""
        return self.tag("section", "comments commentlist responses discussion comment-list replies", title + body + (self.form() if rng.random() < 0.4 else ""))

    def share(self) -> str:
        return self.tag("div", "share social sharing follow meta tags byline", self.links(2, 5) if self.rng.random() < 0.6 else f"<span>{self.words(1, 5)}</span>")

    def hidden(self) -> str:
        return f'<div {self.rng.choice(["hidden", "style=\"display:none\"", "aria-hidden=\"true\""])} {LABEL}="0"><p>{self.words(2, 30)}</p></div>'

    def any(self) -> str:
        return self.rng.choice([self.advert, self.advert, self.notice, self.share, self.sidebar, self.form, self.menu, self.hidden])()

    # -- the main text

    def content(self) -> str:
        rng = self.rng
        closing = "" if self.tight else "</p>"
        if rng.random() < 0.3:
            chosen = list(self.main)
        else:
            chosen = [" ".join(html.unescape(self.words(3, 90)).split()) for _ in range(rng.randint(1, 12))]
        out = [f"<{(h := rng.choice(['h1', 'h1', 'h2']))}>{self.words(2, 12)}</{h}>"] if rng.random() < 0.8 else []
        for text in chosen:
            text = html.escape(text)
            words = text.split()
            shape = rng.random()
            if shape < 0.1 and len(words) > 6:
                k = rng.randrange(1, len(words) - 2)
                text = " ".join([*words[:k], f'<a href="/r">{words[k]}</a>', *words[k + 1 :]])
            elif shape < 0.2:
                text = f"<{(b := rng.choice(['b', 'em', 'strong']))}>{text}" + ("" if self.tight else f"</{b}>")
            elif shape < 0.25:
                text = text + "<br>" + self.words(2, 12)
            form = rng.random()
            if form < 0.72:
                out.append(f"<p>{text}{closing}")
            elif form < 0.78:
                out.append(f"<h{(k := rng.randint(2, 4))}>{self.words(2, 8)}</h{k}><p>{text}</p>")
            elif form < 0.84:
                out.append("<ul>" + "".join(f"<li>{self.words(3, 20)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
            elif form < 0.89:
                out.append(f"<blockquote>{rng.choice([text, f'<p>{text}</p>'])}</blockquote>")
            elif form < 0.92:
                out.append(f"<figure><img src=\"i.png\"><figcaption>{self.words(3, 15)}</figcaption></figure>")
            elif form < 0.95:
                out.append("<table>" + "".join(f"<tr><td>{self.words(1, 4)}</td><td>{self.words(1, 4)}</td></tr>" for _ in range(rng.randint(1, 4))) + "</table>")
            elif form < 0.97:
                out.append(f"<pre>{text}</pre>")
            else:
                out.append(f"<div>{text}</div>")
            if rng.random() < 0.05:
                out.append(self.any())
        return "".join(out)

    def page(self) -> str:
        rng = self.rng
        body = self.content()
        for _ in range(rng.choice([0, 0, 1, 2])):
            body += rng.choice([self.any, self.comments, self.share, self.footer])()
        names = "article post entry content story main-content post-content article-body body text"
        body = self.tag(rng.choice(["article", "article", "main", "div"]), names, body, 1)
        for _ in range(rng.choice([0, 0, 1, 2])):
            extra = "".join(rng.choice([self.any, self.comments, self.sidebar])() for _ in range(rng.choice([0, 0, 1])))
            body = self.tag(rng.choice(["main", "div", "section"]), rng.choice(["content main", "wrapper page container", ""]), body + extra, None)
        before = [f() for f in (self.header, self.menu, self.advert, self.notice, self.sidebar) if rng.random() < 0.45]
        after = [f() for f in (self.comments, self.sidebar, self.advert, self.form, self.notice, self.share, self.footer) if rng.random() < 0.4]
        rng.shuffle(before)
        end = "</body></html>" if rng.random() < 0.8 else ""
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 9)}</title></head><body>{''.join(before)}{body}{''.join(after)}{end}"


def labelled(source: str) -> tuple[np.ndarray, np.ndarray]:
    """(features, share of main text) of the nodes of a page: by ``data-part``, else by its article or main element."""
    page = parse(source)
    nodes, raw = node_table(page)
    marks = LABEL in source
    part = [0] * len(page.tag)
    for i, tag in enumerate(page.tag):
        up = part[page.parent[i]] if page.parent[i] >= 0 else 0
        if marks:
            part[i] = 1 if f'{LABEL}="1"' in page.mark[i] else 0 if f'{LABEL}="0"' in page.mark[i] else up
        else:
            part[i] = 1 if tag in ("article", "main") else 0 if tag in ("nav", "aside", "footer", "form") else up
    total, good = np.zeros(len(page.tag)), np.zeros(len(page.tag))
    for i in range(len(page.tag) - 1, -1, -1):
        if page.tag[i] == "#run":
            total[i] = len(page.text[i])
            good[i] = total[i] * part[i]
        if page.parent[i] >= 0:
            total[page.parent[i]] += total[i]
            good[page.parent[i]] += good[i]
    return features(raw, np.zeros(len(raw), np.int64)), good[nodes] / np.maximum(total[nodes], 1)


def training_pages(source: str, seed: int, variants: int = VARIANTS) -> list[str]:
    """The page itself if an element marks its main text, and made-up pages of its passages."""
    found = passages(parse(source))
    own, (main, other) = ([source], found) if found else ([], ([" ".join(FILLER)], [" ".join(FILLER[:5])]))
    return own + [Template(random.Random(seed * 1000 + k), main, other or main).page() for k in range(variants)]


def _labelled_nodes(variants: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds, out_x, out_y, out_o = batch.column("seed").to_pylist(), [], [], []
            for seed, source in zip(seeds, batch.column("html").to_pylist(), strict=True):
                for k, page in enumerate(training_pages(source or "", seed, variants)):
                    x, y = labelled(page)
                    out_x += [r.tobytes() for r in x]
                    out_y += y.tolist()
                    out_o += [seed * 100 + k] * len(y)
            yield pa.RecordBatch.from_arrays([pa.array(out_o, pa.int64()), pa.array(out_x, pa.binary()), pa.array(out_y, pa.float64())], ["o", "x", "y"])

    return rows


def fit(pages: DataFrame, max_pages: int = MAX_PAGES, max_bytes: int = MAX_BYTES, variants: int = VARIANTS, max_nodes: int = MAX_NODES) -> Trees:
    """Trees trained on a bounded sample of ``pages`` (page_id, html)."""
    sample = written(
        pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("html", F.lit("")).alias("html"))
        .where("page_id IS NOT NULL").where(F.octet_length("html") <= max_bytes)
        .select(F.pmod(F.xxhash64("page_id"), F.lit(1 << 30)).alias("seed"), "page_id", "html")
        .orderBy("seed", "page_id", F.sha2("html", 256)).limit(max_pages),
        "sample-pages",
    ).repartition(8, "seed")
    nodes = sample.mapInArrow(steady(_labelled_nodes(variants)), "o long, x binary, y double").orderBy(F.xxhash64("o", "x"), "o", "x", "y").limit(max_nodes).toArrow()
    x = np.frombuffer(b"".join(nodes.column("x").to_pylist()), np.float32).reshape(-1, N_FEATURES)
    y = nodes.column("y").to_numpy()
    if not len(y):
        made = [labelled(p) for k in range(40) for p in training_pages("", k, variants)]
        x, y = np.concatenate([a for a, _ in made]), np.concatenate([b for _, b in made])
    return train(x, y)


# ---- the operator ----------------------------------------------------------------------------


def _extract(trees: Trees):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = main_texts(batch.column("html").to_pylist(), trees)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return rows


def extract(pages: DataFrame, trees: Trees) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").where("page_id IS NOT NULL")
    return small_batches(rows).mapInArrow(steady(_extract(trees)), "page_id long, url string, text string, n_chars long")


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages))
