"""Pages as trees: tolerant HTML parsing, text runs and block breaks, node statistics.

Parsing follows the usual rules where they matter for text: raw text elements end at their own
end tag, paragraphs, list items, cells and options are closed by what cannot be inside them,
end tags of inline elements do not close blocks, unclosed elements end with the page, and what a
page lacks is not made up. Work is linear in the page's length.

The tree's nodes are the elements that hold text and the runs of text in them. Plain inline
elements (links, bold and so on) are part of their run; inline elements with a class, id or role
are nodes of their own, but do not break the block.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np

# HTML's elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
DROPPED = frozenset("script style title textarea xmp iframe noembed noframes template svg math object select option canvas audio video noscript head datalist".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s samp small span strike strong "
    "sub sup time tt u var button output meter progress wbr br img nobr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section summary table ul".split()
)
#: start tag -> (open elements that it closes, elements that it does not look beyond)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
#: What may stand in a page's head.
IN_HEAD = frozenset("base link meta title style script template noscript".split())
P_SCOPE = frozenset("button table td th caption object template html".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTROLS = frozenset("input button select textarea".split())

#: Groups of tags, a feature each for the node and for its ancestors.
TAG_GROUPS = {
    "article": 0, "main": 0, "nav": 1, "menu": 1, "header": 2, "footer": 3, "aside": 4, "form": 5, "fieldset": 5, "button": 5, "label": 5,
    "section": 6, "div": 7, "p": 8, "h1": 9, "h2": 10, "h3": 10, "h4": 10, "h5": 10, "h6": 10, "ul": 11, "ol": 11, "dl": 11, "li": 12,
    "table": 13, "tbody": 13, "tr": 13, "td": 13, "th": 13, "blockquote": 14, "pre": 14, "figure": 14, "body": 15, "html": 15, "#run": 16,
    "dialog": 4, "address": 3,
}
N_TAGS = 18  # the last one: any other
# Attribute tokens by what they usually name.
NAMES = [
    "article post entry story content main text body blogpost hentry articlebody".split(),
    "nav navbar navigation menu breadcrumb breadcrumbs topnav toc pagination pager tabs".split(),
    "header masthead topbar banner logo branding hero site".split(),
    "footer foot copyright legal colophon imprint bottom".split(),
    "sidebar aside side rail widget widgets related recommended trending popular more teaser teasers complementary".split(),
    "ad ads advert advertisement advertising sponsor sponsored promo promotion adsense adslot dfp outbrain taboola affiliate".split(),
    "comment comments reply replies respond discussion disqus commentlist thread feedback".split(),
    "cookie cookies consent gdpr notice alert modal popup overlay paywall warning message newsletter subscribe signup banner".split(),
    "share sharing social follow byline meta tags tag author date login search form contactform contact hidden none sr".split(),
]
NAME_BITS = {t: sum(1 << i for i, g in enumerate(NAMES) if t in g) for g in NAMES for t in g}
N_NAMES = len(NAMES)

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^>]*+(?:>|\Z)", re.S
)
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for t in RAW}
ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|style|aria-hidden|aria-label|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(?=[\s/]|\Z))""", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
PUNCTUATION = re.compile(r"[.,;:!?、。]")


def name_bits(attributes: str) -> tuple[int, bool]:
    """(groups of names in class, id and role, whether there is any of them)."""
    bits, named = 0, False
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), html.unescape((m[2] or "").strip("\"'"))
        if key == "style":
            bits |= NAME_BITS["hidden"] if HIDDEN_STYLE.search(value) else 0
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            bits |= NAME_BITS["hidden"]
        elif key != "aria-hidden":
            named = True
            for word in NAME.findall(value):
                bits |= NAME_BITS.get(word.lower(), 0)
    return bits, named


@dataclass
class Page:
    """Nodes in page order: parallel lists. Runs have tag ``#run``, a text and the number of their block."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    names: list[int] = field(default_factory=list)
    mark: list[str] = field(default_factory=list)  # attributes as written (labels of training pages)
    text: list[str | None] = field(default_factory=list)
    block: list[int] = field(default_factory=list)
    links: list[int] = field(default_factory=list)  # characters inside links, of runs
    tags: list[int] = field(default_factory=list)  # start tags directly inside
    controls: list[int] = field(default_factory=list)
    images: list[int] = field(default_factory=list)

    def add(self, tag: str, parent: int, names: int = 0, mark: str = "", text: str | None = None, block: int = -1) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.names.append(names)
        self.mark.append(mark)
        self.text.append(text)
        self.block.append(block)
        for x in (self.links, self.tags, self.controls, self.images):
            x.append(0)
        return len(self.tag) - 1


def parse(source: str) -> Page:
    page = Page()
    root = page.add("#page", -1)
    stack: list[tuple[str, int, bool]] = [("#page", root, False)]  # tag, nearest node, whether text is dropped
    opened: dict[str, int] = {}
    block, fresh = 0, True  # fresh: the next run begins a block
    run = -1
    parts: list[str] = []
    in_link = 0
    end, at = len(source), 0

    def flush():
        nonlocal run, parts
        if run >= 0:
            page.text[run] = "".join(parts)
        run, parts = -1, []

    def pop():
        nonlocal fresh, in_link
        tag, node, _ = stack.pop()
        opened[tag] -= 1
        if tag == "a":
            in_link -= 1
        if tag not in INLINE:
            flush()
            fresh = True
        elif node != stack[-1][1]:
            flush()

    def write(piece: str):
        nonlocal run, block, fresh
        tag, node, dropped = stack[-1]
        if dropped or not piece:
            return
        if run < 0:
            if fresh and not piece.strip():
                return
            if fresh:
                block, fresh = block + 1, False
            run = page.add("#run", node, block=block)
        parts.append(piece)
        if in_link:
            page.links[run] += len(piece)

    while at < end:
        m = TOKEN.search(source, at)
        piece = source[at : m.start()] if m else source[at:]
        if piece:
            write(html.unescape(piece) if "&" in piece else piece)
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                write(" ")
            if opened.get(tag) and tag not in ("html", "body"):
                depth = len(stack) - 1
                while stack[depth][0] != tag and (tag not in INLINE or stack[depth][0] in INLINE):
                    depth -= 1
                if stack[depth][0] == tag:
                    while len(stack) > depth:
                        pop()
            continue
        if opened.get("head") and tag not in IN_HEAD:
            while opened["head"]:
                pop()
        if tag in ("html", "body") and opened.get(tag):
            continue
        if tag in CLOSES_P and opened.get("p"):
            depth = len(stack) - 1
            while stack[depth][0] != "p" and stack[depth][0] not in P_SCOPE:
                depth -= 1
            if stack[depth][0] == "p":
                while len(stack) > depth:
                    pop()
        if tag in CLOSES:
            closed, barrier = CLOSES[tag]
            if any(opened.get(t) for t in closed):
                depth, found = len(stack) - 1, 0
                while depth > 0 and stack[depth][0] not in barrier:
                    if stack[depth][0] in closed:
                        found = depth
                    depth -= 1
                if found:
                    while len(stack) > found:
                        pop()
        _, node, dropped = stack[-1]
        page.tags[node] += 1
        if tag in CONTROLS:
            page.controls[node] += 1
        if tag in VOID:
            if tag in ("br", "wbr"):
                write(" " if tag == "br" else "")
            elif tag == "img":
                page.images[node] += 1
            elif tag not in INLINE:
                flush()
                fresh = True
            continue
        if tag in RAW:
            if stop := RAW_END[tag].search(source, at):
                at = stop.end()
            else:
                at = end
            continue
        bits, named = name_bits(m[3]) if m[3] else (0, False)
        inline = tag in INLINE
        if not inline:
            flush()
            fresh = True
        if not dropped and (not inline or named or bits or tag in ("button", "label")):
            if inline:
                flush()
            node = page.add(tag, node, bits, m[3])
        opened[tag] = opened.get(tag, 0) + 1
        if tag == "a":
            in_link += 1
        if not m[3].endswith("/") or tag not in ("svg", "math"):
            stack.append((tag, node, dropped or tag in DROPPED))
        else:
            opened[tag] -= 1
    flush()
    return page


# ---- statistics ---------------------------------------------------------------------------

#: Columns of the raw statistics, by node.
RAW_COLUMNS = 26


def node_table(page: Page) -> tuple[np.ndarray, np.ndarray]:
    """(nodes that hold text, in page order; their raw statistics)."""
    n = len(page.tag)
    parent, text = page.parent, page.text
    size, runs, longest, dots, links = [0] * n, [0] * n, [0] * n, [0] * n, list(page.links)
    tags, controls, images = list(page.tags), list(page.controls), list(page.images)
    paragraphs, items, heads = [0] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        tag = page.tag[i]
        if tag == "#run":
            t = text[i]
            size[i] = longest[i] = len(t) if not t.isspace() else 0
            runs[i] = 1
            dots[i] = len(PUNCTUATION.findall(t))
        p = parent[i]
        if p < 0:
            continue
        size[p] += size[i]
        runs[p] += runs[i]
        longest[p] = max(longest[p], longest[i])
        dots[p] += dots[i]
        links[p] += links[i]
        tags[p] += tags[i]
        controls[p] += controls[i]
        images[p] += images[i]
        paragraphs[p] += paragraphs[i] + (tag == "p")
        items[p] += items[i] + (tag == "li")
        heads[p] += heads[i] + (tag in HEADINGS)
    keep = [i for i in range(n) if size[i]]
    place = {i: k for k, i in enumerate(keep)}
    rows = []
    depth, tag_up, name_up, group_of = [0] * n, [0] * n, [0] * n, [0] * n
    seen = 0
    siblings: dict[int, list[int]] = {}
    for i in keep:
        p = parent[i]
        group = TAG_GROUPS.get(page.tag[i], N_TAGS - 1)
        group_of[i] = group
        if p >= 0:
            depth[i] = depth[p] + 1
            tag_up[i] = tag_up[p] | (1 << group_of[p])
            name_up[i] = name_up[p] | page.names[p]
        kin = siblings.setdefault(p, [])
        before = kin[-1] if kin else -1
        kin.append(i)
        rows.append([
            place.get(p, -1), depth[i], size[i], links[i], tags[i], runs[i], longest[i], dots[i], paragraphs[i], items[i], heads[i],
            controls[i], images[i], group, tag_up[i], page.names[i], name_up[i], seen, len(kin) - 1, place.get(before, -1),
            0, 0, -1, size[0], size[p] if p >= 0 else size[0], page.block[i],
        ])
        if page.tag[i] == "#run":
            seen += size[i]
    for kin in siblings.values():
        count: dict[int, int] = {}
        for i in kin:
            count[group_of[i]] = count.get(group_of[i], 0) + 1
        for k, i in enumerate(kin):
            row = rows[place[i]]
            row[20], row[21] = len(kin), count[group_of[i]]
            row[22] = place[kin[k + 1]] if k + 1 < len(kin) else -1
    return np.array(keep, np.int64), np.array(rows, np.float64).reshape(len(rows), RAW_COLUMNS)


def features(raw: np.ndarray, base: np.ndarray) -> np.ndarray:
    """The model's features of nodes (``base``: where a node's page begins, so that pages can be stacked)."""
    if not len(raw):
        return np.zeros((0, N_FEATURES), np.float32)
    c = [raw[:, i] for i in range(RAW_COLUMNS)]
    size = np.maximum(c[2], 1)
    log_size = np.log1p(c[2])
    link_share = c[3] / size

    def of(values: np.ndarray, at: np.ndarray) -> np.ndarray:
        there = np.where(at >= 0, at + base, 0).astype(np.int64)
        return np.where(at >= 0, values[there], -1.0)

    columns = [
        c[1], log_size, link_share, np.log1p(100 * c[4] / size), c[5], log_size - np.log1p(c[5]), np.log1p(c[6]), 100 * c[7] / size,
        c[8], c[9], c[10], c[11], c[12], c[2] / np.maximum(c[23], 1), c[2] / np.maximum(c[24], 1), c[17] / np.maximum(c[23], 1),
        (c[17] + c[2]) / np.maximum(c[23], 1), c[18], c[20], c[21] / np.maximum(c[20], 1), of(link_share, c[19]), of(log_size, c[19]),
        of(link_share, c[22]), of(log_size, c[22]), np.log1p(c[23]),
    ]
    group, tag_up, names, names_up = (c[i].astype(np.int64) for i in (13, 14, 15, 16))
    parent_names = of(names.astype(np.float64), c[0]).astype(np.int64)
    parent_group = of(group.astype(np.float64), c[0])
    columns += [group == k for k in range(N_TAGS)] + [(tag_up >> k) & 1 for k in range(7)]
    columns += [(x >> k) & 1 for x in (names, names_up) for k in range(N_NAMES)]
    columns += [np.where(parent_names < 0, 0, (parent_names >> k) & 1) for k in range(N_NAMES)]
    columns.append(parent_group)
    return np.stack([x.astype(np.float32) for x in columns], axis=1)


N_FEATURES = 25 + N_TAGS + 7 + 3 * N_NAMES + 1
