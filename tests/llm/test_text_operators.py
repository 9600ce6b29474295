"""Operators 1, 3, 4 and 9 against brute force on given documents and the edge table."""

import collections
import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from assay.llm import jaccard_join, substring_dedup
from assay.llm.common import holding, maybe_in, string_buffer
from assay.llm.components import components
from assay.llm.decontaminate import contamination
from assay.llm.jaccard_join import near_duplicates
from assay.llm.quality import CONSISTENT, LEAST_SPREAD, distances, judged
from assay.llm.substring_dedup import dedup_substrings
from tests.llm.conftest import SF, WORD, lower

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect() if r["doc_id"] is not None]


# ---- substring dedup --------------------------------------------------------------


def brute_substrings(rows, k=13):
    first = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = WORD.findall(t or "")
        for j in range(len(w) - k + 1):
            first.setdefault(tuple(w[j : j + k]), i)
    out = []
    for i, t in rows:
        w, gone = WORD.findall(t or ""), set()
        for j in range(len(w) - k + 1):
            if first[tuple(w[j : j + k])] < i:
                gone.update(range(j, j + k))
        out.append((i, len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone))))
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 50_000, "shard_words": 5_000}])
def test_substrings(documents, sizes):
    assert sorted(map(tuple, dedup_substrings(documents, **sizes).collect())) == brute_substrings(rows_of(documents))


def test_substrings_edges(edges, empty):
    assert sorted(map(tuple, dedup_substrings(edges).collect())) == brute_substrings(rows_of(edges))
    assert dedup_substrings(empty).collect() == []


def test_substrings_split_a_hot_anchor(spark):
    """A short passage among words of each document's own: its segments differ, and must not meet in one shard."""
    rows = [(i, " ".join([f"a{i}x{j}" for j in range(9)] + [f"p{j}" for j in range(8)] + [f"b{i // 2}x{j}" for j in range(9)])) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, dedup_substrings(docs, block_bytes=20_000, shard_words=1_000, sample=1).collect())) == brute_substrings(rows)
    hot = substring_dedup.hot_anchors(docs, 13, 4, 100, 1)
    assert 0 < len(hot) < 20
    buf, offs = string_buffer(pa.array([t for _, t in rows]))
    ids = np.arange(len(rows))
    shards = [substring_dedup.segments(ids, buf, offs, 40, 13, 4, False, some).shard for some in (hot[:0], hot)]
    largest = [np.bincount(x, minlength=40).max() for x in shards]
    assert largest[0] >= 300 and largest[1] < 2.5 * len(shards[1]) / 40


def test_substrings_beside_a_very_long_word(spark):
    """A word's hash does not depend on the length of other words of its block."""
    shared = " ".join(f"w{j}" for j in range(20))
    rows = [(i, f"a{i} {shared}  b{i}" + (" " + "x" * 5000 if i == 7 else "")) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, dedup_substrings(docs, block_bytes=1_000, shard_words=500).collect())) == brute_substrings(rows)


def test_substrings_sort_ties_only(monkeypatch):
    """Suffixes are in order to the depth of a window, and those that are told apart are not sorted again."""
    text = np.random.default_rng(3).integers(1, 5000, 8000)
    text[4000:4200], text[6000:6100], text[::17] = text[:200], 7, 0
    entries = []
    for name in ("sort", "argsort", "lexsort"):
        real = getattr(np, name)
        monkeypatch.setattr(np, name, lambda x, *a, real=real, **k: entries.append(np.size(x)) or real(x, *a, **k))
    order = substring_dedup.suffix_order(text, 13)
    monkeypatch.undo()
    symbols = text.tolist()
    assert order.tolist() == sorted(range(len(text)), key=lambda i: (symbols[i : i + 13], i))
    assert len(text) <= sum(entries) < 2 * len(text)
    first, second, at = text % 5, text % 3, np.arange(len(text))
    for x, y in zip(substring_dedup._sorted(first, second, at, 8000), substring_dedup._sorted(first, second, at, 1 << 30), strict=True):
        assert (x == y).all()


# ---- decontamination ----------------------------------------------------------------


def brute_contamination(docs, items, k=10):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = ALNUM.findall(lower(t))
        n = min(k, len(w))
        for j in range(len(w) - n + 1) if n else ():
            windows[tuple(w[j : j + n])].add(str(i))
    sizes = {len(x) for x in windows}
    out = []
    for i, t in docs:
        w, hit, found = ALNUM.findall(lower(t)), set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[tuple(w[j : j + n])]
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return sorted(out)


def test_contamination(spark, documents):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute_contamination(rows_of(documents), [(r["item_id"], r["text"]) for r in items.collect()])
    got = contamination(documents, items).drop("items")
    assert sorted(map(tuple, got.collect())) == want
    assert any(r[5] for r in want)


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_contamination_edges(spark, edges, empty, broadcast_rows):
    items = [(1, "shared3 SHARED4 shared5"), (2, None), (3, ""), (4, "one"), (None, "two"), (5, "x y shared0 shared1 shared2 "
             "shared3 shared4 shared5 shared6 shared7 shared8 shared9"), (5, "same same"), (6, "same same")]  # fmt: skip
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS words", "3 AS h")
    want = brute_contamination(rows_of(edges), [r for r in items if r[0] is not None])
    got = contamination(edges, bench, broadcast_rows=broadcast_rows).drop("items").distinct()
    assert sorted(map(tuple, got.collect())) == sorted(set(want))
    assert contamination(empty, bench).collect() == []
    assert not any(r["contaminated"] for r in contamination(edges, bench.limit(0)).collect())


def test_contamination_counts_words_without_a_pattern(spark, edges):
    """A pattern over every text costs more than the rest of the query; counting by it is left to the test."""
    bench = spark.createDataFrame([(1, "shared3 shared4")], "item_id long, text string")
    texts = ["", " ", "a", "a-b_c", "Az09 \x7f\x00{é}ñ 日本、語", "x" * 5000 + " y", None, "end ", " lead"]
    docs = edges.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    out = contamination(docs, bench)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "regexp" not in plan.lower()
    want = sorted((i, len(ALNUM.findall(lower(t)))) for i, t in rows_of(docs))
    assert sorted((r["doc_id"], r["n_words"]) for r in out.collect()) == want


# ---- Jaccard join ----------------------------------------------------------------------


def brute_components(rows, k=4, num=85, den=100):
    sets = []
    for _, t in rows:
        w = WORD.findall(lower(t))
        sets.append({tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for a, s in enumerate(sets):
        shared = collections.Counter(b for x in s for b in holders[x])
        for b, n in shared.items():
            if den * n >= num * (len(s) + len(sets[b]) - n):
                x, y = find(rows[a][0]), find(rows[b][0])
                parent[max(x, y)] = min(x, y)
        for x in s:
            holders[x].append(a)
    return sorted((i, len(s), find(i)) for (i, _), s in zip(rows, sets, strict=True))


def test_jaccard(documents):
    assert sorted(map(tuple, near_duplicates(documents).collect())) == brute_components(rows_of(documents))


def test_jaccard_edges(edges, empty):
    assert sorted(map(tuple, near_duplicates(edges).collect())) == brute_components(rows_of(edges))
    assert near_duplicates(empty).collect() == []


def test_jaccard_large_groups(spark, monkeypatch):
    """A family of edited copies in one group: stars, and pairs left for the second round."""
    import random

    rng, base = random.Random(5), [f"t{i}" for i in range(150)]
    rows = []
    for i in range(220):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4, 6])):
            w[rng.randrange(len(w))] = f"e{rng.randrange(40)}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(jaccard_join, "SMALL_GROUP", 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_components(rows)
    assert sorted(map(tuple, near_duplicates(docs).collect())) == want
    assert len({c for _, _, c in want}) > 1


def family(seed, count, edits, words=150, pool=40):
    """Copies of one text, each with some words replaced."""
    import random

    rng, base, rows = random.Random(seed), [f"t{i}" for i in range(words)], []
    for i in range(count):
        w = list(base)
        for _ in range(rng.choice(edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(pool)}"
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("sizes", [{"UNIT_TOKENS": 3000}, {"UNIT_TOKENS": 2000, "MOST_PARTS": 3}, {"LEAST_MARKS": 1, "mark_orders": lambda n, num, den: 1}])
def test_jaccard_blocks_and_weak_filters(spark, monkeypatch, sizes):
    """Families in blocks; families too large, compared by group in blocks; filters that let nearly all pairs pass."""
    monkeypatch.setattr(jaccard_join, "SMALL_GROUP", 2)
    for name, value in sizes.items():
        monkeypatch.setattr(jaccard_join, name, value)
    rows = family(5, 120, [2, 3, 4, 5, 6])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_components(rows)
    assert sorted(map(tuple, near_duplicates(docs).collect())) == want
    assert 1 < len({c for _, _, c in want}) < len(rows)


def test_jaccard_links_grow_with_members():
    """In a family without links, and in one where all are linked, no more links than members are made, and they span all."""
    for edits in ([14], [1], [2, 5, 8]):
        for count in (100, 300):
            rows = family(3, count, edits, pool=4000)
            buf, offs = string_buffer(pa.array([t for _, t in rows]))
            sets = [s for _, s in jaccard_join.shingle_sets(buf, offs, 4)]
            found = jaccard_join.unit_links(np.arange(count), sets, np.zeros(count), 85, 100)
            want = len(rows) - len({c for _, _, c in brute_components(rows)})
            assert len(found) == want < count


def test_marks_allow_every_link():
    """Prefixes that differ are never more than tokens that differ, at every size."""
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 9, 40, 300, 3000):
        base = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for lost in {0, 1, n // 20, n // 12}:
            other = np.unique(np.concatenate((base[lost:], rng.integers(0, 2**63, lost).astype(np.uint64))))
            if lost < len(base) and len(other):
                m = jaccard_join.folded([jaccard_join.marks(x, 85, 100) for x in (base, other)])
                assert (m[0] != m[1]).sum() <= len(np.setxor1d(base, other))


def test_parities_allow_every_link():
    """Pairs that are linked pass in sets of all sizes, and every one lies within the forest's components."""
    rng = np.random.default_rng(2)
    sets = []
    for n in (1, 3, 9, 60, 61, 400, 700, 3000):
        base = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for lost in (0, n // 40, n // 20, n // 9, n // 2):
            sets.append(np.unique(np.concatenate((base[lost:], rng.integers(0, 2**63, lost // 2).astype(np.uint64)))))
    n = np.array([len(s) for s in sets])
    order = rng.permutation(len(sets))
    for block in (np.zeros(len(sets), np.int64), np.arange(len(sets)) % 2):
        pairs = jaccard_join.fitting_pairs(order, n, [jaccard_join.parities(s, 80, 100) for s in sets], block, 80, 100)
        assert len(pairs) < len(sets)
        root = {int(i): int(i) for i in order}
        for a, b in pairs:
            root = {i: root[a] if r == root[b] else r for i, r in root.items()}
        links = 0
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)) and (block[i] != block[j] or not block.any()):
                    links += 1
                    assert root[int(order[i])] == root[int(order[j])]
        assert links


def test_jaccard_common_passages_bind_no_families(spark, tmp_path):
    """Documents that only share passages are never compared by their texts, however many they are."""
    import random

    rng = random.Random(4)
    passages = [" ".join(f"p{i}x{j}" for j in range(40)) for i in range(12)]
    rows = [(i, " ".join([*(f"w{rng.randrange(10**6)}" for _ in range(60)), *rng.sample(passages, 3)])) for i in range(200)]
    rows += [(1000 + i, t + f" tail{i}") for i, t in rows[:5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    seen, units = [], jaccard_join.units

    def spy(*args):
        out = units(*args)
        seen.append({(r["f"], r["doc"]) for r in out.collect()})
        return out

    jaccard_join.units = spy
    try:
        got = sorted(map(tuple, near_duplicates(docs).collect()))
    finally:
        jaccard_join.units = units
    assert got == brute_components(rows)
    assert sorted(d for _, d in seen[0]) == sorted([*range(5), *range(1000, 1005)])


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 9), (20, 21), (21, 20), (7, 7), *((100, i) for i in range(101, 160)), (159, 2)]
    got = components(spark.createDataFrame(edges, "a long, b long"))
    want = {i: 3 for i in (3, 4, 5, 9)} | {20: 20, 21: 20, 2: 2, 100: 2} | {i: 2 for i in range(101, 160)}
    assert {r["id"]: r["component"] for r in got.collect()} == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_bitmap_filter_misses_none(spark):
    rows, ids = spark.range(5000).withColumnRenamed("id", "k"), spark.range(0, 5000, 7).withColumnRenamed("id", "k")
    assert holding(rows, ids, "k").join(ids, "k").count() == ids.count()
    assert holding(rows, ids, "k").count() < 1000
    assert maybe_in(rows, ids.limit(0), "k").where("_maybe").count() == 0


# ---- quality ----------------------------------------------------------------------------


def brute_base(t):
    w, t = WORD.findall(t or ""), t or ""
    windows, covered = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2)), set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i : i + 3])] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [x for x in t.split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), failed)


def test_quality_base(documents, edges, empty):
    for df in (documents, edges):
        got = judged(df).collect()
        want = [(i, *brute_base(t)) for i, t in rows_of(df)]
        assert sorted(tuple(r)[:7] for r in got) == sorted(want)
        assert not any(r["kept"] and r["base_failed"] for r in got)
    assert judged(empty).collect() == []


def test_quality_outliers(spark):
    """Normal texts stay, also with repeated rows; texts far from their group go, also those of a small group."""
    import random

    rng = random.Random(2)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "tempor", "magna", "aliqua", "ut", "enim"]

    def text(n, odd=""):
        return " ".join(rng.choice(words) + str(rng.randrange(1000)) + odd for _ in range(n))

    rows = [(i, text(rng.randint(60, 400)), "en", "a") for i in range(200)]
    rows += [(1000 + i, text(120, "$%#&"), "en", "a") for i in range(5)]
    rows += [(2000 + i, " ".join("z" * 90 for _ in range(1)) + " " + text(20) + " " + "q" * 4000 + " " + text(40), "en", "a") for i in range(3)]
    rows += [(3000 + i, text(120, "$%#&"), None, "b") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in judged(df).collect()}
    assert all(kept[i] for i in range(200))
    assert not any(kept[1000 + i] for i in range(5)) and not any(kept[2000 + i] for i in range(3))
    assert not any(kept[3000 + i] for i in range(5))
    assert kept == {r["doc_id"]: r["kept"] for r in judged(df.repartition(7)).collect()}


def test_quality_one_odd_statistic(spark):
    """Each of the three statistics rejects by itself, also where the rest of the group has no spread in it."""
    import random

    rng = random.Random(7)

    def words(n, size=6):
        return [f"{rng.randrange(10**size):0{size}d}" for _ in range(n)]

    repeated = words(66)
    odd = {
        1000: " ".join(words(100, 14)),
        1001: " ".join(w + "$" * (i % 9 == 0) for i, w in enumerate(words(100))),
        1002: " ".join(repeated + words(10) + repeated[:24]),  # 48 of 100 words in repeated windows
    }
    rows = [(i, " ".join(words(100)), "en", "a") for i in range(100)] + [(i, t, "en", "a") for i, t in odd.items()]
    got = judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert not any(r["base_failed"] for r in got)
    assert {r["doc_id"] for r in got if not r["kept"]} == set(odd)


def brute_estimate(x):
    """(mean, covariance, scale) of the rows of x: all starts, steps to a fixed point, least determinant, reweighted once."""
    x = x.astype(float)
    floor = np.array([1000 * v for v in LEAST_SPREAD])
    coarse = lambda d: np.floor(100 * np.log2(1 + d) + 0.5)

    def shape(rows):
        return rows.mean(axis=0), np.cov(rows.T, bias=True) + np.diag(floor**2)

    def distance(m, c):
        return np.maximum(np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m), 0)

    def scale(m, c):
        return 2.366 / max(2 ** (np.median(coarse(distance(m, c))) / 100) - 1, 2.366)

    mid = np.median(x, axis=0)
    off = ((x - mid) / np.maximum(1.4826 * np.median(np.abs(x - mid), axis=0), floor)) ** 2
    found = []
    for start in (off.sum(axis=1), off.max(axis=1)):
        d, before = coarse(start), None
        for _ in range(13):
            half = d <= np.median(d)
            m, c = shape(x[half])
            if before is not None and (half == before).all():
                break
            before, d = half, coarse(distance(m, c))
        found.append((np.linalg.det(c), m, c))
    _, m, c = min(found, key=lambda f: f[0])
    m, c = shape(x[distance(m, c) * scale(m, c) <= 9.348])
    c = c * CONSISTENT
    return m, c, scale(m, c), distance(m, c) * scale(m, c)


def test_quality_distances_against_brute_force(spark):
    """Every document's distance, by its own group's, its language's or all documents' estimate."""
    rng = np.random.default_rng(5)
    rows = []
    for lang, source, n in (("a", "s", 300), ("a", "t", 25), ("a", "u", 4), ("b", "s", 7), ("b", "t", 16), ("c", "s", 3), ("", "", 1)):
        spread = rng.uniform(20, 300, 3)
        mixed = rng.normal(0, 1, (n, 3)) @ np.array([[1, 0.8, 0], [0, 1, 0.3], [0, 0, 1]]) * spread + rng.uniform(0, 2000, 3)
        mixed[: n // 8] += 4000
        mixed[n // 2 :, 2] = 0
        rows += [(lang, source, *map(int, r)) for r in np.rint(mixed)]
    rows = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, x1 long, x2 long, x3 long").repartition(6)
    got = {r["doc_id"]: r["d2"] for r in distances(df).collect()}
    x = np.array([r[3:] for r in rows])
    lang, source = (np.array([r[i] for r in rows]) for i in (1, 2))
    assert len(got) == len(rows)
    for i, (a, b) in enumerate(zip(lang, source, strict=True)):
        same = (lang == a) & (source == b)
        pool = same if same.sum() >= 20 else lang == a if (lang == a).sum() >= 20 else np.ones(len(rows), bool)
        want = brute_estimate(x[pool])[3][np.flatnonzero(pool).tolist().index(i)]
        assert np.isclose(got[i], want, rtol=1e-6, atol=1e-6), (i, a, b, got[i], want)


def test_quality_is_native(documents):
    from assay.llm.quality import distances, statistics

    assert "Python" not in statistics(documents)._jdf.queryExecution().toString()
    assert distances is not None
