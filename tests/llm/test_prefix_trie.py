"""Operator 11 against brute force: every prefix of every rebuilt conversation counted by itself."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from assay.llm.prefix_trie import ZFastTrie, conversation_trie, two_fattest
from tests.llm.conftest import SF


def sql_rest(c):
    return c - c % 5 if c >= 0 else -(-c - -c % 5)


def brute(rows):
    by = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            by[c].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [r[3:] for r in sorted(x)] for c, x in by.items()}
    built = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(sql_rest(c), [])[:h] + s[h:]
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, s in built.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
        ends[tuple(s)].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, cs in members.items():
        worth = (len(cs) - 1) * len(k[-1][1].encode()) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += worth
    return sorted(
        (min(cs), len(k), min(members[k[:-1]]) if k else None, len(cs), children[k], leaves[k], saved[k],
         hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest())
        for k, cs in members.items()
    )


def got(df, **sizes):
    return sorted((tuple(r) for r in conversation_trie(df, **sizes).collect()), key=lambda r: tuple(x if x is not None else -1 for x in r))


def want(rows):
    return sorted(brute(rows), key=lambda r: tuple(x if x is not None else -1 for x in r))


SCHEMA = "conv_id long, turn long, role string, text string"


def test_two_fattest():
    lo, hi = (x.ravel() for x in np.meshgrid(np.arange(70), np.arange(1, 70)))
    lo, hi = lo[lo < hi], hi[lo < hi]
    best = [max(range(a + 1, b + 1), key=lambda v: v & -v) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
    assert two_fattest(lo, hi).tolist() == best


def test_trie_edges_branch_or_end():
    """Of random sequences: edges are exactly those of the compacted trie, few batches are needed, and sequences are located again."""
    rng = random.Random(4)
    for depth, letters, count in ((6, 2, 200), (40, 2, 300), (3, 50, 300), (300, 1, 100)):
        sequences = sorted({tuple(rng.randrange(letters) for _ in range(rng.randint(1, depth))) for _ in range(count)})
        keys = {}
        for s in sequences:
            for d in range(1, len(s) + 1):
                keys.setdefault(s[:d], rng.getrandbits(62))
        k = np.array([keys[s[:d]] for s in sequences for d in range(1, len(s) + 1)])
        last = np.array([len(s) for s in sequences])
        trie = ZFastTrie(k, k * 3, np.cumsum(last) - last, np.ones_like(last), last)
        fan = collections.Counter(p[:-1] for p in keys)
        stops = {p for p in keys if fan[p] != 1} | set(sequences)
        assert {sequences[r][:h] for r, h in zip(trie.rep.tolist(), trie.hi.tolist(), strict=True)} == stops and len(trie.hi) == len(stops)
        for r, lo, h in zip(trie.rep.tolist(), trie.lo.tolist(), trie.hi.tolist(), strict=True):
            inner = [d for d in range(1, h) if sequences[r][:d] in stops]
            assert lo == max(inner, default=0)
        assert trie.batches <= 30
        _, reached = trie.locate(np.arange(len(last)), np.zeros_like(last))
        assert (reached == last).all()


@pytest.mark.parametrize("sizes", [{}, {"light": 40, "shard_turns": 300}, {"light": 3, "shard_turns": 50}])
def test_given_conversations(spark, sizes):
    df = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert got(df, **sizes) == want(map(tuple, df.collect()))


@pytest.mark.parametrize("sizes", [{}, {"light": 30, "shard_turns": 100}, {"light": 5, "shard_turns": 20}])
def test_shared_prefixes(spark, sizes):
    """Copies, a hot first turn, combs, one very long conversation, and conversations that end inside others."""
    rng, rows = random.Random(9), []
    for c in range(-30, 260):
        kind = rng.random()
        if kind < 0.3:
            texts = ["hot", *(rng.choice("ab") for _ in range(rng.randint(0, 12)))]
        elif kind < 0.5:
            texts = ["copy"] * 12
        elif kind < 0.7:
            texts = ["comb"] * rng.randint(1, 30) + [str(c)] * rng.randint(0, 2)
        else:
            texts = [str(rng.randrange(50)) for _ in range(rng.randint(1, 14))]
        rows += [(c, i, rng.choice(["user", "user", "assistant", None]) if kind >= 0.7 else "user", t) for i, t in enumerate(texts)]
    rows += [(1000, i, "user", "comb" if i < 200 else str(i % 7)) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(df, **sizes) == want(rows)


def test_conversation_edges(spark):
    rows = [
        (5, None, None, None), (5, 1, "user", "a"), (5, 1, "user", "a"), (5, 1, "assistant", "b"), (6, 0, "user", "x"), (7, 0, "", ""), (8, 3, "user", "é" * 9000),
        (None, 0, "user", "lost"), (-3, 0, "user", "a"), (-5, 0, "user", "n"), (-7, 2, "user", "m"), (9223372036854775807, 0, "user", "top"), (-9223372036854775808, 0, "user", "low"),
    ]
    plain = spark.createDataFrame(rows, SCHEMA)
    odd = plain.selectExpr("*", "1 AS depth", "2 AS k1", "3 AS pos", "4 AS part", "5 AS c", "6 AS bytes", "7 AS digest")
    for sizes in ({}, {"light": 1, "shard_turns": 1}):
        assert got(odd, **sizes) == want(rows)
    assert conversation_trie(plain.limit(0)).collect() == []
    assert got(plain.where("conv_id = 6")) == want([r for r in rows if r[0] == 6])


def test_turns_shuffle_no_text(spark):
    from assay.llm.prefix_trie import turns

    df = spark.read.parquet(f"{SF}/conversations.parquet")
    plan = turns(df)._jdf.queryExecution().executedPlan().toString()
    exchange = plan[plan.index("Exchange") :]
    assert "Window" in plan and "text" not in plan[: plan.index("Exchange")].split("Sort")[-1]
    assert "sha2" in exchange
