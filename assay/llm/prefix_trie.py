"""Prefix trie of conversations as z-fast tries in shards (operator 11).

A conversation is a sequence of turns. The key of a prefix is 128 bits: the exclusive or of a hash
of (turn digest, place) over its turns, so keys are running aggregates, equal prefixes have equal
keys everywhere, and no text is ever shuffled. Conversations with the same turns are one class with
a multiplicity.

A trie is compacted: a node is an edge (lo, hi] of depths that ends where conversations branch or
end. A z-fast trie hashes each node at its handle, the prefix whose depth in (lo, hi] is divisible
by the largest power of two. Fat binary search over a conversation's depths then finds its exit
node with a logarithmic number of look-ups; whole batches of conversations are located and inserted
at once, one new edge for each different turn at each exit point, until none is left. At the end
edges are expanded to a node for each depth.

No subtree has to fit in one task. A conversation is routed by its prefix at the smallest power of
two whose subtree is light (at most ``LIGHT`` turns of different conversations), and only there a
trie is built. The prefixes above - the trunk, where hot first turns are - get their figures from
the subtrees' ones, by sums that are combined before they are shuffled. A conversation that is
alone in its subtree and longer than ``LIGHT`` is one edge and is expanded by a window.

Edge cases: null turns come first, ties are ordered by the SHA-256 of role and text; null roles and
texts count as empty; rows with a null conv_id are left out; a conversation without rebuilt turns
ends at the root; repeated rows are turns of their own; remainders of negative ids are those of SQL
(-3 % 5 = -3); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assay.llm.common import ceil_div, mix, ranges, release, steady, table, written

#: Turns of a light subtree, and turns of a shard on average.
LIGHT = 50_000
SHARD_TURNS = 200_000
#: Conversations of a family share the base's first turns, fewer than this many.
FAMILY, MOST_SHARED = 5, 9

NODES = "conv_id long, depth long, k1 long, k2 long, p1 long, p2 long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, top boolean"
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


# ---- sequences ------------------------------------------------------------------------


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), two digest halves and text bytes of every turn."""
    rows = conversations.selectExpr(
        "CAST(conv_id AS BIGINT) AS conv_id", "turn", "coalesce(CAST(role AS STRING), '') AS role", "coalesce(CAST(text AS STRING), '') AS text"
    ).where("conv_id IS NOT NULL")
    rows = rows.selectExpr("conv_id", "turn", "sha2(concat(octet_length(role), ':', role, text), 256) AS digest", "CAST(octet_length(text) AS BIGINT) AS bytes")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.select(
        "conv_id", (F.row_number().over(order) - 1).cast("long").alias("pos"),
        F.substring("digest", 1, 32).alias("d1"), F.substring("digest", 33, 32).alias("d2"), "bytes",
    )


def _shared(conv: str) -> str:
    return f"crc32(CAST(CAST({conv} AS STRING) AS BINARY)) % {MOST_SHARED}"


def family_turns(rows: DataFrame) -> DataFrame:
    """Turns with each conversation's first ones replaced by those of its family's base (``part`` 0 before 1)."""
    ids = rows.select("conv_id").distinct()
    own = rows.where(f"conv_id % {FAMILY} = 0 OR pos >= {_shared('conv_id')}").withColumn("part", F.lit(1))
    others = F.expr(f"filter(transform(sequence({1 - FAMILY}, {FAMILY - 1}), i -> try_add(conv_id, CAST(i AS BIGINT))), c -> c - c % {FAMILY} = conv_id AND c <> conv_id AND pos < {_shared('c')})")
    lent = rows.where(f"conv_id % {FAMILY} = 0 AND pos < {MOST_SHARED}").withColumn("c", F.explode(others))
    lent = lent.selectExpr("c AS conv_id", "pos", "d1", "d2", "bytes", "0 AS part").join(ids, "conv_id", "left_semi")
    return own.unionByName(lent)


def prefix_keys(rows: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), the prefix's key (k1, k2), its parent's key (p1, p2), and bytes of the last text."""
    order = Window.partitionBy("conv_id").orderBy("part", "pos")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("depth", F.row_number().over(order).cast("long"))
    for i in (1, 2):
        placed = placed.withColumn(f"e{i}", F.xxhash64(f"d{i}", "depth"))
    for i in (1, 2):
        placed = placed.withColumn(f"k{i}", F.bit_xor(f"e{i}").over(upto))
    return placed.selectExpr("conv_id", "depth", "k1", "k2", "k1 ^ e1 AS p1", "k2 ^ e2 AS p2", "bytes")


# ---- the z-fast trie of a shard ------------------------------------------------------------


def two_fattest(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The number in (lo, hi] that is divisible by the largest power of two."""
    e = np.frexp((lo ^ hi).astype(np.float64))[1] - 1
    return (hi >> e) << e


class ZFastTrie:
    """Sequences given by the keys of their prefixes; ``first[s]`` is the depth of sequence s's first key."""

    def __init__(self, k1: np.ndarray, k2: np.ndarray, begin: np.ndarray, first: np.ndarray, last: np.ndarray):
        self.k1, self.k2, self.begin, self.first, self.last = k1, k2, begin, first, last
        self.rep = self.lo = self.hi = np.zeros(0, np.int64)
        self.batches = 0
        self._index()
        active, known = np.arange(len(begin)), first - 1  # the depth up to which a sequence is in the trie
        while len(active):
            active, known = self._insert(active, known)
            self.batches += 1

    def at(self, s: np.ndarray, d: np.ndarray) -> np.ndarray:
        return self.begin[s] + d - self.first[s]

    def same(self, s: np.ndarray, t: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Whether two sequences agree up to depth d."""
        x, y = self.at(s, d), self.at(t, d)
        return (self.k1[x] == self.k1[y]) & (self.k2[x] == self.k2[y])

    # hash tables: keys in order, and the node of each
    def _hash(self, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = self.k1[self.at(self.rep, depth)]
        order = np.argsort(key, kind="stable")
        return key[order], order

    def _index(self):
        self.handles = self._hash(two_fattest(self.lo, self.hi))
        self.heads = self._hash(self.lo + 1)

    def _look_up(self, index: tuple[np.ndarray, np.ndarray], s: np.ndarray, d: np.ndarray, inside: bool = True) -> np.ndarray:
        """The node hashed at the prefix of length d of each sequence, or -1."""
        keys, nodes = index
        if not len(keys):
            return np.full(len(s), -1)
        want = self.k1[self.at(s, d)]
        place = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        node = nodes[place]
        hit = (keys[place] == want) & (self.lo[node] < d) & (d <= self.hi[node])
        hit[hit] = self.same(s[hit], self.rep[node[hit]], d[hit])
        return np.where(hit, node, -1)

    def locate(self, s: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(exit node or -1, depth of the longest prefix in the trie) of sequences known up to some depths, by fat binary search."""
        low, high = known.copy(), self.last[s].copy()
        exit_node = np.full(len(s), -1)
        todo = np.flatnonzero(low < high)
        while len(todo):
            f = two_fattest(low[todo], high[todo])
            node = self._look_up(self.handles, s[todo], f)
            missed, hit = todo[node < 0], todo[node >= 0]
            high[missed] = f[node < 0] - 1
            found = node[node >= 0]
            end = self.hi[found]
            whole = end <= self.last[s[hit]]
            whole[whole] = self.same(s[hit[whole]], self.rep[found[whole]], end[whole])
            low[hit[whole]] = end[whole]
            exit_node[hit[~whole]] = found[~whole]
            high[hit[~whole]] = low[hit[~whole]]  # found
            # a node that is wholly passed may have been found above a depth that was missed before
            high[hit[whole]] = np.maximum(high[hit[whole]], low[hit[whole]])
            todo = todo[low[todo] < high[todo]]
        # from the end of a node, the child that begins with the next turn
        rest = np.flatnonzero((exit_node < 0) & (low < self.last[s]))
        exit_node[rest] = self._look_up(self.heads, s[rest], low[rest] + 1)
        depth = low
        inside = np.flatnonzero(exit_node >= 0)
        a = self.lo[exit_node[inside]] + 1  # agrees
        b = np.minimum(self.hi[exit_node[inside]], self.last[s[inside]])
        while (open_ := a < b).any():
            middle = (a + b + 1) // 2
            agree = self.same(s[inside], self.rep[exit_node[inside]], np.where(open_, middle, a))
            a, b = np.where(open_ & agree, middle, a), np.where(open_ & ~agree, middle - 1, b)
        depth[inside] = a
        return exit_node, depth

    def _insert(self, s: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Insert a batch: cut edges at exit points, add an edge for each next turn; returns what is left."""
        node, depth = self.locate(s, known)
        cut = (node >= 0) & (depth < self.hi[np.maximum(node, 0)]) if len(self.hi) else np.zeros(len(s), bool)
        cuts = np.unique(np.stack((node[cut], depth[cut]), axis=1), axis=0)
        more = np.flatnonzero(depth < self.last[s])
        more = more[np.argsort(mix(s[more].astype(np.uint64)), kind="stable")]  # which one of a group comes first is random
        x = self.at(s[more], depth[more] + 1)
        _, chosen = np.unique(np.stack((self.k1[x], self.k2[x]), axis=1), axis=0, return_index=True)
        new = more[chosen]
        if len(cuts):
            split, where = cuts[:, 0], cuts[:, 1]
            head = np.append(True, split[1:] != split[:-1])
            tail = np.append(split[1:] != split[:-1], True)
            end = np.where(tail, self.hi[split], np.append(where[1:], 0))
            rep = self.rep[split]
            self.hi = self.hi.copy()
            self.hi[split[head]] = where[head]
            self._grow(rep, where, end)
        self._grow(s[new], depth[new], self.last[s[new]])
        self._index()
        left = np.setdiff1d(more, new, assume_unique=True)
        return s[left], depth[left]

    def _grow(self, rep: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        self.rep, self.lo, self.hi = (np.concatenate(p) for p in ((self.rep, rep), (self.lo, lo), (self.hi, hi)))

    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        """(the node at whose end each sequence ends, each node's parent or -1)."""
        index = self._hash(self.hi)
        every = np.arange(len(self.begin))
        up = np.full(len(self.lo), -1)
        below = np.flatnonzero(self.lo >= self.first[self.rep])
        up[below] = self._look_up(index, self.rep[below], self.lo[below])
        return self._look_up(index, every, self.last), up


def shard_nodes(tbl: pa.Table) -> pa.Table:
    """All nodes of a shard's subtrees, a row for each depth."""
    conv, depth, k1, k2, p1, p2, size, copies = (tbl.column(c).to_numpy() for c in ("conv_id", "depth", "k1", "k2", "p1", "p2", "bytes", "copies"))
    order = np.lexsort((depth, conv))
    conv, depth, k1, k2, p1, p2, size, copies = (x[order] for x in (conv, depth, k1, k2, p1, p2, size, copies))
    begin = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
    stop = np.append(begin[1:], len(conv))
    trie = ZFastTrie(k1, k2, begin, depth[begin], depth[stop - 1])
    end, up = trie.ends()
    n = len(trie.lo)
    members, least, leaves, saved = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64), np.zeros(n, np.int64)
    np.add.at(members, end, copies[begin])
    np.minimum.at(least, end, conv[begin])
    children = np.bincount(up[up >= 0], minlength=n)
    leaves[children == 0] = 1
    total = np.concatenate(([0], np.cumsum(size)))
    stop_at = trie.at(trie.rep, trie.hi) + 1
    start_at = trie.at(trie.rep, trie.lo + 1)
    below = np.zeros(n, np.int64)  # saved in the subtrees of a node's children
    by_lo = np.argsort(-trie.lo, kind="stable")
    for level in np.split(by_lo, np.flatnonzero(np.diff(trie.lo[by_lo])) + 1):
        saved[level] = below[level] + (members[level] - 1) * (total[stop_at[level]] - total[start_at[level]])
        inner = level[up[level] >= 0]
        for into, what in ((members, members), (leaves, leaves), (below, saved)):
            np.add.at(into, up[inner], what[inner])
        np.minimum.at(least, up[inner], least[inner])
    # expand the edges
    span = trie.hi - trie.lo
    node = np.repeat(np.arange(n), span)
    x = ranges(start_at, span)
    deep = depth[x]
    first, final = deep == trie.lo[node] + 1, deep == trie.hi[node]
    above = np.where(up >= 0, least[np.maximum(up, 0)], 0)
    top = first & (up[node] < 0)
    columns = {
        "conv_id": least[node], "depth": deep, "k1": k1[x], "k2": k2[x], "p1": p1[x], "p2": p2[x],
        "parent_conv_id": pa.array(np.where(first, above[node], least[node]), mask=top), "n_convs": members[node],
        "n_children": np.where(final, children[node], 1), "n_leaves": leaves[node],
        "saved_tokens": below[node] + (members[node] - 1) * (total[stop_at[node]] - total[x]), "top": top,
    }
    release()
    return pa.table({c: v if isinstance(v, pa.Array) else pa.array(v) for c, v in columns.items()})


def _shard(key: tuple, tbl: pa.Table) -> pa.Table:
    return shard_nodes(tbl)


# ---- digests of ends -------------------------------------------------------------------------


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each class, comma-joined; rows come sorted and are read as a stream."""
    held, digest = None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in (*held, digest.hexdigest())], ["depth", "k1", "k2", "ends_sha256"])

    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("depth", "k1", "k2")], axis=1)
        ids = batch.column("conv_id").cast(pa.string()).to_pylist()
        cut = np.append(np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))), len(keys)).tolist() if len(keys) else []
        out = []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            key, part = tuple(keys[a].tolist()), ",".join(ids[a:b]).encode()
            if key == held:
                digest.update(b"," + part)
                continue
            if held is not None:
                out.append(row())
            held, digest = key, hashlib.sha256(part)
        yield from out
    if held is not None:
        yield row()


# ---- the operator ------------------------------------------------------------------------------


def trie_nodes(paths: DataFrame, ids: DataFrame, light: int = LIGHT, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All nodes of the trie of ``paths`` (see ``prefix_keys``); ``ids`` are all conversations, also those without turns."""
    key = ["depth", "k1", "k2"]
    last = paths.groupBy("conv_id").agg(F.max(F.struct("depth", "k1", "k2")).alias("e")).select("conv_id", "e.*")
    none = ids.join(last, "conv_id", "left_anti").selectExpr("conv_id", "0L AS depth", "0L AS k1", "0L AS k2")
    members = written(last.unionByName(none), "trie-members")
    classes = written(
        members.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies")).withColumnRenamed("depth", "turns"),
        "trie-classes",
    )
    ends = members.repartition(*key).sortWithinPartitions(*key, "conv_id").mapInArrow(
        steady(_end_digests), "depth long, k1 long, k2 long, ends_sha256 string"
    )

    # different conversations, routed by their shortest prefix of 1, 2, 4 ... turns with a light subtree
    rows = paths.join(classes.select("conv_id", "turns", "copies"), "conv_id")
    marks = rows.where("depth & (depth - 1) = 0")
    subtrees = marks.groupBy(*key).agg(F.sum(F.expr("turns - depth + 1")).alias("size"), F.count(F.lit(1)).alias("n"))
    small = subtrees.where((F.col("size") <= light) | (F.col("n") == 1)).withColumn("chain", F.col("size") > light)
    routes = written(
        marks.join(small, key).groupBy("conv_id").agg(F.min(F.struct("depth", "k1", "k2", "chain")).alias("r"))
        .selectExpr("conv_id", "r.depth AS root", "r.k1 AS route", "r.chain AS chain"),
        "trie-routes",
    )
    routed = rows.join(routes, "conv_id").where("depth >= root")
    total = paths.count()
    shards = ceil_div(total, shard_turns)
    columns = ["conv_id", *key, "p1", "p2", "bytes", "copies"]
    built = (
        routed.where("NOT chain").select(*columns, F.pmod(F.xxhash64("route"), F.lit(shards)).alias("shard"))
        .groupBy("shard").applyInArrow(_shard, NODES)
    )
    behind = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chains = routed.where("chain").withColumn("left", F.sum("bytes").over(behind)).selectExpr(
        "conv_id", *key, "p1", "p2", "if(depth = root, NULL, conv_id) AS parent_conv_id", "copies AS n_convs",
        "if(depth = turns, 0L, 1L) AS n_children", "1L AS n_leaves", "(copies - 1) * left AS saved_tokens", "depth = root AS top",
    )
    nodes = written(built.unionByName(chains), "trie-nodes")

    # the trunk: prefixes of subtrees' roots, and of conversations that end above every light subtree
    tops = nodes.where("top").selectExpr("conv_id", "depth - 1 AS upto", "n_convs", "n_leaves", "saved_tokens")
    early = classes.join(routes, "conv_id", "left_anti").selectExpr(
        "conv_id", "turns AS upto", "copies AS n_convs", "0L AS n_leaves", "0L AS saved_tokens"
    )
    given = written(tops.unionByName(early), "trie-given")
    root = "0L AS depth", "0L AS k1", "0L AS k2", "0L AS p1", "0L AS p2", "0L AS bytes"
    figures = ["conv_id", "n_convs", "n_leaves", "saved_tokens"]
    above = paths.join(given, "conv_id").where("depth <= upto").select(*key, "p1", "p2", "bytes", *figures)
    trunk = written(
        above.unionByName(given.selectExpr(*root, *figures)).groupBy(*key, "p1", "p2", "bytes")
        .agg(F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in figures[1:])),
        "trie-trunk",
    )
    heads = trunk.where("depth > 0").select("depth", "p1", "p2").unionByName(nodes.where("top").select("depth", "p1", "p2"))
    children = heads.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    trunk = written(
        trunk.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .withColumn("own_saved", F.expr("(n_convs - 1) * bytes")).withColumn("own_leaf", F.expr("if(n_children = 0, 1L, 0L)")),
        "trie-trunk",
    )
    # what a trunk node adds to those above it; the root's own key is 0
    adds = trunk.where("depth > 0 AND (own_saved > 0 OR own_leaf > 0)").selectExpr("conv_id", "depth AS node", "own_saved", "own_leaf")
    upward = paths.select("conv_id", *key).join(adds, "conv_id").where("depth < node").select(*key, "own_saved", "own_leaf")
    upward = upward.unionByName(adds.selectExpr("0L AS depth", "0L AS k1", "0L AS k2", "own_saved", "own_leaf"))
    upward = upward.groupBy(*key).agg(F.sum("own_saved").alias("more_saved"), F.sum("own_leaf").alias("more_leaves"))
    trunk = trunk.join(upward, key, "left").selectExpr(
        "conv_id", *key, "p1", "p2", "CAST(NULL AS BIGINT) AS parent_conv_id", "n_convs", "n_children",
        "n_leaves + own_leaf + coalesce(more_leaves, 0L) AS n_leaves", "saved_tokens + own_saved + coalesce(more_saved, 0L) AS saved_tokens",
        "depth > 0 AS top",
    )
    trunk = written(trunk, "trie-trunk")
    parents = trunk.selectExpr("depth + 1 AS depth", "k1 AS p1", "k2 AS p2", "conv_id AS above")
    hung = nodes.where("top").unionByName(trunk).join(parents, ["depth", "p1", "p2"], "left").withColumn("parent_conv_id", F.col("above"))
    every = nodes.where("NOT top").select(*RESULT[:-1], "k1", "k2").unionByName(hung.select(*RESULT[:-1], "k1", "k2"))
    none_digest = F.lit(hashlib.sha256(b"").hexdigest())
    return every.join(ends, key, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none_digest)).select(*RESULT)


def conversation_trie(conversations: DataFrame, light: int = LIGHT, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    rows = written(turns(conversations), "turns")
    paths = written(prefix_keys(family_turns(rows)), "paths")
    return trie_nodes(paths, rows.select("conv_id").distinct(), light, shard_turns)


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie over rebuilt conversations."""
    return conversation_trie(table(spark, sf_dir, "conversations"))


_POLYNOMIAL = 0xEDB88320
OP11_SQL = f"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes,
         sha256(concat(CAST(strlen(coalesce(role, '')) AS VARCHAR), ':', coalesce(role, ''), coalesce(text, ''))) AS x
  FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT conv_id, list(struct_pack(x := x, bytes := bytes) ORDER BY turn NULLS FIRST, x) AS s FROM t GROUP BY conv_id
), bits AS (
  SELECT conv_id, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ord(c) AS BIGINT)] || list_transform(range(8), lambda i: CAST(-1 AS BIGINT)))) AS steps FROM o
), h AS (
  SELECT conv_id, xor(list_reduce([CAST(4294967295 AS BIGINT)] || steps,
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a >> 1, CAST({_POLYNOMIAL} AS BIGINT)) ELSE a >> 1 END),
    CAST(4294967295 AS BIGINT)) % 9 AS h FROM bits
), r AS (
  SELECT o.conv_id, CASE WHEN o.conv_id % 5 = 0 THEN o.s ELSE coalesce(b.s, [])[1:h] || o.s[h + 1:] END AS s
  FROM o JOIN h USING (conv_id) LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 5
), p AS (
  SELECT conv_id, d, array_to_string(list_transform(s[1:d], lambda e: e.x), ',') AS k,
         CASE WHEN d > 0 THEN array_to_string(list_transform(s[1:d - 1], lambda e: e.x), ',') END AS up,
         CASE WHEN d > 0 THEN s[d].bytes ELSE 0 END AS bytes, d = len(s) AS is_end
  FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM r)
), n AS (
  SELECT k, any_value(d) AS depth, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256
  FROM p GROUP BY k
), c AS (SELECT up AS k, count(*) AS n FROM n WHERE up IS NOT NULL GROUP BY up),
sub AS (
  SELECT k AS top, k AS node FROM n UNION ALL SELECT sub.top, n.k FROM sub JOIN n ON n.up = sub.node
), sums AS (
  SELECT top AS k, sum(CASE WHEN c.n IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
  FROM sub JOIN n ON n.k = sub.node LEFT JOIN c ON c.k = sub.node GROUP BY top
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN sums USING (k) LEFT JOIN c USING (k) LEFT JOIN n m ON m.k = n.up
"""
