"""N-gram Jaccard join by prefixes under several global token orders (operator 4).

Documents are sets of distinct ``k``-word shingles. Two sets A and B with
``den * |A & B| >= num * |A | B|`` differ in at most D tokens, D growing with their sizes.
A global order that ranks the tokens of one residue class first makes a set's prefix its tokens
of that class. A token that differs spoils the prefix of one order only, and two families of
orders use that:

* few orders with long prefixes generate candidates: for sizes of one range there are D + s
  orders, so linked sets share the whole prefix under at least s of them;
* many orders with short prefixes (4 D or more, one byte a prefix) intersect the filters: of
  linked sets no more prefixes differ than tokens do. Only pairs that pass are verified.

Prefixes of several tokens make the first filter indifferent to frequent shingles: documents
that merely share a passage rarely agree on a whole prefix. Empty prefixes prove nothing;
they are sent only by a set with at least s of them. Candidates of small groups also pass a size
bound; a large group is only connected to one of its members, not expanded into pairs. Nothing else of a set
goes to the shards, so what they get grows with the prefixes, whatever the number of shards.

Equal sets are one class, represented by its smallest id; a task sends a class once. The members
of a group (or of a pair) are first compared by sizes and by a bit for each prefix of the second family:
linked sets differ in no more parities than tokens. So passages that many documents share do not bind
them, and for each group a document travels as 16 to 32 bytes for every hundred shingles, not as a text.
The components of what passes are families: every link lies within one. A family's texts are brought
together once, in blocks of ``UNIT_TOKENS`` shingles and pairs of blocks, so no task gets a family
whole; a family of more than ``MOST_PARTS`` blocks is compared group by group instead (each group in
blocks again), which looks at fewer pairs and ships a text once for each of its groups. Within a unit
documents are compared by size, then by the short prefixes, then token by token, and only until they
are in one component: links found join components at once, and what lies within one is not looked
at again. So every link between different sets is either found or lies within a component, no pairs of
copies are expanded, and a unit gives no more links than it has members.

Edge cases: null or empty text has an empty set, linked with nothing; a text of fewer than
``k`` words is one shingle; rows with a null id are left out; rows that repeat an id are
one node (links of either count for both) and each keeps its n_shingles; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.common import LOWER, U64, ceil_div, chunks, discard, gram_hash, holding, mix, release, small_batches, steady, string_buffer, table, text_bytes, words, written
from assay.llm.components import components

K = 4
NUM, DEN = 85, 100
#: Ratio of the largest to the smallest size of a range.
RANGE = 1.5
#: Prefix rows of a shard, on average.
SHARD_ROWS = 1_200_000
#: Groups up to this many sets give pairs, larger ones a star.
SMALL_GROUP = 8
#: Shingles of a block, and blocks up to which a family is compared as a whole.
UNIT_TOKENS = 4_000_000
MOST_PARTS = 32
#: Members of a block of a group, and bytes of a task, when groups are compared by parities.
GROUP_MEMBERS = 20_000
SKETCH_BYTES = 16_000_000
#: Rows of the units' table (five numbers each) up to which it, and not the texts, goes to every task.
BROADCAST_UNITS = 500_000
#: The least number of orders in the second family.
LEAST_MARKS = 64

DOCS = "doc_id long, n long, k1 long, k2 long, parities binary"


# ---- sets -----------------------------------------------------------------------


def shingle_sets(buf: np.ndarray, offs: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ascending shingle hashes) of every document."""
    for a, b in chunks(offs):
        w = words(buf, offs[a : b + 1], LOWER)
        grams = gram_hash(w.hash, k)
        for d in range(b - a):
            x, y = int(w.first[d]), int(w.first[d + 1])
            if y - x >= k:
                yield a + d, np.unique(grams[x : y - k + 1])
            elif y > x:
                yield a + d, gram_hash(w.hash[x:y], y - x)
            else:
                yield a + d, np.zeros(0, U64)


def set_key(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    both = np.array([mix(tokens).sum(), mix(tokens ^ U64(0xA5A5A5A55A5A5A5A)).sum()], U64).view(np.int64)
    return int(both[0]), int(both[1])


def need(a, b, num: int, den: int):
    """The smallest intersection of linked sets of these sizes."""
    return -((-num * (a + b)) // (num + den))


def size_range(n: int) -> int:
    """The range of a size: range j holds [RANGE**j, RANGE**(j + 1))."""
    j = int(np.log(n) / np.log(RANGE))
    while RANGE**j > n:
        j -= 1
    while RANGE ** (j + 1) <= n:
        j += 1
    return j


def orders(j: int, num: int, den: int) -> tuple[int, int]:
    """(K, s) for pairs whose larger set is in range j."""
    top = int(np.ceil(RANGE ** (j + 1)))
    differ = (den - num) * 2 * top // (num + den)
    spare = 2 + differ // 12
    return differ + spare, spare


def ranges_of(n: int, num: int, den: int) -> list[int]:
    """Ranges in which a set of size n can be the larger or the smaller one of a pair."""
    j = size_range(n)
    top = n * den // num
    return list(range(j, size_range(max(top, n)) + 1))


def prefixes(tokens: np.ndarray, j: int, num: int, den: int) -> np.ndarray:
    """Hash of (range, order, the set's prefix under it), for each order that is sent."""
    count, spare = orders(j, num, den)
    order = (mix(tokens + U64(0x9E3779B97F4A7C15)) % U64(count)).astype(np.int64)
    total = np.zeros(count, U64)
    np.add.at(total, order, mix(tokens ^ U64(0x13198A2E03707344)))
    size = np.bincount(order, minlength=count)
    sent = np.arange(count) if (size == 0).sum() >= spare else np.flatnonzero(size)
    return mix(total[sent] + size[sent].astype(U64) * U64(0xC2B2AE3D27D4EB4F) + mix(sent.astype(U64) + U64(j << 32)))


def mark_orders(n: int, num: int, den: int) -> int:
    """Orders of the second family for a set of n tokens: a power of two, at least four times the tokens in which a linked set of its size differs."""
    return max(LEAST_MARKS, 1 << int((den - num) * 8 * n // (num + den)).bit_length())


def marks(tokens: np.ndarray, num: int, den: int) -> np.ndarray:
    """A byte for the prefix under each order of the second family."""
    size = mark_orders(len(tokens), num, den)
    h = mix(tokens ^ U64(0x452821E638D01377))
    out = np.zeros(size, np.uint8)
    np.bitwise_xor.at(out, (h & U64(size - 1)).astype(np.int64), (h >> U64(56)).astype(np.uint8))
    return out


def folded(rows: list[np.ndarray]) -> np.ndarray:
    """Marks of many sets as one matrix, for as many orders as the smallest has (halves of a longer one are the residues of one class)."""
    size = min(map(len, rows))
    out = np.zeros((len(rows), size), np.uint8)
    for i, row in enumerate(rows):
        out[i] = np.bitwise_xor.reduce(row.reshape(-1, size), axis=0)
    return out


def parities(tokens: np.ndarray, num: int, den: int) -> bytes:
    """A bit for the prefix under each order of the second family: whether its number of tokens is odd."""
    size = max(64, mark_orders(len(tokens), num, den))
    place = mix(tokens ^ U64(0x452821E638D01377)) & U64(size - 1)
    return np.packbits((np.bincount(place.astype(np.int64), minlength=size) & 1).astype(np.uint8)).tobytes()


def describe(k: int, num: int, den: int):
    """doc_id, n, the set's key and its parities, for every document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = string_buffer(batch.column("text"))
            n, k1, k2, bits = [], [], [], []
            for _, tokens in shingle_sets(buf, offs, k):
                n.append(len(tokens))
                one, two = set_key(tokens)
                k1.append(one)
                k2.append(two)
                bits.append(parities(tokens, num, den))
            columns = [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, k1, k2)), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in DOCS.split(", ")])

    return rows


# ---- candidates -------------------------------------------------------------------


class _Outbox:
    """Prefixes of a task's sets, packed by shard."""

    def __init__(self, shards: int):
        self.shards = shards
        self.clear()

    def clear(self):
        self.rows, self.ids, self.sizes, self.count = [], [], [], 0

    def add(self, doc: int, n: int, keys: np.ndarray):
        self.rows.append((keys, np.full(len(keys), len(self.ids), np.uint32)))
        self.ids.append(doc)
        self.sizes.append(n)
        self.count += len(keys)

    def batch(self) -> pa.RecordBatch:
        shard_of, blobs = [], []
        if self.ids:
            keys = np.concatenate([x for x, _ in self.rows])
            doc = np.concatenate([x for _, x in self.rows])
            ids, sizes = np.array(self.ids, np.int64), np.array(self.sizes, np.int32)
            shard = (mix(keys) % U64(self.shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            cut = np.searchsorted(shard[order], np.arange(self.shards + 1))
            pack = zstandard.ZstdCompressor(level=1)
            for s in range(self.shards):
                mine = order[cut[s] : cut[s + 1]]
                if len(mine):
                    used, at = np.unique(doc[mine], return_inverse=True)
                    head = np.array([len(mine), len(used)], np.int64).tobytes()
                    parts = (keys[mine], at.astype(np.uint32), ids[used], sizes[used])
                    shard_of.append(s)
                    blobs.append(pack.compress(head + b"".join(x.tobytes() for x in parts)))
        self.clear()
        return pa.RecordBatch.from_arrays([pa.array(shard_of, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "blob"])


def send_prefixes(k: int, num: int, den: int, shards: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, seen = _Outbox(shards), set()
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            buf, offs = string_buffer(batch.column("text"))
            for row, tokens in shingle_sets(buf, offs, k):
                n = len(tokens)
                key = set_key(tokens)
                if not n or key in seen:
                    continue
                seen.add(key)
                keys = [prefixes(tokens, j, num, den) for j in ranges_of(n, num, den)]
                out.add(ids[row], n, np.concatenate(keys))
                if out.count >= 1 << 21:
                    yield out.batch()
        yield out.batch()

    return rows


def _unpack(blobs: list[bytes]) -> tuple[np.ndarray, ...]:
    """(key, set) rows, and the sets' ids and sizes."""
    keys, at, ids, sizes, base = [], [], [], [], 0
    for blob in blobs:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        n, m = np.frombuffer(raw, np.int64, 2).tolist()
        o = 16
        keys.append(np.frombuffer(raw, U64, n, o))
        o += 8 * n
        at.append(np.frombuffer(raw, np.uint32, n, o).astype(np.int64) + base)
        o += 4 * n
        ids.append(np.frombuffer(raw, np.int64, m, o))
        o += 8 * m
        sizes.append(np.frombuffer(raw, np.int32, m, o).astype(np.int64))
        base += m
    return tuple(np.concatenate(x) for x in (keys, at, ids, sizes))


def possible(na, nb, num: int, den: int):
    """Whether sizes allow a link."""
    return need(na, nb, num, den) <= np.minimum(na, nb)


def candidates(num: int, den: int):
    """Candidates (a, b) of a shard's groups: possible pairs of small groups, a star for each large one; ``g`` names the pair or group."""

    def find(key: tuple, tbl: pa.Table) -> pa.Table:
        keys, at, ids, sizes = _unpack([x.as_py() for x in tbl.column("blob")])
        order = np.argsort(keys, kind="stable")
        keys, at = keys[order], at[order]
        edge = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        length = np.diff(np.append(edge, len(keys)))
        pairs, stars = [np.zeros((2, 0), np.int64)], [np.zeros((3, 0), np.int64)]
        for m in range(2, SMALL_GROUP + 1):
            first = edge[length == m]
            for i, j in combinations(range(m), 2):
                pairs.append(np.stack((at[first + i], at[first + j])))
        for e, m in zip(edge[length > SMALL_GROUP].tolist(), length[length > SMALL_GROUP].tolist(), strict=True):
            group = np.unique(ids[at[e : e + m]])
            # groups of one family share most of their members, so they mostly share this one, and the same pairs, too
            hub = group[np.argmin(mix(group.view(U64)))]
            stars.append(np.stack((np.full(len(group), hub), group, np.full(len(group), keys[e].view(np.int64)))))
        a, b = np.concatenate(pairs, axis=1)
        keep = a != b
        a, b = a[keep], b[keep]
        keep = possible(sizes[a], sizes[b], num, den)
        a, b = ids[a[keep]], ids[b[keep]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        found = np.unique(np.stack((low, high), axis=1), axis=0)
        name = mix(mix(found[:, 0].copy().view(U64)) + found[:, 1].copy().view(U64)).view(np.int64)
        found = np.concatenate((np.stack((found[:, 0], found[:, 1], name)), *stars), axis=1)
        found = found[:, found[0] != found[1]]
        del keys, at, order, edge, length
        release()
        return pa.Table.from_arrays([pa.array(x) for x in found], ["a", "b", "g"])

    return find


# ---- groups, by parities --------------------------------------------------------------


def unit_ranges(f: np.ndarray, lo: np.ndarray, hi: np.ndarray, ids: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of each unit (f, lo, hi), by id."""
    order = np.lexsort((ids, hi, lo, f))
    new = (np.diff(f[order]) != 0) | (np.diff(lo[order]) != 0) | (np.diff(hi[order]) != 0)
    edge = [0, *(np.flatnonzero(new) + 1).tolist(), len(f)] if len(f) else [0]
    for x, y in zip(edge[:-1], edge[1:], strict=True):
        yield order[x:y]


def halved(rows: list[bytes], size: int) -> np.ndarray:
    """Parities of sets of any sizes as one matrix of ``size`` bytes (halves of longer ones are the residues of one class)."""
    out = np.zeros((len(rows), size), np.uint8)
    for longer in sorted({len(r) for r in rows}):
        at = [i for i, r in enumerate(rows) if len(r) == longer]
        out[at] = np.bitwise_xor.reduce(np.frombuffer(b"".join([rows[i] for i in at]), np.uint8).reshape(len(at), -1, size), axis=1)
    return out.view(np.uint64)


def fitting_pairs(ids: np.ndarray, n: np.ndarray, rows: list[bytes], block: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that sizes and parities allow to be linked; members of different blocks are compared, unless all are of one."""
    order = np.lexsort((ids, n))
    ids, n, block, rows = ids[order], n[order], block[order], [rows[i] for i in order.tolist()]
    _, root = np.unique(ids, return_inverse=True)
    left, across, out = int(root.max()) + 1, bool((block != block[0]).any()), []
    size = np.array([len(r) for r in rows])  # ascends with n
    top = np.searchsorted(n, n * den // num, side="right")
    for s in np.unique(size).tolist():
        first, last = int(np.searchsorted(size, s)), int(np.searchsorted(size, s, side="right"))
        bits = halved(rows[first : int(top[last - 1])], s)
        for i in range(first, last):
            if left == 1:
                return out
            other = root[i + 1 : top[i]] != root[i]
            if across:
                other &= block[i + 1 : top[i]] != block[i]
            j = np.flatnonzero(other) + i + 1
            if not len(j):
                continue
            apart = np.bitwise_count(bits[j - first] ^ bits[i - first]).sum(axis=1, dtype=np.int64)
            j = j[apart <= n[i] + n[j] - 2 * need(n[i], n[j], num, den)]
            joined, at = np.unique(root[j], return_index=True)
            out += [(int(ids[i]), int(ids[x])) for x in j[at].tolist()]
            root[np.isin(root, joined)] = root[i]
            left -= len(joined)
    return out


def narrow(num: int, den: int):
    """Pairs that join what may be linked within each unit (f, lo, hi) of a task; rows hold the members' parities."""

    def find(key: tuple, tbl: pa.Table) -> pa.Table:
        f, lo, hi, block, ids, n = (tbl.column(c).to_numpy() for c in ("f", "lo", "hi", "block", "doc", "n"))
        rows = tbl.column("parities").to_pylist()
        out = []
        for at in unit_ranges(f, lo, hi, ids):
            if lo[at[0]] == hi[at[0]] or (block[at] != block[at[0]]).any():
                out += fitting_pairs(ids[at], n[at], [rows[i] for i in at.tolist()], block[at], num, den)
        out = list(dict.fromkeys(out))
        del rows
        release()
        return pa.Table.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in (0, 1)], ["a", "b"])

    return find


def dealt(rows: DataFrame) -> DataFrame:
    """f, lo, hi, block and the other columns of ``rows`` (f, doc, parts): every pair of a family's blocks is a unit."""
    rest = [c for c in rows.columns if c not in ("f", "parts")]
    blocks = rows.withColumn("block", F.expr("CAST(pmod(xxhash64(doc), parts) AS INT)")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return blocks.selectExpr("f", "least(block, i) AS lo", "greatest(block, i) AS hi", "block", *rest)


def possible_links(groups: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) that connect all members of a group (g, doc) that may be linked; ``sets``: doc, n, parities."""
    parts = F.expr(f"CAST(ceil(count(1) / {GROUP_MEMBERS}) AS INT)").alias("parts")
    large = groups.groupBy("g").agg(parts).where("parts > 1")
    members = dealt(groups.join(large, "g", "left").selectExpr("g AS f", "doc", "coalesce(parts, 1) AS parts"))
    # a set is in as many groups as it has prefixes, which grow with its size
    mean = sets.agg(F.coalesce(F.sum(F.octet_length("parities") * F.col("n")) / F.sum("n"), F.lit(0.0)).alias("m")).first()["m"]
    tasks = ceil_div(groups.count() * mean, SKETCH_BYTES)
    return (
        members.join(sets, "doc").withColumn("task", F.pmod(F.xxhash64("f", "lo", "hi"), F.lit(tasks)))
        .groupBy("task").applyInArrow(narrow(num, den), "a long, b long")
    )


# ---- units ------------------------------------------------------------------------


def unit_links(ids: np.ndarray, sets: list[np.ndarray], block: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Links that join components, a spanning forest of all links; members of different blocks are compared, unless all are of one."""
    out = []
    n = np.array([len(s) for s in sets], np.int64)
    marked = folded([marks(s, num, den) for s in sets])
    _, root = np.unique(ids, return_inverse=True)
    across = len(np.unique(block)) > 1
    index = np.arange(len(ids))
    for i in range(len(ids)):
        other = (root != root[i]) & (index > i)
        if across:
            other &= block != block[i]
        j = np.flatnonzero(other)
        low = need(n[i], n[j], num, den)
        j = j[low <= np.minimum(n[i], n[j])]
        if not len(j):
            continue
        low = need(n[i], n[j], num, den)
        apart = (marked[j] != marked[i]).sum(axis=1)
        fits = np.flatnonzero(apart <= n[i] + n[j] - 2 * low)
        for y in fits[np.argsort(apart[fits], kind="stable")].tolist():
            x = j[y]
            if root[x] != root[i] and len(np.intersect1d(sets[i], sets[x], assume_unique=True)) >= low[y]:
                out.append((int(ids[i]), int(ids[x])))
                root[root == root[x]] = root[i]
    return out


def compare(k: int, num: int, den: int):
    """Links within each unit (f, lo, hi) of a task; rows hold the members' texts."""

    def find(key: tuple, tbl: pa.Table) -> pa.Table:
        f, lo, hi, block, ids = (tbl.column(c).to_numpy() for c in ("f", "lo", "hi", "block", "doc"))
        buf, offs = string_buffer(tbl.column("text"))
        sets = [tokens for _, tokens in shingle_sets(buf, offs, k)]
        out = []
        for rows in unit_ranges(f, lo, hi, ids):
            at = [i for i in rows.tolist() if len(sets[i])]
            if len(at) > 1 and (lo[at[0]] == hi[at[0]] or len(np.unique(block[at])) > 1):
                out += unit_links(ids[at], [sets[i] for i in at], block[at], num, den)
        del sets
        release()
        return pa.Table.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in (0, 1)], ["a", "b"])

    return find


def units(pairs: DataFrame, groups: DataFrame, sizes: DataFrame, scratch: list[str]) -> DataFrame:
    """f, lo, hi, block, doc, n: the members of every unit. ``pairs``: possible links (a, b); ``groups``: g, doc; ``sizes``: doc, n."""
    family = components(pairs, scratch)
    members = written(family.selectExpr("component AS f", "id AS doc").join(sizes, "doc"), "families", scratch)
    parts = lambda rows: rows.groupBy("f").agg(F.expr(f"CAST(ceil(sum(n) / {UNIT_TOKENS}) AS INT)").alias("parts"), F.count(F.lit(1)).alias("docs"))
    whole = parts(members).drop("docs")
    fitting = members.join(whole.where(F.col("parts") <= MOST_PARTS), "f")
    large = members.join(whole.where(F.col("parts") > MOST_PARTS).select("f"), "f", "left_semi")
    within = groups.join(large, "doc").selectExpr("xxhash64(g, f) AS f", "doc", "n")
    split = fitting.unionByName(within.join(parts(within).where("docs > 1").drop("docs"), "f").select(fitting.columns))
    return dealt(split)


def near_duplicates(documents: DataFrame, k: int = K, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id reachable by links) of every document."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    spark, scratch = documents.sparkSession, []
    described = written(small_batches(docs).mapInArrow(steady(describe(k, num, den)), DOCS), "sets", scratch)
    classes = described.where("n > 0").groupBy("n", "k1", "k2").agg(F.min("doc_id").alias("rep"))
    reps = written(described.join(classes, ["n", "k1", "k2"]).select("doc_id", "rep", "n"), "classes", scratch)

    rows = text_bytes(docs) / 6 * 3.7 * (den - num) / (den + num)  # words x prefixes a shingle
    shards = ceil_div(rows, SHARD_ROWS)
    sent = docs.mapInArrow(steady(send_prefixes(k, num, den, shards)), "shard int, blob binary")
    found = written(sent.groupBy("shard").applyInArrow(candidates(num, den), "a long, b long, g long"), "candidates", scratch)
    node = reps.select("doc_id", "rep").distinct()
    to_a, to_b = node.selectExpr("doc_id AS a", "rep AS ra"), node.selectExpr("doc_id AS b", "rep AS rb")
    found = written(found.join(to_a, "a").join(to_b, "b").selectExpr("ra AS a", "rb AS b", "g").where("a <> b").distinct(), "pairs", scratch)
    groups = written(found.selectExpr("g", "a AS doc").unionByName(found.selectExpr("g", "b AS doc")).distinct(), "groups", scratch)
    # all rows of an id count, also those of other classes than the one that it represents: an id is one node
    sets = described.where("n > 0").select(F.col("doc_id").alias("doc"), "n", "parities").distinct()
    pairs = written(possible_links(groups, sets, num, den), "possible", scratch)
    sizes = reps.groupBy(F.col("rep").alias("doc")).agg(F.max("n").alias("n"))
    unit = written(units(pairs, groups, sizes, scratch), "units", scratch)
    total, count = unit.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("c")).first()
    members = unit.drop("n")
    members = F.broadcast(members) if count <= BROADCAST_UNITS else members
    # a representative's rows that are of other classes come too: an id is one node
    texts = holding(docs.selectExpr("doc_id AS doc", "text"), unit.select("doc"), "doc").join(members, "doc")
    links = (
        texts.withColumn("task", F.pmod(F.xxhash64("f", "lo", "hi"), F.lit(ceil_div(total, UNIT_TOKENS))))
        .groupBy("task").applyInArrow(compare(k, num, den), "a long, b long")
    )
    linked = components(written(links, "links", scratch), scratch)
    component = (
        node.join(linked.withColumnRenamed("id", "rep"), "rep", "left")
        .groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component"))
    )
    out = described.join(component, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )
    out = written(out, "components")
    discard(spark, scratch)
    return out


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 4-word shingles, Jaccard 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"))
