"""Substring deduplication with FM-indexes per shard (operator 1).

A word of a document is removed when a window of ``window`` consecutive words that
covers it also starts in a document with a smaller id. All texts are indexed and all
texts are streamed as queries, without comparing every document with every shard:

1. Documents are dealt to blocks by id. Each window has an anchor, the smallest hash of
   its ``k``-word grams; consecutive windows with one anchor form a segment. Equal
   windows have equal anchors, so dealing segments to shards by anchor brings all
   occurrences of a window together. A block sends every different segment once, with
   the smallest id that holds it (a passage in a third of all rows costs one entry a
   block). An anchor with very many different segments (a passage among words of each
   document's own), found in a sample, is split: each of its windows is a segment by
   itself, dealt by the hash of the whole window.
2. Each shard builds an FM-index of its different segments: a BWT ordered to the depth of
   a window, in a wavelet matrix with packed bit vectors. Segments are then streamed by
   backward search: first the anchor that all windows of a segment contain - an interval
   of one suffix proves that the whole segment is unmatched - then each window, which
   ends when its interval holds itself only. Searches that have matched the same words
   so far take a step once. Intervals that reach ``window`` words are reported with the
   smallest id in them.
3. Reports go back to the blocks, which still have the documents (the same shuffle),
   and each document's covered words are cut.

Work and traffic are proportional to the text: the number of blocks and shards grows with
the corpus. What one task gets of an anchor is bounded by the sample's threshold, and of a
window by one entry a block. Which anchors are split does not change the result.

Edge cases: null or empty text has no words and the hash of nothing; texts under
``window`` words stay whole; rows with a null id are left out; rows that repeat an id are
judged separately (an equal id is not smaller); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.common import (
    U64,
    ceil_div,
    chunks,
    gram_hash,
    mix,
    ranges,
    run_starts,
    slide_min,
    small_batches,
    span_hash,
    steady,
    string_buffer,
    table,
    text_bytes,
)

WINDOW = 13
ANCHOR = 4
#: Bytes of text in a block, and words in a shard, on average.
BLOCK_BYTES = 12 << 20
SHARD_WORDS = 1_200_000
#: A segment has at most this many windows, so that periodic texts repeat the same segments.
RUN = 64
#: An anchor is split beyond this share of a shard's words in different segments, counted in one document of SAMPLE.
HOT_SHARE = 0.25
SAMPLE = 32
SEGMENT_WORDS = 17

_PLACES = np.random.Generator(np.random.PCG64(7)).integers(0, 2**64, 1 << 10, dtype=U64) | U64(1)

SEGMENTS = pa.schema([("shard", pa.int32()), ("p", pa.int32()), ("text", pa.binary()), ("owner", pa.binary())])
REPORTS = pa.schema([("p", pa.int32()), ("shard", pa.int32()), ("found", pa.binary())])
RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
)


# ---- words ----------------------------------------------------------------------

#: White space as blanks.
_BLANKS = bytes.maketrans(b"\t\n\v\f\r", b"     ")


@dataclass
class Line:
    """The words of some documents, each followed by one blank; ``first[d]`` is the index of document d's first word."""

    text: bytes
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def hash(self) -> np.ndarray:
        return span_hash(np.frombuffer(self.text, np.uint8), self.start, self.end - self.start)


def line_of(buf: np.ndarray, offs: np.ndarray) -> Line:
    """The words (runs of bytes other than ASCII white space) of documents in a buffer."""
    raw = buf[int(offs[0]) : int(offs[-1])].tobytes()
    offs = offs - offs[0]
    edges = offs.tolist()
    # a blank after each document, so that no word goes on in the next one
    text = b" ".join([raw[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)] + [b""]).translate(_BLANKS)
    data = np.frombuffer(text, np.uint8)
    inside = data != 0x20
    turn = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        turn = np.concatenate(([0], turn))
    start, end = turn[::2], turn[1::2]
    first = np.searchsorted(start, offs + np.arange(len(offs)))
    size = np.cumsum(end - start + 1)
    if len(text) != (int(size[-1]) if len(size) else 0):  # more white space than one blank a word
        inside[end] = True
        text = data[inside].tobytes()
        start, end = size - (end - start + 1), size - 1
    return Line(text, start, end, first)


# ---- blocks ---------------------------------------------------------------------


@dataclass
class Block:
    """A block's segments: occurrences (document row, first word) and the different ones, by (shard, hash)."""

    row: np.ndarray  # of each occurrence
    word: np.ndarray  # its first word, within the document
    windows: np.ndarray  # its number of windows
    kind: np.ndarray  # index of its different segment
    shard: np.ndarray  # of each different segment
    owner: np.ndarray  # the smallest id that holds it
    size: np.ndarray  # its windows
    text: list[bytes]
    lines: list[tuple[int, int, Line]]  # ranges of rows and their words


def _in_sorted(x: np.ndarray, some: np.ndarray) -> np.ndarray:
    if not len(some):
        return np.zeros(len(x), bool)
    return some[np.minimum(np.searchsorted(some, x), len(some) - 1)] == x


def _segment_starts(at: np.ndarray, anchor: np.ndarray, doc: np.ndarray, split: np.ndarray) -> np.ndarray:
    """Indexes of the windows (at their words ``at``) that begin a segment."""
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | split[1:]
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(at)))
    if length.max() > RUN:
        new |= (np.arange(len(at)) - np.repeat(begin, length)) % RUN == 0
        begin = np.flatnonzero(new)
    return begin


def segments(
    ids: np.ndarray, buf: np.ndarray, offs: np.ndarray, shards: int, window: int, k: int, texts: bool, hot: np.ndarray
) -> Block:
    """The segments of a block; windows whose anchor is in ``hot`` (ascending) are segments by themselves."""
    parts: list[tuple[np.ndarray, ...]] = []
    lines: list[tuple[int, int, Line]] = []
    before = 0
    for a, b in chunks(offs):
        line = line_of(buf, offs[a : b + 1])
        lines.append((a, b, line))
        at, per_doc = run_starts(line.first, window)
        if len(at):
            h = line.hash
            anchor = slide_min(gram_hash(h, k), window - k + 1)[at]
            doc = np.repeat(np.arange(b - a), per_doc)
            split = _in_sorted(anchor, hot)
            begin = _segment_starts(at, anchor, doc, split)
            count = np.diff(np.append(begin, len(at)))
            first, length = at[begin], count + window - 1
            digest = sequence_hash(h, first, length)
            d = doc[begin]
            span = (line.start[first] + before, line.end[first + length - 1] + before)
            parts.append((d + a, first - line.first[d], count, digest, np.where(split[begin], digest, anchor[begin]), *span))
        before += len(line.text)
    if not parts:
        z = np.zeros(0, np.int64)
        return Block(z, z, z, z, z, z, z, [], lines)
    row, word, count, digest, route, start, end = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    shard = (mix(route) % U64(shards)).astype(np.int64)
    _, pick, kind = np.unique(digest, return_index=True, return_inverse=True)
    order = np.argsort(shard[pick], kind="stable")  # by (shard, digest)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    kind, pick = back[kind], pick[order]
    owner = np.full(len(pick), np.iinfo(np.int64).max)
    np.minimum.at(owner, kind, ids[row])
    text: list[bytes] = []
    if texts:
        whole = b"".join([line.text for _, _, line in lines])
        text = [whole[s:e] for s, e in zip(start[pick].tolist(), end[pick].tolist(), strict=True)]
    return Block(row, word, count, kind, shard[pick], owner, count[pick], text, lines)


def sequence_hash(h: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hash of the word sequences h[first : first + length]."""
    if not len(first):
        return np.zeros(0, U64)
    before = np.concatenate(([0], np.cumsum(length)[:-1]))
    every = np.arange(int(length.sum()))
    place = every - np.repeat(before, length)
    term = h[every + np.repeat(first - before, length)]
    term *= _PLACES[place & (len(_PLACES) - 1)]
    return mix(np.add.reduceat(term, before) + length.astype(U64))


def _rows(tbl: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    buf, offs = string_buffer(tbl.column("text"))
    return tbl.column("doc_id").to_numpy().astype(np.int64), buf, offs


def _packed(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def _unpacked(x: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind)


def count_segments(window: int, k: int):
    """(anchor, digest) of the different segments of each batch."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = string_buffer(batch.column("text"))
            for a, b in chunks(offs):
                line = line_of(buf, offs[a : b + 1])
                at, per_doc = run_starts(line.first, window)
                if not len(at):
                    continue
                h = line.hash
                anchor = slide_min(gram_hash(h, k), window - k + 1)[at]
                begin = _segment_starts(at, anchor, np.repeat(np.arange(b - a), per_doc), np.zeros(len(at), bool))
                length = np.diff(np.append(begin, len(at))) + window - 1
                digest, pick = np.unique(sequence_hash(h, at[begin], length), return_index=True)
                both = (anchor[begin][pick].view(np.int64), digest.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in both], ["anchor", "digest"])

    return rows


def hot_anchors(docs: DataFrame, window: int, k: int, most: float, sample: int) -> np.ndarray:
    """Anchors with more than about ``most`` different segments, ascending; there are at most segments / most."""
    some = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(sample)) == 0).select("text")
    found = small_batches(some).mapInArrow(steady(count_segments(window, k)), "anchor long, digest long").distinct()
    rows = found.groupBy("anchor").count().where(F.col("count") * sample > most).select("anchor").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).view(U64))


def send_segments(shards: int, window: int, k: int, hot: np.ndarray):
    def send(key: tuple, tbl: pa.Table) -> pa.Table:
        block = segments(*_rows(tbl), shards, window, k, texts=True, hot=hot)
        out: dict[str, list] = {f.name: [] for f in SEGMENTS}
        edges = np.append(np.flatnonzero(np.diff(block.shard, prepend=-1)), len(block.shard))
        zip_text = zstandard.ZstdCompressor(level=3)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            out["shard"].append(int(block.shard[a]))
            out["p"].append(key[0].as_py())
            out["text"].append(zip_text.compress(b"\n".join(block.text[a:b])))
            out["owner"].append(_packed(block.owner[a:b]))
        return pa.Table.from_pydict(out, schema=SEGMENTS)

    return send


# ---- the index of a shard ----------------------------------------------------------


def _sorted(first: np.ndarray, second: np.ndarray, at: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """``at`` by (first, second, at), and where a pair of first and second begins; no number is above ``top``."""
    width = top.bit_length()
    if 3 * width <= 64:  # one sort of packed keys
        w, w2 = U64(width), U64(2 * width)
        packed = np.sort((first.astype(U64) << w2) | (second.astype(U64) << w) | at.astype(U64))
        at = (packed & U64((1 << width) - 1)).astype(np.int64)
        packed >>= w
        new = packed[1:] != packed[:-1]
    else:
        order = np.lexsort((at, second, first))
        first, second, at = first[order], second[order], at[order]
        new = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    return at, np.concatenate(([True], new))


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by their first ``depth`` symbols, then by position; 0 follows the end.

    By doubling. A rank is the place of the first position with the same symbols so far, so a
    position that is alone keeps its rank, and only the others are sorted again.
    """
    n, reach = len(text), 1
    count = np.bincount(text)
    rank = (np.cumsum(count) - count)[text]
    spot = at = order = np.arange(n)
    while reach < depth and len(at):
        step = min(reach, depth - reach)
        after = at + step
        follow = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        at, new = _sorted(rank[at], follow, at, n)
        if reach == 1:
            order = at
        else:
            order[spot] = at
        reach += step
        if reach < depth:
            begin = np.flatnonzero(new)
            rank[at] = np.repeat(spot[begin], np.diff(np.append(begin, len(at))))
            many = ~(new & np.append(new[1:], True))
            spot, at = spot[many], at[many]
    return order


class WaveletMatrix:
    """Rank queries on a symbol sequence; one packed bit vector a level."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.n, self.levels = len(symbols), levels
        self.bits, self.ones, self.zeros = [], [], []
        a = symbols.astype(np.uint32)
        for level in range(levels - 1, -1, -1):
            flags = ((a >> np.uint32(level)) & np.uint32(1)).astype(bool)
            packed = np.packbits(flags, bitorder="little")
            packed = np.concatenate((packed, np.zeros(-len(packed) % 8 + 8, np.uint8))).view(U64)
            ones = np.zeros(len(packed) + 1, np.int64)
            np.cumsum(np.bitwise_count(packed), out=ones[1:])
            self.bits.append(packed)
            self.ones.append(ones)
            self.zeros.append(self.n - int(ones[-1]))
            a = a[np.concatenate((np.flatnonzero(~flags), np.flatnonzero(flags)))]
        # where each symbol's run starts after the last level
        run = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
        self.start = np.zeros(1 << levels, np.int64)
        self.start[a[run]] = run

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before ``upto``."""
        at = upto
        for level in range(self.levels):
            word = at >> 6
            below = (U64(1) << (at & 63).view(U64)) - U64(1)
            ones = self.ones[level][word] + np.bitwise_count(self.bits[level][word] & below)
            one = (symbol & (1 << (self.levels - 1 - level))) != 0
            at = np.where(one, ones + self.zeros[level], at - ones)
        return at - self.start[symbol]


class FMIndex:
    """Backward search over segments (symbols from 1; each segment is followed by a 0)."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        self.order = suffix_order(text, depth)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols + 1))))
        levels = max(1, int(symbols).bit_length())
        self.bwt = WaveletMatrix(text[self.order - 1], levels)

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step of many searches, taken once for those that have matched the same symbols."""
        _, pick, same = np.unique(symbol * (self.bwt.n + 1) + lo, return_index=True, return_inverse=True)
        symbol = np.tile(symbol[pick], 2)
        at = self.bwt.rank(symbol, np.concatenate((lo[pick], hi[pick]))) + self.before[symbol]
        return at[: len(pick)][same], at[len(pick) :][same]

    def search(self, text: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of text[start : start + length]: (which still match elsewhere, lo, hi).

        A search ends when its interval holds a single suffix, its own.
        """
        live = np.arange(len(start))
        symbol = text[start + length - 1]
        lo, hi = self.before[symbol], self.before[symbol + 1]
        for back in range(2, length + 1):
            keep = hi - lo > 1
            live, lo, hi = live[keep], lo[keep], hi[keep]
            if not len(live):
                break
            lo, hi = self.extend(text[start[live] + length - back], lo, hi)
        keep = hi - lo > 1
        return live[keep], lo[keep], hi[keep]


def search_shard(window: int, k: int):
    def search(key: tuple, tbl: pa.Table) -> pa.Table:
        blocks = tbl.column("p").to_pylist()
        unzip = zstandard.ZstdDecompressor()
        lines = [unzip.decompress(x.as_py()) for x in tbl.column("text")]
        owner = np.concatenate([_unpacked(x.as_py(), np.int64) for x in tbl.column("owner")])
        sizes = np.array([x.count(b"\n") + 1 for x in lines])
        joined = b"\n".join(lines) + b"\n"
        del lines
        buf = np.frombuffer(joined, np.uint8)
        # a blank follows each word, a line feed the last one of a segment
        end = np.flatnonzero((buf == 0x20) | (buf == 0x0A))
        first = np.concatenate(([0], np.flatnonzero(buf[end] == 0x0A) + 1))
        start = np.concatenate(([0], end[:-1] + 1))
        h = span_hash(buf, start, end - start)
        del buf, joined, start, end
        length = np.diff(first)
        digest = sequence_hash(h, first[:-1], length)
        _, pick, kind = np.unique(digest, return_index=True, return_inverse=True)
        least = np.full(len(pick), np.iinfo(np.int64).max)
        np.minimum.at(least, kind, owner)

        # the text of the index: the different segments, each followed by a 0
        length = length[pick]
        source = ranges(first[:-1][pick], length)
        begin = np.concatenate(([0], np.cumsum(length + 1)[:-1]))
        coded = pa.array(h[source].view(np.int64)).dictionary_encode()
        text = np.zeros(int((length + 1).sum()), np.int64)
        text[ranges(begin, length)] = coded.indices.to_numpy().astype(np.int64) + 1
        grams = gram_hash(h, k)
        index = FMIndex(text, len(coded.dictionary), window)

        # a gram that all windows of a segment contain: the last smallest one of the first window
        windows = length - window + 1
        span = window - k + 1
        head = grams[first[:-1][pick][:, None] + np.arange(span)]
        at = span - 1 - np.argmin(head[:, ::-1], axis=1)
        shared = at >= windows - 1
        seg = np.flatnonzero(shared)
        live, _, _ = index.search(text, begin[seg] + at[seg], k)
        seg = np.concatenate((seg[live], np.flatnonzero(~shared)))

        # every window of the remaining segments
        base = np.concatenate(([0], np.cumsum(windows)))
        best = np.repeat(least, windows)  # the smallest id that has the window
        place = ranges(np.zeros(len(seg), np.int64), windows[seg])
        of = np.repeat(seg, windows[seg])
        live, lo, hi = index.search(text, begin[of] + place, window)
        if len(live):
            ivl, pick, inverse = np.unique(lo, return_index=True, return_inverse=True)
            size = hi[pick] - ivl
            holder = np.searchsorted(begin, index.order[ranges(ivl, size)], side="right") - 1
            low = np.minimum.reduceat(least[holder], np.cumsum(size) - size)
            spot = base[of[live]] + place[live]
            best[spot] = np.minimum(best[spot], low[inverse])

        # windows with a smaller id than the block's own smallest one
        out: dict[str, list] = {f.name: [] for f in REPORTS}
        lowest = np.minimum.reduceat(best, base[:-1])
        a = 0
        for p, n in zip(blocks, sizes.tolist(), strict=True):
            entry = np.flatnonzero(lowest[kind[a : a + n]] < owner[a : a + n])
            if len(entry):
                u = kind[a + entry]
                each = np.repeat(entry, windows[u])
                at = ranges(np.zeros(len(u), np.int64), windows[u])
                low = best[ranges(base[u], windows[u])]
                hit = low < owner[a + each]
                out["p"].append(p)
                out["shard"].append(key[0].as_py())
                out["found"].append(_packed(np.stack((each[hit], at[hit], low[hit]))))
            a += n
        return pa.Table.from_pydict(out, schema=REPORTS)

    return search


# ---- cutting ---------------------------------------------------------------------


def cut_block(shards: int, window: int, k: int, hot: np.ndarray):
    def cut(key: tuple, tbl: pa.Table, reports: pa.Table) -> pa.Table:
        ids, buf, offs = _rows(tbl)
        block = segments(ids, buf, offs, shards, window, k, texts=False, hot=hot)
        base = np.concatenate(([0], np.cumsum(block.size)))
        best = np.repeat(block.owner, block.size)
        for shard, found in zip(reports.column("shard").to_pylist(), reports.column("found"), strict=True):
            entry, at, low = _unpacked(found.as_py(), np.int64).reshape(3, -1)
            spot = base[np.searchsorted(block.shard, shard) + entry] + at
            best[spot] = np.minimum(best[spot], low)
        # occurrences of windows that a smaller id has
        if len(block.row):
            lowest = np.minimum.reduceat(best, base[:-1])
            some = np.flatnonzero(lowest[block.kind] < ids[block.row])
        else:
            some = np.zeros(0, np.int64)
        each = np.repeat(some, block.windows[some])
        at = ranges(np.zeros(len(some), np.int64), block.windows[some])
        hit = best[base[block.kind[each]] + at] < ids[block.row[each]]
        row, word = block.row[each[hit]], (block.word[each] + at)[hit]
        out: dict[str, list] = {f.name: [] for f in RESULT}
        for a, b, w in block.lines:
            text, s, e = w.text, w.start, w.end
            mine = (row >= a) & (row < b)
            start = w.first[row[mine] - a] + word[mine]
            cover = np.zeros(len(s) + 1, np.int64)
            np.add.at(cover, start, 1)
            np.add.at(cover, start + window, -1)
            gone = np.cumsum(cover[:-1]) > 0
            lost = np.concatenate(([0], np.cumsum(gone)))
            for d in range(b - a):
                x, y = int(w.first[d]), int(w.first[d + 1])
                removed = int(lost[y] - lost[x])
                if not removed:
                    kept = text[s[x] : e[y - 1]] if y > x else b""
                else:
                    i = np.flatnonzero(~gone[x:y]) + x
                    # runs of kept words are contiguous in the joined text
                    new = np.flatnonzero(np.diff(i, prepend=-2) != 1)
                    last = np.append(new[1:], len(i)) - 1
                    kept = b" ".join([text[p:q] for p, q in zip(s[i[new]], e[i[last]], strict=True)]) if len(i) else b""
                out["doc_id"].append(int(ids[a + d]))
                out["n_words"].append(y - x)
                out["n_removed"].append(removed)
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        return pa.Table.from_pydict(out, schema=RESULT)

    return cut


def dedup_substrings(
    documents: DataFrame,
    window: int = WINDOW,
    k: int = ANCHOR,
    block_bytes: int = BLOCK_BYTES,
    shard_words: int = SHARD_WORDS,
    sample: int = SAMPLE,
) -> DataFrame:
    """doc_id, n_words, n_removed and the hash of the kept words of every document."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    size = text_bytes(docs)
    blocks = ceil_div(size, block_bytes)
    # a segment has about (window - k + 2) / 2 windows, hence this many words for each word of text
    spread = 1 + (window - 1) / ((window - k + 2) / 2)
    shards = ceil_div(size / 6 * spread, shard_words)
    hot = hot_anchors(docs, window, k, HOT_SHARE * shard_words / SEGMENT_WORDS, sample)
    dealt = docs.withColumn("p", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int"))
    sent = dealt.groupBy("p").applyInArrow(send_segments(shards, window, k, hot), "shard int, p int, text binary, owner binary")
    reports = sent.groupBy("shard").applyInArrow(search_shard(window, k), "p int, shard int, found binary")
    return (
        dealt.groupBy("p")
        .cogroup(reports.groupBy("p"))
        .applyInArrow(
            cut_block(shards, window, k, hot), "doc_id long, n_words long, n_removed long, kept_sha256 string"
        )
    )


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """13-word windows of every document against all documents."""
    return dedup_substrings(table(spark, sf_dir, "documents"))
