"""Shared pieces of the training-data operators: scratch tables and vectorised word hashing.

Texts are handled as the UTF-8 buffers that Arrow hands over. A batch is cut into
chunks of a few MB of whole documents, so a task's memory depends on the chunk size
and the longest single document only.
"""

from __future__ import annotations

import ctypes
import hashlib
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.session import ensure_checkpoint_dir, remove

CHUNK_BYTES = 1 << 20
U64 = np.uint64


#: Rows of an Arrow batch: rows hold whole texts, so Spark's default of 10,000 is lowered to this.
BATCH_ROWS = 1000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after the session's Arrow batches are bounded to ``BATCH_ROWS`` rows (on both sides of the pipe)."""
    conf = df.sparkSession.conf
    now = int(conf.get(BATCH_SETTING, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        conf.set(BATCH_SETTING, str(BATCH_ROWS))
    return df


def release() -> None:
    """Give memory that a task has freed back to the system (workers are reused by later stages)."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def steady(rows):
    """A ``mapInArrow`` function that releases memory when its partition is done."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from rows(batches)
        release()

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, scratch: list[str] | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, lineage cut, readable by every executor.

    ``scratch`` collects the folders, for :func:`discard` when their last reader is done.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    if scratch is not None:
        scratch.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, scratch: list[str]) -> None:
    """Delete scratch tables that nothing reads any more."""
    while scratch:
        remove(spark, scratch.pop())


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of a text column over the whole table (sizes shards; one aggregate row)."""
    return df.agg(F.coalesce(F.sum(F.octet_length(F.col(column))), F.lit(0)).alias("b")).first()["b"]


def ceil_div(a: float, b: float) -> int:
    return max(1, math.ceil(a / b))


#: Bits of the filter in ``maybe_in``: at most FILTER_BITS / 64 rows of two numbers are broadcast.
FILTER_BITS = 1 << 23


def maybe_in(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``df`` with ``_maybe``: false if ``key`` is certainly not among ``ids`` (one column of that name).

    A bitmap of fixed size over hashed ids is joined by broadcast, so wide rows that a join
    with ``ids`` would drop need not be shuffled. Whatever the number of ids, none is missed.
    """
    place = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    words = (
        ids.select(place.alias("_place"))
        .groupBy(F.expr("_place div 64").alias("_word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(_place % 64 AS INT)))").alias("_bits"))
    )
    marked = df.withColumn("_place", place).withColumn("_word", F.expr("_place div 64"))
    bit = F.expr("(shiftright(coalesce(_bits, 0L), CAST(_place % 64 AS INT)) & 1L) = 1").alias("_maybe")
    return marked.join(F.broadcast(words), "_word", "left").select(*df.columns, bit)


def holding(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among ``ids``, for a join that follows."""
    return maybe_in(df, ids, key).where("_maybe").drop("_maybe")


# ---- text buffers -------------------------------------------------------------


def string_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offs[0] : offs[-1]], offs - offs[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (a longer single document is a range of its own)."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def _lut(is_word, lower: bool) -> np.ndarray:
    """Byte -> 0 outside words, else the byte (A-Z lower-cased on request) + 1."""
    out = np.zeros(256, np.uint16)
    for b in range(256):
        c = b + 32 if lower and 0x41 <= b <= 0x5A else b
        if is_word(c):
            out[b] = c + 1
    return out


#: Words are maximal runs of bytes other than ASCII white space.
PLAIN = _lut(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D, lower=False)
#: The same with A-Z lower-cased.
LOWER = _lut(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D, lower=True)
#: A-Z lower-cased; words are runs of digits, a-z and non-ASCII bytes.
ALNUM = _lut(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80, lower=True)

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(0, 2**64, 257, dtype=U64)
_PLACE = _rng.integers(0, 2**64, 1 << 12, dtype=U64) | U64(1)
_STEP = _rng.integers(0, 2**64, 64, dtype=U64) | U64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes."""
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    h = h ^ (h >> U64(29))
    h = h * U64(0x9FB21C651E98DF25)
    return h ^ (h >> U64(32))


@dataclass
class Words:
    """The words of a range of documents; ``first[d]`` is the index of document d's first word."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(buf: np.ndarray, offsets: np.ndarray, lut: np.ndarray, hashed: bool = True) -> Words:
    """Words of the documents ``buf[offsets[d]:offsets[d+1]]`` (positions are within ``buf``).

    Hashes are multilinear over the word's bytes, so equal words have equal hashes in
    every task, and different words collide with probability about 2**-64.
    """
    lo, hi = int(offsets[0]), int(offsets[-1])
    code = lut[buf[lo:hi]]
    inside = code != 0
    edge = np.empty(len(inside) + 1, bool)
    if not len(inside):
        z = np.zeros(0, np.int64)
        return Words(z, z, np.zeros(len(offsets), np.int64), np.zeros(0, U64))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cut = (offsets[1:-1] - lo).astype(np.int64)
    cut = cut[(cut > 0) & (cut < len(inside))]
    begins[cut] = inside[cut]
    ends[cut - 1] = inside[cut - 1]
    del edge
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets - lo)
    if not hashed:
        return Words(start + lo, end + lo, first, np.zeros(0, U64))
    at = np.flatnonzero(inside)
    length = end - start
    before = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=before[1:])
    place = np.arange(len(at)) - np.repeat(before[:-1], length)
    term = _BYTE[code[at]]
    if len(length) and length.max() > len(_PLACE):  # very long words: blocks of places get other weights
        term = mix(term + (place // len(_PLACE)).astype(U64) * U64(0x9E3779B97F4A7C15))
    term *= _PLACE[place & (len(_PLACE) - 1)]
    h = np.add.reduceat(term, before[:-1]) if len(start) else np.zeros(0, U64)
    return Words(start + lo, end + lo, first, mix(h + length.astype(U64)))


#: Bytes up to which units are hashed side by side.
SHORT_UNIT = 64
_LOW = np.array([(1 << (8 * i)) - 1 for i in range(9)], U64)


def span_hash(raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hash of the bytes ``raw[s : s + n]`` for every start and length, eight bytes at a time (for tables within a process)."""
    eight = np.lib.stride_tricks.sliding_window_view(np.concatenate((raw, np.zeros(8, np.uint8))), 8)
    h = mix(length.astype(U64) + U64(0x9E3779B97F4A7C15))
    at, done = np.flatnonzero(length <= SHORT_UNIT), 0
    while len(at := at[length[at] > done]):
        part = eight[start[at] + done].view(U64)[:, 0] & _LOW[np.minimum(length[at] - done, 8)]
        h[at] = mix(h[at] ^ part)
        done += 8
    for i in np.flatnonzero(length > SHORT_UNIT).tolist():
        digest = hashlib.blake2b(raw[start[i] : start[i] + length[i]].tobytes(), digest_size=8).digest()
        h[i] = int.from_bytes(digest, "little")
    return h


class Slots:
    """Numbers 0, 1, ... of hashes in the order they are added: an open table of 12 bytes a place, at most half full."""

    def __init__(self, places: int = 1 << 16):
        self.hash = np.zeros(places, np.int64)
        self.slot = np.full(places, -1, np.int32)
        self.count = 0

    def __len__(self) -> int:
        return self.count

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, or -1."""
        out, todo, at = np.full(len(h), -1, np.int64), np.arange(len(h)), h & (len(self.hash) - 1)
        while len(todo):
            slot, same = self.slot[at], self.hash[at] == h[todo]
            hit = same & (slot >= 0)
            out[todo[hit]] = slot[hit]
            on = ~same & (slot >= 0)
            todo, at = todo[on], (at[on] + 1) & (len(self.hash) - 1)
        return out

    def add(self, h: np.ndarray):
        """Number different hashes that are not in the table."""
        if 2 * (self.count + len(h)) > len(self.hash):
            places = len(self.hash)
            while 2 * (self.count + len(h)) > places:
                places *= 2
            used = np.flatnonzero(self.slot >= 0)
            held, slot = self.hash[used], self.slot[used]
            self.hash, self.slot = np.zeros(places, np.int64), np.full(places, -1, np.int32)
            self._put(held, slot)
        self._put(h, np.arange(self.count, self.count + len(h), dtype=np.int32))
        self.count += len(h)

    def _put(self, h: np.ndarray, slot: np.ndarray):
        at = h & (len(self.hash) - 1)
        while len(h):
            free = self.slot[at] < 0
            self.slot[at[free]] = slot[free]
            lost = self.slot[at] != slot  # taken before, or by another one now
            self.hash[at[~lost]] = h[~lost]
            h, slot, at = h[lost], slot[lost], (at[lost] + 1) & (len(self.hash) - 1)


def gram_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive entries (length ``len(h) - k + 1``, or none)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    for j in range(k):
        out += h[j : j + n] * _STEP[j % 64] if j < 64 else mix(h[j : j + n] + U64(j))
    return mix(out + U64(k))


def run_starts(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all runs of ``k`` words that lie within one document, and each document's run count."""
    n = np.maximum(np.diff(first) - k + 1, 0)
    total = int(n.sum())
    base = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(n)[:-1])), n)
    return base + np.arange(total), n


def slide_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive entries (by doubling)."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    span, out = 1, x
    while span * 2 <= w:
        out = np.minimum(out[: len(out) - span], out[span:])
        span *= 2
    return np.minimum(out[:n], out[w - span : w - span + n])


def joined_words(buf: np.ndarray, w: Words, lut: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words as one byte string with a blank after each, and each word's start and end in it."""
    length = w.end - w.start
    end = np.cumsum(length + 1) - 1
    start = end - length
    out = np.full(int(end[-1]) + 1 if len(end) else 0, 0x20, np.uint8)
    if len(end):
        src = np.repeat(w.start - start, length) + (at := _ranges(start, length))
        out[at] = (lut[buf[src]] - 1).astype(np.uint8)
    return out.tobytes(), start, end


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    total = int(length.sum())
    before = np.concatenate(([0], np.cumsum(length)[:-1]))
    return np.arange(total) + np.repeat(start - before, length)


ranges = _ranges
