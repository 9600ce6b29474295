"""Benchmark decontamination by winnowing (operator 3).

Items and documents are reduced to words (A-Z lower-cased, runs of digits, letters and
non-ASCII characters). An item's windows are its runs of ``window`` words; an item with
fewer words (but not none) is one window. Every window of ``window`` words contributes
its smallest ``k``-gram hash, so a span of ``window`` shared words always shares a
fingerprint. Documents' fingerprints are semi-joined with the items' ones; around each
hit, the candidate windows' own words are joined with the items' windows, which makes
the result exact. Items shorter than ``window`` have no such guarantee and are looked
up by all word runs of their lengths (at most ``window - 1`` different lengths).

Edge cases: null text has no words; rows with a null id are left out; rows that repeat an
id share that id's hits and each keeps its own n_words; empty tables give empty results or
clean documents; columns other than doc_id, item_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.common import ALNUM, chunks, gram_hash, joined_words, run_starts, slide_min, small_batches, steady, string_buffer, table, words

WINDOW = 10
K = 5
#: Item fingerprints are broadcast up to this counted number of 8-byte hashes; beyond it the join shuffles.
BROADCAST_ROWS = 200_000

_ITEM = pa.schema([("item_id", pa.int64()), ("len", pa.int32()), ("h", pa.int64()), ("words", pa.string())])
_MARK = pa.schema([("h", pa.int64()), ("len", pa.int32()), ("doc_id", pa.int64()), ("pos", pa.int32())])
_CAND = pa.schema([("doc_id", pa.int64()), ("pos", pa.int32()), ("len", pa.int32()), ("words", pa.string())])


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _window_min(h: np.ndarray, k: int, window: int) -> np.ndarray:
    """The winnowed hash of every window of ``window`` words."""
    return slide_min(gram_hash(h, k), window - k + 1)


def item_windows(window: int, k: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id").to_numpy(zero_copy_only=False)
            buf, offs = string_buffer(batch.column("text"))
            for a, b in chunks(offs):
                w = words(buf, offs[a : b + 1], ALNUM)
                text, s, e = joined_words(buf, w, ALNUM)
                out: dict[str, list] = {"item_id": [], "len": [], "h": [], "words": []}
                for d in range(b - a):
                    x, y = int(w.first[d]), int(w.first[d + 1])
                    n = min(window, y - x)
                    if not n:
                        continue
                    h = _window_min(w.hash[x:y], k, n) if n == window else gram_hash(w.hash[x:y], n)
                    for i in range(y - x - n + 1):
                        out["item_id"].append(int(ids[a + d]))
                        out["len"].append(n)
                        out["h"].append(int(_signed(h[i : i + 1])[0]))
                        out["words"].append(text[s[x + i] : e[x + i + n - 1]].decode())
                yield pa.RecordBatch.from_pydict(out, schema=_ITEM)

    return rows


def doc_marks(window: int, k: int, short: list[int]):
    """Winnowed fingerprints of documents (len = window), and all runs of the short items' lengths."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            buf, offs = string_buffer(batch.column("text"))
            for a, b in chunks(offs):
                w = words(buf, offs[a : b + 1], ALNUM)
                doc, n = w.doc, len(w.hash)
                parts = []
                if n >= window:
                    at, _ = run_starts(w.first, window)
                    grams = gram_hash(w.hash, k)
                    low = slide_min(grams, window - k + 1)[at]
                    # the position of a window's smallest gram: the first one in it
                    pos = np.full(len(at), -1, np.int64)
                    for j in range(window - k, -1, -1):
                        pos[grams[at + j] == low] = j
                    pos += at
                    if len(pos):
                        new = np.ones(len(pos), bool)
                        new[1:] = pos[1:] != pos[:-1]
                        parts.append((pos[new], low[new], window))
                for m in short:
                    at, _ = run_starts(w.first, m)
                    if len(at):
                        parts.append((at, gram_hash(w.hash, m)[at], m))
                for pos, h, m in parts:
                    d = doc[pos]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(_signed(h)),
                            pa.array(np.full(len(pos), m, np.int32)),
                            pa.array(ids[a + d].astype(np.int64)),
                            pa.array((pos - w.first[d]).astype(np.int32)),
                        ],
                        schema=_MARK,
                    )

    return rows


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id and the number of words of every row."""
    for batch in batches:
        buf, offs = string_buffer(batch.column("text"))
        n = [np.diff(words(buf, offs[a : b + 1], ALNUM, hashed=False).first) for a, b in chunks(offs)]
        n = np.concatenate(n) if n else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64())], ["doc_id", "n"])


def hit_windows(window: int, k: int):
    """The words of every window that contains a hit fingerprint (``hits``: list of pos, len)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            hits = batch.column("hits").to_pylist()
            buf, offs = string_buffer(batch.column("text"))
            for a, b in chunks(offs):
                w = words(buf, offs[a : b + 1], ALNUM, hashed=False)
                text, s, e = joined_words(buf, w, ALNUM)
                out: dict[str, list] = {"doc_id": [], "pos": [], "len": [], "words": []}
                for d in range(b - a):
                    x, n = int(w.first[d]), int(w.first[d + 1] - w.first[d])
                    spans = set()
                    for hit in hits[a + d]:
                        p, m = hit["pos"], hit["len"]
                        first = p + k - window if m == window else p
                        spans.update((i, m) for i in range(max(first, 0), min(p, n - m) + 1))
                    for i, m in spans:
                        out["doc_id"].append(int(ids[a + d]))
                        out["pos"].append(i)
                        out["len"].append(m)
                        out["words"].append(text[s[x + i] : e[x + i + m - 1]].decode())
                yield pa.RecordBatch.from_pydict(out, schema=_CAND)

    return rows


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    k: int = K,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, items (sorted item ids as strings)."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL")
    rows = small_batches(items).mapInArrow(item_windows(window, k), "item_id long, len int, h long, words string")
    marks = rows.select("h", "len").distinct()
    grouped = {r["len"]: r["n"] for r in marks.groupBy("len").agg(F.count(F.lit(1)).alias("n")).collect()}
    small = sum(grouped.values()) <= broadcast_rows
    maybe = F.broadcast if small else (lambda x: x)
    short = sorted(m for m in grouped if m < window)

    found = docs.mapInArrow(steady(doc_marks(window, k, short)), "h long, len int, doc_id long, pos int").join(
        maybe(marks), ["h", "len"], "left_semi"
    )
    hits = found.groupBy("doc_id").agg(F.collect_set(F.struct("pos", "len")).alias("hits"))
    spans = docs.join(hits, "doc_id").mapInArrow(
        steady(hit_windows(window, k)), "doc_id long, pos int, len int, words string"
    )
    windows = rows.select("words", "len").distinct()
    exact = spans.distinct().join(maybe(windows), ["words", "len"], "left_semi")

    covered = exact.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("pos", "len"))).alias("spans"))
    covered = covered.selectExpr(
        "doc_id",
        "aggregate(spans, named_struct('n', 0L, 'upto', 0L), (a, s) -> named_struct("
        "'n', a.n + greatest(0L, s.pos + s.len - greatest(a.upto, CAST(s.pos AS BIGINT))),"
        "'upto', greatest(a.upto, CAST(s.pos + s.len AS BIGINT)))).n AS n_hit",
    )
    pairs = (
        exact.select("doc_id", "words").distinct().join(maybe(rows.select("words", "item_id").distinct()), "words")
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    counts = docs.mapInArrow(steady(word_counts), "doc_id long, n long")
    out = counts.join(covered, "doc_id", "left").join(pairs, "doc_id", "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        listed.alias("items"),
    )


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of every document by every benchmark item (10-word windows)."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")
