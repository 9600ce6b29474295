"""Token-id output: per-document zstandard frames with one shared dictionary (operator 2).

A store is a folder of two Parquet tables: ``dictionary`` (its SHA-256 and bytes) and
``blocks``. A block row holds consecutive documents in ascending order of id: their ids,
token counts, the offset of each document's own frame, the frames and the hash of the
dictionary that they need. One document is read by decompressing its frame alone. Ids are
little-endian unsigned 16-bit numbers, or 32-bit ones where the vocabulary or ``end_id`` needs
them (a ``width`` that is too small is an error); every document ends with ``end_id``.

The dictionary is trained on at most ``SAMPLE_DOCS`` documents - different (id, text) pairs, so an id
that repeats is no more than its texts - of which at most ``SAMPLE_BYTES`` bytes each reach the driver.

Documents are range partitioned by id before they are encoded, so files are in ascending
order; a partition's token total is one number, and running sums over the totals, in two levels, give
each document's start without any list of them on the driver.

Edge cases: null text counts as empty (the end id only); rows with a null id are left out;
rows that repeat an id are stored one after the other, smaller texts first; an empty table
gives an empty store; very long texts are one frame; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assay.llm.common import ceil_div, scratch_path, small_batches, steady, string_buffer, table, text_bytes
from assay.llm.tokens import Encoder, default_model

#: Documents that train the dictionary, bytes of ids taken from each, and the dictionary's size.
SAMPLE_DOCS = 1000
SAMPLE_BYTES = 16 << 10
DICTIONARY_BYTES = 64 << 10
#: Text of a partition, and compressed bytes of a block.
PARTITION_BYTES = 32 << 20
BLOCK_BYTES = 1 << 20
LEVEL = 3
#: Partitions (in ascending order of ids) whose token totals are summed together.
STRETCH = 4096

BLOCKS = (
    "part int, seq int, first_doc long, doc_ids array<long>, n_tokens array<int>, offsets array<long>, "
    "width int, dictionary string, frames binary"
)


def _samples(model: str, end_id: int, width: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.get(model)
        for batch in batches:
            buf, offs = string_buffer(batch.column("text"))
            out = []
            for _, _, ids, ends in encoder.encode(buf, offs):
                for x, y in zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), strict=True):
                    out.append(np.append(ids[x:y], end_id).astype(f"<u{width}").tobytes()[:SAMPLE_BYTES])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])

    return rows


def least_width(model: str, end_id: int) -> int:
    """Bytes of an id: two if every id of the vocabulary and the end id fit."""
    size = Encoder.get(model).tokenizer.get_vocab_size(with_added_tokens=True)
    return 2 if max(size - 1, end_id) < 1 << 16 else 4


def sample_of(docs: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` different (doc_id, text) pairs, those with the smallest hash."""
    keys = docs.select("doc_id", F.xxhash64("text").alias("_h"))
    chosen = keys.distinct().orderBy(F.xxhash64("doc_id", "_h"), "doc_id", "_h").limit(rows)
    # at most ``rows`` pairs of numbers: a bounded broadcast; equal pairs are combined before the shuffle
    found = docs.withColumn("_h", F.xxhash64("text")).join(F.broadcast(chosen), ["doc_id", "_h"])
    return found.groupBy("doc_id", "_h").agg(F.first("text", ignorenulls=True).alias("text")).drop("_h")


def train_dictionary(docs: DataFrame, model: str, end_id: int, width: int) -> bytes:
    """A dictionary from a bounded sample of documents; empty if they are fewer than eight."""
    rows = sample_of(docs, SAMPLE_DOCS).mapInArrow(_samples(model, end_id, width), "ids binary")
    samples = sorted(bytes(r["ids"]) for r in rows.collect())  # at most SAMPLE_DOCS x SAMPLE_BYTES
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:  # too little to learn from
        return b""


def _encode_blocks(model: str, end_id: int, width: int, dictionary: bytes):
    digest = hashlib.sha256(dictionary).hexdigest()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seq = Encoder.get(model), 0
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=False)
        part = TaskContext.get().partitionId()
        docs: list[int] = []
        counts: list[int] = []
        frames: list[bytes] = []
        size = 0

        def block() -> pa.RecordBatch:
            offsets = np.concatenate(([0], np.cumsum([len(f) for f in frames]))).tolist()
            values = (part, seq, docs[0], docs, counts, offsets, width, digest, b"".join(frames))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int32(), pa.string(), pa.binary())
            names = [c.split()[0] for c in BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for batch in batches:
            own = batch.column("doc_id").to_pylist()
            buf, offs = string_buffer(batch.column("text"))
            for a, _, ids, ends in encoder.encode(buf, offs):
                for d, (x, y) in enumerate(zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), strict=True)):
                    frame = pack.compress(np.append(ids[x:y], end_id).astype(f"<u{width}").tobytes())
                    docs.append(own[a + d])
                    counts.append(y - x + 1)
                    frames.append(frame)
                    size += len(frame)
                    if size >= BLOCK_BYTES:
                        yield block()
                        seq, size = seq + 1, 0
                        docs, counts, frames = [], [], []
        if docs:
            yield block()

    return rows


def write_store(documents: DataFrame, path: str, model: str | None = None, end_id: int = 0, width: int | None = None) -> None:
    """Encode ``documents`` (doc_id, text) into a store at ``path``."""
    model = model or default_model()
    needed = least_width(model, end_id)
    width = width or needed
    if width not in (2, 4) or width < needed:
        raise ValueError(f"ids of this vocabulary need {needed} bytes, not {width}")
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    dictionary = train_dictionary(docs, model, end_id, width)
    spark.createDataFrame(
        [(hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary))], "hash string, bytes binary"
    ).write.parquet(f"{path}/dictionary")
    parts = ceil_div(text_bytes(docs), PARTITION_BYTES)
    ordered = docs.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    blocks = small_batches(ordered).mapInArrow(steady(_encode_blocks(model, end_id, width, dictionary)), BLOCKS)
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")


def _decode(dictionary: bytes):
    digest = hashlib.sha256(dictionary).hexdigest()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        unpack = zstandard.ZstdDecompressor(dict_data=shared)
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary"] != digest:
                    raise ValueError(f"block needs dictionary {row['dictionary']}, the store has {digest}")
                ids, start, crc, at = row["doc_ids"], [], [], 0
                frames, offsets = memoryview(row["frames"]), row["offsets"]
                for i, n in enumerate(row["n_tokens"]):
                    raw = unpack.decompress(frames[offsets[i] : offsets[i + 1]])
                    tokens = np.frombuffer(raw, f"<u{row['width']}")
                    if len(tokens) != n:
                        raise ValueError(f"document {ids[i]}: {len(tokens)} ids instead of {n}")
                    start.append(at)
                    crc.append(zlib.crc32(tokens.astype("<u4").tobytes()))
                    at += n
                m = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array([row["part"]] * m, pa.int32()),
                        pa.array([row["seq"]] * m, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(row["n_tokens"], pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "part", "seq", "at", "n_tokens", "ids_crc32"],
                )

    return rows


def store_dictionary(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/dictionary").first()["bytes"])


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every stored document, from its own frame."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    decoded = blocks.mapInArrow(
        _decode(store_dictionary(spark, path)),
        "doc_id long, part int, seq int, at long, n_tokens long, ids_crc32 long",
    )
    sizes = blocks.selectExpr(
        "part", "seq", "first_doc", "aggregate(n_tokens, 0L, (a, n) -> a + CAST(n AS BIGINT)) AS n"
    )
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("part", "seq", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("before"))
    # a running sum over partitions in two levels: within stretches of them, and over the stretches' totals
    parts = sizes.groupBy("part").agg(F.min("first_doc").alias("first"), F.sum("n").alias("n"))
    parts = parts.withColumn("stretch", F.expr(f"part div {STRETCH}"))
    upto = Window.partitionBy("stretch").orderBy("first", "part").rowsBetween(Window.unboundedPreceding, -1)
    inner = parts.select("part", "stretch", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("inner"))
    stretches = parts.groupBy("stretch").agg(F.min("first").alias("first"), F.sum("n").alias("n"))
    above = Window.orderBy("first", "stretch").rowsBetween(Window.unboundedPreceding, -1)  # one row a stretch
    outer = stretches.select("stretch", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("outer"))
    offset = inner.join(outer, "stretch").selectExpr("part", "outer + inner AS offset")
    return (
        decoded.join(base.join(offset, "part"), ["part", "seq"])
        .selectExpr("doc_id", "offset + before + at AS start", "n_tokens", "ids_crc32")
    )


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[int] | None:
    """The ids of one document: its block is found by the index, and only its frame is decompressed."""
    rows = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").where(F.array_contains("doc_ids", F.lit(doc_id)))
    row = rows.selectExpr(
        f"array_position(doc_ids, {int(doc_id)}L) AS i", "offsets", "width", "frames"
    ).selectExpr("width", "substring(frames, int(offsets[i - 1]) + 1, int(offsets[i] - offsets[i - 1])) AS frame").first()
    if row is None:
        return None
    dictionary = store_dictionary(spark, path)
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    raw = zstandard.ZstdDecompressor(dict_data=shared).decompress(bytes(row["frame"]))
    return np.frombuffer(raw, f"<u{row['width']}").tolist()


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the token ids of all documents, read the files back and return each document's digest."""
    path = scratch_path(spark, "token-store")
    write_store(table(spark, sf_dir, "documents"), path)
    return read_store(spark, path)
