"""Cross-tokenizer alignment of exactly deduplicated texts (operator 12).

Two tokenizations of one byte string are cut into groups where tokens of both end at the same
byte; the two tokens that end there are linked. Texts are shuffled by the full text and each
distinct one is tokenised and aligned once: its measures and its distinct id pairs are one row.
A pair's corpus-wide count sums the pairs' counts weighted by the texts' multiplicity, and the
measures that need it are joined back to the texts, and then by digest to every doc_id.

Token bytes come from the vocabularies (byte-level entries decoded; pieces in UTF-8 with U+2581
as a blank and ``<0xHH>`` as a byte), and the joined bytes of both sides are compared with the
text behind one blank, byte by byte; texts for which they differ have no tokens.

A text's pairs travel once, to the partial sums of their own task. The pair counts (at most
one row for each pair of ids that occurs) are broadcast up to ``broadcast_pairs`` counted rows
and shuffled beyond that, with the same result.

Edge cases: null and empty texts have no tokens and zeros; special tokens' strings are plain
text; rows with a null id are left out; rows that repeat an id get the measures of their own
texts; very long texts are one unit (their tokens are held in arrays); an empty table gives an
empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.common import ranges, small_batches, span_hash, steady, string_buffer, table, written
from assay.llm.tokens import TABLE_UNITS, Encoder, default_model, different

PIECES = "piece_bpe_32k.model"
#: Pair counts are broadcast up to this counted number of rows (three numbers each).
BROADCAST_PAIRS = 1_000_000

ALIGNED = (
    "digest string, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, times array<long>"
)
MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECES)


# ---- vocabularies ---------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves, the rest from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_level_tokens(model: str) -> list[bytes]:
    """Bytes of every id of a byte-level BPE file."""
    with open(model, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    entries = {i: bytes(letters[c] for c in token) for token, i in spec["model"]["vocab"].items() if all(c in letters for c in token)}
    entries |= {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
    return [entries.get(i, b"") for i in range(max(entries) + 1)]


def piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class Vocabulary:
    """Token bytes side by side."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ranges(self.begin[ids], self.size[ids])]


class Pieces(Encoder):
    """Piece ids of documents in a buffer, each behind one blank.

    No piece has a blank after another character, so a text is the concatenation of independent
    units that begin at a run of blanks, and each different unit is encoded once.
    """

    def __init__(self, processor):
        self.processor = processor
        self.names = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
        self.apart = not any("\u2581" in p.lstrip("\u2581") for p in self.names)
        self.clear()

    def _range(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lo = int(offs[0])
        raw, offs = buf[lo : int(offs[-1])], offs - lo
        new = np.zeros(len(raw), bool)
        new[offs[:-1]] = True  # no document is empty: each begins with its blank
        if self.apart:
            new[1:] |= (raw[1:] == 0x20) & (raw[:-1] != 0x20)
        start = np.flatnonzero(new)
        length = np.diff(np.append(start, len(raw)))
        h, first, code = different(span_hash(raw, start, length))
        if len(self.index) > TABLE_UNITS:
            self.clear()
        slot = self.index.find(h)
        missing = np.flatnonzero(slot < 0)
        if len(missing):
            at = first[missing]
            data = raw.tobytes()
            # the processor puts the blank in front itself
            units = [data[s + 1 : s + n].decode() for s, n in zip(start[at].tolist(), length[at].tolist(), strict=True)]
            found = [self.processor.encode(u) if u else [self.blank()] for u in units]
            self._keep(h[missing], np.fromiter(chain.from_iterable(found), np.uint32), np.array([len(f) for f in found]))
            slot = self.index.find(h)
        slot = slot[code]
        sizes = self.size[slot]
        total = np.concatenate(([0], np.cumsum(sizes)))
        return self.store[ranges(self.begin[slot], sizes)], total[np.searchsorted(start, offs[1:])]

    def blank(self) -> int:
        return self.processor.piece_to_id("\u2581")


class Aligner:
    """Both tokenizers; one for each worker process."""

    def __init__(self, model: str, pieces: str):
        import sentencepiece

        self.encoder = Encoder(model)  # special tokens are plain text
        self.pieces = Pieces(sentencepiece.SentencePieceProcessor(model_file=pieces))
        self.a = Vocabulary(byte_level_tokens(model))
        names = self.pieces.names
        self.b = Vocabulary([piece_bytes(p) for p in names])
        top = max(len(self.a.size), len(names))
        self.base = len(names)
        self.digits = Vocabulary([b"%d" % i for i in range(top)])

    @classmethod
    def get(cls, model: str, pieces: str) -> Aligner:
        held = sys.modules.setdefault("_assay_aligners", {})  # outlives a task, as worker processes do
        if (model, pieces) not in held:
            held[model, pieces] = cls(model, pieces)
        return held[model, pieces]

    def align(self, texts: pa.Array) -> Iterator[tuple]:
        """(n_a, n_b, n_groups, rendered groups or None, pairs, times) of every text, in order."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        blank, end = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
        buf, offs = string_buffer(pc.binary_join_element_wise(blank, texts, end))
        for (x, y, ids_a, ends_a), (_, _, ids_b, ends_b) in zip(self.encoder.encode(buf, offs), self.pieces.encode(buf, offs), strict=True):
            ids_a, ids_b = ids_a.astype(np.int64), ids_b.astype(np.int64)
            yield from self._range(buf[offs[x] : offs[y]], offs[x : y + 1] - offs[x], ids_a, ends_a, ids_b, ends_b)

    def _range(self, raw, offs, ids_a, ends_a, ids_b, ends_b) -> Iterator[tuple]:
        n = len(offs) - 1
        size = np.diff(offs)
        count = [np.diff(e, prepend=0) for e in (ends_a, ends_b)]
        doc = [np.repeat(np.arange(n), c) for c in count]
        length = [v.size[i] for v, i in ((self.a, ids_a), (self.b, ids_b))]
        good = size > 1  # the blank alone: no text
        for d, one in zip(doc, length, strict=True):
            good &= np.bincount(d, weights=one, minlength=n) == size
        while True:  # once more if bytes differ
            keep = [good[d] for d in doc]
            a, b = ids_a[keep[0]], ids_b[keep[1]]
            of = np.repeat(np.arange(n), np.where(good, size, 0))
            want = raw[np.repeat(good, size)]
            off = (self.a.joined(a) != want) | (self.b.joined(b) != want)
            if not off.any():
                break
            good[np.unique(of[off])] = False
        da, db = doc[0][keep[0]], doc[1][keep[1]]
        end_a, end_b = np.cumsum(length[0][keep[0]]), np.cumsum(length[1][keep[1]])
        place = np.searchsorted(end_b, end_a)  # no token is empty, so ends ascend
        last_a = np.flatnonzero(end_b[np.minimum(place, max(len(end_b) - 1, 0))] == end_a)
        last_b = place[last_a]
        group_doc = da[last_a]
        pair = a[last_a] * self.base + b[last_b]
        width = len(self.a.size) * self.base
        both, times = np.unique(group_doc * width + pair, return_counts=True)
        text, cuts = self._render(a, b, last_a, last_b, group_doc, n)
        pair_cut = np.searchsorted(both // width, np.arange(n + 1))
        group_cut = np.searchsorted(group_doc, np.arange(n + 1))
        for d in range(n):
            p, q = pair_cut[d], pair_cut[d + 1]
            if good[d]:
                yield int(count[0][d]), int(count[1][d]), int(group_cut[d + 1] - group_cut[d]), text[cuts[d] : cuts[d + 1] - 1], both[p:q] % width, times[p:q]
            else:
                yield 0, 0, 0, None, both[:0], times[:0]

    def _render(self, a, b, last_a, last_b, group_doc, n) -> tuple[bytes, np.ndarray]:
        """``a1,a2|b1;...;`` of all documents side by side, and where each begins."""
        count_a, count_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        token = np.zeros(len(a) + len(b), np.int64)
        sign = np.full(len(token), ord(","), np.uint8)
        at_a = np.arange(len(a)) + np.repeat(np.cumsum(count_b) - count_b, count_a)
        at_b = np.arange(len(b)) + np.repeat(np.cumsum(count_a), count_b)
        token[at_a], token[at_b] = a, b
        sign[at_a[last_a]] = ord("|")
        closing = at_b[last_b]
        sign[closing] = ord(";")
        size = self.digits.size[token] + 1
        stop = np.cumsum(size)
        out = np.zeros(int(stop[-1]) if len(stop) else 0, np.uint8)
        if len(out):
            out[ranges(stop - size, size - 1)] = self.digits.joined(token)
            out[stop - 1] = sign
        tail = np.concatenate(([0], stop[closing]))
        return out.tobytes(), tail[np.searchsorted(group_doc, np.arange(n + 1))]


def _aligned(model: str, pieces: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.get(model, pieces)
        for batch in batches:
            found = list(aligner.align(batch.column("text")))
            columns = [batch.column("digest"), batch.column("copies")]
            columns += [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1, 2, 2)]
            columns.append(pa.array(["" if f[3] is None else hashlib.sha256(f[3]).hexdigest() for f in found], pa.string()))
            cut = pa.array(np.concatenate(([0], np.cumsum([len(f[4]) for f in found]))).astype(np.int32))
            for i in (4, 5):
                values = np.concatenate([f[i] for f in found]) if found else np.zeros(0)
                columns.append(pa.ListArray.from_arrays(cut, pa.array(values.astype(np.int64))))
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in ALIGNED.split(", ")])

    return rows


# ---- the operator ------------------------------------------------------------------------


def aligned_texts(documents: DataFrame, model: str | None = None, pieces: str | None = None) -> DataFrame:
    """A row for each distinct text: digest, copies, counts, digest of its groups, and its id pairs with their times."""
    texts = (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .where("doc_id IS NOT NULL AND text <> ''")
        .groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
        .select(F.sha2("text", 256).alias("digest"), "copies", "text")
    )
    return small_batches(texts).mapInArrow(steady(_aligned(model or default_model(), pieces or default_pieces())), ALIGNED)


def pair_counts(aligned: DataFrame, pieces: str | None = None) -> DataFrame:
    """pair, count (links that hold it, corpus-wide), best (no other pair of its B id has a higher count)."""
    import sentencepiece

    base = sentencepiece.SentencePieceProcessor(model_file=pieces or default_pieces()).get_piece_size()
    counted = (
        aligned.selectExpr("copies", "inline(arrays_zip(pairs, times))")
        .groupBy(F.col("pairs").alias("pair")).agg(F.sum(F.col("copies") * F.col("times")).alias("count"))
    )
    counted = written(counted.selectExpr("pair", f"pair % {base}L AS b", "count"), "pair-counts")
    top = counted.groupBy("b").agg(F.max("count").alias("top"))  # a row for each B id at most
    return counted.join(F.broadcast(top), "b").selectExpr("pair", f"pair div {base}L AS a", "b", "count", "count = top AS best")


def alignment(
    documents: DataFrame, model: str | None = None, pieces: str | None = None, broadcast_pairs: int = BROADCAST_PAIRS
) -> tuple[DataFrame, DataFrame]:
    """(a row for each document with its measures, the corpus-wide pair counts)."""
    aligned = written(aligned_texts(documents, model, pieces), "aligned")
    counts = pair_counts(aligned, pieces)
    known = counts.select(F.col("pair").alias("pairs"), "count", "best")
    if counts.count() <= broadcast_pairs:
        known = F.broadcast(known)
    links = aligned.selectExpr("digest", "inline(arrays_zip(pairs, times))").join(known, "pairs")
    sums = links.groupBy("digest").agg(
        F.sum(F.expr("if(best, times, 0)")).alias("n_best"), F.sum(F.col("count") * F.col("times")).alias("count_sum")
    )
    texts = aligned.drop("copies", "pairs", "times").join(sums, "digest", "left")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2("text", 256).alias("digest")).where("doc_id IS NOT NULL")
    out = docs.join(texts, "digest", "left").select(
        "doc_id", *(F.coalesce(m, F.lit(0)).cast("long").alias(m) for m in MEASURES),
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
    return out, counts.select("a", "b", "count", "best")


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of the byte-level and the piece tokenizer over every document."""
    return alignment(table(spark, sf_dir, "documents"))[0]
