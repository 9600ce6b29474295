"""Toxicity scores of a counterfactually regularised classifier (operator 5).

A logistic regression on the presence of hashed words and word beginnings. Training rows
that name an identity are paired with copies of the sentence in which every such term is swapped, all
at once, for the next one of its family; the features are then taken from the swapped sentence, and
the squared change of the logit is a penalty, so that naming a group does not move the score.

Fitting uses a bounded sample: the ``max_rows`` labelled (id, text) pairs with the smallest hash of
their id, outside the held-out fold, one of each family of (near) copies and label. The
features are those that separate the labels in the sample; everything else - the scores -
covers every whole text. Inputs of a score are the text's words only.

Edge cases: null text scores as empty text (the intercept); rows with a null id are left
out, rows that repeat an id are scored separately; labels that are null are not used, an
id labelled twice counts as toxic if any of its labels is 1; without labelled rows every
score is 0, with labels of one kind it is their smoothed share; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.llm.common import (
    _BYTE,
    _PLACE,
    ALNUM,
    U64,
    Words,
    chunks,
    gram_hash,
    joined_words,
    mix,
    run_starts,
    small_batches,
    steady,
    string_buffer,
    table,
    words,
    written,
)

#: Bound of the labelled sample, and of the features kept.
MAX_ROWS = 20_000
MAX_FEATURES = 8192
#: A feature needs so many toxic texts and such a z score of its log odds.
MIN_TOXIC = 5
MIN_Z = 4.0
#: Word beginnings of so many bytes are features beside the whole word.
PREFIXES = (4, 5, 6)
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
#: Weights of the squared logit change under a swap, and of the squared weights.
PENALTY = 1.0
DECAY = 5e-5
STEPS = 400

# Identity terms by family; a term is swapped for the next one of its family.
IDENTITY_TERMS = [
    ["woman", "man", "girl", "boy"],
    ["women", "men", "girls", "boys"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["black", "white", "asian", "latino", "african", "european"],
    ["gay", "lesbian", "bisexual", "straight", "transgender"],
    ["immigrant", "refugee", "foreigner", "native"],
    ["deaf", "blind", "disabled", "old", "young"],
    ["frau", "mann", "mädchen", "junge"],
    ["frauen", "männer"],
    ["muslime", "christen", "juden", "hindus"],
    ["femme", "homme", "fille", "garçon"],
    ["musulman", "chrétien", "juif", "hindou"],
    ["mujer", "hombre", "niña", "niño"],
    ["musulmán", "cristiano", "judío", "hindú"],
]


def is_held_out(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT


# ---- features -----------------------------------------------------------------


def word_features(buf: np.ndarray, w: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(word index, feature hash) arrays: whole words, and beginnings of longer words."""
    every = np.arange(len(w.start))
    out = [(every, w.hash)]
    length = w.end - w.start
    code = np.zeros(0, U64)
    done = 0
    idx = every
    for size in sorted(PREFIXES):
        keep = length[idx] > size
        idx, code = idx[keep], (code[keep] if done else np.zeros(int(keep.sum()), U64))
        for j in range(done, size):
            code = code + _BYTE[ALNUM[buf[w.start[idx] + j]]] * _PLACE[j]
        done = size
        out.append((idx, mix(code + U64(0x5EED + size))))
    return out


def one_word(term: str) -> list[int]:
    """The feature hashes of a term."""
    buf = np.frombuffer(term.encode(), np.uint8)
    w = words(buf, np.array([0, len(buf)]), ALNUM)
    return [int(h[0]) for i, h in word_features(buf, w) if len(i)]


def swapped(words_of: list[bytes]) -> list[bytes]:
    """A sentence's lower-cased words with every identity term replaced by the next one of its family, all at once."""
    return [SWAPS.get(w, w) for w in words_of]


#: Term -> the one it is swapped for (the first family that has it decides).
SWAPS: dict[bytes, bytes] = {}
for _family in IDENTITY_TERMS:
    for _a, _b in zip(_family, _family[1:] + _family[:1], strict=True):
        SWAPS.setdefault(_a.encode(), _b.encode())


def identity_features() -> set[int]:
    """The feature hashes of all identity terms."""
    return {h for family in IDENTITY_TERMS for term in family for h in one_word(term)}


@dataclass(frozen=True)
class Vocabulary:
    """Selected feature hashes in ascending order, behind a filter on 20 bits of the hash."""

    hashes: np.ndarray

    def filter(self) -> np.ndarray:
        seen = np.zeros(1 << 20, bool)
        seen[(self.hashes & U64((1 << 20) - 1)).astype(np.int64)] = True
        return seen

    def present(self, buf: np.ndarray, w: Words, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, feature) pairs of a range of documents."""
        doc = w.doc
        pairs = []
        for idx, h in word_features(buf, w):
            maybe = np.flatnonzero(seen[(h & U64((1 << 20) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.hashes, h[maybe]), max(len(self.hashes) - 1, 0))
            hit = self.hashes[at] == h[maybe] if len(self.hashes) else np.zeros(len(maybe), bool)
            pairs.append(doc[idx[maybe[hit]]] * len(self.hashes) + at[hit])
        both = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        size = max(len(self.hashes), 1)
        return both // size, both % size


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest 5-gram hash of each text: (near) copies mostly share it."""
    for batch in batches:
        buf, offs = string_buffer(batch.column("text"))
        keys = []
        for a, b in chunks(offs):
            w = words(buf, offs[a : b + 1], ALNUM)
            at, n = run_starts(w.first, 5)
            low = gram_hash(w.hash, 5)[at]
            base = np.concatenate(([0], np.cumsum(n)))
            for d in range(b - a):
                x, y = w.first[d], w.first[d + 1]
                h = low[base[d] : base[d + 1]]
                keys.append(int((h.min() if len(h) else mix(w.hash[x:y].sum(keepdims=True))[0]).astype(U64).view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("toxic"), pa.array(keys, pa.int64())], ["doc_id", "toxic", "family"]
        )


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with each feature, by label, summed within a chunk."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        buf, offs = string_buffer(batch.column("text"))
        for a, b in chunks(offs, 1 << 20):
            w = words(buf, offs[a : b + 1], ALNUM)
            doc, out_h, out_d = w.doc, [], []
            for idx, h in word_features(buf, w):
                out_h.append(h)
                out_d.append(doc[idx])
            h, d = np.concatenate(out_h), np.concatenate(out_d)
            if not len(h):
                continue
            values, code = np.unique(h, return_inverse=True)
            both = np.unique(code * (b - a) + d)
            code, label = both // (b - a), toxic[a + both % (b - a)]
            n = np.bincount(code, minlength=len(values))
            bad = np.bincount(code, weights=label, minlength=len(values)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values.view(np.int64)), pa.array(bad), pa.array(n - bad)], ["h", "bad", "good"]
            )


def sentence_features(vocabulary: Vocabulary, seen: np.ndarray, buf: np.ndarray, offs: np.ndarray) -> list[list[int]]:
    """The selected features of each document of a range, ascending."""
    w = words(buf, offs, ALNUM)
    doc, feature = vocabulary.present(buf, w, seen)
    cut = np.searchsorted(doc, np.arange(len(offs)))
    return [feature[x:y].tolist() for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def swapped_texts(buf: np.ndarray, offs: np.ndarray) -> dict[int, bytes]:
    """The swapped sentence of each document of a range that names an identity."""
    w = words(buf, offs, ALNUM)
    named = np.isin(w.hash, np.array(sorted(one_word(t.decode())[0] for t in SWAPS), U64))
    text, start, end = joined_words(buf, w, ALNUM)
    out = {}
    for d in np.unique(w.doc[named]).tolist():
        x, y = int(w.first[d]), int(w.first[d + 1])
        out[d] = b" ".join(swapped([text[s:e] for s, e in zip(start[x:y].tolist(), end[x:y].tolist(), strict=True)]))
    return out


def _encode(hashes: np.ndarray):
    """Features of each sample row, and those of the row with its identity terms swapped."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(hashes)
        seen = vocabulary.filter()
        for batch in batches:
            buf, offs = string_buffer(batch.column("text"))
            own, other = [], []
            for a, b in chunks(offs):
                mine = sentence_features(vocabulary, seen, buf, offs[a : b + 1])
                theirs = list(mine)
                swaps = swapped_texts(buf, offs[a : b + 1])
                if swaps:
                    data = b"".join(swaps.values())
                    ends = np.cumsum([0, *map(len, swaps.values())])
                    again = sentence_features(vocabulary, seen, np.frombuffer(data, np.uint8), ends)
                    for d, f in zip(swaps, again, strict=True):
                        theirs[d] = f
                own += mine
                other += theirs
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("toxic"),
                    pa.array(own, pa.list_(pa.int32())),
                    pa.array(other, pa.list_(pa.int32())),
                ],
                ["toxic", "own", "other"],
            )

    return rows


# ---- the model ------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    hashes: np.ndarray
    weights: np.ndarray
    intercept: float


def _sparse(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    which = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    return which, np.array([i for r in rows for i in r], np.int64)


def train(own: list[list[int]], other: list[list[int]], y: np.ndarray, features: int, penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """Weights and intercept by full-batch Adam on log loss + counterfactual logit pairing."""
    n = len(y)
    rx, ix = _sparse(own)
    changed = [i for i in range(n) if own[i] != other[i]]
    ra, ia = _sparse([own[i] for i in changed])
    rb, ib = _sparse([other[i] for i in changed])
    w, b = np.zeros(features), float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    m, v = np.zeros(features + 1), np.zeros(features + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(rx, weights=w[ix], minlength=n) + b
        r = (1 / (1 + np.exp(-z)) - y) / n
        g = np.bincount(ix, weights=r[rx], minlength=features) + DECAY * w
        if changed:
            gap = np.bincount(ra, weights=w[ia], minlength=len(changed)) - np.bincount(rb, weights=w[ib], minlength=len(changed))
            gap *= 2 * penalty / len(changed)
            g += np.bincount(ia, weights=gap[ra], minlength=features) - np.bincount(ib, weights=gap[rb], minlength=features)
        grad = np.append(g, r.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def fit(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, penalty: float = PENALTY) -> Model:
    """Fit on labelled rows outside the held-out fold."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(~is_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # at most max_rows numbers: a bounded broadcast
    labelled = docs.join(F.broadcast(known), "doc_id").withColumn("_h", F.xxhash64("text"))
    # an id may repeat: different (id, text) pairs, no more than max_rows, each once (combined before the shuffle)
    few = labelled.select("doc_id", "_h").distinct().orderBy(F.xxhash64("doc_id", "_h"), "doc_id", "_h").limit(max_rows)
    sample = labelled.join(F.broadcast(few), ["doc_id", "_h"]).groupBy("doc_id", "_h", "toxic").agg(F.first("text", ignorenulls=True).alias("text"))
    sample = written(sample, "toxicity-sample")
    families = small_batches(sample).mapInArrow(_families, "doc_id long, toxic int, family long")
    chosen = families.groupBy("family", "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    sample = written(sample.join(F.broadcast(chosen), "doc_id", "left_semi"), "toxicity-rows")
    none = Model(np.zeros(0, U64), np.zeros(0), -np.inf)
    total = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("bad")).first()
    n, bad = total["n"], total["bad"]
    if not n:
        return none
    if bad in (0, n):
        return Model(none.hashes, none.weights, float(np.log((bad + 0.5) / (n - bad + 0.5))))
    counts = sample.mapInArrow(steady(_counts), "h long, bad long, good long").groupBy("h").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")
    )
    odds = (
        f"ln((bad + 0.5) / ({bad} - bad + 0.5)) - ln((good + 0.5) / ({n - bad} - good + 0.5))",
        f"sqrt(1 / (bad + 0.5) + 1 / (good + 0.5) + 1 / ({bad} - bad + 0.5) + 1 / ({n - bad} - good + 0.5))",
    )
    kept = (
        counts.where(F.col("bad") >= MIN_TOXIC)
        .selectExpr("h", f"({odds[0]}) / {odds[1]} AS z")
        .where(F.col("z") >= MIN_Z)
        .orderBy(F.desc("z"), "h")
        .limit(MAX_FEATURES)
        .collect()  # at most MAX_FEATURES numbers
    )
    hashes = np.array(sorted({r["h"] % 2**64 for r in kept} | identity_features()), U64)
    # at most max_rows lists of selected features
    rows = sample.mapInArrow(_encode(hashes), "toxic int, own array<int>, other array<int>").toArrow()
    order = sorted(zip(rows["toxic"].to_pylist(), rows["own"].to_pylist(), rows["other"].to_pylist(), strict=True))
    y = np.array([t for t, _, _ in order], float)
    weights, intercept = train([o for _, o, _ in order], [c for _, _, c in order], y, len(hashes), penalty)
    return Model(hashes, weights, intercept)


def score(documents: DataFrame, model: Model, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``documents`` (all of them by default) plus ``score`` and ``predicted``."""
    fields = documents.drop("score", "predicted")
    keep = keep or fields.columns

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model.hashes)
        seen = vocabulary.filter()
        for batch in batches:
            buf, offs = string_buffer(batch.column("text"))
            z = np.full(len(batch), model.intercept)
            for a, b in chunks(offs):
                w = words(buf, offs[a : b + 1], ALNUM)
                doc, feature = vocabulary.present(buf, w, seen)
                z[a:b] += np.bincount(doc, weights=model.weights[feature] if len(feature) else None, minlength=b - a)
            p = 1 / (1 + np.exp(-z))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                names=[*keep, "score", "predicted"],
            )

    schema = T.StructType(
        [fields.schema[c] for c in keep]
        + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )
    return small_batches(fields).mapInArrow(steady(rows), schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document; labels are learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
