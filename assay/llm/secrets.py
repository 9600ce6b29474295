"""Secret scans: patterns, and a linear-chain conditional random field (operator 7).

Patterns find the base spans. A CRF tags tokens as begin (B), inside (I) or outside (O) of
a secret from their shape, neighbouring tokens and features of the whole text, and adds
the spans that its best path (Viterbi) marks and no base span overlaps. It is trained on a
bounded sample: windows around unusual tokens in the ``max_docs`` documents with the
smallest hash of their id, labelled by the base spans.

Decoding is exact without walking every token: a token whose outside score exceeds the
others by more than any two transitions can return is outside on every best path, so the
text falls into short runs of undecided tokens, which are decoded side by side.

Edge cases: null text counts as empty; rows with a null id are left out, rows that repeat
an id are scanned separately; without base spans in the sample nothing is added; an empty
table gives an empty result; very long texts are scanned whole; other columns are ignored
(``redacted`` keeps them).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.common import _BYTE, _PLACE, U64, chunks, mix, small_batches, steady, string_buffer, table

#: Bounds of the training sample.
MAX_DOCS = 8000
MAX_WINDOWS = 6000
#: Tokens on either side of an unusual token in a training window.
SIDE = 6
STEPS = 150
DECAY = 1e-5
MASK = "[SECRET]"

# The base patterns; a match is kept from the given length on.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ["assign", "access", "hex", "crf"]
ASSIGN_HINTS = ("passw", "secret", "token", "api")

O, B, I = range(3)
LABELS = 3


def base_spans(text: str, hex_runs: bool = True) -> list[tuple[int, int, str, int]]:
    """(start, kind's place, kind, end) of the base matches, in order."""
    out = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        out += [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    if hex_runs:
        out += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return sorted(out)


# ---- tokens and features ------------------------------------------------------------

#: Byte classes: 0 space, 1 letters, digits and +/_-, 2 non-ASCII, 3 other signs (a token each).
CLASS = np.zeros(256, np.uint8)
for _b in range(256):
    if _b >= 0x80:
        CLASS[_b] = 2
    elif chr(_b).isalnum() or chr(_b) in "+/_-":
        CLASS[_b] = 1
    elif _b > 0x20:
        CLASS[_b] = 3
LOWERED = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
DIGIT = np.array([0x30 <= b <= 0x39 for b in range(256)])
UPPER = np.array([0x41 <= b <= 0x5A for b in range(256)])
LOW = np.array([0x61 <= b <= 0x7A for b in range(256)])
HEXA = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x66 for b in range(256)])
LENGTHS = np.array([2, 4, 6, 9, 13, 17, 21, 33], np.int64)
SIGNS = np.zeros(256, np.int64)
for _i, _c in enumerate("=:\"'.,;()[]{}<>|"):
    SIGNS[ord(_c)] = _i + 1

#: Feature blocks: shape, length, digits and hex, previous token, the one before, shapes around, next sign, file.
WORDS = 1024
BLOCKS = [64, 9, 20, WORDS, WORDS, 64, 64, 20, 18]
BASES = np.concatenate(([0], np.cumsum(BLOCKS)[:-1]))
FEATURES = int(sum(BLOCKS))


@dataclass
class Tokens:
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    features: np.ndarray  # (tokens, blocks), indices into the weights
    unusual: np.ndarray


def tokenize(buf: np.ndarray, offs: np.ndarray) -> Tokens:
    lo, hi = int(offs[0]), int(offs[-1])
    raw = buf[lo:hi]
    cls = CLASS[raw]
    new = cls != 0
    new[1:] &= (cls[1:] != cls[:-1]) | (cls[1:] == 3)
    last = cls != 0
    last[:-1] &= (cls[1:] != cls[:-1]) | (cls[:-1] == 3)
    cut = offs[1:-1] - lo
    cut = cut[(cut > 0) & (cut < len(raw))]
    new[cut] = cls[cut] != 0
    last[cut - 1] = cls[cut - 1] != 0
    start, end = np.flatnonzero(new), np.flatnonzero(last) + 1
    first = np.searchsorted(start, offs - lo)
    n = len(start)
    if not n:
        return Tokens(start, end, first, np.zeros((0, len(BLOCKS)), np.int32), np.zeros(0, bool))
    length = end - start

    def count(flag: np.ndarray) -> np.ndarray:
        total = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(flag[raw], out=total[1:])
        return total[end] - total[start]

    digits, uppers, lowers, hexes = count(DIGIT), count(UPPER), count(LOW), count(HEXA)
    kind = cls[start]
    signs = length - digits - uppers - lowers
    shape = (digits > 0) | ((uppers > 1).astype(np.int64) << 1) | ((lowers > 0).astype(np.int64) << 2)
    shape |= ((signs > 0) & (kind == 1)).astype(np.int64) << 3
    shape = np.where(kind == 3, 32 + SIGNS[raw[start]], np.where(kind == 2, 16, shape))
    # hash of the lower-cased token's first 32 bytes
    code = np.zeros(n, U64)
    idx = np.arange(n)
    for j in range(32):
        idx = idx[length[idx] > j]
        if not len(idx):
            break
        code[idx] += _BYTE[LOWERED[raw[start[idx] + j]]] * _PLACE[j]
    word = (mix(code) % U64(WORDS - 1)).astype(np.int64) + 1
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(first))

    def beside(x: np.ndarray, by: int) -> np.ndarray:
        """The value ``by`` tokens away in the same document, else 0."""
        out = np.zeros(n, np.int64)
        if by < 0:
            same = doc[-by:] == doc[:by]
            out[-by:] = np.where(same, x[:by], 0)
        else:
            same = doc[by:] == doc[:-by]
            out[:-by] = np.where(same, x[by:], 0)
        return out

    share = digits * 8 // np.maximum(length, 1) + 9 * ((hexes == length) & (digits > 0))
    size = np.diff(offs)
    odd = np.bincount(doc, weights=(kind == 3) & (SIGNS[raw[start]] > 0), minlength=len(size))
    file = np.minimum(odd * 40 // np.maximum(np.diff(first), 1), 5).astype(np.int64) * 3 + (size > 2000) + (size > 20000)
    columns = [
        shape,
        np.searchsorted(LENGTHS, length, side="right"),
        share,
        beside(word, -1),
        beside(word, -2),
        beside(shape, -1),
        beside(shape, 1),
        beside(np.where(kind == 3, SIGNS[raw[start]], 17), -1),
        file[doc],
    ]
    features = np.stack([c + b for c, b in zip(columns, BASES, strict=True)], axis=1).astype(np.int32)
    unusual = (kind == 1) & ((digits > 0) | (uppers > 1)) & (length >= 6)
    return Tokens(start + lo, end + lo, first, features, unusual)


# ---- the field ------------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    weights: np.ndarray  # (FEATURES, 3)
    steps: np.ndarray  # (3, 3): from, to

    def emissions(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), LABELS))
        for c in range(features.shape[1]):
            out += self.weights[features[:, c]]
        return out

    def swing(self) -> float:
        """The most that two transitions can gain over passing through O."""
        t = self.steps
        return max(t[a, y] + t[y, c] - t[a, O] - t[O, c] for a in range(3) for y in range(3) for c in range(3))


def viterbi_runs(e: np.ndarray, steps: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Best labels of many runs e[begin : begin + size], with an O before and after each."""
    labels = np.zeros(len(e), np.int8)
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    back = np.zeros((len(e), LABELS), np.int8)
    best = np.zeros((len(begin), LABELS))
    for t in range(int(size[0]) if len(size) else 0):
        m = int(np.searchsorted(-size, -t, side="left"))  # runs longer than t
        at = begin[:m] + t
        if t:
            paths = best[:m, :, None] + steps[None]
            back[at] = paths.argmax(axis=1)
            best[:m] = paths.max(axis=1) + e[at]
        else:
            best[:m] = steps[O][None] + e[at]
    if len(size):
        now = (best + steps[:, O][None]).argmax(axis=1).astype(np.int8)
        for t in range(int(size[0]) - 1, -1, -1):
            m = int(np.searchsorted(-size, -t, side="left"))
            at = begin[:m] + t
            labels[at] = now[:m]
            now[:m] = back[at, now[:m]]
    return labels


def decode(field: Field, tokens: Tokens) -> np.ndarray:
    """The best path's labels over every document (an O before and after each)."""
    e = field.emissions(tokens.features)
    if not len(e):
        return np.zeros(0, np.int8)
    sure = e[:, O] - np.maximum(e[:, B], e[:, I]) > max(field.swing(), 0)
    open_at = np.flatnonzero(~sure)
    labels = np.zeros(len(e), np.int8)
    if len(open_at):
        doc = np.searchsorted(tokens.first, open_at, side="right")
        new = np.append(True, (np.diff(open_at) != 1) | (np.diff(doc) != 0))
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(open_at)))
        labels[open_at] = viterbi_runs(e[open_at], field.steps, begin, size)
    return labels


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(windows: list[tuple[np.ndarray, np.ndarray]]) -> Field:
    """Maximum likelihood (full-batch Adam) over windows of (features, labels)."""
    n, t = len(windows), max(len(y) for _, y in windows)
    x = np.zeros((n, t, len(BLOCKS)), np.int64)
    y = np.zeros((n, t), np.int64)
    here = np.zeros((n, t), bool)
    for i, (f, labels) in enumerate(windows):
        x[i, : len(labels)], y[i, : len(labels)], here[i, : len(labels)] = f, labels, True
    gold = np.zeros((FEATURES, LABELS))
    for c in range(x.shape[2]):
        np.add.at(gold, (x[..., c][here], y[here]), 1.0)
    both = here[:, 1:] & here[:, :-1]
    gold_steps = np.zeros((3, 3))
    np.add.at(gold_steps, (y[:, :-1][both], y[:, 1:][both]), 1.0)
    w, s = np.zeros((FEATURES, LABELS)), np.zeros((3, 3))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(s), np.zeros_like(s)]
    for step in range(1, STEPS + 1):
        e = sum(w[x[..., c]] for c in range(x.shape[2]))
        ahead, behind = np.zeros((n, t, 3)), np.zeros((n, t, 3))
        ahead[:, 0] = e[:, 0]
        for k in range(1, t):
            move = _logsum(ahead[:, k - 1, :, None] + s[None], 1) + e[:, k]
            ahead[:, k] = np.where(here[:, k, None], move, ahead[:, k - 1])
        for k in range(t - 2, -1, -1):
            move = _logsum(s[None] + (e[:, k + 1] + behind[:, k + 1])[:, None, :], 2)
            behind[:, k] = np.where(here[:, k + 1, None], move, 0.0)
        z = _logsum(ahead[:, -1], 1)
        p = np.exp(ahead + behind - z[:, None, None]) * here[..., None]
        expect = np.zeros_like(w)
        for c in range(x.shape[2]):
            for label in range(LABELS):
                expect[:, label] += np.bincount(x[..., c].ravel(), weights=p[..., label].ravel(), minlength=FEATURES)
        pair = ahead[:, :-1, :, None] + s[None, None] + (e + behind)[:, 1:, None, :] - z[:, None, None, None]
        expect_steps = (np.exp(pair) * both[..., None, None]).sum(axis=(0, 1))
        for j, (theta, g) in enumerate((((w), (expect - gold) / n + DECAY * w), (s, (expect_steps - gold_steps) / n + DECAY * s))):
            m, v = state[2 * j], state[2 * j + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            theta -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(w, s)


# ---- training sample --------------------------------------------------------------------


def _code_points(raw: bytes, at: list[int]) -> np.ndarray:
    """Byte positions of code point positions (and the reverse table is its inverse)."""
    starts = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return np.append(starts, len(raw))[at]


def label_tokens(text: str, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Labels of tokens (byte positions within the text) by the base spans' secret parts."""
    labels = np.zeros(len(start), np.int8)
    parts = [(m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    parts += [(s, e) for s, place, _, e in base_spans(text) if place]
    if parts:
        raw = text.encode()
        for s, e in sorted(parts):
            s, e = _code_points(raw, [s, e])
            inside = np.flatnonzero((start >= s) & (end <= e))
            labels[inside[1:]] = I
            labels[inside[:1]] = B
    return labels


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows around unusual tokens: order, features, labels."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        texts = batch.column("text").to_pylist()
        buf, offs = string_buffer(batch.column("text"))
        order, feats, labels = [], [], []
        for a, b in chunks(offs):
            tokens = tokenize(buf, offs[a : b + 1])
            for d in range(b - a):
                x, y = int(tokens.first[d]), int(tokens.first[d + 1])
                spots = np.flatnonzero(tokens.unusual[x:y]) + x
                if not len(spots):
                    continue
                tags = label_tokens(texts[a + d] or "", tokens.start[x:y] - offs[a + d], tokens.end[x:y] - offs[a + d])
                done = -1
                for s in spots.tolist():
                    lo, hi = max(x, s - SIDE), min(y, s + SIDE + 1)
                    if s < done:
                        continue
                    done = hi
                    order.append(int(mix(np.array([ids[a + d] * 1_000_003 + s - x]).view(U64))[0].view(np.int64)))
                    feats.append(tokens.features[lo:hi].astype(np.int32).tobytes())
                    labels.append(tags[lo - x : hi - x].tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(order, pa.int64()), pa.array(feats, pa.binary()), pa.array(labels, pa.binary())], ["o", "f", "y"]
        )


def fit(documents: DataFrame, max_docs: int = MAX_DOCS, max_windows: int = MAX_WINDOWS) -> Field | None:
    """A field trained on windows of a bounded sample; none if the sample has no base span."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    chosen = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    # at most max_docs numbers: a bounded broadcast; at most max_windows windows come back
    rows = (
        small_batches(docs).join(F.broadcast(chosen), "doc_id").mapInArrow(steady(_windows), "o long, f binary, y binary")
        .orderBy("o", "f", "y").limit(max_windows).collect()
    )
    windows = [(np.frombuffer(r["f"], np.int32).reshape(-1, len(BLOCKS)).copy(), np.frombuffer(r["y"], np.int8)) for r in rows]
    if not any(y.any() for _, y in windows):
        return None
    # every other window hides its neighbouring words, so that the field also learns from shape alone
    for f, _ in windows[1::2]:
        f[:, 3:5] = BASES[3:5]
    return train(windows)


# ---- scans -------------------------------------------------------------------------------


def _scan(batch: pa.RecordBatch, field: Field | None) -> Iterator[tuple[int, list[tuple[int, int, str, int]]]]:
    """(row, all spans in order) of a batch's texts."""
    buf, offs = string_buffer(batch.column("text"))
    for a, b in chunks(offs):
        texts = batch.column("text").slice(a, b - a).to_pylist()
        lo = int(offs[a])
        part = buf[lo : int(offs[b])]
        hexa = HEXA[part]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], hexa, [False])).astype(np.int8)))
        long_runs = edge[::2][edge[1::2] - edge[::2] >= LEAST["hex"]] + lo
        has_hex = set((np.searchsorted(offs, long_runs, side="right") - 1).tolist())
        # a run may cross a document's end; its documents are scanned by the pattern
        ends = edge[1::2][edge[1::2] - edge[::2] >= LEAST["hex"]] + lo - 1
        has_hex |= {d for s, e in zip(long_runs.tolist(), ends.tolist(), strict=True) for d in range(int(np.searchsorted(offs, s, side="right")) - 1, int(np.searchsorted(offs, e, side="right")))}
        found: dict[int, list[tuple[int, int]]] = {}
        if field is not None:
            tokens = tokenize(buf, offs[a : b + 1])
            labels = decode(field, tokens)
            hit = np.flatnonzero(labels != O)
            doc = np.searchsorted(tokens.first, hit, side="right") - 1
            begin = np.flatnonzero(
                np.append(True, (np.diff(hit) != 1) | (np.diff(doc) != 0) | (labels[hit[1:]] == B))[: len(hit)]
            )
            last = np.append(begin[1:], len(hit))[: len(begin)] - 1
            for s, e in zip(begin.tolist(), last.tolist(), strict=True):
                d, o = a + int(doc[s]), offs[a + int(doc[s])]
                found.setdefault(d, []).append((int(tokens.start[hit[s]] - o), int(tokens.end[hit[e]] - o)))
        for row in range(a, b):
            text = texts[row - a] or ""
            spans = base_spans(text, row in has_hex)
            if row in found:
                raw = text.encode()
                points = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
                for s, e in found[row]:
                    s, e = int(points[s]) - 1, int(points[e - 1])
                    if not any(x < e and s < y for x, _, kind, y in spans if kind != "crf"):
                        spans.append((s, 3, "crf", e))
                spans.sort()
            yield row, spans


def scan(documents: DataFrame, field: Field | None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, listed = [], [], []
            for _, spans in _scan(batch, field):
                text = [f"{kind}:{s}:{e}" for s, _, kind, e in spans]
                base = ",".join(t for t in text if not t.startswith("crf"))
                counts.append([sum(k == kind for _, _, k, _ in spans) for kind in KINDS[:3]])
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                listed.append(",".join(text))
            by_kind = list(zip(*counts, strict=True)) if counts else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(list(c), pa.int64()) for c in by_kind), pa.array(digests, pa.string()), pa.array(listed, pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    return small_batches(docs).mapInArrow(
        steady(rows), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redacted(documents: DataFrame, field: Field | None, mask: str = MASK) -> DataFrame:
    """All rows and columns of ``documents``, with ``mask`` in place of every span (touching or overlapping spans: one)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index("text")
            texts = batch.column(place).to_pylist()
            for row, spans in _scan(batch, field):
                if spans:
                    out, at = [], 0
                    upto = None
                    for s, _, _, e in spans:
                        if upto is None or s > upto:
                            if upto is not None:
                                out.append(mask)
                                at = upto
                            out.append(texts[row][at:s])
                        upto = e if upto is None else max(upto, e)
                    texts[row] = "".join([*out, mask, texts[row][upto:]])
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return small_batches(documents).mapInArrow(steady(rows), documents.schema)


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base patterns and the trained field."""
    docs = table(spark, sf_dir, "documents")
    return scan(docs, fit(docs))
