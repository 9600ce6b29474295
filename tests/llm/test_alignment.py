"""Operator 12 against brute force: every document tokenised by itself, every link counted."""

import collections
import hashlib

import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from assay.llm.alignment import Aligner, alignment, byte_level_tokens, default_pieces, piece_bytes
from assay.llm.tokens import default_model

ODD = [
    (100, "<|endoftext|> a </s> b <s><unk>"), (101, "a▁b"), (102, " lead  and   runs\t\n x "), (103, "\x00 nul"), (104, "日本 🙂 é"),
    (105, " nbsp　wide"), (106, "▁"), (107, "x" * 5000), (108, "\r\n"), (109, "é ﬁ"),
]


def brute(rows):
    tokenizer = Tokenizer.from_file(default_model())
    tokenizer.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=default_pieces())
    bytes_a = byte_level_tokens(default_model())
    docs, count = [], collections.Counter()
    for i, t in rows:
        groups, links = [], []
        if t:
            a, b = tokenizer.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)
            ba, bb = [bytes_a[x] for x in a], [piece_bytes(sp.id_to_piece(x)) for x in b]
            if b"".join(ba) == b"".join(bb) == (" " + t).encode():
                ends = []
                for side in (ba, bb):
                    at, out = 0, []
                    for x in side:
                        at += len(x)
                        out.append(at)
                    ends.append(out)
                common = sorted(set(ends[0]) & set(ends[1]))
                links = [(x, y) for x, e in zip(a, ends[0], strict=True) for y, f in zip(b, ends[1], strict=True) if e == f] if len(a) < 3000 else [
                    (a[ends[0].index(e)], b[ends[1].index(e)]) for e in common]
                lo = 0
                for e in common:
                    groups.append(",".join(str(x) for x, y in zip(a, ends[0], strict=True) if lo < y <= e) + "|" + ",".join(str(x) for x, y in zip(b, ends[1], strict=True) if lo < y <= e))
                    lo = e
                docs.append((i, len(a), len(b), groups, links))
                count.update(links)
                continue
        docs.append((i, 0, 0, groups, links))
    top = collections.Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return sorted(
        (i, na, nb, len(g), len(ls), sum(count[x] == top[x[1]] for x in ls), sum(count[x] for x in ls), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for i, na, nb, g, ls in docs
    )


@pytest.mark.parametrize("broadcast_pairs", [0, 10**6])
def test_alignment(documents, broadcast_pairs):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    short = [r for r in rows if r[1] is None or len(r[1]) < 1500]
    got, _ = alignment(documents.where("text IS NULL OR length(text) < 1500"), broadcast_pairs=broadcast_pairs)
    assert sorted(map(tuple, got.collect())) == brute(short)


def test_alignment_edges(spark, edges, empty):
    plain = [(r["doc_id"], r["text"]) for r in edges.collect() if r["doc_id"] is not None and len(r["text"] or "") < 6000]
    rows = plain + ODD + ODD[:3]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS digest", "2 AS pairs", "3 AS count", "4 AS copies")
    got, counts = alignment(df)
    want = brute(rows)
    assert sorted(map(tuple, got.collect())) == want
    zero = {r[0] for r in want if not r[1]}
    assert {1, 2, 101, 106} <= zero and 100 not in zero
    assert counts.agg({"count": "sum"}).first()[0] == sum(r[4] for r in want)
    assert alignment(empty)[0].collect() == []


def test_long_texts_and_batches_do_not_change_a_row(edges):
    texts = [t for (t,) in edges.select("text").collect()]
    aligner = Aligner(default_model(), default_pieces())
    together = list(aligner.align(pa.array(texts)))
    for t, x in zip(texts, together, strict=True):
        (alone,) = aligner.align(pa.array([t], pa.string()))
        assert x[:4] == alone[:4] and x[4].tolist() == alone[4].tolist() and x[5].tolist() == alone[5].tolist()
