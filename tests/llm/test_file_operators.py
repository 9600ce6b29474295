"""Operators 2, 6, 8 and 10: exact round trips and brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from assay.llm import token_store, tokens, warc
from assay.llm.chat import fold, format_conversations, log_of, op10_chat_formatting, parse
from assay.llm.common import scratch_path, string_buffer
from assay.llm.packing import best_fit, pack, pack_sizes, token_counts, total_cost
from assay.llm.token_store import read_document, read_store, write_store
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(tokens.default_model())
    t.encode_special_tokens = True
    return t


def test_encoder_is_exact(tokenizer):
    import pyarrow as pa

    rng = random.Random(1)
    parts = ["a", "b", "é", "ñ", " ", "  ", "\n", "\t", "'s", "'ll", "'", "1", "23", "!", "<|endoftext|>", "ß", "日本", "\r\n",
             "\x1c", "word", "Hello", "\x85", "　", "=", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += [None, "", " ", "\n\n", "x" * 50_000, "y " * 9000]
    buf, offs = string_buffer(pa.array(texts, pa.string()))
    for a, b, ids, ends in tokens.Encoder(tokens.default_model()).encode(buf, offs):
        start = [0, *ends.tolist()]
        for i in range(a, b):
            want = tokenizer.encode(texts[i] or "", add_special_tokens=False).ids
            assert ids[start[i - a] : start[i - a + 1]].tolist() == want


def test_units_are_numbered_in_a_small_table():
    """A table of units takes a few dozen bytes each (a dict of numbers takes over a hundred), and finds each of them."""
    from assay.llm.common import Slots

    rng = np.random.default_rng(1)
    h, table = np.unique(rng.integers(-(2**62), 2**62, 300_000)), Slots(4)
    h = rng.permutation(np.concatenate((h, np.arange(1000) << 40, [0, -1, 2**63 - 1, -(2**63)])))
    h = h[np.sort(np.unique(h, return_index=True)[1])]
    for part in np.array_split(h, 7):
        assert (table.find(part) == -1).all()
        table.add(part)
    assert (table.find(h) == np.arange(len(h))).all() and len(table) == len(h)
    assert table.hash.nbytes + table.slot.nbytes <= 50 * len(h)
    assert (table.find(rng.integers(2**62, 2**63 - 2, 1000)) == -1).all()


def test_span_hash():
    """Equal bytes have equal hashes wherever they stand, different ones of any length have different ones."""
    from assay.llm.common import span_hash

    parts = [b"", b"\0", b"\0\0", b"a", b"ab", b"abcdefgh", b"abcdefgh\0", b"abcdefghi", b"x" * 64, b"x" * 65, b"x" * 9000, b"x" * 8999]
    raw, start, length, at = b"", [], [], []
    for i in [*range(len(parts)), *reversed(range(len(parts)))]:
        raw += b"." * (i % 3)
        start.append(len(raw))
        length.append(len(parts[i]))
        at.append(i)
        raw += parts[i]
    h = span_hash(np.frombuffer(raw, np.uint8), np.array(start), np.array(length)).tolist()
    assert len(set(h)) == len(parts) == len(set(zip(at, h, strict=True)))


def test_token_store(spark, documents, edges, empty, tokenizer):
    for df in (documents, edges):
        path = scratch_path(spark, "store")
        write_store(df, path)
        rows = sorted((r["doc_id"], r["text"] or "") for r in df.collect() if r["doc_id"] is not None)
        at, want = 0, []
        for i, t in rows:
            ids = tokenizer.encode(t, add_special_tokens=False).ids + [0]
            want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            at += len(ids)
        assert sorted(map(tuple, read_store(spark, path).collect())) == want
    assert read_document(spark, path, 6) == tokenizer.encode("One  two\nthree", add_special_tokens=False).ids + [0]
    assert read_document(spark, path, 99) is None
    path = scratch_path(spark, "store")
    write_store(empty, path)
    assert read_store(spark, path).collect() == []


def test_token_store_widths_and_stretches(spark, documents, tokenizer, monkeypatch):
    """Wide ids where the end id needs them, and running sums over many partitions and stretches."""
    assert token_store.least_width(tokens.default_model(), 0) == 2 and token_store.least_width(tokens.default_model(), 1 << 16) == 4
    with pytest.raises(ValueError, match="4 bytes"):
        write_store(documents, scratch_path(spark, "store"), end_id=70_000, width=2)
    monkeypatch.setattr(token_store, "PARTITION_BYTES", 20_000)
    monkeypatch.setattr(token_store, "STRETCH", 3)
    path = scratch_path(spark, "store")
    write_store(documents, path, end_id=70_000)
    rows = sorted((r["doc_id"], r["text"] or "") for r in documents.collect())
    at, want = 0, []
    for i, t in rows:
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [70_000]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = read_store(spark, path)
    assert sorted(map(tuple, got.collect())) == want
    assert spark.read.parquet(f"{path}/blocks").select("part").distinct().count() > 9
    assert read_document(spark, path, rows[5][0])[-1] == 70_000


def test_dictionary_sample_is_bounded(spark):
    """Ids that repeat - with one text or with many - do not make the sample larger."""
    rows = [(1, "same text")] * 500 + [(2, f"text {i}") for i in range(500)] + [(i, None) for i in range(3, 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for n in (5, 40, 200):
        assert token_store.sample_of(docs, n).count() == n
    assert token_store.sample_of(docs, 10_000).distinct().count() == token_store.sample_of(docs, 10_000).count() == 1 + 500 + 47


def test_added_tokens_as_the_library_does(spark):
    """Texts that quote an added token, against a tokenizer as it is loaded."""
    library, rng = Tokenizer.from_file(tokens.default_model()), random.Random(6)
    parts = ["a", " ", "<|endoftext|>", "<|endoftext", "|>", "\n", "é", "word", "<", "\u3000", "<|endoftext|><|endoftext|>"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))) for i in range(400)]
    rows += [(400, "a <|endoftext|> b"), (401, "<|endof"), (402, "text|>"), (403, "<|endoftext|>"), (404, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [0] for i, t in rows}
    assert ids[400][:-1] == [64, 220, 50256, 275]
    path = scratch_path(spark, "store")
    write_store(docs, path)
    got = {r[0]: (r[2], r[3]) for r in map(tuple, read_store(spark, path).collect())}
    assert got == {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids.items()}
    assert read_document(spark, path, 400) == ids[400]
    assert dict(map(tuple, token_counts(docs).collect())) == {i: len(x) for i, x in ids.items()}


# ---- WARC ----------------------------------------------------------------------------------


def test_warc(spark):
    big = "é" * 30_000
    rows = [(1, None, "a" * 200), (2, "u\n", "a" * 200), (2, "u", "a" * 200), (3, "", None), (4, "", ""), (5, "", "b"),
            (6, "", "b"), (7, "", big), (8, "", big), (None, "", "zz"), (9, "", "WARC/1.1\r\n\r\n0\r\n\r\n" * 3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS first", "2 AS digest")
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path)
    least, want = {}, []
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            least[h] = min(least.get(h, i), i)
    for i, _, h in rows:
        if i is not None:
            p = (h or "").encode()
            again = h in least and least[h] < i
            want.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", least[h] if again else None))
    assert sorted(map(str, map(tuple, warc.read_archives(spark, path).collect()))) == sorted(map(str, want))
    path = scratch_path(spark, "warc")
    warc.write_archives(pages.limit(0), path)
    assert warc.read_archives(spark, path).collect() == []


def test_warc_parts():
    data = ("aé日" * 50).encode()
    for size in (1, 2, 3, 7, 1000):
        parts = warc.cuts(data, size)
        assert b"".join(parts) == data and all(p.decode() for p in parts)
        assert warc.unchunked(warc.chunked(data, size)) == data
    assert warc.cuts(b"", 5) == [] and warc.unchunked(warc.chunked(b"", 5)) == b""


def test_warc_broken_segments(spark):
    rows = [("o", 1, [(1, b"ab", None, "x"), (3, b"cd", 4, None)])]
    kind = "origin string, page_id long, parts array<struct<segment:int,block:binary,total:long,payload_digest:string>>"
    bad = spark.createDataFrame(rows, kind).mapInArrow(
        warc._reassemble, "page_id long, payload_bytes long, payload_digest string"
    )
    with pytest.raises(Exception, match="segments"):
        bad.collect()


# ---- packing --------------------------------------------------------------------------------


def slow_best_fit(sizes, capacities, overhead, quadratic):
    price = {c: (c + overhead) * (1 + c / quadratic) for c in capacities}
    bins, where = [], []
    order_of = {}
    for i, n in enumerate(sizes):
        fit = [c - u for c, u in bins if c - u >= n]
        if fit:
            b = order_of[min(fit)].pop()
        else:
            options = []
            for c in capacities:
                held = n
                for m in sizes[i + 1 :] if c >= n else ():
                    held += m if held + m <= c else 0
                if c >= n:
                    options.append((price[min(x for x in capacities if x >= held)] / held, c))
            bins.append((min(options)[1], 0))
            b = len(bins) - 1
        c, u = bins[b]
        bins[b] = (c, u + n)
        where.append(b)
        if c - u - n:
            order_of.setdefault(c - u - n, []).append(b)
    return where, [min(c for c in capacities if c >= u) for _, u in bins]


def test_best_fit_against_scan():
    rng = random.Random(4)
    for _ in range(60):
        sizes = sorted((rng.randint(1, 64) for _ in range(rng.randint(1, 80))), reverse=True)
        for quadratic in (40, 1e9):
            assert best_fit(sizes, (16, 32, 64), 4, quadratic) == slow_best_fit(sizes, (16, 32, 64), 4, quadratic)
    assert best_fit([], (16,), 1) == ([], [])


def test_every_capacity_can_be_the_best():
    """Pieces for which one size is provably worse than another, either way."""
    # eight pieces of 512: eight short sequences cost 8 * 544 * (1 + 512/q), a long one 8224 * (1 + 8192/q) for half the overhead
    for quadratic, want in ((12_288, [512] * 16), (1e12, [8192])):
        where, capacity = best_fit([512] * 16, (512, 8192), 32, quadratic)
        assert capacity == want and sorted(where) == sorted(range(16) if len(want) > 1 else [0] * 16)
    # nothing fits beside a piece of 600 in 1024: three in 2048 waste less than one in 1024 or 13 in 8192 cost
    _, capacity = best_fit([600] * 39, (512, 1024, 2048, 4096, 8192))
    assert set(capacity) == {2048}
    # a long piece with short ones to fill its room, and a short one left over
    _, capacity = best_fit([8000, 192, 100], (512, 8192))
    assert sorted(capacity) == [512, 8192]


def test_joint_packing_is_never_dearer():
    rng = random.Random(7)
    used = set()
    for k in range(40):
        sizes = sorted((min(512, max(1, int(rng.lognormvariate(rng.uniform(2, 5), 1)))) for _ in range(200)), reverse=True)
        capacities = (32, 64, 128, 256, 512)
        where, capacity = pack_sizes(sizes, capacities, 4, 300)
        filled = [0] * len(capacity)
        for n, b in zip(sizes, where, strict=True):
            filled[b] += n
        assert all(u <= c and (c == 32 or u > c // 2) for u, c in zip(filled, capacity, strict=True))
        used |= set(capacity)
        for single in capacities:
            if single >= sizes[0]:
                alone, _ = best_fit(sizes, (single,), 4, 300)
                room = [0] * (max(alone) + 1)
                for n, b in zip(sizes, alone, strict=True):
                    room[b] += n
                shrunk = [min(c for c in capacities if c >= u) for u in room]
                assert total_cost(capacity, 4, 300) <= total_cost(shrunk, 4, 300) + 1e-6
    assert used == {32, 64, 128, 256, 512}


def test_pack(documents, edges, empty, tokenizer):
    for df in (documents, edges):
        counts = sorted(map(tuple, token_counts(df).collect()))
        assert counts == sorted(
            (r["doc_id"], len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1)
            for r in df.collect() if r["doc_id"] is not None
        )
        rows = pack(df, capacities=(256, 1024)).collect()
        total, spans = {}, {}
        for r in rows:
            total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["n_tokens"]
            spans.setdefault((r["bin_id"], r["capacity"]), []).append((r["bin_offset"], r["n_tokens"]))
        want = {}
        for i, n in counts:
            want[i] = want.get(i, 0) + n
        assert total == want
        for (_, capacity), inside in spans.items():
            end = 0
            for at, n in sorted(inside):
                assert at == end
                end += n
            assert end <= capacity and (capacity == 256 or end > 256)
    assert pack(empty).collect() == []


# ---- chats -------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    rng = random.Random(3)
    parts = ["\\", "<", "|", "im_start", "|>", "<|im_end|>", "</s>", "[INST]", "[/INST]", "\n", "a", "é", "<s>", "<<SYS>>", "\\|", "/"]
    roles = ["user", "assistant", "sys tem\n<|im_end|>", None, "a+b%"]
    rows = [
        (i, k, rng.choice(roles), None if rng.random() < 0.05 else "".join(rng.choice(parts) for _ in range(rng.randint(0, 12))))
        for i in range(200) for k in range(rng.randint(1, 5))
    ]
    rows += [(500, k, "assistant", f"t{k}") for k in range(700)] + [(501, 0, "user", "x"), (501, 0, "user", "x"), (None, 1, "user", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS message", "2 AS seq")
    got = {r["conv_id"]: r for r in parse(format_conversations(log_of(df))).collect()}
    assert set(got) == {r[0] for r in rows} - {None}
    for i, r in got.items():
        want = [(a or "", t or "") for c, _, a, t in sorted((x for x in rows if x[0] == i), key=lambda x: x[1])]
        assert [(t["role"], t["text"]) for t in r["turns"]] == want
        assert list(r["loss_texts"]) == [t for a, t in want if a == "assistant"]
    assert parse(format_conversations(log_of(df.limit(0)))).collect() == []


def test_chat_fold(spark):
    events = [
        (1, 1, "start", 1, "user", "hi"), (1, 2, "start", 2, "assistant", ""), (1, 3, "delta", 2, None, "Hel"),
        (1, 4, "delta", 2, None, "lo"), (1, 5, "regenerate", 2, None, None), (1, 6, "delta", 2, None, "Good "),
        (1, 7, "delta", 2, None, "day"), (1, 8, "edit", 1, None, "hey"), (1, 9, "delta", 1, None, "!"),
        (2, 3, "delta", 1, None, "b"), (2, 1, "delta", 1, None, "a"), (None, 1, "start", 1, "user", "x"),
    ]
    df = spark.createDataFrame(events, "conv_id long, seq long, event string, message long, role string, text string")
    got = sorted(tuple(r) for r in fold(df.repartition(3)).select("conv_id", "message", "role", "text").collect())
    assert got == [(1, 1, "user", "hey!"), (1, 2, "assistant", "Good day"), (2, 1, "", "ab")]


def test_chat_is_native(spark):
    plan = op10_chat_formatting(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan
