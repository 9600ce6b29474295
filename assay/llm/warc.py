"""WARC archives with segmented records (operator 6).

Writing: one response record a page, its HTTP body in chunked transfer coding. Of records
with equal payloads of at least ``min_bytes`` bytes, the one with the smallest page id is
the response and the others are revisit records that refer to it. A block longer than
``segment_bytes`` is split into segments: the first record and continuation records, which
name their origin and number, the last one also the total length. Archives are gzip files
that Spark's text writer commits, so a lost executor leaves no half-written archive.

Reading: archives are streamed record by record. Segments are grouped by origin, ordered by
number and joined after their numbers and total length are verified; chunked framing is
decoded and every payload is held against its digest. Revisits take their length from the
record that they refer to.

Only digests and lengths are shuffled when revisits are found (map-side minimum for each
digest), and only revisited pages (a bitmap of fixed size finds them) travel with their
text; the largest group that is brought together is one payload's segments.

Edge cases: null html is an empty payload; rows with a null page id are left out; rows
that repeat a page id have a record each (an equal id is not smaller); null urls leave the
header out, line breaks in urls are percent-encoded; an empty table gives an empty
archive; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.common import maybe_in, scratch_path, table, written

MIN_BYTES = 100
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
#: Records of an archive file at most.
ARCHIVE_RECORDS = 20_000
PAGE_URN = "urn:page:"

RECORDS = (
    "page_id long, kind string, refers_to long, payload_bytes long, payload_digest string, "
    "origin string, segment int, total long, block binary"
)


# ---- writing ------------------------------------------------------------------------


def cuts(data: bytes, size: int) -> list[bytes]:
    """Parts of at most ``size`` bytes that split no UTF-8 character (a single character may be longer)."""
    out, at = [], 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and end > at + 1 and data[end] & 0xC0 == 0x80:
            end -= 1
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        out.append(data[at:end])
        at = end
    return out


def chunked(payload: bytes, size: int) -> bytes:
    return b"".join(b"%x\r\n%b\r\n" % (len(c), c) for c in cuts(payload, size)) + b"0\r\n\r\n"


def record(headers: list[tuple[str, object]], block: bytes) -> str:
    """A record as text, without the last line feed (the writer's line separator)."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines) + "\r\n\r\n" + block.decode() + "\r\n\r"


def _records(segment_bytes: int, chunk_bytes: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "html", "first"))
            for page, url, html, first in zip(*columns, strict=True):
                payload = (html or "").encode()
                n += 1
                own = f"<{PAGE_URN}{page}:{part}-{n}>"
                head = [("WARC-Record-ID", own), ("WARC-Date", "1970-01-01T00:00:00Z")]
                if url is not None:
                    head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
                head.append(("WARC-Payload-Digest", "sha256:" + hashlib.sha256(payload).hexdigest()))
                http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                if first is not None:
                    head += [("WARC-Type", "revisit"), ("WARC-Refers-To", f"<{PAGE_URN}{first}>")]
                    out.append(record(head, (http + "\r\n").encode()))
                    continue
                head.append(("WARC-Type", "response"))
                block = (http + "Transfer-Encoding: chunked\r\n\r\n").encode() + chunked(payload, chunk_bytes)
                parts = cuts(block, segment_bytes)
                if len(parts) == 1:
                    out.append(record(head, block))
                    continue
                out.append(record([*head, ("WARC-Segment-Number", 1)], parts[0]))
                for i, piece in enumerate(parts[1:], 2):
                    more = [("WARC-Record-ID", f"{own[:-1]}-{i}>"), ("WARC-Type", "continuation")]
                    more += [("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", i)]
                    if i == len(parts):
                        more.append(("WARC-Segment-Total-Length", len(block)))
                    out.append(record(more, piece))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["record"])

    return rows


def write_archives(
    pages: DataFrame,
    path: str,
    min_bytes: int = MIN_BYTES,
    segment_bytes: int = SEGMENT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
) -> None:
    """Write ``pages`` (page_id, url, html) as gzip archives into the folder ``path``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").where("page_id IS NOT NULL")
    payload = F.coalesce("html", F.lit("")).cast("binary")
    digests = rows.select("page_id", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("n")).where(
        F.col("n") >= min_bytes
    )
    firsts = digests.groupBy("digest").agg(F.min("page_id").alias("first"))
    again = written(
        digests.join(firsts, "digest").where("first < page_id").select("page_id", "digest", "first").distinct(), "revisits"
    )
    marked = maybe_in(rows, again.select("page_id"), "page_id")
    plain = marked.where("NOT _maybe").select("page_id", "url", "html", F.lit(None).cast("long").alias("first"))
    looked = (
        marked.where("_maybe").withColumn("digest", F.sha2(payload, 256)).join(again, ["page_id", "digest"], "left")
        .select("page_id", "url", "html", "first")
    )
    (
        plain.unionByName(looked).mapInArrow(_records(segment_bytes, chunk_bytes), "record string")
        .write.option("compression", "gzip").option("maxRecordsPerFile", ARCHIVE_RECORDS).text(path)
    )


# ---- reading ------------------------------------------------------------------------


class WarcError(ValueError):
    """An archive that breaks the format."""


def read_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-cased names, block) of each record."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line != b"WARC/1.1\r\n":
            raise WarcError(f"not the start of a record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise WarcError(f"record {headers.get('warc-record-id')} is cut off")
        yield headers, block


def unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise WarcError("chunk without its line end")
        out.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The body of an HTTP response, decoded."""
    head, _, body = block.partition(b"\r\n\r\n")
    if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head):
        return unchunked(body)
    return body


def _checked(page: int, block: bytes, want: str) -> tuple[int, str]:
    payload = payload_of(block)
    digest = hashlib.sha256(payload).hexdigest()
    if digest != want:
        raise WarcError(f"page {page}: payload digest {digest} instead of {want}")
    return len(payload), digest


def _page(urn: str) -> int:
    return int(urn.strip("<>").removeprefix(PAGE_URN).split(":")[0])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
    pack = lambda rows: pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names
    )
    for batch in batches:
        for content in batch.column("content"):
            rows, held = [], 0
            for h, block in read_records(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())))):
                kind, own = h["warc-type"], h["warc-record-id"]
                digest = h.get("warc-payload-digest", "").removeprefix("sha256:")
                number = int(h["warc-segment-number"]) if "warc-segment-number" in h else None
                if kind == "revisit":
                    rows.append((_page(own), kind, _page(h["warc-refers-to"]), None, digest, None, None, None, None))
                elif kind == "response" and number is None:
                    rows.append((_page(own), kind, None, *_checked(_page(own), block, digest), None, None, None, None))
                elif kind in ("response", "continuation"):
                    total = h.get("warc-segment-total-length")
                    origin = own if kind == "response" else h["warc-segment-origin-id"]
                    rows.append((_page(origin), kind, None, None, digest or None, origin, number, total and int(total), block))
                    held += len(block)
                if len(rows) >= 5000 or held > 4 << 20:
                    yield pack(rows)
                    rows, held = [], 0
            yield pack(rows)


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole responses from the ordered segments of each origin."""
    for batch in batches:
        pages, sizes, digests = [], [], []
        for row in batch.to_pylist():
            parts = row["parts"]
            if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
                raise WarcError(f"{row['origin']}: segments {[p['segment'] for p in parts]}")
            block = b"".join(p["block"] for p in parts)
            if parts[-1]["total"] != len(block):
                raise WarcError(f"{row['origin']}: {len(block)} bytes instead of {parts[-1]['total']}")
            size, digest = _checked(row["page_id"], block, parts[0]["payload_digest"])
            pages.append(row["page_id"])
            sizes.append(size)
            digests.append(digest)
        yield pa.RecordBatch.from_arrays(
            [pa.array(pages, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
            ["page_id", "payload_bytes", "payload_digest"],
        )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every archived page."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    records = written(files.mapInArrow(_parse, RECORDS), "warc-records")
    whole = records.where("kind = 'response' AND segment IS NULL").select("page_id", "payload_bytes", "payload_digest")
    parts = F.struct("segment", "block", "total", "payload_digest")
    joined = (
        records.where("segment IS NOT NULL").groupBy("origin", "page_id")
        .agg(F.array_sort(F.collect_list(parts)).alias("parts"))
        .mapInArrow(_reassemble, "page_id long, payload_bytes long, payload_digest string")
    )
    responses = written(whole.unionByName(joined), "warc-responses")
    source = responses.selectExpr("page_id AS refers_to", "payload_digest", "payload_bytes").distinct()
    revisits = (
        records.where("kind = 'revisit'").select("page_id", "refers_to", "payload_digest")
        .join(source, ["refers_to", "payload_digest"], "left")
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (
        responses.withColumn("record_type", F.lit("response")).withColumn("refers_to", F.lit(None).cast("long")).select(columns)
        .unionByName(revisits.withColumn("record_type", F.lit("revisit")).select(columns))
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages, read the archives back and return each record's digest."""
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path)


#: The records that the archives must hold.
OP6_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND first < page_id THEN first END AS refers_to
FROM f
"""
