"""Variable-capacity best-fit packing (operator 8).

Documents are measured in tokens (with the end id) and packed into training sequences of several
permitted lengths. Texts longer than the largest length are cut into pieces. What a sequence costs
grows faster than its length, as attention does: ``cost(c) = (c + overhead) * (1 + c / quadratic)``. So
long sequences are worth it for long documents and for what fits beside them, short ones for the rest,
and every size can be the best one.

Within a group of documents, pieces are placed longest first:

* into the open sequence that leaves the least room (best fit over all open sizes), else
* into a new one. Every permitted size is weighed by filling it on trial from the histogram of all
  lengths that remain, largest fitting first: the size with the least cost for each token that it would
  hold - after it is downsized to what it holds - is opened. So each opening looks at the lengths of
  all documents to come, and a size whose room nothing fits is not opened.
* at the end each sequence shrinks to the smallest size that holds its contents.

The same is done with each smaller set of sizes (all up to one limit, and each size alone with those that
longer pieces need), and the cheapest of these packings is the group's: weighing all sizes is never
dearer than best fit with one size.

Groups are dealt by a hash of the id and the number of tokens and hold ``GROUP_ROWS`` documents on
average: only their lengths travel, and the open sequences that a group leaves cost a vanishing share.

Edge cases: null or empty text is one token; rows with a null id are left out; rows that
repeat an id are packed separately (a frequent id is dealt to groups by the lengths of its texts); ties
go by id, then piece; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.common import ceil_div, small_batches, steady, string_buffer, table
from assay.llm.tokens import Encoder, default_model

CAPACITIES = (512, 1024, 2048, 4096, 8192)
#: Cost of a sequence besides its length, in tokens.
OVERHEAD = 32
#: Length at which attention costs as much as everything else (six times the width of a model of 2048).
QUADRATIC = 12_288
GROUP_ROWS = 20_000

PACKED = "doc_id long, piece int, first_token long, n_tokens int, bin_id long, capacity int, bin_offset int"


def token_counts(documents: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and n_tokens (with the end id) of every document."""
    model = model or default_model()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.get(model)
        for batch in batches:
            buf, offs = string_buffer(batch.column("text"))
            sizes = [np.diff(ends, prepend=0) + 1 for _, _, _, ends in encoder.encode(buf, offs)]
            sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64())], ["doc_id", "n_tokens"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    return small_batches(docs).mapInArrow(steady(rows), "doc_id long, n_tokens long")


def cost(capacity: int, overhead: int = OVERHEAD, quadratic: float = QUADRATIC) -> float:
    return (capacity + overhead) * (1 + capacity / quadratic)


def total_cost(capacity: Sequence[int], overhead: int = OVERHEAD, quadratic: float = QUADRATIC) -> float:
    return sum(cost(c, overhead, quadratic) for c in capacity)


def trial_fill(room: int, left: list[int], some: int) -> int:
    """Tokens of ``room`` that the remaining lengths fill, largest fitting first (``left``: how many of each, ``some``: bit n if any)."""
    start, top = room, room
    while top > 0 and (fits := some & ((1 << (top + 1)) - 1)):
        n = fits.bit_length() - 1
        room -= n * min(left[n], room // n)
        top = min(n - 1, room)
    return start - room


def best_fit(sizes: Sequence[int], capacities: Sequence[int], overhead: int = OVERHEAD, quadratic: float = QUADRATIC) -> tuple[list[int], list[int]]:
    """(sequence of each size, capacity of each sequence) for sizes in descending order."""
    capacities = sorted(capacities)
    price = [cost(c, overhead, quadratic) for c in capacities]
    room: list[list[int]] = [[] for _ in range(capacities[-1] + 1)]  # open sequences by room left
    some = 0  # bit r: there is one with room r
    left = [0] * (capacities[-1] + 1)  # of each length, pieces still to come
    for n in sizes:
        left[n] += 1
    coming = sum(1 << n for n in set(sizes))
    where, used = [], []
    for n in sizes:
        left[n] -= 1
        if not left[n]:
            coming &= ~(1 << n)
        fits = some >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                some &= ~(1 << r)
        else:
            best = None
            for c in capacities:
                if c >= n:
                    held = n + trial_fill(c - n, left, coming)
                    fitted = next(i for i, x in enumerate(capacities) if x >= held)
                    if best is None or price[fitted] / held < best[0]:
                        best = (price[fitted] / held, c)
            r = best[1]
            b = len(used)
            used.append(0)
        where.append(b)
        used[b] += n
        if r > n:
            room[r - n].append(b)
            some |= 1 << (r - n)
    return where, [next(c for c in capacities if c >= u) for u in used]


def pack_sizes(sizes: Sequence[int], capacities: Sequence[int], overhead: int = OVERHEAD, quadratic: float = QUADRATIC) -> tuple[list[int], list[int]]:
    """The cheapest of the packings with all sizes, with those up to each limit, and with each alone (longer pieces get what they need).

    Sequences shrink to any permitted size, whichever sizes were opened.
    """
    capacities = sorted(capacities)
    best = None
    for choice in dict.fromkeys([tuple(capacities), *(tuple(capacities[: i + 1]) for i in range(len(capacities))), *((c,) for c in capacities)]):
        longest = max(sizes, default=0)
        opened = set(choice) | ({next(c for c in capacities if c >= longest)} if longest > max(choice) else set())
        where, capacity = best_fit(sizes, sorted(opened), overhead, quadratic)
        used = [0] * len(capacity)
        for n, b in zip(sizes, where, strict=True):
            used[b] += n
        capacity = [next(c for c in capacities if c >= u) for u in used]
        total = total_cost(capacity, overhead, quadratic)
        if best is None or total < best[0] - 1e-6:
            best = (total, where, capacity)
    return best[1], best[2]


def _pack(capacities: Sequence[int], overhead: int, quadratic: float):
    def rows(key: tuple, tbl: pa.Table) -> pa.Table:
        top, group = max(capacities), key[0].as_py()
        items = []
        for doc, n in zip(tbl.column("doc_id").to_pylist(), tbl.column("n_tokens").to_pylist(), strict=True):
            items += [(-min(top, n - at), doc, at // top, at) for at in range(0, n, top)]
        items.sort()
        where, capacity = pack_sizes([-i[0] for i in items], capacities, overhead, quadratic)
        filled = [0] * len(capacity)
        offset = []
        for (size, *_), b in zip(items, where, strict=True):
            offset.append(filled[b])
            filled[b] -= size
        columns = (
            [i[1] for i in items],
            [i[2] for i in items],
            [i[3] for i in items],
            [-i[0] for i in items],
            [(group << 32) + b for b in where],
            [capacity[b] for b in where],
            offset,
        )
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32())
        names = [c.split()[0] for c in PACKED.split(", ")]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return rows


def pack(
    documents: DataFrame,
    capacities: Sequence[int] = CAPACITIES,
    overhead: int = OVERHEAD,
    quadratic: float = QUADRATIC,
    group_rows: int = GROUP_ROWS,
    model: str | None = None,
) -> DataFrame:
    """One row for each piece: its document, place in the document, sequence, capacity and place in the sequence."""
    groups = ceil_div(documents.count(), group_rows)
    return (
        token_counts(documents, model)
        .withColumn("g", F.pmod(F.xxhash64("doc_id", "n_tokens"), F.lit(groups)))
        .groupBy("g")
        .applyInArrow(_pack(tuple(capacities), overhead, quadratic), PACKED)
    )


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 512 to 8192 tokens."""
    return pack(table(spark, sf_dir, "documents"))
