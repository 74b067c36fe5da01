"""Sum-of-squares packing of token pieces into sequences.

Every document is its ids and an end id; what is longer than a sequence is cut into pieces
of that length.  Where a piece goes depends only on its length, so the packing is planned
on the histogram of lengths, at most ``capacity`` numbers however many documents there are:
pieces are placed one by one where the squared counts of open bins per remaining gap become
smallest, then the emptiest bins are opened and their pieces placed by best fit.  N pieces
are planned as ceil(N / plan_items) equal parts of the histogram: one part is planned and
its plan repeated, and the remainder, fewer pieces of each length than parts, is planned by
the same rule until nothing is left.  Pieces of one length are interchangeable; they are
ranked in parallel and look up their place in the plan, whose size is bounded.

Cases: a null text is empty and an empty text is one piece with the end id; repeated
documents are packed each; an empty table gives no rows.  Other columns stay out.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import ranked, shuffle_partitions, stored
from eventloom.llm.tokens import encoder, slices

PIECES_TYPE = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"
PIECES_WITH_IDS = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint,ids:array<int>>>"
PLAN_ITEMS = 300_000
RANK_BUCKET = 50_000


def pieces(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 0, key: str = "doc_id",
           text: str = "text", with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32) of every document, with its ids if asked."""
    step = 4 * capacity

    def cut(texts: pa.Array) -> pa.Array:
        enc, tail = encoder(tokenizer, False, 4), int(end_id).to_bytes(4, "little")
        rows = []
        for part in slices(texts):
            for ids in enc.encode(part):
                raw, row = memoryview(bytes(ids) + tail), []
                for i, at in enumerate(range(0, len(raw), step)):
                    own = raw[at:at + step]
                    cell = {"piece": i, "start": at // 4, "length": len(own) // 4, "ids_crc32": zlib.crc32(own)}
                    if with_ids:
                        cell["ids"] = np.frombuffer(own, "<i4")
                    row.append(cell)
                rows.append(row)
        fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
        if with_ids:
            fields.append(("ids", pa.list_(pa.int32())))
        return pa.array(rows, pa.list_(pa.struct(fields)))

    udf = F.arrow_udf(cut, PIECES_WITH_IDS if with_ids else PIECES_TYPE)
    return docs.select(F.col(key).alias("doc_id"), F.explode(udf(text)).alias("p")).select("doc_id", "p.*")


def _sum_of_squares(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of the given sizes, placed in this order."""
    count = np.zeros(capacity + 1)  # open bins by gap; a full bin costs nothing
    open_bins: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    full: list[list[int]] = []
    for s in sizes.tolist():
        # Cost of moving a bin from gap g to gap g - s, for g = s .. capacity - 1.
        leave = 1 - 2 * count[s:capacity]
        leave[1:] += 2 * count[1:capacity - s] + 1
        leave[count[s:capacity] == 0] = np.inf
        best = int(leave.argmin()) if len(leave) else -1
        rest = capacity - s
        fresh = 2 * count[rest] + 1 if rest else 0
        if best >= 0 and leave[best] <= fresh:
            own, rest = open_bins[best + s].pop(), best
            count[best + s] -= 1
        else:
            own = []
        own.append(s)
        if rest:
            open_bins[rest].append(own)
            count[rest] += 1
        else:
            full.append(own)
    return full + [b for gap in open_bins for b in gap]


def _best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    open_bins: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    has = np.zeros(capacity + 1, bool)
    full = []
    for s in sorted(sizes, reverse=True):
        at = int(has[s:].argmax()) + s
        own = open_bins[at].pop() if has[at] else []
        if own:
            has[at] = bool(open_bins[at])
        rest = (at if own else capacity) - s
        own.append(s)
        if rest:
            open_bins[rest].append(own)
            has[rest] = True
        else:
            full.append(own)
    return full + [b for gap in open_bins for b in gap]


def _pack(histogram: dict[int, int], capacity: int, seed: int = 5) -> Counter:
    """Patterns (sorted tuples of lengths) of a histogram of a bounded number of pieces."""
    sizes = np.repeat(np.array(list(histogram), np.int64), list(histogram.values()))
    sizes = np.random.default_rng(seed).permutation(np.sort(sizes))
    bins = _sum_of_squares(sizes, capacity)
    # The sum of squares leaves some bins of every gap open; their pieces are placed anew.
    best = bins
    for slack in (capacity // 64, capacity // 256, 1):
        loose = [b for b in bins if capacity - sum(b) >= slack]
        again = [b for b in bins if capacity - sum(b) < slack] + _best_fit([s for b in loose for s in b], capacity)
        if len(again) < len(best):
            best = again
    return Counter(tuple(sorted(b, reverse=True)) for b in best)


def plan(histogram: dict[int, int], capacity: int, most: int = PLAN_ITEMS) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, times) that hold all pieces of the histogram."""
    out: Counter = Counter()
    left = {s: n for s, n in histogram.items() if n and s < capacity}
    if histogram.get(capacity):
        out[(capacity,)] += histogram[capacity]
    while left:
        total = sum(left.values())
        times = max(1, -(-total // most))
        part = {s: n // times for s, n in left.items() if n >= times}
        for pattern, n in _pack(part, capacity).items():
            out[pattern] += n * times
        left = {s: n % times for s, n in left.items() if n % times}
    return sorted(out.items())


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """The plan as runs: ranks ``first ..`` of a length go to sequences from ``sequence`` on,
    ``each`` to a sequence, from ``offset`` on.  Sorted by length and rank."""
    rows, used, sequence = [], Counter(), 0
    for pattern, times in patterns:
        offset = 0
        for s, each in sorted(Counter(pattern).items(), reverse=True):
            rows.append((s, used[s], sequence, each, offset))
            used[s] += each * times
            offset += s * each
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(len(rows), 5)
    return dict(zip(("length", "first", "sequence", "each", "offset"), table.T.copy()))


def pack(cut: DataFrame, *, capacity: int = 2048, plan_items: int = PLAN_ITEMS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the rows of ``pieces``."""
    spark = cut.sparkSession
    cut = stored(cut, "pieces")
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    total = sum(counts.values())
    runs = spark.sparkContext.broadcast(places(plan(counts, capacity, plan_items)))  # bounded by plan_items
    thin = cut.select("doc_id", "piece", "start", "length", "ids_crc32").withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(max(shuffle_partitions(spark), -(-total // RANK_BUCKET)))))
    in_length = ranked(thin, "length", [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], "bucket", "rank")

    def place(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        table = runs.value
        s, r = lengths.to_numpy(zero_copy_only=False), ranks.to_numpy(zero_copy_only=False)
        sequence, offset = np.empty(len(s), np.int64), np.empty(len(s), np.int64)
        order = np.lexsort((r, s))
        values, begin = np.unique(s[order], return_index=True)
        for v, rows in zip(values, np.split(order, begin[1:])):
            lo, hi = np.searchsorted(table["length"], [v, v + 1])
            at = lo + np.searchsorted(table["first"][lo:hi], r[rows], side="right") - 1
            inside, each = r[rows] - table["first"][at], table["each"][at]
            sequence[rows] = table["sequence"][at] + inside // each
            offset[rows] = table["offset"][at] + inside % each * v
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    udf = F.arrow_udf(place, "struct<sequence_id:bigint,offset:bigint>")
    return (in_length.withColumn("at", udf(F.col("length"), F.col("rank")))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset"))
