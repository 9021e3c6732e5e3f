"""Bulk-synchronous best-fit packing of token documents into fixed-length sequences.

Documents longer than a sequence are cut; their full pieces are sequences of their own. The
rest is packed best fit, longest first, in supersteps. Documents and gaps are ordered by size,
and what has one size is one class: superstep L takes all documents of L tokens, sweeps for the
smallest gap that still holds them, deals the class's gaps to its documents rank by rank (the
r-th document takes the r-th gap, so two documents never claim one gap), replaces the gaps by
what is left of them, and repeats with the next larger gap; what no gap holds opens sequences.

The sweep needs only how many documents each class has: at most ``capacity - 1`` counters
whatever the size of the corpus. Its outcome is a list of ranges, "documents of length L with
ranks a..b take sequences s.. at place p", and every document finds its own range by a join on
its length and rank. No document or gap passes through the driver and none is sorted; ranks
come from per-partition counters and their prefix sums.
"""

from __future__ import annotations

import bisect
import struct
import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailsift.llm import bpe
from mailsift.llm.common import trimmed, written

CAPACITY = 2048


def pieces(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, rank): the pieces of every row of
    ``docs`` (doc_id, text; null text: just the end id). ``rank`` numbers the pieces of one
    length within their task ``part``, so (length, part, rank) is unique."""
    def run(batches):
        from collections import Counter

        import pyarrow as pa
        from pyspark import TaskContext
        coder, stop, seen = bpe.coder(vocabulary), struct.pack("<I", end_id), Counter()
        part, step = TaskContext.get().partitionId(), 4 * capacity
        for b in batches:
            rows = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "part", "rank")}
            for d, ids in zip(b.column("doc_id").to_pylist(), coder.encode_all(b.column("text").to_pylist())):
                ids += stop
                for piece, at in enumerate(range(0, len(ids), step)):
                    raw = ids[at:at + step]
                    n = len(raw) // 4
                    for k, v in zip(rows, (d, piece, at // 4, n, zlib.crc32(raw), part, seen[n])):
                        rows[k].append(v)
                    seen[n] += 1
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema(
                [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                 ("ids_crc32", pa.int64()), ("part", pa.int32()), ("rank", pa.int64())]))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        trimmed(run), "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long")


def sweep(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best fit over length classes, longest first: ranges (length, first rank, documents,
    first sequence, offset). ``counts`` gives the documents of each length."""
    gaps: dict[int, list[list[int]]] = {}    # gap size -> [first sequence, sequences]
    sizes: list[int] = []                    # the gap sizes there are, ascending
    taken, opened = [], 0

    def put(gap: int, first: int, n: int) -> None:
        if gap:
            if gap not in gaps:
                bisect.insort(sizes, gap)
                gaps[gap] = []
            gaps[gap].append([first, n])

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(sizes, length)          # successor: the smallest gap that fits
            if at == len(sizes):
                each = capacity // length                   # a new sequence takes this many
                n = -(-left // each)
                put(capacity, opened, n)
                opened += n
                continue
            gap = sizes[at]
            first, n = gaps[gap][-1]
            c = min(n, left)
            if c == n:
                gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
            else:
                gaps[gap][-1] = [first + c, n - c]
            taken.append((length, rank, c, first, capacity - gap))
            put(gap - length, first, c)
            rank, left = rank + c, left - c
    return taken


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to ``cut`` (a written table of ``pieces``)."""
    spark = cut.sparkSession
    per_part = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = written(per_part.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "packbase")
    # At most `capacity` rows, whatever the corpus holds.
    counts = {r["length"]: r["n"] for r in base.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    taken = sweep(counts, capacity)

    by_length: dict[int, tuple[list[int], list[int], list[int]]] = {}
    for length, rank, _, first, offset in taken:
        ranks, firsts, offsets = by_length.setdefault(length, ([], [], []))
        ranks.append(rank)
        firsts.append(first)
        offsets.append(offset)
    ranges = spark.sparkContext.broadcast(by_length)

    def place(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            length, rank = (b.column(c).to_numpy() for c in ("length", "rank"))
            seq, off = np.zeros(len(rank), "i8"), np.zeros(len(rank), "i8")
            for n in np.unique(length).tolist():
                ranks, firsts, offsets = map(np.array, ranges.value[n])
                mine = np.flatnonzero(length == n)
                at = np.searchsorted(ranks, rank[mine], side="right") - 1
                seq[mine], off[mine] = firsts[at] + rank[mine] - ranks[at], offsets[at]
            cols = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(seq), pa.array(off)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = (cut.join(base.select("length", "part", "base"), ["length", "part"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("base")).alias("rank")))
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its sequence and its place there. Repeated rows are
    packed each; an empty table gives no rows."""
    return pack(written(pieces(docs, vocabulary, end_id, capacity), "pieces"), capacity)
