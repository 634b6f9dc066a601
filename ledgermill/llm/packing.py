"""Packing of documents into sequences: large items are matched, smaller ones best-fit the gaps.

Only whole numbers up to the capacity occur as lengths, so the packing is decided on their histogram: documents above a
third of the capacity are paired greedily, at most two to a bin, and the smaller ones, longest first, go where they
leave the least gap. The decision is a short list of runs ("pieces number a to b of length l go to bins from s, at
offset o"); each piece finds its bin from its rank among the pieces of its length. No task sees all pieces.
"""
from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.byte_bpe import encoded, totals, vocabulary_path
from ledgermill.llm.common import documents, in_batches, written

CAPACITY = 1024
END_ID = 2
RANKED_TOGETHER = 200_000  # pieces that one task may have to rank, on average

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Token pieces of at most ``capacity`` ids, each document closed by ``END_ID``.

    A document that fits is one piece. A longer one is cut into whole pieces, the first taking what is left over. A
    null or empty text has the end id alone. ``with_ids`` adds the ids themselves.
    """
    path = path or vocabulary_path()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids_of, rows = batch.column("doc_id"), []
        take, piece, start, length, crc, ids = [], [], [], [], [], []
        for low, high, first, chunks, entries in encoded(batch.column("text"), path):
            counts = totals(chunks.counts(entries), first)
            flat = np.insert(chunks.ids(entries).astype("<u4"), np.cumsum(counts), END_ID)
            at = 0
            for row, n in zip(range(low, high), (counts + 1).tolist(), strict=True):
                cuts = [0, *range(n % capacity or capacity, n, capacity), n] if n > capacity else [0, n]
                for k in range(len(cuts) - 1):
                    part = flat[at + cuts[k]:at + cuts[k + 1]]
                    take.append(row)
                    piece.append(k)
                    start.append(cuts[k])
                    length.append(len(part))
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part.astype(np.int32))
                at += n
        rows = [ids_of.take(pa.array(take, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            rows.append(pa.array(ids, pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(rows, names)

    return documents(docs).mapInArrow(in_batches(work), PIECES + (", ids array<int>" if with_ids else ""))


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, end rank, first sequence, pieces per sequence, offset) that place all pieces.

    Ranks count the pieces of one length from 0. In a run, rank r goes to sequence ``first + (r - first rank) // per``
    at ``offset + (r - first rank) % per * length``.
    """
    left = {n: c for n, c in histogram.items() if c}
    done: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[list[int]]] = defaultdict(list)  # gap -> [first sequence, number of sequences]
    runs, bins = [], 0

    def place(length: int, count: int, sequence: int, per: int, offset: int) -> None:
        runs.append((length, done[length], done[length] + count, sequence, per, offset))
        done[length] += count
        left[length] -= count

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        while left[n]:
            mate = next((m for m in large if m <= min(n, capacity - n) and left[m] > (m == n)), None)
            k = left[n] if mate is None else left[n] // 2 if mate == n else min(left[n], left[mate])
            place(n, k, bins, 1, 0)
            if mate is not None:
                place(mate, k, bins, 1, n)
            gaps[capacity - n - (mate or 0)].append([bins, k])
            bins += k
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            gap = next((g for g in range(n, capacity) if gaps[g]), capacity)
            if gap == capacity:
                k = -(-left[n] // (capacity // n))
                gaps[gap].append([bins, k])
                bins += k
            sequence, count = gaps[gap].pop()
            per = min(gap // n, left[n])
            used = min(count, left[n] // per)
            place(n, used * per, sequence, per, capacity - gap)
            gaps[gap - per * n].append([sequence, used])
            if used < count:
                gaps[gap].append([sequence + used, count - used])
    return runs


def packed(cut: DataFrame, capacity: int = CAPACITY, ranked_together: int = RANKED_TOGETHER) -> DataFrame:
    """``pieces`` (a written table) with ``sequence_id`` and ``offset``.

    The histogram has at most ``capacity`` rows, whatever the input; it and the runs made from it are all the driver
    sees. Ranks come from a prefix sum over small hash groups inside each length, so a length that a third of all
    pieces share is ranked by many tasks. Equal rows may swap places. An empty table gives no rows.
    """
    spark = cut.sparkSession
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_length = defaultdict(list)
    for length, *run in plan(histogram, capacity):
        by_length[length].append(tuple(run))
    runs = spark.createDataFrame(
        list(by_length.items()), "length long, runs array<struct<low:long,high:long,first:long,per:long,at:long>>")
    groups = max(64, sum(histogram.values()) // ranked_together)
    keyed = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (keyed.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
               .select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip")))
    inside = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (keyed.withColumn("row", F.row_number().over(inside)).join(offsets, ["length", "part"])
              .withColumn("rank", F.col("row") - 1 + F.col("skip")))
    run = F.expr("element_at(filter(runs, r -> r.low <= rank and rank < r.high), 1)")
    return (ranked.join(F.broadcast(runs), "length").withColumn("run", run).select(
        *cut.columns, F.expr("run.first + (rank - run.low) div run.per").alias("sequence_id"),
        F.expr("run.at + (rank - run.low) % run.per * length").alias("offset")))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """One row per piece of every document, with its sequence and the place in it."""
    return packed(written(pieces(docs, capacity, path), "pieces"), capacity)
