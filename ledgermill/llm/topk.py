"""Exact top-k by inner product: term-at-a-time accumulation over blocks of candidates.

Vectors are whole numbers per component (term). A block of candidates keeps, for each term, the postings of the rows
that have it; a query scatters its weight times the postings' weights into a dense array of scores, one per row of the
block, term after term. The k best of each block are selected by partition, and the blocks' results merged.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import written
from ledgermill.llm.vectors import blocks, matrix, sound

K = 20
SCALE = 64
BLOCK = 4096     # candidates whose scores one array holds
QUERIES = 1024   # queries whose scores against one candidate block are held at once
LANES = 64       # queries accumulated side by side
STRIPES = 8      # tasks that one group of queries is dealt to, at least
STRIPE_BYTES = 32 << 20  # vectors of candidates in one task, on average
QUERY_BYTES = 32 << 20   # vectors of queries in one task, on average
_PACKED = "block long, n long, ids binary, data binary"


def whole_numbers(vectors: DataFrame, scale: int = SCALE, **names: str) -> DataFrame:
    """``vec_id`` and ``v``, each component x as floor(scale * x); unsound vectors are left out.

    Scores are exact as long as they fit 63 bits.
    """
    v = F.transform("v", lambda x: F.floor(x * float(scale)).cast("double"))
    return sound(vectors, **names).where("ok").select("vec_id", v.alias("v"))


def _packed(df: DataFrame, size: int) -> DataFrame:
    """Blocks of up to ``size`` vectors; ``block`` numbers them without repetition, not without gaps."""
    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        base = TaskContext.get().partitionId() << 32
        for k, ((ids,), data) in enumerate(blocks(rows, size)):
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([base + k], pa.int64()), "n": pa.array([len(ids)], pa.int64()),
                "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                "data": pa.array([data.astype("<i8").tobytes()], pa.binary())})
    return df.mapInArrow(pack, _PACKED)


def _accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores, queries by candidates. Sums of up to 31 bits are kept in 32-bit arrays, others in 64-bit ones.

    A term that few rows have is scattered to its postings alone; one that most rows have is added to all of them, as
    a weight of 0 changes no score.
    """
    bound = np.abs(candidates).max(initial=0).astype(float) * np.abs(queries).max(initial=0) * candidates.shape[1]
    kind = np.int32 if bound < 2 ** 31 else np.int64
    weights, terms = queries.astype(kind), np.ascontiguousarray(candidates.T.astype(kind))
    scores = np.zeros((len(queries), len(candidates)), kind)
    held = np.empty_like(scores)
    for term, row in enumerate(terms):
        postings = np.flatnonzero(row)
        if 2 * len(postings) > len(row):
            scores += np.multiply(weights[:, term, None], row[None, :], out=held)
        elif len(postings):
            for lane in np.flatnonzero(weights[:, term]):
                scores[lane, postings] += weights[lane, term] * row[postings]
    return scores


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to smaller ids."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= least)
        ids, scores = ids[keep], scores[keep]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], "<i8")
    return ids, np.frombuffer(row["data"], "<i8").reshape(len(ids), -1)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK, query_block: int = QUERIES,
          stripes: int = STRIPES, stripe_bytes: int = STRIPE_BYTES, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` its k best other rows of ``vectors``.

    Both have ``vec_id`` and ``v`` in whole numbers. A query does not meet the rows of its own id, and vectors of
    another width have no score with it. Candidate blocks are dealt to stripes of about ``stripe_bytes``, query blocks
    to groups of about ``query_bytes`` (one block at least), whatever the tables' size, and one task holds one of each.
    So a candidate travels once per group of queries, not once per block of them, and a query once per stripe.
    ``stripes`` is the least number of stripes. Their results, k per query, are merged per query. Repeated ids give one
    row each.
    """
    rows = written(_packed(vectors, block), "candidates")
    held = rows.agg(F.sum(F.octet_length("data").cast("long"))).first()[0] or 0
    stripes = max(stripes, -(-held // stripe_bytes))
    asked = written(_packed(queries, query_block), "queries")
    # blocks of queries, numbered from 0: their ids alone, no vectors
    asking = asked.agg(F.sum(F.octet_length("data").cast("long"))).first()[0] or 0
    groups = max(1, -(-asking // query_bytes))
    numbered = written(asked.select(
        "block", F.pmod(F.row_number().over(Window.orderBy("block")), F.lit(groups)).alias("q")), "numbers")
    every = F.sequence(F.lit(0), F.lit(groups - 1))
    # a stated query set against all rows, in blocks: each group of queries meets every stripe
    sides = (asked.join(numbered, "block")
             .withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
             .select("q", "stripe", F.lit(True).alias("asks"), "ids", "data"))
    pairs = (rows.withColumn("stripe", F.pmod(F.xxhash64("block"), F.lit(stripes)).cast("int"))
             .select(F.explode(every).alias("q"), "stripe", F.lit(False).alias("asks"), "ids", "data"))

    def work(table: pa.Table) -> pa.Table:
        found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

        def sides_of(asks: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for i in np.flatnonzero(table.column("asks").to_numpy() == asks).tolist():
                yield _unpacked({c: table.column(c)[i].as_py() for c in ("ids", "data")})

        asked_here = list(sides_of(True))
        for ids, data in sides_of(False):
            for b, (q_ids, q_data) in enumerate(asked_here):
                if data.shape[1] != q_data.shape[1]:
                    continue
                for low in range(0, len(q_ids), LANES):
                    scores = _accumulate(q_data[low:low + LANES], data)
                    for j, own in enumerate(q_ids[low:low + LANES].tolist(), low):
                        keep = ids != own
                        new = _best(ids[keep], scores[j - low][keep].astype(np.int64), k)
                        old = found.get((b, j))
                        found[b, j] = new if old is None else _best(
                            np.concatenate([old[0], new[0]]), np.concatenate([old[1], new[1]]), k)
        parts = [(np.full(len(i), asked_here[b][0][j]), i, s) for (b, j), (i, s) in found.items()]
        made = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.empty(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), made, strict=True)))

    met = sides.unionByName(pairs).groupBy("q", "stripe").applyInArrow(
        work, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
