"""Document quality by a logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

A text falls into words (runs of letters, of digits, of other marks). Its features are the words, pairs of neighbouring
words, one to three neighbouring words by their shape, and words that come again at once. Each feature is hashed to one of
2**BITS weights; its value is its share of the text's words. A score is the sparse dot product of shares and weights.

Training rows are dealt to shards. In each round every shard runs over its rows once, from the state that the round before
ended with, and the states of the shards are averaged; a state has a fixed size.
"""
from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import documents, in_batches, mix, written
from ledgermill.llm.spans import slices, span_hashes

THRESHOLD = 0.7
SAMPLE = 20_000      # labelled documents that are learned from, at most
SHARDS = 8
ROUNDS = 2
BITS = 18
FEATURE_SLICE = 500_000
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.0005, 0.001
SCALE = 8.0          # shares are small numbers; this brings them to the order of one
SPACE, LETTER, DIGIT, MARK = range(4)
_CLASS = np.full(256, MARK, np.uint8)
_CLASS[:33] = SPACE
_CLASS[48:58] = DIGIT
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = LETTER
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_SALTS = mix(np.arange(1, 9, dtype=np.uint64) << np.uint64(32))


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts that begin at ``at``: row and weight number of each feature, and the words of each row."""
    kind = np.zeros(len(data) + 2, np.uint8)
    kind[1:-1] = _CLASS[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = True
    edge = (kind[1:] != kind[:-1]) | cut
    starts = np.flatnonzero(edge[:-1] & (kind[1:-1] != SPACE))
    ends = np.flatnonzero(edge[1:] & (kind[1:-1] != SPACE)) + 1
    rows, words = np.searchsorted(at, starts, side="right") - 1, np.diff(np.searchsorted(starts, at))
    if not len(starts):
        return rows, rows, words
    h = span_hashes(data, starts, ends)
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    capitals, length, sort = upper[ends] - upper[starts], ends - starts, kind[1:-1][starts]
    # a shape: all, some or no capitals, and the length up to 4; marks stand for themselves
    shape = mix((sort.astype(np.uint64) << np.uint64(8)) + np.minimum(length, 4).astype(np.uint64) * np.uint64(4)
                + (capitals > 0).astype(np.uint64) + (capitals == length).astype(np.uint64))
    shape = np.where(sort == MARK, h, shape)

    def joined(x: np.ndarray, n: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
        out = x[:len(x) - n + 1] ^ _SALTS[salt]
        for k in range(1, n):
            out = mix(out) + x[k:len(x) - n + 1 + k]
        whole = rows[:len(rows) - n + 1] == rows[n - 1:]
        return rows[n - 1:][whole], mix(out)[whole]

    found = [joined(h, 1, 0), joined(h, 2, 1), joined(shape, 1, 2), joined(shape, 2, 3), joined(shape, 3, 4)]
    for gap in (1, 2):
        again = (h[gap:] == h[:-gap]) & (rows[gap:] == rows[:-gap]) & (sort[gap:] == LETTER)
        found.append((rows[gap:][again], np.full(again.sum(), _SALTS[4 + gap])))
    number = np.concatenate([f[1] for f in found]) >> np.uint64(64 - BITS)
    return np.concatenate([f[0] for f in found]), number.astype(np.int64), words


@dataclasses.dataclass
class Leader:
    """The state of follow-the-regularised-leader: ``z`` and ``n`` of each weight, that of the constant last."""

    z: np.ndarray = dataclasses.field(default_factory=lambda: np.zeros(2 ** BITS + 1))
    n: np.ndarray = dataclasses.field(default_factory=lambda: np.zeros(2 ** BITS + 1))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
        more = np.sqrt(self.n[at] + g * g)
        self.z[at] += g - (more - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] += g * g


def learn_texts(leader: Leader, texts: pa.Array, y: list[int]) -> None:
    for low, _, data, at in slices(texts, FEATURE_SLICE):
        rows, numbers, words = features(data, at)
        order = np.lexsort((numbers, rows))
        rows, numbers = rows[order], numbers[order]
        bounds = np.searchsorted(rows, np.arange(len(words) + 1))
        for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            own, count = np.unique(numbers[a:b], return_counts=True)
            leader.learn(np.append(own, 2 ** BITS), np.append(count * (SCALE / max(1, words[k])), 1.0), y[low + k])


def score_texts(weights: np.ndarray, texts: pa.Array) -> np.ndarray:
    out = np.full(len(texts), 1 / (1 + np.exp(-weights[-1])))
    for low, high, data, at in slices(texts, FEATURE_SLICE):
        rows, numbers, words = features(data, at)
        total = np.bincount(rows, weights[numbers], minlength=len(words)) if len(rows) else np.zeros(len(words))
        out[low:high] = 1 / (1 + np.exp(-np.clip(total * SCALE / np.maximum(words, 1) + weights[-1], -35, 35)))
    return out


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, shards: int = SHARDS) -> DataFrame:
    """``shard, place, y, text``: labelled documents that may be learned from, up to ``sample`` of them by hash of the id.

    Rows whose crc32 of the id as text leaves 2 on division by 4, null ids and null labels are never among them. An id
    with several labels counts as good if one of them says so, one with several texts by the least of them.
    """
    may = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
              .where(may & F.col("y").isNotNull()).groupBy("doc_id").agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # the sample is bounded by the parameter, so it may be broadcast
    rows = documents(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    place = F.xxhash64("doc_id", F.lit(7))
    return rows.select(F.pmod(place, F.lit(shards)).cast("int").alias("shard"), place.alias("place"), "doc_id", "y", "text")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, shards: int = SHARDS, rounds: int = ROUNDS) -> np.ndarray:
    """Weights by number, that of the constant last. Without labels all are 0, and every score is one half."""
    rows = written(training_rows(docs, labels, sample, shards).repartition(shards, "shard")
                   .sortWithinPartitions("shard", "place", "doc_id"), "training")
    context, leader = docs.sparkSession.sparkContext, Leader()
    for _ in range(rounds):
        shared = context.broadcast((leader.z, leader.n))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own, shard, seen = None, None, 0

            def state() -> pa.RecordBatch:
                return pa.RecordBatch.from_pydict({"seen": pa.array([seen], pa.int64()),
                                                   "z": pa.array([own.z.tobytes()]), "n": pa.array([own.n.tobytes()])})
            for batch in batches:
                numbers = np.asarray(batch.column("shard"))
                for low in np.flatnonzero(np.diff(numbers, prepend=-1)).tolist():
                    high = int(np.searchsorted(numbers, numbers[low], side="right"))
                    if numbers[low] != shard:
                        if own is not None:
                            yield state()
                        own, shard, seen = Leader(*(x.copy() for x in shared.value)), numbers[low], 0
                    part = batch.slice(low, high - low)
                    learn_texts(own, part.column("text"), part.column("y").to_pylist())
                    seen += high - low
            if own is not None:
                yield state()

        # one state per shard comes back, whatever the size of the tables
        ordered = rows.repartition(shards, "shard").sortWithinPartitions("shard", "place", "doc_id")
        states = ordered.mapInArrow(work, "seen long, z binary, n binary").collect()
        if not states:
            break
        share = np.array([s["seen"] for s in states]) / sum(s["seen"] for s in states)
        leader = Leader(*(sum(w * np.frombuffer(s[c], np.float64) for w, s in zip(share, states, strict=True))
                          for c in ("z", "n")))
        shared.unpersist()
    return leader.weights()


def scores(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, score``: the whole text of every document, null or empty ones included."""
    frame = documents(docs)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score_texts(shared.value, batch.column("text")))],
                                          ["doc_id", "score"])

    return frame.mapInArrow(in_batches(work), "doc_id long, score double")


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per document, repeated ones too.

    A null or empty text is scored by the constant alone. ``held_out`` is null for a null id, which is never learned from.
    """
    return scores(docs, fit(docs, labels, sample)).select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
