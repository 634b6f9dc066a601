"""Interpolated modified Kneser-Ney bigram model, counted in Spark and stored as sorted hash arrays.

Words are 64-bit hashes; a word's id is its place among all sorted hashes of the training texts, and a bigram is one
64-bit number of two ids. Tasks count what they read and send packed arrays, not rows, to the owner of a range of
hashes or ids, who adds them up and writes sorted arrays to the shared folder. A bigram belongs to the owner of its
first word; those of very frequent first words are spread over all owners. Workers map the arrays into memory and look
up the sorted n-grams of a slice at a time.
"""
from __future__ import annotations

import os
import resource
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.common import documents, in_batches, mix, ship, written
from ledgermill.llm.spans import slices, span_hashes, word_spans
from ledgermill.session import fresh_path

PART_BYTES = 24_000_000   # bytes of text for which one owner is added
MAPPED = 30_000           # arrays that a worker keeps mapped, at most
FLUSH = 4_000_000         # n-grams that a task gathers before it sends them
END = np.uint64(0xE4D0_0F_7E_87)  # the end token; a word's hash equals it with a chance of 2**-64
_SEND = "part int, blob binary"
_LOG10 = np.log(10.0)


@dataclass(frozen=True)
class Model:
    """Where the arrays lie, and the few numbers that belong to the whole model."""
    folder: str
    parts: int
    bases: tuple[int, ...] = ()           # first id of each part, and the number of all ids
    tokens: int = 0
    hot: tuple[int, ...] = ()             # ids of first words whose bigrams are spread
    hot_stats: tuple[tuple[int, ...], ...] = ()
    discounts: tuple[tuple[float, ...], tuple[float, ...]] = ((0.5, 1.0, 1.5), (0.5, 1.0, 1.5))
    bigrams: int = 0                      # distinct ones
    kinds: tuple[int, ...] = (0, 0, 0)    # words with 1, 2, and more distinct predecessors

    @property
    def size(self) -> int:
        return self.bases[-1] if self.bases else 0


def local_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all workers reach by the same path; the model's arrays are mapped from it."""
    url = urlparse(fresh_path(spark, "model"))
    if url.scheme not in ("", "file"):
        raise ValueError(f"the arrays are memory-mapped, so spark.checkpoint.dir must be a mounted folder, not {url.scheme}:")
    path = unquote(url.path)
    os.makedirs(path, exist_ok=True)
    return path


def _save(folder: str, name: str, array: np.ndarray) -> None:
    """Written aside and renamed, so a task that runs twice leaves one whole file."""
    path, aside = os.path.join(folder, name + ".npy"), os.path.join(folder, f".{name}-{os.getpid()}-{os.urandom(4).hex()}")
    with open(aside, "wb") as out:
        np.save(out, array)
    os.replace(aside, path)


@lru_cache(maxsize=1)
def _room() -> int:
    """Arrays that this process may keep mapped: each holds a file descriptor, of which half are left to others."""
    soft, hard = resource.getrlimit(resource.RLIMIT_NOFILE)
    most = 2 * MAPPED if hard == resource.RLIM_INFINITY else min(2 * MAPPED, hard)
    if soft != resource.RLIM_INFINITY and soft < most:
        resource.setrlimit(resource.RLIMIT_NOFILE, (most, hard))
    return max(16, most // 2)


_mapped: OrderedDict[tuple[str, str], np.ndarray] = OrderedDict()


def _load(folder: str, name: str) -> np.ndarray:
    """An array of the model; of more than :func:`_room` the one unused for longest is unmapped."""
    array = _mapped.pop((folder, name), None)
    if array is None:
        while len(_mapped) >= _room():
            _mapped.popitem(last=False)
        array = np.load(os.path.join(folder, name + ".npy"), mmap_mode="r")
    _mapped[folder, name] = array
    return array


def _pack(*arrays: np.ndarray) -> bytes:
    """Columns of equal length; sorted ones as differences, so that they shrink."""
    raw = b"".join(a.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays)
    return np.array([len(arrays[0]), len(arrays)], "<i8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(blob: bytes) -> list[np.ndarray]:
    n, columns = np.frombuffer(blob, "<i8", 2).tolist()
    raw = pa.decompress(blob[16:], decompressed_size=8 * n * columns, codec="zstd", asbytes=True)
    return [np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n, 8 * n * k).reshape(8, n).T).view("<u8").ravel()
            for k in range(columns)]


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the counts of equal keys, sorted by key."""
    if not len(keys):
        return keys.astype(np.uint64), counts.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order].astype(np.int64), first)


def _part_of_hash(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _send(parts: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(owner, packed columns); the rows are sorted by owner, and by the first column inside."""
    cuts = np.flatnonzero(np.diff(parts, prepend=-1))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(parts)], strict=True):
        yield int(parts[a]), _pack(np.diff(columns[0][a:b], prepend=np.uint64(0)), *[c[a:b] for c in columns[1:]])


def _received(table: pa.Table) -> tuple[np.ndarray, ...]:
    """The columns of all blobs of an owner."""
    unpacked = [_unpack(b) for b in table.column("blob").to_pylist()]
    firsts = [np.cumsum(u[0], dtype=np.uint64) for u in unpacked]
    return np.concatenate(firsts), *[np.concatenate([u[k] for u in unpacked]) for k in range(1, len(unpacked[0]))]


def _blobs(sent: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    for part, blob in sent:
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([blob], pa.binary())], ["part", "blob"])


def _counting(grams: Callable[[pa.Array], Iterator[np.ndarray]], part_of: Callable[[np.ndarray], np.ndarray]) -> Callable:
    """A ``mapInArrow`` function that counts 64-bit n-grams and sends the counts to their owners."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        fresh: list[np.ndarray] = []
        held = 0

        def fold() -> None:
            nonlocal keys, counts, held
            new = np.concatenate([keys, *fresh])
            keys, counts = _added(new, np.concatenate([counts, np.ones(len(new) - len(keys), np.int64)]))
            fresh.clear()
            held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal keys, counts
            part = part_of(keys)
            order = np.argsort(part, kind="stable")
            yield from _blobs(_send(part[order], keys[order], counts[order]))
            keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)

        for batch in batches:
            for found in grams(batch.column("text")):
                fresh.append(found)
                held += len(found)
                if held >= FLUSH // 2:
                    fold()
                    if len(keys) >= FLUSH:
                        yield from flush()
        if fresh:
            fold()
        if len(keys):
            yield from flush()

    return run


def token_hashes(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of rows: first row, end row, the hashes of all tokens (each text closed by END), where rows begin."""
    for low, high, data, at in slices(column):
        starts, ends, first = word_spans(data, at)
        tokens = np.insert(span_hashes(data, starts, ends, lower=True), first[1:], END)
        yield low, high, tokens, first + np.arange(len(first))


class Words:
    """Ids of words from the mapped arrays; an unknown word has the number of all ids plus one."""

    def __init__(self, model: Model):
        self.model = model

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        model = self.model
        distinct, back = np.unique(hashes, return_inverse=True)
        out = np.full(len(distinct), model.size + 1, np.int64)
        cuts = np.searchsorted(_part_of_hash(distinct, model.parts), np.arange(model.parts + 1))
        for part in range(model.parts):
            a, b = cuts[part], cuts[part + 1]
            if a < b and model.bases[part] < model.bases[part + 1]:
                keys = _load(model.folder, f"words-{part}")
                at = np.searchsorted(keys, distinct[a:b]).clip(0, len(keys) - 1)
                out[a:b] = np.where(keys[at] == distinct[a:b], model.bases[part] + at, out[a:b])
        return out[back]

    def numbers(self, ids: np.ndarray, name: str) -> np.ndarray:
        """A stored number of each id in a mapped array; 0 for an unknown word. ``ids`` are distinct and sorted."""
        out = np.zeros(len(ids), np.int64)
        cuts = np.searchsorted(ids, np.array(self.model.bases))
        for part in range(self.model.parts):
            a, b = cuts[part], cuts[part + 1]
            if a < b:
                out[a:b] = _load(self.model.folder, f"{name}-{part}")[ids[a:b] - self.model.bases[part]]
        return out


def _bigrams(ids: np.ndarray, first: np.ndarray, begin: int) -> np.ndarray:
    """Each token with the one before it, or the begin mark, as one number of twice 32 bits."""
    if begin >= 1 << 32:
        raise OverflowError(f"{begin} distinct words do not fit ids of 32 bits")
    before = np.empty(len(ids), np.int64)
    before[1:] = ids[:-1]
    before[first[:-1]] = begin
    return before.astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64)


def _owner(model: Model) -> Callable[[np.ndarray], np.ndarray]:
    bases, hot = np.array(model.bases), np.array(model.hot, np.int64)

    def part_of(keys: np.ndarray) -> np.ndarray:
        one = (keys >> np.uint64(32)).astype(np.int64)
        own = np.searchsorted(bases, one, side="right") - 1
        return np.where(np.isin(one, hot), _part_of_hash(mix(keys), model.parts), own.clip(0, model.parts - 1))
    return part_of


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and more from how many n-grams have count 1 to 4."""
    if min(n) <= 0:
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    return tuple(float(np.clip(k + 1 - (k + 2) * y * n[k + 1] / n[k], 0.01, k + 0.99)) for k in range(3))


def train(docs: DataFrame, parts: int | None = None) -> Model:
    """A model of the texts of ``docs`` (``text``). Without documents it knows no word and gives every token 1.

    Owners grow with the text. The driver receives sizes of parts, counts of counts, and one row of statistics for each
    very frequent first word, of which there are four per part at most; owners' shares are added up in Spark.
    """
    spark = docs.sparkSession
    folder = local_folder(spark)
    if parts is None:
        size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
        parts = max(1, -(-size // PART_BYTES))
    made = Model(folder, parts)

    def all_tokens(column: pa.Array) -> Iterator[np.ndarray]:
        return (tokens for _, _, tokens, _ in token_hashes(column))

    def store_words(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        keys, counts = _added(*_received(table))
        _save(folder, f"words-{part}", keys)
        _save(folder, f"counts-{part}", counts)
        top = np.argsort(-counts, kind="stable")[:64]
        return pa.table({"part": pa.array([part], pa.int32()), "n": [len(keys)], "total": [int(counts.sum())],
                         "top": pa.array([top.tolist()], pa.list_(pa.int64())),
                         "top_n": pa.array([counts[top].tolist()], pa.list_(pa.int64()))})

    stored = (docs.select("text").mapInArrow(_counting(all_tokens, lambda k: _part_of_hash(k, parts)), _SEND)
              .groupBy("part").applyInArrow(store_words, "part int, n long, total long, top array<long>, top_n array<long>")
              .collect())
    sizes = np.zeros(parts + 1, np.int64)
    for r in stored:
        sizes[r["part"] + 1] = r["n"]
    bases, tokens = np.cumsum(sizes), sum(r["total"] for r in stored)
    # first words with more tokens than a quarter of a part's share; more than 4 per part there cannot be
    hot = sorted(int(bases[r["part"]] + i) for r in stored for i, n in zip(r["top"], r["top_n"], strict=True)
                 if parts > 1 and 4 * n * parts > tokens)
    begin = int(bases[-1])
    made = Model(folder, parts, tuple(bases.tolist()), tokens, tuple([*hot, begin]))
    if not tokens:
        return made
    words, owner, hot_ids = Words(made), _owner(made), np.array([*hot, begin])

    def all_bigrams(column: pa.Array) -> Iterator[np.ndarray]:
        return (_bigrams(words.ids(t), first, begin) for _, _, t, first in token_hashes(column))

    def store_bigrams(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        keys, counts = _added(*_received(table))
        _save(folder, f"bigrams-{part}", keys)
        _save(folder, f"bigram-counts-{part}", counts.astype(np.min_scalar_type(int(counts.max()))))
        one = (keys >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(one, prepend=-1))
        stats = np.stack([np.add.reduceat(x, first) for x in (
            counts, *[(counts == k).astype(np.int64) for k in (1, 2)], (counts > 2).astype(np.int64))])
        contexts = one[first]
        spread = np.isin(contexts, hot_ids)
        dense = np.zeros((4, int(bases[part + 1] - bases[part])), np.int64)
        dense[:, contexts[~spread] - bases[part]] = stats[:, ~spread]
        for k in range(4):
            _save(folder, f"context{k}-{part}", dense[k].astype(np.min_scalar_type(int(dense[k].max(initial=0)))))
        two, n = np.unique(keys & np.uint64(0xFFFFFFFF), return_counts=True)
        to = np.searchsorted(bases, two.astype(np.int64), side="right") - 1
        sent = [(-1, -1, p, b, [0] * 5) for p, b in _send(to, two, n)]
        sent += [(0, int(c), -1, None, [*s.tolist(), 0]) for c, s in zip(contexts[spread], stats.T[spread], strict=True)]
        sent.append((1, -1, -1, None, [int((counts == k).sum()) for k in (1, 2, 3, 4)] + [len(keys)]))
        return pa.table({"kind": pa.array([s[0] for s in sent], pa.int32()), "context": pa.array([s[1] for s in sent], pa.int64()),
                         "part": pa.array([s[2] for s in sent], pa.int32()), "blob": pa.array([s[3] for s in sent], pa.binary())}
                        | {f"s{k}": pa.array([s[4][k] for s in sent], pa.int64()) for k in range(5)})

    counted = written(docs.select("text").mapInArrow(_counting(all_bigrams, owner), _SEND).groupBy("part").applyInArrow(
        store_bigrams, "kind int, context long, part int, blob binary, s0 long, s1 long, s2 long, s3 long, s4 long"), "bigrams")
    hot_stats = {c: np.zeros(4, np.int64) for c in (*hot, begin)}
    totals = np.zeros(5, np.int64)
    added = counted.where("kind >= 0").groupBy("kind", "context").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(5)])
    for r in added.collect():
        numbers = np.array([r[f"s{k}"] for k in range(5)], np.int64)
        if r["kind"]:
            totals = numbers
        else:
            hot_stats[r["context"]] = numbers[:4]

    def store_predecessors(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        keys, n = _added(*_received(table))
        dense = np.zeros(int(bases[part + 1] - bases[part]), np.int64)
        dense[keys.astype(np.int64) - bases[part]] = n
        _save(folder, f"before-{part}", dense.astype(np.min_scalar_type(int(dense.max(initial=0)))))
        return pa.table({f"n{k}": [int((dense == k).sum())] for k in (1, 2, 3, 4)} | {"more": [int((dense > 2).sum())]})

    kinds = (counted.where("kind = -1").select("part", "blob").groupBy("part")
             .applyInArrow(store_predecessors, "n1 long, n2 long, n3 long, n4 long, more long").collect())
    n = [sum(r[f"n{k}"] for r in kinds) for k in (1, 2, 3, 4)]
    return Model(folder, parts, made.bases, tokens, made.hot, tuple(tuple(hot_stats[c].tolist()) for c in made.hot),
                 (_discounts(totals[:4].tolist()), _discounts(n)), int(totals[4]),
                 (n[0], n[1], sum(r["more"] for r in kinds)))


def _discounted(counts: np.ndarray, discounts: tuple[float, ...]) -> np.ndarray:
    return np.maximum(counts - np.array([0.0, *discounts])[np.minimum(counts, 3)], 0)


def unigram_probability(model: Model, before: np.ndarray) -> np.ndarray:
    """Share of a word's distinct predecessors among all bigrams, interpolated with one share for each word and one for
    all unknown ones."""
    uniform = 1 / (model.size + 1)
    if not model.bigrams:
        return np.full(len(before), uniform)
    left = float(np.dot(model.discounts[1], model.kinds)) / model.bigrams
    return _discounted(before, model.discounts[1]) / model.bigrams + left * uniform


def log10_scores(column: pa.Array, model: Model) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of rows: first row, end row, where rows begin, and per token its training count, base and model log10."""
    words, owner = Words(model), _owner(model)
    bases, begin = np.array(model.bases or (0, 0)), model.size
    hot, hot_stats = np.array(model.hot, np.int64), np.array(model.hot_stats or np.zeros((0, 4)), np.int64).reshape(-1, 4)
    for low, high, tokens, first in token_hashes(column):
        ids = words.ids(tokens) if model.tokens else np.ones(len(tokens), np.int64)
        known, back = np.unique(ids, return_inverse=True)
        inside = known < begin
        counts, before = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)
        if model.tokens:
            counts[inside] = words.numbers(known[inside], "counts")
            before[inside] = words.numbers(known[inside], "before")
        base = np.log((counts + 0.1) / (model.tokens + 0.1 * (begin + 1))) / _LOG10
        lower = unigram_probability(model, before)
        keys, where = np.unique(_bigrams(ids, first, begin), return_inverse=True)
        one = (keys >> np.uint64(32)).astype(np.int64)
        two = np.searchsorted(known, (keys & np.uint64(0xFFFFFFFF)).astype(np.int64))
        seen = np.zeros(len(keys), np.int64)
        stats = np.zeros((4, len(keys)), np.int64)
        if model.tokens:
            part = owner(keys)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(model.parts + 1))
            for p in range(model.parts):
                rows = order[cuts[p]:cuts[p + 1]]
                path = os.path.join(model.folder, f"bigrams-{p}.npy")
                if len(rows) and os.path.exists(path):
                    stored = _load(model.folder, f"bigrams-{p}")
                    at = np.searchsorted(stored, keys[rows]).clip(0, len(stored) - 1)
                    hit = stored[at] == keys[rows]
                    seen[rows[hit]] = _load(model.folder, f"bigram-counts-{p}")[at[hit]]
                    plain = rows[(one[rows] < begin) & ~np.isin(one[rows], hot)]
                    own = one[plain] - bases[p]
                    for k in range(4):
                        stats[k, plain] = _load(model.folder, f"context{k}-{p}")[own]
            spread = np.isin(one, hot)
            stats[:, spread] = hot_stats[np.searchsorted(hot, one[spread])].T
        total = stats[0]
        share = np.where(total > 0, np.dot(model.discounts[0], stats[1:]) / np.maximum(total, 1), 1.0)
        p = _discounted(seen, model.discounts[0]) / np.maximum(total, 1) + share * lower[two]
        yield low, high, first, counts[back], base[back], (np.log(p) / _LOG10)[where]


def scored(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, one row per document.

    The model learns from documents whose crc32 of the id as text is not divisible by 10; a row without id is scored
    but not learned from, and its ``held_out`` is null. A null or empty text is the end token alone. ``base_score`` is
    that of add-0.1 unigrams; ``score`` the model's log10 probability of the whole text.
    """
    ship(docs.sparkSession)
    rows = documents(docs).withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0)
    model = train(rows.where("NOT held_out").select("text"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        out = [np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)]
        for low, high, first, counts, base, score in log10_scores(batch.column("text"), model):
            out[0][low:high] = np.diff(first)
            for k, x in ((1, (counts > 0).astype(np.int64)), (2, base), (3, score)):
                out[k][low:high] = np.add.reduceat(x, first[:-1])
        tokens, known, base, score = map(pa.array, out)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), tokens, known,
             pa.array(np.full(n, model.tokens), pa.int64()), base, score],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return rows.mapInArrow(in_batches(work), "doc_id long, held_out boolean, n_tokens long, n_known long, "
                                             "train_tokens long, base_score double, score double")
