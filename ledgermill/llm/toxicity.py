"""Toxicity by a weighted finite-state grammar over clauses.

Insults and threats are found by a lexicon of words and word beginnings whose weights come from labelled documents; words
for targets, negation and reported speech are given. Each clause with an insult or a threat is read by the composed
transducers of ``automata``, and the weights of the matches they write, by kind and context, make up the score.
Lexicon and match weights are fitted on a bounded sample of labelled rows; every document is scored whole.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.automata import INSULT, NEGATION, REPORT, TARGET, THREAT, Grammar
from ledgermill.llm.common import documents, in_batches, ship, written
from ledgermill.llm.spans import slices, span_hashes

SAMPLE = 30_000    # labelled rows that lexicon and weights are fitted on, at most
THRESHOLD = 0.3
BEGINNINGS = (4, 5, 6, 7)   # lengths in bytes of word beginnings
LEAST_ROWS = 3     # toxic rows that a lexicon entry needs
LEAST_GAIN = 12.0  # log likelihood ratio (G2) that an entry needs
LEAST_ODDS = 1.5   # log odds that an entry needs
DENSE = 0.006      # part of a text's words from which a term counts as dense
EXPLAINED = 4      # entries that make a toxic row explained: others must explain rows that are not

# Given words of the grammar, per class; insults are learned.
GIVEN = {
    THREAT: "kill hurt destroy burn shoot stab beat punish crush töten schlagen vernichten matar golpear tuer frapper",
    TARGET: "you your yours u ya they them he she him her these those du dich dir ihr euch tu tú te ti vous toi usted",
    NEGATION: "not no never neither nor hardly nicht nie kein keine nunca jamás ni ne pas jamais aucun isn't aren't "
              "don't doesn't won't wasn't can't",
    REPORT: "said says say called calls wrote writes claims claimed quoted quote reported sagte sagt schrieb dijo dice "
            "escribió dit disait écrit",
}
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), 39, *range(128, 256)]] = True
_CLAUSE = np.zeros(256, bool)
_CLAUSE[[10, 33, 46, 58, 59, 63]] = True
_WORD = re.compile(r"[0-9A-Za-z'\u0080-\U0010ffff]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@dataclass(frozen=True)
class Model:
    """What scoring needs: insult entries with weights ("word" or "beginning*"), match weights, and the offset."""
    insults: dict[str, float] = field(default_factory=dict)
    weights: tuple[float, ...] = ()
    offset: float = -3.0


def _terms(text: str) -> set[str]:
    """Words and word beginnings ("begin*") of a text; those that make up DENSE of its words also with a "@"."""
    words = Counter(_WORD.findall(text.translate(_LOWER)))
    least = max(2, DENSE * words.total())
    raw = [(w.encode(), n) for w, n in words.items()]
    found = set(words)
    for size in BEGINNINGS:
        begun: Counter[bytes] = Counter()
        for b, n in raw:
            if len(b) > size and b[size] & 0xC0 != 0x80:  # cut between characters only
                begun[b[:size]] += n
        found.update([b.decode() + "*" for b in begun])
        found.update([b.decode() + "*@" for b, n in begun.items() if n >= least])
    found.update([w + "@" for w, n in words.items() if n >= least])
    return found


def _span_hash(words: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words]) if words else np.empty(0, np.int64)
    return span_hashes(data, np.concatenate([[0], ends[:-1]]).astype(np.int64) if words else ends, ends)


class Lexicon:
    """Classes and weights of words by hash, looked up for whole slices at once."""

    def __init__(self, model: Model):
        entries: dict[int, dict[bytes, tuple[int, float]]] = {0: {}, **{n: {} for n in BEGINNINGS}}
        for kind, words in GIVEN.items():
            entries[0] |= {w.encode(): (kind, 1.0) for w in words.split()}
        for term, weight in model.insults.items():
            length = len(term.encode()) - 1 if term.endswith("*") else 0
            entries[length][term.removesuffix("*").encode()] = (INSULT, weight)
        self.tables = {}
        for n, words in entries.items():
            keys = _span_hash(list(words))
            order = np.argsort(keys)
            kinds = np.array([k for k, _ in words.values()], np.int64)
            weights = np.array([w for _, w in words.values()], float)
            self.tables[n] = keys[order], kinds[order], weights[order]

    def classes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kinds, weights = np.zeros(len(starts), np.int64), np.zeros(len(starts))
        for n, (keys, kind, weight) in sorted(self.tables.items(), reverse=True):
            rows = np.flatnonzero(ends - starts > n) if n else np.arange(len(starts))
            if not len(keys) or not len(rows):
                continue
            hashes = span_hashes(data, starts[rows], starts[rows] + n if n else ends[rows], lower=True)
            at = np.searchsorted(keys, hashes).clip(0, len(keys) - 1)
            hit = np.flatnonzero(keys[at] == hashes)
            better = hit[weights[rows[hit]] <= weight[at[hit]]] if n else hit
            kinds[rows[better]], weights[rows[better]] = kind[at[better]], weight[at[better]]
        return kinds, weights


def match_weights(column: pa.Array, model: Model, grammar: Grammar) -> tuple[np.ndarray, np.ndarray]:
    """Per text the weight of its matches, by kind and context, over all of its clauses, and its number of words."""
    lexicon = Lexicon(model)
    out, words = np.zeros((len(column), Grammar.matches)), np.zeros(len(column), np.int64)
    for low, high, data, at in slices(column):
        letter = np.zeros(len(data) + 2, bool)
        letter[1:-1] = _LETTER[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[at] = True
        starts = np.flatnonzero(letter[1:-1] & (~letter[:-2] | cut[:-1]))
        ends = np.flatnonzero(letter[1:-1] & (~letter[2:] | cut[1:])) + 1
        words[low:high] = np.diff(np.searchsorted(starts, at))
        kinds, weights = lexicon.classes(data, starts, ends)
        hot = np.flatnonzero((kinds == INSULT) | (kinds == THREAT))
        if not len(hot):
            continue
        border = np.concatenate([np.flatnonzero(_CLAUSE[data]), at])
        border.sort()
        clause = np.searchsorted(border, starts, side="right")
        rows = np.searchsorted(at, starts, side="right") - 1
        first, last = np.searchsorted(clause, clause[hot]), np.searchsorted(clause, clause[hot], side="right")
        for a, b in sorted(set(zip(first.tolist(), last.tolist(), strict=True))):
            out[low + rows[a]] += grammar.scan(kinds[a:b].tolist(), weights[a:b].tolist())
    return out, words


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label: str = "toxic") -> DataFrame:
    """``text`` and ``y`` of labelled rows that may be learned from, up to ``sample`` of them by hash of the id.

    Rows whose crc32 of the id as text leaves 2 on division by 4, and null labels, are never among them.
    """
    may = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2) & F.col("y").isNotNull()
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
              .where(may).dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # the sample is bounded by the parameter, so it may be broadcast; equal texts count once
    return (documents(docs).join(F.broadcast(chosen), "doc_id").groupBy(F.xxhash64("text"), "text")
            .agg(F.max("y").alias("y")).select("text", "y"))


def _counts(rows: DataFrame) -> DataFrame:
    """``term, toxic, clean``: rows of each label that a term occurs in, from one pass over the texts."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter[str], Counter[str]] = (Counter(), Counter())

        def sums() -> pa.RecordBatch:
            terms = list(seen[0].keys() | seen[1].keys())
            return pa.RecordBatch.from_pydict({
                "term": pa.array(terms, pa.string()), "toxic": pa.array([seen[1][t] for t in terms], pa.int64()),
                "clean": pa.array([seen[0][t] for t in terms], pa.int64())})
        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
                seen[int(y == 1)].update(_terms(text))
                if len(seen[0]) + len(seen[1]) > 300_000:
                    yield sums()
                    seen = (Counter(), Counter())
        if seen[0] or seen[1]:
            yield sums()

    return rows.where("y IN (0, 1)").select("text", "y").mapInArrow(work, "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _telling(rows: DataFrame, toxic: int, clean: int) -> DataFrame:
    """``term, odds, gain`` of the terms with enough toxic rows, log odds and log likelihood ratio."""
    n, m = F.col("toxic"), F.col("clean")
    odds = F.log((n + 0.5) / (toxic + 1)) - F.log((m + 0.5) / (clean + 1))
    gain = F.lit(0.0)
    for o, r, c in ((n, n + m, toxic), (m, n + m, clean), (toxic - n, toxic + clean - n - m, toxic),
                    (clean - m, toxic + clean - n - m, clean)):
        gain += F.when(o > 0, o * F.log(o * F.lit(float(toxic + clean)) / (r * F.lit(float(c))))).otherwise(0.0)
    return _counts(rows).where(n >= LEAST_ROWS).select("term", odds.alias("odds"), (2 * gain).alias("gain")).where(
        (F.col("odds") >= LEAST_ODDS) & (F.col("gain") >= LEAST_GAIN))


def _lexicon(rows: DataFrame) -> dict[str, float]:
    """Entries with their log odds, each of which helps to explain toxic rows that more telling ones do not.

    All terms of the rows are weighed; only those that reach the thresholds come to the driver, which the bounded
    sample of labelled rows bounds.
    """
    size = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic:
        return {}
    found = _telling(rows, toxic, clean).collect()
    strong, gain = {r["term"]: r["odds"] for r in found}, {r["term"]: r["gain"] for r in found}
    # most telling first; of equals the whole word, then the longest beginning
    order = sorted(strong, key=lambda t: (-round(gain[t], 6), "*" in t, -len(t), t))
    if not order:
        return {}
    known, number = frozenset(order), {t: i for i, t in enumerate(order)}

    def hits(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [sorted(number[t] for t in _terms(x) & known) for x in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_pydict({"hits": pa.array(found, pa.list_(pa.int32()))})

    sets = [set(r["hits"]) for r in rows.where("y = 1").select("text").mapInArrow(
        in_batches(hits), "hits array<int>").where("size(hits) > 0").collect()]
    chosen: dict[str, float] = {}
    holders: dict[int, list[int]] = {}
    for i, s in enumerate(sets):
        for h in s:
            holders.setdefault(h, []).append(i)
    explained = np.zeros(len(sets), np.int64)
    taken: list[tuple[str, set[int]]] = []
    for k, term in enumerate(order):
        rows_of, base, stem = holders.get(k, []), term.rstrip("@"), term.rstrip("@*")
        same = any((stem.startswith(other) or other.startswith(stem)) and rows_ == set(rows_of) for other, rows_ in taken)
        if base not in chosen and not same and (
                (explained[rows_of] < EXPLAINED).sum() >= max(2, 0.15 * len(rows_of))):
            chosen[base] = min(strong[term], 8.0)
            explained[rows_of] += 1
            taken.append((stem, set(rows_of)))
    return chosen


#: Match weights before any label is seen, and how firmly they are held: insults and threats by context, and the
#: whole amount of matches.
PRIOR = np.array([1.0, 1.2, 0.5, 0.6, 0.3, 0.5, 1.2, 0.2, 0.3, 0.1, 0.0])
HELD = 1.0


def _fit_weights(features: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic weights of features, held to the prior, by Newton steps; ``n`` counts equal rows."""
    x = np.column_stack([features, np.ones(len(features))])
    w, prior = np.append(PRIOR, -3.0), np.append(PRIOR, -3.0)
    hold = np.append(np.full(len(PRIOR), HELD), 0.01)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.diag(hold),
                               x.T @ (n * (y - p)) - hold * (w - prior))
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return np.maximum(w[:-1], 0), float(w[-1])


def clause_features(column: pa.Array, model: Model) -> np.ndarray:
    """Per text: each match's weight among a hundred words, and the weight of all matches, on log scales."""
    matches, words = match_weights(column, model, Grammar())
    share = 100 * matches / np.maximum(words, 20)[:, None]
    return np.round(np.log1p(np.column_stack([share, matches.sum(axis=1)])), 1)


def _score(column: pa.Array, model: Model) -> np.ndarray:
    z = clause_features(column, model) @ (np.array(model.weights) if model.weights else PRIOR) + model.offset
    return 1 / (1 + np.exp(-z))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from labelled rows. Without labels, or without toxic ones, no insult is known and scores stay low."""
    ship(docs.sparkSession)
    rows = written(training_rows(docs, labels, sample).repartition(
        max(8, docs.sparkSession.sparkContext.defaultParallelism)), "training")
    model = Model(insults=_lexicon(rows))

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = clause_features(batch.column("text"), model)
        return pa.RecordBatch.from_arrays([batch.column("y"), pa.array(list(x), pa.list_(pa.float64()))], ["y", "x"])

    seen = (rows.select("y", "text").mapInArrow(in_batches(features), "y int, x array<double>")
            .groupBy("y", "x").agg(F.count(F.lit(1)).alias("n")).collect())
    if not seen:
        return model
    x, y, n = (np.array([r[c] for r in seen], float) for c in ("x", "y", "n"))
    weights, offset = _fit_weights(x.reshape(len(seen), -1), y, n)
    return Model(model.insults, tuple(weights.tolist()), offset)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score``: the whole text of every document, null or empty ones included."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_score(batch.column("text"), model))],
                                          ["doc_id", "score"])

    return documents(docs).mapInArrow(in_batches(work), "doc_id long, score double")


def judged(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per document, repeated ones too.

    ``held_out`` is null for a null id; such a row is never learned from.
    """
    return scores(docs, fit(docs, labels, sample)).select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    model = fit(docs, labels, sample)
    return docs.mapInArrow(in_batches(lambda b: b.filter(pa.array(_score(b.column("text"), model) < threshold))),
                           docs.schema)
