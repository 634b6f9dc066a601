"""How far the sources of a language diverge in their use of terms.

Terms are counted for each language and source inside the tasks: a term of up to 8 bytes becomes one unsigned 64-bit word,
one of up to 16 bytes two, and such words are radix-sorted and run-counted; longer terms go to buckets by length, sorted
by their bytes. Tasks send sums, never occurrences. Shares of sources are then compared in tiles of sources and terms.

All arithmetic is on whole numbers: p = 1 + floor(10**9 * (count + 2) / (N + 2 * V)), f = floor((p - q)**2 / (p + q)).
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import ship, written
from ledgermill.llm.spans import slices

LEAST_DOCS = 10
TOP_TERMS = 10
SOURCE_BLOCK = 32      # sources on one side of a tile
TERM_BLOCK = 4096      # terms of a tile
PENDING = 1_000_000    # sums that a task holds before it sends them
PENDING_BYTES = 64_000_000
TERM_SLICE = 1_000_000
_TERM = np.zeros(256, bool)
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """The order of rows by unsigned ``keys``, the most significant one first; equal rows keep their places.

    Each key is sorted by 16 bits at a time from its low end, which numpy does by counting.
    """
    order = np.arange(len(keys[0]))
    for key in reversed(keys):
        for shift in range(0, key.dtype.itemsize * 8, 16):
            digit = (key >> key.dtype.type(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a run of rows equal in all columns begins."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _term_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _TERM[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    return starts, ends


def _words(padded: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Up to 8 bytes from each start as one number, first byte highest, absent ones zero."""
    window = np.lib.stride_tricks.sliding_window_view(padded, 8)[starts]
    words = np.ascontiguousarray(window).view(">u8").ravel().astype(np.uint64)
    absent = (8 - np.minimum(lengths, 8)).astype(np.uint64) * np.uint64(8)
    return (words >> absent) << absent


class TermCounts:
    """Sums by group and term: occurrences and documents. Bounded, for it is emptied whenever it is full."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.parts: dict[int, list[tuple]] = {}
        self.fresh = self.held = 0

    def group(self, lang: str, source: str) -> int:
        return self.groups.setdefault((lang, source), len(self.groups))

    def add(self, data: np.ndarray, at: np.ndarray, groups: np.ndarray) -> None:
        """Counts the terms of texts that begin at ``at``, one group number for each text."""
        starts, ends = _term_spans(data, at)
        docs = np.searchsorted(at, starts, side="right") - 1
        by_group = radix_order([groups[docs]])
        starts, lengths, docs = starts[by_group], (ends - starts)[by_group], docs[by_group]
        padded = np.concatenate([_LOWER[data], np.zeros(16, np.uint8)])
        # 8 and 16 stand for one and two words, other classes are powers of two that hold the longer terms
        classes = np.maximum(8, 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))
        for width in np.unique(classes).tolist():
            rows = np.flatnonzero(classes == width)
            low, n, doc = starts[rows], lengths[rows], docs[rows]
            if width <= 16:
                keys = [_words(padded, low, n)]
                if width == 16:
                    keys.append(_words(padded, low + 8, n - 8))
            else:
                box = np.zeros((len(rows), width), np.uint8)
                lanes = np.arange(width)
                box[lanes < n[:, None]] = padded[np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
                keys = [box.view(f"S{width}").ravel()]
            group = groups[doc]
            order = _order(keys)
            keys, group, doc = [k[order] for k in keys], group[order], doc[order]
            first = _runs(*keys, group)
            new_doc = np.zeros(len(doc), np.int64)
            new_doc[_runs(*keys, group, doc)] = 1
            self._put(width, ([k[first] for k in keys], group[first], np.diff(np.append(first, len(doc))),
                              np.add.reduceat(new_doc, first)))
        if self.fresh > PENDING // 2:
            self._merge()

    def _put(self, width: int, part: tuple) -> None:
        self.parts.setdefault(width, []).append(part)
        self.fresh += len(part[1]) * max(1, width // (PENDING_BYTES // PENDING))

    def _merge(self) -> None:
        self.held = self.fresh = 0
        for width, parts in self.parts.items():
            keys = [np.concatenate(x) for x in zip(*(p[0] for p in parts), strict=True)]
            group, n, d = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
            order = radix_order([group])
            order = order[_order([k[order] for k in keys])]
            keys, group = [k[order] for k in keys], group[order]
            first = _runs(*keys, group)
            self.parts[width] = [([k[first] for k in keys], group[first], np.add.reduceat(n[order], first),
                                  np.add.reduceat(d[order], first))]
            self.held += len(first) * max(1, width // (PENDING_BYTES // PENDING))

    def full(self) -> bool:
        return self.held > PENDING // 2

    def flush(self) -> Iterator[pa.RecordBatch]:
        """The sums so far, and one row without a term for each group met, then nothing is held."""
        self._merge()
        names = list(self.groups)
        langs, sources = (pa.array([n[k] for n in names], pa.string()) for k in (0, 1))
        if names:
            zero = pa.array([0] * len(names), pa.int64())
            yield pa.RecordBatch.from_arrays([langs, sources, pa.nulls(len(names), pa.string()), zero, zero], _COLUMNS)
        for width, parts in self.parts.items():
            for keys, group, n, d in parts:
                for low in range(0, len(group), 50_000):
                    cut = slice(low, low + 50_000)
                    which = pa.array(group[cut].astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [langs.take(which), sources.take(which), _strings([k[cut] for k in keys], width),
                         pa.array(n[cut]), pa.array(d[cut])], _COLUMNS)
        self.__init__()


_COLUMNS = ["lang", "source", "term", "n", "n_docs"]


def _order(keys: list[np.ndarray]) -> np.ndarray:
    return np.argsort(keys[0], kind="stable") if keys[0].dtype.kind == "S" else radix_order(keys)


def _strings(keys: list[np.ndarray], width: int) -> pa.Array:
    if width <= 16:
        box = np.column_stack([k.astype(">u8").view(np.uint8).reshape(len(k), 8) for k in keys])
    else:
        box = keys[0].view(np.uint8).reshape(len(keys[0]), width)
    there = box != 0
    offsets = np.concatenate([[0], np.cumsum(there.sum(axis=1))]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(box), [None, pa.py_buffer(offsets), pa.py_buffer(box[there])])


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, n_docs``: occurrences and documents of each term in each group; term is null in one more
    row of each group. Null columns count as empty; columns besides text, lang and source are not read."""
    ship(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = TermCounts()
        for batch in batches:
            for low, high, data, at in slices(batch.column("text"), TERM_SLICE):
                pairs = zip(batch.column("lang")[low:high].to_pylist(), batch.column("source")[low:high].to_pylist(),
                            strict=True)
                counts.add(data, at, np.array([counts.group(*x) for x in pairs], np.uint32))
                if counts.full():
                    yield from counts.flush()
        yield from counts.flush()

    read = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    sums = docs.select(*read).mapInArrow(work, "lang string, source string, term string, n long, n_docs long")
    return sums.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10**9 * (count + 2) / (total + 2 * terms)), exact beyond 64 bits; null without terms."""
    wide = (count + 2).cast("decimal(38,0)") * F.lit(10 ** 9).cast("decimal(10,0)")
    return F.when(terms > 0, F.call_function("div", wide, (total + 2 * terms).cast("decimal(38,0)")) + 1)


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _tile(table: pa.Table) -> pa.Table:
    """Sums of f over the terms that a tile holds, for each pair of its sources, and the number of these terms."""
    lang, i, j = (table.column(c)[0].as_py() for c in ("lang", "i", "j"))
    names = table.column("source").combine_chunks().dictionary_encode()
    terms = table.column("term").combine_chunks().dictionary_encode()
    row, col = (np.asarray(x.indices.fill_null(-1)) for x in (names, terms))
    sources, seen = names.dictionary.to_pylist(), len(terms.dictionary)
    p, none, block = (np.asarray(table.column(c)) for c in ("p", "p_none", "block"))
    empty, side = np.zeros(len(sources), np.int64), np.zeros(len(sources), np.int64)
    empty[row], side[row] = none, block
    shares = np.repeat(empty[:, None], seen, axis=1)
    there = col >= 0
    shares[row[there], col[there]] = p[there]
    out: list[tuple[str, str, int]] = []
    for a in np.flatnonzero(side == i).tolist():
        others = np.flatnonzero(side == j)
        if i == j:
            others = others[others > a]
        q = shares[others]
        f = ((shares[a] - q) ** 2 // (shares[a] + q)).sum(axis=1)
        # a pair has one name in all tiles
        out += [(*sorted((sources[a], sources[b])), x) for b, x in zip(others.tolist(), f.tolist(), strict=True)]
    return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "source": pa.array([x[0] for x in out], pa.string()),
                     "other": pa.array([x[1] for x in out], pa.string()), "f": pa.array([x[2] for x in out], pa.int64()),
                     "seen": pa.array([seen] * len(out), pa.int64())})


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, source_block: int = SOURCE_BLOCK,
               term_block: int = TERM_BLOCK) -> DataFrame:
    """``lang, source, part, item, value, rank``: each source against the others of its language (part ``pair``) and its
    terms above the language's share (part ``term``, the ``top`` of them).

    A term is a run of characters that are neither ASCII signs nor ASCII controls, with A to Z lower-cased; a language
    keeps the terms in at least ``least_docs`` of its documents, repeated rows counted each. Null lang, source and text
    are empty strings, and a group of empty texts takes part; without kept terms all values are 0. No rows for an empty
    table, none of part ``pair`` for a language with one source. Ties go by item.
    """
    counts = written(term_counts(docs), "counts")
    of_lang = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("d"))
    kept = written(of_lang.where(F.col("d") >= least_docs).select("lang", "term", "lang_n"), "kept")
    cells = written(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "cells")
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    every = counts.where("term IS NULL").select("lang", "source")
    many = every.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("total", "terms", "lang_total")}
    groups = every.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").join(many, "lang").withColumns(zero)
    groups = groups.withColumn("p_none", _share(F.lit(0), F.col("total"), F.col("terms")))
    groups = written(groups.withColumn("block", F.expr(
        f"pmod(xxhash64(source), ceil(sources / {source_block}))").cast("int")), "groups")
    shares = cells.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("terms")))

    # terms that a source uses more than its language does
    by_source = Window.partitionBy("lang", "source")
    q = _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    over = shares.withColumn("q", q).where("p > q").withColumn("value", _distance(F.col("p"), F.col("q")))
    named = over.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value",
                        F.row_number().over(by_source.orderBy(F.desc("value"), "term")).alias("rank")).where(F.col("rank") <= top)

    # tiles: a block of sources meets each block of its language on each block of terms; every source is in all of its
    # tiles, with or without terms there
    blocks = f"ceil(sources / {source_block})"
    parts = f"ceil(terms / {term_block})"
    columns = ["lang", "source", "term", "p", "p_none", "block", "k", "sources"]
    with_terms = shares.withColumn("k", F.expr(f"cast(pmod(xxhash64(term), {parts}) AS int)")).select(columns)
    markers = groups.where("terms > 0").select(
        "*", F.lit(None).cast("string").alias("term"), F.col("p_none").alias("p"),
        F.explode(F.expr(f"sequence(0, cast({parts} AS int) - 1)")).alias("k")).select(columns)
    dealt = with_terms.unionByName(markers).withColumn("o", F.explode(F.expr(f"sequence(0, cast({blocks} AS int) - 1)")))
    dealt = dealt.withColumns({"i": F.least("block", "o"), "j": F.greatest("block", "o")}).drop("o", "sources")
    sums = (dealt.groupBy("lang", "i", "j", "k")
            .applyInArrow(_tile, "lang string, source string, other string, f long, seen long")
            .groupBy("lang", "source", "other").agg(F.sum("f").alias("f"), F.sum("seen").alias("seen")))
    sums = written(sums, "sums")
    both = sums.unionByName(sums.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "f", "seen"))
    mine = groups.select("lang", "source", "terms", "p_none")
    others = groups.select("lang", F.col("source").alias("other"), F.col("p_none").alias("q_none"))
    pairs = mine.join(others, "lang").where("source <> other").join(both, ["lang", "source", "other"], "left")
    unseen = F.coalesce(_distance(F.col("p_none"), F.col("q_none")) * (F.col("terms") - F.col("seen")), F.lit(0))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"),
                         (F.coalesce("f", F.lit(0)) + unseen).alias("value"))
    ranked = pairs.withColumn("rank", F.row_number().over(by_source.orderBy(F.desc("value"), "item")))
    return ranked.unionByName(named)
