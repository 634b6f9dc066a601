"""Near-duplicates by HyperMinHash: registers, bands over them, corrected estimates, and an exact check.

A document's distinct word shingles are hashed once. The upper half of a hash picks a bucket; of each bucket's smallest
second hash only the number of leading zeros and some mantissa bits are kept, 16 bits in all. Empty buckets borrow from
full ones in an order fixed by the bucket, so short documents agree as often as long ones. Bands of registers propose
pairs, the registers estimate their Jaccard similarity with chance agreements taken off, and what may reach the
threshold is decided on the full sets.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import documents, in_batches, mix, ship, written
from ledgermill.llm.components import components
from ledgermill.llm.spans import slices, span_hashes, word_spans

BANDS = 48
ROWS = 5           # registers of a band; at similarity 0.8 all 48 bands miss with a chance of 5e-9
MANTISSA = 10      # bits kept below the leading one
WORDS = 5
SIMILARITY = (4, 5)
DEVIATIONS = 6.0   # standard errors of the estimate below the threshold at which a pair is given up
TILE = 2048        # rows of a bucket that one side of a task holds
LOAD = 1 << 20     # shingles of a bucket that one side of a task holds
SET_BYTES = 1 << 25
PARTNERS = 64      # texts checked against one center in one task
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _donors(registers: int) -> np.ndarray:
    """For each bucket, the order in which the others are asked when it is empty."""
    ranks = np.arange(registers * registers, dtype=np.uint64).reshape(registers, registers)
    return np.argsort(mix(ranks + np.uint64(77)), axis=1)


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Per text its sorted distinct shingle hashes; a text with fewer words is one shingle, one without words none."""
    for low, high, data, at in slices(column):
        starts, ends, first = word_spans(data, at)
        tokens = span_hashes(data, starts, ends, lower=True)
        grams = np.zeros(max(0, len(tokens) - words + 1), np.uint64)
        for k in range(words):
            grams = mix(grams * _SPREAD + tokens[k:k + len(grams)] + np.uint64(k + 1))
        for row in range(high - low):
            a, b = int(first[row]), int(first[row + 1])
            if b - a >= words:
                yield np.unique(grams[a:b - words + 1])
            elif b > a:
                short = np.zeros(1, np.uint64)
                for k in range(b - a):
                    short = mix(short * _SPREAD + tokens[a + k:a + k + 1] + np.uint64(k + 1))
                yield short ^ np.uint64(b - a)
            else:
                yield np.empty(0, np.uint64)


def registers_of(shingles: np.ndarray, donors: np.ndarray) -> np.ndarray:
    """16-bit registers of a non-empty sorted set: leading zeros above, mantissa bits below."""
    count = len(donors)
    bucket = ((shingles >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    least = np.minimum.reduceat(mix(shingles ^ _SPREAD) >> np.uint64(11), first)  # 53 bits: exact as doubles
    part, power = np.frexp(least.astype(np.float64))
    packed = ((53 - power) << MANTISSA) + ((2 * part - 1).clip(0) * (1 << MANTISSA)).astype(np.int64)
    full = np.zeros(count, bool)
    out = np.zeros(count, np.uint16)
    full[bucket[first]] = True
    out[bucket[first]] = packed
    if len(first) < count:
        empty = np.flatnonzero(~full)
        asked = donors[empty]
        out[empty] = out[asked[np.arange(len(empty)), np.argmax(full[asked], axis=1)]]
    return out


def sketches(docs: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, code, registers``: per document its set's size and digest, and its registers.

    The columns after ``n_shingles`` are null for an empty set.
    """
    donors = _donors(bands * rows)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, codes, kept = [], [], []
        for shingles in shingle_sets(batch.column("text"), words):
            sizes.append(len(shingles))
            if not len(shingles):
                codes.append(None)
                kept.append(None)
                continue
            codes.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
            kept.append(registers_of(shingles, donors).astype("<u2").tobytes())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(codes, pa.binary()),
             pa.array(kept, pa.binary())], ["doc_id", "n_shingles", "code", "registers"])

    return documents(docs).mapInArrow(in_batches(work), "doc_id long, n_shingles long, code binary, registers binary")


def band_slots(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """``doc_id, nth, band``: a row per document and band, ``band`` being the hash of its registers.

    Hashes are made from the registers wherever they are needed; they are as long and as random, so storing or
    shuffling both would cost almost double.
    """
    salt = mix(np.arange(bands, dtype=np.uint64) + np.uint64(1 << 20))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        registers = np.frombuffer(b"".join(batch.column("registers").to_pylist()), "<u2").reshape(-1, bands, rows)
        keys = np.tile(salt, (batch.num_rows, 1))
        for k in range(rows):
            keys = mix(keys * _SPREAD + registers[:, :, k].astype(np.uint64) + np.uint64(1))
        ends = pa.array(np.arange(0, keys.size + 1, bands), pa.int32())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.ListArray.from_arrays(ends, pa.array(keys.ravel().view(np.int64)))],
            ["doc_id", "keys"])

    made = classes.select("doc_id", "registers").mapInArrow(in_batches(work), "doc_id long, keys array<long>")
    return made.select("doc_id", F.posexplode("keys").alias("nth", "band"))


def similarity(one: np.ndarray, two: np.ndarray, n_one: np.ndarray, n_two: np.ndarray) -> np.ndarray:
    """Jaccard estimates from rows of registers, chance agreements taken off.

    Two unrelated registers agree when the minima of sets of such sizes share leading zeros and mantissa bits, at a
    rate near 2**-mantissa/3 times a factor of the sizes' ratio that is 1 at most.
    """
    agree = (one == two).mean(axis=-1)
    ratio = np.minimum(n_one, n_two) / np.maximum(n_one, n_two)
    chance = ratio * 2.0 ** -MANTISSA * 2 / 3
    return np.clip((agree - chance) / (1 - chance), 0, 1)


def _may_link(one: np.ndarray, two: np.ndarray, n_one: np.ndarray, n_two: np.ndarray,
              part: tuple[int, int]) -> np.ndarray:
    """Pairs that sizes and registers do not rule out."""
    share = part[0] / part[1]
    error = np.sqrt(share * (1 - share) / one.shape[-1])
    # short sets fill few buckets, so their registers repeat each other and tell less
    error = error * np.sqrt(1 + one.shape[-1] / np.minimum(n_one, n_two))
    return ((np.minimum(n_one, n_two) * part[1] >= np.maximum(n_one, n_two) * part[0])
            & (similarity(one, two, n_one, n_two) >= share - DEVIATIONS * error))


def _estimated(pairs: DataFrame, side: DataFrame, part: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) that may link; ``side`` has ``doc_id, n_shingles, registers``."""
    both = pairs.join(side.toDF("a", "na", "ra"), "a").join(side.toDF("b", "nb", "rb"), "b")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1)
                for c in ("ra", "rb")]
        sizes = [batch.column(c).to_numpy() for c in ("na", "nb")]
        keep = pa.array(_may_link(*rows, *sizes, part))
        return pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])

    return both.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(in_batches(work), "a long, b long")


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id, text``, one row for each of ``ids``.

    The ids are written first, so that the plan is made on their true size: where Spark's limit lets it broadcast them,
    no text of another document is shuffled.
    """
    return documents(docs).join(written(ids.distinct(), "ids"), "doc_id", "left_semi").dropDuplicates(["doc_id"])


def confirmed(pairs: DataFrame, docs: DataFrame, words: int, part: tuple[int, int] = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity, by their texts, one per id.

    Partners of one text are dealt into groups of bounded size, each with its own copy of that text, so a text with
    very many partners is compared in many tasks and no group grows with the input.
    """
    counts = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    dealt = pairs.join(counts, "a").withColumn(
        "deal", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / PARTNERS))).drop("n")
    dealt = written(dealt, "dealt")
    centers = dealt.select("a", "deal").distinct().select("a", "deal", F.col("a").alias("doc_id"), F.lit(0).alias("kind"))
    partners = dealt.select("a", "deal", F.col("b").alias("doc_id"), F.lit(1).alias("kind"))
    members = centers.unionByName(partners)
    wanted = members.join(_texts_of(docs, members.select("doc_id")), "doc_id").select(
        "a", "deal", "doc_id", "kind", "text")

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("kind")
        ids, kinds = table.column("doc_id").to_pylist(), table.column("kind").to_pylist()
        center, found = None, []
        for i in range(table.num_rows):
            own = next(shingle_sets(table.column("text").slice(i, 1).combine_chunks(), words))
            if not kinds[i]:
                center = own
            else:
                common = len(np.intersect1d(center, own, assume_unique=True))
                if common * part[1] >= (len(center) + len(own) - common) * part[0]:
                    found.append(ids[i])
        return pa.table({"a": pa.array([table.column("a")[0].as_py()] * len(found), pa.int64()),
                         "b": pa.array(found, pa.int64())})

    return wanted.groupBy("a", "deal").applyInArrow(work, "a long, b long")


def full_sets(texts: DataFrame, words: int) -> DataFrame:
    """``doc_id, shingles``: the sorted shingle hashes of each text, 8 bytes each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, held, size = 0, [], 0
            for row, shingles in enumerate(shingle_sets(batch.column("text"), words), 1):
                held.append(shingles.astype("<u8").tobytes())
                size += len(held[-1])
                if size > SET_BYTES or row == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(first, len(held)), pa.array(held, pa.binary())],
                        ["doc_id", "shingles"])
                    first, held, size = row, [], 0

    return texts.mapInArrow(run, "doc_id long, shingles binary")


def _candidates(table: pa.Table, part: tuple[int, int], rows: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of a task of two tiles: a row, and the rows of other components that may link with it.

    A pair that shares several bands comes up in the first one alone.
    """
    ids, comp, t, n = (table.column(c).to_numpy() for c in ("doc_id", "component", "t", "n_shingles"))
    regs = np.frombuffer(b"".join(table.column("registers").to_pylist()), "<u2").reshape(len(ids), -1)
    nth, p, q = (table.column(c)[0].as_py() for c in ("nth", "p", "q"))
    other = np.flatnonzero(t == q)
    for i in np.flatnonzero(t == p).tolist():
        rest = other[(comp[other] != comp[i]) & ((ids[other] > ids[i]) | (p != q))]
        if len(rest):
            ok = rest[_may_link(regs[None, i], regs[rest], n[i], n[rest], part)]
            bands = (regs[None, i] == regs[ok]).reshape(len(ok), regs.shape[1] // rows, rows).all(axis=2)
            ok = ok[bands.argmax(axis=1) == nth]
            if len(ok):
                yield i, ok


def _linked(table: pa.Table, part: tuple[int, int], rows: int) -> pa.Table:
    """The links (a, b) that join components of a task of two tiles, decided on the full sets."""
    ids, comp = table.column("doc_id").to_numpy(), table.column("component").to_numpy().copy()
    sets = [np.frombuffer(x, "<u8") for x in table.column("shingles").to_pylist()]
    met, places = np.unique(np.concatenate(sets), return_inverse=True)
    places = np.split(places, np.cumsum([len(x) for x in sets])[:-1])
    mine, a, b = np.zeros(len(met), bool), [], []
    for i, ok in _candidates(table, part, rows):
        mine[places[i]] = True
        for j in ok.tolist():
            if comp[i] == comp[j]:
                continue
            common = np.count_nonzero(mine[places[j]])
            if common * part[1] >= (len(sets[i]) + len(sets[j]) - common) * part[0]:
                a.append(ids[i])
                b.append(ids[j])
                comp[comp == comp[j]] = comp[i]
        mine[places[i]] = False
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _across(bucketed: DataFrame, side: DataFrame, docs: DataFrame, words: int, part: tuple[int, int], tile: int,
            load: int, rows: int) -> DataFrame:
    """Links (a, b) between documents that share a bucket and are in different components so far.

    ``bucketed`` has ``nth, band, doc_id, component`` of buckets with several components. A bucket is cut into tiles
    by rows and by shingles, and each pair of tiles is a task of bounded size. The registers tell which
    documents of a task have a partner at all; those alone come back with their full sets, and the pairs are decided
    where they meet. So no pair leaves a task unless it joins two components there.
    """
    sizes = bucketed.join(side.select("doc_id", "n_shingles"), "doc_id").groupBy("band").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / tile, F.sum("n_shingles") / load)).alias("tiles"))
    tiled = bucketed.join(sizes, "band").withColumn("t", F.pmod(F.xxhash64("doc_id"), F.col("tiles")))
    met = tiled.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))).select(
        "nth", "band", F.least("t", "o").alias("p"), F.greatest("t", "o").alias("q"), "t", "doc_id", "component")

    def needed(table: pa.Table) -> pa.Table:
        wanted = np.zeros(table.num_rows, bool)
        for i, ok in _candidates(table, part, rows):
            wanted[i] = wanted[ok] = True
        return table.select(["nth", "band", "p", "q", "t", "doc_id", "component"]).filter(pa.array(wanted))

    chosen = written(met.join(side, "doc_id").groupBy("band", "p", "q").applyInArrow(
        needed, "nth int, band long, p long, q long, t long, doc_id long, component long"), "chosen")
    whole = side.join(full_sets(_texts_of(docs, chosen.select("doc_id")), words), "doc_id")
    return chosen.join(whole, "doc_id").groupBy("band", "p", "q").applyInArrow(
        lambda table: _linked(table, part, rows), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = WORDS, part: tuple[int, int] = SIMILARITY, bands: int = BANDS,
                    rows: int = ROWS, tile: int = TILE, load: int = LOAD) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per input row, as :func:`_by_id` finds them.

    Where rows share an id and have different texts, each of the texts is a document of its own while copies are
    searched, known by a hash of id and text. What they are linked with is then one component, named by the smallest
    id in it. Each row shows the number of shingles of its own text.
    """
    digest = F.xxhash64("text")
    many = written(documents(docs).where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(digest).alias("low"), F.max(digest).alias("high")).where("low != high").select("doc_id"), "repeated")
    if many.isEmpty():
        return _by_id(docs, words, part, bands, rows, tile, load)
    marked = documents(docs).join(many.withColumn("many", F.lit(True)), "doc_id", "left")
    node = F.when(F.col("many"), F.xxhash64("doc_id", digest)).otherwise(F.col("doc_id"))
    found = written(_by_id(marked.select(node.alias("doc_id"), "text"), words, part, bands, rows, tile, load), "nodes")
    own = written(marked.where("many").select(node.alias("node"), F.col("doc_id").alias("own")).distinct(), "own")
    named = found.join(own, found["doc_id"] == own["node"], "left").select(
        F.coalesce("own", "doc_id").alias("doc_id"), "n_shingles", F.col("component_id").alias("part"), "own")
    # components that an id has texts in are one
    hubs = named.where("own IS NOT NULL").groupBy("own").agg(F.min("part").alias("hub"))
    across = named.where("own IS NOT NULL").join(hubs, "own").where("part != hub").select(
        F.col("hub").alias("a"), F.col("part").alias("b")).distinct()
    roots = components(written(across, "across")).toDF("part", "root")
    placed = written(named.join(roots, "part", "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "part").alias("part")), "placed")
    least = placed.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    return (placed.where("part IS NOT NULL").join(least, "part").select("doc_id", "n_shingles", "component_id")
            .unionByName(placed.where("part IS NULL").select("doc_id", "n_shingles", F.col("part").alias("component_id")))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))


def _by_id(docs: DataFrame, words: int, part: tuple[int, int], bands: int, rows: int, tile: int, load: int) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per input row; rows that share an id have one text.

    Documents link when part[1] times the common shingles reach part[0] times all of theirs. Documents with equal sets
    are one class and linked; classes meet in bands. First every class is checked against the least id of each of its
    buckets, which joins groups of copies in linear work. What is still apart in a bucket is compared with all other
    components in it, in tiles, whatever the bucket's size. A null or empty text has an empty set and no links; rows
    without id have none either.
    """
    ship(docs.sparkSession)
    made = written(sketches(docs, words, bands, rows), "sketches")
    full = made.where("code IS NOT NULL AND doc_id IS NOT NULL")
    classes = written(full.groupBy("code").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"),
        F.first("registers").alias("registers")), "classes")
    slots = band_slots(classes, bands, rows)
    least = slots.groupBy("band").agg(F.min("doc_id").alias("center"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(slots.join(least.drop("n"), "band"), "shared")
    met = written(shared.select("doc_id").distinct(), "met")  # all that follows needs only what shares a bucket
    side = written(classes.select("doc_id", "n_shingles", "registers").join(met, "doc_id", "left_semi"), "side")
    stars = shared.where("doc_id != center").select(F.col("center").alias("a"), F.col("doc_id").alias("b")).distinct()
    links = written(confirmed(_estimated(stars, side, part), docs, words, part), "links")
    groups = components(links)
    placed = shared.join(groups.toDF("doc_id", "root"), "doc_id", "left").select(
        "nth", "band", "doc_id", F.coalesce("root", "doc_id").alias("component"))
    mixed = placed.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y")
    still_open = written(placed.join(mixed.select("band"), "band"), "open")
    late = written(_across(still_open, side, docs, words, part, tile, load, rows), "late")
    links = links.unionByName(late)
    twins = full.join(classes.select("code", F.col("doc_id").alias("head")), "code")
    roots = components(links)
    headed = made.join(twins.groupBy("doc_id").agg(F.min("head").alias("head")), "doc_id", "left")
    return (headed.join(roots.toDF("head", "root"), "head", "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "head", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))
