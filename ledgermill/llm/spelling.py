"""Groups of spellings: words of the corpus that differ by one edit, each led to its most frequent neighbour.

The vocabulary is counted with DataFrame functions. Two words of which the shorter has s characters and that differ by one
edit agree in their first or in their last s // 2 characters, so only words with such a part in common meet. Inside a part
the sorted list is scanned once for all words that are looked up: rows of the banded edit matrix are kept for each
character of the current prefix, the next entry goes on from the prefix that it shares with the last one, a word leaves as
soon as the prefix is more than one edit away from it, and a range of the list that has lost all of them is skipped.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import documents, written

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOISE = 199        # of so many runs about one loses a character
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5          # how many times more frequent a form has to be
BLOCK = 4096       # words on one side of a task's scan


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: runs of letters after the noise of the contract, with enough characters and occurrences.

    A null text has no words, a null id reads as an empty one.
    """
    runs = documents(docs).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= least_length).withColumn("run", F.translate("run", UPPER, LOWER))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    word = F.expr(f"if(h % {NOISE} = 0, concat(substr(run, 1, cast(h % length(run) AS int)), "
                  "substr(run, cast(h % length(run) AS int) + 2)), run)")
    return (runs.withColumn("h", h).select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where((F.col("n") >= least_count) & (F.length("word") >= least_length)))


def _scan(code: np.ndarray, length: np.ndarray, depth: int, queries: np.ndarray, entries: np.ndarray,
          own: bool) -> Iterator[tuple[int, np.ndarray]]:
    """Entries of the sorted list and the queries one edit away from each. Rows of ``code`` have a zero in front and two
    behind; all agree in their first ``depth`` characters. ``own`` says that queries and entries are the same words.

    Band 0, 1, 2 of a row at depth d are the distances to the first d - 1, d and d + 1 characters of a query.
    """
    text = code[entries]
    differs = text[1:] != text[:-1]
    shared = np.concatenate([[depth], np.maximum(differs.argmax(axis=1) - 1, depth)]).tolist()
    one = np.ones(len(queries), np.int8)
    rows = {depth: (queries, one, one * 0, one)}
    skip = 1 << 30
    for place, entry in enumerate(entries.tolist()):
        at = shared[place]
        if at >= skip:
            continue
        skip, n = 1 << 30, int(length[entry])
        alive, a, b, c = rows[at]
        while at < n:
            at += 1
            differ = code[alive, at - 1:at + 2] != code[entry, at]
            a2 = np.minimum(a + differ[:, 0], b + 1)
            b2 = np.minimum(np.minimum(b + differ[:, 1], c + 1), a2 + 1)
            c2 = np.minimum(c + differ[:, 2], b2 + 1)
            stay = np.flatnonzero(np.minimum(np.minimum(a2, b2), c2) <= 1)
            if len(stay) < len(alive):
                alive, a, b, c = alive[stay], a2[stay], b2[stay], c2[stay]
            else:
                a, b, c = a2, b2, c2
            rows[at] = (alive, a, b, c)
            if len(alive) <= own:  # nobody is left, or only the entry itself, which then shares this prefix with none
                skip = (1 << 30) if own else at
                break
        else:
            offset = length[alive] - n + 1
            edits = np.where(offset == 0, a, np.where(offset == 1, b, np.where(offset == 2, c, 2)))
            found = alive[edits == 1]
            if len(found):
                yield entry, found


def near_in_group(words: list[bytes], n: list[int], block: list[int], short: int, backward: bool, p: int, q: int
                  ) -> dict[int, list]:
    """For words with a part in common, by place: number of near words, n and place of the best one.

    ``short`` is the length of the shorter word of the pairs sought; the other is as long, or longer by one. Pairs of two
    longer words belong to another group, and so do, of a backward group, pairs that agree in their first part.
    """
    size = short // 2
    length = np.array([len(w) for w in words])
    width = int(length.max())
    code = np.zeros((len(words), width + 3), np.uint8)
    for k, w in enumerate(words):
        code[k, 1:len(w) + 1] = np.frombuffer(w[::-1] if backward else w, np.uint8)
    order = np.array(sorted(range(len(words)), key=lambda k: words[k][::-1] if backward else words[k]))
    if p == q:
        queries = entries = order
    else:
        side = np.array(block)[order]
        queries, entries = order[side == p], order[side == q]
    best: dict[int, list] = {}

    def credit(word: int, other: int) -> None:
        mine = best.setdefault(word, [0, -1, -1])
        mine[0] += 1
        if n[other] > mine[1] or n[other] == mine[1] and words[other] < words[mine[2]]:
            mine[1:] = n[other], other

    if len(queries) and len(entries):
        for entry, found in _scan(code, length, size, queries, entries, p == q):
            for query in found.tolist():
                if len(words[entry]) > short and len(words[query]) > short:
                    continue
                if backward and words[entry][:size] == words[query][:size]:
                    continue
                credit(query, entry)
                if p != q:
                    credit(entry, query)
    return best


def near_words(words: DataFrame, block: int = BLOCK, shortest: int = 2) -> DataFrame:
    """``word, n_near, best_n, best``: for each word with near words their number and the most frequent one of them.

    Words have at least ``shortest`` characters, none above U+00FF.
    """
    roles = words.select("word", "n", F.explode(F.expr(f"""filter(transform(
        array(struct(length(word) AS short, false AS backward), struct(length(word) AS short, true AS backward),
              struct(length(word) - 1 AS short, false AS backward), struct(length(word) - 1 AS short, true AS backward)),
        r -> struct(r.short, r.backward, if(r.backward, right(word, r.short div 2), left(word, r.short div 2)) AS part)),
        r -> r.short >= {shortest})""")).alias("r")).select("word", "n", "r.*")
    key = ["short", "backward", "part"]
    sizes = roles.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    dealt = roles.join(sizes, key).withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    dealt = dealt.withColumn("block", F.expr("cast(pmod(xxhash64(word), blocks) AS int)"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = dealt.withColumns({"p": F.least("block", "other"), "q": F.greatest("block", "other")})
    tile = [*key, "p", "q"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []

        def close() -> Iterator[tuple]:
            if len(rows) > 1:
                short, backward, _, p, q = group
                names = [r[0] for r in rows]
                best = near_in_group([w.encode("latin-1") for w in names], [r[1] for r in rows], [r[2] for r in rows],
                                     short, backward, p, q)
                for k, (count, most, other) in best.items():
                    yield names[k], count, most, names[other]

        def out(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [(), (), (), ()]
            types = (pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                              ["word", "n_near", "best_n", "best"])

        for batch in batches:
            found: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in (*tile, "word", "n", "block")]
            for row in zip(*columns, strict=True):
                if row[:5] != group:
                    found += close()
                    group, rows = row[:5], []
                rows.append(row[5:])
            if found:
                yield out(found)
        last = list(close())
        if last:
            yield out(last)

    found = (dealt.select(*tile, "word", "n", "block").repartition(*tile).sortWithinPartitions(*tile)
             .mapInArrow(work, "word string, n_near long, best_n long, best string"))
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best"))).alias("m")
    ).select("word", "n_near", (-F.col("m.minus")).alias("best_n"), F.col("m.best").alias("best"))


def forms(docs: DataFrame, ratio: int = RATIO, block: int = BLOCK, least_length: int = LEAST_LENGTH,
          least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, form, root, n, n_near, form_n``, one row per word of the vocabulary; repeated documents count each time.

    A word's form is its most frequent near word, the smallest of equals, if it occurs at least ``ratio`` times as often;
    the root follows the forms to the last. No rows for a table without words.
    """
    words = written(vocabulary(docs, least_length, least_count), "vocabulary")
    near = words.join(near_words(words, block, least_length), "word", "left")
    has = F.col("best_n") >= ratio * F.col("n")
    near = written(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                               F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")), "near")
    led = near.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    # every step multiplies n, so a way is shorter than the digits of a long; each round doubles the steps taken
    while True:
        nexts = led.select(F.col("word").alias("root"), F.col("root").alias("further"))
        led = written(led.join(nexts, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if led.where("moved").isEmpty():
            break
    return near.join(led.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
