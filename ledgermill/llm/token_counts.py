"""Token counts from the exact histogram of encoded lengths.

Documents are encoded once and added up by length. Suffix sums over the histogram then answer totals, quantiles and
truncated totals for every context limit without touching a document again.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.byte_bpe import encoded, totals, vocabulary_path
from ledgermill.llm.common import documents, in_batches, written

GROUP = 1024  # neighbouring lengths whose sums are nested


def document_lengths(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: ``doc_id`` and ``length`` in tokens. A null or empty text has length 0."""
    path = path or vocabulary_path()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths = np.zeros(batch.num_rows, np.int64)
        for low, high, first, chunks, entries in encoded(batch.column("text"), path):
            lengths[low:high] = totals(chunks.counts(entries), first)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lengths)], ["doc_id", "length"])

    return documents(docs).mapInArrow(in_batches(work), "doc_id long, length long")


def length_histogram(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``length`` and ``n_docs``, one row per length that occurs; no rows for no documents.

    The histogram is written, so whatever is asked of it, each text is encoded once.
    """
    return written(document_lengths(docs, path).groupBy("length").agg(F.count(F.lit(1)).alias("n_docs")), "histogram")


def with_suffix_sums(histogram: DataFrame) -> DataFrame:
    """The histogram with what it answers for a context limit of each ``length`` that occurs.

    ``docs_over`` and ``tokens_over`` count the longer documents and their tokens, ``truncated_total`` the tokens left
    when every document is cut to the limit, ``share_within`` the part of the documents that fit (the quantile of this
    length), ``n_tokens`` the tokens of documents of this very length. Sums run inside groups of neighbouring lengths
    and over the groups' totals, so no task orders all lengths.
    """
    h = histogram.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens"),
                         F.floor(F.col("length") / GROUP).alias("part"))
    groups = h.groupBy("part").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
    after = Window.orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    groups = groups.select("part", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"),
                           F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"),
                           F.sum("d").over(every).alias("all_docs"), F.sum("t").over(every).alias("all_tokens"))
    inner = Window.partitionBy("part").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    docs_over = F.coalesce(F.sum("n_docs").over(inner), F.lit(0)) + F.col("d_after")
    tokens_over = F.coalesce(F.sum("n_tokens").over(inner), F.lit(0)) + F.col("t_after")
    return h.join(groups, "part").select(
        "length", "n_docs", "n_tokens", docs_over.alias("docs_over"), tokens_over.alias("tokens_over"),
        "all_docs", "all_tokens").withColumns({
            "truncated_total": F.col("all_tokens") - F.col("tokens_over") + F.col("length") * F.col("docs_over"),
            "share_within": (F.col("all_docs") - F.col("docs_over")) / F.col("all_docs")})


def truncated_total(sums: DataFrame, limit: int) -> DataFrame:
    """Tokens left when documents are cut to any ``limit``, also one that no document has: one row."""
    longer = F.col("length") > limit
    return sums.agg(F.coalesce(F.sum(F.when(longer, F.col("n_docs") * limit).otherwise(F.col("n_tokens"))),
                               F.lit(0)).alias("truncated_total"))


def quantile(sums: DataFrame, q: float) -> DataFrame:
    """The least length that at least a share ``q`` of the documents does not exceed; null without documents."""
    return sums.where(F.col("share_within") >= q).agg(F.min("length").alias("length"))
