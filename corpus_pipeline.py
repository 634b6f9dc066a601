"""The corpus pipeline: toxic documents go, near copies go but for one, personal data is redacted, the rest is packed.

Each stage takes (spark, docs, sf_dir), works on all that the one before it kept, and returns documents with all their
columns; the last returns the pieces of documents with their places in training sequences.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import hyper_minhash, packing, personal_data, toxicity
from ledgermill.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar scores below the threshold."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id. Rows without id stay.

    Equal rows stay once. Different texts under one id are documents of their own, known by id and text, so that no text
    goes but for a copy that stays.
    """
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    several = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(digest).alias("one"), F.max(digest).alias("two")).where("one != two").select(F.col("doc_id").alias("many"))
    known = docs.join(several, docs["doc_id"] == several["many"], "left").withColumn(
        "many", F.when(F.col("many").isNull(), F.col("doc_id")).otherwise(F.xxhash64("doc_id", digest)))
    kept = hyper_minhash.near_duplicates(known.select(F.col("many").alias("doc_id"), "text")).where("kept")
    kept = kept.select(F.col("doc_id").alias("kept_id")).distinct()
    named = known.join(kept, known["many"] == kept["kept_id"], "left_semi").dropDuplicates(["many"]).drop("many")
    return named.unionByName(docs.where("doc_id IS NULL"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return personal_data.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and place."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("personal_data", redact), ("packing", pack)]

# the stages use models, tokenizers and reachability; tests hold them against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
