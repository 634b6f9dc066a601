"""The operators applied to the given tables with production parameters, and SQL where it can say the same."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgermill.llm import (
    divergence,
    grid_join,
    hyper_minhash,
    kneser_ney,
    packing,
    personal_data,
    pieces,
    quality,
    sharding,
    spelling,
    token_counts,
    topk,
    toxicity,
)
from ledgermill.llm.common import table


def op1_grid_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


def op3_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.with_suffix_sums(token_counts.length_histogram(table(spark, sf_dir, "documents")))


def op4_clause_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_distinct_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"))


def op6_boosted_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.found(table(spark, sf_dir, "documents"))


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.scored(table(spark, sf_dir, "documents"))


def op8_hyper_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyper_minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op9_large_item_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_term_at_a_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.whole_numbers(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op12_regularised_leader(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_sorted_list_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.forms(table(spark, sf_dir, "documents"))


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("op") and "_" in name}

# op2 and op13 need crc32, which DuckDB lacks; op3, op5 and op9 need tokenizers, op4, op6, op7 and op12 models, op6 and op8
# hashes and patterns without a counterpart; op1 and op8 need reachability. Tests hold all of these against brute force.
ORACLES = {
    "op10_term_at_a_time": """
        WITH v AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
                   FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
                   AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id,
                     CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
              FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op11_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
                   FROM documents),
        o AS (SELECT doc, lang, source,
                     unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
        kept AS (SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
        cells AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM o JOIN kept USING (lang, term) GROUP BY ALL),
        g AS (SELECT d.lang, d.source, coalesce(max(t.total), 0) AS total, coalesce(max(v.v), 0) AS v,
                     coalesce(max(v.lang_total), 0) AS lang_total
              FROM d LEFT JOIN (SELECT lang, source, sum(n) AS total FROM cells GROUP BY ALL) t USING (lang, source)
              LEFT JOIN (SELECT lang, count(*) AS v, sum(n) AS lang_total FROM kept GROUP BY lang) v ON v.lang = d.lang
              GROUP BY d.lang, d.source),
        shares AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                     CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * g.v)::HUGEINT AS BIGINT) AS p,
                     CAST(1 + (1000000000::HUGEINT * (k.n + 2)) // (g.lang_total + 2 * g.v)::HUGEINT AS BIGINT) AS q
              FROM g JOIN kept k ON k.lang = g.lang
              LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        pairs AS (SELECT a.lang, a.source, b.source AS item,
                         sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
                  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
                  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
                  UNION ALL
                  SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT)
                  FROM shares WHERE n > 0 AND p > q),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part
                                                     ORDER BY value DESC, item) AS INTEGER) AS rank FROM every)
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10""",
}
