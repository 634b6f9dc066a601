"""Aggregates of a quality report."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

COUNTED = ("error", "warn")  # severities of the failures that count against a company


def category_share(summary: DataFrame) -> DataFrame:
    """Failures per category and their share. The summary has one row per rule, so the window is tiny."""
    per_category = summary.groupBy("category").agg(F.sum("failed").alias("failed"),
                                                   F.sum("evaluated").alias("evaluated"))
    total = F.sum("failed").over(Window.partitionBy(F.lit(1)))
    return per_category.withColumn(
        "share_of_failures", F.coalesce(F.try_divide(F.col("failed"), total), F.lit(0.0)))


def top_failing_companies(failures: DataFrame, companies: DataFrame, n: int = 10) -> DataFrame:
    """Companies with the most errors and warnings. Two aggregation steps keep the distinct count mergeable."""
    per_rule = (failures.where(F.col("severity").isin(*COUNTED) & F.col("cik").isNotNull())
                .groupBy("cik", "rule_id").agg(F.count(F.lit(1)).alias("k")))
    per_company = per_rule.groupBy("cik").agg(F.sum("k").alias("failures"), F.count(F.lit(1)).alias("rules_hit"))
    return (per_company.join(companies.select("cik", "name"), "cik")
            .select("cik", "name", "failures", "rules_hit")
            .orderBy(F.desc("failures"), "cik").limit(n))


def restatement_stats(restated: DataFrame) -> DataFrame:
    """Groups, rows and companies. A differing fact has exactly one authoritative row, so groups are counted
    without a distinct."""
    one = F.col("is_authoritative")
    kind = F.col("classification")
    return restated.agg(
        F.count_if(one & (kind == "restatement")).alias("restatement_groups"),
        F.count_if(one & (kind == "rounding_diff")).alias("rounding_groups"),
        F.count(F.lit(1)).alias("version_rows"),
        F.count_distinct(F.when(kind == "restatement", F.col("cik"))).alias("companies_with_restatements"))


def overall(summary: DataFrame) -> DataFrame:
    evaluated, failed = F.sum("evaluated"), F.sum("failed")
    return summary.agg(
        F.count(F.lit(1)).alias("rules_implemented"), evaluated.alias("total_evaluated"),
        failed.alias("total_failed"), (1 - F.try_divide(failed, evaluated)).alias("overall_pass_rate"),
        F.sum(F.when(F.col("rule_name") == "outlier_robust_z", F.col("failed"))).alias("outliers_flagged"))
