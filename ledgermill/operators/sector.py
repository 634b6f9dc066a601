"""Companies within their sector."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.picking import latest_where
from ledgermill.functions.ranking import exact_quantiles, value_ranks


def annual_values(ratios: DataFrame, companies: DataFrame) -> DataFrame:
    return (ratios.where("basis = 'FY' AND value IS NOT NULL")
            .select("cik", "ratio", "fiscal_year", "period_end", "value", "source_adshs")
            .join(companies.select("cik", "sector"), "cik"))


def latest_annual(ratios: DataFrame, companies: DataFrame) -> DataFrame:
    """The latest annual value per company and ratio."""
    return (annual_values(ratios, companies).groupBy("cik", "sector", "ratio")
            .agg(latest_where(F.lit(True), ["period_end"], "fiscal_year", "period_end", "value", "source_adshs")
                 .alias("last"))
            .select("cik", "sector", "ratio", F.lit("FY").alias("basis"), "last.*"))


def ranked_in_sector(latest: DataFrame) -> DataFrame:
    """The latest values, which are read twice, with the share of the sector that is strictly lower.

    A sector has no size limit, so ranks come from :func:`value_ranks` rather than one window per sector.
    """
    ranks = value_ranks(latest, ["sector", "ratio"], "value")
    return (latest.join(ranks, ["sector", "ratio", "value"])
            .select("cik", "sector", "ratio", "basis", "fiscal_year", "period_end", "value", "source_adshs",
                    F.col("n_group").alias("n_companies"), F.col("n_below").alias("n_lower"),
                    (F.col("n_below") / F.col("n_group")).alias("pct_rank")))


def sector_ratio_yearly(ratios: DataFrame, companies: DataFrame) -> DataFrame:
    """Median annual value per sector, ratio and fiscal year."""
    keys = ["sector", "ratio", "fiscal_year"]
    annual = annual_values(ratios, companies)
    medians = exact_quantiles(annual, keys, "value", {"median_value": 0.5})
    members = annual.groupBy(*keys).agg(F.count_distinct("cik").alias("n_companies"))
    return medians.join(members, keys).select(*keys, "median_value", F.col("n_group").alias("n_rows"), "n_companies")


SPREAD = {"p10": 0.10, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90}


def sector_quantiles(latest: DataFrame) -> DataFrame:
    """The spread of the latest values per sector and ratio."""
    return (exact_quantiles(latest, ["sector", "ratio"], "value", SPREAD)
            .withColumnRenamed("n_group", "n_companies"))


def sector_histogram(latest: DataFrame, bins: int = 40) -> DataFrame:
    """Counts per bin between the 5th and 95th percentile; tails fall into the edge bins.

    The bounds are one row per sector and ratio, both bounded by configuration, and are broadcast. A value within a
    rounding error of an edge lies on it.
    """
    bounds = exact_quantiles(latest, ["sector", "ratio"], "value", {"low": 0.05, "high": 0.95})
    clipped = F.least(F.greatest(F.col("value"), F.col("low")), F.col("high"))
    step = (F.col("high") - F.col("low")) / bins
    position = F.when(step > 0, F.least(F.floor(F.round(F.try_divide(clipped - F.col("low"), step), 9)),
                                        F.lit(bins - 1)))
    return (latest.select("sector", "ratio", "value")
            .join(F.broadcast(bounds.drop("n_group")), ["sector", "ratio"])
            .withColumn("bin", F.coalesce(position, F.lit(0)).cast("int"))
            .groupBy("sector", "ratio", "bin")
            .agg(F.count(F.lit(1)).alias("n"), F.max("low").alias("low"), F.max("high").alias("high")))
