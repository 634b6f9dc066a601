"""Restated values: the same fact reported differently by several filings."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.functions.numbers import relative_difference
from ledgermill.functions.text import is_amended
from ledgermill.operators.facts import CONSOLIDATED_STANDARD

FACT_KEY = ["cik", "tag", "period_end", "qtrs", "uom"]


def comparable(facts: DataFrame) -> DataFrame:
    """Facts that several filings may report: consolidated, from a standard taxonomy, not cover-page data."""
    return facts.where(f"{CONSOLIDATED_STANDARD} AND taxonomy <> 'dei'")


def repeated_facts(facts: DataFrame) -> DataFrame:
    """The facts that occur in several filings or with several values: extremes of both, one row per fact.

    For reports; restatements and the rule on them start from the versions themselves.
    """
    return (comparable(facts).groupBy(*FACT_KEY)
            .agg(F.min("value").alias("low"), F.max("value").alias("high"),
                 F.min("adsh").alias("first_adsh"), F.max("adsh").alias("last_adsh"))
            .where("low <> high OR first_adsh <> last_adsh"))


def disputed_versions(facts: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """The versions of the facts whose versions differ, every one of them or none. :func:`repeated_facts`, if given, leave
    the facts out beforehand that have one value."""
    if repeated is not None:
        facts = facts.join(repeated.where("low <> high").select(*FACT_KEY), FACT_KEY, "left_semi")
    fact = Window.partitionBy(*FACT_KEY)
    return (fact_versions(facts).withColumns({"_low": F.min("value").over(fact), "_high": F.max("value").over(fact)})
            .where("_low <> _high").drop("_low", "_high"))


def fact_versions(facts: DataFrame) -> DataFrame:
    """One version per fact and filing, the latest taxonomy version. The versions of a fact lie together, in the order of
    its key, so that windows over facts need neither an exchange nor a sort of their own."""
    columns = [*FACT_KEY, "adsh", "form", "filed", "value", "is_current_period", "version"]
    latest = Window.partitionBy(*FACT_KEY, "adsh").orderBy(F.col("version").desc_nulls_last(), F.col("value").desc())
    return (comparable(facts).select(*columns).repartition(*FACT_KEY)
            .withColumn("_rank", F.row_number().over(latest)).where("_rank = 1").drop("_rank"))


def compared_versions(versions: DataFrame) -> DataFrame:
    """Versions with the number of versions of their fact, the authoritative one and their differences from it, which are
    NULL for a fact whose versions agree or which has a NULL in its key: such a fact is not compared.

    All are windows over the versions of one fact, at most one per filing of a company; longer ones go to disk.
    """
    # the winner of a fact: latest filed, then amended, then highest accession number
    order = F.struct(F.col("filed"), is_amended(F.col("form")).alias("amended"), F.col("adsh"),
                     F.col("value"), F.col("form"))
    fact = Window.partitionBy(*FACT_KEY)
    known = " AND ".join(f"{k} IS NOT NULL" for k in FACT_KEY)
    winner = F.when(F.col("differs"), F.col("_winner"))
    return (versions
            .withColumns({"n_versions": F.count(F.lit(1)).over(fact), "_low": F.min("value").over(fact),
                          "_high": F.max("value").over(fact), "_winner": F.max(order).over(fact)})
            .withColumn("differs", F.expr(f"coalesce(n_versions > 1 AND _low <> _high AND {known}, false)"))
            .withColumns({
                "is_authoritative": F.col("adsh") == winner["adsh"],
                "authoritative_value": winner["value"],
                "authoritative_adsh": winner["adsh"],
                "authoritative_form": winner["form"],
                "authoritative_filed": winner["filed"],
            })
            .withColumns({
                "delta": F.col("value") - F.col("authoritative_value"),
                "rel_diff": relative_difference(F.col("value"), F.col("authoritative_value")),
            })
            .withColumn("group_max_rel_diff", F.max("rel_diff").over(fact))
            .drop("_low", "_high", "_winner"))


def with_verdicts(facts: DataFrame, restatement_rel: float) -> DataFrame:
    """Facts that lie together by a part of their key, all of them kept, each with the ``classification`` that
    :func:`restatements` gives its key: NULL where versions agree, are single or cannot be compared."""
    latest = Window.partitionBy("_fact", *FACT_KEY, "adsh").orderBy(
        F.col("_comparable").desc(), F.col("version").desc_nulls_last(), F.col("value").desc())
    fact = Window.partitionBy("_fact", *FACT_KEY)  # a hash decides most comparisons
    version = F.col("_rank") == 1
    order = F.struct(F.col("filed"), is_amended(F.col("form")).alias("amended"), F.col("adsh"), F.col("value"),
                     F.col("form"))
    known = " AND ".join(f"{k} IS NOT NULL" for k in FACT_KEY)
    differs = F.expr(f"_low <> _high AND {known}")
    return (facts.withColumns({"_fact": F.xxhash64(*FACT_KEY),
                               "_comparable": F.coalesce(F.col("taxonomy") != "dei", F.lit(False))})
            .withColumn("_rank", F.when(F.col("_comparable"), F.row_number().over(latest)))
            .withColumns({"_low": F.min(F.when(version, F.col("value"))).over(fact),
                          "_high": F.max(F.when(version, F.col("value"))).over(fact),
                          "_winner": F.max(F.when(version, order)).over(fact)})
            .withColumn("_most", F.max(F.when(version & differs, relative_difference(
                F.col("value"), F.col("_winner.value")))).over(fact))
            .withColumn("classification", F.when(differs, F.when(
                F.col("_most") > restatement_rel, F.lit("restatement")).otherwise(F.lit("rounding_diff"))))
            .drop("_fact", "_comparable", "_rank", "_low", "_high", "_winner", "_most"))


def restatements(versions: DataFrame, restatement_rel: float) -> DataFrame:
    """All versions of the facts whose versions differ, from :func:`fact_versions` or :func:`disputed_versions`."""
    return (compared_versions(versions).where("differs")
            .select(*FACT_KEY, "adsh", "form", "filed", "value", "is_current_period", "version", "is_authoritative",
                    "authoritative_value", "authoritative_adsh", "authoritative_form", "authoritative_filed",
                    "n_versions", "delta", "rel_diff", "group_max_rel_diff",
                    F.when(F.col("group_max_rel_diff") > restatement_rel, F.lit("restatement"))
                    .otherwise(F.lit("rounding_diff")).alias("classification")))


def restated_facts(restated: DataFrame) -> DataFrame:
    """One row per differing fact; the authoritative version carries all that is constant in a fact."""
    return restated.where("is_authoritative")
