"""Dimensions: filings, companies, periods, tags."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import dates
from ledgermill.functions.picking import latest_where, pick_first
from ledgermill.functions.text import filing_url, is_amended, taxonomy_of
from ledgermill.schema import QUARTER
from ledgermill.settings import Settings


def dim_filing(raw_sub: DataFrame, settings: Settings) -> DataFrame:
    """One row per accession number, from its latest dataset quarter."""
    copies_order = [F.col(QUARTER).desc_nulls_last(), F.col("filed").desc_nulls_last(),
                    F.col("name").desc_nulls_last()]
    latest = pick_first(raw_sub, ["adsh"], copies_order)
    form = F.col("form")
    return latest.select(
        "adsh", "cik", "name", "sic", "form",
        dates.compact_date(F.col("period")).alias("period"),
        F.col("fy").alias("fy_reported"), F.col("fp").alias("fp_reported"),
        dates.compact_date(F.col("filed")).alias("filed"), "accepted",
        (F.col("prevrpt") == 1).alias("prevrpt"), (F.col("detail") == 1).alias("detail"),
        "nciks", "aciks", "fye", "afs", "wksi",
        F.col("stprinc").alias("state_of_inc"), F.col("countryinc").alias("country_of_inc"),
        F.col("stprba").alias("state_ba"), F.col("countryba").alias("country_ba"),
        QUARTER,
        is_amended(form).alias("is_amendment"),
        form.isin(settings.in_scope_forms).alias("in_scope"),
        F.when(form.startswith("10-K"), F.lit("annual")).when(form.startswith("10-Q"), F.lit("quarterly"))
        .otherwise(F.lit("other")).alias("report_type"),
        filing_url(F.col("cik"), F.col("adsh")).alias("edgar_url"),
    )


def with_sector(companies: DataFrame, settings: Settings) -> DataFrame:
    """Sector, industry, major group and the financial flag from ``sic``.

    Ranges of the classification are whole hundreds, so the range lookup is an equality on ``sic / 100``.
    The lookup is configuration (under a hundred rows) and is broadcast.
    """
    spark = companies.sparkSession
    financial = F.lit(False)
    for low, high in settings.financial_ranges:
        financial = financial | F.coalesce(F.col("sic").between(low, high), F.lit(False))
    lookup = settings.sector_map(spark)
    return (companies.withColumn("_group", F.floor(F.col("sic") / 100).cast("int"))
            .join(F.broadcast(lookup), F.col("_group") == F.col("major_group"), "left")
            .withColumns({"sector": F.coalesce("sector", F.lit("Unknown")),
                          "industry": F.coalesce("industry", F.lit("Unknown")),
                          "is_financial": financial})
            .drop("_group"))


def dim_company(filings: DataFrame, settings: Settings) -> DataFrame:
    """One row per company in one aggregation; each attribute comes from the latest filing that has it."""
    by_filing_date = ["filed", "adsh"]
    fye_month = F.substring("fye", 1, 2).try_cast("int")
    usable_fye = (F.length("fye") == 4) & fye_month.between(1, 12)
    annual = F.col("report_type") == "annual"
    latest = latest_where(F.lit(True), by_filing_date, "name", "fye", "state_of_inc", "country_of_inc", "state_ba",
                          "country_ba", "afs")
    grouped = filings.groupBy("cik").agg(
        latest.alias("last"),
        latest_where(F.col("sic") > 0, by_filing_date, "sic")["sic"].alias("sic"),
        latest_where(usable_fye, by_filing_date, "fye")["fye"].alias("good_fye"),
        latest_where(annual & F.col("period").isNotNull(), by_filing_date, F.month("period").alias("m"))["m"]
        .alias("annual_month"),
        F.min("filed").alias("first_filed"), F.max("filed").alias("last_filed"),
        F.count(F.lit(1)).alias("n_filings"),
        F.count_if(F.col("in_scope")).alias("n_in_scope_filings"),
        F.count_if(annual).alias("n_annual"),
        F.count_if(F.col("report_type") == "quarterly").alias("n_quarterly"),
    )
    described = with_sector(grouped, settings)
    return described.select(
        "cik", F.col("last.name").alias("name"), "sic", "sector", "industry", "major_group", "is_financial",
        "last.state_of_inc", "last.country_of_inc", "last.state_ba", "last.country_ba",
        F.col("last.afs").alias("filer_status"),
        F.coalesce("good_fye", "last.fye").alias("fye"),
        F.coalesce(F.substring("good_fye", 1, 2).cast("int"), F.col("annual_month"), F.lit(12))
        .alias("fiscal_year_end_month"),
        (F.col("good_fye").isNull() & F.col("annual_month").isNull()).alias("fiscal_year_end_assumed"),
        "first_filed", "last_filed", "n_filings", "n_in_scope_filings", "n_annual", "n_quarterly",
    )


def dim_period(raw_num: DataFrame) -> DataFrame:
    """Every (period end, duration) pair that occurs."""
    end, qtrs = F.col("period_end"), F.col("qtrs")
    pairs = (raw_num.where(F.col("ddate").isNotNull() & qtrs.isNotNull())
             .select("ddate", "qtrs").distinct()
             .select(dates.compact_date(F.col("ddate")).alias("period_end"), "qtrs")
             .where(end.isNotNull()))
    return pairs.select(
        dates.period_key(end, qtrs).alias("period_key"), "period_end", qtrs.alias("duration_quarters"),
        (qtrs == 0).alias("is_instant"),
        dates.period_start(end, qtrs).alias("period_start"), dates.period_type(qtrs).alias("period_type"),
        F.year(end).alias("calendar_year"), F.quarter(end).alias("calendar_quarter"),
    )


def dim_tag(raw_tag: DataFrame) -> DataFrame:
    """Taxonomy metadata, the latest copy per (tag, version)."""
    order = [F.col(QUARTER).desc_nulls_last(), F.col("datatype"), F.col("tlabel")]
    return pick_first(raw_tag, ["tag", "version"], order).select(
        "tag", "version", taxonomy_of(F.col("version")).alias("taxonomy"),
        (F.col("custom") == 1).alias("is_custom"), (F.col("abstract") == 1).alias("is_abstract"),
        "datatype", "iord", "crdr", "tlabel", "doc")
