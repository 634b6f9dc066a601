"""The fact table and the currency of each filing."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.functions import dates
from ledgermill.functions.picking import pick_first
from ledgermill.functions.text import taxonomy_of
from ledgermill.schema import NUM_KEY, QUARTER

CONSOLIDATED = "segments IS NULL AND coreg IS NULL"
CONSOLIDATED_STANDARD = "is_consolidated AND NOT is_custom_tag"
PUBLISHED = "contains(version, '/')"  # of a published taxonomy; a filing's own tags carry its accession number
MONETARY = "is_consolidated AND tag_declared AND datatype = 'monetary'"


def declared_by_filing(rows: DataFrame, tags: DataFrame) -> DataFrame:
    """``adsh, own_tags``: per filing the declarations outside the published taxonomies that its rows may refer to.

    A filing's own tags are found under its accession number without looking at ``rows``. Rows that name neither a published
    taxonomy nor their own filing are rare; their pairs are looked up and join the list of the filing that uses them.
    """
    types = tags.where(f"NOT {PUBLISHED}").select("tag", "version", "datatype", "iord")
    odd = rows.where(f"NOT {PUBLISHED} AND version <> adsh").select("adsh", "tag", "version").distinct()
    entries = types.withColumn("adsh", F.col("version")).unionByName(odd.join(types, ["tag", "version"]))
    return entries.groupBy("adsh").agg(F.struct(  # side by side: a place in one list is the place in the other
        F.collect_list(F.struct("tag", "version")).alias("names"),
        F.collect_list(F.struct("datatype", "iord")).alias("types")).alias("own_tags"))


def with_declarations(rows: DataFrame, tags: DataFrame) -> DataFrame:
    """Rows, joined with :func:`declared_by_filing` before, with ``datatype``, ``iord`` and ``tag_declared``.

    Nothing is dealt by tag: one tag may have any share of the rows. The published taxonomies are broadcast, for their size
    does not depend on the filings; a filing's own tags came with the filing.
    """
    published = tags.where(PUBLISHED).select("tag", "version", F.struct("datatype", "iord").alias("_published"))
    place = "array_position(own_tags.names, struct(tag, version))"  # stays in generated code, as a lambda would not
    own = f"CASE WHEN {PUBLISHED} THEN NULL WHEN tag IS NULL THEN NULL ELSE get(own_tags.types, CAST({place} AS INT) - 1) END"
    return (rows.join(F.broadcast(published), ["tag", "version"], "left").withColumn("_own", F.expr(own))
            .withColumns({"datatype": F.coalesce("_published.datatype", "_own.datatype"),
                          "iord": F.coalesce("_published.iord", "_own.iord"),
                          "tag_declared": F.expr("_published IS NOT NULL OR _own IS NOT NULL")})
            .drop("_published", "_own", "own_tags"))


def fact_financial_facts(raw_num: DataFrame, filings: DataFrame, companies: DataFrame, tags: DataFrame,
                         consolidated: bool = False) -> DataFrame:
    """Every parsed number of an in-scope filing, one row per number key, with what its tag declares.

    All happens where the numbers of a filing lie together: they are dealt once, by filing, and not at all where they already
    are. The narrow context of in-scope filings is hashed and drops the others before anything is sorted; it brings what a
    filing declares itself. One sort then serves the choice among copies, whose keys begin with the filing, and the
    filing's currency, the most frequent unit of its consolidated amounts. Declared types and currencies are looked up
    here, once for all tables that need them: ``tag_declared`` tells whether the (tag, version) is declared at all.

    ``consolidated`` leaves other amounts out before anything is dealt or sorted: they neither are copies of consolidated
    ones nor count for the currency.
    """
    if consolidated:
        raw_num = raw_num.where(CONSOLIDATED)
    context = (filings.where("in_scope")
               .select("adsh", "cik", "form", "filed", "report_type", F.col("period").alias("filing_period"))
               .join(companies.select("cik", "fiscal_year_end_month"), "cik")
               .join(declared_by_filing(raw_num, tags).hint("shuffle_hash"), "adsh", "left"))
    numbers = (raw_num.where(F.col("value").isNotNull())
               .withColumn("period_end", dates.compact_date(F.col("ddate")))
               .where(F.col("period_end").isNotNull())
               .join(context.hint("shuffle_hash"), "adsh"))
    numbers = with_declarations(numbers, tags)  # before the sort, which does not carry the declarations of a filing
    filing = Window.partitionBy("_filing", "adsh")  # a hash decides most comparisons
    copies = Window.partitionBy("_filing", "adsh", "_hash", *NUM_KEY[1:]).orderBy(
        F.col(QUARTER).desc_nulls_last(), F.col("value").desc(), F.col("footnote").desc_nulls_last())
    numbers = numbers.withColumns({
        "_filing": F.xxhash64("adsh"), "_hash": F.xxhash64(*NUM_KEY[1:]),
        "is_consolidated": F.expr(CONSOLIDATED)})
    unit = F.when(F.expr(f"_rank = 1 AND {MONETARY}"), F.struct(F.col("uom").isNull().alias("absent"), "uom"))
    # copies go behind both windows: left out between them, every number would pass two more operators that look for the
    # first of its key, though hardly any has a second
    numbers = (numbers.withColumn("_rank", F.row_number().over(copies))
               .withColumn("filing_currency", F.mode(unit, True).over(filing)["uom"])  # ties by name
               .where("_rank = 1"))
    end, year_end = F.col("period_end"), F.col("fiscal_year_end_month")
    return numbers.select(
        "adsh", "cik", "tag", "version",
        taxonomy_of(F.col("version")).alias("taxonomy"),
        (F.col("version") == F.col("adsh")).alias("is_custom_tag"),
        dates.period_key(end, F.col("qtrs")).alias("period_key"),
        "period_end", "qtrs", "uom", "value", "segments", "coreg", "footnote",
        "form", "filed", "report_type", "filing_period",
        "is_consolidated",
        (end == F.col("filing_period")).alias("is_current_period"),
        dates.fiscal_year(end, year_end).alias("fiscal_year"),
        dates.fiscal_quarter(end, year_end).alias("fiscal_quarter"),
        QUARTER, "datatype", "iord", "tag_declared", "filing_currency",
    )


def with_tag_types(facts: DataFrame, tags: DataFrame, *columns: str) -> DataFrame:
    """Facts of declared tags with the named attributes. The fact table carries them; other facts are joined to ``tags``."""
    if "tag_declared" in facts.columns:
        return facts.where("tag_declared").drop("tag_declared")
    return facts.join(tags.select("tag", "version", *columns), ["tag", "version"])


def filing_currency(facts: DataFrame, tags: DataFrame) -> DataFrame:
    """The most frequent monetary unit of each filing, ties by name. The fact table carries it; its facts are counted."""
    if "filing_currency" in facts.columns:
        agreeing = F.count_if(F.expr(f"{MONETARY} AND uom <=> filing_currency")).alias("n_monetary_facts")
        return (facts.groupBy("adsh", F.col("filing_currency").alias("currency")).agg(agreeing)
                .where("n_monetary_facts > 0"))
    monetary = with_tag_types(facts.where("is_consolidated"), tags, "datatype").where("datatype = 'monetary'")
    counted = monetary.groupBy("adsh", "uom").agg(F.count(F.lit(1)).alias("n"))
    return (pick_first(counted, ["adsh"], [F.col("n").desc(), F.col("uom").asc_nulls_last()])
            .select("adsh", F.col("uom").alias("currency"), F.col("n").alias("n_monetary_facts")))
