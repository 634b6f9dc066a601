"""Rules over the raw files."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions import dates
from ledgermill.functions.sqltext import case, struct
from ledgermill.operators.facts import declared_by_filing, with_declarations
from ledgermill.quality.contract import DETAILS, Rule, counted, detail, register
from ledgermill.schema import NUM_KEY, QUARTER, RULE_OUTPUT
from ledgermill.settings import Settings


def duplicate_keys(tables: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """Number keys that repeat within a quarter; one failing row per key, weighing all its rows.

    Grouping by the key columns treats NULLs as equal and combines copies on the map side.
    """
    groups = (tables["raw_num"].groupBy(*NUM_KEY, QUARTER).agg(F.count(F.lit(1)).alias("k"))
              .withColumn("period_end", dates.compact_date(F.col("ddate"))))
    judged = counted("k > 1", n="k", adsh="adsh", period_end="period_end", qtrs="qtrs", tag="tag",
                     observed="k", expected="1", diff="k - 1",
                     message=f"concat('key duplicated ', k, 'x in ', {QUARTER}, ' num.txt')")
    return groups.selectExpr(f"{judged} AS u").select("u.*")


def references(tables: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Numbers and presentation rows, each with ``declared`` and ``known``, which are true or NULL.

    Each raw file is read once. The lookups are unique per key, so the outer joins keep the row count. Filings and what they
    declare are met by accession number, where the rows of a filing lie together; they are as many as there are filings, so
    they are dealt and never broadcast, whatever the size of their files suggests.
    """
    tags = tables["raw_tag"].select("tag", "version", "datatype", "iord").dropDuplicates(["tag", "version"])
    filed = tables["raw_sub"].select("adsh").distinct().withColumn("known", F.lit(True))

    def looked_up(rows: DataFrame) -> DataFrame:
        own = declared_by_filing(rows, tags)
        known = filed.hint("merge").join(own.hint("merge"), "adsh", "full").hint("shuffle_hash")
        return with_declarations(rows.join(known, "adsh", "left"), tags).withColumn(
            "declared", F.when(F.col("tag_declared"), F.lit(True)))

    numbers = (looked_up(tables["raw_num"].select("adsh", "tag", "version", "ddate", "qtrs"))
               .withColumn("period_end", dates.compact_date(F.col("ddate"))))
    return numbers, looked_up(tables["raw_pre"].select("adsh", "tag", "version"))


def _judged_references(numbers: DataFrame, rows: DataFrame) -> DataFrame:
    """A number failing both checks is two failures and takes two off the passes."""
    where = {"adsh": "adsh", "period_end": "period_end", "qtrs": "qtrs", "tag": "tag"}
    fine = struct({"status": "'pass'", "n": "1L", "d": f"CAST(NULL AS {_detail_type()})"})

    def failure(message: str) -> str:
        return struct({"status": "'fail'", "n": "1L", "d": detail(message=message, **where)})

    no_tag = failure("concat('num tag/version ', version, ' not in tag.txt')")
    no_filing = failure("'num accession not in sub.txt'")
    both = struct({"status": "'pass'", "n": "-1L", "d": f"CAST(NULL AS {_detail_type()})"})
    of_numbers = case(("declared AND known", f"array({fine})"), ("known", f"array({no_tag})"),
                      ("declared", f"array({no_filing})"), otherwise=f"array({both}, {no_tag}, {no_filing})")
    of_rows = counted("declared IS NULL", adsh="adsh", tag="tag",
                      message="concat('pre tag/version ', version, ' not in tag.txt')")
    return (numbers.selectExpr(f"explode({of_numbers}) AS u").select("u.*")
            .unionByName(rows.selectExpr(f"{of_rows} AS u").select("u.*")))


def dangling_references(tables: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """Numbers and presentation rows whose tag is undeclared, and numbers whose filing is absent."""
    return _judged_references(*references(tables))


def dangling_failures(tables: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """The same without the rows that have nothing wrong, for which no unit is made."""
    numbers, rows = references(tables)
    return _judged_references(numbers.where("declared IS NULL OR known IS NULL"), rows.where("declared IS NULL"))


def dangling_counts(tables: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """``status, n`` of the same: a number has a failure for each check that it does not pass, and is one unit, or for two
    failures one unit taken off the passes."""
    numbers, rows = references(tables)
    wrong = "(CASE WHEN declared IS NULL THEN 1L ELSE 0L END + CASE WHEN known IS NULL THEN 1L ELSE 0L END)"
    of_numbers = numbers.selectExpr(f"{wrong} AS fail", f"1L - {wrong} AS pass")
    of_rows = rows.selectExpr("CASE WHEN declared IS NULL THEN 1L ELSE 0L END AS fail",
                              "CASE WHEN declared IS NULL THEN 0L ELSE 1L END AS pass")
    total = of_numbers.unionByName(of_rows).agg(F.sum("fail").alias("fail"), F.sum("pass").alias("pass"))
    return total.selectExpr("stack(2, 'fail', fail, 'pass', pass) AS (status, n)").where("n IS NOT NULL")


def _detail_type() -> str:
    return T.StructType([f for f in RULE_OUTPUT.fields if f.name in DETAILS]).simpleString()


register(Rule(
    "R12", "duplicate_fact_rows", "duplicate", "error", "raw number row, all forms and quarters",
    "No number key repeats within one dataset quarter. Every row of a repeated key counts as a failure.",
    build=duplicate_keys, compact=True, of_company=False))
register(Rule(
    "R20", "tag_referential_integrity", "referential", "error", "raw number row and raw presentation row",
    "Every tag and version in use is declared, and every number belongs to a known filing.",
    build=dangling_references, compact=True, failing=dangling_failures, counts=dangling_counts, of_company=False))
