"""Filing tables derived from an order/line-item star schema.

The driver's tables hold no filings. Orders become submissions and line items become reported numbers, one
per matching template row, so the size of every filing table grows with the star schema. Values follow the
accounting identities before noise and deliberate defects, so every rule meets passes and failures.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.schema import QUARTER, staged

STANDARD = "us-gaap/2024"

# --- fixed values: one template row per source tag (index, tag, datatype, period kind, coefficient) ---------
TEMPLATE = [
    (0, "Revenues", "monetary", "D", 1.0),
    (1, "CostOfRevenue", "monetary", "D", 0.6),
    (2, "GrossProfit", "monetary", "D", 0.4),
    (3, "OperatingIncomeLoss", "monetary", "D", 0.2),
    (4, "NetIncomeLoss", "monetary", "D", 0.1),
    (5, "NetCashProvidedByUsedInOperatingActivities", "monetary", "D", 0.15),
    (6, "NetCashProvidedByUsedInInvestingActivities", "monetary", "D", -0.05),
    (7, "NetCashProvidedByUsedInFinancingActivities", "monetary", "D", -0.04),
    (8, "CashAndCashEquivalentsPeriodIncreaseDecrease", "monetary", "D", 0.06),
    (9, "PaymentsToAcquirePropertyPlantAndEquipment", "monetary", "D", 0.05),
    (10, "Assets", "monetary", "I", 10.0),
    (11, "LiabilitiesAndStockholdersEquity", "monetary", "I", 10.0),
    (12, "Liabilities", "monetary", "I", 6.0),
    (13, "StockholdersEquity", "monetary", "I", 4.0),
    (14, "AssetsCurrent", "monetary", "I", 4.0),
    (15, "LiabilitiesCurrent", "monetary", "I", 2.0),
    (16, "InventoryNet", "monetary", "I", 1.0),
    (17, "LongTermDebtNoncurrent", "monetary", "I", 2.0),
    (18, "ShortTermBorrowings", "monetary", "I", 0.5),
    (19, "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest", "monetary", "I", 4.0),
    (20, "EarningsPerShareBasic", "perShare", "D", 0.0001),
    (21, "WeightedAverageNumberOfSharesOutstandingBasic", "shares", "F", 1000.0),
]
FORM_BY_PRIORITY = {"1": "10-K/A", "2": "10-K", "3": "10-Q", "4": "10-Q/A", "5": "8-K"}
UNDECLARED_TAG = 18  # left out of raw_tag so that referential integrity has failures
# (tag, lines concerned, factor): amounts that rules and ratios have to notice; the first that fits counts
DEFECTS = [
    ("InventoryNet", "l_quantity > 49", -1.0),
    ("Assets", "l_quantity > 49 AND l_discount > 0.095", 1e9),
    ("Assets", "l_quantity < 4 AND l_tax > 0.055", 0.0),
    ("AssetsCurrent", "l_quantity > 48", 3.0),
    ("LiabilitiesCurrent", "l_quantity > 48", 5.0),
    ("LiabilitiesCurrent", "l_quantity < 4", 0.0),
    ("StockholdersEquity", "l_quantity > 48 AND l_discount > 0.055", -1.0),
    ("Revenues", "l_quantity > 49", -1.0),
    ("Revenues", "l_quantity < 4 AND l_tax > 0.035", 0.0),
]
CUSTOMERS_PER_COMPANY = 25  # companies grow with the data; numbers per company are about those of real filings
LINES_PER_PART = 150_000  # what one task turns into numbers, some four a line


def template(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATE, "idx int, tag string, datatype string, iord string, coef double")


def _quarter_end(day: Column) -> Column:
    month = (F.quarter(day) * 3).cast("int")
    return F.replace(F.last_day(F.make_date(F.year(day), month, F.lit(1))).cast("string"), F.lit("-"), F.lit(""))


def _padded(df: DataFrame, name: str) -> DataFrame:
    """All staged columns of a source, absent ones as typed NULLs."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in staged(name).fields])


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _submissions(orders: DataFrame) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    key = F.col("o_orderkey")
    company = F.floor(F.col("o_custkey") / CUSTOMERS_PER_COMPANY)
    kind = company % 100
    priority = F.substring("o_orderpriority", 1, 1)
    form = F.lit(None).cast("string")
    for code, name in FORM_BY_PRIORITY.items():
        form = F.when(priority == code, name).otherwise(form)
    quarter_name = F.concat(F.lit("Q"), F.quarter(day).cast("string"))
    return orders.select(
        F.lpad(key.cast("string"), 10, "0").alias("adsh"),
        company.cast("long").alias("cik"),
        F.concat(F.lit("Company "), F.lpad(company.cast("string"), 8, "0")).alias("name"),
        F.when(key % 10 != 0, 100 + kind * 97).cast("int").alias("sic"),
        F.when(kind < 90, F.concat(F.lpad(((F.col("o_custkey") % 4 + 1) * 3).cast("string"), 2, "0"),
                                      F.lit("30"))).alias("fye"),
        form.alias("form"),
        F.when(key % 101 == 0, F.lit("19991399")).otherwise(_quarter_end(day)).alias("period"),
        (F.year(day) + F.when(key % 53 == 0, 3).otherwise(0)).cast("int").alias("fy"),
        F.when(priority.isin("1", "2") & (key % 59 != 0), F.lit("FY")).otherwise(quarter_name).alias("fp"),
        F.date_format(F.date_add(day, 100), "yyyyMMdd").alias("filed"),
        F.concat(F.year(day).cast("string"), F.lit("q"), F.quarter(day).cast("string")).alias(QUARTER),
    )


def raw_sub(spark: SparkSession, folder: str) -> DataFrame:
    return _padded(_submissions(_read(spark, folder, "orders")), "sub")


def dealt_by_filing(lines: DataFrame) -> DataFrame:
    """Lines by filing, in parts that do not grow with the input, for a task holds what becomes of its part.

    Spark merges small parts but cuts none. Where the parts the session shuffles into would take more than
    ``LINES_PER_PART`` lines, there are several times as many, so that each is still within one of the session's. The count
    reads no column.
    """
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    times = math.ceil(lines.count() / LINES_PER_PART / parts)
    return lines.repartition(times * parts, "adsh") if times > 1 else lines.repartition("adsh")


def raw_num(spark: SparkSession, folder: str) -> DataFrame:
    """Line items by template row. The lines are dealt by filing first, for each becomes several numbers."""
    lines = dealt_by_filing(_read(spark, folder, "lineitem").select(
        F.lpad(F.col("l_orderkey").cast("string"), 10, "0").alias("adsh"), "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_shipdate"))
    filings = _submissions(_read(spark, folder, "orders")).select("adsh", "cik", QUARTER)
    shipped = F.col("l_shipdate").cast("date")
    duration = 1 + F.col("l_linenumber") % 4
    instant, fixed = F.col("iord") == "I", F.col("iord") == "F"
    scale = F.when(fixed, F.lit(1.0)).otherwise(
        (F.col("cik") % 7 + 1) * 100000 * (1 + F.lit(0.05) * (F.year(shipped) - 1995)))
    length = F.when(F.col("iord") == "D", duration).otherwise(1)
    noise = F.when(F.col("idx") % 7 != F.col("l_linenumber") - 1, F.lit(1.0)).when(
        F.col("l_tax") > 0.065, F.lit(1.05)).when(F.col("l_tax") > 0.035, F.lit(1.0005)).otherwise(F.lit(1.0))
    defect = F.expr("CASE " + " ".join(f"WHEN tag = '{tag}' AND {lines_} THEN {factor}D"
                                       for tag, lines_, factor in DEFECTS) + " ELSE 1D END")
    joined = (lines.join(filings.hint("shuffle_hash"), "adsh")
              .withColumn("ddate", _quarter_end(shipped))  # once a line, not once a number
              # 22 template rows, a constant of this module: safe to broadcast
              .join(F.broadcast(template(spark)), F.col("idx") % 5 == F.col("l_partkey") % 5))
    return _padded(joined.select(
        "adsh", "tag",
        F.when(F.col("l_partkey") % 50 == 7, F.col("adsh")).otherwise(F.lit(STANDARD)).alias("version"),
        "ddate",
        F.when(instant, F.when(F.col("l_suppkey") % 61 == 5, 1).otherwise(0)).otherwise(duration)
        .cast("int").alias("qtrs"),
        F.when(F.col("datatype") == "shares", F.lit("shares"))
        .when(F.col("l_suppkey") % 97 == 3, F.lit("EUR"))
        .when(F.col("l_suppkey") % 89 == 3, F.lit("usd")).otherwise(F.lit("USD")).alias("uom"),
        F.when(F.col("l_returnflag") == "R", F.lit("Segment=R;")).alias("segments"),
        F.when(F.col("l_quantity") != 2, F.round(F.col("coef") * scale * length * noise, 4) * defect)
        .alias("value"),
        QUARTER,
    ), "num")


def raw_tag(numbers: DataFrame) -> DataFrame:
    """The (tag, version) pairs in use, declared in the first quarter that uses them; a filing's own tags are custom."""
    # a text as the least of many is sorted for; first one row per quarter, which is hashed
    used = (numbers.select("tag", "version", QUARTER).distinct()
            .groupBy("tag", "version").agg(F.min(QUARTER).alias(QUARTER)))
    declared = template(numbers.sparkSession).where(F.col("idx") != UNDECLARED_TAG)
    return _padded(used.join(F.broadcast(declared), "tag").select(
        "tag", "version", (F.col("version") != STANDARD).cast("int").alias("custom"), F.lit(0).alias("abstract"), "datatype",
        F.when(F.col("iord") == "I", F.lit("I")).otherwise(F.lit("D")).alias("iord"), F.lit("C").alias("crdr"),
        F.col("tag").alias("tlabel"), F.lit("").alias("doc"), QUARTER), "tag")


def raw_pre(numbers: DataFrame) -> DataFrame:
    """One presentation row per filing and tag in use."""
    used = numbers.select("adsh", "tag", "version", QUARTER).distinct()
    kinds = template(numbers.sparkSession).select("tag", F.when(F.col("iord") == "I", F.lit("BS")).otherwise(F.lit("IS"))
                                   .alias("stmt"))
    return _padded(used.join(F.broadcast(kinds), "tag").select(
        "adsh", F.lit(1).alias("report"), F.lit(1).alias("line"), "stmt", F.lit(0).alias("inpth"),
        F.lit("H").alias("rfile"), "tag", "version", F.col("tag").alias("plabel"), F.lit(0).alias("negating"),
        QUARTER), "pre")


def raw_tables(spark: SparkSession, folder: str) -> dict:
    """The four raw tables as functions of the warehouse, so that nothing is planned before it is needed."""
    return {
        "raw_sub": lambda tables: raw_sub(spark, folder),
        "raw_num": lambda tables: raw_num(spark, folder),
        "raw_tag": lambda tables: raw_tag(tables["raw_num"]),
        "raw_pre": lambda tables: raw_pre(tables["raw_num"]),
    }
