"""How often rows are dealt: plans that must not grow faster than the input, and results on odd inputs."""
import re

from build import A, Tables
from pyspark.sql import functions as F

from ledgermill.operators.facts import fact_financial_facts
from ledgermill.operators.normalize import candidates, resolve, source_counts
from ledgermill.operators.restatements import disputed_versions, fact_versions, repeated_facts, restatements
from ledgermill.plans.warehouse import Warehouse
from ledgermill.quality.contract import rule_named
from ledgermill.quality.raw import dangling_references
from ledgermill.quality.run import run_rule
from ledgermill.settings import Settings
from ledgermill.sources import star

OTHER = "0000000002-25-000002"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def raw_tables(spark):
    """A published tag, a filing's own tag, one that refers to another filing's, and an undeclared one."""
    t = Tables()
    for adsh in (A, OTHER):
        t.raw("sub", adsh=adsh, cik=1, form="10-K", period="20241231", filed="20250215")
    for tag, version in (("Assets", "us-gaap/2024"), ("Own", A)):
        t.raw("tag", tag=tag, version=version, datatype="monetary", iord="I")
    number = dict(ddate="20241231", qtrs=0, value=5.0)
    for adsh, tag, version, uom in ((A, "Assets", "us-gaap/2024", "USD"), (A, "Own", A, "EUR"), (OTHER, "Own", A, "EUR"),
                                    (OTHER, "Assets", "us-gaap/2024", "CHF"), (OTHER, "Assets", OTHER, "USD"),
                                    (OTHER, "Assets", None, "USD")):
        t.raw("num", adsh=adsh, tag=tag, version=version, uom=uom, **number)
        t.raw("pre", adsh=adsh, tag=tag, version=version)
    return t


def test_declared_types_whatever_a_version_refers_to(spark):
    w = raw_tables(spark).warehouse(spark, "dim_filing", "dim_company", "dim_tag", "fact_financial_facts")
    found = {(r["adsh"], r["tag"], r["version"]): (r["datatype"], r["tag_declared"], r["filing_currency"])
             for r in w["fact_financial_facts"].collect()}
    assert found == {
        (A, "Assets", "us-gaap/2024"): ("monetary", True, "EUR"), (A, "Own", A): ("monetary", True, "EUR"),
        (OTHER, "Own", A): ("monetary", True, "CHF"), (OTHER, "Assets", "us-gaap/2024"): ("monetary", True, "CHF"),
        (OTHER, "Assets", OTHER): (None, False, "CHF"), (OTHER, "Assets", None): (None, False, "CHF")}
    counted = {(r["adsh"], r["currency"], r["n_monetary_facts"]) for r in w["filing_currency"].collect()}
    assert counted == {(A, "EUR", 1), (OTHER, "CHF", 1)}


def test_copies_neither_stay_nor_count(spark):
    t = raw_tables(spark)
    for k in range(5):  # an older copy of one key, five times, would make EUR the currency of the other filing
        t.raw("num", adsh=OTHER, tag="Own", version=A, uom="EUR", ddate="20241231", qtrs=0, value=float(k),
              dataset_quarter="2024q4")
    w = t.warehouse(spark, "dim_filing", "dim_company", "dim_tag", "fact_financial_facts")
    found = w["fact_financial_facts"].where(f"adsh = '{OTHER}'")
    assert {r["filing_currency"] for r in found.collect()} == {"CHF"}
    assert [r["value"] for r in found.where("uom = 'EUR'").collect()] == [5.0]
    plan = plan_of(found)
    assert "WindowGroupLimit [_filing" not in plan and "CASE WHEN Contains(version" in plan, plan


def test_facts_are_not_dealt_by_tag(spark):
    w = raw_tables(spark).warehouse(spark, "dim_filing", "dim_company", "dim_tag")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for tables beyond it
    try:
        plan = plan_of(fact_financial_facts(w["raw_num"], w["dim_filing"], w["dim_company"], w["dim_tag"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not re.search(r"SortMergeJoin \[tag#\d+, version#\d+\].*LeftOuter", plan), plan


def test_references_without_a_broadcast_of_filings(spark):
    w = raw_tables(spark).warehouse(spark)
    units = dangling_references(w, Settings())
    assert sum(r["n"] for r in units.collect() if r["status"] == "fail") == 4
    # published tags alone go to every task, however small the other tables look once they have been dealt
    assert "BroadcastHashJoin [adsh#" not in plan_of(units)


def test_restatements_in_one_exchange(spark):
    t = Tables()
    for k in range(30):
        t.fact("Revenues", 100 + k % 3, adsh=f"f{k}", filed=f"2024-01-{k % 28 + 1:02d}")
        t.fact("Assets", 7, adsh=f"f{k}")
        t.fact("Liabilities", k % 2, adsh=f"f{k}", uom=None)  # a NULL in the key is not compared
    facts = t.frame(spark, "fact_financial_facts")
    found = restatements(disputed_versions(facts), 0.001)
    assert {(r["tag"], r["n_versions"]) for r in found.collect()} == {("Revenues", 30)}
    again = restatements(disputed_versions(facts, repeated_facts(facts)), 0.001)
    assert found.exceptAll(again).count() == 0 and again.exceptAll(found).count() == 0
    assert found.exceptAll(restatements(fact_versions(facts), 0.001)).count() == 0
    assert plan_of(restatements(disputed_versions(facts), 0.001)).count("Exchange hashpartitioning") == 1


def test_resolution_keeps_candidates_single(spark):
    t = Tables()
    t.tag("Assets")
    for k, value in enumerate((0.0, -0.0, 5.0, 5.0)):
        t.fact("Assets", value, adsh=f"f{k}", filed=f"2025-02-{k + 1:02d}")
    w = t.warehouse(spark)
    reported = resolve(w["fact_financial_facts"], w["dim_tag"], w["filing_currency"], w["restatements"], Settings())
    row = reported.collect()[0]
    assert (row["value"], row["source_adsh"], row["n_candidates"], row["n_sources"], row["n_distinct_values"]) == (
        5.0, "f3", 4, 4, 2)
    assert "Expand" not in plan_of(reported)  # a copy of every candidate per distinct count


def test_verdicts_where_facts_lie_are_those_of_the_restatements(spark):
    t = Tables()
    t.tag("Assets")
    t.tag("Revenues", iord="D")
    for k in range(4):
        t.fact("Assets", 5.0, adsh=f"f{k}", filed=f"2025-02-{k + 1:02d}")  # agrees
        t.fact("Revenues", 100 + k, adsh=f"f{k}", qtrs=4, filed=f"2025-02-{k + 1:02d}")  # restated
        t.fact("Revenues", 100000 + k, adsh=f"f{k}", qtrs=1, filed=f"2025-02-{k + 1:02d}")  # rounded
        t.fact("Assets", k, adsh=f"f{k}", uom=None)  # a NULL in the key
        t.fact("Assets", k, adsh=f"f{k}", version="dei/2024", period_end="2023-12-31")  # a cover page
    t.fact("Assets", 7.0, adsh="f1", period_end="2022-12-31")
    t.fact("Assets", 9.0, adsh="f1", period_end="2022-12-31", version="us-gaap/2023")  # an older version of one filing
    t.fact("Assets", -3.0, adsh="f2", period_end="2021-12-31", filed=None)
    t.fact("Assets", 3.0, adsh="f1", period_end="2021-12-31")
    w = t.warehouse(spark)
    facts = w["fact_financial_facts"]
    joined = resolve(facts, w["dim_tag"], w["filing_currency"], restatements(disputed_versions(facts), 0.001), Settings())
    here = resolve(facts, w["dim_tag"], w["filing_currency"], None, Settings())
    assert sorted(map(str, here.collect())) == sorted(map(str, joined.collect()))
    assert {(r["metric"], r["qtrs"], r["is_restated"], r["resolution_reason"].rsplit(";", 1)[1])
            for r in here.where("period_end IN ('2024-12-31', '2021-12-31')").collect()} == {
        ("total_assets", 0, False, "authoritative=latest_filed"), ("total_assets", 0, True, "restated"),
        ("revenue", 4, True, "restated"), ("revenue", 1, False, "rounding_diff")}


def test_ratios_from_one_exchange_of_facts(spark):
    t = Tables()
    t.tag("Assets")
    t.fact("Assets", 5.0)
    facts = t.frame(spark, "fact_financial_facts").selectExpr(
        "*", "'monetary' AS datatype", "'I' AS iord", "true AS tag_declared", "'USD' AS filing_currency")
    w = Warehouse(spark, {"fact_financial_facts": facts, "dim_tag": t.frame(spark, "dim_tag")}, write=False)
    for name in ("fact_normalized", "dq_wide", "ratio_rows"):
        plan = plan_of(w[name])
        assert plan.count("Exchange hashpartitioning") == 1 and "Union" not in plan, plan


def test_one_consumer_writes_nothing_on_the_way(spark, tmp_path):
    t = raw_tables(spark)
    for adsh in (A, OTHER):
        t.raw("num", adsh=adsh, tag="NetIncomeLoss", version="us-gaap/2024", uom="EUR", ddate="20241231", qtrs=4, value=5.0)
    t.raw("tag", tag="NetIncomeLoss", version="us-gaap/2024", datatype="monetary", iord="D")
    given = {f"raw_{name}": t.frame(spark, f"raw_{name}") for name in ("sub", "num", "tag", "pre")}
    alone = Warehouse(spark, given, path=str(tmp_path / "alone"))
    assert alone["ratio_rows"].count() == 1
    assert not {"fact_financial_facts", "fact_normalized"} & {p.name for p in (tmp_path / "alone").iterdir()}
    whole = Warehouse(spark, given, path=str(tmp_path / "whole")).build("fact_financial_facts", "fact_normalized", "ratio_rows")
    assert {"fact_financial_facts", "fact_normalized"} <= {p.name for p in (tmp_path / "whole").iterdir()}
    assert whole["ratio_rows"].exceptAll(alone["ratio_rows"]).count() == 0


def test_facts_go_to_their_buckets_without_another_exchange(spark, tmp_path):
    import glob
    t = Tables()
    for k in range(40):
        t.raw("sub", adsh=f"f{k}", cik=k, form="10-K", period="20241231", filed="20250215")
        t.raw("num", adsh=f"f{k}", tag="Assets", version="us-gaap/2024", uom="USD", ddate="20241231", qtrs=0, value=5.0)
    t.raw("tag", tag="Assets", version="us-gaap/2024", datatype="monetary", iord="I")
    given = {f"raw_{name}": t.frame(spark, f"raw_{name}") for name in ("sub", "num", "tag", "pre")}
    given["raw_num"] = given["raw_num"].repartition("adsh")
    w = Warehouse(spark, given, path=str(tmp_path / "own"))
    names = ["fact_financial_facts", "dim_filing", "filing_currency"]
    for _ in range(2):  # saved again over tables that were read meanwhile
        w.save_as_tables("default", *names, path=str(tmp_path / "saved"), suffix="_straight")
    assert not (tmp_path / "own/fact_financial_facts").exists()
    files = glob.glob(str(tmp_path / "saved/fact_financial_facts/part-*"))
    numbers = [re.search(r"_(\d{5})\.c", name).group(1) for name in files]
    assert len(numbers) == len(set(numbers)) == 4  # one file for each bucket
    fact, filing, currency = (spark.table(f"default.{name}_straight") for name in names)
    joined = fact.select("adsh").join(filing.select("adsh").hint("merge"), "adsh").join(
        currency.select("adsh").hint("merge"), "adsh")
    assert joined.count() == 40 and "Exchange" not in plan_of(joined)


def test_sources_are_counted_without_copies(spark):
    t = Tables()
    t.tag("Assets")
    for k, value in enumerate((0.0, -0.0, 5.0, 5.0)):
        t.fact("Assets", value, adsh=f"f{k % 3}")
    w = t.warehouse(spark)
    counts = source_counts(candidates(w["fact_financial_facts"], w["dim_tag"], w["filing_currency"], Settings()))
    assert [(r["metric"], r["n_sources"], r["n_values"]) for r in counts.collect()] == [("total_assets", 3, 2)]
    assert "Expand" not in plan_of(counts)


def test_text_is_compressed_and_loads_sort_nothing(spark, tmp_path):
    from ledgermill.schema import SOURCES
    from ledgermill.sources import staging
    t = raw_tables(spark)
    for name in SOURCES:
        staging.write_text(t.frame(spark, f"raw_{name}"), name, str(tmp_path / f"text/{name}.txt"))
    files = [p.name for p in (tmp_path / "text/num.txt").iterdir() if p.name.startswith("part-")]
    assert files and all(name.endswith(".gz") for name in files)
    found = staging.load_quarter(spark, str(tmp_path / "text"), "2025q1", str(tmp_path / "stage"))
    assert found["num"].agrees and (found["num"].parsed, found["num"].rejected) == (6, 0)
    assert staging.read_staged(spark, str(tmp_path / "stage"), "num").where("uom = 'CHF'").count() == 1
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 1  # parsed and rejected lines, unsorted


def test_parts_of_numbers_do_not_grow_with_the_input(spark, monkeypatch, tmp_path):
    def duplicates(w):
        return run_rule(rule_named("R12"), w, w.settings)

    folder = "/root/testdata/sf0.001"
    before = sorted(map(str, duplicates(Warehouse(spark, star.raw_tables(spark, folder))).collect()))
    monkeypatch.setattr(star, "LINES_PER_PART", 250, raising=False)
    w = Warehouse(spark, star.raw_tables(spark, folder), path=str(tmp_path / "own"))
    sizes = (w["raw_num"].selectExpr("spark_partition_id() AS part", "pmod(hash(adsh), 4) AS of_session")
             .groupBy("part").agg(F.count("*").alias("n"), F.count_distinct("of_session").alias("of_session")).collect())
    assert len(sizes) >= 20 and max(r["n"] for r in sizes) < 250 * 22 / 5 * 2, sizes
    assert {r["of_session"] for r in sizes} == {1}
    assert sorted(map(str, duplicates(w).collect())) == before
    assert not re.search(r"Exchange hashpartitioning\(adsh#\d+, tag", plan_of(duplicates(w)))
    # facts of these parts go to the buckets of the session
    names = ["fact_financial_facts", "dim_filing"]
    w.save_as_tables("default", *names, path=str(tmp_path / "saved"), suffix="_parts")
    fact, filing = (spark.table(f"default.{name}_parts") for name in names)
    joined = fact.join(filing.select("adsh").hint("merge"), "adsh")
    assert "Exchange" not in plan_of(joined)
    assert joined.count() == fact.count() == w["fact_financial_facts"].count() > 0
