"""Dimensions, facts, restatements, normalization, derivation, ratios and sectors."""
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgermill.functions.ranking import exact_quantiles, in_pieces, value_ranks
from ledgermill.operators import ratios, sector
from ledgermill.operators.normalize import derive
from ledgermill.operators.restatements import disputed_versions, fact_versions, repeated_facts, restatements
from ledgermill.settings import Settings
from tests.build import A, Tables, day

A1, A2, A3 = "0000000001-24-000001", "0000000001-25-000001", "0000000001-24-000002"


def test_configuration_is_sound(spark):
    s = Settings()
    assert s.problems() == [] and s.alias_conflicts(spark).count() == 0
    assert set(s.ratios) == set(ratios.RATIOS) and len(s.metrics) == 33
    s.metrics["cash"]["tags"].append("Assets")
    s.derivation_specs.append({"metric": "nope", "formula": "+revenue -what", "reason": "r"})
    assert len(s.problems()) == 2 and s.alias_conflicts(spark).count() == 1
    s.derivation_specs.append({"metric": "revenue", "formula": "+revenue -what", "reason": "r"})
    assert [p for p in s.problems() if "revenue uses revenue itself" in p]


def test_derivations_follow_their_terms(spark):
    """Any order of the configuration that keeps the two sides of an identity gives the same rows."""
    chain = [{"metric": m, "formula": f"+{t}", "reason": "r", "optional": []}
             for m, t in (("net_income", "operating_income"), ("operating_income", "gross_profit"), ("gross_profit", "revenue"))]
    assert [d.metric for d in Settings(derivation_specs=chain).derivations] == ["gross_profit", "operating_income", "net_income"]
    assert [d.metric for d in Settings(derivation_specs=chain[::-1]).derivations] == ["gross_profit", "operating_income", "net_income"]
    specs = Settings().derivation_specs
    assert [d.metric for d in Settings().derivations] == [d["metric"] for d in specs]
    t = Tables()
    t.norm("revenue", 9, qtrs=1)
    rows = t.frame(spark, "fact_normalized")
    for order in (chain, chain[::-1], [chain[1], chain[0], chain[2]]):
        found = derive(rows, Settings(derivation_specs=order)).collect()
        assert {(r["metric"], r["value"]) for r in found} == {(m, 9.0) for m in ("gross_profit", "operating_income", "net_income")}


def test_saved_tables_join_without_exchange(spark, tmp_path):
    t = Tables()
    for k in range(40):
        t.filing(f"f{k}", cik=k % 7)
        t.fact("Assets", k, adsh=f"f{k}", cik=k % 7)
    w = t.warehouse(spark)
    w.save_as_tables("default", "dim_filing", "fact_financial_facts", buckets=4, path=str(tmp_path), suffix="_saved")
    filing, fact = spark.table("default.dim_filing_saved"), spark.table("default.fact_financial_facts_saved")
    joined = fact.select("adsh", "value").join(filing.select("adsh", "form").hint("merge"), "adsh")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 40 and "SortMergeJoin" in plan and "Exchange" not in plan
    switch = "spark.sql.sources.bucketing.autoBucketedScan.enabled"  # on, it leaves the number out of the plan's text
    spark.conf.set(switch, False)
    one = fact.where("adsh = 'f7'")
    assert one.count() == 1 and "SelectedBucketsCount: 1 out of 4" in one._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset(switch)
    w.save_as_tables("default", "dim_filing", buckets=4, path=str(tmp_path), suffix="_saved")  # a full rebuild
    assert spark.table("default.dim_filing_saved").count() == 40


def test_settings_from_files(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "aliases.yaml").write_text(
        "metrics:\n  cash: {datatype: monetary, tags: [Cash]}\n  debt: {datatype: monetary, tags: ['x:Debt']}\n"
        "derivations:\n  - {metric: cash, formula: '+debt', reason: r}\n")
    (tmp_path / "quality_rules.yaml").write_text("tolerances: {abs_floor: 5}\n")
    s = Settings.from_folder(str(tmp_path))
    assert s.problems() == [] and s.tolerance("abs_floor") == 5.0 and s.derivations[0].terms == [(1, "debt")]
    assert s.alias_rows()[1][:4] == ("debt", "Debt", "x", 1)
    assert s.n_quarters == 8 and s.in_scope_forms == Settings().in_scope_forms


def submission(t, adsh, **more):
    t.raw("sub", **{**dict(adsh=adsh, cik=1, name="OLD CO", sic=3571, fye="1231", form="10-K", period="20241231",
                           fy=2024, fp="FY", filed="20250215"), **more})


def test_dimensions_and_facts(spark):
    t = Tables()
    submission(t, A1, period="20231231", filed="20240215", sic=6022)
    submission(t, A2, name="NEW CO", sic=None, fye=None)
    submission(t, A2, name="STALE CO", dataset_quarter="2024q4")
    submission(t, "8", form="8-K", period="20241399", filed="20250301", name="NEWEST CO", sic=None, fye="9931")
    submission(t, "x", cik=2, sic=0, fye=None, form="10-Q", period="20240630")
    number = dict(adsh=A2, tag="Revenues", version="us-gaap/2024", qtrs=1, uom="USD", ddate="20240331", value=5.0)
    t.raw("num", **number)
    t.raw("num", **{**number, "value": 7.0}, dataset_quarter="2025q2")
    t.raw("num", **{**number, "value": None, "qtrs": 2})
    t.raw("num", **{**number, "adsh": "8"})
    t.raw("num", **{**number, "ddate": "2024033"})
    t.raw("num", **{**number, "version": A2, "coreg": "Sub"})
    w = t.warehouse(spark)
    company = {r["cik"]: r for r in w["dim_company"].collect()}
    one = company[1]
    assert (one["name"], one["sic"], one["sector"], one["is_financial"]) == (
        "NEWEST CO", 6022, "Finance, Insurance & Real Estate", True)
    assert (one["fye"], one["fiscal_year_end_month"], one["fiscal_year_end_assumed"]) == ("1231", 12, False)
    assert (one["n_filings"], one["n_in_scope_filings"], one["n_annual"], one["n_quarterly"]) == (3, 2, 2, 0)
    two = company[2]
    assert (two["sic"], two["sector"], two["fiscal_year_end_month"], two["fiscal_year_end_assumed"]) == (
        None, "Unknown", 12, True)
    filing = {r["adsh"]: r for r in w["dim_filing"].collect()}
    assert filing["8"]["period"] is None and not filing["8"]["in_scope"] and filing["8"]["report_type"] == "other"
    assert filing[A1]["edgar_url"].endswith(f"/1/000000000124000001/{A1}-index.htm")
    facts = w["fact_financial_facts"].orderBy("version").collect()
    assert len(facts) == 2
    custom, plain = facts
    assert plain["value"] == 7.0 and (plain["fiscal_year"], plain["fiscal_quarter"]) == (2024, 1)
    assert plain["period_key"] == "20240331-1" and plain["is_consolidated"] and not plain["is_current_period"]
    assert custom["is_custom_tag"] and not custom["is_consolidated"]
    periods = {r["period_key"]: r for r in w["dim_period"].collect()}
    assert periods["20240331-1"]["period_start"] == date(2024, 1, 1)
    assert periods["20240331-2"]["period_type"] == "half_year_ytd"


def test_restatements(spark):
    t = Tables()
    for tag, first, second in (("Revenues", 100, 110), ("Assets", 500, 500.3), ("NetIncomeLoss", 7, 7)):
        t.fact(tag, first, A1, filed="2024-02-15")
        t.fact(tag, second, A2, filed="2025-02-15")
    rows = {(r["tag"], r["adsh"]): r for r in
            restatements(fact_versions(t.frame(spark, "fact_financial_facts")), 0.001).collect()}
    assert len(rows) == 4
    assert rows["Revenues", A2]["is_authoritative"] and not rows["Revenues", A1]["is_authoritative"]
    old = rows["Revenues", A1]
    assert (old["authoritative_value"], old["classification"], old["n_versions"]) == (110, "restatement", 2)
    assert old["delta"] == -10 and old["rel_diff"] == pytest.approx(10 / 110)
    assert rows["Revenues", A2]["group_max_rel_diff"] == pytest.approx(10 / 110)
    assert rows["Assets", A1]["classification"] == "rounding_diff"
    facts = t.frame(spark, "fact_financial_facts")
    repeated = repeated_facts(facts)
    assert {(r["tag"], r["first_adsh"], r["last_adsh"]) for r in repeated.collect()} == {
        (tag, A1, A2) for tag in ("Revenues", "Assets", "NetIncomeLoss")}
    disputed = disputed_versions(facts, repeated)
    assert disputed.select("tag").distinct().count() == 2
    again = restatements(disputed, 0.001)
    assert again.count() == 4 and again.exceptAll(restatements(fact_versions(facts), 0.001)).count() == 0


def test_amendment_wins_a_tie(spark):
    t = Tables()
    t.fact("Revenues", 100, A3, filed="2024-02-15")
    t.fact("Revenues", 105, A1, form="10-K/A", filed="2024-02-15")
    winner = restatements(t.frame(spark, "fact_financial_facts"), 0.001).where("is_authoritative").collect()
    assert [r["adsh"] for r in winner] == [A1]


def test_normalization(spark):
    t = Tables()
    for tag in ("Revenues", "SalesRevenueNet"):
        t.tag(tag, "monetary", "D")
    t.tag("Assets", "shares")
    t.fact("SalesRevenueNet", 9, A2, qtrs=4, filed="2025-02-15")
    t.fact("Revenues", 100, A1, qtrs=4, filed="2024-02-15")
    t.fact("Revenues", 110, A2, qtrs=4, filed="2025-02-15")
    t.fact("Revenues", 70, A2, qtrs=4, uom="EUR", filed="2025-02-15")   # not the currency of the filing
    t.fact("Assets", 1, A2)                                            # declared with another datatype
    row, = t.warehouse(spark, "fact_normalized")["fact_normalized"].collect()
    assert (row["metric"], row["value"], row["source_adsh"], row["alias_rank"]) == ("revenue", 110, A2, 1)
    assert (row["n_candidates"], row["n_sources"], row["n_distinct_values"]) == (3, 2, 3)
    assert row["is_restated"] and row["resolution_reason"] == "alias_priority=1;authoritative=latest_filed;restated"


def test_derivations_in_order(spark):
    t = Tables()
    t.norm("equity_parent", 40, adsh="a", filed="2025-01-01")
    t.norm("minority_interest", 10, adsh="b", filed="2025-02-01")
    t.norm("liabilities_and_equity", 200, adsh="a", filed="2025-01-01")
    t.norm("revenue", 100, qtrs=4)
    t.norm("cost_of_revenue", 60, qtrs=4)
    t.norm("gross_profit", 39, qtrs=4)
    rows = {r["metric"]: r for r in derive(t.frame(spark, "fact_normalized"), Settings()).collect()}
    assert set(rows) == {"equity_incl_nci", "total_liabilities"}
    total = rows["equity_incl_nci"]
    assert (total["value"], total["source_adsh"], total["n_sources"]) == (50, "b", 2)
    assert (total["source_tag"], total["alias_rank"], total["status"]) == (
        "derived:+equity_parent +minority_interest", 99, "derived")
    assert rows["total_liabilities"]["value"] == 150 and rows["total_liabilities"]["source_adsh"] == "b"


# ---- ratios -------------------------------------------------------------------------------------------------

def evaluate(spark, *cases):
    """{case: {ratio: row}} for input dictionaries; a value may be a (value, adsh, status) triple."""
    kind = "struct<value:double,adsh:string,tag:string,status:string,currency:string>"
    names = ratios.INPUTS
    schema = ("basis string, cik bigint, period_end date, fiscal_year int, fiscal_quarter int, "
              + ", ".join(f"{n} {kind}" for n in names))
    rows = []
    for i, inputs in enumerate(cases):
        cells = []
        for n in names:
            given = inputs.get(n)
            value = given if isinstance(given, tuple) else (given, A, "reported")
            cells.append(None if given is None else (float(value[0]), value[1], n, value[2], "USD"))
        rows.append(("FY", i, day("2024-12-31"), 2024, 4, *cells))
    out = ratios.fact_ratios(spark.createDataFrame(rows, schema)).collect()
    return [{r["ratio"]: r for r in out if r["cik"] == i} for i in range(len(cases))]


def test_ratio_values_and_reasons(spark):
    cases = [
        ({}, {n: (None, None) for n in ratios.RATIOS}),
        (dict(revenue=100, cost_of_revenue=60, gross_profit=45), {"gross_margin": (0.45, "")}),
        (dict(revenue=100, cost_of_revenue=60), {"gross_margin": (0.40, "")}),
        (dict(revenue=0, gross_profit=5), {"gross_margin": (None, "zero_denominator:revenue")}),
        (dict(revenue=100), {"gross_margin": (None, "missing:gross_profit|cost_of_revenue"),
                             "yoy_revenue_growth": (None, "prior_period_not_found"),
                             "net_margin": (None, "missing:net_income")}),
        (dict(revenue=200, operating_income=50, net_income=-20), {"operating_margin": (0.25, ""),
                                                                  "net_margin": (-0.1, "")}),
        (dict(current_assets=300, current_liabilities=150),
         {"current_ratio": (2.0, ""), "quick_ratio": (2.0, "assumes_zero:inventory"), "working_capital": (150, "")}),
        (dict(current_assets=300, current_liabilities=150, inventory=60), {"quick_ratio": (1.6, "")}),
        (dict(current_assets=300, current_liabilities=0),
         {"current_ratio": (None, "zero_denominator:current_liabilities")}),
        (dict(short_term_borrowings=10, ltd_current=20, ltd_noncurrent=70, equity_parent=50),
         {"debt_to_equity": (2.0, "")}),
        (dict(ltd_noncurrent=70, equity_parent=50),
         {"debt_to_equity": (1.4, "assumes_zero:short_term_borrowings,ltd_current")}),
        (dict(equity_parent=50), {"debt_to_equity": (None, "missing:short_term_borrowings|ltd_current|ltd_noncurrent"),
                                  "liabilities_to_equity": (None, "missing:total_liabilities")}),
        (dict(ltd_noncurrent=70, equity_parent=-5, total_liabilities=9, net_income=1),
         {"debt_to_equity": (None, "non_positive_equity"), "liabilities_to_equity": (None, "non_positive_equity"),
          "roe": (None, "non_positive_equity")}),
        (dict(net_income=10, total_assets=200, equity_parent=40, revenue=300),
         {"roa": (0.05, ""), "roe": (0.25, ""), "asset_turnover": (1.5, "")}),
        (dict(net_income=10, total_assets=0), {"roa": (None, "non_positive_denominator:total_assets")}),
        (dict(operating_cash_flow=100, capex=30), {"free_cash_flow": (70, "")}),
        (dict(operating_cash_flow=100), {"free_cash_flow": (None, "missing:capex")}),
        (dict(revenue=110, revenue_prior_year=100), {"yoy_revenue_growth": (0.1, "")}),
        (dict(revenue=110, revenue_prior_year=0), {"yoy_revenue_growth": (None, "non_positive_prior_revenue")}),
        (dict(revenue=1e308, total_assets=1e-10), {"asset_turnover": (None, "non_finite_result")}),
    ]
    for got, (_, expected) in zip(evaluate(spark, *[c[0] for c in cases]), cases):
        assert set(got) == set(ratios.RATIOS)
        for name, (value, reason) in expected.items():
            row = got[name]
            assert row["value"] == (None if value is None else pytest.approx(value)), (name, row)
            assert reason is None or row["reason"] == reason
            assert (row["status"] == "null") == (row["value"] is None)
            assert row["value"] is not None or row["reason"]


def test_ratio_lineage(spark):
    other = "0000000001-25-000002"
    row = evaluate(spark, dict(revenue=100, net_income=(20, f"{A}+{other}", "derived_from_ytd"), inventory=1,
                               current_assets=(5, A, "derived"), current_liabilities=2))[0]
    margin = row["net_margin"]
    assert (margin["status"], margin["reason"]) == ("derived", "uses_derived_input:net_income")
    assert margin["source_adshs"] == [A, other]
    inputs = json.loads(margin["inputs_json"])
    assert list(inputs) == ["net_income", "revenue"]
    assert inputs["revenue"] == {"value": 100.0, "adsh": A, "tag": "revenue", "status": "reported"}
    assert row["quick_ratio"]["status"] == "derived" and row["roa"]["inputs_json"] == "{}"


# --- fixed values: figures of two published annual reports and ratios worked out by hand -------------------
PUBLISHED = [
    (dict(revenue=391035e6, cost_of_revenue=210352e6, gross_profit=180683e6, operating_income=123216e6,
          net_income=93736e6, total_assets=364980e6, total_liabilities=308030e6, equity_parent=56950e6,
          current_assets=152987e6, current_liabilities=176392e6, inventory=7286e6, short_term_borrowings=9967e6,
          ltd_current=10912e6, ltd_noncurrent=85750e6, operating_cash_flow=118254e6, capex=9447e6,
          revenue_prior_year=383285e6),
     dict(gross_margin=0.4621, operating_margin=0.3151, net_margin=0.2397, current_ratio=0.8673, quick_ratio=0.8260,
          debt_to_equity=1.8723, liabilities_to_equity=5.4088, roa=0.2568, roe=1.6459, asset_turnover=1.0714,
          free_cash_flow=108807e6, working_capital=-23405e6, yoy_revenue_growth=0.0202)),
    (dict(revenue=245122e6, cost_of_revenue=74114e6, gross_profit=171008e6, operating_income=109433e6,
          net_income=88136e6, total_assets=512163e6, total_liabilities=243686e6, equity_parent=268477e6,
          current_assets=159734e6, current_liabilities=125286e6, operating_cash_flow=118548e6, capex=44477e6,
          revenue_prior_year=211915e6),
     dict(gross_margin=0.6976, operating_margin=0.4464, net_margin=0.3596, current_ratio=1.2750,
          liabilities_to_equity=0.9077, roa=0.1721, roe=0.3283, asset_turnover=0.4786, free_cash_flow=74071e6,
          working_capital=34448e6, yoy_revenue_growth=0.1567)),
]


def test_published_figures(spark):
    for got, (_, expected) in zip(evaluate(spark, *[p[0] for p in PUBLISHED]), PUBLISHED):
        for name, value in expected.items():
            assert got[name]["value"] == pytest.approx(value, abs=0.5 if abs(value) >= 1000 else 5e-5), name
            assert got[name]["status"] == "ok" and got[name]["source_adshs"] == [A]


def test_ratio_inputs(spark):
    t = Tables()
    for end, qtrs, value in (("2024-03-31", 1, 100), ("2024-06-30", 2, 220), ("2024-12-31", 4, 480),
                             ("2023-12-31", 4, 400), ("2024-09-30", 3, 350), ("2022-11-30", 4, 300)):
        t.norm("revenue", value, end, qtrs, adsh=f"r{end}")
    t.norm("total_assets", 9, "2024-12-31")
    t.norm("total_assets", 9, "2020-12-31")
    rows = ratios.ratio_rows(t.frame(spark, "fact_normalized"))
    got = {(r["basis"], str(r["period_end"]), r["metric"]): r for r in ratios.ratio_inputs(rows).collect()}
    q2, q4 = got["Q", "2024-06-30", "revenue"], got["Q", "2024-12-31", "revenue"]
    assert (q2["value"], q2["source_adsh"], q2["source_tag"]) == (
        120, "r2024-06-30+r2024-03-31", "ytd2(revenue)-ytd1")
    assert (q4["value"], q4["status"]) == (130, "derived_from_ytd")
    assert got["FY", "2024-12-31", "revenue"]["value"] == 480
    assert ("Q", "2024-12-31", "total_assets") in got and ("FY", "2020-12-31", "total_assets") not in got
    assert got["FY", "2024-12-31", "revenue_prior_year"]["value"] == 400
    assert got["FY", "2023-12-31", "revenue_prior_year"]["value"] == 300  # a month off is near enough
    assert ("FY", "2022-11-30", "revenue_prior_year") not in got


# ---- ranks and sectors --------------------------------------------------------------------------------------

@pytest.fixture
def sector_tables():
    t = Tables()
    for cik in range(1, 8):
        t.company(cik, f"CO {cik}", sector="Manufacturing" if cik < 6 else "Services")
    for cik, value, end in ((1, .40, "2023-12-31"), (1, .45, "2024-12-31"), (2, .45, "2024-12-31"),
                            (3, .10, "2022-12-31"), (3, .30, "2024-12-31"), (4, .60, "2023-12-31"),
                            (4, None, "2024-12-31"), (5, None, "2024-12-31"), (6, .2, "2024-06-30"),
                            (7, .8, "2024-06-30")):
        t.ratio(cik, "gross_margin", value, end)
    t.ratio(3, "gross_margin", .99, basis="Q")
    t.ratio(1, "roa", .05)
    t.ratio(3, "roa", -.02)
    return t


def test_sector_latest(spark, sector_tables):
    w = sector_tables.warehouse(spark)
    rows = {r["cik"]: r for r in w["sector_ratio_latest"].where("ratio = 'gross_margin'").collect()}
    assert set(rows) == {1, 2, 3, 4, 6, 7} and rows[4]["value"] == .60
    assert rows[1]["pct_rank"] == rows[2]["pct_rank"] == 0.25 and rows[1]["n_companies"] == 4
    assert (rows[3]["pct_rank"], rows[4]["pct_rank"], rows[7]["pct_rank"]) == (0, 0.75, 0.5)
    spread = {(r["sector"], r["ratio"]): r for r in sector.sector_quantiles(w["sector_ratio_latest"]).collect()}
    assert spread["Manufacturing", "gross_margin"]["p50"] == pytest.approx(0.45)
    assert spread["Manufacturing", "gross_margin"]["p90"] == pytest.approx(0.555)
    bars = sector.sector_histogram(w["sector_ratio_latest"]).where("sector = 'Services'").collect()
    assert sorted((b["bin"], b["n"]) for b in bars) == [(0, 1), (39, 1)]


def test_sector_yearly(spark, sector_tables):
    rows = {(r["sector"], r["ratio"], r["fiscal_year"]): r for r in
            sector_tables.warehouse(spark)["sector_ratio_yearly"].collect()}
    assert rows["Manufacturing", "gross_margin", 2024]["median_value"] == pytest.approx(.45)
    assert rows["Manufacturing", "gross_margin", 2023]["median_value"] == pytest.approx(.5)
    assert rows["Manufacturing", "gross_margin", 2023]["n_companies"] == 2


def test_ranks_against_one_window(spark):
    df = spark.range(4000).select(
        (F.col("id") % 3).alias("k"),
        F.when(F.col("id") % 4 == 0, F.lit(7.25)).otherwise((F.hash("id") % 1000) * F.pow(F.lit(10.0), F.col("id") % 9 - 4))
        .alias("v"))
    expected = df.selectExpr("k", "v", "rank() OVER (PARTITION BY k ORDER BY v) - 1 AS n_below",
                             "count(*) OVER (PARTITION BY k) AS n_group",
                             "count(*) OVER (PARTITION BY k, v) AS n_equal").distinct()
    got = value_ranks(df, ["k"], "v").select(expected.columns)
    assert got.count() == expected.count() and got.exceptAll(expected).count() == 0
    medians = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", {"mid": 0.5, "high": 0.95}).collect()}
    for r in df.groupBy("k").agg(F.median("v").alias("mid"), F.percentile("v", 0.95).alias("high")).collect():
        assert medians[r["k"]]["mid"] == pytest.approx(r["mid"])
        assert medians[r["k"]]["high"] == pytest.approx(r["high"])


def test_ranks_of_concentrated_values(spark):
    """Nine tenths of the values lie within a millionth of each other, and some repeat."""
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'b' ELSE 'a' END AS k",
        "CASE WHEN id % 10 = 0 THEN CAST(id AS double) - 1500 WHEN id % 7 = 0 THEN 2 ELSE 2 + pow(id / 3000, 3) * 1e-6 END AS v")
    rows = df.collect()
    got = {(r["k"], r["v"]): (r["n_equal"], r["n_below"], r["n_group"]) for r in value_ranks(df, ["k"], "v", most=100).collect()}
    want = {}
    for k in "ab":
        values = sorted(r["v"] for r in rows if r["k"] == k)
        for i, v in enumerate(values):
            want.setdefault((k, v), (values.count(v), i, len(values)))
    assert got == want
    sizes = in_pieces(df.groupBy("k", "v").count(), ["k"], "v", most=100).groupBy("k", "_slot", "_piece").count().collect()
    assert max(r["count"] for r in sizes) <= 400 and max(r["_piece"] for r in sizes) >= 5
