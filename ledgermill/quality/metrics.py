"""Rules over canonical metrics: identities, plausibility, continuity, outliers."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.functions import dates
from ledgermill.functions.sqltext import agree, case, struct, text, texts
from ledgermill.quality.contract import Rule, pass_unless, register, unit, verdict
from ledgermill.settings import Settings

# --- fixed values: the flows whose periods have to chain -----------------------------------------------------
CHAINED_FLOWS = ["revenue", "cost_of_revenue", "operating_income", "net_income", "operating_cash_flow"]


def _row(status: str, tag: str, observed: str, expected: str, message: str) -> str:
    return unit(status, cik="cik", adsh="adsh", period_end="period_end", qtrs="qtrs", tag=text(tag),
                observed=observed, expected=expected, diff=f"({observed}) - ({expected})", message=message)


def _within(s: Settings, a: str, b: str, kind: str) -> str:
    return agree(a, b, s.tolerance(kind), s.tolerance("abs_floor"))


def _absent(*names: str) -> str:
    return " OR ".join(f"{name} IS NULL" for name in names)


def _balance(s: Settings):
    pair = ("total_assets", "liabilities_and_equity")
    status = verdict(_absent(*pair), _within(s, *pair, "face_total_rel"))
    return (f"qtrs = 0 AND coalesce({', '.join(pair)}) IS NOT NULL",
            _row(status, "Assets", *pair, text("Assets != LiabilitiesAndStockholdersEquity")))


def _liabilities_and_equity(s: Settings):
    total = "total_liabilities + equity_incl_nci + coalesce(temporary_equity, 0D)"
    face = "liabilities_and_equity"
    circular = "coalesce(total_liabilities_status, '') <> 'reported'"
    status = verdict(f"{circular} OR {_absent('equity_incl_nci')}", _within(s, total, face, "multi_term_rel"))
    words = "Liabilities + equity (incl. NCI) + temporary equity != LiabilitiesAndStockholdersEquity"
    return f"qtrs = 0 AND {face} IS NOT NULL", _row(status, "Liabilities", total, face, text(words))


def _part_of_total(part: str, total: str, tag: str, message: str):
    def check(s: Settings):
        slack = f"greatest({s.tolerance('face_total_rel')}D * abs({total}), {s.tolerance('abs_floor')}D)"
        status = verdict(_absent(part), f"{part} - {total} <= {slack}")
        return f"qtrs = 0 AND {total} IS NOT NULL", _row(status, tag, part, total, message)
    return check


def _gross_profit(s: Settings):
    computed, stated = "revenue - cost_of_revenue", "gross_profit"
    status = verdict(_absent("revenue", "cost_of_revenue"), _within(s, computed, stated, "multi_term_rel"))
    return ("qtrs > 0 AND gross_profit_status = 'reported'",
            _row(status, "GrossProfit", computed, stated, text("Revenue - CostOfRevenue != GrossProfit")))


def _cash_flow(s: Settings):
    with_fx = "cash_change_incl_fx IS NOT NULL"
    change = "coalesce(cash_change_incl_fx, cash_change_excl_fx)"
    flows = ("operating_cash_flow + investing_cash_flow + financing_cash_flow + "
             + case((with_fx, "coalesce(fx_effect, 0D)"), otherwise="0D"))
    skip = _absent("investing_cash_flow", "financing_cash_flow", change)
    variant = case((with_fx, "'incl_fx'"), otherwise="'excl_fx'")
    return ("qtrs > 0 AND operating_cash_flow IS NOT NULL",
            _row(verdict(skip, _within(s, flows, change, "multi_term_rel")),
                 "NetCashProvidedByUsedInOperatingActivities", flows, change,
                 f"concat('op + inv + fin (+ fx) != change in cash (', {variant}, ')')"))


def _eps(s: Settings):
    implied, stated = "try_divide(net_income, weighted_shares_basic)", "eps_basic"
    close = f"abs({implied} - {stated}) <= greatest({s.tolerance('eps_rel')}D * abs({stated}), 0.01D)"
    return (f"qtrs > 0 AND {stated} IS NOT NULL",
            _row(verdict(_absent(implied), close), "EarningsPerShareBasic", implied, stated,
                 text("NetIncome / weighted basic shares != EPS basic")))


def _negative_revenue(s: Settings):
    return "metric = 'revenue'", unit(
        pass_unless("value < 0"), cik="cik", adsh="source_adsh", period_end="period_end", qtrs="qtrs",
        tag="source_tag", observed="value", expected="0", diff="value",
        message="concat('negative revenue (', source_tag, ')')")


def period_continuity(tables: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """YTD(n) = YTD(n-1) one quarter earlier + the quarter itself.

    All durations of a metric and period end sit in one row, so the quarter needs no join and the shorter
    year to date needs one equality join on a computed month end.
    """
    keys = ["cik", "metric", "period_end"]
    wide = (tables["fact_normalized"].where(f"qtrs BETWEEN 1 AND 4 AND metric IN ({texts(CHAINED_FLOWS)})")
            .groupBy(*keys).agg(*[F.expr(f"max(CASE WHEN qtrs = {n} THEN struct(value, source_adsh) END) AS d{n}")
                                  for n in (1, 2, 3, 4)]))
    before = wide.selectExpr("cik", "metric", "period_end AS before_end",
                             *[f"d{n}.value AS before{n}" for n in (1, 2, 3)])
    joined = (wide.withColumn("before_end", dates.month_end_before(F.col("period_end"), 3))
              .join(before, ["cik", "metric", "before_end"], "left"))
    chain = ", ".join(case((f"d{n} IS NOT NULL", struct({
        "qtrs": str(n), "observed": f"d{n}.value", "adsh": f"d{n}.source_adsh",
        "expected": f"before{n - 1} + d1.value"}))) for n in (2, 3, 4))
    rows = joined.selectExpr(*keys, f"explode(array_compact(array({chain}))) AS x").selectExpr(*keys, "x.*")
    status = verdict(_absent("expected"), _within(s, "observed", "expected", "multi_term_rel"))
    return rows.selectExpr(
        f"{status} AS status", "cik", "adsh", "period_end", "qtrs", "metric AS tag", "observed", "expected",
        "observed - expected AS diff",
        "concat('YTD(', qtrs, ') != YTD(', qtrs - 1, ') + quarter for ', metric) AS message")


def quarters_sum_to_annual(tables: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """Four standalone quarters against the annual value, joined on company, metric and fiscal year."""
    keys = ["cik", "metric", "fiscal_year"]
    flows = tables["fact_normalized"].where(
        f"fiscal_quarter IS NOT NULL AND metric IN ({texts(CHAINED_FLOWS)})")
    annual = (flows.where("qtrs = 4 AND fiscal_quarter = 4")
              .selectExpr(*keys, "period_end", "value AS observed", "source_adsh AS adsh"))
    quarters = (flows.where("qtrs = 1").groupBy(*keys)
                .agg(F.count_distinct("fiscal_quarter").alias("n_quarters"), F.sum("value").alias("expected")))
    status = verdict("coalesce(n_quarters, 0) < 4", _within(s, "observed", "expected", "multi_term_rel"))
    return annual.join(quarters, keys, "left").selectExpr(
        f"{status} AS status", "cik", "adsh", "period_end", "4 AS qtrs", "metric AS tag", "observed", "expected",
        "observed - expected AS diff",
        "concat('sum of Q1..Q4 != annual for ', metric, ' FY', fiscal_year) AS message")


def outliers(tables: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """Robust z against the company's own series of a metric and duration.

    A series has one value per period end, so it is bounded by the calendar and a window over it is safe.
    Both medians use the same partitioning: one shuffle for the whole rule.
    """
    series = Window.partitionBy("cik", "metric", "qtrs")
    values = tables["fact_normalized"].where("datatype IN ('monetary', 'shares')").selectExpr(
        "cik", "metric", "qtrs", "period_end", "value AS observed", "source_adsh AS adsh")
    around = values.withColumns({"n_obs": F.count(F.lit(1)).over(series),
                                 "expected": F.median("observed").over(series)})
    spread = around.selectExpr("*", "observed - expected AS diff", "abs(observed - expected) AS away").withColumns({
        "mad": F.median("away").over(series), "mean_away": F.avg("away").over(series)})
    sigma = case(("mad > 0", "1.4826D * mad"), ("mean_away > 0", "1.2533D * mean_away"))
    judged = spread.selectExpr("*", f"diff / ({sigma}) AS z")
    few = f"n_obs <= {int(s.tolerance('outlier_min_history'))}"
    status = verdict(f"{few} OR z IS NULL", f"abs(z) <= {s.tolerance('outlier_sigma')}D")
    return judged.selectExpr(
        f"{status} AS status", "cik", "adsh", "period_end", "qtrs", "metric AS tag", "observed", "expected", "diff",
        "concat('robust z = ', round(z, 1), ' against ', n_obs, ' company observations') AS message")


WIDE, LONG = "dq_wide", "fact_normalized"

register(Rule(
    "R01", "balance_sheet_identity", "identity", "error",
    "company balance-sheet date with total assets or total liabilities and equity",
    "Total assets equal liabilities and equity within 0.1% (floor 1,000). Skipped when one side is not reported.",
    source=WIDE, check=_balance))
register(Rule(
    "R02", "liabilities_plus_equity", "identity", "error",
    "company balance-sheet date with liabilities and equity",
    "Reported liabilities + total equity + temporary equity equal liabilities and equity within 0.5%. Skipped when "
    "liabilities are derived, as the check would be circular.",
    source=WIDE, check=_liabilities_and_equity))
register(Rule(
    "R04", "revenue_nonnegative", "sign", "warn", "revenue of a company, period and duration",
    "Revenue is not negative. A warning, as revenue net of interest may be negative for financial companies.",
    source=LONG, check=_negative_revenue))
register(Rule(
    "R05", "current_assets_le_total_assets", "plausibility", "error", "company balance-sheet date with total assets",
    "Current assets do not exceed total assets (0.1%). Skipped for balance sheets without current assets.",
    source=WIDE, check=_part_of_total("current_assets", "total_assets", "AssetsCurrent",
                                         text("AssetsCurrent > Assets"))))
register(Rule(
    "R06", "current_liabilities_le_total_liabilities", "plausibility", "error",
    "company balance-sheet date with total liabilities, reported or derived",
    "Current liabilities do not exceed total liabilities (0.1%). Skipped without current liabilities.",
    source=WIDE, check=_part_of_total(
        "current_liabilities", "total_liabilities", "LiabilitiesCurrent",
        "concat('LiabilitiesCurrent > Liabilities (', total_liabilities_status, ')')")))
register(Rule(
    "R07", "period_continuity", "continuity", "error", "year-to-date flow of a company, metric and period end",
    "A year to date equals the previous year to date plus the quarter within 0.5%. Skipped when either is absent.",
    build=period_continuity))
register(Rule(
    "R08", "quarters_sum_to_annual", "continuity", "error", "annual value of a company, metric and fiscal year",
    "Where all four quarters stand alone they sum to the annual value within 0.5%. Skipped otherwise.",
    build=quarters_sum_to_annual))
register(Rule(
    "R13", "outlier_robust_z", "outlier", "error", "monetary or share value of a company, metric, period and duration",
    "No value lies more than 5 robust sigmas from the company's own history. Skipped with under 9 observations or a "
    "constant history.",
    build=outliers))
register(Rule(
    "R16", "gross_profit_consistency", "identity", "error", "company flow period with a reported gross profit",
    "Revenue less cost of revenue equals reported gross profit within 0.5%. Skipped when either is absent.",
    source=WIDE, check=_gross_profit))
register(Rule(
    "R17", "cash_flow_identity", "identity", "error", "company flow period with operating cash flow",
    "Operating, investing and financing cash flow (and currency effect) equal the change in cash within 0.5%, in the "
    "variant that was reported. Skipped when a part is absent.",
    source=WIDE, check=_cash_flow))
register(Rule(
    "R18", "eps_consistency", "plausibility", "error", "company flow period with basic earnings per share",
    "Net income over weighted basic shares agrees with earnings per share within 5% (floor 0.01). Skipped without "
    "net income or shares.",
    source=WIDE, check=_eps))
