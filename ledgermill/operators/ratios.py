"""Ratio inputs and the thirteen ratios, evaluated as SQL expressions over one row per company and period."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ledgermill.functions import dates
from ledgermill.functions.sqltext import all_of, any_of, case, struct, text, texts
from ledgermill.operators.normalize import metric_cell

# --- fixed values: what the ratios read ----------------------------------------------------------------------
INSTANTS = ["total_assets", "current_assets", "current_liabilities", "total_liabilities", "equity_parent", "inventory",
            "short_term_borrowings", "ltd_current", "ltd_noncurrent"]
FLOWS = ["revenue", "cost_of_revenue", "gross_profit", "operating_income", "net_income", "operating_cash_flow",
         "capex"]
PRIOR_REVENUE = "revenue_prior_year"
INPUTS = [*FLOWS, *INSTANTS, PRIOR_REVENUE]

CELL = ["value", "adsh", "tag", "status", "currency"]
PERIOD = ["cik", "period_end"]
ROW = ["basis", *PERIOD]


# ---- inputs -------------------------------------------------------------------------------------------------

def _from_ytd(metric: str, n: int) -> str:
    """A quarter as the year to date less the year to date one quarter earlier."""
    now, before = f"{metric}_{n}", f"before_{metric}_{n - 1}"
    return case((f"{now} IS NOT NULL AND {before} IS NOT NULL", struct({
        "value": f"{now}.value - {before}.value",
        "adsh": f"concat({now}.adsh, '+', {before}.adsh)",
        "tag": f"concat('ytd{n}(', {now}.tag, ')-ytd{n - 1}')",
        "status": "'derived_from_ytd'", "currency": f"{now}.currency"})))


def _months(start: int, end: int) -> WindowSpec:
    """The periods of a company that end between ``start`` and ``end`` months from the current one's month. A company has
    at most one row per day, so a frame of months is small and a partition is bounded by the calendar."""
    return Window.partitionBy("cik").orderBy("month").rangeBetween(start, end)


def period_rows(normalized: DataFrame) -> DataFrame:
    """All instants and all flow durations of a company and period end side by side, with the standalone quarter of each
    flow (``<metric>_q``): the reported one, else the shortest year-to-date difference; and with the revenue of a year
    before (``prior_4`` and ``prior_q``).

    The narrow rows are dealt once, by company. The periods side by side, the year to date of the quarter before and the
    nearest period of the year before all come from that one exchange, the last two by frames over months.
    """
    source = normalized.selectExpr(*PERIOD, "qtrs", "fiscal_year", "fiscal_quarter", "metric", "value",
                                   "source_adsh AS adsh", "source_tag AS tag", "status", "currency")
    wanted = (f"(qtrs = 0 AND metric IN ({texts(INSTANTS)})) OR "
              f"(qtrs BETWEEN 1 AND 4 AND metric IN ({texts(FLOWS)}))")
    cells = [f"{metric_cell(m, CELL, 'qtrs = 0')} AS {m}" for m in INSTANTS]
    cells += [f"{metric_cell(m, CELL, f'qtrs = {n}')} AS {m}_{n}" for m in FLOWS for n in (1, 2, 3, 4)]
    wide = source.where(wanted).repartition("cik").groupBy(*PERIOD).agg(*[F.expr(e) for e in (
        "max(fiscal_year) AS fiscal_year", "max(fiscal_quarter) AS fiscal_quarter", *cells)])
    wide = wide.withColumn("month", dates.month_index(F.col("period_end")))
    shorter = struct({f"before_{m}_{n}": f"{m}_{n}" for m in FLOWS for n in (1, 2, 3)})
    month_end = F.when(F.col("period_end") == F.last_day("period_end"), F.expr(shorter))
    chained = wide.withColumn("before", F.max(month_end).over(_months(-3, -3))).selectExpr(*wide.columns, "before.*")
    quarters = [f"coalesce({m}_1, {', '.join(_from_ytd(m, n) for n in (2, 3, 4))}) AS {m}_q" for m in FLOWS]
    rows = chained.selectExpr(*wide.columns, *quarters)
    offered = F.when(F.expr("revenue_4 IS NOT NULL OR revenue_q IS NOT NULL"),
                     F.struct(F.col("period_end").alias("prior_end"), "revenue_4", "revenue_q"))
    near = rows.withColumn("near", F.collect_list(offered).over(_months(-13, -11)))
    return near.selectExpr(*rows.columns, f"{_nearest('revenue_4')} AS prior_4", f"{_nearest('revenue_q')} AS prior_q")


def _nearest(cell: str) -> str:
    """The cell of the period nearest to one year earlier, at most a month away, the earlier one on a tie; none for a
    period that has no such cell itself."""
    end = "last_day(add_months(period_end, {}))"
    fits = f"c -> c.{cell} IS NOT NULL AND c.prior_end BETWEEN {end.format(-13)} AND {end.format(-11)}"
    ranked = (f"transform(filter(near, {fits}), "
              f"c -> struct(abs(datediff(c.prior_end, {end.format(-12)})) AS days, c.prior_end AS prior_end, c.{cell} AS cell))")
    return case((f"{cell} IS NOT NULL", f"array_min({ranked}).cell"))


def basis_rows(periods: DataFrame) -> DataFrame:
    """One row per basis that has a flow: FY from annual durations, Q from standalone quarters. Instants apply
    to both."""
    def side(basis: str, suffix: str) -> str:
        return case((any_of(f"{m}_{suffix} IS NOT NULL" for m in FLOWS), struct({
            "basis": text(basis), **{m: f"{m}_{suffix}" for m in FLOWS}, PRIOR_REVENUE: f"prior_{suffix}"})))

    return (periods.selectExpr(*PERIOD, "fiscal_year", "fiscal_quarter", *INSTANTS,
                               f"explode(array_compact(array({side('FY', '4')}, {side('Q', 'q')}))) AS s")
            .selectExpr("s.basis", *PERIOD, "fiscal_year", "fiscal_quarter", *[f"s.{m}" for m in FLOWS], *INSTANTS,
                        f"s.{PRIOR_REVENUE}"))


def ratio_rows(normalized: DataFrame) -> DataFrame:
    """One row per basis, company and period with all inputs of the ratios as structs."""
    return basis_rows(period_rows(normalized))


def shorter_before(normalized: DataFrame) -> DataFrame:
    """Every value of a duration beyond one quarter with the next shorter one that ended a quarter earlier, where there is
    one: one window over months instead of a self join."""
    rows = normalized.select("cik", "metric", "period_end", "qtrs", "value").withColumn(
        "month", dates.month_index(F.col("period_end")))
    ended = F.when(F.col("period_end") == F.last_day("period_end"), F.struct("qtrs", "value"))
    frame = Window.partitionBy("cik", "metric").orderBy("month").rangeBetween(-3, -3)
    found = rows.withColumn("ended", F.collect_list(ended).over(frame)).where("qtrs > 1")
    return (found.selectExpr("cik", "metric", "period_end", "qtrs", "value",
                             "filter(ended, e -> e.qtrs = qtrs - 1) AS hits")
            .where("size(hits) > 0").selectExpr("cik", "metric", "period_end", "qtrs", "value", "hits[0].value AS previous"))


def ratio_inputs(rows: DataFrame) -> DataFrame:
    """The inputs in long form, one row per metric."""
    entries = ", ".join(case((f"{n} IS NOT NULL", struct({"metric": text(n), "i": n}))) for n in INPUTS)
    return (rows.selectExpr(*ROW, "fiscal_year", "fiscal_quarter", f"explode(array_compact(array({entries}))) AS e")
            .selectExpr(*ROW, "e.metric", "e.i.value", "e.i.adsh AS source_adsh", "e.i.tag AS source_tag",
                        "e.i.status", "e.i.currency", "fiscal_year", "fiscal_quarter"))


# ---- evaluation ---------------------------------------------------------------------------------------------
# A ratio is an expression for one outcome struct. It is either empty, with the reason why, or a value with the
# inputs that were assumed to be zero; both name the inputs used, in the order they are reported.

_ENTRY = "struct<key:string,value:struct<value:double,adsh:string,tag:string,status:string>>"


def _outcome(value: str, why: str, assumed: str, names: tuple[str, ...]) -> str:
    entries = ", ".join(case((f"{n} IS NOT NULL", struct({
        "key": text(n), "value": struct({f: f"{n}.{f}" for f in CELL[:4]})}))) for n in names)
    return struct({"value": f"CAST({value} AS double)", "why": f"CAST({why} AS string)", "assumed": assumed,
                   "used": f"CAST(array_compact(array({entries})) AS array<{_ENTRY}>)"})


def _none(why: str, *names: str) -> str:
    return _outcome("NULL", why, "''", names)


def _result(value: str, *names: str, assumed: str = "''") -> str:
    return _outcome(value, "NULL", assumed, names)


def _over(top: str, bottom: str) -> str:
    return f"try_divide({top}, {bottom})"


def _listing(separator: str, names: tuple[str, ...] | list[str]) -> str:
    """The names among the given ones that are absent."""
    return f"concat_ws('{separator}', " + ", ".join(case((f"{n} IS NULL", text(n))) for n in names) + ")"


def _absent(*names: str) -> tuple[str, str]:
    """The branch taken when any of the names is absent."""
    return any_of(f"{n} IS NULL" for n in names), _none(f"concat('missing:', {_listing('|', names)})")


def _quotient(top: str, bottom: str, unusable: str, why: str, order: tuple[str, str]) -> str:
    """``top / bottom`` unless an input is absent or the denominator is unusable."""
    return case(_absent(top, bottom), (f"{bottom}.value {unusable}", _none(text(why), *order)),
                otherwise=_result(_over(f"{top}.value", f"{bottom}.value"), top, bottom))


def _difference(a: str, b: str) -> str:
    return case(_absent(a, b), otherwise=_result(f"{a}.value - {b}.value", a, b))


def _on_revenue(top: str) -> str:
    return _quotient(top, "revenue", "= 0", "zero_denominator:revenue", ("revenue", top))


def _on_equity(top: str) -> str:
    return _quotient(top, "equity_parent", "<= 0", "non_positive_equity", (top, "equity_parent"))


def _on_assets(top: str) -> str:
    return _quotient(top, "total_assets", "<= 0", "non_positive_denominator:total_assets", (top, "total_assets"))


def _gross_margin() -> str:
    return case(
        ("revenue IS NULL", _none("'missing:revenue'")),
        ("revenue.value = 0", _none("'zero_denominator:revenue'", "revenue")),
        ("gross_profit IS NOT NULL", _result(_over("gross_profit.value", "revenue.value"), "revenue", "gross_profit")),
        ("cost_of_revenue IS NOT NULL",
         _result(_over("(revenue.value - cost_of_revenue.value)", "revenue.value"), "revenue", "cost_of_revenue")),
        otherwise=_none("'missing:gross_profit|cost_of_revenue'", "revenue"))


_CURRENT = ("current_assets", "current_liabilities")
_NO_LIABILITIES = "zero_denominator:current_liabilities"


def _quick_ratio() -> str:
    bottom = "current_liabilities.value"
    return case(
        _absent(*_CURRENT),
        (f"{bottom} = 0", _none(text(_NO_LIABILITIES), *_CURRENT)),
        ("inventory IS NULL", _result(_over("current_assets.value", bottom), *_CURRENT, assumed="'inventory'")),
        otherwise=_result(_over("(current_assets.value - inventory.value)", bottom), *_CURRENT, "inventory"))


def _debt_to_equity() -> str:
    parts = ["short_term_borrowings", "ltd_current", "ltd_noncurrent"]
    debt = " + ".join(f"coalesce({p}.value, 0D)" for p in parts)
    return case(
        ("equity_parent IS NULL", _none("'missing:equity_parent'")),
        (all_of(f"{p} IS NULL" for p in parts), _none(text("missing:" + "|".join(parts)), "equity_parent")),
        ("equity_parent.value <= 0", _none("'non_positive_equity'", "equity_parent", *parts)),
        otherwise=_result(_over(f"({debt})", "equity_parent.value"), "equity_parent", *parts,
                          assumed=_listing(",", parts)))


def _yoy_revenue_growth() -> str:
    return case(
        ("revenue IS NULL", _none("'missing:revenue'")),
        (f"{PRIOR_REVENUE} IS NULL", _none("'prior_period_not_found'", "revenue")),
        (f"{PRIOR_REVENUE}.value <= 0", _none("'non_positive_prior_revenue'", "revenue", PRIOR_REVENUE)),
        otherwise=_result(_over("revenue.value", f"{PRIOR_REVENUE}.value") + " - 1", "revenue", PRIOR_REVENUE))


# name -> expression of an outcome; a new ratio is one more entry
RATIOS: dict[str, str] = {
    "gross_margin": _gross_margin(),
    "operating_margin": _on_revenue("operating_income"),
    "net_margin": _on_revenue("net_income"),
    "current_ratio": _quotient(*_CURRENT, "= 0", _NO_LIABILITIES, _CURRENT),
    "quick_ratio": _quick_ratio(),
    "debt_to_equity": _debt_to_equity(),
    "liabilities_to_equity": _on_equity("total_liabilities"),
    "roa": _on_assets("net_income"),
    "roe": _on_equity("net_income"),
    "asset_turnover": _on_assets("revenue"),
    "free_cash_flow": _difference("operating_cash_flow", "capex"),
    "working_capital": _difference(*_CURRENT),
    "yoy_revenue_growth": _yoy_revenue_growth(),
}


def fact_ratios(rows: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The ratios of every row in long form. Each has a value or a reason, the inputs used, and their filings.

    A value that is not finite is none. An estimate outranks a derived input in the status.
    """
    outcomes = ", ".join(struct({"ratio": text(n), "r": RATIOS[n]}) for n in names or RATIOS)
    currency = "array_min(array_compact(array(" + ", ".join(f"{n}.currency" for n in INPUTS) + ")))"
    evaluated = (
        rows.selectExpr(*ROW, "fiscal_year", "fiscal_quarter", f"{currency} AS currency",
                        f"explode(array({outcomes})) AS x")
        .selectExpr(*ROW, "fiscal_year", "fiscal_quarter", "currency", "x.ratio", "x.r.*")
        .selectExpr("*", "value IS NOT NULL AND NOT isnan(value) AND abs(value) < double('Infinity') AS finite",
                    "array_join(transform(filter(used, e -> e.value.status <> 'reported'), e -> e.key), ',') "
                    "AS computed"))
    status = case(("why IS NOT NULL OR NOT finite", "'null'"), ("assumed <> ''", "'estimated'"),
                  ("computed <> ''", "'derived'"), otherwise="'ok'")
    reason = case(("why IS NOT NULL", "why"), ("NOT finite", "'non_finite_result'"),
                  ("assumed <> ''", "concat('assumes_zero:', assumed)"),
                  ("computed <> ''", "concat('uses_derived_input:', computed)"), otherwise="''")
    sources = ("array_distinct(filter(flatten(transform(used, e -> split(e.value.adsh, '[+]'))), a -> a <> ''))")
    return evaluated.selectExpr(
        "cik", "period_end", "basis", "fiscal_year", "fiscal_quarter", "ratio",
        "CASE WHEN finite THEN value END AS value", f"{status} AS status", f"{reason} AS reason",
        "to_json(map_from_entries(used)) AS inputs_json", f"{sources} AS source_adshs", "currency")
