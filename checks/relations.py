"""Named relations of the yardstick, as DuckDB SQL over the driver's tables.

Written from the semantics, not from the Spark plans: where Spark aggregates structs, these use windows and
joins, and the other way round. ``statement`` puts the relations a query needs in front of it.
"""
from __future__ import annotations

import re

from ledgermill.settings import Settings
from ledgermill.sources.star import (
    CUSTOMERS_PER_COMPANY,
    DEFECTS,
    FORM_BY_PRIORITY,
    STANDARD,
    TEMPLATE,
    UNDECLARED_TAG,
)

S = Settings()


def q(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def values(rows) -> str:
    def cell(v):
        return str(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else q(v)
    return "(VALUES " + ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows) + ")"


def names(items) -> str:
    return ", ".join(q(i) for i in items)


REL: dict[str, str] = {}  # name -> SELECT

# ---- configuration ------------------------------------------------------------------------------------------

REL["template"] = f"SELECT * FROM {values(TEMPLATE)} t(idx, tag, datatype, iord, coef)"
REL["alias"] = (f"SELECT * FROM {values(S.alias_rows())} "
                "a(metric, tag, taxonomy, priority, datatype, statement)")
REL["sectors"] = f"SELECT * FROM {values(S.sector_rows())} s(major_group, sector, industry)"
REL["signed"] = "SELECT * FROM {} s(taxonomy, tag)".format(
    values([t.split(":") if ":" in t else (None, t) for t in S.non_negative_tags]))

# ---- raw tables ---------------------------------------------------------------------------------------------

_forms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FORM_BY_PRIORITY.items())
REL["raw_sub"] = f"""
SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS adsh, cik, 'Company ' || lpad(CAST(cik AS VARCHAR), 8, '0') AS name,
  CASE WHEN o_orderkey % 10 <> 0 THEN CAST(100 + (cik % 100) * 97 AS INTEGER) END AS sic,
  CASE WHEN cik % 100 < 90 THEN lpad(CAST((o_custkey % 4 + 1) * 3 AS VARCHAR), 2, '0') || '30' END AS fye,
  CASE left(o_orderpriority, 1) {_forms} END AS form,
  CASE WHEN o_orderkey % 101 = 0 THEN '19991399' ELSE strftime(last_day(make_date(
    CAST(year(o_orderdate) AS INTEGER), CAST(quarter(o_orderdate) * 3 AS INTEGER), 1)), '%Y%m%d') END AS period,
  CAST(year(o_orderdate) + CASE WHEN o_orderkey % 53 = 0 THEN 3 ELSE 0 END AS INTEGER) AS fy,
  CASE WHEN left(o_orderpriority, 1) IN ('1', '2') AND o_orderkey % 59 <> 0 THEN 'FY'
    ELSE 'Q' || quarter(o_orderdate) END AS fp,
  strftime(CAST(o_orderdate AS DATE) + 100, '%Y%m%d') AS filed,
  year(o_orderdate) || 'q' || quarter(o_orderdate) AS dataset_quarter
FROM (SELECT *, CAST(o_custkey // {CUSTOMERS_PER_COMPANY} AS BIGINT) AS cik FROM orders)"""

_defects = " ".join(f"WHEN t.tag = '{tag}' AND {lines} THEN {factor}::DOUBLE" for tag, lines, factor in DEFECTS)
REL["raw_num"] = f"""
SELECT s.adsh, t.tag, CASE WHEN l_partkey % 50 = 7 THEN s.adsh ELSE '{STANDARD}' END AS version,
  strftime(last_day(make_date(CAST(year(l_shipdate) AS INTEGER), CAST(quarter(l_shipdate) * 3 AS INTEGER), 1)),
    '%Y%m%d') AS ddate,
  CAST(CASE WHEN t.iord <> 'I' THEN 1 + l_linenumber % 4 WHEN l_suppkey % 61 = 5 THEN 1 ELSE 0 END AS INTEGER) AS qtrs,
  CASE WHEN t.datatype = 'shares' THEN 'shares' WHEN l_suppkey % 97 = 3 THEN 'EUR'
    WHEN l_suppkey % 89 = 3 THEN 'usd' ELSE 'USD' END AS uom,
  CASE WHEN l_returnflag = 'R' THEN 'Segment=R;' END AS segments, CAST(NULL AS VARCHAR) AS coreg,
  CASE WHEN l_quantity <> 2 THEN round(CAST(t.coef AS DOUBLE)
    * CASE WHEN t.iord = 'F' THEN 1.0::DOUBLE
        ELSE (s.cik % 7 + 1) * 100000 * (1 + 0.05::DOUBLE * (year(l_shipdate) - 1995)) END
    * CASE WHEN t.iord = 'D' THEN 1 + l_linenumber % 4 ELSE 1 END
    * CASE WHEN t.idx % 7 <> l_linenumber - 1 THEN 1.0::DOUBLE WHEN l_tax > 0.065 THEN 1.05::DOUBLE
        WHEN l_tax > 0.035 THEN 1.0005::DOUBLE ELSE 1.0::DOUBLE END, 4)
    * CASE {_defects} ELSE 1.0::DOUBLE END END AS value,
  CAST(NULL AS VARCHAR) AS footnote, s.dataset_quarter
FROM lineitem l JOIN raw_sub s ON s.adsh = lpad(CAST(l_orderkey AS VARCHAR), 10, '0')
JOIN template t ON t.idx % 5 = l_partkey % 5"""

REL["raw_tag"] = f"""
SELECT n.tag, n.version, CAST(n.version <> '{STANDARD}' AS INTEGER) AS custom, 0 AS abstract, t.datatype,
  CASE t.iord WHEN 'I' THEN 'I' ELSE 'D' END AS iord, 'C' AS crdr, n.tag AS tlabel, '' AS doc, n.dataset_quarter
FROM (SELECT tag, version, min(dataset_quarter) AS dataset_quarter FROM raw_num GROUP BY tag, version) n
JOIN template t ON t.tag = n.tag WHERE t.idx <> {UNDECLARED_TAG}"""

REL["raw_pre"] = """
SELECT DISTINCT n.adsh, n.tag, n.version, CASE t.iord WHEN 'I' THEN 'BS' ELSE 'IS' END AS stmt, n.dataset_quarter
FROM raw_num n JOIN template t ON t.tag = n.tag"""

# ---- dimensions ---------------------------------------------------------------------------------------------


def as_date(column: str) -> str:
    return f"CASE WHEN regexp_full_match({column}, '[0-9]{{8}}') THEN CAST(try_strptime({column}, '%Y%m%d') AS DATE) END"


REL["filing"] = f"""
SELECT adsh, cik, name, sic, form, {as_date('period')} AS period, fy, fp, {as_date('filed')} AS filed, fye,
  dataset_quarter, suffix(form, '/A') AS amended,
  form IN ({names(S.in_scope_forms)}) AS in_scope,
  CASE left(form, 4) WHEN '10-K' THEN 'annual' WHEN '10-Q' THEN 'quarterly' ELSE 'other' END AS report_type
FROM raw_sub"""

REL["filing_order"] = """
SELECT *, row_number() OVER (PARTITION BY cik ORDER BY filed NULLS FIRST, adsh) AS seq FROM filing"""

REL["company"] = f"""
WITH picks AS (
  SELECT cik, max(seq) AS any_seq, max(seq) FILTER (WHERE sic > 0) AS sic_seq,
    max(seq) FILTER (WHERE length(fye) = 4 AND try_cast(left(fye, 2) AS INTEGER) BETWEEN 1 AND 12) AS fye_seq,
    max(seq) FILTER (WHERE report_type = 'annual' AND period IS NOT NULL) AS k_seq,
    min(filed) AS first_filed, max(filed) AS last_filed, count(*) AS n_filings,
    count_if(in_scope) AS n_in_scope_filings, count_if(report_type = 'annual') AS n_annual,
    count_if(report_type = 'quarterly') AS n_quarterly
  FROM filing_order GROUP BY cik)
SELECT p.cik, a.name, b.sic, coalesce(m.sector, 'Unknown') AS sector, coalesce(m.industry, 'Unknown') AS industry,
  m.major_group,
  coalesce(b.sic BETWEEN {S.financial_ranges[0][0]} AND {S.financial_ranges[0][1]}, false) AS is_financial,
  coalesce(c.fye, a.fye) AS fye,
  coalesce(CAST(left(c.fye, 2) AS INTEGER), CAST(month(d.period) AS INTEGER), 12) AS fiscal_year_end_month,
  c.fye IS NULL AND d.period IS NULL AS fiscal_year_end_assumed,
  first_filed, last_filed, n_filings, CAST(n_in_scope_filings AS BIGINT) AS n_in_scope_filings,
  CAST(n_annual AS BIGINT) AS n_annual, CAST(n_quarterly AS BIGINT) AS n_quarterly
FROM picks p JOIN filing_order a ON a.cik = p.cik AND a.seq = any_seq
LEFT JOIN filing_order b ON b.cik = p.cik AND b.seq = sic_seq
LEFT JOIN filing_order c ON c.cik = p.cik AND c.seq = fye_seq
LEFT JOIN filing_order d ON d.cik = p.cik AND d.seq = k_seq
LEFT JOIN sectors m ON b.sic BETWEEN m.major_group * 100 AND m.major_group * 100 + 99"""

REL["tag"] = """
SELECT DISTINCT tag, version, split_part(version, '/', 1) AS taxonomy, custom = 1 AS is_custom, datatype, iord FROM raw_tag"""

REL["period"] = f"""
SELECT DISTINCT {as_date('ddate')} AS period_end, qtrs FROM raw_num"""

# ---- facts --------------------------------------------------------------------------------------------------

REL["number"] = f"""
SELECT adsh, tag, version, {as_date('ddate')} AS period_end, qtrs, uom, segments, coreg,
  max(value) AS value
FROM raw_num n
WHERE value IS NOT NULL AND dataset_quarter = (
  SELECT max(s.dataset_quarter) FROM raw_sub s WHERE s.adsh = n.adsh)
GROUP BY adsh, tag, version, ddate, qtrs, uom, segments, coreg"""

REL["fact"] = """
SELECT n.adsh, f.cik, n.tag, n.version, split_part(n.version, '/', 1) AS taxonomy, n.version = n.adsh AS is_custom,
  n.period_end, n.qtrs, n.uom, n.value, n.segments, n.coreg, f.form, f.filed, f.report_type, f.period,
  f.amended, n.segments IS NULL AND n.coreg IS NULL AS whole, n.period_end = f.period AS is_current,
  CAST(year(n.period_end) + CASE WHEN month(n.period_end) > c.fiscal_year_end_month THEN 1 ELSE 0 END AS INTEGER)
    AS fiscal_year,
  CASE (c.fiscal_year_end_month - month(n.period_end) + 12) % 12
    WHEN 0 THEN 4 WHEN 3 THEN 3 WHEN 6 THEN 2 WHEN 9 THEN 1 END AS fiscal_quarter,
  f.dataset_quarter
FROM number n JOIN filing f ON f.adsh = n.adsh JOIN company c ON c.cik = f.cik
WHERE f.in_scope AND n.period_end IS NOT NULL"""

REL["typed"] = """
SELECT f.*, t.datatype, t.iord FROM fact f JOIN tag t ON t.tag = f.tag AND t.version = f.version"""

REL["currency"] = """
SELECT adsh, first(uom ORDER BY k DESC, uom) AS currency, max(k) AS n_monetary_facts
FROM (SELECT adsh, uom, count(*) AS k FROM typed WHERE whole AND datatype = 'monetary' GROUP BY adsh, uom)
GROUP BY adsh"""

# ---- restatements -------------------------------------------------------------------------------------------

REL["version_of"] = """
SELECT cik, tag, period_end, qtrs, uom, adsh, form, filed, amended, value, is_current, version
FROM fact WHERE whole AND NOT is_custom AND taxonomy <> 'dei'"""

REL["restated"] = f"""
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY cik, tag, period_end, qtrs, uom
      ORDER BY filed DESC, amended DESC, adsh DESC) AS place,
    count(*) OVER g AS n_versions, min(value) OVER g AS lo, max(value) OVER g AS hi
  FROM version_of WINDOW g AS (PARTITION BY cik, tag, period_end, qtrs, uom)),
differing AS (SELECT * FROM ranked WHERE n_versions > 1 AND lo <> hi),
compared AS (
  SELECT d.*, d.place = 1 AS is_authoritative, w.value AS authoritative_value, w.adsh AS authoritative_adsh,
    w.form AS authoritative_form, w.filed AS authoritative_filed, d.value - w.value AS delta,
    CASE WHEN d.value <> 0 OR w.value <> 0
      THEN abs(d.value - w.value) / greatest(abs(d.value), abs(w.value)) END AS rel_diff
  FROM differing d JOIN differing w ON w.cik = d.cik AND w.tag = d.tag AND w.period_end = d.period_end
    AND w.qtrs = d.qtrs AND w.uom = d.uom AND w.place = 1)
SELECT *, max(rel_diff) OVER k AS group_max_rel_diff,
  CASE WHEN max(rel_diff) OVER k > {S.tolerance('restatement_rel')} THEN 'restatement' ELSE 'rounding_diff' END
    AS classification
FROM compared WINDOW k AS (PARTITION BY cik, tag, period_end, qtrs, uom)"""

# ---- normalized metrics -------------------------------------------------------------------------------------

REL["candidate"] = """
SELECT f.*, a.metric, a.priority, coalesce(c.currency, 'USD') AS currency
FROM typed f JOIN alias a ON a.tag = f.tag AND a.datatype = f.datatype AND coalesce(a.taxonomy, f.taxonomy) = f.taxonomy
LEFT JOIN currency c ON c.adsh = f.adsh
WHERE f.whole AND NOT f.is_custom
  AND f.uom = CASE f.datatype WHEN 'pure' THEN f.uom WHEN 'shares' THEN 'shares' ELSE coalesce(c.currency, 'USD') END"""

REL["reported"] = """
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY cik, period_end, qtrs, metric
    ORDER BY priority, filed DESC, amended DESC, adsh DESC, version DESC) AS place FROM candidate),
counts AS (
  SELECT cik, period_end, qtrs, metric, count(*) AS n_candidates, count(DISTINCT adsh) AS n_sources,
    count(DISTINCT value) AS n_distinct_values FROM candidate GROUP BY ALL),
verdicts AS (SELECT DISTINCT cik, tag, period_end, qtrs, uom, classification FROM restated)
SELECT r.cik, r.period_end, r.qtrs, r.fiscal_year, r.fiscal_quarter, r.metric, r.datatype, r.value, r.uom, r.currency,
  r.adsh AS source_adsh, r.tag AS source_tag, r.priority AS alias_rank, r.filed AS source_filed,
  r.form AS source_form, n_candidates, n_sources, n_distinct_values,
  coalesce(v.classification, '') = 'restatement' AS is_restated, 'reported' AS status,
  concat('alias_priority=', r.priority, ';authoritative=',
    if(n_sources > 1, 'latest_filed', 'single_source'),
    CASE v.classification WHEN 'restatement' THEN ';restated' WHEN 'rounding_diff' THEN ';rounding_diff' ELSE '' END)
    AS resolution_reason
FROM ranked r JOIN counts USING (cik, period_end, qtrs, metric)
LEFT JOIN verdicts v ON v.cik = r.cik AND v.tag = r.tag AND v.period_end = r.period_end AND v.qtrs = r.qtrs
  AND v.uom = r.uom
WHERE r.place = 1"""

_COLS = ("cik, period_end, qtrs, fiscal_year, fiscal_quarter, metric, datatype, value, uom, currency, source_adsh, "
         "source_tag, alias_rank, source_filed, source_form, n_candidates, n_sources, n_distinct_values, is_restated, "
         "status, resolution_reason")

_previous = "reported"
for _i, _d in enumerate(S.derivations, start=1):
    _need = [t for _, t in _d.terms if t not in _d.optional]
    REL[f"derived_{_i}"] = f"""
SELECT {_COLS} FROM {_previous} UNION ALL
SELECT cik, period_end, qtrs, max(fiscal_year), max(fiscal_quarter), {q(_d.metric)},
  {q(S.metrics[_d.metric]['datatype'])},
  {' + '.join(f"{sign} * coalesce(max(value) FILTER (WHERE metric = '{t}'), 0)" for sign, t in _d.terms)},
  min(uom), min(currency), last(source_adsh ORDER BY source_filed, source_adsh), {q('derived:' + _d.formula)}, 99,
  max(source_filed), last(source_form ORDER BY source_filed, source_adsh), 0, count(DISTINCT source_adsh), 1,
  bool_or(is_restated), 'derived', {q(_d.reason)}
FROM {_previous} p WHERE metric IN ({names(t for _, t in _d.terms)})
  AND (cik, period_end, qtrs) NOT IN (
    SELECT (cik, period_end, qtrs) FROM {_previous} WHERE metric = {q(_d.metric)})
GROUP BY cik, period_end, qtrs
HAVING count(*) FILTER (WHERE metric IN ({names(_need)})) = {len(_need)}"""
    _previous = f"derived_{_i}"
REL["norm"] = f"SELECT {_COLS} FROM {_previous}"

REL["wide"] = """
SELECT cik, period_end, qtrs, max(fiscal_year) AS fiscal_year, max(fiscal_quarter) AS fiscal_quarter,
  last(source_adsh ORDER BY source_filed, source_adsh) AS adsh, min(currency) AS currency, """ + ", ".join(
    f"max(value) FILTER (WHERE metric = '{m}') AS {m}, any_value(status) FILTER (WHERE metric = '{m}') AS {m}_status"
    for m in S.metric_names) + " FROM norm GROUP BY cik, period_end, qtrs"

# ---- ratios -------------------------------------------------------------------------------------------------

from ledgermill.operators.ratios import FLOWS, INSTANTS  # noqa: E402

REL["flow"] = f"""
SELECT cik, period_end, qtrs, metric, value, source_adsh, source_tag, status, currency, fiscal_year, fiscal_quarter
FROM norm WHERE metric IN ({names(FLOWS)}) AND qtrs BETWEEN 1 AND 4"""
REL["quarter_flow"] = """
WITH steps AS (
  SELECT a.* EXCLUDE (value, source_adsh, source_tag, status), a.value - b.value AS value,
    a.source_adsh || '+' || b.source_adsh AS source_adsh,
    format('ytd{}({})-ytd{}', a.qtrs, a.source_tag, b.qtrs) AS source_tag, 'derived_from_ytd' AS status
  FROM flow a JOIN flow b ON b.cik = a.cik AND b.metric = a.metric AND b.qtrs = a.qtrs - 1
    AND b.period_end = last_day(a.period_end - INTERVAL 3 MONTH) WHERE a.qtrs > 1),
pool AS (SELECT * FROM flow WHERE qtrs = 1 UNION ALL BY NAME SELECT * FROM steps)
SELECT * FROM pool p WHERE qtrs = (
  SELECT min(o.qtrs) FROM pool o WHERE o.cik = p.cik AND o.period_end = p.period_end AND o.metric = p.metric)"""
REL["instant"] = f"""
SELECT cik, period_end, qtrs, metric, value, source_adsh, source_tag, status, currency, fiscal_year, fiscal_quarter
FROM norm WHERE metric IN ({names(INSTANTS)}) AND qtrs = 0"""
REL["inputs_now"] = """
WITH flows AS (
  SELECT 'FY' AS basis, * FROM flow WHERE qtrs = 4
  UNION ALL BY NAME SELECT 'Q' AS basis, * FROM quarter_flow),
periods AS (SELECT DISTINCT basis, cik, period_end FROM flows)
SELECT * EXCLUDE (qtrs) FROM flows
UNION ALL BY NAME
SELECT p.basis, i.* EXCLUDE (qtrs) FROM instant i JOIN periods p USING (cik, period_end)"""
REL["inputs"] = """
WITH revenue AS (SELECT * FROM inputs_now WHERE metric = 'revenue'),
pairs AS (
  SELECT r.basis, r.cik, r.period_end, r.fiscal_year, r.fiscal_quarter, p.value, p.source_adsh, p.source_tag, p.status,
    p.currency, row_number() OVER (PARTITION BY r.basis, r.cik, r.period_end ORDER BY
      abs(p.period_end - last_day(r.period_end - INTERVAL 12 MONTH)), p.period_end) AS place
  FROM revenue r JOIN revenue p ON p.basis = r.basis AND p.cik = r.cik
    AND p.period_end >= last_day(r.period_end - INTERVAL 13 MONTH)
    AND p.period_end <= last_day(r.period_end - INTERVAL 11 MONTH))
SELECT * FROM inputs_now UNION ALL BY NAME
SELECT * EXCLUDE (place), 'revenue_prior_year' AS metric FROM pairs WHERE place = 1"""


def _cells(name: str) -> str:
    hit = f"FILTER (WHERE metric = '{name}')"
    return (f"max(value) {hit} AS {name}, any_value(source_adsh) {hit} AS {name}_a, "
            f"any_value(status) {hit} AS {name}_s")


_ALL_INPUTS = [*FLOWS, *INSTANTS, "revenue_prior_year"]
REL["side"] = ("SELECT basis, cik, period_end, max(fiscal_year) AS fiscal_year, max(fiscal_quarter) AS fiscal_quarter, "
               "min(currency) AS currency, " + ", ".join(map(_cells, _ALL_INPUTS))
               + " FROM inputs GROUP BY basis, cik, period_end")


def _ratio(name: str, value: str, inputs: list[str], problem: str, assumed: str = "''") -> str:
    """A ratio in long form. ``problem`` is the reason for no value, or NULL."""
    derived = "concat_ws(',', " + ", ".join(f"CASE WHEN {i}_s <> 'reported' THEN '{i}' END" for i in inputs) + ")"
    return f"""
SELECT basis, cik, period_end, fiscal_year, fiscal_quarter, currency, '{name}' AS ratio,
  CASE WHEN problem IS NULL THEN raw END AS value,
  CASE WHEN problem IS NOT NULL THEN 'null' WHEN assumed <> '' THEN 'estimated' WHEN derived <> '' THEN 'derived'
    ELSE 'ok' END AS status,
  CASE WHEN problem IS NOT NULL THEN problem WHEN assumed <> '' THEN 'assumes_zero:' || assumed
    WHEN derived <> '' THEN 'uses_derived_input:' || derived ELSE '' END AS reason
FROM (SELECT *, {problem} AS problem, {value} AS raw, {assumed} AS assumed, {derived} AS derived FROM side)"""


def _missing(*inputs: str) -> str:
    parts = ", ".join(f"CASE WHEN {i} IS NULL THEN '{i}' END" for i in inputs)
    return f"WHEN {' OR '.join(f'{i} IS NULL' for i in inputs)} THEN 'missing:' || concat_ws('|', {parts})"


def _simple(name, top, bottom, test, why):
    return _ratio(name, f"{top} / {bottom}", [top, bottom],
                  f"CASE {_missing(top, bottom)} WHEN {bottom} {test} THEN '{why}' END")


_DEBT = ["short_term_borrowings", "ltd_current", "ltd_noncurrent"]
RATIO_SQL = {
    "gross_margin": """
SELECT basis, cik, period_end, fiscal_year, fiscal_quarter, currency, 'gross_margin' AS ratio,
  CASE WHEN revenue <> 0 THEN coalesce(gross_profit, revenue - cost_of_revenue) / revenue END AS value,
  CASE WHEN coalesce(revenue, 0) = 0 OR (gross_profit IS NULL AND cost_of_revenue IS NULL) THEN 'null'
    WHEN concat(CASE WHEN revenue_s <> 'reported' THEN 'r' END,
      CASE WHEN gross_profit IS NOT NULL AND gross_profit_s <> 'reported' THEN 'g' END,
      CASE WHEN gross_profit IS NULL AND cost_of_revenue_s <> 'reported' THEN 'c' END) = '' THEN 'ok'
    ELSE 'derived' END AS status,
  CASE WHEN revenue IS NULL THEN 'missing:revenue' WHEN revenue = 0 THEN 'zero_denominator:revenue'
    WHEN gross_profit IS NULL AND cost_of_revenue IS NULL THEN 'missing:gross_profit|cost_of_revenue'
    ELSE coalesce('uses_derived_input:' || nullif(concat_ws(',', CASE WHEN revenue_s <> 'reported' THEN 'revenue' END,
      CASE WHEN gross_profit IS NOT NULL AND gross_profit_s <> 'reported' THEN 'gross_profit' END,
      CASE WHEN gross_profit IS NULL AND cost_of_revenue_s <> 'reported' THEN 'cost_of_revenue' END), ''), '')
    END AS reason
FROM side""",
    "operating_margin": _simple("operating_margin", "operating_income", "revenue", "= 0", "zero_denominator:revenue"),
    "net_margin": _simple("net_margin", "net_income", "revenue", "= 0", "zero_denominator:revenue"),
    "current_ratio": _simple("current_ratio", "current_assets", "current_liabilities", "= 0",
                             "zero_denominator:current_liabilities"),
    "quick_ratio": _ratio(
        "quick_ratio", "(current_assets - coalesce(inventory, 0)) / current_liabilities",
        ["current_assets", "current_liabilities", "inventory"],
        f"CASE {_missing('current_assets', 'current_liabilities')} "
        "WHEN current_liabilities = 0 THEN 'zero_denominator:current_liabilities' END",
        "CASE WHEN inventory IS NULL THEN 'inventory' ELSE '' END"),
    "debt_to_equity": _ratio(
        "debt_to_equity", "(" + " + ".join(f"coalesce({d}, 0)" for d in _DEBT) + ") / equity_parent",
        ["equity_parent", *_DEBT],
        "CASE WHEN equity_parent IS NULL THEN 'missing:equity_parent' "
        f"WHEN coalesce({', '.join(_DEBT)}) IS NULL THEN 'missing:{'|'.join(_DEBT)}' "
        "WHEN equity_parent <= 0 THEN 'non_positive_equity' END",
        "concat_ws(',', " + ", ".join(f"CASE WHEN {d} IS NULL THEN '{d}' END" for d in _DEBT) + ")"),
    "liabilities_to_equity": _simple("liabilities_to_equity", "total_liabilities", "equity_parent", "<= 0",
                                     "non_positive_equity"),
    "roa": _simple("roa", "net_income", "total_assets", "<= 0", "non_positive_denominator:total_assets"),
    "roe": _simple("roe", "net_income", "equity_parent", "<= 0", "non_positive_equity"),
    "asset_turnover": _simple("asset_turnover", "revenue", "total_assets", "<= 0",
                              "non_positive_denominator:total_assets"),
    "free_cash_flow": _ratio("free_cash_flow", "operating_cash_flow - capex", ["operating_cash_flow", "capex"],
                             f"CASE {_missing('operating_cash_flow', 'capex')} END"),
    "working_capital": _ratio("working_capital", "current_assets - current_liabilities",
                              ["current_assets", "current_liabilities"],
                              f"CASE {_missing('current_assets', 'current_liabilities')} END"),
    "yoy_revenue_growth": _ratio(
        "yoy_revenue_growth", "revenue / revenue_prior_year - 1", ["revenue", "revenue_prior_year"],
        "CASE WHEN revenue IS NULL THEN 'missing:revenue' WHEN revenue_prior_year IS NULL THEN 'prior_period_not_found' "
        "WHEN revenue_prior_year <= 0 THEN 'non_positive_prior_revenue' END"),
}
for _name, _sql in RATIO_SQL.items():
    REL[f"ratio_{_name}"] = _sql
REL["ratio"] = " UNION ALL BY NAME ".join(f"SELECT * FROM ratio_{n}" for n in RATIO_SQL)

REL["annual"] = """
SELECT r.*, c.sector, c.name FROM ratio r JOIN company c USING (cik) WHERE basis = 'FY' AND value IS NOT NULL"""
REL["sector_latest"] = """
WITH latest AS (
  SELECT a.* FROM annual a WHERE period_end = (
    SELECT max(b.period_end) FROM annual b WHERE b.cik = a.cik AND b.ratio = a.ratio))
SELECT l.*, count(*) OVER (PARTITION BY sector, ratio) AS n_companies,
  (SELECT count(*) FROM latest o WHERE o.sector = l.sector AND o.ratio = l.ratio AND o.value < l.value) AS n_lower
FROM latest l"""

# ---- rules --------------------------------------------------------------------------------------------------

from checks.rule_relations import RULES  # noqa: E402

for _id, _sql in RULES.items():
    REL[_id] = _sql
REL["unit_rows"] = " UNION ALL BY NAME ".join(
    f"SELECT '{i}' AS rule_id, status, CAST(n AS BIGINT) AS n, cik, adsh, period_end, qtrs, tag, observed, expected, diff "
    f"FROM {i}" for i in RULES)


def _order(needed: set[str], seen: list[str], name: str) -> None:
    if name in seen:
        return
    for other in REL:
        if other != name and re.search(rf"\b(?:FROM|JOIN|from|join)\s+{other}\b", REL[name]):
            _order(needed, seen, other)
    seen.append(name)


def statement(sql: str) -> str:
    """``sql`` with the relations it reads in front of it, each computed once."""
    seen: list[str] = []
    sql = sql.strip()
    if sql.startswith("WITH"):
        sql = f"SELECT * FROM ({sql})"
    REL["_query"] = sql
    try:
        _order(set(), seen, "_query")
    finally:
        del REL["_query"]
    seen.remove("_query")
    if not seen:
        return sql.strip()
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({REL[n].strip()})" for n in seen) + "\n" + sql.strip()
