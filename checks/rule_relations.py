"""The rules of the yardstick. Every relation yields the same columns; ``judge`` rows are one unit each."""
from __future__ import annotations

from ledgermill.quality.metrics import CHAINED_FLOWS
from ledgermill.settings import Settings

S = Settings()
RULES: dict[str, str] = {}

_NUM = "CAST({} AS DOUBLE) AS {}"


def _names(items) -> str:
    return ", ".join(f"'{i}'" for i in items)


def _gap(a: str, b: str, kind: str) -> str:
    """How far two amounts are beyond their tolerance; not positive when they agree."""
    rel, floor = S.tolerance(kind), S.tolerance("abs_floor")
    return f"abs(({a}) - ({b})) - greatest({rel} * abs({a}), {rel} * abs({b}), {floor})"


def _wide(observed: str, expected: str, tag: str, judged: str, skip: str, gap: str) -> str:
    return f"""
SELECT CASE WHEN {skip} THEN 'skip' WHEN ({gap}) <= 0 THEN 'pass' ELSE 'fail' END AS status, 1 AS n, cik, adsh,
  period_end, qtrs, '{tag}' AS tag, {_NUM.format(observed, 'observed')}, {_NUM.format(expected, 'expected')},
  CAST(({observed}) - ({expected}) AS DOUBLE) AS diff
FROM wide WHERE {judged}"""


RULES["r01"] = _wide("total_assets", "liabilities_and_equity", "Assets",
                     "qtrs = 0 AND NOT (total_assets IS NULL AND liabilities_and_equity IS NULL)",
                     "total_assets + liabilities_and_equity IS NULL",
                     _gap("total_assets", "liabilities_and_equity", "face_total_rel"))
_SUM = "total_liabilities + equity_incl_nci + ifnull(temporary_equity, 0)"
RULES["r02"] = _wide(_SUM, "liabilities_and_equity", "Liabilities", "qtrs = 0 AND liabilities_and_equity IS NOT NULL",
                     "total_liabilities_status IS DISTINCT FROM 'reported' OR equity_incl_nci IS NULL",
                     _gap(_SUM, "liabilities_and_equity", "multi_term_rel"))


def _at_most(part: str, total: str, tag: str) -> str:
    slack = f"greatest({S.tolerance('face_total_rel')} * abs({total}), {S.tolerance('abs_floor')})"
    return _wide(part, total, tag, f"qtrs = 0 AND {total} IS NOT NULL", f"{part} IS NULL",
                 f"{part} - ({total} + {slack})")


RULES["r05"] = _at_most("current_assets", "total_assets", "AssetsCurrent")
RULES["r06"] = _at_most("current_liabilities", "total_liabilities", "LiabilitiesCurrent")
RULES["r16"] = _wide("revenue - cost_of_revenue", "gross_profit", "GrossProfit",
                     "qtrs > 0 AND gross_profit_status = 'reported'", "revenue - cost_of_revenue IS NULL",
                     _gap("revenue - cost_of_revenue", "gross_profit", "multi_term_rel"))
_FLOWS = ("operating_cash_flow + investing_cash_flow + financing_cash_flow"
          " + if(cash_change_incl_fx IS NULL, 0, ifnull(fx_effect, 0))")
_CHANGE = "ifnull(cash_change_incl_fx, cash_change_excl_fx)"
RULES["r17"] = _wide(_FLOWS, _CHANGE, "NetCashProvidedByUsedInOperatingActivities",
                     "qtrs > 0 AND operating_cash_flow IS NOT NULL",
                     f"investing_cash_flow + financing_cash_flow + {_CHANGE} IS NULL",
                     _gap(_FLOWS, _CHANGE, "multi_term_rel"))
_IMPLIED = "net_income / nullif(weighted_shares_basic, 0)"
RULES["r18"] = _wide(_IMPLIED, "eps_basic", "EarningsPerShareBasic", "qtrs > 0 AND eps_basic IS NOT NULL",
                     f"{_IMPLIED} IS NULL",
                     f"abs({_IMPLIED} - eps_basic) - greatest({S.tolerance('eps_rel')} * abs(eps_basic), 0.01)")

RULES["r04"] = f"""
SELECT if(value < 0, 'fail', 'pass') AS status, 1 AS n, cik, source_adsh AS adsh, period_end, qtrs,
  source_tag AS tag, value AS observed, {_NUM.format('0', 'expected')}, value AS diff
FROM norm WHERE metric = 'revenue'"""

_EMPTY = ("CAST(NULL AS BIGINT) AS cik, CAST(NULL AS VARCHAR) AS adsh, CAST(NULL AS DATE) AS period_end, "
          "CAST(NULL AS INTEGER) AS qtrs, CAST(NULL AS VARCHAR) AS tag, CAST(NULL AS DOUBLE) AS observed, "
          "CAST(NULL AS DOUBLE) AS expected, CAST(NULL AS DOUBLE) AS diff")


def _counted(judged: str, extra: str = "", kinds: tuple[str, ...] = ("pass",)) -> str:
    """Failures as rows, the other kinds as one count each. ``judged`` is a SELECT with the unit columns."""
    totals = " ".join(f"UNION ALL BY NAME SELECT '{k}' AS status, count(*) FILTER (WHERE status = '{k}') AS n, "
                      f"{_EMPTY} FROM judged" for k in kinds)
    return f"WITH judged AS ({judged})\nSELECT * FROM judged WHERE status = 'fail' {totals} {extra}"


RULES["r03"] = _counted("""
  SELECT if(value < 0, 'fail', 'pass') AS status, 1 AS n, cik, adsh, period_end, qtrs, tag, value AS observed,
    CAST(0 AS DOUBLE) AS expected, value AS diff
  FROM fact f WHERE whole AND NOT is_custom
    AND EXISTS (SELECT 1 FROM signed s WHERE s.tag = f.tag AND coalesce(s.taxonomy, f.taxonomy) = f.taxonomy)""")

RULES["r07"] = f"""
SELECT CASE WHEN p.value IS NULL OR o.value IS NULL THEN 'skip'
    WHEN {_gap('y.value', 'p.value + o.value', 'multi_term_rel')} <= 0 THEN 'pass' ELSE 'fail' END AS status, 1 AS n,
  y.cik, y.source_adsh AS adsh, y.period_end, y.qtrs, y.metric AS tag, y.value AS observed,
  p.value + o.value AS expected, y.value - (p.value + o.value) AS diff
FROM norm y
LEFT JOIN norm p ON (p.cik, p.metric, p.qtrs, p.period_end)
  = (y.cik, y.metric, y.qtrs - 1, last_day(y.period_end - INTERVAL 3 MONTH))
LEFT JOIN norm o ON (o.cik, o.metric, o.qtrs, o.period_end) = (y.cik, y.metric, 1, y.period_end)
WHERE y.metric IN ({_names(CHAINED_FLOWS)}) AND y.qtrs BETWEEN 2 AND 4"""

RULES["r08"] = f"""
WITH parts AS (
  SELECT cik, metric, fiscal_year, sum(value) AS total FROM norm
  WHERE qtrs = 1 AND fiscal_quarter IS NOT NULL AND metric IN ({_names(CHAINED_FLOWS)})
  GROUP BY ALL),
full_years AS (
  SELECT cik, metric, fiscal_year FROM norm
  WHERE qtrs = 1 AND fiscal_quarter IS NOT NULL AND metric IN ({_names(CHAINED_FLOWS)})
  GROUP BY ALL HAVING count(DISTINCT fiscal_quarter) = 4)
SELECT CASE WHEN f.cik IS NULL THEN 'skip'
    WHEN {_gap('a.value', 's.total', 'multi_term_rel')} <= 0 THEN 'pass' ELSE 'fail' END AS status, 1 AS n,
  a.cik, a.source_adsh AS adsh, a.period_end, 4 AS qtrs, a.metric AS tag, a.value AS observed, s.total AS expected,
  a.value - s.total AS diff
FROM norm a
LEFT JOIN parts s ON s.cik = a.cik AND s.metric = a.metric AND s.fiscal_year = a.fiscal_year
LEFT JOIN full_years f ON f.cik = a.cik AND f.metric = a.metric AND f.fiscal_year = a.fiscal_year
WHERE a.qtrs = 4 AND a.fiscal_quarter = 4 AND a.metric IN ({_names(CHAINED_FLOWS)})"""

RULES["r09"] = _counted("""
  SELECT if(any_value(r.classification) = 'restatement', 'fail', 'pass') AS status, 1 AS n, v.cik,
    any_value(r.authoritative_adsh) AS adsh, v.period_end, v.qtrs, v.tag,
    any_value(r.authoritative_value) AS observed, first(v.value ORDER BY v.filed, v.adsh) AS expected,
    any_value(r.authoritative_value) - first(v.value ORDER BY v.filed, v.adsh) AS diff
  FROM version_of v LEFT JOIN restated r ON r.cik = v.cik AND r.tag = v.tag AND r.period_end = v.period_end
    AND r.qtrs = v.qtrs AND r.uom = v.uom AND r.adsh = v.adsh
  GROUP BY v.cik, v.tag, v.period_end, v.qtrs, v.uom HAVING count(DISTINCT v.adsh) > 1""")

RULES["r10"] = """
SELECT if(EXISTS (SELECT 1 FROM filing a WHERE a.in_scope AND a.cik = o.cik AND a.period = o.period
    AND a.form = o.form || '/A'), 'fail', 'pass') AS status, 1 AS n, cik, adsh, period AS period_end,
  CAST(NULL AS INTEGER) AS qtrs, form AS tag, CAST(NULL AS DOUBLE) AS observed, CAST(NULL AS DOUBLE) AS expected,
  CAST(NULL AS DOUBLE) AS diff
FROM filing o WHERE in_scope AND period IS NOT NULL AND NOT amended"""

RULES["r11"] = """
SELECT if(count(*) OVER g > 1, 'fail', 'pass') AS status, 1 AS n, cik, adsh, period AS period_end,
  CAST(NULL AS INTEGER) AS qtrs, form AS tag, CAST(count(*) OVER g AS DOUBLE) AS observed,
  CAST(1 AS DOUBLE) AS expected, CAST(count(*) OVER g - 1 AS DOUBLE) AS diff
FROM filing WHERE in_scope AND period IS NOT NULL AND NOT amended WINDOW g AS (PARTITION BY cik, form, period)"""

RULES["r12"] = """
WITH keyed AS (
  SELECT *, count(*) OVER k AS size, row_number() OVER k AS seq FROM raw_num
  WINDOW k AS (PARTITION BY adsh, tag, version, ddate, qtrs, uom, segments, coreg, dataset_quarter))
SELECT 'fail' AS status, size AS n, CAST(NULL AS BIGINT) AS cik, adsh,
  CAST(strptime(ddate, '%Y%m%d') AS DATE) AS period_end, qtrs, tag, CAST(size AS DOUBLE) AS observed,
  CAST(1 AS DOUBLE) AS expected, CAST(size - 1 AS DOUBLE) AS diff
FROM keyed WHERE size > 1 AND seq = 1
UNION ALL BY NAME SELECT 'pass' AS status, count(*) AS n, """ + _EMPTY + " FROM keyed WHERE size = 1"

RULES["r13"] = f"""
WITH series AS (
  SELECT *, count(*) OVER g AS k, median(value) OVER g AS med FROM norm WHERE datatype IN ('monetary', 'shares')
  WINDOW g AS (PARTITION BY cik, metric, qtrs)),
spread AS (
  SELECT cik, metric, qtrs, median(abs(value - med)) AS mad, avg(abs(value - med)) AS mean_dev
  FROM series GROUP BY cik, metric, qtrs),
scored AS (
  SELECT s.*, (value - med) / nullif(if(mad > 0, 1.4826 * mad, 1.2533 * mean_dev), 0) AS z
  FROM series s JOIN spread d ON d.cik = s.cik AND d.metric = s.metric AND d.qtrs = s.qtrs)
SELECT CASE WHEN k < {int(S.tolerance('outlier_min_history')) + 1} OR z IS NULL THEN 'skip'
    WHEN abs(z) > {S.tolerance('outlier_sigma')} THEN 'fail' ELSE 'pass' END AS status, 1 AS n, cik,
  source_adsh AS adsh, period_end, qtrs, metric AS tag, value AS observed, med AS expected, value - med AS diff
FROM scored"""

_MANDATORY = " UNION ALL ".join(
    f"SELECT '{kind}' AS report_type, unnest([{_names(metrics)}]) AS metric" for kind, metrics in S.mandatory.items())
_COND = " OR ".join(
    f"(m.metric = '{m}' AND NOT EXISTS (SELECT 1 FROM norm n WHERE n.cik = f.cik AND n.period_end = f.period "
    f"AND n.qtrs > 0 AND n.metric IN ({_names(any_of)})))" for m, any_of in S.conditional.items())
RULES["r14"] = f"""
WITH mandatory AS ({_MANDATORY}),
due AS (
  SELECT f.adsh, f.cik, f.period, f.report_type, m.metric
  FROM filing f JOIN company c ON c.cik = f.cik JOIN mandatory m ON m.report_type = f.report_type
  WHERE f.in_scope AND f.period IS NOT NULL
    AND EXISTS (SELECT 1 FROM norm b WHERE b.cik = f.cik AND b.period_end = f.period AND b.qtrs = 0
      AND b.datatype = 'monetary')
    AND NOT (c.is_financial AND m.metric IN ({_names(S.financial_exempt)})) AND NOT ({_COND})),
checked AS (
  SELECT d.*, EXISTS (SELECT 1 FROM norm n WHERE n.cik = d.cik AND n.metric = d.metric AND n.period_end = d.period
    AND (n.qtrs = 0 OR n.qtrs IN (SELECT unnest(if(d.report_type = 'annual', [4], [1, 2, 3]))))) AS there FROM due d)
SELECT if(bool_and(there), 'pass', 'fail') AS status, 1 AS n, cik, adsh, period AS period_end,
  CAST(NULL AS INTEGER) AS qtrs, min(metric) FILTER (WHERE NOT there) AS tag,
  CAST(count_if(NOT there) AS DOUBLE) AS observed, CAST(0 AS DOUBLE) AS expected,
  CAST(count_if(NOT there) AS DOUBLE) AS diff
FROM checked GROUP BY adsh, cik, period"""

RULES["r15"] = _counted("""
  SELECT CASE datatype WHEN 'shares' THEN if(uom = 'shares', 'pass', 'fail') WHEN 'pure' THEN if(uom = 'pure', 'pass', 'fail')
      ELSE if(length(uom) = 3 AND upper(uom) = uom AND regexp_full_match(uom, '[A-Z]+'), 'pass', 'fail') END AS status,
    1 AS n, cik, adsh, period_end, qtrs, tag, CAST(NULL AS DOUBLE) AS observed, CAST(NULL AS DOUBLE) AS expected,
    CAST(NULL AS DOUBLE) AS diff
  FROM typed WHERE whole AND NOT is_custom AND uom IS NOT NULL AND datatype IN ('monetary', 'shares', 'perShare', 'pure')""",
                        """
UNION ALL BY NAME
SELECT 'fail' AS status, 1 AS n, CAST(NULL AS BIGINT) AS cik, adsh, CAST(NULL AS DATE) AS period_end,
  CAST(NULL AS INTEGER) AS qtrs, tag, CAST(count(DISTINCT uom) AS DOUBLE) AS observed, CAST(1 AS DOUBLE) AS expected,
  CAST(count(DISTINCT uom) - 1 AS DOUBLE) AS diff
FROM typed WHERE whole AND NOT is_custom AND datatype = 'monetary' GROUP BY adsh, tag HAVING min(uom) <> max(uom)""")

RULES["r19"] = f"""
SELECT if(period IS NULL OR filed IS NULL OR fp IS NULL OR NOT list_contains([{_names(S.allowed_fp)}], fp)
    OR fy IS NULL OR coalesce(abs(fy - year(period)) > 1, false) OR coalesce(period > filed, false)
    OR (report_type = 'annual' AND fp <> 'FY'), 'fail', 'pass') AS status, 1 AS n, cik, adsh, period AS period_end,
  CAST(NULL AS INTEGER) AS qtrs, form AS tag, CAST(NULL AS DOUBLE) AS observed, CAST(NULL AS DOUBLE) AS expected,
  CAST(NULL AS DOUBLE) AS diff
FROM filing WHERE in_scope"""

RULES["r20"] = """
WITH lost AS (
  SELECT n.adsh, CAST(strptime(n.ddate, '%Y%m%d') AS DATE) AS period_end, n.qtrs, n.tag FROM raw_num n
    WHERE NOT EXISTS (SELECT 1 FROM raw_tag t WHERE t.tag = n.tag AND t.version = n.version)
  UNION ALL SELECT n.adsh, CAST(strptime(n.ddate, '%Y%m%d') AS DATE), n.qtrs, n.tag FROM raw_num n
    WHERE n.adsh NOT IN (SELECT adsh FROM raw_sub)
  UNION ALL SELECT p.adsh, NULL, NULL, p.tag FROM raw_pre p
    WHERE NOT EXISTS (SELECT 1 FROM raw_tag t WHERE t.tag = p.tag AND t.version = p.version))
SELECT 'fail' AS status, 1 AS n, CAST(NULL AS BIGINT) AS cik, adsh, period_end, qtrs, tag,
  CAST(NULL AS DOUBLE) AS observed, CAST(NULL AS DOUBLE) AS expected, CAST(NULL AS DOUBLE) AS diff FROM lost
UNION ALL BY NAME
SELECT 'pass' AS status, (SELECT count(*) FROM raw_num) + (SELECT count(*) FROM raw_pre) - count(*) AS n, """ + _EMPTY + """
FROM lost"""

RULES["r21"] = _counted("""
  SELECT CASE WHEN qtrs = 0 THEN if(iord = 'I', 'pass', 'skip') ELSE if(iord = 'I', 'fail', 'pass') END AS status, 1 AS n,
    cik, adsh, period_end, qtrs, tag, CAST(qtrs AS DOUBLE) AS observed, CAST(0 AS DOUBLE) AS expected,
    CAST(qtrs AS DOUBLE) AS diff
  FROM typed""", kinds=("pass", "skip"))

RULES["r22"] = _counted(f"""
  SELECT if((datatype = 'shares' AND abs(value) > {S.tolerance('magnitude_shares_max')})
      OR (datatype = 'perShare' AND abs(value) > {S.tolerance('magnitude_eps_max')})
      OR (datatype = 'monetary' AND uom = 'USD' AND abs(value) > {S.tolerance('magnitude_usd_max')}), 'fail', 'pass') AS status,
    1 AS n, cik, adsh, period_end, qtrs, tag, value AS observed, CAST(NULL AS DOUBLE) AS expected,
    CAST(NULL AS DOUBLE) AS diff
  FROM typed WHERE whole AND datatype IN ('monetary', 'shares', 'perShare')""")

RULES = dict(sorted(RULES.items()))
