"""Rules over filings: amendments, duplicates, completeness, metadata."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.sqltext import case, text, texts
from ledgermill.quality.contract import Rule, pass_unless, register
from ledgermill.settings import Settings


def amendments(tables: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """Originals that a later amendment of the same form and period supersedes."""
    keys = ["cik", "form", "period"]
    dated = tables["dim_filing"].where("in_scope AND period IS NOT NULL").select(
        *keys, "adsh", "filed", "is_amendment")
    amended = (dated.where("is_amendment").withColumn("form", F.expr("replace(form, '/A', '')"))
               .groupBy(*keys).agg(F.expr("max(CASE WHEN filed IS NOT NULL THEN struct(filed, adsh) END) AS a")))
    originals = dated.where("NOT is_amendment").select(*keys, "adsh")
    return originals.join(amended, keys, "left").selectExpr(
        f"{pass_unless('a IS NOT NULL')} AS status", "cik", "adsh", "period AS period_end", "form AS tag",
        "concat('superseded by ', a.adsh, ' filed ', a.filed) AS message")


def duplicate_filings(tables: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """The same form and period filed more than once without an amendment mark. The message tells how often and
    by which filings first and last; the others are failing rows of the same company, form and period."""
    keys = ["cik", "form", "period"]
    originals = tables["dim_filing"].where("in_scope AND NOT is_amendment AND period IS NOT NULL").select(
        *keys, "adsh", "filed")
    placed = "struct(filed IS NULL AS undated, filed, adsh)"
    groups = originals.groupBy(*keys).agg(
        F.expr("count(*) AS k"), F.expr(f"min({placed}).adsh AS first"), F.expr(f"max({placed}).adsh AS last"))
    message = "concat('same form and period filed ', k, ' times, first as ', first, ', last as ', last)"
    return originals.join(groups.selectExpr(*keys, "k", f"{message} AS message"), keys).selectExpr(
        f"{pass_unless('k > 1')} AS status", "cik", "adsh", "period AS period_end", "form AS tag", "k AS observed",
        "1 AS expected", "k - 1 AS diff", "message")


def missing_metrics(tables: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """Mandatory metrics absent from a filing that carries a balance sheet.

    Instead of joining every required metric of every filing to the normalized facts, the metrics present for
    a company and period end are gathered once (a bounded set of flags), joined once per filing, and compared
    as arrays.
    """
    durations = {"instant": "qtrs = 0", "annual": "qtrs = 4", "quarterly": "qtrs IN (1, 2, 3)"}
    flags = {f"{m}__{kind}": f"metric = {text(m)} AND {when}"
             for m in sorted({m for names in s.mandatory.values() for m in names})
             for kind, when in durations.items()}
    flags.update({f"{m}__due": f"qtrs > 0 AND metric IN ({texts(triggers)})"
                  for m, triggers in s.conditional.items()})
    flags["has_balance_sheet"] = "qtrs = 0 AND datatype = 'monetary'"
    presence = (tables["fact_normalized"].groupBy("cik", F.col("period_end").alias("period"))
                .agg(*[F.expr(f"bool_or({condition}) AS {name}") for name, condition in flags.items()])
                .where("has_balance_sheet"))
    filings = (tables["dim_filing"]
               .where(f"in_scope AND period IS NOT NULL AND report_type IN ({texts(s.mandatory)})")
               .select("adsh", "cik", "period", "report_type", "form")
               .join(presence, ["cik", "period"])
               .join(tables["dim_company"].select("cik", "is_financial"), "cik"))
    needed, missing = [], []
    for report_type, names in s.mandatory.items():
        for m in sorted(names):
            need = f"report_type = {text(report_type)}"
            need += " AND NOT is_financial" if m in s.financial_exempt else ""
            need += f" AND {m}__due" if m in s.conditional else ""
            needed.append(f"({need})")
            missing.append(case((f"{need} AND NOT ({m}__instant OR {m}__{report_type})", text(m))))
    judged = filings.where(" OR ".join(needed)).selectExpr(
        "cik", "adsh", "period", "form", f"array_compact(array({', '.join(missing)})) AS missing")
    listed = "concat(form, ' missing: ', array_join(missing, ', '))"
    return judged.selectExpr(
        f"{pass_unless('size(missing) > 0')} AS status", "cik", "adsh", "period AS period_end",
        "get(missing, 0) AS tag", "size(missing) AS observed", "0 AS expected", "size(missing) AS diff",
        f"{case(('size(missing) > 0', listed))} AS message")


def filing_metadata(tables: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """Period, filing date, fiscal period and fiscal year of a submission agree with each other."""
    fp, fy = "coalesce(fp_reported, 'NULL')", "coalesce(string(fy_reported), 'NULL')"
    found = [
        ("period IS NULL", "'period missing'"),
        ("filed IS NULL", "'filed missing'"),
        (f"fp_reported IS NULL OR fp_reported NOT IN ({texts(s.allowed_fp)})", f"concat('fp=', {fp}, ' not allowed')"),
        ("fy_reported IS NULL OR abs(fy_reported - year(period)) > 1",
         f"concat('fy=', {fy}, ' inconsistent with period ', coalesce(string(period), 'NULL'))"),
        ("period > filed", "'period after filing date'"),
        ("report_type = 'annual' AND fp_reported <> 'FY'", "concat('10-K with fp=', fp_reported)"),
    ]
    problems = "concat_ws('; ', " + ", ".join(case(branch) for branch in found) + ")"
    status = pass_unless("message <> ''")
    return (tables["dim_filing"].where("in_scope").selectExpr("*", f"{problems} AS message")
            .selectExpr(f"{status} AS status", "cik", "adsh", "period AS period_end", "form AS tag", "message"))


register(Rule(
    "R10", "amendment_detected", "restatement", "info", "original in-scope filing",
    "An original superseded by an amendment of the same form, company and period, seen from the data.",
    build=amendments))
register(Rule(
    "R11", "duplicate_filing", "duplicate", "warn", "original in-scope filing",
    "The same company filed the same form for the same period more than once without an amendment mark.",
    build=duplicate_filings))
register(Rule(
    "R14", "missing_mandatory_tags", "completeness", "error", "annual or quarterly filing with a balance sheet",
    "A filing states the mandatory metrics of its form. Revenue is not required of financial companies, and otherwise "
    "only where cost of revenue or gross profit is stated.",
    build=missing_metrics))
register(Rule(
    "R19", "fiscal_period_validity", "referential", "error", "in-scope filing",
    "Period and filing date are present, the fiscal period is a known one, the fiscal year is within a year of the "
    "period, the period is not after the filing date, and annual reports are marked FY.",
    build=filing_metadata))
