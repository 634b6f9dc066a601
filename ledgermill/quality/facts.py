"""Rules over single facts: sign, unit, period kind, magnitude, and restatement.

R15, R21 and R22 judge the same join of facts and tag types, so they run in one pass over it.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.sqltext import any_of, case, struct, text, texts
from ledgermill.operators.facts import CONSOLIDATED_STANDARD
from ledgermill.operators.restatements import FACT_KEY, compared_versions, fact_versions
from ledgermill.quality.contract import Rule, counted, detail, register
from ledgermill.settings import Settings, split_tag

FACTS, TYPED = "fact_financial_facts", "typed_facts"
CURRENCY_CODE = "^[A-Z]{3}$"
SHORT_DURATION = "duration tag with sub-quarter duration (qtrs rounded to 0)"


def _fact(bad: str, **details: str) -> str:
    return counted(bad, cik="cik", adsh="adsh", period_end="period_end", qtrs="qtrs", tag="tag", **details)


def _sign(s: Settings):
    listed = [split_tag(t) for t in s.non_negative_tags]
    candidates = [f"tag IN ({texts(name for taxonomy, name in listed if taxonomy is None)})"]
    candidates += [f"(tag = {text(name)} AND taxonomy = {text(taxonomy)})" for taxonomy, name in listed if taxonomy]
    return (f"{CONSOLIDATED_STANDARD} AND {any_of(candidates)}",
            _fact("value < 0", observed="value", expected="0", diff="value",
                  message=text("negative value for a tag whose natural balance is non-negative")))


def _unit(s: Settings):
    fits = case(("datatype IN ('monetary', 'perShare')", f"uom RLIKE {text(CURRENCY_CODE)}"),
                ("datatype IN ('shares', 'pure')", "uom = datatype"))
    return (f"{CONSOLIDATED_STANDARD} AND ({fits}) IS NOT NULL",
            _fact(f"NOT ({fits})",
                  message="concat('unit ', uom, ' inconsistent with datatype ', datatype)"))


def several_currencies(tables: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """One failure per filing and monetary tag in more than one unit; distinct units are gathered, not facts."""
    units = (tables[TYPED].where(f"{CONSOLIDATED_STANDARD} AND datatype = 'monetary' AND uom IS NOT NULL")
             .select("adsh", "tag", "uom").distinct())
    per_tag = units.groupBy("adsh", "tag").agg(F.count(F.lit(1)).alias("k"),
                                               F.array_sort(F.collect_list("uom")).alias("uoms"))
    message = "concat('monetary tag reported in several currencies within one filing: ', array_join(uoms, ','))"
    return per_tag.where("k > 1").selectExpr(
        "'fail' AS status", "adsh", "tag", "k AS observed", "1 AS expected", "k - 1 AS diff", f"{message} AS message")


def _period_kind(s: Settings):
    wrong, unclear = "iord = 'I' AND qtrs > 0", "iord = 'D' AND qtrs = 0"
    right = "(iord = 'I' AND qtrs = 0) OR (iord = 'D' AND qtrs > 0)"
    details = detail(cik="cik", adsh="adsh", period_end="period_end", qtrs="qtrs", tag="tag", observed="qtrs",
                     expected="0", diff="qtrs",
                     message="concat('instant tag reported with a duration of ', qtrs, ' quarters')")
    return (f"{right} OR ({wrong}) OR ({unclear})", struct({
        "status": case((wrong, "'fail'"), (unclear, "'skip'"), otherwise="'pass'"), "n": "1L",
        "d": case((wrong, details), (unclear, detail(message=text(SHORT_DURATION))))}))


def _magnitude(s: Settings):
    limit = case(("datatype = 'monetary' AND uom = 'USD'", f"{s.tolerance('magnitude_usd_max')}D"),
                 ("datatype = 'shares'", f"{s.tolerance('magnitude_shares_max')}D"),
                 ("datatype = 'perShare'", f"{s.tolerance('magnitude_eps_max')}D"))
    return ("is_consolidated AND datatype IN ('monetary', 'shares', 'perShare')",
            _fact(f"abs(value) > ({limit})", observed="value",
                  message="concat('implausible magnitude for ', datatype, ' value in ', uom)"))


def restatement_units(tables: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """Facts in two or more filings: restated, or counted as unchanged.

    Versions are one per filing, so a fact with several is in several filings. They are compared and added up where they
    lie, without a join with the restatements.
    """
    dated = "CASE WHEN filed IS NOT NULL THEN struct(filed, adsh, value) END"
    several = (compared_versions(fact_versions(tables[FACTS])).where("n_versions > 1").groupBy(*FACT_KEY).agg(
        *[F.expr(e) for e in (
            "max(n_versions) AS n_versions", "max(group_max_rel_diff) AS largest", "max(authoritative_adsh) AS adsh",
            "max(authoritative_value) AS observed", f"min({dated}).value AS expected")]))
    restated = f"coalesce(largest > {s.tolerance('restatement_rel')}D, false)"
    message = ("concat('reported in ', n_versions, ' filings, values differ by up to ', round(largest * 100, 2), "
               "'%')")
    judged = _fact(restated, observed="observed", expected="expected",
                   diff="observed - expected", message=message)
    return several.selectExpr(f"{judged} AS u").select("u.*")


register(Rule(
    "R03", "sign_conventions", "sign", "warn",
    "consolidated fact of a tag whose natural balance is not negative",
    "Assets, liabilities, inventory, receivables, cash, cost of revenue, capital expenditure and share counts are not "
    "negative.",
    source=FACTS, check=_sign, compact=True))
register(Rule(
    "R09", "restatement_detected", "restatement", "info", "consolidated fact reported in two or more filings",
    "The same fact with values more than 0.1% apart in different filings. All versions are kept; the latest filing is "
    "authoritative.",
    build=restatement_units, compact=True))
register(Rule(
    "R15", "unit_inconsistency", "unit", "error", "consolidated fact with a typed tag",
    "The unit fits the datatype (a currency code, shares or pure), and a filing states a monetary tag in one currency.",
    source=TYPED, check=_unit, compact=True, extra=several_currencies))
register(Rule(
    "R21", "instant_duration_consistency", "referential", "error", "fact whose tag declares instant or duration",
    "Instant tags have no duration. Duration tags at zero quarters are skipped: short durations are rounded to zero.",
    source=TYPED, check=_period_kind, compact=True, always=(("pass", None), ("skip", SHORT_DURATION))))
register(Rule(
    "R22", "value_magnitude_plausibility", "plausibility", "error", "consolidated monetary, share or per-share fact",
    "Values above 1e14 US dollars, 1e13 shares or 1e5 per share point to scaling errors.",
    source=TYPED, check=_magnitude, compact=True))
