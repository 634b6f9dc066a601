"""Small tables for tests: rows with defaults, and warehouses made of given tables."""
from __future__ import annotations

from datetime import date

from ledgermill.plans.warehouse import Warehouse
from ledgermill.quality.contract import rule_named
from ledgermill.quality.run import failures, run_rule, summary
from ledgermill.schema import staged
from ledgermill.settings import Settings

A = "0000000001-25-000001"

SCHEMAS = {
    "dim_filing": "adsh string, cik bigint, name string, sic int, form string, period date, fy_reported int, "
                  "fp_reported string, filed date, in_scope boolean, is_amendment boolean, report_type string, "
                  "fye string, dataset_quarter string",
    "dim_company": "cik bigint, name string, sic int, sector string, industry string, is_financial boolean, "
                   "fiscal_year_end_month int",
    "dim_tag": "tag string, version string, taxonomy string, is_custom boolean, datatype string, iord string",
    "fact_financial_facts": "adsh string, cik bigint, tag string, version string, taxonomy string, "
                            "is_custom_tag boolean, period_key string, period_end date, qtrs int, uom string, "
                            "value double, segments string, coreg string, footnote string, form string, filed date, "
                            "report_type string, filing_period date, is_consolidated boolean, "
                            "is_current_period boolean, fiscal_year int, fiscal_quarter int, dataset_quarter string",
    "fact_normalized": "cik bigint, period_end date, period_key string, qtrs int, fiscal_year int, "
                       "fiscal_quarter int, metric string, datatype string, value double, uom string, "
                       "currency string, source_adsh string, source_tag string, alias_rank int, source_filed date, "
                       "source_form string, n_candidates bigint, n_sources bigint, n_distinct_values bigint, "
                       "is_restated boolean, status string, resolution_reason string",
    "fact_ratios": "cik bigint, period_end date, basis string, fiscal_year int, fiscal_quarter int, ratio string, "
                   "value double, status string, reason string, inputs_json string, source_adshs array<string>, "
                   "currency string",
}


def day(text):
    return None if text is None else date.fromisoformat(text)


class Tables:
    """Collects rows and turns them into a warehouse."""

    def __init__(self):
        self.rows = {name: [] for name in [*SCHEMAS, "raw_sub", "raw_num", "raw_tag", "raw_pre"]}

    def company(self, cik=1, name="TEST CO", sic=3571, sector="Manufacturing", is_financial=False):
        self.rows["dim_company"].append((cik, name, sic, sector, "Computers", is_financial, 12))

    def filing(self, adsh, cik=1, form="10-K", period="2024-12-31", filed="2025-02-15", fy=2024, fp="FY",
               in_scope=True):
        kind = {"10-K": "annual", "10-Q": "quarterly"}.get(form[:4], "other")
        self.rows["dim_filing"].append((adsh, cik, "TEST CO", 3571, form, day(period), fy, fp, day(filed), in_scope,
                                        form.endswith("/A"), kind, "1231", "2025q1"))

    def tag(self, tag, datatype="monetary", iord="I", version="us-gaap/2024"):
        self.rows["dim_tag"].append((tag, version, version.split("/")[0], False, datatype, iord))

    def fact(self, tag, value, adsh=A, period_end="2024-12-31", qtrs=0, uom="USD", cik=1, version="us-gaap/2024",
             segments=None, form="10-K", filed="2025-02-15", fiscal_quarter=None):
        self.rows["fact_financial_facts"].append(
            (adsh, cik, tag, version, version.split("/")[0], version == adsh,
             f"{period_end.replace('-', '')}-{qtrs}", day(period_end), qtrs, uom, float(value), segments, None, None,
             form, day(filed), "annual" if form.startswith("10-K") else "quarterly", day(period_end),
             segments is None, True, int(period_end[:4]), fiscal_quarter, "2025q1"))

    def norm(self, metric, value, period_end="2024-12-31", qtrs=0, cik=1, adsh=A, tag=None, status="reported",
             datatype="monetary", fiscal_year=None, fiscal_quarter=None, filed="2025-02-15"):
        self.rows["fact_normalized"].append(
            (cik, day(period_end), f"{period_end.replace('-', '')}-{qtrs}", qtrs, fiscal_year or int(period_end[:4]),
             fiscal_quarter, metric, datatype, float(value), "shares" if datatype == "shares" else "USD", "USD", adsh,
             tag or metric, 1, day(filed), "10-K", 1, 1, 1, False, status, "test"))

    def ratio(self, cik, ratio, value, period_end="2024-12-31", basis="FY"):
        self.rows["fact_ratios"].append(
            (cik, day(period_end), basis, int(period_end[:4]), None, ratio, value, "null" if value is None else "ok",
             "missing:revenue" if value is None else "", "{}", [f"{cik:010d}-25-000001"], "USD"))

    def raw(self, source, /, **values):
        schema = staged(source)
        values = {"dataset_quarter": "2025q1", **values}
        self.rows[f"raw_{source}"].append(tuple(values.get(f) for f in schema.fieldNames()))

    def frame(self, spark, name):
        schema = staged(name[4:]) if name.startswith("raw_") else SCHEMAS[name]
        return spark.createDataFrame(self.rows[name], schema)

    def warehouse(self, spark, *computed) -> Warehouse:
        """All tables that have rows are given; tables named in ``computed`` are computed."""
        given = {name: self.frame(spark, name) for name, rows in self.rows.items()
                 if name not in computed and (rows or name.startswith("raw_"))}
        return Warehouse(spark, given, Settings(), write=False)

    def judge(self, spark, rule_name, *computed):
        """(pass, fail, skip) and the failing rows of one rule."""
        tables = self.warehouse(spark, *computed)
        rule = rule_named(rule_name)
        units = run_rule(rule, tables, tables.settings).selectExpr(f"'{rule.id}' AS rule_id", "*").cache()
        row = summary(units, [rule]).collect()[0]
        return (row["passed"], row["failed"], row["skipped"]), failures(units, [rule]).collect(), row
