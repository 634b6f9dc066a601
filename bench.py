"""Headline timings. Prints one JSON line.

Stages follow the pipeline: derive raw tables, build the warehouse, judge the rules, compute ratios and sector
tables. Serving queries run on the built tables; each is the median of three runs.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgermill.plans import serving  # noqa: E402
from ledgermill.plans.warehouse import Warehouse  # noqa: E402
from ledgermill.session import build_session  # noqa: E402
from ledgermill.sources.star import raw_tables  # noqa: E402

STAGES = {
    "stage_raw": ["raw_sub", "raw_num", "raw_tag", "raw_pre"],
    "stage_dims": ["dim_filing", "dim_company", "dim_tag"],
    "stage_facts": ["fact_financial_facts"],
    "stage_restatements": ["repeated_facts", "disputed_versions", "restatements"],
    "stage_normalize": ["filing_currency", "fact_reported", "fact_normalized"],
    "stage_rules": ["dq_wide", "dq_units", "dq_results", "dq_summary"],
    "stage_ratios": ["ratio_rows", "fact_ratios"],
    "stage_sector": ["sector_ratio_latest"],
}
SERVING = {
    "company_search": lambda w: serving.company_search(w, "ny 00000"),
    "company_ratio_trend": lambda w: serving.company_ratio_trend(w, 14),
    "multi_company_compare": lambda w: serving.multi_company_compare(w, [3, 14, 25, 47, 71]),
    "sector_percentile": lambda w: serving.sector_percentile(w, "Manufacturing"),
    "sector_ratio_yearly": lambda w: w["sector_ratio_yearly"],
    "dq_summary": serving.dq_page,
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", "bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        # the staged files are far below the default split size; without this a scan uses half the cores
        "spark.sql.files.openCostInBytes": "262144",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"), "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    warehouse = Warehouse(spark, raw_tables(spark, folder))
    timings: dict[str, float] = {}
    for stage, names in STAGES.items():
        started = time.perf_counter()
        warehouse.build(*names)
        timings[stage] = round(time.perf_counter() - started, 3)
    for name, plan in SERVING.items():
        runs = []
        for _ in range(4):
            started = time.perf_counter()
            plan(warehouse).collect()
            runs.append(time.perf_counter() - started)
        timings[name] = round(statistics.median(runs[1:]), 3)
    numbers = warehouse["raw_num"].count()
    built = sum(v for k, v in timings.items() if k.startswith("stage_") and k != "stage_raw")
    print(json.dumps({
        "metric": "pipeline and serving time", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": folder.rstrip("/").rsplit("sf", 1)[-1], "raw_num_rows": numbers,
        "rows_per_sec_per_core": round(numbers / built / int(cpus), 1),
        "tables": {k: round(v, 3) for k, v in warehouse.seconds.items()}}))
    spark.stop()


if __name__ == "__main__":
    main()
