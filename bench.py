"""Headline timings at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from crmfunnel.plans import checks, extras, measures, reports
from crmfunnel.plans.activity_fact import LEGACY, build_activity_fact
from crmfunnel.verify.env import env_of

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
MONTH, YEAR = 6, 2024


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS).config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    e = env_of(spark, SF_DIR)
    times: dict[str, float] = {}
    exchanges: dict[str, int] = {}

    def run(name: str, action) -> None:
        start = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - start, 3)

    def report(name: str, df) -> None:
        """Collect a query and count the exchanges of its final plan."""
        run(name, df.collect)
        exchanges[name] = df._jdf.queryExecution().executedPlan().toString().count("Exchange ")

    run("b06_activity_stream_written", lambda: e.staged_stream)
    run("b02_leads_written", lambda: e.staged_leads)
    run("b08_activity_fact_written", lambda: e.fact)
    run("b09_call_fact_written", lambda: e.call_fact)
    run("b11_user_hierarchy", lambda: e.users.collect())
    report("b12_legacy_fact_rows", build_activity_fact(e.raw, LEGACY).groupBy().count())
    report("r01_funnel", reports.funnel(e.fact, MONTH, YEAR))
    report("r02_funnel_by_source", reports.funnel_by_source(e.fact, MONTH, YEAR))
    report("r03_funnel_by_segment", reports.funnel_by_segment(e.fact, MONTH, YEAR))
    for i, level in enumerate(reports.LEVELS, start=4):
        report(f"r{i:02d}_demos_by_{level}", reports.demos_by(e.fact, e.users, level, MONTH, YEAR))
    report("e06_cohort_lag_long", extras.cohort_lag_long(e.fact, ["activity_month_start", "source_attribution_final"]))
    report("e07_daily_distinct_mtd", extras.daily_distinct_trend(e.fact))
    report("c05_report_sanity", checks.report_sanity(e.fact, MONTH, YEAR))
    for fact in ("activity", "call"):
        table = e.fact if fact == "activity" else e.call_fact
        for section in measures.sections(fact):
            dims = [measures.MONTH_COLUMN[fact]]
            run(f"m_{fact}_{section.split(' ', 1)[0]}",
                lambda: measures.section_report(table, fact, section, dims).collect())
    print(json.dumps({"metric": "build and report wall time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "exchanges": exchanges, "sf": SF_DIR.rsplit("sf", 1)[-1], "cpus": int(CPUS)}))


if __name__ == "__main__":
    main()
