"""Cohort lags without a cut, and month-to-date counts of distinct leads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from crmfunnel.plans import extras
from crmfunnel.verify.env import env_of

DIMS = ["activity_month_start", "source_attribution_final"]


def test_lags_add_up_to_all_enrolled(spark):
    fact = env_of(spark, "/root/testdata/sf0.01").fact
    bucket = F.col("Enroll_Month_Bucket_Capped")
    enrolled = {tuple(r[:2]): r[2] for r in fact.filter(bucket.startswith("M+") & F.col("lead_id").isNotNull())
                .groupBy(*DIMS).agg(F.countDistinct("lead_id")).collect()}
    long = {}
    for r in extras.cohort_lag_long(fact, DIMS).collect():
        long[(r[0], r[1])] = long.get((r[0], r[1]), 0) + r["enrolled"]
    assert long == enrolled
    wide = {tuple(r[:2]): sum(r[f"M{i}"] for i in range(6)) + r["M_later"] for r in extras.cohort_lag(fact, DIMS).collect()}
    assert {k: v for k, v in wide.items() if v} == enrolled
    assert max(r["lag"] for r in extras.cohort_lag_long(fact, DIMS).collect()) > 5  # lags past M+5 are kept


def test_month_to_date_counts_a_lead_once(spark):
    day = lambda d: dt.datetime(2024, 6, d, 12)
    rows = [(1, day(1)), (1, day(2)), (2, day(2)), (None, day(3)), (3, day(3)), (1, day(3))]
    fact = spark.createDataFrame(
        [(lead, at, dt.date(2024, 6, 1), "Lead Capture") for lead, at in rows] + [(4, day(2), dt.date(2024, 6, 1), "Email")],
        "lead_id long, created_at timestamp, activity_month_start date, activity_type_category string")
    got = {r["activity_date_only"].day: (r["new_leads"], r["leads_mtd_distinct"]) for r in extras.daily_distinct_trend(fact).collect()}
    assert got == {1: (1, 1), 2: (1, 2), 3: (1, 3)}
    additive = {r["activity_date_only"].day: r["leads_mtd"] for r in extras.daily_trend(fact).collect()}
    assert additive[3] == 5  # lead 1 counted on each of its three days
