"""Freshness gates, post-checks and sanity checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import reports

SOURCE_MAX_LAG_DAYS = 1
REPORT_MAX_LAG_DAYS = 2
MIN_FACT_ROWS = 1_000_000


def freshness(df: DataFrame, at: str, as_of: dt.date, max_lag_days: int) -> DataFrame:
    """One row: latest time, age in days and ``ok``; an empty table is not ok."""
    lag = F.date_diff(F.lit(as_of), F.to_date("latest"))
    return (df.agg(F.max(at).alias("latest"))
            .withColumn("lag_days", lag)
            .withColumn("ok", F.coalesce(F.col("lag_days") <= max_lag_days, F.lit(False))))


def source_gate(df: DataFrame, at: str, as_of: dt.date, max_lag_days: int = SOURCE_MAX_LAG_DAYS) -> dt.datetime:
    """Raise when a source is empty or too old, else give its latest time."""
    row = freshness(df, at, as_of, max_lag_days).first()
    if row.latest is None:
        raise RuntimeError("source is empty")
    if not row.ok:
        raise RuntimeError(f"source is stale: latest {row.latest}, {row.lag_days} days before {as_of}")
    return row.latest


def freshness_warning(fact: DataFrame, as_of: dt.date, max_lag_days: int = REPORT_MAX_LAG_DAYS) -> DataFrame:
    """One row with a warning text, NULL when the fact is current."""
    stale = F.concat(F.lit("data may be stale: latest activity is "), F.date_format("latest", "yyyy-MM-dd"),
                     F.lit(", "), F.col("lag_days").cast("string"), F.lit(" days ago"))
    return freshness(fact, "created_at", as_of, max_lag_days).select(
        "latest", "lag_days",
        F.when(F.col("latest").isNull(), F.lit("fact is empty")).when(~F.col("ok"), stale).alias("warning"))


def _check(name: str, ok: Column, detail: Column) -> Column:
    return F.struct(F.lit(name).alias("check"), F.coalesce(ok, F.lit(False)).alias("ok"),
                    detail.cast("string").alias("detail"))


def _as_rows(one_row: DataFrame, *checks: Column) -> DataFrame:
    return one_row.select(F.inline(F.array(*checks)))


def pair(*names: str) -> Column:
    parts = []
    for n in names:
        parts += [F.lit(f"{n}="), F.coalesce(F.col(n).cast("string"), F.lit("null")), F.lit(" ")]
    return F.trim(F.concat(*parts))


def post_check(fact: DataFrame, users: DataFrame, calls: DataFrame, as_of: dt.date,
               min_rows: int = MIN_FACT_ROWS, max_lag_days: int = SOURCE_MAX_LAG_DAYS) -> DataFrame:
    """Did a rebuild land: fact age and size, dimension size, latest call."""
    facts = fact.agg(F.max("created_at").alias("fact_max"), F.count(F.lit(1)).alias("fact_rows"))
    one = facts.select(
        "*", users.agg(F.count(F.lit(1))).scalar().alias("user_rows"),
        calls.agg(F.max("created_at")).scalar().alias("call_max"),
        F.date_diff(F.lit(as_of), F.to_date("fact_max")).alias("lag_days"))
    return _as_rows(
        one,
        _check("fact_is_fresh", F.col("lag_days") <= max_lag_days, pair("lag_days")),
        _check("fact_is_large", F.col("fact_rows") >= min_rows, pair("fact_rows")),
        _check("users_present", F.col("user_rows") > 0, pair("user_rows")),
        _check("calls_present", F.col("call_max").isNotNull(), F.date_format("call_max", "yyyy-MM-dd HH:mm:ss")))


def report_sanity(fact: DataFrame, month: int, year: int) -> DataFrame:
    """Order of the funnel counts of a month."""
    return _as_rows(
        reports.funnel(fact, month, year),
        _check("enrolls_within_leads", (F.col("Leads") == 0) | (F.col("Enrolls") <= F.col("Leads")),
               pair("Enrolls", "Leads")),
        _check("same_month_within_enrolls", F.col("Same_Month_Enrolls") <= F.col("Enrolls"),
               pair("Same_Month_Enrolls", "Enrolls")))


def reconciliation(fact: DataFrame, month: int, year: int) -> DataFrame:
    """Leads of the source and segment breakdowns against the total."""
    dims = {"by_source": "source_attribution_final", "by_segment": "lead_segment"}
    leads = reports.in_month(fact, month, year).filter(
        reports.funnel_flags()["Leads"] & F.col("lead_id").isNotNull()).select("lead_id", *dims.values()).distinct()
    # a lead has few sources and segments; a missing one is a group of its own
    per_lead = leads.groupBy("lead_id").agg(
        *[F.size(F.collect_set(F.struct(c))).cast("bigint").alias(n) for n, c in dims.items()])
    one = per_lead.agg(F.count(F.lit(1)).alias("Leads"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in dims])
    return _as_rows(
        one,
        _check("source_leads_add_up", F.col("by_source") == F.col("Leads"), pair("by_source", "Leads")),
        _check("segment_leads_add_up", F.col("by_segment") == F.col("Leads"), pair("by_segment", "Leads")))


def demo_sanity(fact: DataFrame, users: DataFrame, level: str, month: int, year: int,
                max_unassigned: float = 0.05) -> DataFrame:
    """Completed within scheduled on every row; unassigned share of the total."""
    rows = reports.demos_with_total(fact, users, level, month, year)
    first = reports.LEVELS[level][0]
    scheduled = F.col("Demos_Tech_Scheduled")
    over = (F.col("is_total") == 0) & (F.col("Demos_Tech_Completed") > scheduled)
    one = rows.agg(
        F.count(F.when(over, 1)).alias("rows_over"),
        F.coalesce(F.max(F.when((F.col("is_total") == 0) & (F.col(first) == reports.UNASSIGNED), scheduled)),
                   F.lit(0)).alias("unassigned"),
        F.max(F.when(F.col("is_total") == 1, scheduled)).alias("total"))
    return _as_rows(
        one,
        _check("completed_within_scheduled", F.col("rows_over") == 0, pair("rows_over")),
        _check("few_unassigned", F.col("unassigned") <= F.col("total") * max_unassigned, pair("unassigned", "total")))


def ratio_checks(fact: DataFrame, month: int, year: int) -> DataFrame:
    """Ratios between 0 and 1; revenue present where there are enrolments."""
    one = reports.with_funnel_ratios(reports.funnel(fact, month, year))
    ratios = [_check(f"{r}_in_range", F.col(r).between(0, 1), F.round(r, 6)) for r in ("L2D", "L2E", "D2E", "SM_L2E")]
    revenue = _check("revenue_present",
                     (F.col("Enrolls") == 0) | (F.coalesce(F.col("Total_Sale_Value"), F.lit(0)) > 0),
                     pair("Enrolls", "Total_Sale_Value"))
    return _as_rows(one, *ratios, revenue)
