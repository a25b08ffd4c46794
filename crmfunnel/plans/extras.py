"""Further operators on the facts: dates, ageing, cohorts, trends, drift."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import business_date, week_of_month, year_month_int
from ..functions.text import first_match
from ..operators.asof import as_of
from ..operators.distinct import conditional_distinct, count_flags, entity_flags, ratio
from ..operators.previous import with_previous_time

# Day ranges of ageing and sales-cycle buckets.
DAY_BUCKETS = ((7, "0-7 days"), (14, "8-14 days"), (30, "15-30 days"), (60, "31-60 days"))


def day_bucket(days: Column) -> Column:
    """Bucket of a number of days; negative days have none."""
    rules = [(label, (days >= 0) & (days <= top)) for top, label in DAY_BUCKETS]
    return first_match([*rules, ("60+ days", days > DAY_BUCKETS[-1][0])])


def is_demo_done() -> Column:
    return F.col("activity_type_category").isin("Demo Completed - Webinars", "SE Marked Demo Completed")


def with_business_date(df: DataFrame, at: str = "created_at", cutoff_minutes: int = 630) -> DataFrame:
    return df.withColumn("business_date", business_date(F.col(at), cutoff_minutes))


def event_dates(fact: DataFrame, condition: Column, name: str) -> DataFrame:
    """First and latest date of an event per lead and per lead-month.

    Two aggregates instead of windows over a lead's rows.
    """
    day = F.to_date("created_at")
    monthly = (
        fact.filter(condition & F.col("lead_id").isNotNull())
        .groupBy("lead_id", "activity_month_start")
        .agg(F.min(day).alias(f"first_{name}_month"), F.max(day).alias(f"latest_{name}_month"),
             F.count(F.lit(1)).alias(f"n_{name}_month")))
    lead = Window.partitionBy("lead_id")  # at most one row per calendar month
    return (monthly.withColumn(f"first_{name}", F.min(f"first_{name}_month").over(lead))
            .withColumn(f"latest_{name}", F.max(f"latest_{name}_month").over(lead)))


def sales_cycle(fact: DataFrame) -> DataFrame:
    """Days from a lead's first capture to its sale, with bucket."""
    first = (fact.filter((F.col("activity_type_category") == "Lead Capture") & F.col("lead_id").isNotNull())
             .groupBy("lead_id").agg(F.min(F.to_date("created_at")).alias("first_capture"),
                                     F.min("enroll_date").alias("enroll_date")))
    days = F.date_diff("enroll_date", "first_capture")
    return (first.filter(F.col("enroll_date") >= F.col("first_capture"))
            .withColumn("sales_cycle_days", days).withColumn("sales_cycle_bucket", day_bucket(days)))


def pipeline_ageing(fact: DataFrame, as_of_date) -> DataFrame:
    """Age of each lead's latest completed demo, and whether the lead has enrolled, before or after it."""
    latest = (fact.filter(is_demo_done() & F.col("lead_id").isNotNull())
              .groupBy("lead_id").agg(F.max(F.to_date("created_at")).alias("latest_demo"),
                                      F.min("enroll_date").alias("enroll_date")))
    days = F.date_diff(F.lit(as_of_date), F.col("latest_demo"))
    return (latest.withColumn("days_since_demo", days).withColumn("ageing_bucket", day_bucket(days))
            .withColumn("status", F.when(F.col("enroll_date").isNotNull(), "Converted").otherwise("Open"))
            .drop("enroll_date"))


def owner_as_of_capture(fact: DataFrame) -> DataFrame:
    """Owner of each capture: last assignment before, else first after, else snapshot."""
    known = F.col("lead_id").isNotNull()
    captures = fact.filter(known & (F.col("activity_type_category") == "Lead Capture")).select(
        "activity_id", "lead_id", "created_at", "lead_owner_id")
    assigned = fact.filter(known & (F.col("activity_type_category") == "Lead Assignment Activity")).select(
        "lead_id", F.col("created_at").alias("assigned_at"), F.col("selected_user_id_assign").alias("owner"))
    found = as_of(captures, assigned, "lead_id", "created_at", "activity_id", "assigned_at", "owner")
    return found.withColumn("owner_as_of", F.coalesce("owner_before", "owner_after", "lead_owner_id"))


def cohort_lag(fact: DataFrame, dims: Sequence[str], months: int = 5) -> DataFrame:
    """Enrolled leads per cohort and month lag, as columns M0..Mn; later lags are counted in ``M_later``."""
    bucket = F.col("Enroll_Month_Bucket_Capped")
    shown = [f"M+{i}" for i in range(months + 1)]
    flags = {f"M{i}": bucket == f"M+{i}" for i in range(months + 1)}
    flags = {"Leads": F.col("activity_type_category") == "Lead Capture", **flags,
             "M_later": bucket.startswith("M+") & ~bucket.isin(shown)}
    return conditional_distinct(fact, dims, "lead_id", flags)


def cohort_lag_long(fact: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Enrolled leads per cohort and month lag as long rows (dims, ``lag``, ``enrolled``): every lag, none cut.

    The distinct count is made in two steps (one row per cohort, lag and lead, then counts), so a cohort
    that holds most leads is combined in the map tasks.
    """
    bucket = F.col("Enroll_Month_Bucket_Capped")
    lag = F.substring(bucket, 3, 10).cast("int")
    per_lead = (fact.filter(bucket.startswith("M+") & F.col("lead_id").isNotNull())
                .select(*dims, lag.alias("lag"), "lead_id").distinct())
    return per_lead.groupBy(*dims, "lag").agg(F.count(F.lit(1)).alias("enrolled"))


def weekly_cohorts(fact: DataFrame, weeks: int = 5) -> DataFrame:
    """Captured and enrolled leads by the week of their first capture.

    Columns W0 to W(weeks - 1); earlier and later enrolments are counted in ``W_before`` and ``W_later``.
    """
    per_lead = (
        fact.filter((F.col("activity_type_category") == "Lead Capture") & F.col("lead_id").isNotNull())
        .groupBy("lead_id").agg(F.min("created_at").alias("first_at"), F.min("enroll_date").alias("enroll_date")))
    week = F.to_date(F.date_trunc("week", "first_at"))
    lag = F.floor(F.date_diff("enroll_date", week) / 7)
    return (per_lead.groupBy(week.alias("cohort_week"))
            .agg(F.count(F.lit(1)).alias("leads"),
                 *[F.count(F.when(lag == i, 1)).alias(f"W{i}") for i in range(weeks)],
                 F.count(F.when(lag < 0, 1)).alias("W_before"), F.count(F.when(lag >= weeks, 1)).alias("W_later")))


def daily_trend(fact: DataFrame) -> DataFrame:
    """Leads per day, month-to-date sum, and the same day of the month before."""
    day = fact.withColumn("activity_date_only", F.to_date("created_at"))
    daily = conditional_distinct(day, ["activity_month_start", "activity_date_only"], "lead_id",
                                 {"leads": F.col("activity_type_category") == "Lead Capture"})
    running = Window.partitionBy("activity_month_start").orderBy("activity_date_only").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)  # at most 31 rows
    daily = (daily.withColumn("leads_mtd", F.sum("leads").over(running))
             .withColumn("day_no", F.dayofmonth("activity_date_only")))
    before = daily.select(F.add_months("activity_month_start", 1).alias("activity_month_start"), "day_no",
                          F.col("leads_mtd").alias("leads_mtd_prior"))
    return daily.join(before, ["activity_month_start", "day_no"], "left").select(
        "activity_date_only", "activity_month_start", "day_no", "leads", "leads_mtd", "leads_mtd_prior")


def daily_distinct_trend(fact: DataFrame) -> DataFrame:
    """Leads captured for the first time in their month, per day, and their running count: distinct leads to date.

    ``daily_trend`` sums daily distinct counts, so a lead captured on two days of a month counts twice
    there; here each lead is marked on its first day of the month only (a min per lead and month, combined
    in the map tasks), and the running sum over the month's days (at most 31 rows) counts it once.
    """
    firsts = (fact.filter((F.col("activity_type_category") == "Lead Capture") & F.col("lead_id").isNotNull())
              .groupBy("activity_month_start", "lead_id").agg(F.min(F.to_date("created_at")).alias("activity_date_only")))
    daily = firsts.groupBy("activity_month_start", "activity_date_only").agg(F.count(F.lit(1)).alias("new_leads"))
    running = Window.partitionBy("activity_month_start").orderBy("activity_date_only").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn("leads_mtd_distinct", F.sum("new_leads").over(running))


def top_owners(fact: DataFrame, n: int) -> DataFrame:
    """Leaderboard: owners by enrolled leads."""
    flags = {"enrolls": F.col("Is_Valid_Enroll") == 1,
             "leads": F.col("activity_type_category") == "Lead Capture"}
    board = conditional_distinct(fact.filter(F.col("bda_id").isNotNull()), ["bda_id", "bda_name"], "lead_id", flags)
    return board.orderBy(F.desc("enrolls"), "bda_id").limit(n)


def owner_rank_per_month(fact: DataFrame, n: int) -> DataFrame:
    """Top ``n`` owners of every month (the window holds owners of a month, not rows)."""
    flags = {"enrolls": F.col("Is_Valid_Enroll") == 1}
    board = conditional_distinct(fact.filter(F.col("bda_id").isNotNull()), ["activity_month_start", "bda_id"],
                                 "lead_id", flags)
    order = Window.partitionBy("activity_month_start").orderBy(F.desc("enrolls"), "bda_id")
    return board.withColumn("owner_rank", F.row_number().over(order)).filter(F.col("owner_rank") <= n)


def additive_demos(fact: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Demo leads of both tracks added up: a lead in both counts twice, by design."""
    flags = {"demos_webinar": F.col("activity_type_category") == "Demo Scheduled",
             "demos_tech": F.col("activity_type_category") == "SE Marked Demo Schedule"}
    rows = entity_flags(fact, dims, "lead_id", flags)
    return count_flags(rows, dims, "lead_id", list(flags)).withColumn(
        "demos_added", F.col("demos_webinar") + F.col("demos_tech"))


def reactivated(fact: DataFrame, gap_days: int = 90) -> DataFrame:
    """Rows whose lead had been silent for more than ``gap_days`` days."""
    rows = fact.filter(F.col("lead_id").isNotNull()).select("activity_id", "lead_id", "created_at")
    rows = with_previous_time(rows, ["lead_id"], "created_at", "activity_id", "previous_at", bucket="day")
    silent = F.date_diff(F.to_date("created_at"), F.to_date("previous_at")) > gap_days
    return rows.withColumn("is_reactivated", F.when(silent, 1).otherwise(0))


def rolling_months(fact: DataFrame, months: int, as_of_date) -> DataFrame:
    """Rows of the last ``months`` calendar months, by the partition column."""
    start = F.add_months(F.trunc(F.lit(as_of_date), "MM"), 1 - months)
    return fact.filter(F.col("activity_month_start").between(start, F.lit(as_of_date)))


def drift(current: DataFrame, baseline: DataFrame, keys: Sequence[str], metric: str,
          alert: float = 0.30) -> DataFrame:
    """Relative change of a metric against a stored baseline."""
    stored = baseline.select(*keys, F.col(metric).alias("baseline"))
    change = ratio(F.col("current") - F.col("baseline"), F.col("baseline"))
    return (current.select(*keys, F.col(metric).alias("current")).join(stored, list(keys), "full")
            .fillna(0, ["current", "baseline"]).withColumn("change", change)
            .withColumn("alert", F.abs(change) > alert))


def calendar_integers(df: DataFrame, at: str) -> Mapping[str, Column]:
    col = F.col(at)
    return {"week_of_month": week_of_month(col), "hour": F.hour(col), "year_month": year_month_int(col)}


def leads_across_facts(fact: DataFrame, calls: DataFrame) -> DataFrame:
    """One row per lead of either fact: captured, enrolled, dials and connected calls.

    Each fact is reduced to its leads first, so the join meets one row per lead on both sides.
    """
    known = F.col("lead_id").isNotNull()
    acted = fact.filter(known).groupBy("lead_id").agg(
        F.max(F.when(F.col("activity_type_category") == "Lead Capture", 1).otherwise(0)).alias("is_captured"),
        F.max(F.when(F.col("Is_Valid_Enroll") == 1, 1).otherwise(0)).alias("is_enrolled"))
    valid = F.col("Is_Valid_Call") == 1
    called = calls.filter(known).groupBy("lead_id").agg(
        F.count(F.when(valid, 1)).alias("dials"),
        F.count(F.when(valid & (F.col("Is_Connected_Call") == 1), 1)).alias("connected_calls"))
    return acted.join(called, "lead_id", "full").fillna(0)


def calling_by_outcome(fact: DataFrame, calls: DataFrame) -> DataFrame:
    """Calling of captured and enrolled leads: dials per lead, and the rate of dialled leads that connected."""
    dialled, connected = F.count(F.when(F.col("dials") > 0, 1)), F.count(F.when(F.col("connected_calls") > 0, 1))
    return leads_across_facts(fact, calls).groupBy("is_captured", "is_enrolled").agg(
        F.count(F.lit(1)).alias("leads"), F.sum("dials").alias("dials"), dialled.alias("dialled_leads"),
        connected.alias("connected_leads"), ratio(F.sum("dials"), F.count(F.lit(1))).alias("dials_per_lead"),
        ratio(connected, dialled).alias("connected_rate"))


def counts_by_period(fact: DataFrame, calendar: DataFrame, month: str, period: Sequence[str], entity: str,
                     flags: Mapping[str, Column]) -> DataFrame:
    """Distinct counts of a fact by columns of the calendar that whole months share, e.g. quarter and fiscal year.

    The fact is reduced to one row per (month, entity) before the calendar's months are joined; a month
    outside the calendar counts under a missing period.
    """
    monthly = entity_flags(fact, [month], entity, flags)
    months = calendar.select(F.col("cal_month_start").alias(month), *period).distinct()
    joined = monthly.join(months, month, "left")
    per_entity = joined.groupBy(*period, entity).agg(*[F.max(n).alias(n) for n in flags])
    return count_flags(per_entity, period, entity, list(flags))
