"""Documented extras (E) on the stored facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators.distinct import conditional_distinct
from ..plans import dims, extras, reports
from .registry import add

AS_OF = dt.date(2025, 6, 1)
CAP = "activity_type_category = 'Lead Capture'"
DONE = "activity_type_category in ('Demo Completed - Webinars', 'SE Marked Demo Completed')"


def buckets(days: str) -> str:
    return (f"case when {days} > 60 then '60+ days' when {days} > 30 then '31-60 days' when {days} > 14 then '15-30 days' "
            f"when {days} > 7 then '8-14 days' when {days} >= 0 then '0-7 days' end")


add("e01_business_date",
    lambda e: extras.with_business_date(e.fact).groupBy("business_date").agg(F.count(F.lit(1)).alias("n_rows")),
    """select cast(created_at - interval 10 hour - interval 30 minute as date) as business_date, count(*) as n_rows
       from f_fact group by 1""")
add("e02_event_dates", lambda e: extras.event_dates(e.fact, extras.is_demo_done(), "demo"),
    f"""select lead_id, activity_month_start, cast(min(created_at) as date) as first_demo_month,
        cast(max(created_at) as date) as latest_demo_month, count(*) as n_demo_month,
        (select cast(min(created_at) as date) from f_fact i where i.lead_id = o.lead_id and {DONE}) as first_demo,
        (select cast(max(created_at) as date) from f_fact i where i.lead_id = o.lead_id and {DONE}) as latest_demo
        from f_fact o where {DONE} and lead_id is not null group by 1, 2""")
add("e03_sales_cycle", lambda e: extras.sales_cycle(e.fact),
    f"""select *, cast(enroll_date - first_capture as integer) as sales_cycle_days,
        {buckets('(enroll_date - first_capture)')} as sales_cycle_bucket from (
        select lead_id, cast(min(created_at) as date) as first_capture, any_value(enroll_date) as enroll_date
        from f_fact where {CAP} and lead_id is not null group by 1) where enroll_date >= first_capture""")
add("e04_pipeline_ageing", lambda e: extras.pipeline_ageing(e.fact, AS_OF),
    f"""select lead_id, latest_demo, cast(date '2025-06-01' - latest_demo as integer) as days_since_demo,
        {buckets("(date '2025-06-01' - latest_demo)")} as ageing_bucket,
        if(enroll_date is null, 'Open', 'Converted') as status from (
        select lead_id, cast(max(created_at) as date) as latest_demo, any_value(enroll_date) as enroll_date
        from f_fact where {DONE} and lead_id is not null group by 1)""")
add("e05_owner_as_of_capture", lambda e: extras.owner_as_of_capture(e.fact),
    f"""with c as (select activity_id, lead_id, created_at, lead_owner_id from f_fact where {CAP} and lead_id is not null),
        a as (select lead_id, created_at, selected_user_id_assign as owner from f_fact
          where activity_type_category = 'Lead Assignment Activity' and selected_user_id_assign is not null)
        select *, coalesce(owner_before, owner_after, lead_owner_id) as owner_as_of from (select c.*,
          (select max(owner) from a where a.lead_id = c.lead_id and a.created_at = (select max(b.created_at) from a b
             where b.lead_id = c.lead_id and b.created_at < c.created_at)) as owner_before,
          (select min(owner) from a where a.lead_id = c.lead_id and a.created_at = (select min(b.created_at) from a b
             where b.lead_id = c.lead_id and b.created_at >= c.created_at)) as owner_after from c)""")
_M = ", ".join(f"count(distinct case when Enroll_Month_Bucket_Capped = 'M+{i}' then lead_id end) as M{i}" for i in range(6))
add("e06_cohort_lag",
    lambda e: extras.cohort_lag(e.fact, ["activity_month_start", "source_attribution_final"]),
    f"""select activity_month_start, source_attribution_final, count(distinct case when {CAP} then lead_id end) as Leads,
        {_M}, count(distinct case when Enroll_Month_Bucket_Capped like 'M+%'
          and Enroll_Month_Bucket_Capped not in ('M+0', 'M+1', 'M+2', 'M+3', 'M+4', 'M+5') then lead_id end) as M_later
        from f_fact group by 1, 2""")
add("e06_cohort_lag_long",
    lambda e: extras.cohort_lag_long(e.fact, ["activity_month_start", "source_attribution_final"]),
    """select activity_month_start, source_attribution_final, cast(substr(Enroll_Month_Bucket_Capped, 3) as integer) as lag,
        count(distinct lead_id) as enrolled
        from f_fact where Enroll_Month_Bucket_Capped like 'M+%' and lead_id is not null group by 1, 2, 3""")
_W = ", ".join(f"count(case when lag = {i} then 1 end) as W{i}" for i in range(5)) + (
    ", count(case when lag < 0 then 1 end) as W_before, count(case when lag > 4 then 1 end) as W_later")
add("e06_weekly_cohorts", lambda e: extras.weekly_cohorts(e.fact),
    f"""select cohort_week, count(*) as leads, {_W} from (select *, floor((d - cohort_week) / 7.0) as lag from (
        select lead_id, cast(date_trunc('week', min(created_at)) as date) as cohort_week, any_value(enroll_date) as d
        from f_fact where {CAP} and lead_id is not null group by 1)) group by 1""")
add("e07_daily_trend", lambda e: extras.daily_trend(e.fact),
    f"""with d as (select cast(created_at as date) as activity_date_only, any_value(activity_month_start) as activity_month_start,
          cast(day(any_value(created_at)) as integer) as day_no, count(distinct case when {CAP} then lead_id end) as leads
          from f_fact group by 1),
        r as (select *, cast(sum(leads) over (partition by activity_month_start order by activity_date_only) as bigint)
          as leads_mtd from d)
        select r.*, p.leads_mtd as leads_mtd_prior from r left join r p on p.day_no = r.day_no
          and cast(p.activity_month_start + interval 1 month as date) = r.activity_month_start""")
add("e07_daily_distinct_mtd", lambda e: extras.daily_distinct_trend(e.fact),
    f"""with f as (select activity_month_start, lead_id, min(cast(created_at as date)) as activity_date_only
          from f_fact where {CAP} and lead_id is not null group by 1, 2),
        d as (select activity_month_start, activity_date_only, count(*) as new_leads from f group by 1, 2)
        select *, cast(sum(new_leads) over (partition by activity_month_start order by activity_date_only) as bigint)
          as leads_mtd_distinct from d""")
add("e08_top_owners", lambda e: extras.top_owners(e.fact, 3),
    f"""select bda_id, bda_name, count(distinct case when Is_Valid_Enroll = 1 then lead_id end) as enrolls,
        count(distinct case when {CAP} then lead_id end) as leads from f_fact where bda_id is not null
        group by 1, 2 order by enrolls desc, bda_id limit 3""")
add("e08_owner_rank_per_month", lambda e: extras.owner_rank_per_month(e.fact, 2),
    """select activity_month_start, bda_id, enrolls, cast(row_number() over (partition by activity_month_start
         order by enrolls desc, bda_id) as integer) as owner_rank from (
       select activity_month_start, bda_id, count(distinct case when Is_Valid_Enroll = 1 then lead_id end) as enrolls
       from f_fact where bda_id is not null group by 1, 2) qualify owner_rank <= 2""")
add("e09_additive_demos", lambda e: extras.additive_demos(e.fact, ["activity_month_start"]),
    """select *, demos_webinar + demos_tech as demos_added from (select activity_month_start,
       count(distinct case when activity_type_category = 'Demo Scheduled' then lead_id end) as demos_webinar,
       count(distinct case when activity_type_category = 'SE Marked Demo Schedule' then lead_id end) as demos_tech
       from f_fact group by 1)""")
add("e10_reactivated", lambda e: extras.reactivated(e.fact),
    """select *, cast(ifnull(cast(created_at as date) - cast(previous_at as date) > 90, false) as integer) as is_reactivated
       from (select activity_id, lead_id, created_at, lag(created_at) over (partition by lead_id
         order by created_at, activity_id) as previous_at from f_fact where lead_id is not null)""")
add("e11_rolling_months",
    lambda e: extras.rolling_months(e.fact, 6, dt.date(2024, 10, 15)).groupBy("activity_month_start").agg(
        F.count(F.lit(1)).alias("n_rows")),
    """select activity_month_start, count(*) as n_rows from f_fact
       where activity_month_start between date '2024-05-01' and date '2024-10-01' group by 1""")


def _counts(fact, month):
    rows = fact.filter(F.col("activity_month_start") == F.lit(month))
    return conditional_distinct(rows, ["Source_Bucket_Final"], "lead_id", {"leads": F.lit(True)})


add("e12_drift",
    lambda e: extras.drift(_counts(e.fact, dt.date(2024, 6, 1)), _counts(e.fact, dt.date(2024, 5, 1)),
                           ["Source_Bucket_Final"], "leads"),
    """select Source_Bucket_Final, ifnull(c, 0) as current, ifnull(b, 0) as baseline,
       ifnull((ifnull(c, 0) - b) / cast(b as double), 0) as change,
       abs(ifnull((ifnull(c, 0) - b) / cast(b as double), 0)) > 0.3 as alert from
       (select Source_Bucket_Final, count(distinct lead_id) as c from f_fact where activity_month_start = date '2024-06-01' group by 1)
       full join (select Source_Bucket_Final, count(distinct lead_id) as b from f_fact
         where activity_month_start = date '2024-05-01' group by 1) using (Source_Bucket_Final)""")
add("e13_calendar_integers",
    lambda e: (e.fact.withColumns(dict(extras.calendar_integers(e.fact, "created_at")))
               .groupBy("year_month", "week_of_month", "hour").agg(F.count(F.lit(1)).alias("n_rows"))),
    """select cast(strftime(created_at, '%Y%m') as integer) as year_month,
       cast((day(created_at) - 1) // 7 + 1 as integer) as week_of_month, cast(hour(created_at) as integer) as hour,
       count(*) as n_rows from f_fact group by all""")
_CALLED = """select coalesce(a.lead_id, c.lead_id) as lead_id, ifnull(is_captured, 0) as is_captured,
    ifnull(is_enrolled, 0) as is_enrolled, ifnull(dials, 0) as dials, ifnull(connected_calls, 0) as connected_calls
    from (select lead_id, max(cast(activity_type_category = 'Lead Capture' as integer)) as is_captured,
            max(cast(Is_Valid_Enroll = 1 as integer)) as is_enrolled from f_fact where lead_id is not null group by 1) a
    full join (select lead_id, count(*) filter (Is_Valid_Call = 1) as dials,
            count(*) filter (Is_Valid_Call = 1 and Is_Connected_Call = 1) as connected_calls
          from call_fact where lead_id is not null group by 1) c on a.lead_id = c.lead_id"""
add("x01_leads_across_facts", lambda e: extras.leads_across_facts(e.fact, e.call_fact), _CALLED)
add("x02_calling_by_outcome", lambda e: extras.calling_by_outcome(e.fact, e.call_fact),
    f"""select *, cast(dials as double) / leads as dials_per_lead,
        if(dialled_leads = 0, 0.0::double, cast(connected_leads as double) / dialled_leads) as connected_rate from (
        select is_captured, is_enrolled, count(*) as leads, cast(sum(dials) as bigint) as dials,
        count(*) filter (dials > 0) as dialled_leads, count(*) filter (connected_calls > 0) as connected_leads
        from ({_CALLED}) group by 1, 2)""")
_QUARTER, _FY = "concat('Q', quarter({0}))", "concat('FY', year({0} + interval 9 month))"
add("x03_funnel_by_quarter",
    lambda e: extras.counts_by_period(e.fact, dims.calendar_of(e.rows, "created_at"), "activity_month_start",
                                      ["cal_fy", "cal_quarter"], "lead_id", reports.breakdown_flags()),
    f"""select {_FY.format('created_at')} as cal_fy, {_QUARTER.format('created_at')} as cal_quarter,
        count(distinct case when {CAP} then lead_id end) as Leads,
        count(distinct case when activity_type_category = 'Demo Scheduled' then lead_id end) as Demos_SE,
        count(distinct case when Is_Valid_Enroll = 1 then lead_id end) as Enrolls
        from f_fact group by 1, 2""")
add("x04_calls_by_fiscal_year",
    lambda e: extras.counts_by_period(e.call_fact, dims.calendar_of(e.call_fact, "created_at"), "call_month_start",
                                      ["cal_fy"], "lead_id", {"dialled_leads": F.col("Is_Valid_Call") == 1,
                                      "connected_leads": (F.col("Is_Valid_Call") == 1) & (F.col("Is_Connected_Call") == 1)}),
    f"""select {_FY.format('created_at')} as cal_fy, count(distinct case when Is_Valid_Call = 1 then lead_id end) as dialled_leads,
        count(distinct case when Is_Valid_Call = 1 and Is_Connected_Call = 1 then lead_id end) as connected_leads
        from call_fact group by 1""")
