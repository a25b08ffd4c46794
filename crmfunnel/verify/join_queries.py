"""Joins (J), window picks (W) and aggregates (G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.distinct import conditional_distinct, conditional_distinct_with_total
from ..operators.previous import with_previous_time
from ..plans import activity_fact as facts
from ..plans import audits, dims, measures, prep, reports
from .registry import add, add_columns

# --- joins ------------------------------------------------------------------
add_columns("j01_activity_type", lambda e: prep.unified_activity(e.raw),
            "activity_id type_id activity_type_activity_code activity_type_display_name", "v_activity")
add_columns("j02_activity_extension", lambda e: prep.unified_activity(e.raw),
            "activity_id activity_owner_id extension_status mx_custom39", "v_activity")
add_columns("j03_lead_extension_star", lambda e: e.leads, "id mx_domain le_team_domain lead_star_rank", "v_leads")
add_columns("j04_message_metadata", lambda e: prep.unified_capture_message(e.raw),
            "lcm_id lc_source lc_sourceMedium program_name course_id", "v_message")
add_columns("j05_activity_message", lambda e: e.stream, "activity_id lc_source lc_sourceCampaign program_name", "v_stream")
add_columns("j06_call_completed_event", lambda e: prep.calls_with_event(e.raw),
            "call_id call_duration_sec status1 status2 dialstatus caller_phone receiver_phone", "v_call_event")
add_columns("j07_activity_lead", lambda e: e.build(), "activity_id prospect_id lead_id first_name email_address", "f_fact")
add("j08_lead_sale", lambda e: audits.sales_per_lead(e.leads, e.raw["sales"]),
    """select l.id, count(*) as n_sales, cast(min(s.sale_date) as date) as first_sale_date, cast(max(s.sale_date) as date) as last_sale_date,
       cast(sum(s.sale_value) as decimal(28,2)) as booked from v_leads l join raw_sales s
       on lower(trim(s.lead_email)) = lower(trim(l.email_address)) group by 1""")
add_columns("j09_first_capture_of_month", lambda e: e.build(),
            "activity_id first_lead_capture_source_of_month first_capture_date_of_month", "f_fact")
add_columns("j10_last_capture", lambda e: e.build(),
            "activity_id last_lead_capture_source last_lead_capture_month", "f_fact")
add_columns("j11_enrolment", lambda e: e.build(), "activity_id enroll_date sale_program sale_ind_pg", "f_fact")
add_columns("j12_first_assignment_of_month", lambda e: e.build(),
            "activity_id assigned_bda_id assignment_type_month p1_score_at_assign lead_star_rank_at_assign", "f_fact")
add_columns("j13_latest_assignment", lambda e: e.build(),
            "activity_id latest_bda_id latest_p1_score latest_assignment_date", "f_fact")
add_columns("j14_user_roles", lambda e: e.build(),
            "activity_id activity_owner_name assigned_bda_email latest_bda_email bda_dm_workforce_id", "f_fact")
add_columns("j15_owner_tier", lambda e: e.build(),
            "activity_id assigned_bda_tier assigned_bda_status latest_bda_tier latest_bda_status", "f_fact")
add_columns("j16_call_lead_user_tier", lambda e: e.call_fact,
            "call_id lead_id lead_email bda_name bda_role bda_tier bda_status", "call_fact")
add_columns("j17_user_self_joins", lambda e: e.users, "user_id dm_id rsm_id ad_id", "user_dim")
add("j18_fact_user_dimension",
    lambda e: (e.build().join(e.users, F.col("bda_id") == F.col("user_id"), "left")
               .select("activity_id", "bda_id", "user_name", "dm_name")),
    "select f.activity_id, f.bda_id, u.user_name, u.dm_name from f_fact f left join user_dim u on u.user_id = f.bda_id")
add("j19_day_series",
    lambda e: (dims.calendar_of(e.raw["call"], "created_at").select("calendar_date").join(
        e.raw["call"].groupBy(F.to_date("created_at").alias("calendar_date")).agg(F.count(F.lit(1)).alias("n_calls")),
        "calendar_date", "left").fillna(0, ["n_calls"])),
    """select cast(d as date) as calendar_date, ifnull(n, 0) as n_calls
       from (select unnest(generate_series(min(cast(created_at as date)), max(cast(created_at as date)), interval 1 day)) as d
             from raw_call)
       left join (select cast(created_at as date) as day, count(*) as n from raw_call group by 1) on day = d""")

# --- window picks -----------------------------------------------------------
add("w01_latest_metadata", lambda e: prep.latest_metadata(e.raw),
    "select * exclude (created_at) from v_metadata")
add("w02_latest_message",
    lambda e: prep.latest_message_per_activity(e.raw).select("activity_id", "lc_source", "program_name", "course_id"),
    "select lcm_activity_id as activity_id, lc_source, program_name, course_id from v_message_of_activity")
add("w03_previous_call",
    lambda e: with_previous_time(e.raw["call"].select("id", "user_id", "prospect_id", "created_at"),
                                 ["user_id", "prospect_id"], "created_at", "id", "previous_at"),
    """select id, user_id, prospect_id, created_at, lag(created_at) over (
         partition by user_id, prospect_id order by created_at, id) as previous_at from raw_call""")
add("w04_latest_completed_event", lambda e: prep.completed_events(e.raw), "select * from v_completed")
add("w05_first_capture_per_month",
    lambda e: e.lead_months.filter(F.col("first_capture").isNotNull()).select(
        "lead_id", F.col("_lead_month").alias("capture_month"), "first_lead_capture_source_of_month",
        "first_capture_date_of_month"),
    """select lead_id, m as capture_month, src as first_lead_capture_source_of_month,
       happened as first_capture_date_of_month from f_first_capture where lead_id is not null""")
add("w06_last_capture_per_lead",
    lambda e: e.lead_months.filter(F.col("last_lead_capture_month") == F.col("_lead_month")).select(
        "lead_id", "last_lead_capture_source", "last_lead_capture_month"),
    """select lead_id, src as last_lead_capture_source, m as last_lead_capture_month from f_last_capture
       where lead_id is not null""")
add("w07_first_sale_per_lead", lambda e: facts.enrolments(e.leads, e.raw["sales"]).withColumnRenamed(
    "booked_value", "sale_value"), "select * from f_enrol")
add_columns("w08_capture_in_month", lambda e: e.build(),
            "activity_id lead_id activity_month_start has_lead_capture_in_month", "f_fact")
add("w09_first_row_of_month",
    lambda e: e.lead_months.select("lead_id", F.col("_lead_month").alias("activity_month_start"),
                                   F.col("first_row._o1").alias("activity_id")),
    "select lead_id, m as activity_month_start, activity_id from f_base where row_no = 1 and lead_id is not null")
add("w10_first_assignment_per_month",
    lambda e: e.lead_months.filter(F.col("assigned_bda_id").isNotNull()).select(
        "lead_id", F.col("_lead_month").alias("assigned_month"), "assigned_bda_id", "lead_star_rank_at_assign",
        "p1_score_at_assign", "p1_star_rank_at_assign", "bda_star_rank_at_assign", "team_domain_at_assignment",
        "assignment_type_month", "source_score_at_assign", "lead_type_score_at_assign"),
    """select lead_id, m as assigned_month, owner as assigned_bda_id, lead_rank as lead_star_rank_at_assign,
       score as p1_score_at_assign, star as p1_star_rank_at_assign, user_rank as bda_star_rank_at_assign,
       team as team_domain_at_assignment, kind as assignment_type_month, source_score as source_score_at_assign,
       lead_type_score as lead_type_score_at_assign from f_first_assigned where lead_id is not null""")
add("w11_latest_assignment_per_lead",
    lambda e: e.lead_months.filter(F.col("latest_bda_id").isNotNull()).select(
        "lead_id", "latest_bda_id", "latest_p1_score", "latest_p1_star_rank", "latest_lead_star_rank",
        "latest_bda_star_rank", "latest_assignment_date").distinct(),
    """select lead_id, owner as latest_bda_id, score as latest_p1_score, star as latest_p1_star_rank,
       lead_rank as latest_lead_star_rank, user_rank as latest_bda_star_rank, happened as latest_assignment_date
       from f_last_assigned where lead_id is not null""")
add("w12_numbered_days",
    lambda e: (dims.calendar_of(e.raw["activity_base"], "created_at")
               .select("calendar_date", F.date_diff("calendar_date", e.raw["activity_base"].agg(
                   F.min(F.to_date("created_at"))).scalar()).alias("day_no"))),
    """select cast(d as date) as calendar_date, cast(row_number() over (order by d) - 1 as integer) as day_no
       from (select unnest(generate_series(min(cast(created_at as date)), max(cast(created_at as date)), interval 1 day)) as d
             from raw_activity_base)""")

# --- aggregates -------------------------------------------------------------
CAP = "activity_type_category = 'Lead Capture'"
add("g01_conditional_distinct",
    lambda e: conditional_distinct(e.fact, ["activity_month_start", "Source_Bucket_Final"], "lead_id",
                                   reports.funnel_flags()),
    f"""select activity_month_start, Source_Bucket_Final, count(distinct case when {CAP} then lead_id end) as Leads,
       count(distinct case when activity_type_category = 'Demo Scheduled' then lead_id end) as Demos_SE,
       count(distinct case when activity_type_category in ('Demo Completed - Webinars', 'SE Marked Demo Completed')
         then lead_id end) as Demos_Completed,
       count(distinct case when Is_Valid_Enroll = 1 then lead_id end) as Enrolls,
       count(distinct case when {CAP} and SameMonthEnrolls = 'Enrolls' then lead_id end) as Same_Month_Enrolls
       from f_fact group by 1, 2""")
add("g02_conditional_sum",
    lambda e: e.fact.groupBy("activity_month_start").agg(
        F.sum(F.when(F.col("Is_Valid_Enroll") == 1, F.col("sale_value"))).alias("Total_Sale_Value")),
    """select activity_month_start, cast(sum(case when Is_Valid_Enroll = 1 then sale_value end) as decimal(28,2))
       as Total_Sale_Value from f_fact group by 1""")
add("g03_coalesced_label",
    lambda e: e.fact.groupBy(F.coalesce("source_attribution_final", F.lit("(none)")).alias("Source")).agg(
        F.count(F.lit(1)).alias("n_rows")),
    "select ifnull(source_attribution_final, '(none)') as Source, count(*) as n_rows from f_fact group by 1")
add("g04_two_keys",
    lambda e: conditional_distinct(e.fact.join(e.users, F.col("bda_id") == F.col("user_id"), "left"),
                                   ["user_name", "dm_name"], "lead_id", {"leads": F.lit(True)}),
    """select u.user_name, u.dm_name, count(distinct f.lead_id) as leads from f_fact f
       left join user_dim u on u.user_id = f.bda_id group by 1, 2""")
add("g05_scalar_max_count",
    lambda e: e.fact.agg(F.max("created_at").alias("latest"), F.count(F.lit(1)).alias("n_rows")),
    "select max(created_at) as latest, count(*) as n_rows from f_fact")
add("g06_revenue_per_lead_month",
    lambda e: audits.revenue_per_lead_month(e.fact).groupBy("activity_month_start").agg(F.sum("sale").alias("revenue")),
    """select activity_month_start, cast(sum(sale) as decimal(28,2)) as revenue from (
         select activity_month_start, lead_id, max(sale_value) as sale from f_fact where Is_Valid_Enroll = 1 group by 1, 2)
       group by 1""")
add("g07_conditional_count_avg",
    lambda e: measures.evaluate(e.call_fact, "call", ["Dials", "Avg_Call_Duration_Sec", "Active_Calling_BDAs"],
                                ["call_month_start", "bda_role"]),
    """select call_month_start, bda_role, count(case when Is_Valid_Call = 1 then call_id end) as Dials,
       avg(case when Is_Valid_Call = 1 and Is_Connected_Call = 1 then call_duration_sec end) as Avg_Call_Duration_Sec,
       count(distinct case when Is_Valid_Call = 1 then se_user_id end) as Active_Calling_BDAs
       from call_fact group by 1, 2""")
add("g08_totals_recomputed",
    lambda e: conditional_distinct_with_total(e.fact, ["lead_segment"], "lead_id", reports.breakdown_flags(),
                                              reports.funnel_sums()),
    f"""select case when grouping(lead_segment) = 1 then 'Total' else lead_segment end as lead_segment,
       count(distinct case when {CAP} then lead_id end) as Leads,
       count(distinct case when activity_type_category = 'Demo Scheduled' then lead_id end) as Demos_SE,
       count(distinct case when Is_Valid_Enroll = 1 then lead_id end) as Enrolls,
       cast(sum(case when Is_Valid_Enroll = 1 then sale_value end) as decimal(38,2)) as Total_Sale_Value,
       cast(grouping(lead_segment) as integer) as is_total from f_fact group by rollup (lead_segment)""")
