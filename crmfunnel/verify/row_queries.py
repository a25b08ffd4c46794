"""Projections, filters and row-level classification (P), prep and fact builds (B, U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules
from ..functions.dates import fiscal_year_label, quarter_label
from ..plans import activity_fact as facts
from ..plans import call_fact, dims, prep, reports
from . import oracle
from .registry import add, add_columns

# --- prep projections -------------------------------------------------------
add_columns("p01_activity_projection", lambda e: prep.unified_activity(e.raw),
            "activity_id prospect_id type_id event_id created_at updated_at activity_date activity_source "
            "activity_source_medium activity_source_campaign form_name activity_score activity_note web_url "
            "web_referrer activity_type_activity_code activity_type_display_name activity_type_direction "
            "is_done_by_system activity_owner_id extension_status mx_custom39", "v_activity")
add_columns("p02_lead_projection", lambda e: e.leads,
            "id first_name last_name email_address phone age created_on prospect_stage owner_id is_customer is_lead "
            "do_not_call city state country lead_source_raw lead_source_medium_raw lead_source_campaign_raw utm_device "
            "lead_score engagement_score total_visits star_rank lead_team_domain verified_otp mx_degree mx_domain "
            "new_mx_domain mx_intent le_team_domain Lead_Source_Medium Lead_Source_Campaign", "v_leads")
add_columns("p03_lead_source_fallback", lambda e: e.leads, "id Lead_Source", "v_leads")
add_columns("p04_customer_profile", lambda e: e.leads,
            "id mx_student_or_working_professional Customer_Profile", "v_leads")
add_columns("p05_profile_code", lambda e: e.leads, "id mx_student_or_working_professional profile", "v_leads")
add_columns("p06_assignment_rows", lambda e: prep.assignment_activity(e.raw),
            "activity_id activity_type_activity_code activity_type_display_name activity_type_direction "
            "is_done_by_system selected_user_id_assign assignment_type", "v_assignment")

add("p07_activity_category",
    lambda e: e.stream.select("activity_id", "activity_type_activity_code", rules.activity_category(
        F.col("activity_type_activity_code")).alias("activity_type_category")),
    """select s.activity_id, s.activity_type_activity_code, ifnull(c.label, 'Other / Unknown') as activity_type_category
       from v_stream s left join f_codes c on c.code = s.activity_type_activity_code""")
add("p08_junk_filter",
    lambda e: e.rows.groupBy("activity_type_category").agg(F.count(F.lit(1)).alias("n_rows")),
    "select activity_type_category, count(*) as n_rows from f_classified group by all")
add_columns("p09_source_bucket", lambda e: e.rows, "activity_id lc_source Source_Bucket", "f_classified")
add_columns("p10_source_bucket_final", lambda e: e.build(), "activity_id Source_Bucket Source_Bucket_Final", "f_fact")
add("p11_system_activity",
    lambda e: e.leads.select("id", rules.system_flag(F.col("email_address")).alias("Is_System_Activity")),
    f"select id, {oracle.system_case('email_address')} as Is_System_Activity from v_leads")
add("p12_domain_group",
    lambda e: e.leads.select("id", "mx_domain", rules.domain_group(F.col("mx_domain")).alias("Domain_group")),
    f"select id, mx_domain, {oracle.domain_case('mx_domain')} as Domain_group from v_leads")
add("p13_star_bucket",
    lambda e: e.raw["assignment_history"].select(
        "id", "priority_score1", rules.star_from_score(F.col("priority_score1")).alias("star"),
        rules.star_from_score(F.col("priority_score1"), rules.LEGACY_STAR_LABELS).alias("legacy_star")),
    f"select id, priority_score1, {oracle.star_case('priority_score1')} as star, "
    f"{oracle.star_case('priority_score1', rules.LEGACY_STAR_LABELS)} as legacy_star from raw_assignment_history")
add_columns("p14_duration_bucket", lambda e: e.calls, "call_id call_duration_sec call_duration_bucket", "v_call")
add_columns("p15_connected_call", lambda e: e.calls, "call_id status1 status2 Is_Connected_Call", "v_call")
add_columns("p16_dnp_call", lambda e: e.calls, "call_id call_status Is_DNP_Call", "v_call")

# --- columns of the fact ----------------------------------------------------
_FACT = {
    "p17_program_interested": "activity_id program_name lc_source Program_Interested",
    "p18_star_match": "activity_id lead_star_rank_at_assign bda_star_rank_at_assign Is_Star_Match",
    "p19_assigned_this_month": "activity_id assigned_bda_id Is_Assigned_This_Month",
    "p20_first_assignment": "activity_id activity_type_category Is_First_Assignment_Per_Month",
    "p21_valid_enroll": "activity_id lead_id enroll_date Is_Valid_Enroll",
    "p22_same_month_enrolls": "activity_id lead_id SameMonthEnrolls",
    "p23_enroll_month_bucket": "activity_id lead_id enroll_date Enroll_Month_Bucket_Capped",
    "p24_lead_segment": "activity_id lead_id lead_created_on lead_segment",
    "p25_source_attribution": "activity_id lead_id source_attribution_final",
    "p26_unified_owner": "activity_id bda_id bda_name bda_email bda_tier bda_status",
    "p27_effective_star_rank": "activity_id latest_p1_star_rank lead_star_rank p1_star_rank_effective",
    "p28_calendar_parts": "activity_id activity_year activity_month activity_day activity_month_name "
                          "activity_month_start lead_created_month enroll_year enroll_month enroll_day "
                          "enroll_month_name enroll_month_start",
    "p35_full_names": "activity_id activity_owner_name activity_owner_email assigned_bda_name latest_bda_name bda_name",
    "p36_owner_hierarchy": "activity_id bda_dm_workforce_id bda_rsm_workforce_id bda_ad_workforce_id bda_region",
    "p37_team_domain": "activity_id team_domain_current team_domain_at_assignment",
}
for _key, _cols in _FACT.items():
    add_columns(_key, lambda e: e.build(), _cols, "f_fact")

add("p29_quarter_and_fiscal_year",
    lambda e: (e.rows.select(F.to_date("created_at").alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias("n_rows"))
               .withColumn("quarter_label", quarter_label(F.col("day")))
               .withColumn("fiscal_year", fiscal_year_label(F.col("day")))),
    """select cast(created_at as date) as day, count(*) as n_rows, concat('Q', quarter(any_value(created_at))) as quarter_label,
       concat('FY', year(any_value(created_at) + interval 9 month)) as fiscal_year from f_classified group by 1""")
add("p30_month_filter",
    lambda e: reports.in_month(e.fact, 6, 2024).groupBy("activity_type_category").agg(F.count(F.lit(1)).alias("n_rows")),
    "select activity_type_category, count(*) as n_rows from f_fact where activity_year = 2024 and activity_month = 6 group by all")
add_columns("p31_assignment_source", lambda e: e.build(facts.LEGACY),
            "activity_id lead_id has_lead_capture_in_month assignment_source", "old_fact")
add_columns("p32_valid_call", lambda e: e.calls, "call_id se_user_id prospect_id prev_call_created_at Is_Valid_Call",
            "v_call")
add_columns("p33_legacy_source_bucket", lambda e: facts.classified(e.stream, facts.LEGACY),
            "activity_id lc_source activity_type_category Source_Bucket", "old_classified")
add("p34_completed_events",
    lambda e: (e.raw["call_event"].filter(F.col("event_type") == "completed")
               .groupBy("call_id").agg(F.count(F.lit(1)).alias("n_events"))),
    "select call_id, count(*) as n_events from raw_call_event where event_type = 'completed' group by 1")
add_columns("p38_padded_columns", lambda e: prep.activity_appended(e.raw),
            "activity_id type_id activity_date modified_by_id form_name activity_score web_url extension_status "
            "mx_custom39 from_user_id priority_score1 priority_score2 prospect_star_rank_at_assign source_score "
            "lead_type_score", "v_appended")

# --- composite builds -------------------------------------------------------
add("u01_activity_union", lambda e: prep.activity_appended(e.raw).drop("extension_copy"), "select * from v_appended")
add("b01_unified_activity", lambda e: prep.unified_activity(e.raw), "select * from v_activity")
add("b02_unified_leads", lambda e: e.leads, "select * from v_leads")
add("b03_capture_message", lambda e: prep.unified_capture_message(e.raw), "select * from v_message")
add("b04_assignment_activity", lambda e: prep.assignment_activity(e.raw), "select * from v_assignment")
add_columns("b05_activity_appended", lambda e: prep.activity_appended(e.raw),
            "activity_id prospect_id created_at updated_at created_by_id activity_type_activity_code owner_id "
            "selected_user_id_assign assignment_type", "v_appended")
add("b06_activity_with_source", lambda e: e.stream.drop("extension_copy"), "select * from v_stream")
add("b07_call_detail", lambda e: e.calls, "select * from v_call")
add("b08_activity_fact", lambda e: e.build(), "select * from f_fact")
add("b08_first_capture_placement",
    lambda e: e.build(facts.FactOptions(sale_placement="first_capture_row"))
    .select("activity_id", "lead_id", "activity_month_start", "sale_value"),
    "select activity_id, lead_id, activity_month_start, sale_value from cap_fact")
add("b09_call_fact", lambda e: call_fact.call_fact(e.calls, e.leads, e.raw), "select * from call_fact")
add("b10_calendar", lambda e: dims.calendar_of(e.rows, "created_at"),
    f"""select cast(d as date) as calendar_date, {oracle.parts('d', 'cal')}, concat('Q', quarter(d)) as cal_quarter,
       concat('FY', year(d + interval 9 month)) as cal_fy
       from (select unnest(generate_series(min(cast(created_at as date)), max(cast(created_at as date)), interval 1 day)) as d
             from f_classified)""")
add("b11_user_hierarchy", lambda e: e.users, "select * from user_dim")
add("b12_legacy_fact", lambda e: e.build(facts.LEGACY), "select * from old_fact")
