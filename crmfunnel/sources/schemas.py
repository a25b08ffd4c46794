"""Fixed schemas of the raw CRM tables (no inference, no evolution).

Each schema lists the columns the engine uses.  Timestamps are wall-clock
(``timestamp_ntz``), ids are strings, JSON stays a string.
"""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(), "decimal(18,2)": T.DecimalType(18, 2),
    "decimal(18,6)": T.DecimalType(18, 6),
}


def _ddl(*groups: tuple[str, str]) -> T.StructType:
    """Build a schema from (type, 'name name name') groups."""
    return T.StructType([T.StructField(n, _TYPES[t]) for t, names in groups for n in names.split()])


LEAD_EXTENSION_TEXT = (
    "mx_degree mx_department mx_department_name mx_domain new_mx_domain mx_lead_branch "
    "mx_skill_centre_location mx_lead_background mx_lead_goal mx_year_of_passing mx_device "
    "mx_company_name mx_job_title mx_designation mx_job_experience mx_job_domain "
    "mx_years_of_experience mx_current_education_status mx_branch_of_education "
    "mx_working_professional_or_experienced mx_student_or_working_professional "
    "mx_interested_courses mx_course_interested_in mx_webinar_interest mx_intent "
    "mx_lead_quality_score mx_eligibility_status mx_india_or_out_of_india"
)

RAW_SCHEMAS: dict[str, T.StructType] = {
    "activity_base": _ddl(
        ("string", "id prospect_id type_id event_id"),
        ("timestamp_ntz", "created_at updated_at activity_date"),
        ("string", "created_by_id modified_by_id source source_medium source_campaign form_name"),
        ("int", "score"),
        ("string", "activity_note web_url web_referrer"),
    ),
    "activity_type": _ddl(
        ("string", "id"), ("int", "activity_code"), ("string", "display_name direction"),
        ("boolean", "is_done_by_system"),
    ),
    "activity_extension": _ddl(("string", "related_activity_id owner_id status mx_custom39")),
    "leads": _ddl(
        ("string", "id first_name last_name email_address phone national_number phone_country_code timezone"),
        ("int", "age"),
        ("timestamp_ntz", "created_on modified_on lead_conversion_date current_owner_assignment_date"),
        ("string", "prospect_stage owner_id current_owner_assignment_id"),
        ("boolean", "is_customer is_lead do_not_call do_not_email do_not_sms"),
        ("string", "city state country country_code source source_medium source_campaign first_source "
                   "first_original_source utm_device utm_source"),
        ("int", "score engagement_score total_visits"),
        ("string", "star_rank team_domain related_prospect_id"),
        ("boolean", "verified_otp"),
    ),
    "lead_extension": _ddl(("string", "prospect_id team_domain " + LEAD_EXTENSION_TEXT)),
    "lead_star": _ddl(("string", "id latest_star_rank")),
    "capture_message": _ddl(
        ("string", "id prospect_id activity_id message"), ("timestamp_ntz", "created_at")),
    "capture_metadata": _ddl(
        ("string", "lead_capture_message_id source source_medium source_campaign program_name course_id"),
        ("timestamp_ntz", "created_at")),
    "assignment_history": _ddl(
        ("string", "id prospect_id created_by_id selected_user_id from_user_id prospect_star_rank "
                   "selected_user_rank assignment_type team_domain prospect_domain prospect_rank current_stage"),
        ("timestamp_ntz", "created_at updated_at"),
        ("decimal(18,6)", "priority_score1 priority_score2"),
        ("int", "source_score lead_type_score current_week_activity_score"),
    ),
    "call": _ddl(
        ("string", "id prospect_id user_id call_status direction original_call_status comments platform_type"),
        ("timestamp_ntz", "created_at updated_at"), ("boolean", "is_manual_call_done")),
    "call_event": _ddl(
        ("string", "call_id event_type event_data"), ("timestamp_ntz", "created_at")),
    "sales": _ddl(
        ("string", "lead_email"), ("timestamp_ntz", "sale_date"), ("decimal(18,2)", "sale_value"),
        ("string", "sale_program sale_ind_pg")),
    "user": _ddl(
        ("string", "id first_name last_name email role region"),
        ("int", "workforce_id dm rsm ad"), ("boolean", "is_deleted")),
    "owner_tier": _ddl(("string", "email tier status")),
}

# Spreadsheet headers of the sales sheet and the names used here.
SALES_HEADERS = {
    "Lead Email": "lead_email",
    "Formatted Sale Date": "sale_date",
    "Booked Sale Amount": "sale_value",
    "Program Chosen by Lead": "sale_program",
    "Enrollment Type": "sale_ind_pg",
}
