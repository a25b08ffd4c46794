"""Reference SQL: the data model as DuckDB common table expressions.

``render`` puts the expressions a statement needs, and theirs, into its WITH clause.
The formulation differs from the Spark plans on purpose: joins to QUALIFY-ed rows,
regular expressions and code lists instead of aggregates, LIKE chains and windows.
"""

from __future__ import annotations

import re

from ..functions import rules
from ..sources.schemas import LEAD_EXTENSION_TEXT, RAW_SCHEMAS
from ..sources.surrogate import duck_views

SITE = rules.DEFAULT_SITE


def _code_rows(legacy: bool) -> str:
    skip = {rules.JUNK} if legacy else set()
    return ", ".join(f"({c}, '{label}')" for label, codes in rules.CATEGORY_CODES.items() if label not in skip
                     for c in (codes if not (legacy and label == "Call Activity") else (506,)))


def _dots(host: str) -> str:
    return host.replace(".", "[.]")


def source_case(legacy: bool = False) -> str:
    """Channel of a source text; LIKE's ``_`` becomes a one-character wildcard."""
    has = lambda *words: f"regexp_matches(lower(lc_source), '{'|'.join(words)}')"
    ig = "" if legacy else "or lower(lc_source) = 'ig'"
    new = lambda text: "" if legacy else text
    display = "regexp_matches(lower(activity_type_display_name), 'facebook|meta|fb')"
    return f"""case
      when lc_source is null then case when {display} then 'Meta' else 'Email' end
      when {has(_dots(SITE.landing_host), 'direct grow')} then 'Direct Grow'
      when {has('youtube', 'yt', 'google.video', 'video.ad')} then 'Youtube'
      {new("when lower(lc_source) = 'ig' and regexp_matches(lower(ifnull(lc_sourceCampaign, '')), 'website.conv') then 'Meta - Resources'")}
      when {has('facebook', 'fb', 'insta', 'meta')} {ig} then 'Meta'
      when {has('linkedin')} then 'Linkedin'
      when {has('google ads', 'google.search', 'search.ad')} then 'Google Ads'
      when {has('email', 'webengage', 'kasplo')} then 'Email'
      when {has('whatsapp')} then 'Whatsapp'
      when {has('google[.]com', 'bing', 'yahoo', 'duckduckgo', 'yandex')} then 'Organic'
      {new(f"when lower(lc_source) = '{SITE.resource_tag}' and lower(lc_sourceMedium) = 'organic' then 'Organic Resources'")}
      when {has(_dots(SITE.host))} then 'Direct'
      {f"when {has('resource')} then '{SITE.resources_label}'" if legacy else ''}
      else 'Others' end"""


def refined(bucket: str, campaign: str) -> str:
    return (f"case when {bucket} = 'Email' and regexp_matches(lower(ifnull({campaign}, '')), 'facebook|fb|meta') "
            f"then 'Meta' else {bucket} end")


def domain_case(col: str) -> str:
    d = f"lower({col})"
    return (f"case when {d} in ('mechanical', 'mech', 'manufacturing') then 'Mechanical' "
            f"when {d} in ('ev', 'hev') then 'Electric Vehicles' when contains({d}, 'embedded') then 'Embedded Systems' "
            f"when {d} in ('information tech', 'fsd') then 'Software / IT' when {d} = 'fea' then 'CAE / Simulation' "
            f"when contains({d}, 'electr') then 'Electrical' when contains({d}, 'design') then 'Design' "
            f"when contains({d}, 'civil') then 'Civil' else 'Others / Unknown' end")


def system_case(col: str) -> str:
    domains = "|".join(_dots(d) for d in SITE.internal_domains)
    return f"case when regexp_matches(lower({col}), '@({domains})') then 1 else 0 end"


def star_case(score: str, labels=rules.STAR_LABELS) -> str:
    four, three, two, one = labels
    return (f"case when {score} is null then null when {score} < 20 then '{one}' when {score} < 40 then '{two}' "
            f"when {score} < 60 then '{three}' else '{four}' end")


def month(col: str) -> str:
    return f"cast(date_trunc('month', {col}) as date)"


def parts(col: str, prefix: str, name: bool = True) -> str:
    out = [f"cast(year({col}) as integer) as {prefix}_year", f"cast(month({col}) as integer) as {prefix}_month",
           f"cast(day({col}) as integer) as {prefix}_day"]
    if name:
        out.append(f"monthname({col}) as {prefix}_month_name")
    return ", ".join([*out, f"{month(col)} as {prefix}_month_start"])


PROFILE = ("case when regexp_matches(lower({c}), 'job|unemploy|fresher') then 'JOB SEEKER' "
           "when regexp_matches(lower({c}), 'student') then 'STUDENT' "
           "when regexp_matches(lower({c}), 'working|professional|experience') then 'WORKING PROFESSIONAL' "
           "else 'OTHERS' end")
BUCKET = ("case when call_duration_sec < 30 then '<30s' when call_duration_sec <= 60 then '30-60s' "
          "when call_duration_sec <= 180 then '60-180s' when call_duration_sec is not null then '>180s' end")

_LEAD_RENAMED = {"source": "lead_source_raw", "source_medium": "lead_source_medium_raw",
                 "source_campaign": "lead_source_campaign_raw", "score": "lead_score",
                 "team_domain": "lead_team_domain"}
_LEADS = ", ".join(f"l.{f.name} as {_LEAD_RENAMED.get(f.name, f.name)}" for f in RAW_SCHEMAS["leads"])
_EXT = ", ".join(f"e.{c}" for c in LEAD_EXTENSION_TEXT.split())

_A_ONLY = ["selected_user_id_assign", "from_user_id", "priority_score1", "priority_score2",
           "prospect_star_rank_at_assign", "selected_user_rank", "assignment_type", "assignment_team_domain",
           "prospect_domain", "source_score", "lead_type_score"]
_ACTIVITY_ONLY = ["type_id", "activity_date", "modified_by_id", "activity_source", "activity_source_medium",
                  "activity_source_campaign", "form_name", "activity_score", "activity_note", "web_url",
                  "web_referrer", "extension_status", "mx_custom39"]

CTES: dict[str, str] = dict(duck_views())
CTES |= {
    "v_activity": """select a.id as activity_id, a.prospect_id, a.type_id, a.event_id, a.created_at, a.updated_at,
      a.activity_date, a.created_by_id, a.modified_by_id, a.source as activity_source,
      a.source_medium as activity_source_medium, a.source_campaign as activity_source_campaign, a.form_name,
      a.score as activity_score, a.activity_note, a.web_url, a.web_referrer,
      k.activity_code as activity_type_activity_code, k.display_name as activity_type_display_name,
      k.direction as activity_type_direction, k.is_done_by_system, x.owner_id as activity_owner_id,
      x.status as extension_status, x.mx_custom39
      from raw_activity_base a join raw_activity_type k on k.id = a.type_id
      left join raw_activity_extension x on x.related_activity_id = a.id""",
    "v_leads": f"""select {_LEADS}, {_EXT}, e.team_domain as le_team_domain,
      ifnull(ifnull(l.source, l.first_source), l.first_original_source) as Lead_Source,
      l.source_medium as Lead_Source_Medium, l.source_campaign as Lead_Source_Campaign,
      s.latest_star_rank as lead_star_rank, {PROFILE.format(c='e.mx_student_or_working_professional')} as Customer_Profile,
      map {{'Working Professional': 'CWP', 'Job Seeker': 'NWP', 'Unemployed': 'NWP', 'Student': 'STU'}}
        [e.mx_student_or_working_professional] as profile
      from raw_leads l left join raw_lead_extension e on e.prospect_id = l.id left join raw_lead_star s on s.id = l.id""",
    "v_metadata": """select * from raw_capture_metadata
      qualify row_number() over (partition by lead_capture_message_id order by created_at desc) = 1""",
    "v_message": """select m.id as lcm_id, m.created_at as lcm_created_at, m.prospect_id as lcm_prospect_id,
      m.activity_id as lcm_activity_id, m.message as lcm_message_raw, d.source as lc_source,
      d.source_medium as lc_sourceMedium, d.source_campaign as lc_sourceCampaign, d.program_name, d.course_id
      from raw_capture_message m left join v_metadata d on d.lead_capture_message_id = m.id""",
    "v_assignment": """select id as activity_id, prospect_id, created_at, updated_at, created_by_id,
      2200 as activity_type_activity_code, 'Lead Assignment Activity' as activity_type_display_name,
      cast(null as varchar) as activity_type_direction, false as is_done_by_system,
      selected_user_id as selected_user_id_assign, from_user_id, priority_score1, priority_score2,
      prospect_star_rank as prospect_star_rank_at_assign, selected_user_rank, assignment_type,
      team_domain as assignment_team_domain, prospect_domain, prospect_rank,
      current_stage as assignment_current_stage, source_score, lead_type_score, current_week_activity_score
      from raw_assignment_history""",
    "v_appended": f"""select * exclude (event_id, activity_owner_id), activity_owner_id as owner_id,
      {', '.join('null as ' + c for c in _A_ONLY)} from v_activity
      union all by name
      select activity_id, prospect_id, created_at, updated_at, created_by_id, activity_type_activity_code,
      activity_type_display_name, activity_type_direction, is_done_by_system, selected_user_id_assign as owner_id,
      {', '.join(_A_ONLY)} from v_assignment""",
    "v_message_of_activity": """select * from v_message where lcm_activity_id is not null
      qualify row_number() over (partition by lcm_activity_id order by lcm_created_at desc, lcm_id desc) = 1""",
    "v_stream": """select a.*, m.lc_source, m.lc_sourceMedium, m.lc_sourceCampaign, m.program_name, m.course_id
      from v_appended a left join v_message_of_activity m on m.lcm_activity_id = a.activity_id""",
    "v_completed": """select call_id, event_data from raw_call_event where event_type = 'completed'
      qualify row_number() over (partition by call_id order by created_at desc) = 1""",
    "v_call_event": """select c.id as call_id, c.prospect_id, c.user_id as se_user_id, c.created_at, c.updated_at,
      c.call_status, c.direction, c.is_manual_call_done, c.original_call_status, c.comments, c.platform_type,
      case when regexp_full_match(json_extract_string(e.event_data, '$.duration'), '[0-9]+')
        then cast(json_extract_string(e.event_data, '$.duration') as integer) end as call_duration_sec,
      json_extract_string(e.event_data, '$.status1') as status1,
      json_extract_string(e.event_data, '$.status2') as status2,
      json_extract_string(e.event_data, '$.dialstatus') as dialstatus,
      json_extract_string(e.event_data, '$.caller') as caller_phone,
      json_extract_string(e.event_data, '$.receiver') as receiver_phone
      from raw_call c left join v_completed e on e.call_id = c.id""",
    "v_call_lag": """select *, lag(created_at) over (partition by se_user_id, prospect_id order by created_at, call_id)
      as prev_call_created_at from v_call_event""",
    "v_call": f"""select *,
      case when ifnull(trim(status1), '') = '' then 0 when prev_call_created_at is null then 1
        when date_diff('second', prev_call_created_at, created_at) > 5 then 1 else 0 end as Is_Valid_Call,
      case when status1 = 'Connected' and status2 = 'Connected' then 1 else 0 end as Is_Connected_Call,
      case when call_status in ('dnp', 'dnpWithinLimit') then 1 else 0 end as Is_DNP_Call,
      {BUCKET} as call_duration_bucket from v_call_lag""",
    "call_fact": f"""select c.* exclude (prev_call_created_at), c.prev_call_created_at,
      {parts('c.created_at', 'call', name=False)}, l.id as lead_id, l.first_name as lead_first_name,
      l.last_name as lead_last_name, l.email_address as lead_email, l.prospect_stage, l.is_customer,
      l.city as lead_city, l.state as lead_state, l.country as lead_country, l.mx_domain, l.Customer_Profile,
      l.lead_star_rank, l.le_team_domain as team_domain_current, {domain_case('l.mx_domain')} as Domain_group,
      {system_case('l.email_address')} as Is_System_Activity, u.first_name || ' ' || u.last_name as bda_name,
      u.email as bda_email, u.role as bda_role, u.region as bda_region, t.tier as bda_tier, t.status as bda_status,
      u.dm as bda_dm_workforce_id, u.rsm as bda_rsm_workforce_id, u.ad as bda_ad_workforce_id
      from v_call c left join v_leads l on l.id = c.prospect_id left join raw_user u on u.id = c.se_user_id
      left join raw_owner_tier t on lower(t.email) = lower(u.email)""",
    "user_dim": """select u.id as user_id, trim(concat(u.first_name, ' ', u.last_name)) as user_name,
      u.email as user_email, u.role as user_role, u.workforce_id as user_workforce_id, u.is_deleted,
      case u.role when 'dm' then u.id else d.id end as dm_id,
      trim(case u.role when 'dm' then concat(u.first_name, ' ', u.last_name) else concat(d.first_name, ' ', d.last_name) end) as dm_name,
      case u.role when 'rsm' then u.id else r.id end as rsm_id,
      trim(case u.role when 'rsm' then concat(u.first_name, ' ', u.last_name) else concat(r.first_name, ' ', r.last_name) end) as rsm_name,
      case u.role when 'ad' then u.id else a.id end as ad_id,
      trim(case u.role when 'ad' then concat(u.first_name, ' ', u.last_name) else concat(a.first_name, ' ', a.last_name) end) as ad_name
      from raw_user u left join raw_user d on d.role = 'dm' and d.workforce_id = u.dm
      left join raw_user r on r.role = 'rsm' and r.workforce_id = case u.role when 'dm' then u.rsm else d.rsm end
      left join raw_user a on a.role = 'ad' and a.workforce_id = case u.role when 'rsm' then u.ad else r.ad end""",
}


def _fact_ctes(x: str, *, legacy: bool = False, placement: str = "first_row_if_capture") -> dict[str, str]:
    """The activity fact with the joins of first/last rows; ``x`` prefixes the names."""
    labels = rules.LEGACY_STAR_LABELS if legacy else rules.STAR_LABELS
    new, recaptured, other = rules.LEGACY_SEGMENTS if legacy else rules.SEGMENTS
    day = "cast(s.sale_date as timestamp)" if legacy else "cast(s.sale_date as date)"
    name = (lambda u: f"concat({u}.first_name, ' ', {u}.last_name)") if legacy else (
        lambda u: f"{u}.first_name || ' ' || {u}.last_name")
    sale = {
        "every_row": "en.sale_value",
        "first_row_if_capture": "case when b.capture = 1 and b.row_no = 1 then en.sale_value end",
        "first_capture_row": "case when b.activity_id = fc.activity_id then en.sale_value end",
    }[placement]
    keep = "" if legacy else f"where c.label is distinct from '{rules.JUNK}'"
    lag = "date_diff('month', b.m, en.enroll_date)"
    traits = ("mx_degree mx_department mx_lead_branch mx_department_name mx_domain mx_skill_centre_location "
              "mx_lead_background mx_lead_goal mx_year_of_passing mx_device mx_company_name mx_job_title "
              "mx_designation mx_job_experience mx_job_domain mx_years_of_experience mx_current_education_status "
              "mx_branch_of_education mx_working_professional_or_experienced mx_student_or_working_professional "
              "mx_interested_courses mx_course_interested_in mx_webinar_interest Customer_Profile profile").split()
    extra = (""", case when b.assigned_row and fa.owner is not null
      then case when b.has_capture = 1 then 'From Capture' else 'Old Lead' end end as assignment_source"""
             if legacy else "")
    return {
        f"{x}codes": f"select * from (values {_code_rows(legacy)}) as t(code, label)",
        f"{x}classified": f"""select s.*, ifnull(c.label, '{rules.OTHER_CATEGORY}') as activity_type_category,
          {source_case(legacy)} as Source_Bucket from v_stream s
          left join {x}codes c on c.code = s.activity_type_activity_code {keep}""",
        f"{x}base": f"""select s.*, l.id as lead_id, {refined('s.Source_Bucket', 'l.Lead_Source_Campaign')} as Source_Bucket_Final,
          {month('s.created_at')} as m, cast(s.activity_type_category = 'Lead Capture' as integer) as capture,
          s.activity_type_category = 'Lead Assignment Activity' as assigned_row,
          max(case when s.activity_type_category = 'Lead Capture' then 1 else 0 end)
            over (partition by l.id, {month('s.created_at')}) as has_capture,
          row_number() over (partition by l.id, {month('s.created_at')} order by s.created_at, s.activity_id) as row_no
          from {x}classified s left join v_leads l on l.id = s.prospect_id""",
        f"{x}first_capture": f"""select lead_id, m, activity_id, Source_Bucket_Final as src, created_at as happened from {x}base
          where capture = 1 qualify row_number() over (partition by lead_id, m order by created_at, activity_id) = 1""",
        f"{x}last_capture": f"""select lead_id, m, Source_Bucket_Final as src from {x}base
          where capture = 1 qualify row_number() over (partition by lead_id order by created_at desc, activity_id desc) = 1""",
        f"{x}enrol": f"""select l.id as lead_id, {day} as enroll_date, s.sale_value, s.sale_program, s.sale_ind_pg
          from v_leads l join raw_sales s on lower(trim(s.lead_email)) = lower(trim(l.email_address))
          qualify row_number() over (partition by l.id order by {day}, s.sale_value,
            s.sale_program nulls first, s.sale_ind_pg nulls first) = 1""",
        f"{x}assigned": f"""select lead_id, m, activity_id, created_at as happened, selected_user_id_assign as owner,
          priority_score1 as score, {star_case('priority_score1', labels)} as star,
          prospect_star_rank_at_assign as lead_rank, selected_user_rank as user_rank,
          assignment_team_domain as team, assignment_type as kind, source_score, lead_type_score
          from {x}base where assigned_row and selected_user_id_assign is not null""",
        f"{x}first_assigned": f"""select * from {x}assigned
          qualify row_number() over (partition by lead_id, m order by happened, activity_id) = 1""",
        f"{x}last_assigned": f"""select * from {x}assigned
          qualify row_number() over (partition by lead_id order by happened desc, activity_id desc) = 1""",
        f"{x}fact": f"""select b.activity_id, b.prospect_id, b.type_id, b.created_at, b.updated_at, b.activity_date,
          b.created_by_id, b.activity_source, b.activity_source_medium, b.activity_source_campaign, b.form_name,
          b.activity_score, b.web_url, b.activity_type_activity_code, b.activity_type_display_name,
          b.activity_type_category, b.activity_type_direction, b.is_done_by_system, b.owner_id, b.extension_status,
          b.mx_custom39, b.selected_user_id_assign, b.from_user_id, b.assignment_type, b.assignment_team_domain,
          b.prospect_domain, b.lc_source, b.lc_sourceMedium, b.lc_sourceCampaign, b.program_name, b.course_id,
          b.Source_Bucket, b.Source_Bucket_Final, b.lead_id, l.first_name, l.last_name, l.email_address,
          l.phone_country_code, l.timezone, l.age, l.created_on as lead_created_on, l.owner_id as lead_owner_id,
          l.is_customer, l.prospect_stage, l.city as lead_city, l.state as lead_state, l.country as lead_country,
          l.utm_device as lead_utm_device, {system_case('l.email_address')} as Is_System_Activity,
          {', '.join('l.' + c for c in traits)}, {domain_case('l.mx_domain')} as Domain_group,
          l.le_team_domain as team_domain_current, l.Lead_Source, l.Lead_Source_Medium, l.Lead_Source_Campaign,
          l.star_rank, l.first_source, l.lead_star_rank, {parts('b.created_at', 'activity')},
          {month('l.created_on')} as lead_created_month, fc.src as first_lead_capture_source_of_month,
          fc.happened as first_capture_date_of_month, lc.src as last_lead_capture_source,
          lc.m as last_lead_capture_month, en.enroll_date, {parts('en.enroll_date', 'enroll')},
          en.sale_program, en.sale_ind_pg, {sale} as sale_value,
          case when {month('en.enroll_date')} = b.m and (b.capture = 1 or b.has_capture = 0) then 1 else 0 end as Is_Valid_Enroll,
          case when b.capture = 1 and {month('en.enroll_date')} = b.m and en.enroll_date >= fc.happened
            then 'Enrolls' else 'Leads' end as SameMonthEnrolls,
          case when b.capture = 0 then null when en.enroll_date >= fc.happened and {lag} between 0 and 12
            then concat('M+', {lag}) else 'Leads' end as Enroll_Month_Bucket_Capped,
          b.has_capture as has_lead_capture_in_month,
          cast(b.assigned_row and fa.owner is not null as integer) as Is_First_Assignment_Per_Month,
          case when b.has_capture = 1 and {month('l.created_on')} = b.m then '{new}'
            when b.has_capture = 1 and {month('l.created_on')} < b.m then '{recaptured}' else '{other}' end as lead_segment,
          case when b.has_capture = 1 then fc.src else lc.src end as source_attribution_final,
          {name('uo')} as activity_owner_name, uo.email as activity_owner_email,
          fa.lead_rank as lead_star_rank_at_assign, fa.score as p1_score_at_assign, fa.star as p1_star_rank_at_assign,
          fa.user_rank as bda_star_rank_at_assign, ifnull(la.star, l.lead_star_rank) as p1_star_rank_effective,
          fa.kind as assignment_type_month, fa.source_score as source_score_at_assign,
          fa.lead_type_score as lead_type_score_at_assign, fa.owner as assigned_bda_id,
          {name('um')} as assigned_bda_name, um.email as assigned_bda_email, tm.tier as assigned_bda_tier,
          tm.status as assigned_bda_status, fa.team as team_domain_at_assignment, la.owner as latest_bda_id,
          {name('ul')} as latest_bda_name, ul.email as latest_bda_email, tl.tier as latest_bda_tier,
          tl.status as latest_bda_status, la.score as latest_p1_score, la.star as latest_p1_star_rank,
          la.lead_rank as latest_lead_star_rank, la.user_rank as latest_bda_star_rank, la.happened as latest_assignment_date,
          ifnull(fa.owner, la.owner) as bda_id, ifnull({name('um')}, {name('ul')}) as bda_name,
          ifnull(um.email, ul.email) as bda_email, ifnull(tm.tier, tl.tier) as bda_tier,
          ifnull(tm.status, tl.status) as bda_status, uh.dm as bda_dm_workforce_id, uh.rsm as bda_rsm_workforce_id,
          uh.ad as bda_ad_workforce_id, uh.region as bda_region,
          case when fa.lead_rank = fa.user_rank then 1 else 0 end as Is_Star_Match,
          cast(fa.owner is not null as integer) as Is_Assigned_This_Month,
          case when b.capture = 0 then null when b.program_name is not null then b.program_name
            when regexp_matches(lower(b.lc_source), 'iit jammu') then
              case when contains(lower(b.lc_source), 'design') then 'IIT Jammu Design'
                when contains(lower(b.lc_source), 'ev') then 'IIT Jammu EV' end end as Program_Interested{extra}
          from {x}base b left join v_leads l on l.id = b.lead_id
          left join {x}first_capture fc on fc.lead_id = b.lead_id and fc.m = b.m
          left join {x}last_capture lc on lc.lead_id = b.lead_id
          left join {x}enrol en on en.lead_id = b.lead_id
          left join {x}first_assigned fa on fa.lead_id = b.lead_id and fa.m = b.m
          left join {x}last_assigned la on la.lead_id = b.lead_id
          left join raw_user uo on uo.id = b.owner_id left join raw_user um on um.id = fa.owner
          left join raw_user ul on ul.id = la.owner left join raw_user uh on uh.id = ifnull(fa.owner, la.owner)
          left join raw_owner_tier tm on lower(tm.email) = lower(um.email)
          left join raw_owner_tier tl on lower(tl.email) = lower(ul.email)""",
    }


CTES |= _fact_ctes("f_")
CTES |= _fact_ctes("cap_", placement="first_capture_row")
CTES |= _fact_ctes("old_", legacy=True, placement="every_row")

_WORD = re.compile(r"\b(" + "|".join(sorted(CTES, key=len, reverse=True)) + r")\b")


def render(sql: str) -> str:
    """``sql`` with the common table expressions it needs."""
    order: list[str] = []

    def visit(text: str, own: str = "") -> None:
        for name in dict.fromkeys(_WORD.findall(text)):
            if name != own and name not in order:
                visit(CTES[name], name)
                order.append(name)
    visit(sql)
    if not order:
        return sql
    views = ",\n".join(f"{n} as ({CTES[n]})" for n in order)
    own = sql.lstrip()
    return f"with {views},\n{own[5:]}" if own.lower().startswith("with ") else f"with {views}\n{sql}"
