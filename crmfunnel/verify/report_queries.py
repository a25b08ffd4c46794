"""Monthly reports (R), measure sections (M), jobs, checks and audits (C, A)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..plans import audits, checks, measures, reports
from .registry import add

MONTH, YEAR = 6, 2024
AS_OF = dt.date(2025, 6, 1)

CAP = "activity_type_category = 'Lead Capture'"
LEADS = f"count(distinct case when {CAP} then lead_id end)"
DEMOS = "count(distinct case when activity_type_category = 'Demo Scheduled' then lead_id end)"
DONE = ("count(distinct case when activity_type_category in ('Demo Completed - Webinars', 'SE Marked Demo Completed') "
        "then lead_id end)")
ENROLLS = "count(distinct case when Is_Valid_Enroll = 1 then lead_id end)"
SAME = f"count(distinct case when {CAP} and SameMonthEnrolls = 'Enrolls' then lead_id end)"
SALES = "cast(sum(case when Is_Valid_Enroll = 1 then sale_value end) as decimal(38,2))"
IN_MONTH = f"activity_year = {YEAR} and activity_month = {MONTH}"
FUNNEL = (f"{LEADS} as Leads, {DEMOS} as Demos_SE, {DONE} as Demos_Completed, {ENROLLS} as Enrolls, "
          f"{SAME} as Same_Month_Enrolls, {SALES} as Total_Sale_Value")
SPLIT = f"{LEADS} as Leads, {DEMOS} as Demos_SE, {ENROLLS} as Enrolls, {SALES} as Total_Sale_Value"
TECH_S = "count(distinct case when activity_type_category = 'SE Marked Demo Schedule' then lead_id end)"
TECH_C = "count(distinct case when activity_type_category = 'SE Marked Demo Completed' then lead_id end)"
TECH = f"{TECH_S} as Demos_Tech_Scheduled, {TECH_C} as Demos_Tech_Completed"
DEMO_ROWS = f"""(select f.activity_type_category, f.lead_id, ifnull(u.user_name, '(Unassigned)') as BDA,
  ifnull(u.dm_name, '(Unassigned)') as DM, ifnull(u.rsm_name, '(Unassigned)') as RSM,
  ifnull(u.ad_name, '(Unassigned)') as AD from f_fact f left join user_dim u on u.user_id = f.bda_id
  where {IN_MONTH} and activity_type_category in ('SE Marked Demo Schedule', 'SE Marked Demo Completed'))"""


def over(a: str, b: str) -> str:
    """Division that yields 0 for a zero or missing denominator."""
    return f"ifnull(cast({a} as double) / nullif(cast({b} as double), 0), 0)"


add("r01_funnel", lambda e: reports.funnel(e.fact, MONTH, YEAR), f"select {FUNNEL} from f_fact where {IN_MONTH}")
add("r02_funnel_by_source", lambda e: reports.funnel_by_source(e.fact, MONTH, YEAR),
    f"""select ifnull(source_attribution_final, '(none)') as Source, {SPLIT} from f_fact where {IN_MONTH}
        group by 1 order by Leads desc, 1""")
add("r03_funnel_by_segment", lambda e: reports.funnel_by_segment(e.fact, MONTH, YEAR),
    f"select lead_segment as Segment, {SPLIT} from f_fact where {IN_MONTH} group by 1 order by Leads desc, 1")
for _i, (_level, _cols) in enumerate(reports.LEVELS.items(), start=4):
    _names = ", ".join(_cols)
    add(f"r{_i:02d}_demos_by_{_level}",
        lambda e, lv=_level: reports.demos_by(e.fact, e.users, lv, MONTH, YEAR),
        f"select {_names}, {TECH} from {DEMO_ROWS} group by {_names} order by Demos_Tech_Scheduled desc, {_names}")
    add(f"r10_demos_by_{_level}_total",
        lambda e, lv=_level: reports.demos_with_total(e.fact, e.users, lv, MONTH, YEAR),
        f"select {_names}, {TECH}, 0 as is_total from {DEMO_ROWS} group by {_names} union all "
        f"select 'Total', {'null, ' if len(_cols) > 1 else ''}{TECH}, 1 from {DEMO_ROWS}")
    add(f"r11_demo_ratio_by_{_level}",
        lambda e, lv=_level: reports.with_demo_ratio(reports.demos_by(e.fact, e.users, lv, MONTH, YEAR)),
        f"select {_names}, {TECH}, {over(TECH_C, TECH_S)} as DS2DC from {DEMO_ROWS} group by {_names}")
_RATIOS = f"{over(DEMOS, LEADS)} as L2D, {over(ENROLLS, LEADS)} as L2E, {over(ENROLLS, DEMOS)} as D2E"
add("r08_funnel_ratios", lambda e: reports.with_funnel_ratios(reports.funnel(e.fact, MONTH, YEAR)),
    f"select {FUNNEL}, {_RATIOS}, {over(SAME, LEADS)} as SM_L2E from f_fact where {IN_MONTH}")
add("r08_source_ratios", lambda e: reports.with_funnel_ratios(reports.funnel_by_source(e.fact, MONTH, YEAR)),
    f"""select ifnull(source_attribution_final, '(none)') as Source, {SPLIT}, {_RATIOS} from f_fact
        where {IN_MONTH} group by 1""")
add("r08_segment_ratios", lambda e: reports.with_funnel_ratios(reports.funnel_by_segment(e.fact, MONTH, YEAR)),
    f"select lead_segment as Segment, {SPLIT}, {_RATIOS} from f_fact where {IN_MONTH} group by 1")
add("r09_month_compare", lambda e: reports.month_compare(e.fact, MONTH, YEAR),
    f"""select metric, current, prior, current - prior as delta, {over('current - prior', 'prior')} as delta_pct from (
        select metric, ifnull(max(case when m = {MONTH} then v end), 0) as current,
          ifnull(max(case when m = {MONTH - 1} then v end), 0) as prior from (
          unpivot (select activity_month as m, cast({LEADS} as double) as Leads, cast({DEMOS} as double) as Demos_SE,
            cast({DONE} as double) as Demos_Completed, cast({ENROLLS} as double) as Enrolls,
            cast({SAME} as double) as Same_Month_Enrolls, ifnull(cast({SALES} as double), 0) as Total_Sale_Value
            from f_fact where activity_year = {YEAR} and activity_month in ({MONTH - 1}, {MONTH}) group by 1)
          on Leads, Demos_SE, Demos_Completed, Enrolls, Same_Month_Enrolls, Total_Sale_Value into name metric value v)
        group by 1)""")
add("r10_source_total", lambda e: reports.breakdown_with_total(e.fact, "source", MONTH, YEAR),
    f"""select ifnull(source_attribution_final, '(none)') as Source, {SPLIT}, 0 as is_total from f_fact
        where {IN_MONTH} group by 1 union all select 'Total', {SPLIT}, 1 from f_fact where {IN_MONTH}""")
add("r10_segment_total", lambda e: reports.breakdown_with_total(e.fact, "segment", MONTH, YEAR),
    f"""select lead_segment as Segment, {SPLIT}, 0 as is_total from f_fact where {IN_MONTH} group by 1
        union all select 'Total', {SPLIT}, 1 from f_fact where {IN_MONTH}""")
_AD_HOC = """select lead_segment, activity_type_category, count(*) as n_rows, count(distinct lead_id) as n_leads
  from {table} where activity_year = {year} group by lead_segment, activity_type_category"""
add("r12_ad_hoc_sql",
    lambda e: reports.ad_hoc(e.spark, _AD_HOC.format(table="activity_fact", year=":year"),
                             {"activity_fact": e.fact}, {"year": YEAR}),
    _AD_HOC.format(table="f_fact", year=YEAR))


# --- measure sections: long form per month ------------------------------------
def direct(m: measures.Measure) -> str:
    """A measure's aggregate in plain SQL."""
    pick = lambda c: f"case when {m.where} then {c} end"
    return {
        "leads": lambda: f"count(distinct {pick('lead_id')})",
        "owners": lambda: f"count(distinct {pick(m.column)})",
        "count": lambda: f"count({pick(m.column or '1')})",
        "sum": lambda: f"sum({pick(m.column)})",
        "avg": lambda: f"avg({pick(m.column)})",
        "max": lambda: f"max({pick(m.column)})",
    }[m.kind]()


def formula(fact: str, name: str) -> str:
    """SQL of a measure over the columns of its inputs."""
    m = measures.CATALOGUE[fact][name]
    a = [f'"{x}"' for x in m.args]
    percent = f"printf('%.1f%%', round({a[0]} * 100, 1))" if a else ""
    money = lambda s, p: f"format('{{:,.{p}f}}', round(cast({a[0]} as double) / {s}, {p}))"
    return {
        "ratio": lambda: over(a[0], a[1]),
        "delta": lambda: f"ifnull({a[0]}, 0) - ifnull({a[1]}, 0)",
        "change": lambda: over(f"(ifnull({a[0]}, 0) - ifnull({a[1]}, 0))", a[1]),
        "alias": lambda: a[0],
        "blank": lambda: "cast(null as double)",
        "money": lambda: f"case when {a[0]} >= 100000 then {money(100000, 2)} || ' L' "
                         f"when {a[0]} >= 1000 then {money(1000, 1)} || ' K' else {money(1, 0)} end",
        "clock": lambda: f"case when {a[0]} is null then '-' else concat(cast(floor({a[0]} / 60) as integer), ':', "
                         f"lpad(cast(cast(floor({a[0]}) as integer) % 60 as varchar), 2, '0')) end",
        "arrow": lambda: f"case when {a[0]} > 0 then '▲ ' || {percent} when {a[0]} < 0 then '▼ ' || {percent} "
                         f"else '─ 0.0%' end",
    }[m.kind]()


def section_sql(fact: str, view: str, section: str, dims: list[str]) -> str:
    """One section: aggregates, prior month by full join, formulas, then rows."""
    names = [m.name for m in measures.sections(fact)[section]]
    chain = measures.needed(fact, names)
    month = measures.MONTH_COLUMN[fact]
    keys = ", ".join(dims)
    steps = [f"select {keys}, " + ", ".join(
        f'{direct(m)} as "{m.name}"' for m in chain if m.kind in measures.AGGREGATES) + f" from {view} group by {keys}"]

    def put(parts: list[measures.Measure]) -> None:
        for m in parts:
            steps.append(f'select *, {formula(fact, m.name)} as "{m.name}" from ({steps[-1]})')
    prior = [m for m in chain if m.kind == "prior"]
    early: set[str] = set()
    if prior:
        inputs = [m for m in measures.needed(fact, [p.args[0] for p in prior]) if m.kind not in measures.AGGREGATES]
        put(inputs)
        early = {m.name for m in inputs}
        before = ", ".join(f'"{p.args[0]}" as "{p.name}"' for p in prior)
        now = steps[-1]
        others = ", ".join(f"{d} as {d}" if d != month else f"cast({d} + interval 1 month as date) as {d}" for d in dims)
        # a group without a value has a month before, too
        both = ", ".join(f"coalesce(a.{d}, b.{d}) as {d}" for d in dims)
        same = " and ".join(f"a.{d} is not distinct from b.{d}" for d in dims)
        steps.append(f"select {both}, a.* exclude ({keys}), b.* exclude ({keys}) from ({now}) a "
                     f"full join (select {others}, {before} from ({now})) b on {same}")
    put([m for m in chain if m.kind not in measures.AGGREGATES | {"prior"} and m.name not in early])
    rows = []
    for n in names:
        m = measures.CATALOGUE[fact][n]
        if m.kind == "max":
            value, text = "null", f"""strftime("{n}", '%Y-%m-%d %H:%M:%S')"""
        elif measures.is_text(fact, m):
            value, text = "null", f'"{n}"'
        else:
            value, text = f'"{n}"', "null"
        rows.append(f"select {keys}, '{n}' as measure, cast({value} as double) as value, "
                    f"cast({text} as varchar) as value_text from final_rows")
    return f"select * from (with final_rows as ({steps[-1]}) " + " union all ".join(rows) + ")"


_DIMS = {
    "8 Owner Performance": ["bda_id"], "9 Owner Tier": ["bda_tier"], "10 Source Attribution": ["source_attribution_final"],
    "12 Domain and Program": ["Domain_group"], "14 Customer Profile": ["Customer_Profile"],
    "11 Month over Month": ["lead_segment"], "4 Owner Calling": ["bda_name"], "7 By Domain": ["Domain_group"],
    "8 By Tier": ["bda_tier"], "6 Calling Month over Month": ["bda_tier"],
}
for _fact, _view in (("activity", "f_fact"), ("call", "call_fact")):
    for _section in measures.sections(_fact):
        _dims = [measures.MONTH_COLUMN[_fact], *_DIMS.get(_section, [])]
        _slug = _section.lower().replace(" ", "_")
        if _section[1] == " ":
            _slug = "0" + _slug
        add(f"m_{_fact}_{_slug}",
            lambda e, f=_fact, s=_section, d=_dims: measures.section_report(
                e.fact if f == "activity" else e.call_fact, f, s, d),
            section_sql(_fact, _view, _section, _dims))

# --- checks -------------------------------------------------------------------
_AGE = "cast(date '2025-06-01' - cast(max(created_at) as date) as integer)"
add("c01_source_freshness", lambda e: checks.freshness(e.raw["activity_base"], "created_at", AS_OF, 1),
    f"select max(created_at) as latest, {_AGE} as lag_days, {_AGE} <= 1 as ok from raw_activity_base")
add("c02_fact_freshness_warning", lambda e: checks.freshness_warning(e.fact, AS_OF),
    f"""select max(created_at) as latest, {_AGE} as lag_days, case when {_AGE} > 2 then concat(
        'data may be stale: latest activity is ', strftime(max(created_at), '%Y-%m-%d'), ', ', {_AGE}, ' days ago')
        end as warning from f_fact""")
add("c04_post_check", lambda e: checks.post_check(e.fact, e.users, e.call_fact, AS_OF, min_rows=10_000),
    f"""select 'fact_is_fresh' as "check", {_AGE} <= 1 as ok, concat('lag_days=', {_AGE}) as detail from f_fact
        union all select 'fact_is_large', count(*) >= 10000, concat('fact_rows=', count(*)) from f_fact
        union all select 'users_present', count(*) > 0, concat('user_rows=', count(*)) from user_dim
        union all select 'calls_present', max(created_at) is not null, strftime(max(created_at), '%Y-%m-%d %H:%M:%S')
        from call_fact""")
_ONE = f"(select {FUNNEL} from f_fact where {IN_MONTH})"
add("c05_report_sanity", lambda e: checks.report_sanity(e.fact, MONTH, YEAR),
    f"""select 'enrolls_within_leads' as "check", Leads = 0 or Enrolls <= Leads as ok,
        concat('Enrolls=', Enrolls, ' Leads=', Leads) as detail from {_ONE}
        union all select 'same_month_within_enrolls', Same_Month_Enrolls <= Enrolls,
        concat('Same_Month_Enrolls=', Same_Month_Enrolls, ' Enrolls=', Enrolls) from {_ONE}""")


def _added(dim: str) -> str:
    return f"(select sum(n) from (select {LEADS} as n from f_fact where {IN_MONTH} group by {dim}))"


_TOTAL = f"(select {LEADS} from f_fact where {IN_MONTH})"
add("c06_reconciliation", lambda e: checks.reconciliation(e.fact, MONTH, YEAR),
    f"""select 'source_leads_add_up' as "check", a = t as ok, concat('by_source=', a, ' Leads=', t) as detail
        from (select {_added('source_attribution_final')} as a, {_TOTAL} as t)
        union all select 'segment_leads_add_up', a = t, concat('by_segment=', a, ' Leads=', t)
        from (select {_added('lead_segment')} as a, {_TOTAL} as t)""")
add("c07_demo_sanity", lambda e: checks.demo_sanity(e.fact, e.users, "dm", MONTH, YEAR),
    f"""select 'completed_within_scheduled' as "check", n = 0 as ok, concat('rows_over=', n) as detail from (
          select count(*) as n from (select DM, {TECH} from {DEMO_ROWS} group by DM)
          where Demos_Tech_Completed > Demos_Tech_Scheduled)
        union all select 'few_unassigned', u <= t * 0.05, concat('unassigned=', u, ' total=', t) from (select
          (select {TECH_S} from {DEMO_ROWS} where DM = '(Unassigned)') as u, (select {TECH_S} from {DEMO_ROWS}) as t)""")
add("c08_ratio_checks", lambda e: checks.ratio_checks(e.fact, MONTH, YEAR),
    " union all ".join(
        [f"""select '{n}_in_range' as "check", r between 0 and 1 as ok, cast(round(r, 6) as varchar) as detail
             from (select {x} as r from f_fact where {IN_MONTH})"""
         for n, x in (("L2D", over(DEMOS, LEADS)), ("L2E", over(ENROLLS, LEADS)), ("D2E", over(ENROLLS, DEMOS)),
                      ("SM_L2E", over(SAME, LEADS)))]
        + [f"""select 'revenue_present', Enrolls = 0 or ifnull(Total_Sale_Value, 0) > 0,
               concat('Enrolls=', Enrolls, ' Total_Sale_Value=', ifnull(cast(Total_Sale_Value as varchar), 'null'))
               from {_ONE}"""]))

# --- audits -------------------------------------------------------------------
add("a01_table_profile", lambda e: audits.table_profile(e.raw["activity_base"], "created_at"),
    "select count(*) as n_rows, min(created_at) as earliest, max(created_at) as latest from raw_activity_base")
add("a02_duplicate_keys", lambda e: audits.duplicate_keys(e.raw["capture_message"], ["activity_id"]),
    "select activity_id, count(*) as n_rows from raw_capture_message group by 1 having count(*) > 1")


def _rate(df: str, other: str, key: str, other_key: str) -> str:
    hit = f"{key} in (select {other_key} from {other} where {other_key} is not null)"
    return f"""select count(*) as n_rows, count(*) filter ({hit}) as n_matched,
      count(*) - count(*) filter ({hit}) as n_orphan,
      (count(*) - count(*) filter ({hit})) / cast(count(*) as double) as orphan_rate,
      count(*) filter ({hit}) / cast(count(*) as double) as coverage_rate from {df}"""


add("a03_orphan_rate",
    lambda e: audits.match_rate(e.raw["activity_extension"], e.raw["activity_base"], "related_activity_id", "id"),
    _rate("raw_activity_extension", "raw_activity_base", "related_activity_id", "id"))
add("a04_metadata_coverage",
    lambda e: audits.match_rate(e.raw["capture_message"], e.raw["capture_metadata"], "id", "lead_capture_message_id"),
    _rate("raw_capture_message", "raw_capture_metadata", "id", "lead_capture_message_id"))
add("a04_extension_coverage",
    lambda e: audits.match_rate(e.raw["leads"], e.raw["lead_extension"], "id", "prospect_id"),
    _rate("raw_leads", "raw_lead_extension", "id", "prospect_id"))
add("a05_value_distribution", lambda e: audits.value_distribution(e.raw["call"], ["call_status", "direction"]),
    """select call_status, direction, count(*) as n_rows, count(*) / cast(sum(count(*)) over () as double) as share
       from raw_call group by 1, 2""")
add("a06_revenue_reconciliation", lambda e: audits.revenue_reconciliation(e.raw["sales"], e.fact),
    f"""select definition, amount, round(cast(amount as double) / cast(first_value(amount) over (order by i) as double), 6)
          as share_of_booked from (
        select i, definition, cast(ifnull(total, 0) as decimal(38,2)) as amount from (
        select 0 as i, 'booked' as definition, sum(sale_value) as total from raw_sales
        union all select 1, 'all_rows', sum(sale_value) from f_fact
        union all select 2, 'enrolled_rows', sum(sale_value) from f_fact where Is_Valid_Enroll = 1
        union all select 3, 'enrolled_captures', sum(sale_value) from f_fact where Is_Valid_Enroll = 1 and {CAP}
        union all select 4, 'max_per_lead_month', sum(v) from (select max(sale_value) as v from f_fact
          where Is_Valid_Enroll = 1 group by activity_month_start, lead_id)))""")
