"""Catalogue of named measures and their evaluator.

A measure is data: an aggregate over a fact under a predicate, or an expression over
other measures.  ``evaluate`` applies measures under a filter context, which is the
caller's ``filter`` plus the grouping ``dims``.

Predicates are plain SQL conditions on fact columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.distinct import count_flags, entity_flags, ratio

CAPTURE = "activity_type_category = 'Lead Capture'"
ENROL = "Is_Valid_Enroll = 1"
FIRST = "Is_First_Assignment_Per_Month = 1"
VALID = "Is_Valid_Call = 1"
CONNECTED = f"{VALID} and Is_Connected_Call = 1"
SCHEDULED = "activity_type_category in ('Demo Scheduled', 'SE Marked Demo Schedule')"
INDIVIDUAL = "sale_ind_pg in ('Individual Course', 'Combined Individual')"
ASSIGNED = "Is_Assigned_This_Month = 1"


@dataclass(frozen=True)
class Measure:
    """One catalogue entry.

    kind: leads, owners (distinct counts), count, sum, avg, max (aggregates under
    ``where``); ratio, prior, delta, change (over other measures in ``args``);
    alias, money, clock, arrow, stamp (display), blank (no source data).
    """

    id: str
    name: str
    section: str
    kind: str
    where: str = "true"
    column: str | None = None
    args: tuple[str, ...] = ()
    hidden: bool = False


def _section(fact: str, title: str, *rows: tuple) -> list[tuple[str, Measure]]:
    out = []
    for mid, name, kind, *rest in rows:
        where = column = None
        args: tuple[str, ...] = ()
        if kind in AGGREGATES:
            where, column = (rest + [None])[:2] if rest else ("true", None)
        else:
            args = tuple(rest)
        out.append((fact, Measure(mid or "", name, title, kind, where or "true", column, args, hidden=not mid)))
    return out


AGGREGATES = {"leads", "owners", "count", "sum", "avg", "max"}
TEXT_KINDS = {"money", "clock", "arrow", "stamp"}

# Measure names, predicates and sections.
_ROWS = [
    *_section(
        "activity", "1 Core Funnel",
        ("M1", "Leads", "leads", CAPTURE),
        ("M2", "Demos_Webinar_Scheduled", "leads", "activity_type_category = 'Demo Scheduled'"),
        ("M3", "Demos_Tech_Scheduled", "leads", "activity_type_category = 'SE Marked Demo Schedule'"),
        ("M4", "Demos_Scheduled", "leads", SCHEDULED),
        ("M5", "Demos_Webinar_Completed", "leads", "activity_type_category = 'Demo Completed - Webinars'"),
        ("M6", "Demos_Tech_Completed", "leads", "activity_type_category = 'SE Marked Demo Completed'"),
        ("M7", "Demos_Completed", "leads",
         "activity_type_category in ('Demo Completed - Webinars', 'SE Marked Demo Completed')"),
        ("M8", "Enrolls", "leads", ENROL),
        ("M9", "Same_Month_Enrolls", "leads", f"{CAPTURE} and SameMonthEnrolls = 'Enrolls'"),
        ("M10", "Revenue", "sum", "true", "sale_value"),
        ("M11", "Revenue_Formatted", "money", "Revenue")),
    *_section(
        "activity", "2 Funnel Ratios",
        ("M12", "L2D%", "ratio", "Demos_Scheduled", "Leads"),
        ("M13", "L2E%", "ratio", "Enrolls", "Leads"),
        ("M14", "D2E%", "ratio", "Enrolls", "Demos_Scheduled"),
        ("M15", "SM_L2E%", "ratio", "Same_Month_Enrolls", "Leads"),
        ("M16", "DS2DC%", "ratio", "Demos_Completed", "Demos_Scheduled"),
        ("M17", "Avg_Sale_Per_Enroll", "ratio", "Revenue", "Enrolls"),
        ("M131", "LA2D%", "ratio", "Demos_Scheduled", "Leads_Assigned"),
        ("M132", "LA2DC%", "ratio", "Demos_Completed", "Leads_Assigned"),
        ("M140", "DC2E%", "ratio", "Enrolls", "Demos_Completed")),
    *_section(
        "activity", "3 Product Split",
        ("M18", "Enrolls_PG", "leads", f"{ENROL} and sale_ind_pg = 'PG'"),
        ("M19", "Enrolls_Individual", "leads", f"{ENROL} and {INDIVIDUAL}"),
        ("M20", "Revenue_PG", "sum", "sale_ind_pg = 'PG'", "sale_value"),
        ("M21", "Revenue_Individual", "sum", INDIVIDUAL, "sale_value"),
        ("M22", "D2E%_PG", "ratio", "Enrolls_PG", "Demos_Scheduled"),
        ("M133", "L2E(P)%", "ratio", "Enrolls_PG", "Leads"),
        ("M134", "D2E(P)%", "ratio", "Enrolls_PG", "Demos_Scheduled"),
        ("M135", "LA2E(P)%", "ratio", "Enrolls_PG", "Leads_Assigned"),
        (None, "Same_Month_Enrolls_PG", "leads",
         f"{CAPTURE} and SameMonthEnrolls = 'Enrolls' and sale_ind_pg = 'PG'"),
        ("M136", "SM_L2E(P)%", "ratio", "Same_Month_Enrolls_PG", "Leads"),
        ("M137", "L2E(I)%", "ratio", "Enrolls_Individual", "Leads"),
        ("M138", "D2E(I)%", "ratio", "Enrolls_Individual", "Demos_Scheduled"),
        ("M139", "LA2E(I)%", "ratio", "Enrolls_Individual", "Leads_Assigned"),
        ("M141", "DC2E(P)%", "ratio", "Enrolls_PG", "Demos_Completed"),
        ("M142", "DC2E(I)%", "ratio", "Enrolls_Individual", "Demos_Completed"),
        ("M147", "Avg_Sale_PG", "ratio", "Revenue_PG", "Enrolls_PG"),
        ("M148", "Avg_Sale_Individual", "ratio", "Revenue_Individual", "Enrolls_Individual")),
    *_section(
        "activity", "4 Lead Segment",
        ("M23", "Leads_New", "leads", f"{CAPTURE} and lead_segment = 'New Lead'"),
        ("M24", "Leads_Old_Capture", "leads", f"{CAPTURE} and lead_segment = 'Old Lead - Capture'"),
        ("M25", "Enrolls_New", "leads", f"{ENROL} and lead_segment = 'New Lead'"),
        ("M26", "Enrolls_Old_Capture", "leads", f"{ENROL} and lead_segment = 'Old Lead - Capture'"),
        ("M27", "Enrolls_Old_Others", "leads", f"{ENROL} and lead_segment = 'Old - Others'"),
        ("M28", "L2E%_New", "ratio", "Enrolls_New", "Leads_New"),
        ("M29", "L2E%_Old_Capture", "ratio", "Enrolls_Old_Capture", "Leads_Old_Capture")),
    *_section(
        "activity", "5 Cohort Lag",
        ("M30", "Enrolls_M0", "leads", "Enroll_Month_Bucket_Capped = 'M+0'"),
        ("M31", "Enrolls_M1", "leads", "Enroll_Month_Bucket_Capped = 'M+1'"),
        ("M32", "Enrolls_M2", "leads", "Enroll_Month_Bucket_Capped = 'M+2'"),
        ("M33", "Enrolls_M3", "leads", "Enroll_Month_Bucket_Capped = 'M+3'"),
        ("M34", "Cumulative_Enrolls_M3", "leads", "Enroll_Month_Bucket_Capped in ('M+0', 'M+1', 'M+2', 'M+3')"),
        ("M35", "Cumulative_L2E%_M3", "ratio", "Cumulative_Enrolls_M3", "Leads")),
    *_section(
        "activity", "6 Assignment",
        ("M36", "Leads_Assigned", "leads", ASSIGNED),
        ("M37", "Leads_Assigned_First", "leads", FIRST),
        ("M38", "Leads_Assigned_New", "leads", f"{FIRST} and assignment_type_month = 'New'"),
        ("M39", "Leads_Assigned_Others", "leads", f"{FIRST} and assignment_type_month = 'Others'"),
        ("M40", "Assignment_Coverage%", "ratio", "Leads_Assigned", "Leads"),
        ("M41", "LA2E%", "ratio", "Enrolls", "Leads_Assigned"),
        ("M143", "Demos_from_Assigned", "leads", f"{SCHEDULED} and {ASSIGNED}"),
        ("M144", "Enrolls_from_Assigned", "leads", f"{ENROL} and {ASSIGNED}"),
        ("M145", "Enrolls_PG_from_Assigned", "leads", f"{ENROL} and {ASSIGNED} and sale_ind_pg = 'PG'"),
        ("M146", "Revenue_from_Assigned", "sum", ASSIGNED, "sale_value")),
    *_section(
        "activity", "7 Star Rank",
        ("M42", "Leads_Assigned_FourStar", "leads", f"{FIRST} and lead_star_rank_at_assign = 'FourStar'"),
        ("M43", "Leads_Assigned_ThreeStar", "leads", f"{FIRST} and lead_star_rank_at_assign = 'ThreeStar'"),
        ("M44", "Leads_Assigned_TwoStar", "leads", f"{FIRST} and lead_star_rank_at_assign = 'TwoStar'"),
        ("M45", "Leads_Assigned_OneStar", "leads", f"{FIRST} and lead_star_rank_at_assign = 'OneStar'"),
        ("M46", "Star_Match_Count", "leads", f"{FIRST} and Is_Star_Match = 1"),
        ("M47", "Star_Match%", "ratio", "Star_Match_Count", "Leads_Assigned_First"),
        ("M48", "Enrolls_FourStar", "leads", f"{ENROL} and lead_star_rank_at_assign = 'FourStar'"),
        ("M49", "Enrolls_ThreeStar", "leads", f"{ENROL} and lead_star_rank_at_assign = 'ThreeStar'"),
        ("M50", "L2E%_FourStar", "ratio", "Enrolls_FourStar", "Leads_Assigned_FourStar"),
        ("M51", "L2E%_ThreeStar", "ratio", "Enrolls_ThreeStar", "Leads_Assigned_ThreeStar"),
        ("M52", "Avg_P1_Score_At_Assign", "avg", FIRST, "p1_score_at_assign"),
        ("M53", "Revenue_FourStar", "sum", "lead_star_rank_at_assign = 'FourStar'", "sale_value")),
    *_section(
        "activity", "8 Owner Performance",
        ("M54", "Leads_Per_BDA", "leads", f"{CAPTURE} and bda_name is not null"),
        ("M55", "Enrolls_Per_BDA", "leads", f"{ENROL} and bda_name is not null"),
        ("M56", "Revenue_Per_BDA", "sum", "bda_name is not null", "sale_value"),
        ("M57", "Active_BDAs", "owners", FIRST, "bda_id"),
        ("M58", "Avg_Enrolls_Per_BDA", "ratio", "Enrolls_Per_BDA", "Active_BDAs"),
        ("M59", "BDA_L2E%", "ratio", "Enrolls_Per_BDA", "Leads_Per_BDA")),
    *_section(
        "activity", "9 Owner Tier",
        ("M60", "Leads_by_Tier", "leads", f"{CAPTURE} and bda_tier is not null"),
        ("M61", "Enrolls_by_Tier", "leads", f"{ENROL} and bda_tier is not null"),
        ("M62", "Revenue_by_Tier", "sum", "bda_tier is not null", "sale_value"),
        ("M63", "L2E%_by_Tier", "ratio", "Enrolls_by_Tier", "Leads_by_Tier"),
        ("M64", "BDAs_per_Tier", "owners", f"{FIRST} and bda_tier is not null", "bda_id")),
    *_section(
        "activity", "10 Source Attribution",
        ("M65", "CPE", "blank"),
        ("M66", "Leads_by_Source", "leads", f"{CAPTURE} and source_attribution_final is not null"),
        ("M67", "Enrolls_by_Source", "leads", f"{ENROL} and source_attribution_final is not null"),
        ("M68", "L2E%_by_Source", "ratio", "Enrolls_by_Source", "Leads_by_Source")),
    *_section(
        "activity", "11 Month over Month",
        ("M69", "Leads_PM", "prior", "Leads"),
        ("M70", "Enrolls_PM", "prior", "Enrolls"),
        ("M71", "Revenue_PM", "prior", "Revenue"),
        ("M72", "Leads_MoM_Delta", "delta", "Leads", "Leads_PM"),
        ("M73", "Leads_MoM%", "change", "Leads", "Leads_PM"),
        ("M74", "Enrolls_MoM%", "change", "Enrolls", "Enrolls_PM"),
        ("M75", "Revenue_MoM%", "change", "Revenue", "Revenue_PM")),
    *_section(
        "activity", "12 Domain and Program",
        ("M76", "Leads_by_Domain", "leads", f"{CAPTURE} and Domain_group is not null"),
        ("M77", "Enrolls_by_Domain", "leads", f"{ENROL} and Domain_group is not null"),
        ("M78", "Enrolls_by_Program", "leads", f"{ENROL} and sale_program is not null"),
        ("M79", "Revenue_by_Program", "sum", "sale_program is not null", "sale_value")),
    *_section(
        "activity", "13 Data Quality",
        ("M80", "System_Leads", "leads", "Is_System_Activity = 1"),
        ("M81", "Total_Rows", "count"),
        ("M82", "Unique_Leads", "leads"),
        ("M83", "Latest_Activity_Date", "max", "true", "created_at")),
    *_section(
        "activity", "14 Customer Profile",
        ("M84", "Leads_Job_Seeker", "leads", f"{CAPTURE} and Customer_Profile = 'JOB SEEKER'"),
        ("M85", "Leads_Student", "leads", f"{CAPTURE} and Customer_Profile = 'STUDENT'"),
        ("M86", "Leads_Working_Professional", "leads", f"{CAPTURE} and Customer_Profile = 'WORKING PROFESSIONAL'")),
    *_section(
        "activity", "15 KPI Cards",
        ("M87", "KPI_Leads", "alias", "Leads"),
        ("M88", "KPI_Enrolls", "alias", "Enrolls"),
        ("M89", "KPI_Revenue", "alias", "Revenue"),
        ("M90", "KPI_L2E", "alias", "L2E%"),
        ("M91", "KPI_Leads_MoM_Arrow", "arrow", "Leads_MoM%"),
        ("M92", "KPI_Enrolls_MoM_Arrow", "arrow", "Enrolls_MoM%")),
    *_section(
        "call", "1 Core Calling",
        ("M93", "Dials", "count", VALID, "call_id"),
        ("M94", "Dialled_Leads", "leads", VALID),
        ("M95", "Connected_Leads", "leads", CONNECTED),
        ("M96", "Connected_Calls", "count", CONNECTED, "call_id"),
        ("M97", "DNP_Leads", "leads", f"{VALID} and Is_DNP_Call = 1"),
        ("M98", "DNP_Calls", "count", f"{VALID} and Is_DNP_Call = 1", "call_id")),
    *_section(
        "call", "2 Calling Ratios",
        ("M99", "Connectivity%", "ratio", "Connected_Leads", "Dialled_Leads"),
        ("M100", "DNP_Rate", "ratio", "DNP_Leads", "Dialled_Leads"),
        ("M101", "CC_per_Lead", "ratio", "Connected_Calls", "Connected_Leads"),
        ("M102", "Dials_per_Lead", "ratio", "Dials", "Dialled_Leads")),
    *_section(
        "call", "3 Duration",
        ("M103", "Avg_Call_Duration_Sec", "avg", CONNECTED, "call_duration_sec"),
        ("M104", "Avg_Call_Duration_Formatted", "clock", "Avg_Call_Duration_Sec"),
        ("M105", "Calls_Under_30s", "count", f"{VALID} and call_duration_bucket = '<30s'", "call_id"),
        ("M106", "Calls_30_60s", "count", f"{VALID} and call_duration_bucket = '30-60s'", "call_id"),
        ("M107", "Calls_60_180s", "count", f"{VALID} and call_duration_bucket = '60-180s'", "call_id"),
        ("M108", "Calls_Over_180s", "count", f"{VALID} and call_duration_bucket = '>180s'", "call_id"),
        (None, "Quality_Calls", "count", f"{CONNECTED} and call_duration_sec > 60", "call_id"),
        ("M109", "Quality_Call%", "ratio", "Quality_Calls", "Connected_Calls")),
    *_section(
        "call", "4 Owner Calling",
        ("M110", "Active_Calling_BDAs", "owners", VALID, "se_user_id"),
        ("M111", "Dials_per_BDA", "ratio", "Dials", "Active_Calling_BDAs"),
        ("M112", "Connected_per_BDA", "ratio", "Connected_Calls", "Active_Calling_BDAs"),
        ("M113", "Dialled_Leads_per_BDA", "ratio", "Dialled_Leads", "Active_Calling_BDAs")),
    *_section(
        "call", "5 Manual and Auto",
        ("M114", "Dials_Manual", "count", f"{VALID} and is_manual_call_done = true", "call_id"),
        ("M115", "Dials_Auto", "count", f"{VALID} and is_manual_call_done = false", "call_id"),
        ("M116", "Manual_Call%", "ratio", "Dials_Manual", "Dials")),
    *_section(
        "call", "6 Calling Month over Month",
        ("M117", "Dials_PM", "prior", "Dials"),
        ("M118", "Connected_Leads_PM", "prior", "Connected_Leads"),
        ("M119", "Connectivity%_PM", "prior", "Connectivity%"),
        ("M120", "Dials_MoM%", "change", "Dials", "Dials_PM")),
    *_section(
        "call", "7 By Domain",
        ("M125", "Dials_by_Domain", "count", f"{VALID} and Domain_group is not null", "call_id"),
        ("M126", "Connected_by_Domain", "count", f"{CONNECTED} and Domain_group is not null", "call_id"),
        (None, "Connected_Domain_Leads", "leads", f"{CONNECTED} and Domain_group is not null"),
        (None, "Dialled_Domain_Leads", "leads", f"{VALID} and Domain_group is not null"),
        ("M127", "Connectivity%_by_Domain", "ratio", "Connected_Domain_Leads", "Dialled_Domain_Leads")),
    *_section(
        "call", "8 By Tier",
        ("M128", "Dials_by_Tier", "count", f"{VALID} and bda_tier is not null", "call_id"),
        ("M129", "Connected_by_Tier", "count", f"{CONNECTED} and bda_tier is not null", "call_id"),
        (None, "Connected_Tier_Leads", "leads", f"{CONNECTED} and bda_tier is not null"),
        (None, "Dialled_Tier_Leads", "leads", f"{VALID} and bda_tier is not null"),
        ("M130", "Connectivity%_by_Tier", "ratio", "Connected_Tier_Leads", "Dialled_Tier_Leads")),
    *_section(
        "call", "9 KPI Cards",
        ("M121", "KPI_Dials", "alias", "Dials"),
        ("M122", "KPI_Connectivity", "alias", "Connectivity%"),
        ("M123", "KPI_Avg_Duration", "alias", "Avg_Call_Duration_Formatted"),
        ("M124", "KPI_Dials_MoM_Arrow", "arrow", "Dials_MoM%")),
]
CATALOGUE: dict[str, dict[str, Measure]] = {
    fact: {m.name: m for f, m in _ROWS if f == fact} for fact in ("activity", "call")}
MONTH_COLUMN = {"activity": "activity_month_start", "call": "call_month_start"}


def sections(fact: str) -> dict[str, list[Measure]]:
    """Visible measures by section, in catalogue order."""
    out: dict[str, list[Measure]] = {}
    for m in CATALOGUE[fact].values():
        if not m.hidden:
            out.setdefault(m.section, []).append(m)
    return out


def needed(fact: str, names: Sequence[str]) -> list[Measure]:
    """The measures and everything they are computed from, inputs first."""
    found: dict[str, Measure] = {}

    def visit(name: str) -> None:
        m = CATALOGUE[fact][name]
        for a in m.args:
            visit(a)
        found.setdefault(name, m)
    for n in names:
        visit(n)
    return list(found.values())


def _aggregate(df: DataFrame, dims: Sequence[str], parts: Sequence[Measure]) -> DataFrame:
    """All direct aggregates per group: two-phase per counted entity, then merged."""
    def value(m: Measure, default: Column | None = None) -> Column:
        return F.when(F.expr(m.where), F.col(m.column) if m.column else default)

    leads = {m.name: F.expr(m.where) for m in parts if m.kind == "leads"}
    sums: dict[str, Column] = {}
    for m in parts:
        if m.kind == "sum":
            sums[m.name] = value(m)
        elif m.kind == "count":
            sums[m.name] = F.when(value(m, F.lit(1)).isNotNull(), 1).otherwise(0)
        elif m.kind == "avg":
            sums[f"{m.name}|sum"] = value(m)
            sums[f"{m.name}|n"] = F.when(value(m).isNotNull(), 1).otherwise(0)
    maxes = {m.name: value(m) for m in parts if m.kind == "max"}
    per_lead = entity_flags(df, dims, "lead_id", leads, sums, maxes)
    branches = [count_flags(per_lead, dims, "lead_id", list(leads), list(sums), list(maxes))]
    owner_keys = {m.column for m in parts if m.kind == "owners"}
    for key in sorted(owner_keys):
        flags = {m.name: F.expr(m.where) for m in parts if m.kind == "owners" and m.column == key}
        branches.append(count_flags(entity_flags(df, dims, key, flags), dims, key, list(flags)))
    if len(branches) == 1:
        return branches[0]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)
    return merged.groupBy(*dims).agg(*[F.max(f"`{c}`").alias(c) for c in merged.columns if c not in dims])


def _arrow(x: Column) -> Column:
    percent = F.format_string("%.1f%%", F.round(x * 100, 1))
    return (F.when(x > 0, F.concat(F.lit("▲ "), percent))
            .when(x < 0, F.concat(F.lit("▼ "), percent))
            .otherwise(F.lit("─ 0.0%")))


def _money(v: Column) -> Column:
    x = v.cast("double")
    def shown(scale: int, places: int) -> Column:
        return F.format_number(F.round(x / scale, places), places)
    return (F.when(x >= 100000, F.concat(shown(100000, 2), F.lit(" L")))
            .when(x >= 1000, F.concat(shown(1000, 1), F.lit(" K")))
            .otherwise(shown(1, 0)))


def _clock(seconds: Column) -> Column:
    whole = F.floor(seconds)
    text = F.concat(F.floor(whole / 60).cast("string"), F.lit(":"), F.lpad((whole % 60).cast("string"), 2, "0"))
    return F.when(seconds.isNull(), F.lit("-")).otherwise(text)


def evaluate(df: DataFrame, fact: str, names: Sequence[str], dims: Sequence[str] = ()) -> DataFrame:
    """Measures as columns, one row per group of ``dims``.

    Prior-month measures need the fact's month column among the dims.  A group that
    exists in one of two neighbouring months only is kept in both.
    """
    chain = needed(fact, names)
    month = MONTH_COLUMN[fact]
    base = _aggregate(df, dims, [m for m in chain if m.kind in AGGREGATES])
    for m in chain:
        if m.kind == "avg":
            base = base.withColumn(m.name, ratio_or_null(F.col(f"`{m.name}|sum`"), F.col(f"`{m.name}|n`")))

    def derive(df: DataFrame, m: Measure) -> DataFrame:
        a = [F.col(f"`{x}`") for x in m.args]
        column = {
            "ratio": lambda: ratio(a[0], a[1]),
            "delta": lambda: F.coalesce(a[0], F.lit(0)) - F.coalesce(a[1], F.lit(0)),
            "change": lambda: ratio(F.coalesce(a[0], F.lit(0)) - F.coalesce(a[1], F.lit(0)), a[1]),
            "alias": lambda: a[0], "blank": lambda: F.lit(None).cast("double"),
            "money": lambda: _money(a[0]), "clock": lambda: _clock(a[0]), "arrow": lambda: _arrow(a[0]),
        }[m.kind]()
        return df.withColumn(m.name, column)

    # inputs of prior-month measures, then the shift, then everything that reads it
    prior = [m for m in chain if m.kind == "prior"]
    if prior:
        if month not in dims:
            raise ValueError(f"prior-month measures need {month} among the dims")
        inputs = needed(fact, [p.args[0] for p in prior])
        for m in inputs:
            if m.kind not in AGGREGATES:
                base = derive(base, m)
        ready = {m.name for m in inputs}
        shifted = base.select(
            *[F.add_months(d, 1).alias(d) if d == month else d for d in dims],
            *[F.col(f"`{p.args[0]}`").alias(p.name) for p in prior])
        base = base.unionByName(shifted, allowMissingColumns=True)
        base = base.groupBy(*dims).agg(*[F.max(f"`{c}`").alias(c) for c in base.columns if c not in dims])
    else:
        ready = set()
    for m in chain:
        if m.kind not in AGGREGATES | {"prior"} and m.name not in ready:
            base = derive(base, m)
    return base.select(*dims, *[F.col(f"`{n}`") for n in names])


def ratio_or_null(total: Column, n: Column) -> Column:
    return F.try_divide(total.cast("double"), n.cast("double"))


def is_text(fact: str, m: Measure) -> bool:
    source = CATALOGUE[fact][m.args[0]] if m.kind == "alias" else m
    return source.kind in TEXT_KINDS


def long_form(wide: DataFrame, fact: str, names: Sequence[str], dims: Sequence[str]) -> DataFrame:
    """Measures as rows: (dims…, measure, value, value_text)."""
    entries = []
    for n in names:
        m, col = CATALOGUE[fact][n], F.col(f"`{n}`")
        stamp = m.kind == "max"
        text = F.date_format(col, "yyyy-MM-dd HH:mm:ss") if stamp else col if is_text(fact, m) else F.lit(None)
        number = F.lit(None) if stamp or is_text(fact, m) else col
        entries.append(F.struct(F.lit(n).alias("measure"), number.cast("double").alias("value"),
                                text.cast("string").alias("value_text")))
    return wide.select(*dims, F.inline(F.array(*entries)))


def section_report(df: DataFrame, fact: str, section: str, dims: Sequence[str]) -> DataFrame:
    names = [m.name for m in sections(fact)[section]]
    return long_form(evaluate(df, fact, names, dims), fact, names, dims)
