"""CRM-shaped raw tables derived from the driver's star-schema tables.

Every raw table is a UNION ALL of branches ``select <columns> from <table> [where]``.
The expressions are plain SQL that Spark and DuckDB both read; the few functions that
differ come from a :class:`Dialect`.  So queries and their reference SQL start from the
same rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from .schemas import LEAD_EXTENSION_TEXT, RAW_SCHEMAS


@dataclass(frozen=True)
class Dialect:
    json_k: str
    add_days: str
    add_seconds: str
    add_date_days: str
    ntz: str


SPARK = Dialect(
    json_k="cast(get_json_object(props, '$.k') as int)",
    add_days="timestampadd(DAY, cast({n} as int), {t})",
    add_seconds="timestampadd(SECOND, cast({n} as int), {t})",
    add_date_days="date_add({t}, cast({n} as int))",
    ntz="timestamp_ntz")
DUCK = Dialect(
    json_k="cast(json_extract_string(props, '$.k') as int)",
    add_days="({t} + to_days(cast({n} as int)))",
    add_seconds="({t} + to_seconds(cast({n} as int)))",
    add_date_days="cast({t} + cast({n} as int) as date)",
    ntz="timestamp")


@dataclass(frozen=True)
class Branch:
    table: str
    columns: dict[str, str]
    where: str | None = None


@dataclass
class Expressions:
    """Shared expressions in one dialect."""

    d: Dialect
    k: str = field(init=False)
    happened: str = field(init=False)
    assigned: str = field(init=False)

    def __post_init__(self):
        self.k = "k"  # parsed once per row
        # every tenth user is silent for long stretches
        self.happened = self.d.add_days.format(
            t="ts", n=f"case when user_id % 10 = 0 then 150 * ({self.k} % 3) else 5 * {self.k} end")
        self.assigned = self.d.add_days.format(t="ts", n=f"3 * {self.k}")

    def later(self, t: str, seconds: str | int) -> str:
        return self.d.add_seconds.format(t=t, n=seconds)

    def day(self, start: str, n: str) -> str:
        return self.d.add_date_days.format(t=f"date '{start}'", n=n)


def cycle(expr: str, values: list[str | None]) -> str:
    """CASE over ``expr % len(values)``."""
    arms = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values) if v is not None)
    return f"case {expr} % {len(values)} {arms} end"


ACTIVITY_CODE = (
    "case event_type when 'signup' then case event_id % 3 when 0 then 310 else 23 end when 'view' then 2 "
    "when 'purchase' then 98 when 'click' then case event_id % 6 when 0 then 920 when 1 then 393 when 2 then 395 "
    "when 3 then 342 when 4 then 318 else 319 end else case event_id % 8 when 0 then 506 when 1 then 507 "
    "when 2 then 777 when 3 then 2500 when 4 then 2502 when 5 then 295 when 6 then 433 else 9999 end end")
# Type table rows ride on the 25 nations.
NATION_CODE = (
    "case n_nationkey when 0 then 23 when 1 then 310 when 2 then 2 when 3 then 98 when 4 then 920 when 5 then 393 "
    "when 6 then 395 when 7 then 342 when 8 then 318 when 9 then 319 when 10 then 506 when 11 then 507 "
    "when 12 then 777 when 13 then 2500 when 14 then 2502 when 15 then 295 when 16 then 433 when 17 then 9999 "
    "when 18 then 510 when 19 then 921 when 20 then 316 when 21 then 9629 when 22 then 397 when 23 then 259 "
    "else 926 end")
EMAIL = ("concat('customer', lpad(cast({key} as string), 9, '0'), "
         "case when {key} % 19 = 0 then '@internal.example' else '@mail.example' end)")
CALL_STATUS = ("case event_id % 5 when 0 then 'connected' when 1 then 'dnpWithinLimit' when 2 then null "
               "else 'dnp' end")
IS_CALL = "event_type in ('error', 'click')"
IS_REDIAL = IS_CALL + " and event_id % 10 = 0"


def _text(col: str) -> str:
    return f"cast({col} as string)"


def branches(d: Dialect) -> dict[str, list[Branch]]:
    x = Expressions(d)
    k, happened = x.k, x.happened
    key = "c_custkey"
    born = f"cast({x.day('2023-10-01', f'({key} * 37) % 500')} as {d.ntz})"

    activity = Branch("events", {
        "id": _text("event_id"),
        "prospect_id": f"case when event_id % 97 <> 5 then {_text('user_id')} end",
        "type_id": f"case when event_id % 101 = 7 then 'T-none' else concat('T', {ACTIVITY_CODE}) end",
        "event_id": "concat('E', event_type)",
        "created_at": happened, "updated_at": x.later(happened, "event_id % 50"), "activity_date": happened,
        "created_by_id": "concat('U', event_id % 10)", "modified_by_id": "case when event_id % 3 = 0 then 'U1' end",
        "source": cycle("event_id", ["web", None, "app"]), "source_medium": cycle("event_id", [None, "cpc"]),
        "source_campaign": cycle("event_id", ["spring", None, "autumn", None]),
        "form_name": cycle("event_id", ["Form A", None, "Form B", None]), "score": k,
        "activity_note": "concat('note ', event_type)",
        "web_url": f"concat('https://site.example/', {k})", "web_referrer": cycle("event_id", [None, "ref"])})

    kinds = Branch("nation", {
        "id": f"concat('T', {NATION_CODE})", "activity_code": NATION_CODE,
        "display_name": f"case {NATION_CODE} when 310 then 'FB Form' when 23 then 'Download' "
                        f"else concat('Type ', {NATION_CODE}) end",
        "direction": f"case when {NATION_CODE} in (506, 507, 777) then 'Outbound' end",
        "is_done_by_system": "n_nationkey % 5 = 0"})

    def extension(offset: int, where: str | None) -> Branch:
        return Branch("events", {
            "related_activity_id": _text(f"event_id + {offset}"), "owner_id": _text(f"6 + (event_id + {k}) % 4"),
            "status": cycle("event_id", ["Active", None, "Inactive"]),
            "mx_custom39": f"case when event_id % 2 = 0 then concat('c', {k}) end"}, where)

    lead = Branch("customer", {
        "id": _text(key), "first_name": "substr(c_name, 1, 8)", "last_name": f"case when {key} % 23 <> 0 then {_text(key)} end",
        "email_address": EMAIL.format(key=key), "phone": f"concat('9', lpad({_text(key)}, 9, '0'))",
        "national_number": f"lpad({_text(key)}, 10, '7')", "phone_country_code": cycle(key, ["91", "1"]),
        "timezone": cycle(key, ["Asia/Kolkata", None]), "age": f"cast(18 + {key} % 30 as int)",
        "created_on": born, "modified_on": born, "lead_conversion_date": f"cast(null as {d.ntz})",
        "current_owner_assignment_date": born, "prospect_stage": cycle(key, ["Prospect", "Qualified", "Lost", None]),
        "owner_id": _text(f"6 + {key} % 4"), "current_owner_assignment_id": f"concat('A', {key})",
        "is_customer": f"{key} % 11 = 0", "is_lead": f"{key} % 11 <> 0", "do_not_call": f"{key} % 29 = 0",
        "do_not_email": f"{key} % 31 = 0", "do_not_sms": f"{key} % 37 = 0",
        "city": cycle(key, ["Pune", "Delhi", None]), "state": cycle(key, ["MH", "DL", None]),
        "country": cycle(key, ["India", "India", "USA"]), "country_code": cycle(key, ["IN", "IN", "US"]),
        "source": cycle(key, ["Website", None, None]), "source_medium": cycle(key, ["cpc", "organic", None, "email"]),
        "source_campaign": cycle(key, ["FB_leads", None, "meta_spring", "newsletter", None]),
        "first_source": cycle(key, [None, "Referral", None]), "first_original_source": cycle(key, [None, "Fair"]),
        "utm_device": cycle(key, ["mobile", "desktop"]), "utm_source": cycle(key, ["g", None]),
        "score": f"cast({key} % 100 as int)", "engagement_score": f"cast({key} % 50 as int)",
        "total_visits": f"cast({key} % 20 as int)",
        "star_rank": cycle(key, ["FourStar", "TwoStar", None]), "team_domain": cycle(key, ["mech", "fsd"]),
        "related_prospect_id": "cast(null as string)", "verified_otp": f"{key} % 2 = 0"}, f"{key} % 17 <> 3")

    special = {
        "mx_domain": "case c_mktsegment when 'MACHINERY' then 'Mechanical' when 'AUTOMOBILE' then 'HEV' "
                     "when 'BUILDING' then 'Civil Engg' when 'FURNITURE' then 'Product Design' "
                     "else 'embedded systems' end",
        "mx_student_or_working_professional": cycle(key, [
            "Working Professional", "Job Seeker", "Unemployed", "Student", "Fresher", "working professional",
            "TBD", None])}
    lead_extension = Branch("customer", {
        "prospect_id": _text(key), "team_domain": cycle(key, ["mech", "fsd", "ev", None]),
        **{c: special.get(c, f"case when {key} % {i + 2} = 0 then concat('v', {key} % {i + 3}) end")
           for i, c in enumerate(LEAD_EXTENSION_TEXT.split())}}, f"{key} % 4 <> 1")
    star = Branch("customer", {"id": _text(key), "latest_star_rank": cycle(key, ["FourStar", "TwoStar", None])},
                  f"{key} % 3 <> 2")

    def message(prefix: str, delay: int, where: str) -> Branch:
        return Branch("events", {
            "id": f"concat('{prefix}', event_id)", "prospect_id": _text("user_id"), "activity_id": _text("event_id"),
            "message": f"concat('{{\"k\":', {k}, '}}')", "created_at": x.later(happened, delay)}, where)

    def metadata(prefix: str, delay: int, source: str, where: str) -> Branch:
        return Branch("events", {
            "lead_capture_message_id": f"concat('{prefix}', event_id)", "source": source,
            "source_medium": cycle(k, ["organic", "cpc", None]),
            "source_campaign": cycle(k, ["website_conv_x", None]),
            "program_name": cycle(k, [None, "Program A", None, "Program B", None, None, None]),
            "course_id": f"concat('C', {k} % 9)", "created_at": x.later(happened, delay)}, where)

    sources = cycle(k, [
        None, "YouTube_ad", "ig", "google_search", "partner", "linkedin.com", "Direct Grow", "whatsapp",
        "site_resource", "https://site.example/x", "www.bing.com", "webengage", "IIT Jammu EV", "google_video",
        "googlexvideo", "FB", "https://grow.site.example"])
    signup = "event_type = 'signup'"

    assignment = Branch("events", {
        "id": _text("event_id + 10000000"), "prospect_id": _text("user_id"), "created_by_id": "'system'",
        "selected_user_id": f"case when event_id % 9 <> 0 then {_text(f'6 + (event_id + {k}) % 4')} end",
        "from_user_id": cycle("event_id", [None, "6", "7"]),
        "prospect_star_rank": cycle("event_id", ["FourStar", "ThreeStar", "TwoStar", "OneStar", None]),
        "selected_user_rank": cycle("event_id", ["FourStar", "TwoStar", None]),
        "assignment_type": cycle(k, ["New", "Others"]), "team_domain": cycle("event_id", ["mech", "ev", None]),
        "prospect_domain": cycle("event_id", ["mech", None]), "prospect_rank": "cast(null as string)",
        "current_stage": cycle("event_id", ["New", "Open"]), "created_at": x.assigned, "updated_at": x.assigned,
        "priority_score1": f"cast({k} * 37 % 101 as decimal(18,6))", "priority_score2": "cast(null as decimal(18,6))",
        "source_score": f"cast({k} % 10 as int)", "lead_type_score": f"cast({k} % 7 as int)",
        "current_week_activity_score": f"cast({k} % 5 as int)"})

    redial_at = x.later(happened, "3 + event_id % 6")

    def call(offset: int, at: str, manual: str, where: str) -> Branch:
        return Branch("events", {
            "id": _text(f"event_id + {offset}"), "prospect_id": _text("user_id"), "user_id": _text(f"6 + (event_id + {k}) % 4"),
            "call_status": CALL_STATUS, "direction": "'Outbound'", "original_call_status": CALL_STATUS,
            "comments": "cast(null as string)", "platform_type": cycle("event_id", ["web", "app"]),
            "created_at": at, "updated_at": at, "is_manual_call_done": manual}, where)

    def call_event(offset: int, at: str, kind: str, where: str, shift: int = 0) -> Branch:
        i = f"(event_id + {offset})"
        body = (
            f"""concat('{{"duration":"', case when {i} % 11 = 0 then 'n/a' else cast(({i} + {shift}) % 400 as string) """
            f"""end, '","status1":"', case when {i} % 7 = 0 then ' ' else 'Connected' end, '","status2":"', """
            f"""case when {i} % 3 = 0 then 'Connected' else 'Missed' end, '","dialstatus":"', case when {i} % 3 = 0 """
            f"""then 'answered' else 'noanswer' end, '","caller":"9', {i} % 7, '","receiver":"8', {i} % 9, '"}}')""")
        return Branch("events", {"call_id": _text(i), "event_type": f"'{kind}'", "event_data": body,
                                 "created_at": at}, f"{where} and {i} % 13 <> 5")

    sale = Branch("orders", {
        "lead_email": f"concat(' ', upper({EMAIL.format(key='o_custkey')}))",
        "sale_date": x.later(f"cast({x.day('2024-01-01', 'o_orderkey % 500')} as {d.ntz})", "o_orderkey * 7919 % 86400"),
        "sale_value": "cast(o_totalprice as decimal(18,2))",
        "sale_program": cycle("o_orderkey", ["Program A", "Program B", None]),
        "sale_ind_pg": "case when o_orderpriority = '1-URGENT' then 'PG' when o_orderpriority = '2-HIGH' "
                       "then 'Combined Individual' else 'Individual Course' end"})

    s = "s_suppkey"
    user_mail = f"concat('Owner', {s}, '@team.example')"
    user = Branch("supplier", {
        "id": _text(s), "first_name": "'Owner'", "last_name": f"case when {s} % 10 <> 7 then {_text(s)} end",
        "email": user_mail,
        "role": f"case when {s} = 0 then 'ad' when {s} in (1, 2) then 'rsm' when {s} in (3, 4, 5) then 'dm' else 'se' end",
        "region": cycle(s, ["North", "South", None]), "workforce_id": f"cast({s} as int)",
        "dm": f"case when {s} > 5 and {s} % 4 <> 0 then cast(3 + {s} % 3 as int) end",
        "rsm": f"case when {s} in (3, 4, 5) then cast(1 + {s} % 2 as int) when {s} > 5 then 2 end",
        "ad": f"case when {s} in (1, 2) then 0 end", "is_deleted": f"{s} % 9 = 4"})
    tier = Branch("supplier", {
        "email": f"upper({user_mail})", "tier": cycle(s, ["A", "B", "C", "New"]),
        "status": cycle(s, ["Active", "Inactive", "Active"])}, f"{s} % 3 <> 1")

    return {
        "activity_base": [activity],
        "activity_type": [kinds],
        "activity_extension": [extension(0, "event_id % 3 <> 0"), extension(50_000_000, None)],
        "leads": [lead], "lead_extension": [lead_extension], "lead_star": [star],
        "capture_message": [message("M", 1, signup), message("N", 60, signup + " and event_id % 5 = 0")],
        "capture_metadata": [
            metadata("M", 2, sources, signup + " and event_id % 6 <> 1"),
            metadata("M", 1, "'stale'", signup + " and event_id % 7 = 0"),
            metadata("N", 62, "'facebook.com'", signup + " and event_id % 10 = 0")],
        "assignment_history": [assignment],
        "call": [call(0, happened, "event_id % 2 = 0", IS_CALL), call(20_000_000, redial_at, "false", IS_REDIAL)],
        "call_event": [
            call_event(0, happened, "completed", IS_CALL),
            call_event(20_000_000, redial_at, "completed", IS_REDIAL),
            call_event(0, x.later(happened, -5), "completed", IS_CALL + " and event_id % 4 = 0", 50),
            call_event(0, x.later(happened, 5), "answered", IS_CALL + " and event_id % 4 = 2", 90)],
        "sales": [sale], "user": [user], "owner_tier": [tier],
    }


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The raw CRM tables over the driver's parquet files, in their fixed schemas."""
    sources: dict[str, DataFrame] = {}
    out = {}
    for name, parts in branches(SPARK).items():
        schema = RAW_SCHEMAS[name]
        frames = []
        for b in parts:
            if b.table not in sources:
                df = spark.read.parquet(f"{sf_dir}/{b.table}.parquet")
                sources[b.table] = df.selectExpr("*", f"{SPARK.json_k} as k") if b.table == "events" else df
            df = sources[b.table].filter(b.where) if b.where else sources[b.table]
            frames.append(df.selectExpr(*[
                f"cast({b.columns[f.name]} as {f.dataType.simpleString()}) as `{f.name}`" for f in schema]))
        out[name] = reduce(DataFrame.unionAll, frames)
    return out


_DUCK_TYPES = {"timestamp_ntz": "timestamp", "string": "varchar", "int": "integer"}


def duck_views() -> dict[str, str]:
    """The same raw tables as SELECT texts (``raw_<name>``) for the reference SQL."""
    views = {}
    for name, parts in branches(DUCK).items():
        schema = RAW_SCHEMAS[name]
        selects = []
        for b in parts:
            cols = ", ".join(
                f"cast({b.columns[f.name]} as {_DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())})"
                f" as {f.name}" for f in schema)
            source = f"(select *, {DUCK.json_k} as k from events)" if b.table == "events" else b.table
            selects.append(f"select {cols} from {source}" + (f" where {b.where}" if b.where else ""))
        views[f"raw_{name}"] = " union all ".join(selects)
    return views
