"""Prep views: decode, de-duplicate and union the raw tables (all lazy)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.dates import seconds_crossed
from ..operators import bloom
from ..operators.keyed import latest_per_key
from ..operators.previous import with_previous_time
from ..sources.schemas import LEAD_EXTENSION_TEXT
from ..sources.tables import Tables

ASSIGNMENT_ONLY = [
    "selected_user_id_assign", "from_user_id", "priority_score1", "priority_score2",
    "prospect_star_rank_at_assign", "selected_user_rank", "assignment_type",
    "assignment_team_domain", "prospect_domain", "source_score", "lead_type_score",
]


def unified_activity(t: Tables, *, prune_orphans: bool = True, numbered: bool = False) -> DataFrame:
    """Activities with decoded type and the owner from the extension.

    Activities of an unknown type drop out.  Of the extension, mostly orphan rows, only
    four columns are read, and with ``prune_orphans`` a Bloom filter of the activity ids
    (:mod:`crmfunnel.operators.bloom`, built by one aggregation within the query) drops
    nearly all orphans in the extension's scan, before the join's exchange; the rows are the same.
    ``numbered`` adds ``extension_copy``: the number of an extension row among the rows of its activity
    (1, 2, ... ordered by their values; NULL without one), counted in the join's own partitioning by
    activity, so that copies of one row stay apart where rows are ordered.
    """
    base = t["activity_base"].select(
        F.col("id").alias("activity_id"), "prospect_id", "type_id", "event_id", "created_at", "updated_at",
        "activity_date", "created_by_id", "modified_by_id",
        *[F.col(c).alias(f"activity_{c}") for c in ("source", "source_medium", "source_campaign")],
        "form_name", F.col("score").alias("activity_score"), "activity_note", "web_url", "web_referrer")
    kinds = t["activity_type"].select(
        F.col("id").alias("type_id"),
        *[F.col(c).alias(f"activity_type_{c}") for c in ("activity_code", "display_name", "direction")],
        "is_done_by_system")
    extension = t["activity_extension"].select(
        F.col("related_activity_id").alias("activity_id"), F.col("owner_id").alias("activity_owner_id"),
        F.col("status").alias("extension_status"), "mx_custom39")
    if prune_orphans:
        extension = extension.filter(bloom.build(base, "activity_id").might_contain(F.col("activity_id")))
    if numbered:
        copies = Window.partitionBy("activity_id").orderBy(
            *[F.col(c).asc_nulls_first() for c in ("activity_owner_id", "extension_status", "mx_custom39")])
        extension = extension.withColumn("extension_copy", F.row_number().over(copies))
    ordered = base.columns + kinds.columns[1:] + extension.columns[1:]
    return base.join(kinds, "type_id").join(extension, "activity_id", "left").select(*ordered)


def active_prospects(stream: DataFrame, calls: DataFrame) -> DataFrame:
    """Prospects with an activity or a call, one row each."""
    return (stream.select("prospect_id").unionAll(calls.select("prospect_id"))
            .filter(F.col("prospect_id").isNotNull()).distinct())


def only_active(t: Tables, active: DataFrame) -> dict[str, DataFrame]:
    """Raw tables whose lead tables are cut to active prospects.

    Few of all leads are ever active, and the facts read no other.  Where the active ids
    are small, Spark's size check makes the semi-joins broadcast joins, and the bulk of
    the lead tables is dropped in its scan stage.
    """
    keys = {"leads": "id", "lead_extension": "prospect_id", "lead_star": "id"}
    return dict(t) | {
        name: t[name].join(active.select(F.col("prospect_id").alias(key)), key, "left_semi")
        for name, key in keys.items()}


def star_ranks(t: Tables, *, dedupe: bool = False) -> DataFrame:
    """Current star rank per lead; ``dedupe`` keeps the highest label of each lead."""
    stars = t["lead_star"].select("id", F.col("latest_star_rank").alias("lead_star_rank"))
    return stars.groupBy("id").agg(F.max("lead_star_rank").alias("lead_star_rank")) if dedupe else stars


def unified_leads(t: Tables, *, dedupe_stars: bool = False) -> DataFrame:
    """Lead master with extension attributes, star rank and profile labels."""
    l = t["leads"]
    renamed = {
        "source": "lead_source_raw", "source_medium": "lead_source_medium_raw",
        "source_campaign": "lead_source_campaign_raw", "score": "lead_score", "team_domain": "lead_team_domain",
    }
    leads = l.select(
        *[F.col(c).alias(renamed.get(c, c)) for c in l.columns],
        F.coalesce("source", "first_source", "first_original_source").alias("Lead_Source"),
        F.col("source_medium").alias("Lead_Source_Medium"),
        F.col("source_campaign").alias("Lead_Source_Campaign"))
    answer = F.col("mx_student_or_working_professional")
    extension = t["lead_extension"].select(
        F.col("prospect_id").alias("id"), *LEAD_EXTENSION_TEXT.split(), F.col("team_domain").alias("le_team_domain"))
    return (
        leads.join(extension, "id", "left")
        .join(star_ranks(t, dedupe=dedupe_stars), "id", "left")
        .withColumn("Customer_Profile", rules.customer_profile(answer))
        .withColumn("profile", rules.profile_code(answer)))


def latest_metadata(t: Tables) -> DataFrame:
    """Latest parsed metadata of each capture message."""
    values = ["source", "source_medium", "source_campaign", "program_name", "course_id"]
    return latest_per_key(t["capture_metadata"], ["lead_capture_message_id"], ["created_at"], values)


def unified_capture_message(t: Tables) -> DataFrame:
    messages = t["capture_message"].select(
        *[F.col(c).alias(f"lcm_{c}") for c in ("id", "created_at", "prospect_id", "activity_id")],
        F.col("message").alias("lcm_message_raw"))
    parsed = latest_metadata(t).select(
        F.col("lead_capture_message_id").alias("lcm_id"), F.col("source").alias("lc_source"),
        F.col("source_medium").alias("lc_sourceMedium"), F.col("source_campaign").alias("lc_sourceCampaign"),
        "program_name", "course_id")
    return messages.join(parsed, "lcm_id", "left")


def assignment_activity(t: Tables) -> DataFrame:
    """Assignments shaped as activities with a synthetic code."""
    return t["assignment_history"].select(
        F.col("id").alias("activity_id"), "prospect_id", "created_at", "updated_at", "created_by_id",
        F.lit(rules.ASSIGNMENT_CODE).alias("activity_type_activity_code"),
        F.lit(rules.ASSIGNMENT).alias("activity_type_display_name"),
        F.lit(None).cast("string").alias("activity_type_direction"),
        F.lit(False).alias("is_done_by_system"),
        F.col("selected_user_id").alias("selected_user_id_assign"), "from_user_id",
        "priority_score1", "priority_score2",
        F.col("prospect_star_rank").alias("prospect_star_rank_at_assign"), "selected_user_rank",
        "assignment_type", F.col("team_domain").alias("assignment_team_domain"), "prospect_domain",
        "prospect_rank", F.col("current_stage").alias("assignment_current_stage"), "source_score",
        "lead_type_score", "current_week_activity_score")


def _activities_and_assignments(t: Tables) -> tuple[DataFrame, DataFrame, list[str]]:
    """Activities, assignments in their shape, and the columns of both in one stream."""
    activities = (unified_activity(t, numbered=True).withColumnRenamed("activity_owner_id", "owner_id")
                  .drop("event_id"))
    assigned = assignment_activity(t).withColumn("owner_id", F.col("selected_user_id_assign"))
    kept = [c for c in assigned.columns if c in activities.columns or c in ASSIGNMENT_ONLY]
    return activities, assigned.select(*kept), [*activities.columns, *ASSIGNMENT_ONLY]


def activity_appended(t: Tables) -> DataFrame:
    """Activities and assignments in one stream; columns a side lacks are NULL.

    ``extension_copy`` numbers the copies of an activity's extension row (see :func:`unified_activity`).
    """
    activities, assigned, columns = _activities_and_assignments(t)
    return activities.unionByName(assigned, allowMissingColumns=True).select(*columns)


def latest_message_per_activity(t: Tables) -> DataFrame:
    values = ["lc_source", "lc_sourceMedium", "lc_sourceCampaign", "program_name", "course_id"]
    messages = unified_capture_message(t).filter(F.col("lcm_activity_id").isNotNull())
    return (latest_per_key(messages, ["lcm_activity_id"], ["lcm_created_at", "lcm_id"], values)
            .withColumnRenamed("lcm_activity_id", "activity_id"))


def activity_with_source(t: Tables) -> DataFrame:
    """The activity stream with the source of its latest capture message.

    The messages join each side of the stream before the union: activities stay in the partitions by activity that
    the join with their extension made, and the narrow assignments alone are shuffled for it.
    """
    activities, assigned, columns = _activities_and_assignments(t)
    found = latest_message_per_activity(t)
    both = (activities.join(found, "activity_id", "left")
            .unionByName(assigned.join(found, "activity_id", "left"), allowMissingColumns=True))
    return both.select(*columns, *found.columns[1:])


def completed_events(t: Tables) -> DataFrame:
    """Latest completed event of each call."""
    done = t["call_event"].filter((F.col("event_type") == "completed") & F.col("call_id").isNotNull())
    return latest_per_key(done, ["call_id"], ["created_at"], ["event_data"])


#: Scalar fields of a call-event payload and the columns made from them.
EVENT_FIELDS = {
    "duration": "call_duration_sec",
    "status1": "status1",
    "status2": "status2",
    "dialstatus": "dialstatus",
    "caller": "caller_phone",
    "receiver": "receiver_phone",
}


def with_event_fields(df: DataFrame, payload: str) -> DataFrame:
    """Replace a call-event payload by its scalar fields.

    One parse gives all fields; malformed text gives NULLs.  Nested values come back as their JSON text and
    are dropped, so only scalars pass; a row with a value that looks nested is parsed once more to tell it
    from a quoted text.
    """
    body = F.col(payload)
    parsed = df.select("*", F.json_tuple(body, *EVENT_FIELDS).alias(*[f"_{f}" for f in EVENT_FIELDS]))

    def scalar(field: str) -> Column:
        value = F.col(f"_{field}")
        kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(body), f"$.{field}", "variant"))
        return F.when(~value.rlike(r"(?s)^(\{.*\}|\[.*\])$"), value).when(kind == "STRING", value)
    typed = {f: scalar(f).try_cast("int") if f == "duration" else scalar(f) for f in EVENT_FIELDS}
    return parsed.select(*[c for c in df.columns if c != payload], *[typed[f].alias(n) for f, n in EVENT_FIELDS.items()])


def calls_with_event(t: Tables) -> DataFrame:
    """Calls with the fields of their latest completed event."""
    calls = t["call"].select(
        F.col("id").alias("call_id"), "prospect_id", F.col("user_id").alias("se_user_id"), "created_at",
        "updated_at", "call_status", "direction", "is_manual_call_done", "original_call_status", "comments",
        "platform_type")
    joined = calls.join(completed_events(t), "call_id", "left").select(*calls.columns, "event_data")
    return with_event_fields(joined, "event_data")


def call_detail(t: Tables) -> DataFrame:
    """Calls with dummy-call, connection and duration flags.

    The previous call is looked up over all calls of (user, prospect), ghost calls
    included, before any filter.
    """
    calls = with_previous_time(calls_with_event(t), ["se_user_id", "prospect_id"], "created_at", "call_id",
                               "prev_call_created_at")
    gap = seconds_crossed(F.col("prev_call_created_at"), F.col("created_at"))
    return (
        calls
        .withColumn("Is_Valid_Call", rules.valid_call_flag(F.col("status1"), F.col("prev_call_created_at"), gap))
        .withColumn("Is_Connected_Call", rules.connected_flag(F.col("status1"), F.col("status2")))
        .withColumn("Is_DNP_Call", rules.dnp_flag(F.col("call_status")))
        .withColumn("call_duration_bucket", rules.duration_bucket(F.col("call_duration_sec"))))
