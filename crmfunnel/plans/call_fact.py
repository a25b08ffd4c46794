"""Call fact: one row per call with lead, caller and tier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.dates import calendar_parts
from ..functions.text import strict_name
from ..sources.tables import Tables
from . import prep

LEAD_COLUMNS = {
    "lead_first_name": "first_name", "lead_last_name": "last_name", "lead_email": "email_address",
    "prospect_stage": "prospect_stage", "is_customer": "is_customer", "lead_city": "city", "lead_state": "state",
    "lead_country": "country", "mx_domain": "mx_domain", "Customer_Profile": "Customer_Profile",
    "lead_star_rank": "lead_star_rank", "team_domain_current": "le_team_domain",
}


def call_fact(calls: DataFrame, leads: DataFrame, t: Tables, site: rules.Site = rules.DEFAULT_SITE) -> DataFrame:
    lead = leads.select(F.col("id").alias("lead_id"), *[F.col(o).alias(n) for n, o in LEAD_COLUMNS.items()])
    callers = t["user"].select(
        F.col("id").alias("caller_key"), strict_name(F.col("first_name"), F.col("last_name")).alias("bda_name"),
        F.col("email").alias("bda_email"), F.col("role").alias("bda_role"), F.col("region").alias("bda_region"),
        *[F.col(c).alias(f"bda_{c}_workforce_id") for c in ("dm", "rsm", "ad")], F.lower("email").alias("mail"))
    tiers = t["owner_tier"].select(F.lower("email").alias("mail"), F.col("tier").alias("bda_tier"),
                                   F.col("status").alias("bda_status"))
    # tiers attach to the few users first, so the calls are joined only once
    callers = callers.join(tiers, "mail", "left")
    joined = (calls.join(lead, F.col("prospect_id") == F.col("lead_id"), "left")
              .join(callers, F.col("se_user_id") == F.col("caller_key"), "left"))
    flags = ["Is_Valid_Call", "Is_Connected_Call", "Is_DNP_Call", "call_duration_bucket", "prev_call_created_at"]
    plain = [c for c in calls.columns if c not in flags]
    return joined.select(
        *plain, *flags, *calendar_parts(F.col("created_at"), "call", month_name=False),
        "lead_id", *LEAD_COLUMNS,
        rules.domain_group(F.col("mx_domain")).alias("Domain_group"),
        rules.system_flag(F.col("lead_email"), site).alias("Is_System_Activity"),
        "bda_name", "bda_email", "bda_role", "bda_region", "bda_tier", "bda_status",
        *[f"bda_{c}_workforce_id" for c in ("dm", "rsm", "ad")])


def build_call_fact(t: Tables, site: rules.Site = rules.DEFAULT_SITE) -> DataFrame:
    return call_fact(prep.call_detail(t), prep.unified_leads(t), t, site)
