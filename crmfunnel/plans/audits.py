"""Reusable audits of raw and built tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import email_key
from ..operators.distinct import ratio


def table_profile(df: DataFrame, at: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(at).alias("earliest"), F.max(at).alias("latest"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    found = duplicate_keys(df, keys).limit(1).collect()
    if found:
        raise ValueError(f"duplicate key {found[0].asDict()}")


def match_rate(df: DataFrame, other: DataFrame, key: str, other_key: str) -> DataFrame:
    """Rows of ``df`` with and without a partner, and their shares.

    Both sides are reduced to one row per key first, so a key with very many rows
    joins like any other.
    """
    counts = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    partners = other.select(F.col(other_key).alias("_partner")).distinct()
    matched = F.when(F.col("_partner").isNotNull(), F.col("_n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    return (
        counts.join(partners, F.col("_key") == F.col("_partner"), "left")
        .agg(F.coalesce(F.sum("_n"), zero).alias("n_rows"), F.coalesce(F.sum(matched), zero).alias("n_matched"))
        .withColumn("n_orphan", F.col("n_rows") - F.col("n_matched"))
        .withColumn("orphan_rate", ratio(F.col("n_orphan"), F.col("n_rows")))
        .withColumn("coverage_rate", ratio(F.col("n_matched"), F.col("n_rows"))))


def orphans(df: DataFrame, other: DataFrame, key: str, other_key: str) -> DataFrame:
    """Rows of ``df`` without a partner."""
    return df.join(other.select(F.col(other_key).alias(key)), key, "left_anti")


def value_distribution(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per value combination and their share of all rows."""
    counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("share", ratio(F.col("n_rows"), counts.agg(F.sum("n_rows")).scalar()))


def revenue_reconciliation(sales: DataFrame, fact: DataFrame) -> DataFrame:
    """Booked revenue beside four readings of the fact, one row per reading."""
    enrolled = F.col("Is_Valid_Enroll") == 1
    captured = F.col("activity_type_category") == "Lead Capture"
    money = lambda c: F.coalesce(c, F.lit(0)).cast("decimal(38,2)")
    one = fact.agg(
        money(F.sum("sale_value")).alias("all_rows"),
        money(F.sum(F.when(enrolled, F.col("sale_value")))).alias("enrolled_rows"),
        money(F.sum(F.when(enrolled & captured, F.col("sale_value")))).alias("enrolled_captures"))
    one = one.select(
        "*", sales.agg(money(F.sum("sale_value"))).scalar().alias("booked"),
        revenue_per_lead_month(fact).agg(money(F.sum("sale"))).scalar().alias("max_per_lead_month"))
    names = ["booked", "all_rows", "enrolled_rows", "enrolled_captures", "max_per_lead_month"]
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("definition"), F.col(n).alias("amount"),
                 F.round(ratio(F.col(n), F.col("booked")), 6).alias("share_of_booked")) for n in names])))


def revenue_per_lead_month(fact: DataFrame) -> DataFrame:
    """Revenue without inflation: the highest value per lead and month."""
    return (fact.filter(F.col("Is_Valid_Enroll") == 1)
            .groupBy("activity_month_start", "lead_id").agg(F.max("sale_value").alias("sale")))


def sales_per_lead(leads: DataFrame, sales: DataFrame) -> DataFrame:
    """Sales of each lead by normalised address.

    Sales are reduced per address before the join, so an address shared by many leads
    and many sales does not multiply.
    """
    per_buyer = sales.groupBy(email_key(F.col("lead_email")).alias("buyer")).agg(
        F.count(F.lit(1)).alias("n_sales"), F.min(F.to_date("sale_date")).alias("first_sale_date"),
        F.max(F.to_date("sale_date")).alias("last_sale_date"), F.sum("sale_value").alias("booked"))
    return (leads.select("id", email_key(F.col("email_address")).alias("buyer")).join(per_buyer, "buyer")
            .select("id", "n_sales", "first_sale_date", "last_sale_date", "booked"))
