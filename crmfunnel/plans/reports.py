"""Monthly funnel and demo reports over the stored activity fact.

All filters are on ``activity_month_start``, the partition column of the fact, so a
report reads the partitions of its months only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.distinct import conditional_distinct, conditional_distinct_with_total, ratio

UNASSIGNED = "(Unassigned)"


def _category(*names: str) -> Column:
    return F.col("activity_type_category").isin(*names)


def funnel_flags() -> dict[str, Column]:
    enrolled = F.col("Is_Valid_Enroll") == 1
    return {
        "Leads": _category("Lead Capture"),
        "Demos_SE": _category("Demo Scheduled"),
        "Demos_Completed": _category("Demo Completed - Webinars", "SE Marked Demo Completed"),
        "Enrolls": enrolled,
        "Same_Month_Enrolls": _category("Lead Capture") & (F.col("SameMonthEnrolls") == "Enrolls"),
    }


def funnel_sums() -> dict[str, Column]:
    return {"Total_Sale_Value": F.when(F.col("Is_Valid_Enroll") == 1, F.col("sale_value"))}


BREAKDOWN = ("Leads", "Demos_SE", "Enrolls")


def breakdown_flags() -> dict[str, Column]:
    return {k: v for k, v in funnel_flags().items() if k in BREAKDOWN}


def demo_flags() -> dict[str, Column]:
    return {"Demos_Tech_Scheduled": _category("SE Marked Demo Schedule"),
            "Demos_Tech_Completed": _category("SE Marked Demo Completed")}


def in_month(fact: DataFrame, month: int, year: int) -> DataFrame:
    return fact.filter(F.col("activity_month_start") == F.lit(dt.date(int(year), int(month), 1)))


def funnel(fact: DataFrame, month: int, year: int) -> DataFrame:
    return conditional_distinct(in_month(fact, month, year), [], "lead_id", funnel_flags(), funnel_sums())


def _sources(fact: DataFrame) -> DataFrame:
    return fact.withColumn("Source", F.coalesce("source_attribution_final", F.lit("(none)")))


def funnel_by_source(fact: DataFrame, month: int, year: int) -> DataFrame:
    rows = _sources(in_month(fact, month, year))
    return (conditional_distinct(rows, ["Source"], "lead_id", breakdown_flags(), funnel_sums())
            .orderBy(F.desc("Leads"), "Source"))


def funnel_by_segment(fact: DataFrame, month: int, year: int) -> DataFrame:
    rows = in_month(fact, month, year).withColumnRenamed("lead_segment", "Segment")
    return (conditional_distinct(rows, ["Segment"], "lead_id", breakdown_flags(), funnel_sums())
            .orderBy(F.desc("Leads"), "Segment"))


def demo_rows(fact: DataFrame, users: DataFrame, month: int, year: int, *,
              blank_as_unassigned: bool = False) -> DataFrame:
    """Tech-demo rows of a month with the current managers of their owner.

    ``(Unassigned)`` stands for owners missing from the dimension; a known owner
    without a manager shows a blank unless ``blank_as_unassigned``.
    """
    rows = in_month(fact, month, year).filter(
        _category("SE Marked Demo Schedule", "SE Marked Demo Completed"))
    names = {"BDA": "user_name", "DM": "dm_name", "RSM": "rsm_name", "AD": "ad_name"}
    dim = users.select("user_id", *[F.col(c).alias(label) for label, c in names.items()])

    def label(c: str) -> Column:
        known = F.when(F.col(c) != "", F.col(c)) if blank_as_unassigned else F.col(c)
        return F.coalesce(known, F.lit(UNASSIGNED))
    return (rows.join(dim, F.col("bda_id") == F.col("user_id"), "left")
            .withColumns({c: label(c) for c in names}))


LEVELS = {"bda": ["BDA", "DM"], "dm": ["DM"], "rsm": ["RSM"], "ad": ["AD"]}


def demos_by(fact: DataFrame, users: DataFrame, level: str, month: int, year: int, **options) -> DataFrame:
    rows = demo_rows(fact, users, month, year, **options)
    return (conditional_distinct(rows, LEVELS[level], "lead_id", demo_flags())
            .orderBy(F.desc("Demos_Tech_Scheduled"), *LEVELS[level]))


def with_funnel_ratios(report: DataFrame) -> DataFrame:
    """L2D, L2E, D2E and, where counted, same-month L2E."""
    out = (report.withColumn("L2D", ratio(F.col("Demos_SE"), F.col("Leads")))
           .withColumn("L2E", ratio(F.col("Enrolls"), F.col("Leads")))
           .withColumn("D2E", ratio(F.col("Enrolls"), F.col("Demos_SE"))))
    if "Same_Month_Enrolls" in report.columns:
        out = out.withColumn("SM_L2E", ratio(F.col("Same_Month_Enrolls"), F.col("Leads")))
    return out


def with_demo_ratio(report: DataFrame) -> DataFrame:
    return report.withColumn("DS2DC", ratio(F.col("Demos_Tech_Completed"), F.col("Demos_Tech_Scheduled")))


def breakdown_with_total(fact: DataFrame, by: str, month: int, year: int) -> DataFrame:
    """Funnel by source or segment with a recomputed total row, total last."""
    rows = in_month(fact, month, year)
    rows, label = (_sources(rows), "Source") if by == "source" else (
        rows.withColumnRenamed("lead_segment", "Segment"), "Segment")
    return (conditional_distinct_with_total(rows, [label], "lead_id", breakdown_flags(), funnel_sums())
            .orderBy("is_total", F.desc("Leads"), label))


def demos_with_total(fact: DataFrame, users: DataFrame, level: str, month: int, year: int) -> DataFrame:
    rows = demo_rows(fact, users, month, year)
    return (conditional_distinct_with_total(rows, LEVELS[level], "lead_id", demo_flags())
            .orderBy("is_total", F.desc("Demos_Tech_Scheduled"), *LEVELS[level]))


def month_compare(fact: DataFrame, month: int, year: int) -> DataFrame:
    """Funnel of a month beside the month before, one row per metric."""
    current = dt.date(int(year), int(month), 1)
    prior = (current - dt.timedelta(days=1)).replace(day=1)
    rows = fact.filter(F.col("activity_month_start").isin(current, prior))
    counts = conditional_distinct(rows, ["activity_month_start"], "lead_id", funnel_flags(), funnel_sums())
    metrics = [*funnel_flags(), *funnel_sums()]
    is_now = F.col("activity_month_start") == F.lit(current)
    tall = counts.select(is_now.alias("now"), F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics])))
    value = lambda keep: F.coalesce(F.max(F.when(keep, F.col("v"))), F.lit(0.0))
    return (tall.groupBy("metric").agg(value(F.col("now")).alias("current"), value(~F.col("now")).alias("prior"))
            .withColumn("delta", F.col("current") - F.col("prior"))
            .withColumn("delta_pct", ratio(F.col("delta"), F.col("prior"))))


def ad_hoc(spark: SparkSession, text: str, tables: Mapping[str, DataFrame], args: Mapping | None = None,
           max_rows: int | None = None) -> DataFrame:
    """A query over named tables, with named parameters; all rows, unless the caller asks for fewer.

    The text is parsed as a subquery, where Spark's grammar takes no command and no second statement; other
    texts raise ``ParseException``.  The names hold in this query alone: no view of the session is replaced.
    """
    named = ", ".join(f"`{name}` as (select * from {{{name}}})" for name in tables)
    quoted = text.strip().rstrip(";").replace("{", "{{").replace("}", "}}")
    query = f"select * from (\n{quoted}\n)"
    out = spark.sql(f"with {named} {query}" if tables else query.replace("{{", "{").replace("}}", "}"),
                    args=dict(args or {}), **tables)
    return out if max_rows is None else out.limit(max_rows)
