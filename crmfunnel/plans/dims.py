"""Calendar and user-hierarchy dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import fiscal_year_label, month_start, quarter_label
from ..functions.text import display_name


def calendar(spark: SparkSession, start: str = "2025-01-01", end: str = "2027-12-31") -> DataFrame:
    """One row per day of a fixed range."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("lo"), F.lit(end).cast("date").alias("hi"))
    return calendar_between(bounds)


def calendar_between(bounds: DataFrame) -> DataFrame:
    """One row per day between ``lo`` and ``hi`` of a one-row DataFrame."""
    day = F.col("calendar_date")
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("calendar_date")).select(
        "calendar_date", F.year(day).alias("cal_year"), F.month(day).alias("cal_month"),
        F.dayofmonth(day).alias("cal_day"), F.date_format(day, "MMMM").alias("cal_month_name"),
        month_start(day).alias("cal_month_start"), quarter_label(day).alias("cal_quarter"),
        fiscal_year_label(day).alias("cal_fy"))


def calendar_of(df: DataFrame, at: str) -> DataFrame:
    """Calendar that spans the dates of a table."""
    return calendar_between(df.agg(F.min(F.to_date(at)).alias("lo"), F.max(F.to_date(at)).alias("hi")))


def user_hierarchy(users: DataFrame) -> DataFrame:
    """Users with their managers at three levels.

    Each level is found through the pointer of the level below it, never through
    the pointers cached on an executive's own row.  Managers are their own entry at
    their own level.
    """
    def level(role: str, prefix: str, *pointers: str) -> DataFrame:
        return users.filter(F.col("role") == role).select(
            F.col("workforce_id").alias(f"{prefix}_key"), F.col("id").alias(f"{prefix}_uid"),
            display_name(F.col("first_name"), F.col("last_name")).alias(f"{prefix}_nm"),
            *[F.col(p).alias(f"{prefix}_{p}") for p in pointers])

    def attach(df: DataFrame, pointer: str, side: DataFrame, prefix: str) -> DataFrame:
        return df.join(side, F.col(pointer) == F.col(f"{prefix}_key"), "left")

    people = users.withColumn("own_name", display_name(F.col("first_name"), F.col("last_name")))
    people = attach(people, "dm", level("dm", "d", "rsm"), "d")
    people = attach(people, "d_rsm", level("rsm", "dr", "ad"), "dr")
    people = attach(people, "rsm", level("rsm", "r", "ad"), "r")
    people = attach(people, "dr_ad", level("ad", "dra"), "dra")
    people = attach(people, "r_ad", level("ad", "ra"), "ra")
    people = attach(people, "ad", level("ad", "a"), "a")

    def pick(routes: dict[str, str], otherwise: str, kind: str):
        own = {"uid": "id", "nm": "own_name"}[kind]
        blank = F.lit("") if kind == "nm" else F.lit(None).cast("string")

        def value(prefix: str):
            return F.col(own) if prefix == "self" else F.coalesce(F.col(f"{prefix}_{kind}"), blank)
        chain = None
        for role, prefix in routes.items():
            chain = (F if chain is None else chain).when(F.col("role") == role, value(prefix))
        return chain.otherwise(value(otherwise))

    routes = {
        "dm": ({"dm": "self"}, "d"),
        "rsm": ({"rsm": "self", "dm": "r"}, "dr"),
        "ad": ({"ad": "self", "rsm": "a", "dm": "ra"}, "dra"),
    }
    managers = [c for lvl, (by_role, otherwise) in routes.items() for c in (
        pick(by_role, otherwise, "uid").alias(f"{lvl}_id"), pick(by_role, otherwise, "nm").alias(f"{lvl}_name"))]
    return people.select(
        F.col("id").alias("user_id"), F.col("own_name").alias("user_name"), F.col("email").alias("user_email"),
        F.col("role").alias("user_role"), F.col("workforce_id").alias("user_workforce_id"), "is_deleted", *managers)
