"""Calendar arithmetic on wall-clock timestamps and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(col: Column) -> Column:
    return F.trunc(col, "MM")


def months_between_starts(start: Column, end: Column) -> Column:
    """Month boundaries crossed from ``start`` to ``end``."""
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))


def seconds_crossed(start: Column, end: Column) -> Column:
    """Second boundaries crossed: whole-second difference of truncated times."""
    def whole(c: Column) -> Column:
        return F.unix_timestamp(c.cast("timestamp"))
    return whole(end) - whole(start)


def calendar_parts(col: Column, prefix: str, *, month_name: bool = True) -> list[Column]:
    """year / month / day (/ month name) / month start of a date, as named columns."""
    parts = [
        F.year(col).alias(f"{prefix}_year"),
        F.month(col).alias(f"{prefix}_month"),
        F.dayofmonth(col).alias(f"{prefix}_day"),
    ]
    if month_name:
        parts.append(F.date_format(col, "MMMM").alias(f"{prefix}_month_name"))
    parts.append(month_start(col).alias(f"{prefix}_month_start"))
    return parts


def quarter_label(col: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(col).cast("string"))


def fiscal_year_label(col: Column, first_month: int = 4) -> Column:
    """Fiscal year named after the calendar year it ends in."""
    return F.concat(F.lit("FY"), (F.year(col) + (F.month(col) >= first_month).cast("int")).cast("string"))


def business_date(col: Column, cutoff_minutes: int = 630) -> Column:
    """Date of an event, where times before the cut-off belong to the day before."""
    early = F.hour(col) * 60 + F.minute(col) < cutoff_minutes
    return F.date_sub(F.to_date(col), early.cast("int"))


def week_of_month(col: Column) -> Column:
    return F.ceil(F.dayofmonth(col) / 7).cast("int")


def year_month_int(col: Column) -> Column:
    return F.year(col) * 100 + F.month(col)
