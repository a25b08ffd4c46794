"""Conditional distinct counts in two phases.

``count(distinct case when … end)`` many times over plans an Expand that multiplies
the rows.  Here each entity is first reduced to one row of 0/1 flags per group (with
map-side combine, so a hot entity or group stays cheap), then flags are summed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def entity_flags(df: DataFrame, dims: Sequence[str], entity: str, flags: Mapping[str, Column],
                 sums: Mapping[str, Column] | None = None,
                 maxes: Mapping[str, Column] | None = None) -> DataFrame:
    """Phase one: one row per (dims, entity)."""
    aggs = [F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in flags.items()]
    aggs += [F.sum(c).alias(n) for n, c in (sums or {}).items()]
    aggs += [F.max(c).alias(n) for n, c in (maxes or {}).items()]
    return df.groupBy(*dims, entity).agg(*aggs)


def count_flags(per_entity: DataFrame, dims: Sequence[str], entity: str, flags: Sequence[str],
                sums: Sequence[str] = (), maxes: Sequence[str] = ()) -> DataFrame:
    """Phase two: entities per group.  The NULL entity counts 0 but keeps its group."""
    known = F.col(entity).isNotNull()
    aggs = [F.coalesce(F.sum(F.when(known, F.col(n))), F.lit(0)).cast("bigint").alias(n) for n in flags]
    aggs += [F.sum(n).alias(n) for n in sums]
    aggs += [F.max(n).alias(n) for n in maxes]
    return per_entity.groupBy(*dims).agg(*aggs)


def conditional_distinct(df: DataFrame, dims: Sequence[str], entity: str, flags: Mapping[str, Column],
                         sums: Mapping[str, Column] | None = None) -> DataFrame:
    """``count(distinct case when flag then entity end)`` per group, plus sums."""
    rows = entity_flags(df, dims, entity, flags, sums)
    return count_flags(rows, dims, entity, list(flags), list(sums or {}))


def conditional_distinct_with_total(df: DataFrame, dims: Sequence[str], entity: str,
                                    flags: Mapping[str, Column], sums: Mapping[str, Column] | None = None,
                                    total_label: str = "Total") -> DataFrame:
    """Groups plus a total row whose distinct counts are recomputed, not added up.

    Both branches read the same (dims, entity) rows, so their exchange is shared.
    ``is_total`` is 1 on the total row.
    """
    sums = sums or {}
    rows = entity_flags(df, dims, entity, flags, sums)
    detail = count_flags(rows, dims, entity, list(flags), list(sums)).withColumn("is_total", F.lit(0))
    once = rows.groupBy(entity).agg(*[F.max(n).alias(n) for n in flags], *[F.sum(n).alias(n) for n in sums])
    total = count_flags(once, [], entity, list(flags), list(sums)).withColumn("is_total", F.lit(1))
    labels = [F.lit(total_label if i == 0 else None).cast("string").alias(d) for i, d in enumerate(dims)]
    return detail.unionByName(total.select(*labels, *[c for c in detail.columns if c not in dims]))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields 0 where the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))
