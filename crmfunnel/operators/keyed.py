"""One row per key: first and latest picks as plain aggregates.

``row_number() = 1`` would bring every row of a key to one task.  A min/max over
a struct gives the same row, and each map task sends one candidate per key, so a
key that holds a large part of the table costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_struct(order: Sequence[Column], payload: Sequence[Column], where: Column | None = None) -> Column:
    """Aggregate: payload of the row that sorts first (NULLs first), as a struct."""
    return F.min(_pick(order, payload, where))


def latest_struct(order: Sequence[Column], payload: Sequence[Column], where: Column | None = None) -> Column:
    """Aggregate: payload of the row that sorts last (NULLs first), as a struct."""
    return F.max(_pick(order, payload, where))


def _pick(order, payload, where):
    packed = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], *payload)
    return packed if where is None else F.when(where, packed)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """The row with the highest ``order`` of each key; ties fall to the payload."""
    return _one_per_key(df, keys, order, payload, latest_struct)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """The row with the lowest ``order`` of each key; ties fall to the payload."""
    return _one_per_key(df, keys, order, payload, first_struct)


def _one_per_key(df, keys, order, payload, pick):
    packed = pick([F.col(c) for c in order], [F.col(c) for c in payload])
    return (df.groupBy(*keys).agg(packed.alias("_pick"))
            .select(*keys, *[F.col(f"_pick.{c}").alias(c) for c in payload]))
