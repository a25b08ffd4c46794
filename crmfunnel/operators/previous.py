"""Time of the previous row of a key, without one window over the whole key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_previous_time(df: DataFrame, keys: Sequence[str], at: str, tie: str, out: str,
                       bucket: str = "hour") -> DataFrame:
    """Add ``out`` = ``at`` of the preceding row of the same keys, ordered by (at, tie).

    Rows are windowed per (keys, time bucket).  The last time before a bucket is found
    on the rows reduced to one per bucket and enters the window as an extra row, which
    sorts first because it lies before the bucket.  So a key with very many rows is
    spread over its buckets, the only group that spans a key holds one row per bucket,
    and the rows are shuffled once.  NULL keys form one group, as in a plain window.
    """
    chunk, last, carried = "_chunk", "_last", "_carried"
    rows = df.withColumn(chunk, F.date_trunc(bucket, F.col(at)))
    across = Window.partitionBy(*keys).orderBy(chunk)
    before = (
        rows.groupBy(*keys, chunk).agg(F.max(at).alias(last))
        .withColumn(at, F.lag(last).over(across))
        .filter(F.col(at).isNotNull())
        .select(*keys, chunk, at, F.lit(True).alias(carried)))
    inside = Window.partitionBy(*keys, chunk).orderBy(at, tie)
    return (rows.withColumn(carried, F.lit(False))
            .unionByName(before, allowMissingColumns=True)
            .withColumn(out, F.lag(at).over(inside))
            .filter(~F.col(carried))
            .select(*df.columns, out))
