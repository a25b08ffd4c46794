"""Value in force at an event: last change before it, first change from it on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of(events: DataFrame, changes: DataFrame, key: str, event_at: str, event_id: str, change_at: str,
          value: str, bucket: str = "day") -> DataFrame:
    """Add ``value_before`` and ``value_after`` to the events.

    Events and changes are put in one stream and windowed per (key, time bucket);
    what lies in other buckets comes from the changes reduced to one row per bucket.
    No range join, and no group that holds all rows of a key.  Several changes at one
    time fall to the highest value before and the lowest value after.
    """
    chunk = "_chunk"
    stream_events = events.withColumns({
        "_at": F.col(event_at), "_side": F.lit(0), "_value": F.lit(None).cast(changes.schema[value].dataType)})
    stream_changes = (
        changes.filter(F.col(value).isNotNull() & F.col(change_at).isNotNull())
        .select(F.col(key), F.col(change_at).alias("_at"), F.lit(1).alias("_side"), F.col(value).alias("_value")))
    both = (stream_events.unionByName(stream_changes, allowMissingColumns=True)
            .withColumn(chunk, F.date_trunc(bucket, "_at")))
    # forward and backward windows: frames that end at the current row cost one pass
    order = ["_at", "_side", "_value", event_id]
    upto = (Window.unboundedPreceding, Window.currentRow)
    forward = Window.partitionBy(key, chunk).orderBy(*order).rowsBetween(*upto)
    backward = Window.partitionBy(key, chunk).orderBy(*[F.desc(c) for c in order]).rowsBetween(*upto)
    both = (
        both
        .withColumn("_before", F.last("_value", ignorenulls=True).over(forward))
        .withColumn("_after", F.last("_value", ignorenulls=True).over(backward))
        .filter(F.col("_side") == 0))

    change = F.struct("_at", "_value")
    reduced = (stream_changes.select(key, F.date_trunc(bucket, "_at").alias(chunk), "_at", "_value")
               .groupBy(key, chunk).agg(F.max(change).alias("_hi"), F.min(change).alias("_lo")))
    # chunks of events need a row too, so that they can look around themselves
    marks = stream_events.select(key, F.date_trunc(bucket, "_at").alias(chunk)).distinct()
    above = (Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(key).orderBy(chunk).rowsBetween(*above)
    later = Window.partitionBy(key).orderBy(F.desc(chunk)).rowsBetween(*above)
    around = (
        reduced.unionByName(marks, allowMissingColumns=True)
        .groupBy(key, chunk).agg(F.max("_hi").alias("_hi"), F.max("_lo").alias("_lo"))
        .withColumn("_earlier", F.last("_hi", ignorenulls=True).over(earlier))
        .withColumn("_later", F.last("_lo", ignorenulls=True).over(later))
        .select(F.col(key).alias("_key"), F.col(chunk).alias("_key_chunk"),
                F.col("_earlier._value").alias("_carry_before"), F.col("_later._value").alias("_carry_after")))
    return (
        both.join(around, (F.col(key) == F.col("_key")) & (F.col(chunk) == F.col("_key_chunk")), "left")
        .select(*events.columns, F.coalesce("_before", "_carry_before").alias(f"{value}_before"),
                F.coalesce("_after", "_carry_after").alias(f"{value}_after")))
