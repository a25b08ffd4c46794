"""Session settings the engine relies on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # the activity fact has 146 columns; above this limit its projection leaves codegen
    "spark.sql.codegen.maxFields": "200",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # wall-clock times are truncated to hours; a zone with summer time would shift some
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


#: While large tables are written one after the other.
_WRITES = {
    # shuffle files of a query leave the disk when it ends, not when the driver's garbage collection meets its plan
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # a task keeps a file open for each of so many partition values; beyond, it sorts its rows, which spill
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


@contextmanager
def large_writes(spark: SparkSession) -> Iterator[None]:
    """Within it, a query's shuffle files are removed at its end, and partitioned writes sort nothing."""
    before = {key: spark.conf.get(key, None) for key in _WRITES}
    for key, value in _WRITES.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
