"""Reading raw tables and writing built ones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import RAW_SCHEMAS, SALES_HEADERS

Tables = Mapping[str, DataFrame]


def read_raw(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """All raw tables under ``root`` with their fixed schemas (lazy)."""
    return {
        name: spark.read.schema(schema).format(fmt).load(f"{root}/{name}")
        for name, schema in RAW_SCHEMAS.items()
        if name != "sales"
    } | {"sales": read_sales(spark, f"{root}/sales", fmt)}


def read_sales(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Sales sheet with its spreadsheet headers renamed and typed."""
    return tidy_sales(spark.read.format(fmt).load(path))


def tidy_sales(sheet: DataFrame) -> DataFrame:
    """Rename the sheet's headers; columns already renamed pass through."""
    target = RAW_SCHEMAS["sales"]
    by_new = {new: old for old, new in SALES_HEADERS.items()}
    return sheet.select(*[
        F.col(f"`{by_new[f.name]}`" if by_new[f.name] in sheet.columns else f.name)
        .cast(f.dataType).alias(f.name)
        for f in target
    ])


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Full rebuild of a table, rebalanced to even files.

    A partitioned table is rebalanced by its partition column: a value's rows meet in few tasks, and
    adaptive execution splits a large value, so the number of files follows the bytes of each value.
    """
    if partition_by:
        df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by).parquet(path)
    else:
        df.hint("rebalance").write.mode("overwrite").parquet(path)


def write_as_is(df: DataFrame, path: str, partition_by: str | None = None, *, append: bool = False) -> None:
    """Write a large table by the tasks that make it, without a shuffle of its finished rows.

    For results of joins, whose partitions adaptive execution has evened.  A task writes a file per partition value that
    it has, so tables of many values are written in parts of few (``append``).
    """
    writer = df.write.mode("append" if append else "overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def _files(spark: SparkSession, path: str):
    """File system of a path, and the path as it takes it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _files(spark, path)
    fs.delete(target, True)


def replace(spark: SparkSession, fresh: str, live: str, aside: str) -> None:
    """Move a built table to the place of the live one, which is kept aside until then."""
    fs, new = _files(spark, fresh)
    _, place = _files(spark, live)
    _, old = _files(spark, aside)
    fs.mkdirs(old.getParent())
    fs.mkdirs(place.getParent())
    if fs.exists(place) and not fs.rename(place, old):
        raise OSError(f"can't move {live} aside")
    if not fs.rename(new, place):
        if fs.exists(old):
            fs.rename(old, place)
        raise OSError(f"can't move {fresh} to {live}")
    fs.delete(old, True)


def write_json(df: DataFrame, path: str) -> None:
    """A report result as JSON lines."""
    df.write.mode("overwrite").json(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Publish a lazy DataFrame under a view name."""
    df.createOrReplaceTempView(name)
    return df


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables: ``spark.checkpoint.dir``.

    Where that is unset, a folder in the warehouse, which executors share as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staging"
    return configured.rstrip("/")
