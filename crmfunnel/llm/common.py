"""What the operators of this subpackage share: written intermediate tables and small helpers."""

from __future__ import annotations

import atexit
import ctypes
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import shared_dir

#: A word is a run of bytes other than the ASCII white space that contracts name.
WORD = r"[^\x20\x09-\x0D]+"

_staged: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    The lineage ends here: a lost executor costs a re-read, and what a task numbers
    (its partition id, its row numbers) is fixed once the table is committed.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    _staged.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def clean() -> None:
    """Remove the tables written by :func:`stage`; also runs when the driver ends."""
    while _staged:
        spark, path = _staged.pop()
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001  the session has ended; the folder is the cluster's scratch space
            return


#: Rows of text that are handed to Python at once.
BATCH_ROWS = "500"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bytes that are handed to Python at once: a batch is held by Spark and, as Arrow and as objects, by Python.
BATCH_BYTES = "1m"
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows of text that are read from Parquet at once: a column's vector is one array, and large arrays make the heap grow.
READ_ROWS = "512"
_READ = "spark.sql.parquet.columnarReaderBatchSize"


def small_batches(df: DataFrame) -> DataFrame:
    """Texts are long: a session that has Spark's defaults of 10,000 rows and 64 MB a batch, and of 4096 rows read at once, gets
    batches of 500 and 1 MB, and 512."""
    if df.sparkSession.conf.get(_BATCH) == "10000":
        df.sparkSession.conf.set(_BATCH, BATCH_ROWS)
    if df.sparkSession.conf.get(_BYTES) == "67108864b":
        df.sparkSession.conf.set(_BYTES, BATCH_BYTES)
    if df.sparkSession.conf.get(_READ) == "4096":
        df.sparkSession.conf.set(_READ, READ_ROWS)
    return df


def text_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, under names of its own; a missing text is empty."""
    return small_batches(df).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lazily(fn: Callable, *args, **kwargs) -> Callable:
    """Bind arguments of a task function, so that it is pickled by reference to its module; its freed memory is given back."""
    def run(batches):
        try:
            yield from fn(batches, *args, **kwargs)
        finally:
            give_back()
    return run


def give_back() -> None:
    """Return to the system what this Python worker has freed.

    Workers live on after a task, beside the executor's JVM, and the C library keeps freed memory for them.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)
