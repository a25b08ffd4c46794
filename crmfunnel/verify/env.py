"""Inputs of the registered queries over one data folder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..plans import activity_fact as facts
from ..plans import call_fact, dims, prep
from ..sources.session import large_writes, tune
from ..sources.surrogate import raw_tables
from ..sources.tables import shared_dir, write_as_is, write_table

_STORED: dict[str, StructType] = {}


class Env:
    """Lazy frames; the stored facts are written once per application and folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._built: dict[facts.FactOptions, DataFrame] = {}

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return raw_tables(self.spark, self.sf_dir)

    @cached_property
    def stream(self) -> DataFrame:
        return prep.activity_with_source(self.raw)

    @cached_property
    def leads(self) -> DataFrame:
        return prep.unified_leads(self.raw)

    @cached_property
    def calls(self) -> DataFrame:
        return prep.call_detail(self.raw)

    @cached_property
    def staged_stream(self) -> DataFrame:
        """The activity stream as a written table: the fact reads it three times."""
        return self._stored("activity_stream", lambda: self.stream, as_is=True)

    @cached_property
    def staged_leads(self) -> DataFrame:
        """The lead view of active prospects; the facts read no other leads."""
        active = self._stored("active_prospects", lambda: prep.active_prospects(self.staged_stream, self.raw["call"]))
        return self._stored("leads", lambda: prep.unified_leads(prep.only_active(self.raw, active)))

    @cached_property
    def rows(self) -> DataFrame:
        return facts.classified(self.staged_stream)

    @cached_property
    def lead_months(self) -> DataFrame:
        return facts.lead_months(self.rows, self.staged_leads, self.raw)

    def build(self, opt: facts.FactOptions = facts.FactOptions()) -> DataFrame:
        """The activity fact as a lazy plan."""
        if opt not in self._built:
            self._built[opt] = facts.activity_fact(self.staged_stream, self.staged_leads, self.raw, opt)
        return self._built[opt]

    @cached_property
    def users(self) -> DataFrame:
        return dims.user_hierarchy(self.raw["user"])

    @cached_property
    def fact(self) -> DataFrame:
        """The activity fact as a written table, partitioned by month and written in parts of whole months."""
        return self._stored(
            "activity_fact",
            lambda: facts.fact_parts(self.staged_stream, self.staged_leads, self.raw,
                                     lambda name, df: self._stored(name, lambda: df, as_is=True)),
            "activity_month_start", as_is=True)

    @cached_property
    def call_fact(self) -> DataFrame:
        return self._stored("call_fact", lambda: call_fact.call_fact(self.calls, self.staged_leads, self.raw),
                            "call_month_start")

    def _stored(self, name: str, build: Callable[[], DataFrame | Iterable[DataFrame]],
                partition_by: str | None = None, *, as_is: bool = False) -> DataFrame:
        """A table or its parts, written at first use; ``as_is`` is for large ones, whose rows aren't shuffled to even files."""
        tag = hashlib.md5(self.sf_dir.encode()).hexdigest()[:8]
        path = f"{shared_dir(self.spark)}/{self.spark.sparkContext.applicationId}-{tag}/{name}"
        if path not in _STORED:
            df = build()
            with large_writes(self.spark):
                for i, part in enumerate([df] if isinstance(df, DataFrame) else df):
                    if as_is:
                        write_as_is(part, path, partition_by, append=i > 0)
                    else:
                        write_table(part, path, partition_by)
            _STORED[path] = part.schema
        return self.spark.read.schema(_STORED[path]).parquet(path)


_ENVS: dict[tuple[str, str], Env] = {}


def env_of(spark: SparkSession, sf_dir: str) -> Env:
    """The inputs of a folder; plans are analysed once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ENVS:
        _ENVS[key] = Env(tune(spark), sf_dir)
    return _ENVS[key]
