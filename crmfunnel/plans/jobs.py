"""Daily rebuild: gate, staged inputs, parallel table writes into a new run, post-check, publication by manifest."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.session import tune
from ..sources import snapshots
from ..sources.tables import Tables, remove, shared_dir, write_table
from . import audits, checks, prep
from .activity_fact import FactOptions, activity_fact
from .call_fact import call_fact
from .dims import user_hierarchy

PARTITIONS = {"activity_fact": "activity_month_start", "call_fact": "call_month_start", "user": None}
#: Keys that a build relies on; copies would multiply rows and sales.
UNIQUE_KEYS = {"activity_extension": ["related_activity_id"], "user": ["id"], "owner_tier": ["email"]}


def staged(df: DataFrame, name: str, folder: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    It is read several times by the builds, and a lost executor then costs a re-read
    of files instead of the joins behind it.
    """
    path = f"{folder}/{name}"
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rebuild(spark: SparkSession, t: Tables, out: str, as_of: dt.date, *, opt: FactOptions = FactOptions(),
            max_lag_days: int = checks.SOURCE_MAX_LAG_DAYS, min_rows: int = checks.MIN_FACT_ROWS,
            keep: int = 2, grace: dt.timedelta = dt.timedelta(hours=6)) -> DataFrame:
    """Rebuild the facts and the user dimension as a new run under ``out``; gives the post-check rows.

    All tables are written into the run's own folder and become current together when its manifest is
    published, after the post-check (:mod:`crmfunnel.sources.snapshots`; read them with
    ``snapshots.read_all``).  A failed build or check removes the run and leaves the current one as it is;
    nothing is renamed.  Intermediate tables are removed in every case; older runs go by ``keep`` and ``grace``.
    """
    tune(spark)
    checks.source_gate(t["activity_base"], "created_at", as_of, max_lag_days)
    for name, keys in UNIQUE_KEYS.items():
        known = [F.col(k).isNotNull() for k in keys]
        audits.assert_unique(t[name].filter(reduce(Column.__and__, known)), keys)
    run, fresh = snapshots.new_run(out)
    folder = f"{shared_dir(spark)}/rebuild-{run}"
    try:
        result = _build_and_check(spark, t, folder, fresh, as_of, opt, max_lag_days, min_rows)
        snapshots.publish(spark, out, run, list(PARTITIONS), as_of=as_of.isoformat())
    except BaseException:
        # no manifest names this run: no reader can see it
        remove(spark, fresh)
        raise
    finally:
        remove(spark, folder)
    snapshots.expire(spark, out, keep, grace)
    return result


def _build_and_check(spark: SparkSession, t: Tables, folder: str, fresh: str, as_of: dt.date, opt: FactOptions,
                     max_lag_days: int, min_rows: int) -> DataFrame:
    """Write all tables under ``fresh``; raises where one is not built or the post-check fails."""
    stream = staged(prep.activity_with_source(t), "activity_stream", folder)
    active = staged(prep.active_prospects(stream, t["call"]), "active_prospects", folder)
    leads = staged(prep.unified_leads(prep.only_active(t, active)), "leads", folder)
    builds: dict[str, Callable[[], DataFrame]] = {
        "activity_fact": lambda: activity_fact(stream, leads, t, opt),
        "call_fact": lambda: call_fact(prep.call_detail(t), leads, t, opt.site),
        "user": lambda: user_hierarchy(t["user"]),
    }

    def build(name: str) -> None:
        write_table(builds[name](), f"{fresh}/{name}", PARTITIONS[name])

    failures = {}
    with ThreadPoolExecutor(len(builds)) as pool:
        running = {name: pool.submit(build, name) for name in builds}
        for name, job in running.items():
            if (error := job.exception()) is not None:
                failures[name] = error
    if failures:
        raise RuntimeError(f"tables not built: {failures}")
    tables = {name: spark.read.parquet(f"{fresh}/{name}") for name in builds}
    result = checks.post_check(tables["activity_fact"], tables["user"], tables["call_fact"], as_of,
                               min_rows, max_lag_days)
    rows = result.collect()  # one row per check
    failed = [r.check for r in rows if not r.ok]
    if failed:
        raise RuntimeError(f"post-check failed: {failed}")
    return spark.createDataFrame(rows, result.schema)
