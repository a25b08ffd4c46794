"""Collects registered queries and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .env import Env, env_of
from .oracle import render


@dataclass(frozen=True)
class Entry:
    build: Callable[[Env], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def add(key: str, build: Callable[[Env], DataFrame], sql: str | None) -> None:
    if key in ENTRIES:
        raise KeyError(f"query registered twice: {key}")
    ENTRIES[key] = Entry(build, sql)


def add_columns(key: str, frame: Callable[[Env], DataFrame], columns: str, view: str) -> None:
    """A query that shows the same columns of a frame and of a reference view."""
    names = columns.split()
    add(key, lambda e: frame(e).select(*names), f"select {', '.join(names)} from {view}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(entry: Entry):
        return lambda spark, sf_dir: entry.build(env_of(spark, sf_dir))
    return {k: runner(e) for k, e in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: render(e.sql) for k, e in ENTRIES.items() if e.sql}
