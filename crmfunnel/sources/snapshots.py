"""Published snapshots: the tables of one run, made current together by one small manifest written last.

Layout under a root folder::

    runs/<run>/<table>/           tables of a run, written in place and never moved or renamed
    manifests/<version>.json      {"version": n, "run": "<run>", "tables": {"<table>": "<path>"}, ...}

A run's tables are written to its own folder; nothing a reader sees changes while they are written.  The
run becomes current when its manifest is published: the manifest is written under a hidden name and then
renamed to the next version, an operation on one small file that a reader sees whole or not at all (a
rename onto an existing version fails, so two publishers can not take one version).  A reader resolves the
greatest version once and reads every table of that run: it never mixes tables of two runs, and a run
that failed half way has no manifest and is never seen.

Old runs go by age: runs named by the last ``keep`` manifests stay, as do runs younger than ``grace``
(readers that resolved an older manifest may still read them, and a run may be in the middle of its
writes); other runs and manifests are removed.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNS, MANIFESTS = "runs", "manifests"
_VERSION = re.compile(r"^(\d{20})\.json$")


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _names(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Names in a folder with their modification time in ms; none where the folder is missing."""
    fs, path = _fs(spark, folder)
    if not fs.exists(path):
        return []
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(path)]


def new_run(root: str, now: dt.datetime | None = None) -> tuple[str, str]:
    """A fresh run id and the folder its tables are written to."""
    now = now or dt.datetime.now(dt.UTC)
    run = f"{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"
    return run, f"{root.rstrip('/')}/{RUNS}/{run}"


def versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(m.group(1)) for name, _ in _names(spark, f"{root}/{MANIFESTS}") if (m := _VERSION.match(name)))


def publish(spark: SparkSession, root: str, run: str, tables: list[str], **facts) -> dict:
    """Make a run current; gives its manifest.  Every table must exist in the run's folder."""
    root = root.rstrip("/")
    paths = {name: f"{root}/{RUNS}/{run}/{name}" for name in tables}
    for name, path in paths.items():
        fs, p = _fs(spark, path)
        if not fs.exists(p):
            raise FileNotFoundError(f"table {name} of run {run} was not written")
    folder = f"{root}/{MANIFESTS}"
    fs, hidden = _fs(spark, f"{folder}/_{uuid.uuid4().hex}.tmp")
    fs.mkdirs(hidden.getParent())
    for _ in range(100):
        known = versions(spark, root)
        manifest = {"version": (known[-1] + 1) if known else 1, "run": run, "tables": paths,
                    "published": dt.datetime.now(dt.UTC).isoformat(), **facts}
        stream = fs.create(hidden, True)
        try:
            stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        finally:
            stream.close()
        _, final = _fs(spark, f"{folder}/{manifest['version']:020d}.json")
        if fs.rename(hidden, final):
            return manifest
    fs.delete(hidden, False)
    raise RuntimeError(f"no free manifest version under {folder}")


def _read_manifest(spark: SparkSession, root: str, version: int) -> dict:
    fs, path = _fs(spark, f"{root}/{MANIFESTS}/{version:020d}.json")
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def current(spark: SparkSession, root: str) -> dict | None:
    """The manifest of the current run, or None before the first publication."""
    known = versions(spark, root.rstrip("/"))
    return _read_manifest(spark, root.rstrip("/"), known[-1]) if known else None


def read_all(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every table of the current run, resolved once, so that all come from one run."""
    manifest = current(spark, root)
    if manifest is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    return {name: spark.read.parquet(path) for name, path in manifest["tables"].items()}


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    return read_all(spark, root)[table]


def expire(spark: SparkSession, root: str, keep: int = 2, grace: dt.timedelta = dt.timedelta(hours=6),
           now: dt.datetime | None = None) -> list[str]:
    """Remove runs and manifests that are neither among the last ``keep`` nor younger than ``grace``; gives the runs removed."""
    root = root.rstrip("/")
    now_ms = int((now or dt.datetime.now(dt.UTC)).timestamp() * 1000)
    old = now_ms - int(grace.total_seconds() * 1000)
    known = versions(spark, root)
    kept = {_read_manifest(spark, root, v)["run"] for v in known[-keep:]} if keep else set()
    gone = []
    for name, modified in _names(spark, f"{root}/{RUNS}"):
        if name not in kept and modified < old:
            fs, path = _fs(spark, f"{root}/{RUNS}/{name}")
            fs.delete(path, True)
            gone.append(name)
    stale = set(known[:-keep] if keep else known)
    for name, modified in _names(spark, f"{root}/{MANIFESTS}"):
        m = _VERSION.match(name)
        if m and int(m.group(1)) in stale and modified < old:
            fs, path = _fs(spark, f"{root}/{MANIFESTS}/{name}")
            fs.delete(path, False)
    return gone
