"""Vector code compression: product codes learnt by rounds of k-means over Hilbert-sorted blocks.

Method.  Kept vectors become integers ``floor(1024 * x)`` and are cut into ``PARTS`` consecutive parts.
Every part is given a key on a Hilbert curve (Skilling's transform of its quantised components), the parts
are range-partitioned and sorted by (part, key) and cut into flat blocks of ``BLOCK`` rows; a block stores
its rows, its box (componentwise min and max) and its componentwise sum.  The blocks are written once.

A codebook per part starts as that part of the ``ENTRIES`` smallest kept ``vec_id`` s, ascending.  In each
round the codebooks (``PARTS * ENTRIES`` entries, a fixed size) are broadcast; a task bounds, for each of its
blocks, the distance from every entry to the box from below and above, and keeps as the block's shortlist
the entries whose lower bound does not exceed the least upper bound: only they can be nearest to a row of
the block (ties included).  A block whose shortlist is one entry adds its stored sum; others are assigned
by a small exact kernel of 64-bit squared distances against the shortlist, ties to the lower index.  Tasks
send their sums and counts per entry, an aggregation adds them, and the driver (which receives at most
``PARTS * ENTRIES * (width + 1)`` numbers) replaces each used entry by the floor of the mean; unused
entries stay.  After ``ROUNDS`` rounds the rows are assigned once more and their codes, errors and the
codebooks' digest are returned.

Defined results: rows whose vector is null, holds a null or non-finite component, or whose length differs
from that of the smallest kept ``vec_id`` are dropped; part ``j`` of a vector of length ``d`` is its
components ``j*d div 4`` to ``(j+1)*d div 4``; with fewer than ``ENTRIES`` kept rows the codebooks have as
many entries; rows that repeat a ``vec_id`` are rows of their own (ordered by vector for the codebook's
start); a null ``vec_id`` sorts last; a null label is one group of its own for ``label_error``; an empty
table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lazily, stage

#: Fixed values of the contract: parts, entries, rounds and the scale of components.
PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Rows of a block.
BLOCK = 128


def kept(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Usable rows with their integer vector and a row number, written once."""
    v = F.col(f"`{vec_col}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ints = F.transform(v, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long"))
    rows = vectors.filter(v.isNotNull() & ~bad).select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{label_col}`").alias("label"), ints.alias("v"))
    return stage(rows, "vcodes_kept")


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of non-negative integer points below ``2**bits`` (Skilling, 2004), as int64."""
    x = points.astype(np.int64).copy()
    n, d = x.shape
    if d == 0:
        return np.zeros(n, np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(d):
            high = (x[:, i] & q) != 0
            x[high, 0] ^= p
            low = ~high
            t = (x[low, 0] ^ x[low, i]) & p
            x[low, 0] ^= t
            x[low, i] ^= t
        q >>= 1
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(n, np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t[(x[:, d - 1] & q) != 0] ^= q - 1
        q >>= 1
    x ^= t[:, None]
    key = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def _keys(batches: Iterator[pd.DataFrame], ranges: dict[int, tuple[int, int]]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = np.zeros(len(batch), np.int64)
        for part, rows in batch.groupby("part").indices.items():
            x = np.stack(batch["p"].to_numpy()[rows]) if len(rows) else np.zeros((0, 0), np.int64)
            if x.ndim != 2 or x.shape[1] == 0:
                continue
            lo, hi = ranges[int(part)]
            bits = max(1, min(16, 62 // x.shape[1]))
            out[rows] = hilbert(((x - lo) << bits) // (hi - lo + 1), bits)
        yield batch.assign(key=out)


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Consecutive rows of one part, ``BLOCK`` at a time, with their box and sum; a part's last block may be short."""
    task = TaskContext.get().partitionId()
    number = 0
    carry = None
    for batch in batches:
        frame = batch if carry is None else pd.concat([carry, batch], ignore_index=True)
        part = frame["part"].to_numpy()
        ends = np.concatenate([np.flatnonzero(np.diff(part)) + 1, [len(frame)]])
        out, start = [], 0
        for i, end in enumerate(ends):
            last = i == len(ends) - 1
            while end - start >= BLOCK or (not last and end > start):
                stop = min(start + BLOCK, end)
                out.append(_block(frame.iloc[start:stop], task, number))
                number += 1
                start = stop
        # the rows left may go on in the next batch
        carry = frame.iloc[start:].reset_index(drop=True)
        if out:
            yield pd.DataFrame(out)
    if carry is not None and len(carry):
        yield pd.DataFrame([_block(carry, task, number)])


def _block(rows: pd.DataFrame, task: int, number: int) -> dict:
    x = np.stack(rows["p"].to_numpy()).astype(np.int64)
    return {"part": int(rows["part"].iloc[0]), "block": (task << 32) | number, "rows": rows["row"].to_numpy(np.int64),
            "vec_ids": rows["vec_id"].to_numpy(), "labels": rows["label"].to_numpy(), "width": x.shape[1],
            "data": x.ravel(), "lo": x.min(axis=0), "hi": x.max(axis=0), "total": x.sum(axis=0)}


def _shortlist(lo: np.ndarray, hi: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Entries that can be nearest to some point of the box [lo, hi], in index order."""
    below = np.maximum(0, np.maximum(lo - book, book - hi))
    least = (below * below).sum(axis=1)
    far = np.maximum((book - lo) ** 2, (book - hi) ** 2).sum(axis=1)
    return np.flatnonzero(least <= far.min())


def _assign(x: np.ndarray, book: np.ndarray, short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    diff = x[:, None, :] - book[short][None, :, :]
    dist = (diff * diff).sum(axis=2)
    best = dist.argmin(axis=1)
    return short[best], dist[np.arange(len(x)), best]


def _round(batches: Iterator[pd.DataFrame], books) -> Iterator[pd.DataFrame]:
    """Sums and counts per (part, entry) of one task's blocks."""
    books = books.value
    sums = {p: np.zeros_like(b) for p, b in books.items()}
    counts = {p: np.zeros(len(b), np.int64) for p, b in books.items()}
    for batch in batches:
        for part, width, data, lo, hi, total in zip(batch["part"], batch["width"], batch["data"], batch["lo"], batch["hi"],
                                                    batch["total"], strict=True):
            book = books[part]
            short = _shortlist(lo, hi, book)
            x = np.asarray(data, np.int64).reshape(-1, width)
            if len(short) == 1:
                sums[part][short[0]] += total
                counts[part][short[0]] += len(x)
                continue
            entry, _ = _assign(x, book, short)
            np.add.at(sums[part], entry, x)
            counts[part] += np.bincount(entry, minlength=len(book))
    for part, s in sums.items():
        used = np.flatnonzero(counts[part])
        if len(used):
            yield pd.DataFrame({"part": part, "entry": used, "count": counts[part][used], "total": list(s[used])})


def _final(batches: Iterator[pd.DataFrame], books) -> Iterator[pd.DataFrame]:
    books = books.value
    for batch in batches:
        out = []
        for part, width, data, lo, hi, rows, ids, labels in zip(batch["part"], batch["width"], batch["data"], batch["lo"],
                                                               batch["hi"], batch["rows"], batch["vec_ids"], batch["labels"],
                                                               strict=True):
            book = books[part]
            x = np.asarray(data, np.int64).reshape(-1, width)
            entry, dist = _assign(x, book, _shortlist(lo, hi, book))
            out.append(pd.DataFrame({"row": rows, "vec_id": ids, "label": labels, "part": part, "entry": entry, "dist": dist}))
        if out:
            yield pd.concat(out, ignore_index=True)


def digest(books: dict[int, np.ndarray]) -> str:
    """sha256 of all entries' components by part, entry and position, comma-joined decimals."""
    text = ",".join(str(int(c)) for p in sorted(books) for c in books[p].ravel())
    return hashlib.sha256(text.encode()).hexdigest()


def encode(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every kept row."""
    spark = vectors.sparkSession
    rows = kept(vectors, id_col, vec_col, label_col)
    label_type = rows.schema["label"].dataType.simpleString()
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v", "row").limit(ENTRIES).collect()
    if not start:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    d = len(start[0]["v"])
    rows = rows.filter(F.size("v") == d)
    bounds = [(j * d // PARTS, (j + 1) * d // PARTS) for j in range(PARTS)]
    books = {j: np.array([r["v"][a:b] for r in start], np.int64).reshape(len(start), b - a) for j, (a, b) in enumerate(bounds)}

    parts = rows.select("row", "vec_id", "label", F.posexplode(F.array(*[
        F.slice("v", a + 1, b - a) if b > a else F.array().cast("array<long>") for a, b in bounds])).alias("part", "p"))
    ranges = {r["part"]: (int(r["lo"] or 0), int(r["hi"] or 0)) for r in parts.groupBy("part").agg(
        F.min(F.array_min("p")).alias("lo"), F.max(F.array_max("p")).alias("hi")).collect()}
    keyed = parts.mapInPandas(lazily(_keys, ranges), f"row long, vec_id long, label {label_type}, part int, p array<long>, key long")
    block_schema = (f"part int, block long, rows array<long>, vec_ids array<long>, labels array<{label_type}>, width int, "
                    "data array<long>, lo array<long>, hi array<long>, total array<long>")
    blocks = stage(keyed.repartitionByRange("part", "key", "row").sortWithinPartitions("part", "key", "row")
                   .mapInPandas(_blocks, block_schema), "vcodes_blocks")

    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(books)
        sums = (blocks.mapInPandas(lazily(_round, shared), "part int, entry int, count long, total array<long>")
                .groupBy("part", "entry").agg(F.sum("count").alias("count"),
                                              *[F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(max(b - a for a, b in bounds))]))
        books = {p: b.copy() for p, b in books.items()}
        for r in sums.collect():
            width = books[r["part"]].shape[1]
            books[r["part"]][r["entry"]] = np.floor_divide(np.array([r[f"t{i}"] for i in range(width)], np.int64), r["count"])
        shared.unpersist()

    shared = spark.sparkContext.broadcast(books)
    assigned = blocks.mapInPandas(lazily(_final, shared),
                                  f"row long, vec_id long, label {label_type}, part int, entry int, dist long")
    codes = assigned.groupBy("row", "vec_id", "label").agg(
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("part", "entry"))),
                                    lambda s: F.lpad(F.lower(F.hex(s["entry"])), 2, "0"))).alias("code"),
        F.sum("dist").alias("error"))
    by_label = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label")
    out = codes.join(by_label, F.col("label").eqNullSafe(F.col("of_label")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
