"""Exact top-k by inner product: norm-bucketed retrieval.

Method.  Vectors are grouped by length into buckets, which hold similar lengths and are cut into
bounded blocks.  Each query first meets the block of the longest vectors; the k-th best score
there is a lower bound ``t`` of its k-th best score at all.  A block whose longest vector is ``m``
needs a cosine of at least ``t / (|q| m)`` with the query, its local threshold:

* above 1 the block can hold no result and is skipped;
* a high threshold prunes by coordinates: a unit vector within that cosine of the query lies in
  a narrow interval at the query's largest coordinates, and vectors outside are dropped;
* a low threshold prunes by length alone: vectors are in order of length, and those too short to
  reach ``t`` at cosine 1 are cut off.

What is left is verified by the exact integer product, made at once for all queries of a block that keep many rows.  ``t`` rises as blocks are read.

Components are ``floor(scale * x)``.  Defined results: vectors that are null, empty or hold a null or
non-finite component, and rows without an id, take no part; vectors of another dimension than the
query's are no candidates; rows that repeat an id count as one candidate with their best score,
and a query's own id is never its candidate; scores outside the range of a long stop at its
limits; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import lazily, stage
from .vectors import FOUND, best, one_row_per, packed, pairs, query_blocks, top_of

SCALE = 1024
#: Rows of a block, and norm buckets at most: bounds on what one task holds and on the driver's list of bounds.
BLOCK, BUCKETS = 2048, 256
#: Local thresholds from here on prune by coordinates.
STEEP, FOCUS = 0.8, 4
#: A query that more than this part of a block's rows survive is multiplied together with the others of its block.
SHARED = 16
_LIMIT = 2 ** 62


def quantised(x: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * x), -_LIMIT, _LIMIT).astype("i8")


def _products(qs: np.ndarray, vecs: np.ndarray) -> np.ndarray:
    """Exact inner products (queries x rows); beyond what a double holds exactly, by unbounded integers."""
    size = float(np.abs(qs).max(initial=0)) * float(np.abs(vecs).max(initial=0)) * max(1, qs.shape[1])
    if size < 2 ** 53:
        return (qs.astype("f8") @ vecs.astype("f8").T).astype("i8")
    exact = qs.astype(object) @ vecs.astype(object).T
    return np.array([min(max(int(x), -2 ** 63), 2 ** 63 - 1) for x in exact.ravel()], "i8").reshape(exact.shape)


def _survivors(q: np.ndarray, q_norm: float, unit: np.ndarray, norms: np.ndarray, bound: float) -> np.ndarray:
    """Positions in a block (longest first) that may reach the score ``bound``."""
    if not np.isfinite(bound) or bound <= 0 or not q_norm:
        return np.arange(len(norms))
    slack = 1 - 1e-9
    # by length: cosine 1 at most
    upto = int(np.searchsorted(-norms, -(bound * slack / q_norm), side="right"))
    if not upto:
        return np.arange(0)
    local = bound * slack / (q_norm * norms[0])
    if local < STEEP:
        return np.arange(upto)
    direction = q / q_norm
    focus = np.argsort(-np.abs(direction))[:FOCUS]
    keep = np.ones(upto, bool)
    for f in focus:
        c = direction[f]
        wide = np.sqrt(max(0.0, (1 - local * local) * (1 - c * c))) + 1e-9
        keep &= (unit[:upto, f] >= local * c - wide) & ((unit[:upto, f] <= local * c + wide) | (c >= local))
    return np.flatnonzero(keep)


def _search(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out: list[tuple] = []
        for row in pdf.itertuples(index=False):
            ids, vecs = np.frombuffer(row.ids, "i8"), np.frombuffer(row.vecs, "i8").reshape(-1, row.dim)
            q_ids, q_vecs = np.frombuffer(row.q_ids, "i8"), np.frombuffer(row.q_vecs, "i8").reshape(-1, row.dim)
            bounds = np.frombuffer(row.q_bounds, "f8")
            norms = np.sqrt((vecs.astype("f8") ** 2).sum(1))
            unit = vecs / np.where(norms > 0, norms, 1)[:, None]
            lengths = np.sqrt((q_vecs.astype("f8") ** 2).sum(1))
            found = [_survivors(q, float(l), unit, norms, bound) for q, l, bound in zip(q_vecs, lengths, bounds, strict=True)]
            # queries that many rows survive share one product, over the rows of the longest list
            many = np.array([len(at) > len(ids) // SHARED for at in found])
            upto = max((int(at[-1]) + 1 for at, m in zip(found, many, strict=True) if m), default=0)
            shared = iter(_products(q_vecs[many], vecs[:upto]))
            for query, q, bound, at, m in zip(q_ids, q_vecs, bounds, found, many, strict=True):
                scores = next(shared)[at] if m else _products(q[None], vecs[at])[0]
                near = (scores >= bound) & (ids[at] != query)
                out += [(int(query), i, int(s)) for i, s in top_of(scores[near], ids[at][near], k)]
        yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def _bounded(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """Lower bounds from the block of the longest vectors, and the least length that any query of the block needs."""
    for pdf in batches:
        rows = []
        for row in pdf.itertuples(index=False):
            ids, vecs = np.frombuffer(row.ids, "i8"), np.frombuffer(row.vecs, "i8").reshape(-1, row.dim)
            q_ids, q_vecs = np.frombuffer(row.q_ids, "i8"), np.frombuffer(row.q_vecs, "i8").reshape(-1, row.dim)
            bounds = np.full(len(q_ids), -np.inf)
            for i, (query, scores) in enumerate(zip(q_ids, _products(q_vecs, vecs), strict=True)):
                other = ids != query
                found = top_of(scores[other], ids[other], k)
                if len(found) == k:
                    bounds[i] = float(found[-1][1])
            lengths = np.sqrt((q_vecs.astype("f8") ** 2).sum(1))
            need = np.where((bounds > 0) & (lengths > 0), bounds / np.where(lengths > 0, lengths, 1), 0.0)
            rows.append((row.q, row.q_dim, row.q_n, row.q_ids, row.q_vecs, bounds.tobytes(), float(need.min())))
        yield pd.DataFrame(rows, columns=["q", "dim", "n", "ids", "vecs", "bounds", "need"])


def top_products(df: DataFrame, k: int, step: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id is divisible by ``step``, against all rows."""
    vectors = packed(df, id_col, vec_col, quantised)
    total = vectors.count()
    cuts = max(1, min(BUCKETS, -(-total // BLOCK)))
    marks = sorted(set(vectors.approxQuantile("norm", [i / cuts for i in range(1, cuts)], 1 / (4 * cuts)))) if cuts > 1 else []
    bucket = F.size(F.filter(F.array(*[F.lit(m) for m in marks]), lambda m: m <= F.col("norm"))) if marks else F.lit(0)
    bucketed = vectors.withColumn("bucket", bucket)
    # one row per bucket: how many blocks it has and the number of its first; long vectors first
    order = Window.orderBy("dim", F.col("bucket").desc())
    layout = stage(bucketed.groupBy("dim", "bucket").agg(F.ceil(F.count("*") / BLOCK).alias("parts")).withColumn(
        "base", F.sum("parts").over(order) - F.col("parts")), "layout")
    count = int(layout.agg(F.coalesce(F.sum("parts"), F.lit(0))).first()[0])
    if not count:
        return best(vectors.select(F.lit(0).cast("long").alias("query_id"), "vec_id", F.lit(0).cast("long").alias("score")), k)
    numbered = bucketed.join(layout, ["dim", "bucket"]).withColumn(
        "b", (F.col("base") + F.pmod(F.xxhash64("vec_id", "v"), F.col("parts"))).cast("long"))
    blocks = stage(one_row_per(numbered, ["b"]), "blocks")
    queries = query_blocks(vectors, step)
    longest = blocks.join(blocks.groupBy("dim").agg(F.min("b").alias("b")), ["dim", "b"], "left_semi")
    asked = stage(_first(queries, longest).mapInPandas(
        lazily(_bounded, k), "q long, dim int, n int, ids binary, vecs binary, bounds binary, need double"), "bounds")
    found = pairs(asked, blocks, count).filter(F.col("top") >= F.col("q_need") * (1 - 1e-9))
    return best(found.mapInPandas(lazily(_search, k), FOUND.format(score="long")), k)


def _first(queries: DataFrame, longest: DataFrame) -> DataFrame:
    """Query blocks with the one block of the longest vectors of their dimension."""
    asked = queries.select(*[F.col(c).alias(c if c == "q" else f"q_{c}") for c in queries.columns])
    return asked.join(longest, asked["q_dim"] == longest["dim"])
