"""What the two searches share: checked vectors, blocks of them, query blocks against blocks, the merge.

A search sets every block of queries against every block of rows it can't rule out.  Both kinds of
block are bounded, so are the tasks; nothing but counts of blocks goes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import lazily, stage

#: Queries in one block.
QUERIES = 256
FOUND = "query_id long, vec_id long, score {score}"


def usable(vec: Column) -> Column:
    """Not null, not empty, and no component null, NaN or infinite."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & ~F.coalesce(bad, F.lit(False))


def packed(df: DataFrame, id_col: str, vec_col: str, convert: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``vec_id, dim, norm, v``: vectors that take part, as bytes of what ``convert`` makes of them.

    Rows without an id take no part; rows that repeat id and vector count once.
    """
    rows = (df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vec_col}`").alias("vec"))
            .filter(F.col("vec_id").isNotNull() & usable(F.col("vec"))))
    return stage(rows.mapInPandas(lazily(_pack, convert), "vec_id long, dim int, norm double, v binary")
                 .dropDuplicates(["vec_id", "v"]), "vectors")


def _pack(batches: Iterator[pd.DataFrame], convert) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        vecs = [convert(np.asarray(v, "f8")) for v in pdf["vec"]]
        yield pd.DataFrame({"vec_id": pdf["vec_id"], "dim": [len(v) for v in vecs],
                            "norm": [float(np.sqrt((v.astype("f8") ** 2).sum())) for v in vecs],
                            "v": [v.tobytes() for v in vecs]})


def one_row_per(df: DataFrame, keys: list[str]) -> DataFrame:
    """Bounded groups as one row each: ``n``, ids and vectors as bytes, in the order of norm (falling) and id."""
    schema = ", ".join(f"{k} long" for k in keys) + ", dim int, n int, top double, ids binary, vecs binary"

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["norm", "vec_id"], ascending=[False, True])
        return pd.DataFrame([[*map(int, key[:len(keys)]), int(key[-1]), len(pdf), float(pdf["norm"].iloc[0]),
                              pdf["vec_id"].to_numpy("i8").tobytes(), b"".join(pdf["v"])]],
                            columns=[*keys, "dim", "n", "top", "ids", "vecs"])

    return df.groupBy(*keys, "dim").applyInPandas(pack, schema)


def query_blocks(vectors: DataFrame, step: int) -> DataFrame:
    """``q, dim, n, top, ids, vecs``: the rows whose id is divisible by ``step``, in blocks."""
    chosen = vectors.filter(F.col("vec_id") % step == 0)
    blocks = -(-chosen.count() // QUERIES) or 1
    key = F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks))
    return stage(one_row_per(chosen.withColumn("q", key), ["q"]), "queries")


def pairs(queries: DataFrame, blocks: DataFrame, count: int, per_task: int = 8) -> DataFrame:
    """Each query block against each block of its dimension; columns of the queries get the prefix ``q_``.

    ``blocks`` are numbered from 0 to ``count - 1`` in ``b``.  A block meets the query blocks in
    groups of ``per_task``, so a task's work is bounded too.

    Both sides repeat their blocks, but Spark estimates their size from the files, before the repeats: without the
    hint a small file of queries is broadcast, and the driver gets every query block once per block of rows.
    """
    asked = queries.select(*[F.col(c).alias(c if c == "q" else f"q_{c}") for c in queries.columns])
    groups = max(1, -(-queries.count() // per_task))
    asked = asked.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))).withColumn(
        "g", F.pmod(F.col("q"), F.lit(groups)))
    spread = blocks.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    met = (asked["b"] == spread["b"]) & (asked["g"] == spread["g"]) & (asked["q_dim"] == spread["dim"])
    return asked.hint("merge").join(spread, met).drop(asked["b"]).drop(asked["g"])


def best(found: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of each query, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return (once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def top_of(scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, object]]:
    """The k best distinct ids (id, score), ties to the smaller id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - 2 * k)[len(scores) - 2 * k]
        keep = scores >= cut
        if len(np.unique(ids[keep])) >= k:
            scores, ids = scores[keep], ids[keep]
    out: list[tuple[int, object]] = []
    seen: set[int] = set()
    for i in np.lexsort((-ids, scores))[::-1]:
        if ids[i] not in seen:
            seen.add(int(ids[i]))
            out.append((int(ids[i]), scores[i]))
            if len(out) == k:
                break
    return out
