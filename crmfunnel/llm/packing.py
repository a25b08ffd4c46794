"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Method: large-item matching.  Pieces above one third of the capacity stand at most two to a
sequence: the longest takes the longest partner that still fits.  Shorter pieces then go, longest
first, into the smallest gap that holds them.  Both steps work on the number of pieces of each
length, so the plan has at most a few entries per length, whatever the number of documents; pieces
find their place by their rank among the pieces of their length.

Ranks need no sort: a task numbers its pieces of each length as it makes them, and the numbers
of pieces of each (task, length) give the offsets.

Defined results: a null or empty text is the closing id alone; a null id stays a row; repeated
rows are packed each on its own; an empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import lazily, stage, text_of

CAPACITY = 1024
END_ID = 2
PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
          "task int, rank long")

#: Texts of these signs only are split alike by both tokenizer libraries; others go the slower way.
_PLAIN = re.compile(r"[\n\r\t\x20-\x7eÀ-ɏ]*")


@functools.lru_cache(maxsize=2)
def _encoder(path: str):
    """Function from a text to its ids; both libraries read the vocabulary of one file.

    ``tiktoken`` is several times faster.  It takes texts of Latin letters without special
    tokens; any other text goes through ``tokenizers`` itself.
    """
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = [t["content"] for t in spec.get("added_tokens", [])]
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in kept)}
    ranks = {bytes(signs[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    import public_tokenizers

    fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str):
        if _PLAIN.fullmatch(text) and not any(s in text for s in special):
            return fast.encode_ordinary(text)
        return exact.encode(text, add_special_tokens=False).ids

    return encode


def _pieces(batches: Iterator[pd.DataFrame], path: str, capacity: int, end_id: int,
            with_ids: bool) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    encode = _encoder(path)
    seen = np.zeros(capacity + 1, "i8")
    for pdf in batches:
        out: list[tuple] = []
        for doc_id, text in zip(pdf["doc_id"].astype("Int64"), pdf["text"], strict=True):
            ids = np.array([*encode(text), end_id], "<u4")
            first = len(ids) % capacity or capacity
            cuts = [0, *range(first, len(ids) + 1, capacity)]
            for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                part = ids[a:b]
                row = (doc_id, piece, a, b - a, zlib.crc32(part.tobytes()), task, int(seen[b - a]))
                out.append((*row, part.astype("i8")) if with_ids else row)
                seen[b - a] += 1
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank", *["ids"] * with_ids]
        frame = pd.DataFrame(out, columns=names)
        yield frame.assign(doc_id=frame["doc_id"].astype("Int64"))


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Where pieces go, from the number of pieces of each length.

    Rows (length, first rank, ranks, first sequence, pieces per sequence, offset): piece r of the
    row stands in sequence ``first sequence + r // per`` at ``offset + (r % per) * length``.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    used = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: ranges (first sequence, sequences)
    sequences = 0

    def put(size: int, n: int, seq: int, per: int, offset: int) -> None:
        rows.append((size, used[size], n, seq, per, offset))
        used[size] += n
        left[size] -= n

    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    for size in large:
        while left[size]:
            partner = next((s for s in large if s <= capacity - size and left[s] > (s == size)), 0)
            n = left[size] if not partner else (left[size] // 2 if partner == size else min(left[size], left[partner]))
            put(size, n, sequences, 1, 0)
            if partner:
                put(partner, n, sequences, 1, size)
            if size + partner < capacity:
                gaps.setdefault(capacity - size - partner, []).append((sequences, n))
            sequences += n
    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[size]:
            gap = min((g for g in gaps if g >= size), default=0)
            if not gap:
                per = capacity // size
                n = -(-left[size] // per)
                gaps[gap := capacity] = [(sequences, n)]
                sequences += n
            seq, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
            per = min(gap // size, left[size])
            full = min(n, left[size] // per)
            put(size, full * per, seq, per, capacity - gap)
            for rest, first, many in ((gap - per * size, seq, full), (gap, seq + full, n - full)):
                if rest and many:
                    gaps.setdefault(rest, []).append((first, many))
    return rows


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``) of every piece."""
    spark = docs.sparkSession
    schema = PIECES + (", ids array<long>" if with_ids else "")
    pieces = stage(text_of(docs, id_col, text_col).mapInPandas(
        lazily(_pieces, tokenizer, capacity, end_id, with_ids), schema), "pieces")
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    # at most ``capacity`` rows
    counts = {int(r["length"]): int(r["n"]) for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.createDataFrame(
        plan(counts, capacity), "length long, low long, n long, sequence long, per long, offset long")
    places = places.groupBy("length").agg(
        F.array_sort(F.collect_list(F.struct("low", "sequence", "per", "offset"))).alias("places"))
    before = per_task.select("length", "task", (F.sum("n").over(
        Window.partitionBy("length").orderBy("task")) - F.col("n")).alias("before"))
    ranked = (pieces.join(before, ["length", "task"])
              # a few places for each of at most ``capacity`` lengths
              .join(F.broadcast(places), "length")
              .withColumn("rank", F.col("rank") + F.col("before"))
              .withColumn("place", F.element_at(F.filter("places", lambda p: p["low"] <= F.col("rank")), -1)))
    r, p = F.col("rank") - F.col("place.low"), F.col("place")
    return ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (p["sequence"] + F.floor(r / p["per"])).alias("sequence_id"),
        (p["offset"] + r % p["per"] * F.col("length")).alias("offset"), *["ids"] * with_ids)
