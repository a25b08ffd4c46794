"""Mixing sources to target weights with exact budgets.

Method.  Rows get hash-random keys.  Within a source the key space is cut into ranges, as many
as the source's rows ask for; sums per range and a running sum over the ranges give each range its
start, and a running sum inside the range each document its own.  A source's budget is cut
exactly: whole epochs first, then the documents in key order until the rest is used up; the
document that crosses it is taken in part.

Targets: the words to share out are a fraction of all words, split by weight.  A source takes at
most ``repeats`` times its size; what is left over goes to the others by weight.  That is one
level ``x`` with ``sum(min(weight * x, repeats * size))`` equal to the total, found with one
running sum over the sources.

Defined results: a null text has size 0; a null source is a source of its own, the last; sources
are ordered by code point; rows that repeat an id and size are counted first and then placed one
behind the other, so no range holds an unbounded run of one key; an empty table gives no rows;
the columns of the result are the operator's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, stage, word_count

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
REPEATS = 2
#: Rows that a key range holds on average.
RANGE_ROWS = 4096
#: Up to so many sources their targets are broadcast; beyond, they are joined by shuffle.
MANY_SOURCES = 50_000


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """Adds ``target`` to rows of ``source, source_size``: one row per source, so one task sorts them."""
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = sources.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(ordered) - 1) % len(weights) + 1)))
    cap = F.col("source_size") * float(repeats)
    by_ratio = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    # with the sources in order of cap / weight, those before the level are capped
    levels = weighted.select(
        "*", (F.sum("source_size").over(everything) * float(share)).alias("total"),
        F.coalesce(F.sum(cap).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("capped"),
        F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
        (cap / F.col("weight")).alias("ratio"))
    # the first source, in that order, at whose ratio the total is reached
    level = F.min(F.when(F.col("ratio") * F.col("open") + F.col("capped") >= F.col("total"), F.struct(
        "ratio", "capped", ((F.col("total") - F.col("capped")) / F.col("open")).alias("level")))).over(everything)
    return levels.select(*sources.columns, F.least(
        cap, F.coalesce(F.col("weight") * level["level"], cap)).alias("target"))


def _within(size: Column, before: Column, budget: Column) -> Column:
    return F.greatest(F.lit(0), F.least(size, budget - before))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: int = 17,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` of every row."""
    return _copies(docs, weights, share, repeats, seed, id_col, text_col, source_col).drop(
        "copies", "copy", "key", "before", "epochs", "rest")


def _copies(docs: DataFrame, weights, share: float, repeats: int, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """The mix; rows with equal id, source and size are ``copies`` in number, and numbered by ``copy`` from 0."""
    sized = stage(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                         word_count(F.col(f"`{text_col}`")).alias("size"))
             .groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies"))
             .withColumn("key", F.xxhash64(F.col("doc_id"), F.col("size"), F.lit(seed))), "sized")
    per_source = sized.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count("*").alias("source_rows"))
    goals = stage(targets(per_source, weights, share, repeats).select(
        F.col("source").alias("goal_source"), "source_size", "target",
        F.greatest(F.lit(1), F.ceil(F.col("source_rows") / RANGE_ROWS)).cast("double").alias("ranges")), "goals")
    if goals.count() <= MANY_SOURCES:
        goals = F.broadcast(goals)
    # the key as a fraction of the key space picks the range; ranges are in key order
    place = ((F.col("key").cast("double") / 2.0 ** 64) + 0.5) * F.col("ranges")
    keyed = (sized.join(goals, F.col("source").eqNullSafe(F.col("goal_source")))
             .withColumn("range", F.least(F.floor(place), F.col("ranges") - 1).cast("long")))
    sums = keyed.groupBy("source", "range").agg(F.sum(F.col("size") * F.col("copies")).alias("range_size"))
    starts = sums.select(F.col("source").alias("r_source"), F.col("range").alias("r_range"), (F.sum("range_size").over(
        Window.partitionBy("source").orderBy("range")) - F.col("range_size")).alias("range_start"))
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size")
    placed = (keyed.withColumn("upto", F.sum(F.col("size") * F.col("copies")).over(inside))
              .join(starts, F.col("source").eqNullSafe(F.col("r_source")) & (F.col("range") == F.col("r_range")))
              .withColumn("before", F.col("range_start") + F.col("upto") - F.col("size") * F.col("copies"))
              .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
              .withColumn("before", F.col("before") + F.col("copy") * F.col("size")))
    budget = F.floor(F.col("target")).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size")
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", "copies", "copy", "key", "before",
        epochs.alias("epochs"), rest.alias("rest"),
        (epochs * F.col("size") + _within(F.col("size"), F.col("before"), rest)).cast("long").alias("taken"))


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: int = 17,
          id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", length_col: str | None = None) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each time a document is taken, whole or in part.

    Of the document at which a source's budget is cut the first words are taken, joined by blanks; its length
    in ``length_col`` is kept up.  Rows with equal id, source and size are numbered by the hash of their texts, and
    take what :func:`mix` takes of the copy of that number.

    Texts are never joined to the mix: per source, its whole epochs and the place in key order (key, id, size,
    copy) where its budget is crossed, with the words taken there, are one row, broadcast while there are at
    most ``MANY_SOURCES`` sources.  Each other row compares its own key with its source's cut in the scan: before
    it, taken once more; at it, in part.  Only rows that repeat an id, source and size meet the mix by a join.
    """
    names = docs.columns
    text = F.col(f"`{text_col}`")
    placed = stage(_copies(docs, weights, share, repeats, seed, id_col, text_col, source_col), "placed")
    # per source: whole epochs and the place in key order where its budget is crossed (a few bytes a source)
    order = F.struct("key", "doc_id", "size", "copy")
    crossing = (placed.filter((F.col("before") < F.col("rest")) & (F.col("before") + F.col("size") >= F.col("rest")))
                .select("source", order.alias("cut"), (F.col("rest") - F.col("before")).alias("cut_words")))
    cuts = stage(_cuts(placed, crossing), "cuts")
    if cuts.count() <= MANY_SOURCES:
        cuts = F.broadcast(cuts)
    taken = placed.filter("copies > 1").select(
        F.col("doc_id").alias("m_id"), F.col("source").alias("m_source"), F.col("size").alias("m_size"),
        "copies", F.col("copy").alias("m_copy"), F.col("taken").alias("m_taken"))
    every = docs.select(F.struct("*").alias("d"), word_count(text).alias("size"), F.col(f"`{id_col}`").alias("id"),
                        F.col(f"`{source_col}`").alias("source"))
    same = F.col("id").eqNullSafe(F.col("m_id")) & F.col("source").eqNullSafe(F.col("m_source")) & (F.col("size") == F.col("m_size"))
    own = ("d", "size", "m_taken")
    repeated = stage(taken.filter("m_copy = 0").select("m_id", "m_source", "m_size"), "repeated")
    # a row that is no copy decides from its own key whether its source's cut lies after it
    if repeated.count() <= MANY_SOURCES:
        repeated = F.broadcast(repeated)
    single = every.join(repeated, same, "left_anti")
    # the same key as the mix's, from the id as it is
    mine = F.struct(F.xxhash64(F.col("id"), F.col("size"), F.lit(seed)).alias("key"), F.col("id").alias("doc_id"),
                    F.col("size").alias("size"), F.lit(0).cast(placed.schema["copy"].dataType).alias("copy"))
    extra = (F.when(F.col("cut").isNull(), F.lit(0)).when(mine < F.col("cut"), F.col("size"))
             .when(mine == F.col("cut"), F.col("cut_words")).otherwise(F.lit(0)))
    rows = (single.join(cuts, F.col("source").eqNullSafe(F.col("c_source")))
            .withColumn("m_taken", (F.col("epochs") * F.col("size") + extra).cast("long"))
            .filter("m_taken > 0").select(*own))
    if not repeated.isEmpty():
        copies = _numbered(every.join(repeated, same, "left_semi"), text_col)
        rows = rows.unionByName(copies.join(taken.filter("m_taken > 0"), same & (F.col("copy") == F.col("m_copy")))
                                .select(*own))
    times = F.ceil(F.col("m_taken") / F.col("size"))
    rows = rows.withColumn("turn", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    words = F.least(F.col("size"), F.col("m_taken") - (F.col("turn") - 1) * F.col("size")).cast("int")
    whole = F.col("d").getField(text_col)
    part = F.array_join(F.slice(F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)), F.lit(1), words), " ")
    cut = words < F.col("size")
    rows = rows.withColumn("text", F.when(cut, part).otherwise(whole))
    out = []
    for name in names:
        value = F.col("d").getField(name)
        if name == text_col:
            value = F.col("text")
        elif name == length_col:
            value = F.when(cut, F.length("text").cast(docs.schema[name].dataType)).otherwise(value)
        out.append(value.alias(name))
    return rows.select(*out)


def _cuts(placed: DataFrame, crossing: DataFrame) -> DataFrame:
    """One row per source: ``epochs``, and the order and words of the row at which its budget is crossed (null if none)."""
    epochs = placed.groupBy("source").agg(F.max("epochs").alias("epochs"))
    crossed = crossing.select(F.col("source").alias("x_source"), "cut", "cut_words")
    return epochs.join(crossed, F.col("source").eqNullSafe(F.col("x_source")), "left").select(
        F.col("source").alias("c_source"), "epochs", "cut", "cut_words")


def _numbered(rows: DataFrame, text_col: str) -> DataFrame:
    """Adds ``copy``: numbers from 0 of rows with equal ``id, source, size``, in order of the hash of their texts.

    Rows are numbered within their text and task, and a running sum over these gives each its start: no window
    holds more rows of ``rows`` than a task has read.
    """
    text = F.coalesce(F.col("d").getField(text_col), F.lit(""))
    rows = stage(rows.withColumn("hash", F.xxhash64(text)).withColumn("part", F.spark_partition_id()), "copies")
    key, part = ("id", "source", "size"), ("id", "source", "size", "hash", "part")
    counts = rows.groupBy(*part).agg(F.count("*").alias("many"))
    starts = counts.select(*[F.col(k).alias(f"s_{k}") for k in part], (F.sum("many").over(
        Window.partitionBy(*key).orderBy("hash", "part")) - F.col("many")).alias("start"))
    inside = rows.withColumn("place", F.row_number().over(Window.partitionBy(*part).orderBy(F.lit(0))) - 1)
    on = F.lit(True)
    for k in part:
        on = on & F.col(k).eqNullSafe(F.col(f"s_{k}"))
    return inside.join(starts, on).select("d", *key, (F.col("start") + F.col("place")).alias("copy"))
