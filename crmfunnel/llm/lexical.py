"""Ranked lexical search: integer BM25-style scores over a length-stratified index.

Method.  Every document gets its normaliser ``m = 10 + (90 * n * N) div L`` from its own number of
terms ``n`` and two corpus totals (``N`` documents with a term, ``L`` terms in all).  The postings of the
terms that the items ask for are written once with ``(term, n, tf)``, and with them one row per document for the
totals, so that every text is taken apart once; a posting's impact
``(10^9 * tf) div (1000 * tf + 8 * m)`` depends on ``tf`` and ``m`` alone, so documents of one stratum
(equal ``m``) that share a ``tf`` share it.  A stratum's bound for an item sums, over the item's terms,
weight times the impact of the largest ``tf`` in that stratum: no document of the stratum can score more.
Documents are visited per item through these bounds:

1. a threshold: the documents that hold the item's rarest terms (fewest documents first, up to the first
   term held by ``k`` documents, so that there are ``k`` of them where the item has ``k`` matches) are scored
   exactly; their ``k``-th score is a score that ``k`` documents reach;
2. in each stratum the item's terms are ordered by bound; the terms whose bounds, with all smaller ones,
   stay below the threshold can not lift a document to it alone.  Only documents of the stratum with
   another ("essential") term are candidates; a stratum whose whole bound is below the threshold has none;
3. candidates are scored exactly over all the item's terms (only their postings meet the items' terms),
   and the top ``k`` is taken, ties included.

Scores are sums per (item, document) over joins of narrow rows, with the postings of candidates only; the top ``k`` is taken per (item,
stratum, salt) and then per item, so that a stratum that holds most documents is ranked by many tasks.
Terms of weight 0 add nothing and are left out.  Small tables (the items' terms, thresholds, essential terms,
candidates) are written, so that joins with the postings see their size and broadcast them within Spark's limit.

Terms are the maximal matches of ``TERM``; only A-Z are lower-cased.  A term's weight is
``floor(1000 * ln((2N + 2) / (2 df + 1)))`` in doubles, everything else is 64-bit integer arithmetic.

Defined results: a null text has no terms; an item without terms, or whose terms are in no document, has
no rows; only scores above 0 are ranked; equal scores go to the smaller ``doc_id`` (rows that repeat an id
are separate documents, each counted in ``N``, ``L`` and ``df``, and may both be listed); rows that repeat an
item id are one item with the union of their terms; a null item id is an item of its own; a null
``doc_id`` is a document ranked after all ids; empty tables give no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: Fixed values of the contract: a term, the letters that are lower-cased, the result size.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
K = 10
#: Stands for a whole document among its terms, which are never empty; its ``tf`` is the document's number of terms.
WHOLE = ""
#: Tasks that rank one (item, stratum) before the ranks per item.
SALT = 16
#: Rows of a file of the items' terms.
FILE_ROWS = 1 << 16


def terms(text: Column) -> Column:
    """The terms of a text in order, repeats kept; a null text has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))


def impact(tf: Column, m: Column) -> Column:
    """A posting's impact; it depends on ``tf`` and the stratum ``m`` alone."""
    return _div(F.lit(1_000_000_000).cast("long") * tf, F.lit(1000).cast("long") * tf + F.lit(8).cast("long") * m)


def _div(a: Column, b: Column) -> Column:
    """Integer division of longs, rounding down for the non-negative values used here."""
    return F.call_function("div", a.cast("long"), b.cast("long"))


def search(docs: DataFrame, items: DataFrame, k: int = K, *, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score`` of each item's ``k`` best documents with a score above 0."""
    d = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    q = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").alias("text"))
    item_type = q.schema["item_id"].dataType
    empty = d.sparkSession.createDataFrame([], f"item_id {item_type.simpleString()}, rank int, doc_id long, score long")

    item_terms = q.select("item_id", F.explode(terms(F.col("text"))).alias("term")).distinct()
    vocabulary = item_terms.select("term").distinct().unionByName(d.sparkSession.range(1).select(F.lit(WHOLE).alias("term")))
    # one row per (document row, asked term) and one per document, so that texts are read once for the postings and the
    # totals; the row number is fixed once they are written
    rows = d.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.sort_array(terms(F.col("text"))).alias("t"))
    rows = _counted(rows).withColumn("n", F.size("t").cast("long"))
    whole = F.array(F.struct(F.lit(WHOLE).alias("term"), F.col("n").alias("tf")))
    # outer: for the inner form Spark infers a filter on the counts, which counts anew for each term
    rows = rows.select("row", "doc_id", "n", F.inline_outer(F.concat(whole, "counts")))
    written = stage(rows.join(vocabulary, "term", "left_semi").select("term", "n", "tf", "row", "doc_id"), "lexical_postings")
    totals = written.filter(F.col("term") == WHOLE).agg(F.count(F.lit(1)).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
    big_n, big_l = int(totals["N"]), int(totals["L"])
    if big_l == 0:
        return empty
    m = F.lit(10) + _div(F.lit(90) * F.col("n") * F.lit(big_n), F.lit(big_l))
    postings = written.filter(F.col("term") != WHOLE).select("term", m.cast("long").alias("m"), "tf", "row", "doc_id")

    weights = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select(
        "term", "df", F.floor(F.lit(1000.0) * F.log((F.lit(2.0) * big_n + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("long").alias("w"))
    # written, so that joins see its size: at most the items' distinct terms; in files of many rows, as the size of many
    # small ones is mostly their footers
    files = -(-max(1, item_terms.count()) // FILE_ROWS)
    asked = stage(item_terms.join(weights, "term").filter(F.col("w") > 0).repartition(files), "lexical_asked")
    strata = postings.groupBy("term", "m").agg(F.max("tf").alias("top_tf"))

    # a threshold per item: the k-th exact score of the documents that hold its rarest terms
    rare = Window.partitionBy("item_id").orderBy("df", "term").rowsBetween(Window.unboundedPreceding, -1)
    first = asked.withColumn("before", F.coalesce(F.max("df").over(rare), F.lit(0))).filter(F.col("before") < k)
    found = _candidates(postings.join(first.select("term"), "term", "left_semi"), first)
    threshold = stage(_top(_exact(found, asked, postings), k).filter(F.col("rank") == k)
                      .select(F.col("item_id").alias("of_item"), F.col("score").alias("threshold")), "lexical_threshold")

    # per (item, stratum): terms by bound, ascending; those whose bounds with all smaller ones stay below the
    # threshold can not lift a document to it alone, so only documents with another term are candidates
    by_bound = Window.partitionBy("item_id", "m").orderBy("bound", "term").rowsBetween(Window.unboundedPreceding, 0)
    essential = stage(
        asked.join(strata, "term").withColumn("bound", F.col("w") * impact(F.col("top_tf"), F.col("m")))
        .join(threshold, F.col("item_id").eqNullSafe(F.col("of_item")), "left")
        .withColumn("reach", F.sum("bound").over(by_bound))
        .filter((F.col("bound") > 0) & (F.col("reach") >= F.coalesce(F.col("threshold"), F.lit(0))))
        .select("item_id", "m", "term"), "lexical_essential")
    hits = _candidates(postings.join(essential, ["term", "m"]), essential).unionByName(found)
    return _top(_exact(hits.distinct(), asked, postings), k).select("item_id", "rank", "doc_id", "score")


def _counted(rows: DataFrame) -> DataFrame:
    """``counts``: the distinct terms of a row's sorted terms ``t`` and how often each occurs (``term, tf``).

    A term's occurrences follow each other, so they are counted within the row, without an exchange.
    """
    t, firsts = F.col("t"), F.col("firsts")
    full = rows.filter(F.size("t") > 0).withColumn("firsts", F.filter(
        F.sequence(F.lit(0), F.size(t) - 1), lambda i: (i == 0) | (F.get(t, i) != F.get(t, i - 1))))
    return full.withColumn("counts", F.transform(firsts, lambda first, k: F.struct(
        F.get(t, first).alias("term"), (F.coalesce(F.get(firsts, k + 1), F.size(t)) - first).cast("long").alias("tf")))).drop("firsts")


def _candidates(postings: DataFrame, wanted: DataFrame) -> DataFrame:
    """(item, row) of the postings that hold a wanted term of the item, written."""
    if "item_id" not in postings.columns:
        postings = postings.join(wanted.select("item_id", "term"), "term")
    return stage(postings.select("item_id", "row").distinct(), "lexical_candidates")


def _exact(candidates: DataFrame, asked: DataFrame, postings: DataFrame) -> DataFrame:
    """Exact scores of candidate (item, row) pairs.

    Candidates meet the postings of their documents (a join on the row, which Spark broadcasts where the
    candidates are few and else makes by one exchange of postings and candidates), then the item's terms;
    the sums per pair need no further exchange where the join was partitioned by the row.
    """
    terms_of = asked.select(F.col("item_id").alias("of_item"), F.col("term").alias("of_term"), "w")
    hits = postings.join(candidates, "row").join(
        terms_of, F.col("item_id").eqNullSafe(F.col("of_item")) & (F.col("term") == F.col("of_term")))
    return (hits.groupBy("item_id", "m", "row", "doc_id")
            .agg(F.sum(F.col("w") * impact(F.col("tf"), F.col("m"))).alias("score"))
            .filter(F.col("score") > 0))


def _top(scores: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows per item, first per (item, stratum, salt), then per item."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row"]
    salt = F.pmod(F.xxhash64("row"), F.lit(SALT))
    local = Window.partitionBy("item_id", "m", salt).orderBy(*order)
    best = scores.withColumn("rank", F.row_number().over(local)).filter(F.col("rank") <= k).drop("rank")
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).filter(
        F.col("rank") <= k)
