"""N-gram Jaccard join with adaptive multi-match prefixes; classes of near duplicates.

Links join documents whose sets of 4-word shingles have a Jaccard similarity of 0.85 or more.

1. *Sets.*  Documents are dealt into chunks of bounded size; equal sets of a chunk, and later of all
   chunks, become one node.
2. *Order.*  The global order of tokens is by document frequency, then by hash.  Frequencies are exact
   counts over all chunks: a chunk sends its sorted distinct tokens, squeezed, to token ranges, and gets the
   frequencies back in the same order.  Tokens travel once, without the documents that hold them.
3. *Prefixes.*  Two sets with overlap ``t`` share ``l`` tokens within their first ``n - t + l``.
   Each document picks its own ``l``: a longer prefix meets more candidates but asks more shared tokens of
   them, and the estimated cost of both decides.  A pair is a candidate if it shares as many prefix
   tokens as the less demanding of its two documents asks.  Tokens of frequency 1 match
   nothing: they only shorten the prefix, and a document with too many of them has no partner.
4. *Hubs.*  Of the documents at a prefix token the one with the most frequent tokens on average is a hub (in a
   group of copies, the text that the others vary); each document is verified against the hub that it meets most.  That links most copies of a group with as
   many comparisons as documents.
5. *Pairs.*  What remains are candidates in different classes.  Documents at a token that agree in all
   that bounds use (hub, distance to it, size, own tokens) are counted as one group first, and only pairs of
   groups that pass the bounds are opened up.  The symmetric difference is a metric, so distances to a
   common hub bound the distance of two copies: groups of copies don't meet pair by pair.
6. Candidates are verified by exact intersection; components are found by star contraction.

Defined results: a null or empty text has size 0 and no links; a null id stays a row and does not
name its class (which has a null name if no member has an id); rows that repeat an id are documents
of their own; an empty table gives no rows; other columns are not read.  A text of up to three
words is one shingle, the whole sequence.  Shingles are 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, lazily, small_batches, stage, text_of
from .graph import components
from .shingles import shingle_sets, signatures, spread, squeezed

#: Least similarity, in hundredths.
PERCENT = 85
#: Bytes of text in a chunk, sets in a chunk, tokens in a token range; l at most.
CHUNK_BYTES, CHUNK_SETS, RANGE_TOKENS, MOST = 1 << 20, 1 << 16, 1 << 19, 8
#: Up to so many ids of rows to drop are broadcast, so that texts stay where they are; more are joined by shuffle.
FEW_IDS = 1 << 20
#: Cost of verifying a candidate, in units of a posting met: fixed, and per token.
VERIFY, VERIFY_TOKEN = 20.0, 0.05

_SETS = "sets array<struct<i:int,n:int,hi:long,lo:long,ids:array<long>>>"
_CHUNK = f"chunk long, texts binary, sizes binary, tokens long, empty array<long>, {_SETS}"


def least_overlap(n):
    """Overlap that any partner of a set of size n shares with it at least."""
    return -(-PERCENT * n // 100)


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    chunk = TaskContext.get().partitionId() << 24
    texts: list[bytes] = []
    ids: list = []
    held = 0
    for pdf in batches:
        for doc_id, text in zip(pdf["doc_id"].astype("Int64"), pdf["text"], strict=True):
            texts.append(text.encode("utf-8", "surrogatepass"))
            ids.append(None if doc_id is pd.NA else int(doc_id))
            held += len(texts[-1])
            if held >= CHUNK_BYTES or len(texts) >= CHUNK_SETS:
                yield _chunk(chunk, texts, ids)
                chunk, texts, ids, held = chunk + 1, [], [], 0
    if texts:
        yield _chunk(chunk, texts, ids)


def _chunk(chunk: int, texts: list[bytes], ids: list) -> pd.DataFrame:
    hashes, counts = shingle_sets(texts)
    sums = signatures(hashes, counts)
    members: dict[tuple, list] = {}
    firsts: dict[tuple, int] = {}
    empty = []
    for d, doc_id in enumerate(ids):
        if counts[d]:
            key = (int(counts[d]), int(sums[d, 0]), int(sums[d, 1]))
            firsts.setdefault(key, d)
            members.setdefault(key, []).append(doc_id)
        else:
            empty.append(doc_id)
    kept = [texts[d] for d in firsts.values()]
    sets = [{"i": i, "n": n, "hi": hi, "lo": lo, "ids": members[n, hi, lo]} for i, (n, hi, lo) in enumerate(firsts)]
    row = [chunk, zlib.compress(b"".join(kept), 1), np.array([len(t) for t in kept], "i4").tobytes(),
           sum(k[0] for k in firsts), empty, sets]
    return pd.DataFrame([row], columns=["chunk", "texts", "sizes", "tokens", "empty", "sets"])


def _sets_of(row) -> tuple[np.ndarray, np.ndarray]:
    data = zlib.decompress(row.texts)
    cuts = np.concatenate([[0], np.cumsum(np.frombuffer(row.sizes, "i4"))])
    return shingle_sets([data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)])


def _range_edges(bits: int, ranges: int) -> np.ndarray:
    return np.array([(i << bits) // ranges for i in range(1, ranges)], "u8")


def _outgoing(batches: Iterator[pd.DataFrame], bits: int, ranges: int) -> Iterator[pd.DataFrame]:
    """Sorted distinct tokens of a chunk, cut into token ranges, and in how many of its sets each is."""
    edges = _range_edges(bits, ranges)
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            hashes, _ = _sets_of(row)
            tokens, counts = np.unique(hashes >> np.uint64(64 - bits), return_counts=True)
            cuts = [0, *np.searchsorted(tokens, edges), len(tokens)]
            out = [(p, row.chunk, squeezed(np.diff(tokens[a:b], prepend=np.uint64(0))), squeezed(counts[a:b]))
                   for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            yield pd.DataFrame(out, columns=["p", "chunk", "steps", "counts"])


def _counted(pdf: pd.DataFrame) -> pd.DataFrame:
    """Frequencies over all chunks, returned to each chunk in the order of its tokens."""
    tokens = [np.cumsum(spread(s)) for s in pdf["steps"]]
    counts = np.concatenate([spread(c) for c in pdf["counts"]]).astype("f8")
    _, which = np.unique(np.concatenate(tokens), return_inverse=True)
    df = np.bincount(which, weights=counts)[which].astype("u8")
    cuts = np.cumsum([0, *map(len, tokens)])
    out = [squeezed(df[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    del tokens, counts, which, df
    give_back()
    return pd.DataFrame({"chunk": pdf["chunk"], "p": pdf["p"], "df": out})


def choose(df: np.ndarray, n: int, own: int) -> int:
    """The l of least estimated cost: postings met in the prefix, and candidates that share l of its tokens.

    ``df`` are the frequencies of the shared tokens in order; ``own`` tokens come before them.
    By Markov's inequality at most ``met / l`` documents share l tokens when ``met`` postings are met.
    """
    t = least_overlap(n)
    met = np.cumsum(df - 1.0)
    best, least = 1, np.inf
    for l in range(1, min(MOST, t) + 1):  # noqa: E741
        seen = met[min(n - t + l - own, len(df)) - 1]
        cost = seen + seen / l * (VERIFY + VERIFY_TOKEN * n)
        if cost < least:
            best, least = l, cost
    return best


_PREFIX = "key long, n int, own int, mass long, l int, prefix array<long>, shared binary"


def _prefixes(batches: Iterator[pd.DataFrame], bits: int) -> Iterator[pd.DataFrame]:
    """Sets that can have a partner: their prefix, and their shared tokens for verification."""
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            hashes, counts = _sets_of(row)
            _, which = np.unique(hashes >> np.uint64(64 - bits), return_inverse=True)
            df = np.concatenate([spread(d["df"]) for d in sorted(row.dfs, key=lambda d: d["p"])])[which]
            cuts = np.concatenate([[0], np.cumsum(counts)])
            shared = np.add.reduceat((df > 1).astype("i8"), cuts[:-1])
            out = []
            for i in np.flatnonzero(shared >= least_overlap(counts)):
                n, own = int(counts[i]), int(counts[i] - shared[i])
                f, h = df[cuts[i]:cuts[i + 1]], hashes[cuts[i]:cuts[i + 1]]
                mass = int(1000 * f.sum() // n)
                f, h = f[f > 1], h[f > 1]
                order = np.lexsort((h, f))
                l = choose(f[order].astype("f8"), n, own)  # noqa: E741
                prefix = h[order[:n - least_overlap(n) + l - own]].view("i8")
                out.append(((row.chunk << 16) + i, n, own, mass, l, prefix, h.tobytes()))
            yield pd.DataFrame(out, columns=["key", "n", "own", "mass", "l", "prefix", "shared"])


def _overlaps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Exact overlap of verified pairs; shared tokens are in order of hash."""
    for pdf in batches:
        common = [len(np.intersect1d(np.frombuffer(a, "u8"), np.frombuffer(b, "u8"), assume_unique=True))
                  for a, b in zip(pdf["shared_a"], pdf["shared_b"], strict=True)]
        yield pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "apart": pdf["n_a"] + pdf["n_b"] - 2 * np.array(common, "i8"),
                            "together": pdf["n_a"] + pdf["n_b"]})


def _near(apart: Column, together: Column) -> Column:
    """Similarity reached: of sizes summing to ``together``, ``apart`` tokens are in one set only."""
    return (100 + PERCENT) * apart <= (100 - PERCENT) * together


def _verified(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``a, b, apart, linked`` of pairs ``a, b`` of node keys."""
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("key").alias(side), F.col("n").alias(f"n_{side}"),
                                        F.col("shared").alias(f"shared_{side}")), side)
    done = pairs.mapInPandas(lazily(_overlaps), "a long, b long, apart long, together long")
    return done.select("a", "b", "apart", _near(F.col("apart"), F.col("together")).alias("linked"))


def _hubs(postings: DataFrame, nodes: DataFrame) -> DataFrame:
    """``key, hub, apart, linked``: every document against the hub that it meets at most of its prefix tokens."""
    hub = postings.groupBy("token").agg(F.max(F.struct("mass", "key")).alias("h"), F.count("*").alias("many"))
    hub = hub.filter(F.col("many") > 1).select(F.col("token").alias("at"), F.col("h.key").alias("hub"))
    met = postings.join(hub, postings["token"] == hub["at"]).groupBy("key", "hub").agg(F.count("*").alias("times"))
    chosen = stage(met.groupBy("key").agg(F.min(F.struct((-F.col("times")).alias("t"), "hub")).alias("h"))
                   .select("key", F.col("h.hub").alias("hub")), "hubs")
    other = _verified(chosen.filter("key <> hub").select(F.col("key").alias("a"), F.col("hub").alias("b")), nodes)
    own = chosen.filter("key = hub").select("key", "hub", F.lit(0).cast("long").alias("apart"), F.lit(True).alias("linked"))
    return stage(own.unionByName(other.select(F.col("a").alias("key"), F.col("b").alias("hub"), "apart", "linked")), "stars")


def _classes_so_far(stars: DataFrame) -> DataFrame:
    """``key, class``: two steps up the links to hubs; equal classes are truly linked, other ones need not be apart."""
    up = stars.select("key", F.when(F.col("linked"), F.col("hub")).otherwise(F.col("key")).alias("class"))
    again = up.select(F.col("key").alias("k"), F.col("class").alias("next"))
    return up.join(again, up["class"] == again["k"], "left").select("key", F.coalesce("next", "class").alias("class"))


_GROUP = ("hub", "apart", "n", "own", "l", "class_")


def _remaining(postings: DataFrame, stars: DataFrame, nodes: DataFrame) -> DataFrame:
    """``a, b``: candidates in different classes that share enough prefix tokens and pass all bounds."""
    classes = _classes_so_far(stars)
    # classes with a member besides the one that names them; joined by that member, as a class may hold most rows
    heads = classes.filter("key <> class").select(F.col("class").alias("head")).distinct()
    known = classes.join(heads, classes["key"] == heads["head"], "left").select(
        F.col("key").alias("k"), "class",
        F.when((F.col("key") != F.col("class")) | F.col("head").isNotNull(), F.col("class")).otherwise(-1).alias("class_"))
    about = stars.select(F.col("key").alias("s"), "hub", "apart").join(known, F.col("s") == F.col("k")).drop("s")
    rows = stage(postings.join(about, postings["key"] == about["k"]).drop("k"), "postings")
    groups = rows.groupBy("token", *_GROUP).agg(F.count("*").alias("many"))
    left = groups.select("token", *[F.col(c).alias(f"{c}_1") for c in (*_GROUP, "many")])
    right = groups.select(F.col("token").alias("token_2"), *[F.col(c).alias(f"{c}_2") for c in _GROUP])
    c = F.col
    shared = F.least(c("n_1") - c("own_1"), c("n_2") - c("own_2"))
    # tokens of its own that a document has are in its difference to the hub, and in no other one
    common = F.least(*[c(f"apart_{s}") - F.least(c(f"own_{s}"), c(f"apart_{s}")) for s in (1, 2)])
    ordered = F.struct(*[c(f"{g}_1") for g in _GROUP]) <= F.struct(*[c(f"{g}_2") for g in _GROUP])
    same = F.struct(*[c(f"{g}_1") for g in _GROUP]) == F.struct(*[c(f"{g}_2") for g in _GROUP])
    total = c("n_1") + c("n_2")
    passed = left.join(
        right, (c("token") == c("token_2")) & ordered & (~same | (c("many_1") > 1))
        & ((c("class__1") != c("class__2")) | (c("class__1") == -1))
        & (100 * F.least("n_1", "n_2") >= PERCENT * F.greatest("n_1", "n_2"))
        & _near(total - 2 * shared, total)
        & ((c("hub_1") != c("hub_2")) | _near(c("apart_1") + c("apart_2") - 2 * common, total)))
    passed = stage(passed.drop("token_2", "many_1"), "passed")

    def opened(s: int, key: str) -> DataFrame:
        """The documents of one side of the group pairs, with their prefixes."""
        on = c("token") == c(f"t_{key}")
        for g in _GROUP:
            on = on & (c(f"{g}_{s}") == c(f"{key}_{g}"))
        side = rows.select(c("token").alias(f"t_{key}"), c("key").alias(key), c("class").alias(f"class_{key}"),
                           *[c(g).alias(f"{key}_{g}") for g in _GROUP])
        if key == "a":
            side = passed.join(side, on).drop("t_a", *[f"a_{g}" for g in _GROUP])
        else:
            side = side.join(passed, on, "left_semi")
        prefixes = nodes.select(c("key").alias("k"), c("prefix").alias(f"prefix_{key}"))
        return side.join(prefixes, c(key) == c("k")).drop("k")

    common = F.array_intersect("prefix_a", "prefix_b")
    on = c("token") == c("t_b")
    for g in _GROUP:
        on = on & (c(f"{g}_2") == c(f"b_{g}"))
    # a pair is made at the first token that it shares only, and only if it shares enough
    wanted = (c("class_a") != c("class_b")) & (c("a") != c("b")) & (~same | (c("a") < c("b"))) & (
        F.get(common, F.lit(0)) == c("token")) & (F.size(common) >= F.least("l_1", "l_2"))
    return opened(1, "a").join(opened(2, "b"), on & wanted).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, spanning_links`` of every row.

    ``component_id`` is the smallest id of the class.  ``spanning_links`` counts those verified links of the
    document's set to other sets that were kept to span its class.  It is no count of its links: pairs already
    in one class are not verified.  Equal sets are linked by being one.
    """
    return _members(docs, id_col, text_col).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", "spanning_links")


def _members(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, hi, lo, component_id, first, spanning_links`` of every row: its set's size and signature, and its class.

    ``first`` marks the set that stands for its class: of those with the smallest id the least one.
    """
    chunks = stage(text_of(docs, id_col, text_col).mapInPandas(lazily(_chunks), _CHUNK), "chunks")
    sets = chunks.select("chunk", F.explode("sets").alias("s")).select(
        (F.col("chunk") * (1 << 16) + F.col("s.i")).alias("key"), "s.n", "s.hi", "s.lo", "s.ids")
    # one node per distinct set: the least of its keys
    unique = stage(sets.groupBy("n", "hi", "lo").agg(
        F.min("key").alias("node"), F.min(F.array_min("ids")).alias("low")), "sets")
    links = _links(chunks, unique)
    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    degree = links.select(F.explode(F.array("a", "b")).alias("of")).groupBy("of").agg(F.count("*").alias("spanning_links"))
    named = unique.join(roots, unique["node"] == roots["node"], "left").drop(roots["node"]).withColumn(
        "root", F.coalesce("root", "node"))
    own = F.struct(F.col("low").isNull().alias("nameless"), "low", "n", "hi", "lo")
    names = named.groupBy(F.col("root").alias("r")).agg(F.min(own).alias("head"))
    named = named.join(names, named["root"] == names["r"]).join(degree, named["node"] == degree["of"], "left").select(
        F.col("n").alias("n_"), F.col("hi").alias("hi_"), F.col("lo").alias("lo_"),
        F.col("head.low").alias("component_id"), (own == F.col("head")).alias("first"), F.coalesce("spanning_links", F.lit(0)).alias("spanning_links"))
    # a chunk has a set once, whatever its number of copies
    full = sets.join(named, (F.col("n") == F.col("n_")) & (F.col("hi") == F.col("hi_")) & (F.col("lo") == F.col("lo_"))).select(
        F.explode("ids").alias("doc_id"), "n", "hi", "lo", "component_id", "first", "spanning_links")
    none = F.lit(0).cast("long")
    empty = chunks.select(F.explode("empty").alias("doc_id")).select(
        "doc_id", F.lit(0).alias("n"), none.alias("hi"), none.alias("lo"), F.col("doc_id").alias("component_id"),
        F.lit(True).alias("first"), none.alias("spanning_links"))
    return full.unionByName(empty)


def _links(chunks: DataFrame, unique: DataFrame) -> DataFrame:
    """``a, b``: verified links between nodes that span every class."""
    tokens = int(chunks.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0])
    ranges = max(1, -(-tokens // RANGE_TOKENS))
    # tokens are counted by so many bits that few of them collide; a collision only makes a token look more frequent
    bits = min(64, max(32, tokens.bit_length() + 12))
    counted = (chunks.select("chunk", "texts", "sizes")
               .mapInPandas(lazily(_outgoing, bits, ranges), "p int, chunk long, steps binary, counts binary")
               .groupBy("p").applyInPandas(_counted, "chunk long, p int, df binary"))
    # as many numbers as the chunk has tokens
    back = counted.groupBy("chunk").agg(F.collect_list(F.struct("p", "df")).alias("dfs"))
    found = chunks.select("chunk", "texts", "sizes").join(back, "chunk").mapInPandas(lazily(_prefixes, bits), _PREFIX)
    nodes = stage(found.join(unique.select(F.col("node").alias("key")), "key", "left_semi"), "nodes")
    postings = nodes.select("key", "n", "own", "mass", "l", F.explode("prefix").alias("token"))
    stars = _hubs(postings, nodes)
    rest = _verified(_remaining(postings, stars, nodes), nodes).filter("linked")
    return stage(stars.filter("linked and key <> hub").select(F.col("key").alias("a"), F.col("hub").alias("b"))
                 .unionByName(rest.select("a", "b")), "links")


def _set_of(texts: pd.Series) -> pd.DataFrame:
    """Size and signature of each text's set, as :func:`_chunk` has them."""
    hashes, counts = shingle_sets([t.encode("utf-8", "surrogatepass") for t in texts])
    sums = signatures(hashes, counts)
    return pd.DataFrame({"n": counts.astype("i4"), "hi": sums[:, 0], "lo": sums[:, 1]})


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class of near duplicates, with all columns.

    It has the smallest id of the class, or none if no member has one; of several such rows it is that of the
    least set signature, then of the least text by hash.  Texts without words are in no class: they stay, of
    rows with equal id and text one.
    """
    found = stage(_members(docs, id_col, text_col).select(
        "doc_id", "n", "hi", "lo", (F.col("first") & F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("stays")), "found")
    key, text = F.col(f"`{id_col}`").cast("long"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    # ids that don't stay for all their rows, or that several rows have, and the missing id
    aside = found.groupBy(F.col("doc_id").alias("aside")).agg(F.count("*").alias("many"), F.max("stays").alias("any"))
    aside = stage(aside.filter("many > 1 or not any or aside is null"), "aside")

    def few(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if ids.count() <= FEW_IDS else ids

    def by_ids(frame: DataFrame, ids: DataFrame, how: str) -> DataFrame:
        # the ids' column is taken from their own frame: a column of docs with the same name is no clash
        ids = few(ids)
        return frame.join(ids, key == ids["aside"], how)

    again = aside.filter("any and (many > 1 or aside is null)").select("aside")
    kept = by_ids(docs, aside.filter("aside is not null").select("aside"), "left_anti").filter(key.isNotNull())
    if again.isEmpty():
        return kept
    rows = small_batches(docs)
    several = by_ids(rows, again.filter("aside is not null"), "left_semi").unionByName(rows.filter(key.isNull()))
    several = several.select(F.struct("*").alias("d"), key.alias("id"), F.col(f"`{text_col}`").alias("t"), F.pandas_udf(
        _set_of, "n int, hi long, lo long")(text).alias("set")).select("d", "id", "t", "set.*")
    wordless = several.filter("n = 0")
    wordless = wordless.filter("id is null").unionByName(wordless.filter("id is not null").dropDuplicates(["id", "t"]))
    # one row per id and set before the join, so that no key of it has many
    full = several.filter("n > 0").groupBy("id", "n", "hi", "lo").agg(
        F.min_by("d", F.struct(F.xxhash64("t").alias("hash"), "t")).alias("d"))
    stay = found.filter("stays and n > 0").select(F.col("doc_id").alias("id_"), F.col("n").alias("n_"), F.col("hi").alias("hi_"),
                                                  F.col("lo").alias("lo_"))
    full = full.join(stay, F.col("id").eqNullSafe(F.col("id_")) & (F.col("n") == F.col("n_")) & (F.col("hi") == F.col("hi_"))
                     & (F.col("lo") == F.col("lo_")), "left_semi")
    return kept.unionByName(full.select("d.*")).unionByName(wordless.select("d.*"))
