"""Approximate nearest neighbours by robust-pruned directed graphs.

Method.  Rows are dealt to shards of bounded size.  In each shard a directed graph is grown in
batches: a greedy beam search over the graph so far proposes neighbours of the new points,
and relaxed pruning keeps a candidate only if no kept one is nearer to it by the factor ``alpha``
than the point itself, so kept edges are diverse.  Edges are also set backwards and lists that
grow too long are pruned the same way.  A query runs a beam search in every shard, and the
candidates of all shards are ranked by their exact cosine.

Vectors that are equal share one node of the graph; all their ids are found with it.

Measured on these tables (tests hold it to 0.9): the share of the true nearest that is found.

Defined results: vectors that are null, zero, empty or hold a null or non-finite component, and rows
without an id, take no part; vectors of another dimension are no candidates; rows that repeat an
id count as one candidate with their best score, and a query's own id is never its candidate; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lazily, stage
from .vectors import FOUND, best, one_row_per, packed, pairs, query_blocks

#: Rows of a shard on average, edges of a node, beams of building and of searching, pruning factor.
SHARD, DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA = 3072, 32, 64, 128, 1.15
EXPAND, BATCH, ENTRIES = 4, 512, 16


def as_given(x: np.ndarray) -> np.ndarray:
    return x


def beam_search(points: np.ndarray, graph: np.ndarray, entries: np.ndarray, queries: np.ndarray, width: int):
    """For all queries at once: the ``width`` nearest seen (positions, -1 if none; similarities), nearest first."""
    many, rows = len(queries), np.arange(len(queries))[:, None]
    ids = np.full((many, width), -1, "i4")
    sims = np.full((many, width), -np.inf, "f4")
    open_ = np.zeros((many, width), bool)
    seen = np.zeros((many, len(points)), bool)
    fresh = np.broadcast_to(entries, (many, len(entries)))
    new_sims = (queries @ points[entries].T).astype("f4")
    seen[:, entries] = True
    active = np.arange(many)
    while True:
        all_ids = np.concatenate([ids[active], fresh], 1)
        all_sims = np.concatenate([sims[active], new_sims], 1)
        all_open = np.concatenate([open_[active], np.isfinite(new_sims)], 1)
        top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width] if all_sims.shape[1] > width \
            else np.broadcast_to(np.arange(all_sims.shape[1]), all_sims.shape)
        pick = rows[:len(active)]
        n = top.shape[1]
        ids[active, :n], sims[active, :n], open_[active, :n] = all_ids[pick, top], all_sims[pick, top], all_open[pick, top]
        waiting = np.where(open_[active], sims[active], -np.inf)
        left = np.isfinite(waiting).any(1)
        active, waiting = active[left], waiting[left]
        if not len(active):
            break
        pick = rows[:len(active)]
        take = np.argpartition(-waiting, EXPAND, axis=1)[:, :EXPAND]
        chosen = np.where(np.isfinite(waiting[pick, take]), ids[active][pick, take], -1)
        open_[active[:, None], take] = False
        near = graph[chosen].reshape(len(active), -1)
        near = np.where(np.repeat(chosen < 0, graph.shape[1], 1), -1, near)
        # a node proposed twice in one step counts once
        near = np.sort(near, axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        fresh = np.where((near >= 0) & ~seen[active[:, None], near], near, -1)
        at, column = np.nonzero(fresh >= 0)
        nodes = fresh[at, column]
        seen[active[at], nodes] = True
        new_sims = np.full(fresh.shape, -np.inf, "f4")
        new_sims[at, column] = np.einsum("ij,ij->i", points[nodes], queries[active[at]])
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def robust_prune(points: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each node, up to ``degree`` of its candidates (-1: none), nearest first, without those that a kept one shades."""
    nearness = np.einsum("nd,ncd->nc", points[nodes], points[candidates])
    alive = (candidates >= 0) & (candidates != nodes[:, None])
    nearness = np.where(alive, nearness, -np.inf)
    order = np.argsort(-nearness, axis=1, kind="stable")
    candidates, nearness = np.take_along_axis(candidates, order, 1), np.take_along_axis(nearness, order, 1)
    alive = np.take_along_axis(alive, order, 1)
    between = np.matmul(points[candidates], points[candidates].transpose(0, 2, 1))
    out = np.full((len(nodes), degree), -1, "i4")
    count = np.zeros(len(nodes), int)
    rows = np.arange(len(nodes))
    for _ in range(degree):
        has = alive.any(1)
        if not has.any():
            break
        first = alive.argmax(1)
        out[rows[has], count[has]] = candidates[rows[has], first[has]]
        count[has] += 1
        # squared distances of unit vectors are 2 - 2 cos
        shaded = alpha * alpha * (1 - between[rows, first]) <= 1 - nearness
        alive &= ~(shaded & has[:, None])
        alive[rows, first] = False
    return out


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA):
    """Edges (n x degree, -1: none) and entry points of a graph over unit vectors."""
    n = len(points)
    order = np.random.default_rng(n).permutation(n)
    entries = order[:min(n, ENTRIES)].astype("i4")
    graph = np.full((n, degree), -1, "i4")
    begin, size = 1, 1
    graph_nodes = order[:1]
    while begin < n:
        batch = order[begin:begin + size]
        starts = entries[np.isin(entries, graph_nodes)]
        near, _ = beam_search(points, graph, starts, points[batch], min(beam, max(2 * EXPAND, begin)))
        # points of one batch are candidates of each other too, nearest first
        mates = points[batch] @ points[batch].T
        np.fill_diagonal(mates, -np.inf)
        mate = batch[np.argsort(-mates, axis=1)[:, :min(len(batch) - 1, degree // 2)]] if len(batch) > 1 else near[:, :0]
        graph[batch] = robust_prune(points, batch, np.concatenate([near, mate], 1), degree, alpha)
        _set_back(points, graph, batch, degree, alpha)
        begin += len(batch)
        graph_nodes = order[:begin]
        size = min(BATCH, begin)
    return graph, entries


def _set_back(points: np.ndarray, graph: np.ndarray, batch: np.ndarray, degree: int, alpha: float) -> None:
    """Edges from the batch's neighbours back to it; full lists are pruned anew."""
    to = graph[batch]
    source = np.repeat(batch, to.shape[1])[(to >= 0).ravel()]
    target = to[to >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
    held = (graph[nodes] >= 0).sum(1)
    # by how many arrive, so that padding stays small
    for group in np.array_split(np.argsort(counts), max(1, len(nodes) // 256)):
        if not len(group):
            continue
        wide = int(counts[group].max())
        column = np.arange(wide)
        given = np.where(column < counts[group][:, None], source[np.minimum(first[group][:, None] + column, len(source) - 1)], -1)
        both = np.concatenate([graph[nodes[group]], given], 1)
        fits = held[group] + counts[group] <= degree
        if fits.any():
            # held edges first
            rows = both[fits]
            rows = np.take_along_axis(rows, np.argsort(rows < 0, axis=1, kind="stable"), 1)[:, :degree]
            graph[nodes[group][fits], :rows.shape[1]] = rows
        if (~fits).any():
            for part in np.array_split(np.flatnonzero(~fits), -(-int((~fits).sum()) * both.shape[1] ** 2 // 4_000_000)):
                graph[nodes[group][part]] = robust_prune(points, nodes[group][part], both[part], degree, alpha)


def _unit(vecs: np.ndarray) -> np.ndarray:
    return (vecs / np.sqrt((vecs ** 2).sum(1))[:, None]).astype("f4")


def _index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        graphs = []
        for row in pdf.itertuples(index=False):
            vecs = np.unique(np.frombuffer(row.vecs, "f8").reshape(-1, row.dim), axis=0)
            graph, entries = build_graph(_unit(vecs))
            graphs.append((graph.tobytes(), entries.tobytes()))
        yield pdf.assign(graph=[g for g, _ in graphs], entries=[e for _, e in graphs])


def _search(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out: list[tuple] = []
        for row in pdf.itertuples(index=False):
            rows = np.frombuffer(row.vecs, "f8").reshape(-1, row.dim)
            ids = np.frombuffer(row.ids, "i8")
            vecs, node = np.unique(rows, axis=0, return_inverse=True)
            node = node.ravel()
            by_node = np.lexsort((ids, node))
            starts = np.searchsorted(node[by_node], np.arange(len(vecs) + 1))
            q_ids, asked = np.frombuffer(row.q_ids, "i8"), np.frombuffer(row.q_vecs, "f8").reshape(-1, row.dim)
            graph = np.frombuffer(row.graph, "i4").reshape(len(vecs), -1)
            near, _ = beam_search(_unit(vecs), graph, np.frombuffer(row.entries, "i4"), _unit(asked), SEARCH_BEAM)
            lengths = np.sqrt((vecs ** 2).sum(1))
            for query, q, nodes in zip(q_ids, asked, near[:, :4 * k], strict=True):
                nodes = nodes[nodes >= 0]
                scores = (vecs[nodes] * q).sum(1) / (lengths[nodes] * np.sqrt((q ** 2).sum()))
                left = k
                for i in np.lexsort((ids[by_node[starts[nodes]]], -scores)):
                    # of equal vectors the k smallest ids can be results
                    own = ids[by_node[starts[nodes[i]]:starts[nodes[i] + 1]]]
                    own = np.unique(own[own != query])[:k]
                    out += [(int(query), int(v), float(scores[i])) for v in own]
                    left -= len(own)
                    if left <= 0:
                        break
        yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def nearest(df: DataFrame, k: int, step: int, id_col: str = "vec_id", vec_col: str = "embedding",
            shard: int = SHARD) -> DataFrame:
    """``query_id, rank, vec_id, score`` (cosine) for the rows whose id is divisible by ``step``."""
    vectors = packed(df, id_col, vec_col, as_given).filter(F.col("norm") > 0)
    count = max(1, -(-vectors.count() // shard))
    sharded = vectors.withColumn("b", F.pmod(F.xxhash64("vec_id", "v"), F.lit(count)))
    index = stage(one_row_per(sharded, ["b"]).mapInPandas(
        _index, "b long, dim int, n int, top double, ids binary, vecs binary, graph binary, entries binary"), "index")
    found = pairs(query_blocks(vectors, step), index, count).mapInPandas(lazily(_search, k), FOUND.format(score="double"))
    return best(found, k)
