"""Approximate nearest neighbours by largest inner product, on robust-pruned directed graphs.

Method. Rows with equal vectors are one node. Nodes are dealt to shards by hash, and each shard
is one directed graph: every node is searched greedily from the shard's middle, the nodes met
are proposed as its neighbours, and relaxed distance pruning keeps a neighbour only where no
kept one is closer to it by the factor ``ALPHA``, so edges are few and point in different
directions. Edges are also entered in reverse and pruned anew where a node has too many; nodes
that no path reaches get an edge from the nearest one that a path reaches. A query searches
every shard with a beam, and the best of all shards are its neighbours.

The largest inner product is the smallest distance once every vector gets one more component
that brings it to the largest norm, and a query 0 there; graphs are built in this space.

A graph is one row of bounded size, and queries travel in blocks, so a task holds one graph and
one block. Searches of a shard and block are one row and can run anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.common import map_batches, stage

NEIGHBOURS = 20
# Nodes of a shard and queries of a block, on average.
SHARD_NODES = 8192
BLOCK_QUERIES = 1024
# Edges of a node, width of a search while building, and factor of the relaxed pruning.
DEGREE = 32
BUILD_BEAM = 64
ALPHA = 1.2
# Nodes that enter a graph together, at most.
ROUND_NODES = 512
# Width of a query's search in each shard.
BEAM = 96


@dataclass
class Graph:
    """One shard: vectors (one more component than the data's), neighbour lists padded with -1, entry."""

    vectors: np.ndarray
    edges: np.ndarray
    entry: int


def beam_search(graph: Graph, queries: np.ndarray, beam: int, by_product: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, distances) of the ``beam`` nearest nodes met, per query, nearest first; -1 where
    there are fewer. All queries take a step together: the nearest node not yet opened is opened,
    and a query ends when its whole beam is open. Distances are squared and lack the query's own
    norm; ``by_product`` they are the negative inner product, twice."""
    vectors, edges = graph.vectors, graph.edges
    norms = np.zeros(len(vectors), np.float32) if by_product else np.einsum("ij,ij->i", vectors, vectors)

    count = len(queries)
    ids = np.full((count, beam), -1, np.int64)
    far = np.full((count, beam), np.inf, np.float32)
    opened = np.ones((count, beam), bool)
    seen = np.zeros((count, len(vectors)), bool)
    ids[:, 0] = graph.entry
    far[:, 0] = norms[graph.entry] - 2 * queries @ vectors[graph.entry]
    opened[:, 0] = False
    seen[:, graph.entry] = True
    active = np.arange(count)
    while len(active):
        waiting = np.where(opened[active], np.inf, far[active])
        at = waiting.argmin(axis=1)
        going = np.isfinite(waiting[np.arange(len(active)), at])
        active, at = active[going], at[going]
        if not len(active):
            break
        opened[active, at] = True
        found = edges[ids[active, at]]
        fresh = (found >= 0) & ~seen[active[:, None], found]
        nodes, rows = found[fresh], active[np.nonzero(fresh)[0]]
        seen[rows, nodes] = True
        distance = np.full(found.shape, np.inf, np.float32)
        distance[fresh] = norms[nodes] - 2 * np.einsum("ij,ij->i", vectors[nodes], queries[rows])
        every = np.concatenate([far[active], distance], axis=1)
        keep = np.argpartition(every, beam - 1, axis=1)[:, :beam]
        far[active] = np.take_along_axis(every, keep, axis=1)
        ids[active] = np.take_along_axis(np.concatenate([ids[active], found], axis=1), keep, axis=1)
        closed = np.concatenate([opened[active], ~fresh], axis=1)
        opened[active] = np.take_along_axis(closed, keep, axis=1)
    order = np.argsort(far, axis=1, kind="stable")
    ids, far = np.take_along_axis(ids, order, axis=1), np.take_along_axis(far, order, axis=1)
    ids[~np.isfinite(far)] = -1
    return ids, far


def robust_prune(vectors: np.ndarray, nodes: np.ndarray, proposed: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Neighbours of each node among its ``proposed`` (padded with -1): the nearest is kept, and
    those that are closer to it by ``alpha`` than to the node go, until ``degree`` are kept."""
    proposed = np.where(proposed == nodes[:, None], -1, proposed)
    there = vectors[proposed]
    # All distances among a node's proposals, by one product of matrices each.
    norms = np.einsum("ijk,ijk->ij", there, there)
    between = norms[:, :, None] + norms[:, None, :] - 2 * (there @ there.transpose(0, 2, 1))
    distance = ((there - vectors[nodes][:, None]) ** 2).sum(axis=2)
    distance[proposed < 0] = np.inf
    # A node proposed twice takes part once.
    order = np.argsort(proposed, axis=1, kind="stable")
    sorted_ids = np.take_along_axis(proposed, order, axis=1)
    again = np.zeros(proposed.shape, bool)
    np.put_along_axis(again, order[:, 1:], sorted_ids[:, 1:] == sorted_ids[:, :-1], axis=1)
    distance[again] = np.inf
    rows = np.arange(len(nodes))
    out = np.full((len(nodes), degree), -1, np.int64)
    for k in range(degree):
        best = distance.argmin(axis=1)
        live = np.isfinite(distance[rows, best])
        if not live.any():
            break
        out[live, k] = proposed[rows, best][live]
        # Squared distances, so the factor counts squared.
        distance[(alpha * alpha * between[rows, best] <= distance) & live[:, None]] = np.inf
        distance[rows[live], best[live]] = np.inf
    return out


def build_graph(vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 0) -> Graph:
    """Graph over ``vectors`` (rows, float32). Nodes enter in rounds, the middle first; a round
    is as large as what has entered, up to ``ROUND_NODES``, and its searches see what has entered."""
    count = len(vectors)
    entry = int(((vectors - vectors.mean(axis=0)) ** 2).sum(axis=1).argmin())
    # Lists have room for some reverse edges before they are pruned again.
    graph = Graph(vectors, np.full((count, degree + degree // 2), -1, np.int64), entry)
    nodes = np.random.default_rng(seed).permutation(count)
    nodes = nodes[nodes != entry]
    first = 0
    while first < len(nodes):
        some = nodes[first : first + min(ROUND_NODES, first + 1)]
        first += len(some)
        met, _ = beam_search(graph, vectors[some], beam)
        kept = robust_prune(vectors, some, met, degree, alpha)
        graph.edges[some, :degree] = kept
        _enter_reverse(vectors, graph.edges, np.repeat(some, degree), kept.ravel(), degree, alpha)
    graph.edges = _reach_all(graph)
    return graph


def _enter_reverse(vectors: np.ndarray, edges: np.ndarray, tails: np.ndarray, heads: np.ndarray, degree: int, alpha: float) -> None:
    """Edges from ``heads`` back to ``tails``; a list without room for its new edges is pruned."""
    tails, heads = tails[heads >= 0], heads[heads >= 0]
    order = np.argsort(heads, kind="stable")
    heads, tails = heads[order], tails[order]
    targets, firsts, counts = np.unique(heads, return_index=True, return_counts=True)
    more = np.full((len(targets), int(counts.max(initial=0))), -1, np.int64)
    more[np.repeat(np.arange(len(targets)), counts), np.arange(len(heads)) - np.repeat(firsts, counts)] = tails
    used = (edges[targets] >= 0).sum(axis=1)
    room = used + counts <= edges.shape[1]
    at, k = np.nonzero(more[room] >= 0)
    edges[targets[room][at], used[room][at] + k] = more[room][at, k]
    targets, more, counts = targets[~room], more[~room], counts[~room]
    # Lists of similar length are pruned together, so one long list does not widen all.
    order = np.argsort(counts)
    for first in range(0, len(targets), 256):
        some = order[first : first + 256]
        extra = more[some, : int(counts[some].max())]
        kept = robust_prune(vectors, targets[some], np.concatenate([edges[targets[some]], extra], axis=1), degree, alpha)
        edges[targets[some], :degree] = kept
        edges[targets[some], degree:] = -1


def _reach_all(graph: Graph) -> np.ndarray:
    """The edges, and one more for each node that no path from the entry reaches."""
    vectors, edges = graph.vectors, graph.edges
    reached = np.zeros(len(vectors), bool)
    front = np.array([graph.entry])
    added: dict[int, list[int]] = {}
    while True:
        while len(front):
            reached[front] = True
            onward = np.unique(edges[front])
            front = onward[(onward >= 0) & ~reached[np.maximum(onward, 0)]]
        left = np.flatnonzero(~reached)
        if not len(left):
            break
        known = np.flatnonzero(reached)
        node = left[0]
        nearest = known[((vectors[known] - vectors[node]) ** 2).sum(axis=1).argmin()]
        added.setdefault(int(nearest), []).append(int(node))
        front = np.array([node])
    if added:
        wide = np.full((len(edges), edges.shape[1] + max(map(len, added.values()))), -1, np.int64)
        wide[:, : edges.shape[1]] = edges
        for node, more in added.items():
            wide[node, edges.shape[1] : edges.shape[1] + len(more)] = more
        edges = wide
    return edges


def clean(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector) of the rows that take part, one per id."""
    vector = F.col(vector_column).cast("array<float>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    useful = rows.select(F.col(id_column).cast("long").alias("id"), vector.alias("vector")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    )
    # -0.0 and 0.0 are one value.
    useful = useful.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0).cast("float")))
    return useful.groupBy("id").agg(F.min("vector").alias("vector"))


def index(rows: DataFrame, keep: int = NEIGHBOURS, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """One row per shard of ``rows`` (id, vector): dim, shard, its nodes' vectors, ids and edges as bytes.

    Only the ``keep`` + 1 smallest ids of equal vectors are stored: with ties going to smaller
    ids, no other can be among ``keep`` neighbours of any row.
    """
    order = Window.partitionBy("vector").orderBy("id")
    few = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep + 1)
    nodes = few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    nodes = nodes.withColumn("dim", F.size("vector"))
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    nodes = stage(nodes.withColumn("norm", norm), "neighbour-nodes")
    sizes = nodes.groupBy("dim").agg(F.max("norm").alias("largest"), F.ceil(F.count("*") / shard_nodes).alias("shards"))
    dealt = nodes.join(sizes, "dim").withColumn("shard", F.pmod(F.xxhash64("vector", "ids"), F.col("shards")))
    dealt = dealt.repartition("dim", "shard").sortWithinPartitions("dim", "shard", F.col("ids")[0])
    dealt = dealt.select("dim", "shard", "largest", "ids", "vector")
    return map_batches(dealt, _graphs, "dim int, shard long, nodes long, entry long, vectors binary, ids binary, id_ends binary, edges binary")


def _graphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of dim and shard to one row per shard."""
    names = ["dim", "shard", "nodes", "entry", "vectors", "ids", "id_ends", "edges"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
    key, held = None, []

    def row() -> pa.RecordBatch:
        vectors = np.concatenate([x[0] for x in held])
        ids = np.concatenate([x[1] for x in held])
        ends = np.cumsum(np.concatenate([x[2] for x in held]))
        dim, shard, largest = key
        norms = np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64)
        longer = np.sqrt(np.maximum(largest - norms, 0)).astype(np.float32)
        graph = build_graph(np.concatenate([vectors, longer[:, None]], axis=1), seed=shard)
        values = [dim, shard, len(vectors), graph.entry, vectors.tobytes(), ids.tobytes(), ends.tobytes(), graph.edges.astype(np.int32).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

    for batch in batches:
        dims, shards = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero((np.diff(dims) != 0) | (np.diff(shards) != 0)) + 1
        for first, last in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if first == last:
                continue
            part = batch.slice(first, last - first)
            now = (int(dims[first]), int(shards[first]), part.column(2)[0].as_py())
            if now != key:
                if held:
                    yield row()
                key, held = now, []
            lists = part.column(3)
            vectors = part.column(4).flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, now[0])
            counts = np.diff(lists.offsets.to_numpy())
            held.append((vectors, lists.flatten().to_numpy(), counts))
    if held:
        yield row()


def pack_queries(queries: DataFrame, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """Blocks of queries (id, vector): dim, block, members."""
    sized = queries.withColumn("dim", F.size("vector"))
    blocks = sized.groupBy("dim").agg(F.ceil(F.count("*") / block_queries).alias("blocks"))
    dealt = sized.join(blocks, "dim").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    return dealt.groupBy("dim", "block").agg(F.array_sort(F.collect_list(F.struct("id", "vector"))).alias("members"))


def _search(keep: int, beam: int):
    """Rows (one graph, one block of queries) to (query_id, vec_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k] for n in batch.schema.names}
                dim, count = row["dim"].as_py(), row["nodes"].as_py()
                read = lambda n, kind: np.frombuffer(row[n].as_buffer(), kind)
                vectors = read("vectors", np.float32).reshape(count, dim)
                ids, ends = read("ids", np.int64), read("id_ends", np.int64)
                edges = read("edges", np.int32).reshape(count, -1).astype(np.int64)
                members = row["members"].values
                query_ids = members.field("id").to_numpy()
                queries = members.field("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, dim)
                graph = Graph(vectors, edges, row["entry"].as_py())
                for first in range(0, len(queries), 256):
                    some = queries[first : first + 256]
                    met, _ = beam_search(graph, some, max(beam, keep + 1), by_product=True)
                    yield _best(met, some, query_ids[first : first + 256], vectors, ids, ends, keep)

    return run


def _best(met, queries, query_ids, vectors, ids, ends, keep) -> pa.RecordBatch:
    """The ``keep`` best rows behind the nodes met, with products in double precision."""
    out = ([], [], [])
    starts = np.concatenate(([0], ends[:-1]))
    for row, (query, own) in enumerate(zip(queries, query_ids, strict=True)):
        nodes = met[row][met[row] >= 0]
        score = (vectors[nodes].astype(np.float64) * query.astype(np.float64)).sum(axis=1)
        counts = ends[nodes] - starts[nodes]
        places = np.repeat(starts[nodes] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
        found, score = ids[places], np.repeat(score, counts)
        other = found != own
        found, score = found[other], score[other]
        order = np.lexsort((found, -score))[:keep]
        out[0].append(np.full(len(order), own))
        out[1].append(found[order])
        out[2].append(score[order])
    columns = [np.concatenate(c) if c else np.zeros(0) for c in out]
    kinds = (pa.int64(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["query_id", "vec_id", "score"])


def nearest_neighbours(
    rows: DataFrame,
    is_query,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    keep: int = NEIGHBOURS,
    beam: int = BEAM,
    shard_nodes: int = SHARD_NODES,
) -> DataFrame:
    """The ``keep`` rows of largest inner product found for each row for which ``is_query`` holds,
    itself left out: query_id, rank from 1, vec_id, score in double precision. Equal scores are
    ranked by vec_id. All other rows come back where there are no more than ``keep``.

    Rows whose vector is null, empty, zero or has a null or non-finite component take no part,
    nor do rows without an id. A repeated id counts once, with its smallest vector. Vectors of
    different lengths have no product, so each length is searched for itself. Copies under
    different ids are all candidates. An empty table gives no rows; other columns are not read.
    """
    vectors = stage(clean(rows, id_column, vector_column), "neighbour-vectors")
    graphs = stage(index(vectors, keep, shard_nodes), "neighbour-graphs")
    wanted = rows.where(is_query).select(F.col(id_column).cast("long").alias("id")).distinct()
    blocks = stage(pack_queries(vectors.join(wanted, "id", "left_semi")), "neighbour-queries")
    shards = graphs.select("dim", "shard")
    pairs = blocks.select("dim", "block").join(shards, "dim")
    searches = pairs.join(blocks, ["dim", "block"]).join(graphs, ["dim", "shard"])
    found = map_batches(searches, _search(keep, beam), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = stage(found, "neighbour-found").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
