"""Nearest neighbours by largest inner product: one hierarchical navigable
small-world graph per shard, results of all shards merged.

Vectors are hashed into shards of bounded size.  A shard's graph is built in
one task and written as a row: the vectors and, for every layer, its members
and one flat array of neighbours.  For inner products the shard's vectors get
one more coordinate that makes their norms equal, so the order by distance is
that by product.  Nodes join in batches, those of the highest layers first;
a batch is searched against the graph so far and within itself, neighbours are
chosen by the diversity heuristic, links go both ways, and a node that has too
many is pruned by the same heuristic.  Nodes that no path reaches are linked
at the end.  Many queries search a graph in lockstep, so every step is a few
array operations.

Equal vectors are one node: it keeps the least ``k + 1`` ids, all that any
query can ask for, because ties go to the smaller id; nodes of equal score are
ordered by their least id wherever they are cut.  A beam whose last score is
still that of the ``k + 1``-th may have left equal ones out: such a query is
answered by the scores of all nodes of the shard.

How wide a beam a shard needs depends on its vectors, so its builder measures
that: ``SAMPLED`` of its own vectors are searched and compared with all
products, and the least width of ``EF_SEARCH`` and its doublings that finds
``RECALL`` of their nearest is stored with the graph (the widest is all nodes).

Query vectors are grouped in blocks; a shard's graph is read once, by one task
that all blocks are sent to (``meet``).

Defined results: a vector that is NULL, empty, all zero, or that holds a NULL
or non-finite component takes no part, nor does a NULL id; an id that occurs
with several vectors has the least of them (arrays in order); vectors are
compared with those of their own length only; queries with fewer than ``k``
candidates get them all; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.common import ship_package
from tallymart.llm.meet import meet
from tallymart.session import materialize

K = 20
SHARD = 8192
#: Neighbours chosen for a new node, most kept after pruning (twice that in
#: layer 0), and slots per node (pruning waits until they are full).
LINKS, SLACK = 20, 16
EF_BUILD, EF_SEARCH = 80, 160
#: What the stored beam must find of the nearest of so many sampled vectors.
RECALL, SAMPLED = 0.97, 64
BATCH = 256
QUERY_BLOCK = 1024
SEED = 42


class Graph:
    """A layered graph over ``points`` (rows of equal norm)."""

    def __init__(self, points: np.ndarray, layers: list[np.ndarray], entry: int):
        self.points, self.layers, self.entry = points, layers, entry

    def beam(self, queries: np.ndarray, start: np.ndarray, sim: np.ndarray, layer: int, ef: int):
        """Best ``ef`` nodes of ``layer`` reached from the ``start`` nodes of
        each query: ids (-1: none) and products, best first."""
        links, points = self.layers[layer], self.points
        b, width = len(queries), start.shape[1]
        ids = np.full((b, ef), -1, np.int32)
        sims = np.full((b, ef), -np.inf)
        w = min(width, ef)
        ids[:, :w], sims[:, :w] = start[:, :w], sim[:, :w]
        done = ids < 0
        seen = np.zeros((b, len(points)), bool)
        rows, cols = np.nonzero(start >= 0)
        seen[rows, start[rows, cols]] = True
        live = np.arange(b)
        while live.size:
            open_sims = np.where(done[live], -np.inf, sims[live])
            best = open_sims.argmax(axis=1)
            go = open_sims[np.arange(len(live)), best] > -np.inf
            live, best = live[go], best[go]
            if not live.size:
                break
            done[live, best] = True
            near = links[ids[live, best]]
            new = near >= 0
            new[new] = ~seen[live[np.nonzero(new)[0]], near[new]]
            r, c = np.nonzero(new)
            if not r.size:
                continue
            found = near[r, c]
            seen[live[r], found] = True
            s = np.full(near.shape, -np.inf)
            s[r, c] = np.einsum("ij,ij->i", points[found], queries[live[r]])
            all_sims = np.concatenate([sims[live], s], axis=1)
            all_ids = np.concatenate([ids[live], np.where(new, near, -1)], axis=1)
            all_done = np.concatenate([done[live], ~new], axis=1)
            top = np.argpartition(-all_sims, ef - 1, axis=1)[:, :ef]
            at = np.arange(len(live))[:, None]
            sims[live], ids[live], done[live] = all_sims[at, top], all_ids[at, top], all_done[at, top]
        order = np.argsort(-sims, axis=1, kind="stable")
        at = np.arange(b)[:, None]
        return ids[at, order], sims[at, order]

    def search(self, queries: np.ndarray, ef: int, down_to: int = 0):
        """Beam search through the layers; at ``down_to`` the beam is ``ef``."""
        start = np.full((len(queries), 1), self.entry, np.int32)
        sim = (queries @ self.points[self.entry])[:, None]
        for layer in range(len(self.layers) - 1, down_to, -1):
            start, sim = self.beam(queries, start, sim, layer, 1)
        return self.beam(queries, start, sim, down_to, ef)


def _diverse(points: np.ndarray, own: np.ndarray, cands: np.ndarray, most: int) -> np.ndarray:
    """For each row of candidate ids (-1: none), up to ``most`` of them: best
    first, those nearer to the node than to any chosen one, then the rest."""
    sims = np.einsum("bcd,bd->bc", points[cands], own)
    sims[cands < 0] = -np.inf
    order = np.argsort(-sims, axis=1, kind="stable")
    at = np.arange(len(cands))[:, None]
    cands, sims = cands[at, order], sims[at, order]
    near = points[cands]
    between = near @ near.transpose(0, 2, 1)
    kept = np.zeros(cands.shape, bool)
    for j in range(cands.shape[1]):
        hidden = (kept & (between[:, j, :] >= sims[:, j, None])).any(axis=1)
        kept[:, j] = (cands[:, j] >= 0) & ~hidden & (kept.sum(axis=1) < most)
    rank = np.argsort(~kept * 2 + (cands < 0), axis=1, kind="stable")[:, :most]
    return cands[at, rank]


def _join(points: np.ndarray, links: np.ndarray, degree: np.ndarray, most: int, a: np.ndarray, b: np.ndarray) -> None:
    """Add the links b -> a to the flat array, pruning nodes that are full."""
    order = np.argsort(b, kind="stable")
    a, b = a[order], b[order]
    while b.size:
        first = np.append(True, b[1:] != b[:-1])
        to, new = b[first], a[first]  # one link a node at a time
        full = degree[to] >= links.shape[1]
        if full.any():
            nodes = to[full]
            chosen = _diverse(points, points[nodes], links[nodes], most)
            links[nodes] = -1
            links[nodes, : chosen.shape[1]] = chosen
            degree[nodes] = (chosen >= 0).sum(axis=1)
        links[to, degree[to]] = new
        degree[to] += 1
        a, b = a[~first], b[~first]


def _reach(links: np.ndarray, entry: int) -> np.ndarray:
    seen = np.zeros(len(links), bool)
    seen[entry] = True
    front = np.array([entry])
    while front.size:
        near = np.unique(links[front])
        near = near[near >= 0]
        front = near[~seen[near]]
        seen[front] = True
    return seen


def build(points: np.ndarray, seed: int = SEED) -> Graph:
    """The graph of ``points`` (n, d), rows of equal norm."""
    n = len(points)
    rng = np.random.default_rng(seed)
    level = np.minimum((-np.log(1.0 - rng.random(n)) / np.log(LINKS)).astype(int), 12)
    order = np.lexsort((rng.random(n), -level))
    graph = Graph(points, [], int(order[0]))
    most = [2 * LINKS] + [LINKS] * int(level.max())
    graph.layers = [np.full((n, m + SLACK), -1, np.int32) for m in most]
    degree = [np.zeros(n, np.int64) for _ in most]
    at, size = 1, 1
    while at < n:
        batch = order[at : at + size]
        own = points[batch]
        inside = own @ own.T
        np.fill_diagonal(inside, -np.inf)
        top = int(level[order[0]])
        start = np.full((len(batch), 1), graph.entry, np.int32)
        sim = (own @ points[graph.entry])[:, None]
        for layer in range(top, -1, -1):
            here = level[batch] >= layer
            ef = EF_BUILD if here.any() else 1
            start, sim = graph.beam(own, start, sim, layer, ef)
            if here.any():
                nodes = batch[here]
                peers = np.where(here[None, :], inside[here], -np.inf)
                w = min(LINKS, peers.shape[1])
                best = np.argpartition(-peers, w - 1, axis=1)[:, :w]
                mates = np.where(peers[np.arange(len(nodes))[:, None], best] > -np.inf, batch[best], -1)
                cands = np.concatenate([start[here], mates], axis=1).astype(np.int32)
                chosen = _diverse(points, own[here], cands, LINKS)
                r, c = np.nonzero(chosen >= 0)
                graph.layers[layer][nodes[r], c] = chosen[r, c]
                degree[layer][nodes] = (chosen >= 0).sum(axis=1)
                back = ~(graph.layers[layer][chosen[r, c]] == nodes[r][:, None]).any(axis=1)
                _join(points, graph.layers[layer], degree[layer], most[layer], nodes[r][back], chosen[r, c][back])
        at += len(batch)
        size = min(BATCH, 2 * size)
    _connect(graph, degree[0])
    return graph


def _connect(graph: Graph, degree: np.ndarray) -> None:
    """Link every node that no path of layer 0 reaches from a near one that
    a path does reach (one more slot each, as often as needed)."""
    while True:
        seen = _reach(graph.layers[0], graph.entry)
        lost = np.flatnonzero(~seen)
        if not lost.size:
            return
        node = lost[0]
        reached = np.flatnonzero(seen)
        near = reached[(graph.points[reached] @ graph.points[node]).argmax()]
        links = graph.layers[0]
        if degree[near] >= links.shape[1]:
            graph.layers[0] = links = np.concatenate([links, np.full((len(links), 4), -1, np.int32)], axis=1)
        links[near, degree[near]] = node
        degree[near] += 1


def _equal_norms(x: np.ndarray) -> np.ndarray:
    squares = np.einsum("ij,ij->i", x, x)
    rest = np.sqrt(np.maximum(squares.max() - squares, 0.0))
    scale = np.sqrt(squares.max())
    # In double precision: beside one very long vector all products are near 1.
    return np.column_stack([x, rest]) / scale


def _best(score: np.ndarray, least: np.ndarray, k: int) -> np.ndarray:
    """Columns of the first ``k`` of every row: by score, then least id."""
    first = np.argsort(least, axis=1, kind="stable")
    at = np.arange(len(score))[:, None]
    return first[at, np.argsort(-score[at, first], axis=1, kind="stable")][:, :k]


def search_shard(graph: Graph, x: np.ndarray, least: np.ndarray, queries: np.ndarray, k: int, ef: int):
    """Nodes and products of the first ``k`` found for every query, by product
    of the vectors as given, then least id (-1: none)."""
    n, rows = len(x), np.arange(len(queries))[:, None]
    found, _ = graph.search(np.column_stack([queries, np.zeros(len(queries))]), min(ef, n))
    score = np.where(found >= 0, (x[found] * queries[:, None, :]).sum(axis=2), -np.inf)
    ids = np.where(found >= 0, least[found], np.iinfo(np.int64).max)
    best = _best(score, ids, k)
    found, last = found[rows, best], score.min(axis=1)
    score = score[rows, best]
    # Beyond a full beam there may be more nodes of the last score that counts.
    for i in np.flatnonzero((score[:, -1] == last) & (ef < n)).tolist() if score.shape[1] == k else ():
        every = (x * queries[i]).sum(axis=1)
        found[i] = _best(every[None, :], least[None, :], k)[0]
        score[i] = every[found[i]]
    return found, score


def beam_width(graph: Graph, x: np.ndarray, least: np.ndarray, k: int, ef: int) -> int:
    """The least width, ``ef`` or a doubling of it, that finds ``RECALL`` of
    the first ``k`` of some of the shard's vectors."""
    some = np.random.default_rng(SEED).permutation(len(x))[:SAMPLED]
    k = min(k, len(x))
    product = x[some] @ x.T
    kth = -np.partition(-product, k - 1, axis=1)[:, k - 1]
    while ef < len(x):
        found, score = search_shard(graph, x, least, x[some], k, ef)
        if (score >= kth[:, None] - 1e-12 * np.abs(kth[:, None])).mean() >= RECALL:
            return ef
        ef *= 2
    return len(x)


_INDEX = (
    "shard long, dim int, ids binary, least binary, vectors binary, entry int, ef int, widths array<int>, links array<binary>"
)
_HITS = "query_node long, node long, score double"


def _build_shard(k: int, ef: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", kind="stable")  # the graph must not depend on the order of arrival
        x = np.array(rows["vector"].tolist(), np.float64)
        least = rows["least"].to_numpy(np.int64)
        graph = build(_equal_norms(x))
        return pd.DataFrame(
            {
                "shard": [int(rows["dim"].iloc[0]) << 32 | int(rows["part"].iloc[0])],
                "dim": rows["dim"].iloc[:1].to_numpy(),
                "ids": [rows["node"].to_numpy(np.int64).tobytes()],
                "least": [least.tobytes()],
                "vectors": [x.tobytes()],
                "entry": [graph.entry],
                "ef": [beam_width(graph, x, least, k + 1, ef)],
                "widths": [[m.shape[1] for m in graph.layers]],
                "links": [[m.tobytes() for m in graph.layers]],
            }
        )

    return run


def nodes_of(vectors: DataFrame, id_col: str, vector_col: str, k: int = K) -> DataFrame:
    """One row per distinct usable vector: node (number), vector, members (its
    least ``k + 1`` ids), dim.  Written once, so numbers hold."""
    rows = usable_rows(vectors, id_col, vector_col)
    # At most k + 1 rows of a vector leave a task, however many share it.
    least = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    few = rows.withColumn("at", least).where(F.col("at") <= k + 1)
    grouped = few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("members"))
    numbered = grouped.select(F.monotonically_increasing_id().alias("node"), "vector", "members", F.size("vector").alias("dim"))
    return materialize(numbered, "hnsw-nodes")


def usable_rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector as doubles), one row per id, unusable vectors left out."""
    v = F.col("vector")
    usable = (
        F.col("id").isNotNull()
        & v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    given = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return given.where(usable).groupBy("id").agg(F.min("vector").alias("vector"))


def build_index(nodes: DataFrame, shard: int = SHARD, k: int = K, ef: int = EF_SEARCH) -> DataFrame:
    """One written row per shard: ids, vectors, layers as flat arrays, and the
    width of beam that it needs."""
    ship_package(nodes.sparkSession)
    sizes = materialize(
        nodes.groupBy(F.col("dim").alias("of_dim")).agg(F.ceil(F.count("*") / F.lit(shard)).cast("int").alias("parts")),
        "hnsw-sizes",
    )
    parts = max(1, sizes.agg(F.sum("parts")).first()[0] or 1)
    placed = nodes.join(sizes, F.col("dim") == F.col("of_dim")).select(
        "node", "vector", "dim", F.get("members", F.lit(0)).alias("least"),
        F.pmod(F.xxhash64("vector"), F.col("parts")).cast("int").alias("part"),
    )
    spread = placed.repartitionByRange(int(parts), "dim", "part")
    return materialize(spread.groupBy("dim", "part").applyInPandas(_build_shard(k, ef), _INDEX), "hnsw-index")


class Loaded:
    """A shard as a search needs it."""

    def __init__(self, row: dict):
        self.x = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"])
        self.ids, self.least = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["least"], np.int64)
        layers = [np.frombuffer(b, np.int32).reshape(len(self.ids), w) for b, w in zip(row["links"], row["widths"])]
        self.graph, self.ef = Graph(_equal_norms(self.x), layers, row["entry"]), row["ef"]


def _ask(k: int):
    def ask(shard: Loaded, block: dict) -> pa.RecordBatch:
        asked = np.array([q["node"] for q in block["queries"]], np.int64)
        q = np.array([q["vector"] for q in block["queries"]], np.float64)
        out = [], [], []
        for at in range(0, len(q), BATCH):
            found, score = search_shard(shard.graph, shard.x, shard.least, q[at : at + BATCH], k + 1, shard.ef)
            r, c = np.nonzero(score > -np.inf)
            for store, value in zip(out, (asked[at + r], shard.ids[found[r, c]], score[r, c])):
                store.append(value)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in out], names=["query_node", "node", "score"])

    return ask


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    shard: int = SHARD,
    ef: int = EF_SEARCH,
) -> DataFrame:
    """The ``k`` found nearest of every row for which ``is_query`` (an
    expression over ``id``) holds: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    nodes = nodes_of(vectors, id_col, vector_col, k)
    index = build_index(nodes, shard, k, ef)
    asking = usable_rows(vectors, id_col, vector_col).where(is_query)
    queries = materialize(
        asking.join(nodes.select("node", "vector", "dim"), "vector").select(F.col("id").alias("query_id"), "node", "dim"),
        "hnsw-queries",
    )
    distinct = queries.select("node", "dim").distinct().join(nodes.select("node", "vector"), "node")
    n_blocks = -(-distinct.count() // QUERY_BLOCK) or 1
    blocks = (
        distinct.withColumn("block", F.pmod(F.xxhash64("node"), F.lit(n_blocks)))
        .groupBy(F.col("dim").alias("of_dim"), "block")
        .agg(F.collect_list(F.struct("node", "vector")).alias("queries"))
    )
    # Each block of the stated queries meets every shard of its dimension.
    shards = index.groupBy("dim").agg(F.collect_list("shard").alias("shards"))
    asked = blocks.join(shards, F.col("of_dim") == F.col("dim")).select("shards", "queries")
    hits = meet(index, asked, F.col("shards"), Loaded, _ask(k), _HITS, index.count())
    best = Window.partitionBy("query_node").orderBy(F.desc("score"), "vec_id")
    # k + 1 nodes hold k + 1 ids at least; of equal scores those with the least ids.
    least = F.row_number().over(Window.partitionBy("query_node").orderBy(F.desc("score"), F.get("members", F.lit(0))))
    near = (
        materialize(hits, "hnsw-hits")
        .join(nodes.select("node", "members"), "node")
        .withColumn("at", least)
        .where(F.col("at") <= k + 1)
        .select("query_node", "score", F.explode("members").alias("vec_id"))
        .withColumn("at", F.row_number().over(best))
        .where(F.col("at") <= k + 1)
        .select("query_node", "score", "vec_id")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        queries.join(near, F.col("node") == F.col("query_node"))
        .where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
