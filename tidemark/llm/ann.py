"""Approximate nearest neighbours by cosine in robust-pruned directed graphs.

Different directions are dealt to shards of bounded size.  In a shard, batches of vectors
enter a graph: a greedy search from fixed entry points proposes neighbours; pruning
keeps a neighbour only if no kept one is closer to it by the factor ``ALPHA`` than the
vector itself, so edges stay diverse; and every edge is offered to its other end.  A
query walks the graph of every shard with a beam, in blocks of queries, and the best of
all shards are its answer.  Vectors of one direction (equal ones and multiples) are one
node that carries those with the smallest ids; each is scored by its own vector.

Defined results: null, zero and non-finite vectors, those with null components, and
rows with a null id take no part; vectors of different lengths are never compared; rows
with equal id and vector are one; ties go to the smaller id; with fewer candidates all
are returned; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_folder

SHARD = 4096  # vectors in a graph
DEGREE = 32
BUILD_BEAM = 64
BEAM = 96
ALPHA = 1.2
ENTRIES = 16
BATCH = 256  # vectors that enter or search side by side
QUERIES = 1024  # queries in a block


class Graph:
    """Unit vectors and the neighbours of each, -1 where there are fewer than the degree."""

    def __init__(self, unit: np.ndarray, neighbours: np.ndarray, entries: np.ndarray):
        self.unit, self.neighbours, self.entries = unit, neighbours, entries


def beam_search(graph: Graph, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes found for each unit query, nearest first, and their cosines; -1 where there are fewer."""
    n, q = len(graph.unit), len(queries)
    width = min(beam, n)
    seen = np.zeros((q, n + 1), bool)
    seen[:, n] = True  # stands for "no node"
    entries = graph.entries
    seen[:, entries] = True
    near = queries @ graph.unit[entries].T
    ids = np.full((q, width), n)
    score = np.full((q, width), -np.inf)
    done = np.ones((q, width), bool)
    first = np.argsort(-near, axis=1, kind="stable")[:, :width]
    k = first.shape[1]
    ids[:, :k], score[:, :k], done[:, :k] = entries[first], np.take_along_axis(near, first, 1), False
    rows = np.arange(q)
    while len(rows):
        open_ = ~done[rows]
        rows = rows[open_.any(1)]
        if not len(rows):
            break
        at = np.argmax(~done[rows], axis=1)  # nearest node not yet opened
        done[rows, at] = True
        links = graph.neighbours[ids[rows, at]]
        links = np.where(links < 0, n, links)
        new = ~seen[rows[:, None], links]
        seen[rows[:, None], links] = True
        value = np.einsum("qd,qkd->qk", queries[rows], graph.unit[np.minimum(links, n - 1)])
        value[~new] = -np.inf
        all_ids = np.concatenate([ids[rows], np.where(new, links, n)], 1)
        all_score = np.concatenate([score[rows], value], 1)
        all_done = np.concatenate([done[rows], ~new], 1)
        best = np.argsort(-all_score, axis=1, kind="stable")[:, :width]
        ids[rows] = np.take_along_axis(all_ids, best, 1)
        score[rows] = np.take_along_axis(all_score, best, 1)
        done[rows] = np.take_along_axis(all_done, best, 1) | (score[rows] == -np.inf)
    return np.where(score > -np.inf, ids, -1), score


def robust_prune(unit: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, alpha: float = ALPHA) -> np.ndarray:
    """For each node of ``own`` at most ``degree`` of its candidates (-1: none), nearest first.

    A candidate falls away once ``alpha`` times its distance to a kept one is no more than its distance to the node.
    """
    valid = (candidates >= 0) & (candidates != own[:, None])
    points = unit[np.maximum(candidates, 0)]
    distance = np.where(valid, np.maximum(0, 2 - 2 * np.einsum("qd,qkd->qk", unit[own], points)), np.inf)
    order = np.argsort(distance, axis=1, kind="stable")
    candidates, distance = np.take_along_axis(candidates, order, 1), np.take_along_axis(distance, order, 1)
    repeated = np.zeros(candidates.shape, bool)
    by_id = np.argsort(candidates, axis=1, kind="stable")
    ascending = np.take_along_axis(candidates, by_id, 1)
    np.put_along_axis(repeated, by_id[:, 1:], ascending[:, 1:] == ascending[:, :-1], 1)
    distance[repeated] = np.inf
    points = unit[np.maximum(candidates, 0)]
    among = 2 - 2 * points @ points.transpose(0, 2, 1)
    kept = np.full((len(own), degree), -1)
    count = np.zeros(len(own), np.int64)
    alive = distance < np.inf
    for k in range(candidates.shape[1]):
        take = np.flatnonzero(alive[:, k] & (count < degree))
        if not len(take):
            continue
        kept[take, count[take]] = candidates[take, k]
        count[take] += 1
        alive[take] &= alpha * alpha * among[take, k] > distance[take]  # squared distances
        alive[take, k] = False
    return kept


def build(unit: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM) -> Graph:
    """The graph of a shard."""
    n = len(unit)
    center = int(np.argmax(unit @ unit.sum(0)))
    spread = np.unique(np.append(np.linspace(0, n - 1, min(n, ENTRIES)).astype(np.int64), center))
    graph = Graph(unit, np.full((n, degree), -1), spread)
    rest = np.setdiff1d(np.arange(n), spread)
    order = np.concatenate([spread, np.random.Generator(np.random.PCG64(n)).permutation(rest)])
    graph.neighbours[spread] = robust_prune(unit, spread, np.tile(spread, (len(spread), 1)), degree)
    at, size = len(spread), 8
    while at < n:
        batch = order[at:at + size]
        found, _ = beam_search(graph, unit[batch], beam)
        # vectors of one batch do not see each other in the graph yet
        together = np.tile(batch, (len(batch), 1)) if len(batch) <= BATCH else np.empty((len(batch), 0), np.int64)
        if together.shape[1] > beam:
            near = np.argsort(-(unit[batch] @ unit[batch].T), axis=1, kind="stable")[:, :beam // 2]
            together = batch[near]
        graph.neighbours[batch] = robust_prune(unit, batch, np.concatenate([found, together], 1), degree)
        _offer(graph, batch, degree)
        at += len(batch)
        size = min(BATCH, 2 * size)
    return graph


def _offer(graph: Graph, batch: np.ndarray, degree: int) -> None:
    """Offer the edges of ``batch`` to their other ends; a node with too many prunes its own."""
    target = graph.neighbours[batch].ravel()
    source = np.repeat(batch, degree)
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
    most = int(counts.max()) if len(counts) else 0
    if not most:
        return
    offered = np.full((len(nodes), most), -1)
    offered[np.repeat(np.arange(len(nodes)), counts), np.arange(len(source)) - np.repeat(first, counts)] = source
    for i in range(0, len(nodes), BATCH):
        part = nodes[i:i + BATCH]
        graph.neighbours[part] = robust_prune(graph.unit, part, np.concatenate([graph.neighbours[part], offered[i:i + BATCH]], 1), degree)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times powers of two, so that no square overflows or vanishes; their directions are the same to the last bit."""
    largest = np.abs(vectors).max(-1, keepdims=True)
    return np.ldexp(vectors, -np.frexp(largest)[1])


def units(vectors: np.ndarray) -> np.ndarray:
    near_one = scaled(vectors)
    return near_one / np.sqrt((near_one * near_one).sum(-1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the rows of two arrays in double precision."""
    a, b = scaled(a), scaled(b)
    return (a * b).sum(-1) / (np.sqrt((a * a).sum(-1)) * np.sqrt((b * b).sum(-1)))


def usable(vector: str) -> Column:
    """No null, zero or non-finite vector, and no null component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def vectors_of(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    chosen = rows.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    return chosen.where(F.col("id").isNotNull() & usable("vector"))


def with_direction(rows: DataFrame) -> DataFrame:
    """Adds the components of the unit vector to nine digits: the same for a vector and its multiples."""
    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            bounds = vectors.offsets.to_numpy().astype(np.int64)
            flat = vectors.values.to_numpy(zero_copy_only=False)
            found, sizes = np.empty(len(flat)), np.diff(bounds)
            for size in np.unique(sizes):
                at = bounds[:-1][sizes == size][:, None] + np.arange(size)
                found[at] = np.round(units(flat[at]), 9) + 0.0  # no negative zeros
            yield pa.RecordBatch.from_arrays([batch.column("id"), vectors, pa.ListArray.from_arrays(vectors.offsets, pa.array(found))],
                                             names=["id", "vector", "direction"])

    return rows.select("id", "vector").mapInArrow(of_batch, "id long, vector array<double>, direction array<double>")


def index(rows: DataFrame, spares: int, folder: str, shard_size: int = SHARD) -> DataFrame:
    """One row per shard with its vectors, ids and graph; written to ``folder``.

    ``spares`` members are kept of each direction, those with the smallest ids.
    """
    spark = rows.sparkSession
    # members of a direction: the limit by rank is applied before the shuffle as well
    ranked = with_direction(rows.distinct()).withColumn(
        "rank", F.row_number().over(Window.partitionBy("direction").orderBy("id", "vector"))).where(F.col("rank") <= spares)
    ranked.groupBy("direction").agg(F.sort_array(F.collect_list(F.struct("id", "vector"))).alias("members")).select("members").write.parquet(f"{folder}/vectors")
    nodes = spark.read.parquet(f"{folder}/vectors")
    first = F.element_at("members", 1)
    size = F.size(first["vector"])
    shards = F.ceil(F.col("n") / shard_size).cast("int")
    count = nodes.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n"))
    # a shard is little data and much work, so each is a task of its own
    tasks = max(1, count.agg(F.sum(shards)).first()[0] or 0)
    dealt = (nodes.withColumn("size", size).join(count, "size")
             .select("size", F.pmod(F.xxhash64(first["id"]), shards).alias("shard"), "members")
             .repartition(tasks, "size", "shard"))

    def of_shard(key: tuple, rows: pa.Table) -> pa.Table:
        members = rows.column("members").combine_chunks()
        many = np.diff(members.offsets.to_numpy())
        flat = members.flatten()
        ids = flat.field("id").to_numpy(zero_copy_only=False)
        vectors = flat.field("vector").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), key[0].as_py())
        begins = np.cumsum(many) - many
        order = np.argsort(ids[begins], kind="stable")  # the same whatever the order of the rows
        many = many[order]
        which = np.repeat(begins[order], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        graph = build(units(vectors[begins[order]]))
        return pa.table({
            "size": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()), "n": pa.array([len(order)], pa.int32()),
            "vectors": [vectors[which].tobytes()], "ids": [ids[which].astype(np.int64).tobytes()], "many": [many.astype(np.int32).tobytes()],
            "neighbours": [graph.neighbours.astype(np.int32).tobytes()], "entries": [graph.entries.astype(np.int32).tobytes()]})

    dealt.groupBy("size", "shard").applyInArrow(
        of_shard, "size int, shard int, n int, vectors binary, ids binary, many binary, neighbours binary, entries binary").write.parquet(f"{folder}/graphs")
    return spark.read.parquet(f"{folder}/graphs")


FOUND = "query_id long, vec_id long, score double"


def search(graphs: DataFrame, queries: DataFrame, k: int, spares: int, beam: int = BEAM) -> DataFrame:
    """The ``k`` best of all shards for each query (``id``, ``vector``)."""
    count = queries.count()
    blocks = max(1, math.ceil(count / QUERIES))
    placed = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("size", F.size("vector"))
    packed = placed.groupBy("size", "block").agg(F.collect_list(F.struct("id", "vector")).alias("queries"))  # a block has about QUERIES
    pairs = graphs.join(packed, "size")  # a block goes to each shard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, size = row["n"], row["size"]
                ids, many = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["many"], np.int32).astype(np.int64)
                vectors = np.frombuffer(row["vectors"]).reshape(len(ids), size)
                begins = np.cumsum(many) - many
                member = np.where(np.arange(spares) < many[:, None], begins[:, None] + np.arange(spares), -1)  # of node and place
                graph = Graph(units(vectors[begins]), np.frombuffer(row["neighbours"], np.int32).reshape(n, -1),
                              np.frombuffer(row["entries"], np.int32))
                asked = sorted(row["queries"], key=lambda x: x["id"])
                for i in range(0, len(asked), BATCH):
                    part = asked[i:i + BATCH]
                    own = np.array([x["id"] for x in part])
                    exact = np.array([x["vector"] for x in part])
                    found, _ = beam_search(graph, units(exact), beam)
                    held = np.where((found >= 0)[:, :, None], member[np.maximum(found, 0)], -1)  # query x node x place
                    q, f, p = np.nonzero((held >= 0) & (ids[held] != own[:, None, None]))
                    at = held[q, f, p]
                    score = cosines(exact[q], vectors[at])
                    result = (own[q], ids[at], score)
                    order = np.lexsort((result[1], -result[2], q))
                    place = np.arange(len(order)) - np.searchsorted(q[order], q[order])
                    best = order[place < k]
                    yield pa.RecordBatch.from_arrays([pa.array(x[best]) for x in result], names=["query_id", "vec_id", "score"])

    hits = pairs.repartition(max(1, graphs.count() * blocks), "size", "shard", "block").mapInArrow(run, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def neighbours(rows: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
               shard_size: int = SHARD, beam: int = BEAM) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest found for the rows that ``is_query`` (of ``id``) names."""
    folder = scratch_folder(rows.sparkSession)
    vectors = vectors_of(rows, vec_id, vector)
    graphs = index(vectors, k + 1, folder, shard_size)
    return search(graphs, vectors.where(is_query).dropDuplicates(["id"]), k, k + 1, beam)
