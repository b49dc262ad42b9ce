"""Approximate nearest neighbours: a robust-pruned directed graph in each shard, searched with a beam.

Distinct vectors are dealt to shards by hash, about ``SHARD_ROWS`` to each at any size of the table. One task builds one
shard's graph: vectors enter in batches that double; for each, a greedy search of the graph so far proposes neighbours,
and robust pruning keeps the nearest and drops what a kept one is closer to by the factor ``RELAX``, which leaves diverse
edges, some of them long; reverse edges are added and pruned alike. Graphs are rows of a table in the shared folder, so a lost
executor costs one shard. Queries come in blocks of bounded size, each block meets each shard once, and a beam search
gives the nearest of the shard; the nearest over all shards are exact distances between original vectors in double precision.

Equal vectors are one node. As a query wants k rows, a node needs no more than the k + 1 smallest ids of its copies (one
may be the query itself), so a vector that fills a third of the table is k + 1 ids after a partial rank in each task.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part; vectors only meet vectors
of their own length; repeated ids are candidates of their own, and none of a query's own id is its candidate; null ids take no
part; ties go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from calloom.session import stage

SHARD_ROWS = 1 << 14
QUERY_BLOCK = 1 << 10
#: Tasks for each full shard, so that few shards seldom meet in one, and tasks at most. Rows are few and their work is long.
SPREAD, MOST_TASKS = 4, 1 << 14
DEGREE, BEAM, RELAX = 32, 64, 1.2
SEARCH_BEAM = 256
#: Nodes that one step of a search opens, nodes where it begins, points that enter together, and points that enter twice.
OPENED, ENTRIES, BATCH, AGAIN = 4, 16, 256, 1024


class Graph:
    """Out-edges of each node, -1 where there are fewer than ``DEGREE``; searches run for many queries at once."""

    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float32)
        self.norms = np.einsum("nd,nd->n", self.points, self.points)
        self.edges = np.full((len(points), DEGREE), -1, np.int32)
        centre = self.points.mean(axis=0, dtype=np.float64).astype(np.float32)
        middle = int(((self.points - centre) ** 2).sum(axis=1).argmin())
        order = np.random.default_rng(0).permutation(len(points))
        self.order = np.r_[middle, order[order != middle]]
        self.entries = self.order[:ENTRIES]

    def _far(self, nodes: np.ndarray, others: np.ndarray) -> np.ndarray:
        apart = self.points[nodes] - others
        return np.einsum("nd,nd->n", apart, apart)

    def search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        """The nodes of each query's beam, nearest first; -1: none."""
        n, count = len(self.points), len(queries)
        rows, begin = np.arange(count)[:, None], self.entries
        nodes = np.full((count, beam), -1, np.int64)
        far = np.full((count, beam), np.inf, np.float32)
        nodes[:, : len(begin)] = begin
        far[:, : len(begin)] = self._far(np.tile(begin, count), np.repeat(queries, len(begin), axis=0)).reshape(count, -1)
        order = np.argsort(far, axis=1, kind="stable")
        nodes, far = nodes[rows, order], far[rows, order]
        opened = ~np.isfinite(far)
        seen = np.zeros((count, n + 1), bool)  # the last column stands for -1
        seen[:, begin] = seen[:, n] = True
        while not opened.all():
            first = np.argsort(opened, axis=1, kind="stable")[:, :OPENED]  # the nearest that are not opened
            fresh = ~opened[rows, first]
            opened[rows, first] = True
            new = np.where(fresh[:, :, None], self.edges[nodes[rows, first]], -1).reshape(count, -1).astype(np.int64)
            new = np.sort(np.where(new < 0, n, new), axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = n
            new[seen[rows, new]] = n
            seen[rows, new] = True
            reached = np.full(new.shape, np.inf, np.float32)
            at = np.nonzero(new < n)
            reached[at] = self._far(new[at], queries[at[0]])
            all_nodes, all_far = np.hstack([nodes, np.where(new == n, -1, new)]), np.hstack([far, reached])
            all_opened = np.hstack([opened, new == n])
            best = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
            nodes, far, opened = all_nodes[rows, best], all_far[rows, best], all_opened[rows, best]
            opened |= ~np.isfinite(far)
        return nodes

    def prune(self, own: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Robust pruning of candidates ``near`` (-1: none) of the nodes ``own``."""
        near = np.sort(near, axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near[near == own[:, None]] = -1
        points, norms = self.points[np.maximum(near, 0)], self.norms[np.maximum(near, 0)]

        def from_(centres: np.ndarray) -> np.ndarray:
            inner = np.matmul(points, self.points[centres][:, :, None])[:, :, 0]
            return np.maximum(norms + self.norms[centres][:, None] - 2 * inner, 0)

        far = from_(own)
        far[near < 0] = np.inf
        rows = np.arange(len(own))
        kept = np.full((len(own), DEGREE), -1, np.int32)
        for slot in range(DEGREE):
            at = far.argmin(axis=1)
            some = np.isfinite(far[rows, at])
            if not some.any():
                break
            chosen = near[rows, at]
            kept[some, slot] = chosen[some]
            far[(RELAX**2) * from_(np.maximum(chosen, 0)) <= far] = np.inf
            far[rows, at] = np.inf
        return kept

    def insert(self, batch: np.ndarray) -> None:
        self.edges[batch] = self.prune(batch, np.hstack([self.search(self.points[batch], BEAM), self.edges[batch]]))
        targets, sources = self.edges[batch].ravel().astype(np.int64), np.repeat(batch, DEGREE)
        sources, targets = sources[targets >= 0], targets[targets >= 0]
        # of a node's new in-neighbours the nearest are candidates for reverse edges
        order = np.lexsort((self._far(targets, self.points[sources]), targets))
        sources, targets = sources[order], targets[order]
        nodes, starts, counts = np.unique(targets, return_index=True, return_counts=True)
        place = np.arange(len(targets)) - np.repeat(starts, counts)
        extra = np.full((len(nodes), DEGREE), -1, np.int64)
        row = np.repeat(np.arange(len(nodes)), counts)[place < DEGREE]
        extra[row, place[place < DEGREE]] = sources[place < DEGREE]
        both = np.hstack([self.edges[nodes].astype(np.int64), extra])
        both = -np.sort(-both, axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        both = -np.sort(-both, axis=1)
        full = both[:, DEGREE] >= 0 if both.shape[1] > DEGREE else np.zeros(len(nodes), bool)
        self.edges[nodes[~full]] = both[~full, :DEGREE]
        for at in range(0, int(full.sum()), BATCH):
            part = np.flatnonzero(full)[at : at + BATCH]
            self.edges[nodes[part]] = self.prune(nodes[part], both[part])

    @classmethod
    def build(cls, points: np.ndarray) -> "Graph":
        graph, at = cls(points), 1
        while at < len(points):
            size = min(at, BATCH)
            graph.insert(graph.order[at : at + size])
            at += size
        # once more, so that early nodes are linked within the whole shard
        for at in range(0, min(len(points), AGAIN), BATCH):
            graph.insert(graph.order[at : min(at + BATCH, AGAIN)])
        return graph


def usable(vector: Column) -> Column:
    """Whether a vector is not null, not zero, and has finite components only."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(F.size(vector) > 0, F.lit(False)) & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


def _tasks(nodes: int | None, shard_rows: int) -> int:
    """How many tasks to deal shards to: a number Spark keeps, as by their bytes all would be one task."""
    return max(1, min(SPREAD * -(-(nodes or 0) // shard_rows), MOST_TASKS))


def build_index(rows: DataFrame, copies: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(shard, dim, size, graph): one serialised graph for each shard of ``rows`` (id, vector), with ids by node."""
    rows = rows.withColumn("_deal", F.xxhash64("vector"))
    by_vector = Window.partitionBy("_deal", "vector").orderBy("id")
    few = rows.withColumn("_rank", F.row_number().over(by_vector)).filter(F.col("_rank") <= copies)
    nodes = few.groupBy("_deal", "vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    nodes = stage(nodes.withColumn("dim", F.size("vector")))
    shards = nodes.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).alias("shards"))
    tasks = _tasks(nodes.count(), shard_rows)
    dealt = nodes.join(shards, "dim").withColumn("shard", F.pmod("_deal", "shards").cast("int"))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_deal", kind="stable")
        points = np.array(group["vector"].tolist(), np.float64)
        graph = Graph.build(points)
        data = pickle.dumps((graph.entries, graph.edges, points, [np.array(ids, np.int64) for ids in group["ids"]]))
        return pd.DataFrame({"shard": [group["shard"].iloc[0]], "dim": [points.shape[1]], "size": [len(points)], "graph": [data]})

    kept = dealt.select("dim", "shard", "_deal", F.col("vector").cast("array<double>").alias("vector"), "ids")
    return stage(kept.repartition(tasks, "dim", "shard").groupBy("dim", "shard").applyInPandas(build, "shard int, dim int, size int, graph binary"))


def search(index: DataFrame, queries: DataFrame, k: int, block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query (id, vector), over all shards."""
    queries = queries.withColumn("dim", F.size("vector"))
    count = queries.groupBy("dim").agg(F.ceil(F.count("*") / block).alias("_blocks"))
    blocks = (
        queries.join(count, "dim").withColumn("_block", F.pmod(F.xxhash64("id"), "_blocks"))
        .groupBy("dim", "_block")
        .agg(F.collect_list(F.struct("id", F.col("vector").cast("array<double>").alias("vector"))).alias("queries"))
    )
    shards = index.groupBy("dim").agg(F.max("shard").alias("_last"))
    blocks = blocks.join(shards, "dim")
    blocks = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), "_last"))).select("dim", "shard", "queries")
    tasks = _tasks(index.agg(F.sum("size")).first()[0], SHARD_ROWS)
    met = index.repartition(tasks, "dim", "shard").join(blocks.repartition(tasks, "dim", "shard"), ["dim", "shard"])
    met = met.select("graph", "queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                entries, edges, points, ids = pickle.loads(one.column("graph")[0].as_py())
                graph = Graph.__new__(Graph)
                graph.entries, graph.edges, graph.points = entries, edges, points.astype(np.float32)
                asked = one.column("queries").flatten()
                wanted = asked.field("id").to_numpy(zero_copy_only=False)
                vectors = np.array(asked.field("vector").to_pylist(), np.float64)
                nodes = graph.search(vectors.astype(np.float32), max(SEARCH_BEAM, 2 * k))
                out: tuple[list, list, list] = ([], [], [])
                for at, query in enumerate(wanted.tolist()):
                    found = nodes[at][nodes[at] >= 0]
                    exact = np.sqrt(((points[found] - vectors[at]) ** 2).sum(axis=1))
                    copies = [ids[node] for node in found]
                    far = np.repeat(exact, [len(c) for c in copies])
                    all_ids = np.concatenate(copies)
                    far, all_ids = far[all_ids != query], all_ids[all_ids != query]
                    best = np.lexsort((all_ids, far))[:k]
                    out[0].extend([query] * len(best)), out[1].extend(all_ids[best].tolist()), out[2].extend(far[best].tolist())
                arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["query_id", "vec_id", "score"])

    found = met.mapInArrow(run, "query_id long, vec_id long, score double")
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def neighbours(rows: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest rows of each row for which ``is_query`` holds, among all others."""
    chosen = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), is_query.alias("_query"))
    chosen = chosen.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    index = build_index(chosen.select("id", "vector"), k + 1)
    # a query that stands several times is asked once
    queries = chosen.filter("_query").dropDuplicates(["id"]).select("id", "vector")
    return search(index, queries, k)
