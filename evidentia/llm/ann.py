"""Nearest neighbours by a hierarchical small-world graph per shard.

Vectors are dealt to shards of bounded size by a hash. Each shard builds its
graph alone (no graph spans tasks) and is one row of flat arrays: vectors,
member ids of each distinct vector, and neighbour numbers by level. Graphs are
written once; blocks of queries meet every shard by an equi-join, each (shard,
block) gives the nearest it found, and a window keeps the best of all shards.
Distances are Euclidean in double precision on the original components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from evidentia.llm.common import stored


@dataclass(frozen=True)
class Graph:
    """Links per node above the ground (twice as many on it), widths of the beam, rows of a shard, queries of a block."""

    links: int = 16
    build_width: int = 80
    search_width: int = 200
    shard_rows: int = 8192
    block_rows: int = 512
    seed: int = 17


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class SmallWorld:
    """A layered graph over distinct vectors; ``layers[l]`` maps a node to its neighbours."""

    def __init__(self, vectors: np.ndarray, how: Graph):
        self.vectors, self.how = vectors, how
        self.layers: list[np.ndarray] = []
        self.slots: list[np.ndarray] = []
        self.entry = -1

    # -- building -----------------------------------------------------------------

    def build(self) -> SmallWorld:
        n, links = len(self.vectors), self.how.links
        draw = np.random.default_rng(self.how.seed).random(n)
        top = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(links)).astype(int), 12)
        order = np.arange(n)
        for level in range(int(top.max(initial=0)) + 1):
            held = np.flatnonzero(top >= level)
            slot = np.full(n, -1, np.int32)
            slot[held] = np.arange(len(held))
            self.slots.append(slot)
            self.layers.append(np.full((len(held), links * (2 if level == 0 else 1)), -1, np.int32))
        counts = [np.zeros(len(layer), np.int32) for layer in self.layers]
        highest = -1
        for node in order:
            vector, own = self.vectors[node], int(top[node])
            if self.entry < 0:
                self.entry, highest = int(node), own
                continue
            near = [(self._distance(vector, self.entry), self.entry)]
            for level in range(highest, own, -1):
                near = self._beam(vector, near, 1, level)
            for level in range(min(own, highest), -1, -1):
                near = self._beam(vector, near, self.how.build_width, level)
                for other in self._chosen(near, links):
                    self._link(level, counts[level], int(node), other)
                    self._link(level, counts[level], other, int(node))
            if own > highest:
                self.entry, highest = int(node), own
        return self

    def _distance(self, vector: np.ndarray, node: int) -> float:
        away = self.vectors[node] - vector
        return float(away @ away)

    def _chosen(self, near: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours in different directions first (closer to the new node than to a chosen one), then the nearest."""
        if len(near) <= most:
            return [node for _, node in near]
        nodes = np.array([node for _, node in near])
        away = np.array([d for d, _ in near])
        rows = self.vectors[nodes]
        square = (rows * rows).sum(1)
        between = square[:, None] + square[None, :] - 2 * (rows @ rows.T)
        closest = np.full(len(nodes), np.inf)
        chosen, skipped = [], []
        for i in range(len(nodes)):
            if len(chosen) == most:
                break
            if away[i] <= closest[i]:
                chosen.append(i)
                np.minimum(closest, between[i], out=closest)
            else:
                skipped.append(i)
        return nodes[(chosen + skipped)[:most]].tolist()

    def _link(self, level: int, counts: np.ndarray, node: int, other: int) -> None:
        layer, slot = self.layers[level], self.slots[level][node]
        if counts[slot] < layer.shape[1]:
            layer[slot, counts[slot]] = other
            counts[slot] += 1
            return
        options = np.append(layer[slot], other)
        away = self.vectors[options] - self.vectors[node]
        away = np.einsum("ij,ij->i", away, away)
        rank = np.argsort(away, kind="stable")
        layer[slot] = self._chosen(list(zip(away[rank].tolist(), options[rank].tolist())), layer.shape[1])

    # -- searching -----------------------------------------------------------------

    def _beam(self, vector: np.ndarray, near: list[tuple[float, int]], width: int, level: int) -> list[tuple[float, int]]:
        """The ``width`` nearest found from ``near`` on a level, nearest first."""
        layer, slots, vectors = self.layers[level], self.slots[level], self.vectors
        seen = {node for _, node in near}
        front = list(near)
        heapify(front)
        best = [(-d, node) for d, node in near]
        heapify(best)
        while len(best) > width:
            heappop(best)
        while front:
            d, node = heappop(front)
            if d > -best[0][0] and len(best) >= width:
                break
            fresh = [x for x in layer[slots[node]].tolist() if x >= 0 and x not in seen]
            if not fresh:
                continue
            seen.update(fresh)
            away = vectors[fresh] - vector
            for d, node in zip(np.einsum("ij,ij->i", away, away).tolist(), fresh):
                if len(best) < width:
                    heappush(best, (-d, node))
                    heappush(front, (d, node))
                elif d < -best[0][0]:
                    heapreplace(best, (-d, node))
                    heappush(front, (d, node))
        return sorted((-d, node) for d, node in best)

    def nearest(self, vector: np.ndarray, width: int) -> list[int]:
        near = [(self._distance(vector, self.entry), self.entry)]
        for level in range(len(self.layers) - 1, 0, -1):
            near = self._beam(vector, near, 1, level)
        return [node for _, node in self._beam(vector, near, width, 0)]

    # -- flat arrays ------------------------------------------------------------------

    def flat(self) -> dict:
        return {
            "entry": self.entry,
            "slots": [s.tobytes() for s in self.slots],
            "layers": [x.tobytes() for x in self.layers],
        }

    @classmethod
    def load(cls, vectors: np.ndarray, flat: dict, how: Graph) -> SmallWorld:
        world = cls(vectors, how)
        world.entry = flat["entry"]
        world.slots = [np.frombuffer(s, np.int32) for s in flat["slots"]]
        world.layers = [
            np.frombuffer(x, np.int32).reshape(-1, how.links * (2 if i == 0 else 1)) for i, x in enumerate(flat["layers"])
        ]
        return world


_GRAPH = "shard int, dim int, ids binary, members binary, vectors binary, entry int, slots array<binary>, layers array<binary>"


def index(vectors: DataFrame, how: Graph = Graph()) -> DataFrame:
    """One row per shard with its graph, over every usable row of (vec_id, embedding).

    Equal vectors of a shard are one node with its ids in order; repeated rows
    count once. Vectors of other lengths form graphs of their own.
    """
    rows = vectors.where(usable(F.col("embedding"))).select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.distinct()
    shards = max(1, -(-vectors.count() // how.shard_rows))
    rows = rows.withColumn("dim", F.size("v")).withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))

    def build(group: pa.Table) -> pa.Table:
        n, dim = group.num_rows, group["dim"][0].as_py()
        flat = group["v"].combine_chunks()
        values = (flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat).flatten().to_numpy().reshape(n, dim)
        ids = group["vec_id"].to_numpy().astype(np.int64)
        distinct, node = np.unique(values, axis=0, return_inverse=True)
        shuffle = np.random.default_rng(how.seed).permutation(len(distinct))
        place = np.empty_like(shuffle)
        place[shuffle] = np.arange(len(shuffle))
        distinct, node = distinct[shuffle], place[node.ravel()]
        order = np.lexsort((ids, node))
        starts = np.searchsorted(node[order], np.arange(len(distinct) + 1)).astype(np.int64)
        graph = SmallWorld(distinct, how).build().flat()
        row = {"shard": group["shard"][0].as_py(), "dim": dim, "ids": ids[order].tobytes(), "members": starts.tobytes(), "vectors": distinct.tobytes(), **graph}
        return pa.Table.from_pylist([row], schema=_arrow_schema())

    return rows.groupBy("dim", "shard").applyInArrow(build, _GRAPH)


def _arrow_schema() -> pa.Schema:
    many = pa.list_(pa.binary())
    return pa.schema(
        [("shard", pa.int32()), ("dim", pa.int32()), ("ids", pa.binary()), ("members", pa.binary()), ("vectors", pa.binary()), ("entry", pa.int32()), ("slots", many), ("layers", many)]
    )


def _tied(world, vectors, ids, members, vector, k: int, width: int) -> list[tuple[float, int]]:
    """(score, node) of the nodes found, nearest first; a wider search if the last one ties with the k-th id."""
    while True:
        nodes = np.array(world.nearest(vector, width), np.int64)
        scores = np.sqrt(((vectors[nodes] - vector) ** 2).sum(axis=1))
        order = np.argsort(scores, kind="stable")
        nodes, scores = nodes[order], scores[order]
        held = np.cumsum(members[nodes + 1] - members[nodes])
        at = int(np.searchsorted(held, k))
        if len(nodes) < width or at >= len(nodes) or scores[-1] > scores[at]:
            return list(zip(scores.tolist(), nodes.tolist()))
        width *= 2


def search(graphs: DataFrame, queries: DataFrame, k: int = 10, how: Graph = Graph()) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each usable query (query_id, embedding).

    The row with the query's own id is no candidate. Ties go to the smaller
    vec_id; fewer candidates than k give fewer rows. Unusable queries have no
    row. An id that repeats with several vectors counts with its nearest.
    """
    wanted = queries.where(usable(F.col("embedding"))).where("query_id is not null")
    wanted = wanted.select("query_id", F.col("embedding").cast("array<double>").alias("v")).distinct()
    blocks = max(1, -(-queries.count() // how.block_rows))
    wanted = wanted.withColumn("dim", F.size("v")).withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    wanted = wanted.groupBy("dim", "block").agg(F.collect_list(F.struct("query_id", "v")).alias("queries"))  # about block_rows each
    shards = graphs.select("dim", "shard")
    wanted = wanted.join(shards, "dim")
    met = graphs.join(wanted, ["dim", "shard"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                vectors = np.frombuffer(row["vectors"]).reshape(-1, row["dim"])
                ids, members = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["members"], np.int64)
                world = SmallWorld.load(vectors, row, how)
                found: tuple[list, list, list] = ([], [], [])
                for query in row["queries"]:
                    vector, got, last = np.array(query["v"]), 0, 0.0
                    for score, node in _tied(world, vectors, ids, members, vector, k + 1, max(how.search_width, k + 1)):
                        if got > k and score > last:
                            break  # different vectors at one distance are all taken: the smaller id wins
                        last = score
                        # equal vectors: the k + 1 smallest ids, as larger ones rank behind them
                        for vec_id in ids[members[node] : members[node + 1]][: k + 1].tolist():
                            if vec_id != query["query_id"]:
                                found[0].append(query["query_id"])
                                found[1].append(vec_id)
                                found[2].append(score)
                                got += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())],
                    ["query_id", "vec_id", "score"],
                )

    rows = met.mapInArrow(run, "query_id long, vec_id long, score double")
    rows = rows.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    rows = rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return rows.select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(vectors: DataFrame, k: int = 10, every: int = 100, how: Graph = Graph()) -> DataFrame:
    """Neighbours of every row whose vec_id is divisible by ``every`` among all rows of (vec_id, embedding).

    Vectors that are null, empty, zero or hold null or non-finite components
    take no part; null ids neither. An empty table gives an empty result.
    """
    vectors = vectors.select(F.col("vec_id").cast("long"), "embedding").where("vec_id is not null")
    graphs = stored(index(vectors, how))
    queries = vectors.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")
    return search(graphs, queries, k, how)
