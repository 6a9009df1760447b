"""Approximate nearest neighbours by a small-world graph per shard.

Equal vectors are merged first (a vector a third of all rows share is one
node). Distinct vectors are dealt to about as many shards as there are cores, to
more where a shard would outgrow a task's memory. Each shard builds
a hierarchical navigable small-world graph: every node links to near but
mutually distant others, a random few also on sparser upper levels; links are
flat integer arrays. A query walks greedily down the levels and searches the
lowest with a bounded list of best candidates. Blocks of queries meet every
shard, the found candidates are scored exactly on the original vectors, and
the shards' best are merged.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import staged, table

#: distinct vectors of a shard: at least so many, as more shards mean more searches for each
#: query, and at most so many, which with BLOCK_ROWS queries bounds a task's memory
SHARD_ROWS, MOST_ROWS = 6_000, 1 << 17
BLOCK_ROWS = 512
LINKS = 16
BUILD_LIST, SEARCH_LIST = 80, 160


def spread_out(near: np.ndarray, closeness: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of ``near`` (best first): those nearer to the node than to
    any chosen one, then the best of the others."""
    if len(near) <= most:
        return near
    among = vectors[near] @ vectors[near].T
    chosen, others = [0], []
    for i in range(1, len(near)):
        if len(chosen) == most:
            break
        (chosen if (among[i, chosen] < closeness[i]).all() else others).append(i)
    return near[sorted(chosen + others[:most - len(chosen)])]


class Graph:
    """Links as flat arrays: ``levels[k]`` is (node, link), -1 where there is none;
    level 0 has twice the links. ``row`` maps nodes to rows of upper levels."""

    def __init__(self, vectors: np.ndarray, links: int = LINKS, build_list: int = BUILD_LIST, seed: int = 1):
        self.vectors = vectors
        n = len(vectors)
        height = np.minimum((-np.log(1.0 - np.random.default_rng(seed).random(n)) / math.log(links)).astype(int), 8)
        self.levels, self.row, self.used = [], [], []
        for level in range(int(height.max(initial=0)) + 1):
            nodes = np.flatnonzero(height >= level)
            row = np.full(n, -1, np.int32)
            row[nodes] = np.arange(len(nodes))
            self.row.append(row)
            self.levels.append(np.full((len(nodes), 2 * self._most(level, links)), -1, np.int32))
            self.used.append(np.zeros(len(nodes), np.int32))
        self.entry, self.top = 0, int(height[0]) if n else 0
        self.seen = np.zeros(n, np.int32)
        self.turn = 0
        for node in range(1, n):
            self._insert(node, int(height[node]), links, build_list)
        for level, table_ in enumerate(self.levels):  # from room for growth to the final width
            most = self._most(level, links)
            for r in np.flatnonzero(self.used[level] > most):
                self._shrink(level, int(r), int(np.flatnonzero(self.row[level] == r)[0]), most)
            self.levels[level] = np.ascontiguousarray(table_[:, :most])

    @staticmethod
    def _most(level: int, links: int) -> int:
        return links if level else 2 * links

    def _shrink(self, level: int, r: int, node: int, most: int) -> None:
        near = self.levels[level][r, :self.used[level][r]]
        close = self.vectors[near] @ self.vectors[node]
        order = np.argsort(-close, kind="stable")
        kept = spread_out(near[order], close[order], self.vectors, most)
        self.levels[level][r] = -1
        self.levels[level][r, :len(kept)] = kept
        self.used[level][r] = len(kept)

    def _link(self, level: int, a: int, b: int, most: int) -> None:
        r = int(self.row[level][a])
        self.levels[level][r, self.used[level][r]] = b
        self.used[level][r] += 1
        if self.used[level][r] == self.levels[level].shape[1]:
            self._shrink(level, r, a, most)

    def _insert(self, node: int, height: int, links: int, build_list: int) -> None:
        q = self.vectors[node]
        at = self.entry
        for level in range(self.top, height, -1):
            at = self._greedy(q, at, level)
        starts = [at]
        for level in range(min(height, self.top), -1, -1):
            close, near = self.search_level(q, starts, level, build_list)
            starts = near.tolist()
            most = self._most(level, links)
            for other in spread_out(near, close, self.vectors, links).tolist():
                self._link(level, node, other, most)
                self._link(level, other, node, most)
        if height > self.top:
            self.entry, self.top = node, height

    def _greedy(self, q: np.ndarray, at: int, level: int) -> int:
        best = float(self.vectors[at] @ q)
        while True:
            near = self.levels[level][self.row[level][at]]
            near = near[near >= 0]
            if not len(near):
                return at
            close = self.vectors[near] @ q
            i = int(close.argmax())
            if close[i] <= best:
                return at
            at, best = int(near[i]), float(close[i])

    def search_level(self, q: np.ndarray, starts: list[int], level: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Closeness and node of the up to ``size`` best found, best first."""
        self.turn += 1
        seen, turn, vectors = self.seen, self.turn, self.vectors
        links, row = self.levels[level], self.row[level]
        seen[starts] = turn
        close = (vectors[starts] @ q).tolist()
        todo = [(-c, s) for c, s in zip(close, starts)]
        best = [(c, s) for c, s in zip(close, starts)]
        heapq.heapify(todo)
        heapq.heapify(best)
        while len(best) > size:
            heapq.heappop(best)
        while todo:
            c, at = heapq.heappop(todo)
            if -c < best[0][0] and len(best) >= size:
                break
            near = links[row[at]]
            near = near[(near >= 0) & (seen[near] != turn)]
            if not len(near):
                continue
            seen[near] = turn
            for c, x in zip((vectors[near] @ q).tolist(), near.tolist()):
                if len(best) < size:
                    heapq.heappush(best, (c, x))
                    heapq.heappush(todo, (-c, x))
                elif c > best[0][0]:
                    heapq.heapreplace(best, (c, x))
                    heapq.heappush(todo, (-c, x))
        best.sort(reverse=True)
        return np.array([c for c, _ in best], np.float32), np.array([x for _, x in best], np.int64)

    def nearest(self, q: np.ndarray, size: int = SEARCH_LIST) -> np.ndarray:
        at = self.entry
        for level in range(self.top, 0, -1):
            at = self._greedy(q, at, level)
        return self.search_level(q, [at], 0, size)[1]

    def flat(self) -> bytes:
        """The graph as one array of integers."""
        parts = [np.array([self.entry, self.top, len(self.levels)], np.int32)]
        for table_, row in zip(self.levels, self.row):
            parts += [np.array(table_.shape, np.int32), np.flatnonzero(row >= 0).astype(np.int32), table_.ravel()]
        return np.concatenate(parts).tobytes()

    @classmethod
    def from_flat(cls, vectors: np.ndarray, data: bytes) -> "Graph":
        ints = np.frombuffer(data, np.int32)
        g = cls.__new__(cls)
        g.vectors, g.seen, g.turn = vectors, np.zeros(len(vectors), np.int32), 0
        g.entry, g.top, n_levels = ints[:3].tolist()
        g.levels, g.row, at = [], [], 3
        for _ in range(n_levels):
            rows, width = ints[at:at + 2].tolist()
            row = np.full(len(vectors), -1, np.int32)
            row[ints[at + 2:at + 2 + rows]] = np.arange(rows)
            at += 2 + rows
            g.row.append(row)
            g.levels.append(ints[at:at + rows * width].reshape(rows, width))
            at += rows * width
        return g


def units(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def usable(vector: Column) -> Column:
    """Neither null, empty, zero nor holding null or non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def shards_for(n: int, cores: int, least: int = SHARD_ROWS, most: int = MOST_ROWS) -> int:
    """A shard for each core, of ``least`` vectors or more; further ones only where a shard
    would hold more than ``most``. Every query is searched in every shard, so shards that
    grow with the table keep the searches in proportion to the queries."""
    return max(1, min(-(-n // least), cores), -(-n // most))


_GRAPHS = "dim int, shard int, vectors binary, ids binary, graph binary"


def build_graphs(vectors: DataFrame, per_vector: int, shard_rows: int | None = None) -> tuple[DataFrame, int]:
    """One graph per shard of ``vectors(vec_id, embedding)``: ``dim, shard, vectors``
    (32-bit floats), ``ids`` (the ``per_vector`` smallest of each) and ``graph``;
    also the number of shards (``shard_rows``: of that many vectors each). A shard is built in a task of its own."""
    order = Window.partitionBy("embedding").orderBy("vec_id")
    merged = staged(vectors.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_vector)
                    .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                    .withColumn("dim", F.size("embedding")), "vectors")
    n = merged.count()
    shards = -(-n // shard_rows) or 1 if shard_rows else shards_for(n, vectors.sparkSession.sparkContext.defaultParallelism)

    def build(group: pa.Table) -> pa.Table:
        ids = group.column("ids").to_pylist()
        flat = group.column("embedding").combine_chunks().flatten().to_numpy().astype(np.float32)
        order = sorted(range(len(ids)), key=lambda i: (ids[i], i))
        dim = group.column("dim")[0].as_py()
        own = flat.reshape(len(ids), dim)[order]
        padded = np.array([(ids[i] + [-1] * per_vector)[:per_vector] for i in order], np.int64)
        count = np.array([len(ids[i]) for i in order], np.int64)
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([group.column("shard")[0].as_py()], pa.int32()),
                         "vectors": [own.tobytes()], "ids": [np.column_stack([count, padded]).tobytes()],
                         "graph": [Graph(units(own)).flat()]})

    return staged(merged.withColumn("shard", F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int"))
                  .repartitionByRange(shards, "shard").groupBy("dim", "shard").applyInArrow(build, _GRAPHS), "graphs"), shards


_BLOCKS = "dim int, block int, ids binary, vectors binary"


def query_blocks(queries: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``queries(vec_id, embedding)`` in blocks of about ``block_rows``."""
    rows = staged(queries.distinct().withColumn("dim", F.size("embedding")), "queries")
    blocks = -(-rows.count() // block_rows) or 1

    def pack(group: pa.Table) -> pa.Table:
        flat = group.column("embedding").combine_chunks().flatten().to_numpy().astype(np.float32)
        return pa.table({"dim": group.column("dim").slice(0, 1).cast(pa.int32()),
                         "block": group.column("block").slice(0, 1).cast(pa.int32()),
                         "ids": [group.column("vec_id").to_numpy().tobytes()], "vectors": [flat.tobytes()]})

    return (rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)).cast("int"))
            .groupBy("dim", "block").applyInArrow(pack, _BLOCKS))


def nearest(table_: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
            shard_rows: int | None = None, search_list: int = SEARCH_LIST) -> DataFrame:
    """The ``k`` nearest found of all rows for each row that ``queries`` selects:
    ``query_id, rank, vec_id, score`` (cosine in double precision).

    A row isn't its own candidate. Vectors that are null, empty, zero or hold null
    or non-finite components take no part, nor do rows with null ids; vectors of
    different lengths aren't compared. Ties go to the smaller id; repeated rows
    count once; an id with several different queried vectors gets a list for each.
    Extra columns are not carried; an empty table gives an empty result."""
    rows = (table_.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>").alias("embedding"),
                          queries.alias("asked"))
            .where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))))
    graphs, shards = build_graphs(rows.select("vec_id", "embedding"), k + 1, shard_rows)
    blocks = query_blocks(rows.where("asked").select("vec_id", "embedding"))
    # the stated query set meets every shard, block by block
    asked = blocks.select("dim", "block", F.col("ids").alias("query_ids"), F.col("vectors").alias("query_vectors"),
                          F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    pairs = asked.join(graphs, ["dim", "shard"]).select("dim", "block", "query_ids", "query_vectors", "vectors", "ids", "graph")
    arrow = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                dim, block, q_ids, q_vec, vec, ids, graph = (batch.column(c)[i].as_py() for c in range(7))
                own = np.frombuffer(vec, np.float32).reshape(-1, dim)
                names = np.frombuffer(ids, np.int64).reshape(len(own), -1)
                asked_ids, asked_vec = np.frombuffer(q_ids, np.int64), np.frombuffer(q_vec, np.float32).reshape(-1, dim)
                g = Graph.from_flat(units(own), graph)
                wide = own.astype(np.float64)
                norms = np.sqrt((wide * wide).sum(1))
                out = []
                for n, (q_id, q, unit) in enumerate(zip(asked_ids.tolist(), asked_vec.astype(np.float64), units(asked_vec))):
                    found = g.nearest(unit, search_list)
                    score = (wide[found] * q).sum(1) / (norms[found] * np.sqrt((q * q).sum()))
                    best = [(-s, v) for s, x in zip(score.tolist(), found.tolist())
                            for v in names[x, 1:1 + names[x, 0]].tolist() if v != q_id]
                    out += [(block << 32 | n, q_id, v, -s) for s, v in sorted(best)[:k]]
                columns = zip(*out) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)

    best = Window.partitionBy("query", "query_id").orderBy(F.col("score").desc(), "vec_id")
    return (pairs.mapInArrow(search, "query long, query_id long, vec_id long, score double")
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
