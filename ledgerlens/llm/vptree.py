"""Nearest neighbours by inner product with vantage-point trees per shard (operator 7).

A further coordinate sqrt(M^2 - |x|^2), M the largest norm, turns the largest
inner product into the smallest Euclidean distance, so the triangle inequality
holds. Rows are dealt into shards of bounded size and queries into blocks of
bounded size; each (shard, block) builds the shard's tree and searches it for
the whole block at once. The side of a node away from the query is skipped when
its boundary is further than ``factor`` times the k-th distance found so far:
factor 1 is exact search, smaller factors prune more.

* Vectors that are null, zero or hold null or non-finite components take no
  part, nor do rows without vec_id. Lengths must agree, else ValueError.
* Rows that share a vec_id count as one, with the smallest of their vectors.
* Ties go to the smaller vec_id: scores are sums in order of the components, the
  same for equal vectors wherever they lie. A query with fewer than k candidates
  gets all. Empty tables give no rows. Columns other than the two are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.words import mix
from ledgerlens.session import cut_lineage

NEIGHBOURS = 20
QUERY_STEP = 20
FACTOR = 1.0
SHARD_ROWS = 8192
BLOCK_ROWS = 4096
LEAF = 96
#: Width of a block of exact scores.
PAIRS = 1 << 17
#: Room for rounding in distances and in scores of the block product.
SLACK = 1e-9


def exact_scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed in order of the components."""
    total = x[:, 0] * y[:, 0]
    for j in range(1, x.shape[1]):
        total += x[:, j] * y[:, j]
    return total


def smallest_of_equal(ids: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Rows without those that have ``most`` rows of the same vector and a smaller id."""
    raw = np.ascontiguousarray(vectors + 0.0)
    keys = raw.view([("", raw.dtype)] * raw.shape[1]).ravel()
    order = np.lexsort([ids, np.unique(keys, return_inverse=True)[1]])
    ranked = keys[order]
    new = np.ones(len(order), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    place = np.arange(len(order))
    return np.sort(order[place - np.maximum.accumulate(np.where(new, place, 0)) < most])


class Tree:
    """Nodes are (vantage row, radius, inner, outer); leaves are arrays of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest_square: float):
        self.ids, self.vectors = ids, vectors
        self.rest = np.sqrt(np.maximum(largest_square - np.einsum("ij,ij->i", vectors, vectors), 0.0))
        self.largest = largest_square
        order = np.argsort(mix(ids.astype(np.uint64)), kind="stable")
        self.root = self.build(order)

    def build(self, rows: np.ndarray):
        if len(rows) <= LEAF:
            return rows
        top, others = rows[0], rows[1:]
        gap = self.vectors[others] - self.vectors[top]
        far = np.sqrt(np.einsum("ij,ij->i", gap, gap) + (self.rest[others] - self.rest[top]) ** 2)
        radius = float(np.median(far))
        inner = far <= radius
        if inner.all():
            inner = far < radius
            if not inner.any():
                return rows
        return top, radius, self.build(others[inner]), self.build(others[~inner])


class Search:
    """The k best of every query of a block."""

    def __init__(self, tree: Tree, ids: np.ndarray, queries: np.ndarray, k: int, factor: float):
        self.tree, self.ids, self.queries, self.k, self.factor = tree, ids, queries, k, factor
        self.square = np.einsum("ij,ij->i", queries, queries)
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        norm = np.sqrt(self.square * max(tree.largest, 1e-300))
        self.room = SLACK * np.maximum(norm, 1e-300)

    def run(self) -> None:
        self.visit(self.tree.root, np.arange(len(self.ids)))

    def reach(self, active: np.ndarray) -> np.ndarray:
        """Distance of the k-th best so far."""
        square = self.square[active] + self.tree.largest - 2 * (self.scores[active, -1] - self.room[active])
        return np.sqrt(np.maximum(square, 0.0))

    def visit(self, node, active: np.ndarray) -> None:
        if not len(active):
            return
        if isinstance(node, np.ndarray):
            self.take(node, active)
            return
        top, radius, inner, outer = node
        self.take(np.array([top]), active)
        tree = self.tree
        gap = self.queries[active] - tree.vectors[top]
        far = np.sqrt(np.einsum("ij,ij->i", gap, gap) + tree.rest[top] ** 2)
        within = far <= radius
        self.visit(inner, active[within])
        self.visit(outer, active[~within])
        near = np.abs(far - radius) * (1 - SLACK) <= self.factor * self.reach(active)
        self.visit(outer, active[within & near])
        self.visit(inner, active[~within & near])

    def take(self, rows: np.ndarray, active: np.ndarray) -> None:
        step = max(1, PAIRS // len(active))
        for i in range(0, len(rows), step):
            part = rows[i : i + step]
            rough = self.queries[active] @ self.tree.vectors[part].T
            good = rough >= (self.scores[active, -1] - self.room[active])[:, None]
            good &= self.tree.ids[part][None, :] != self.ids[active][:, None]
            q, p = np.nonzero(good)
            if len(q):
                self.merge(active[q], part[p])

    def merge(self, q: np.ndarray, rows: np.ndarray) -> None:
        scores = exact_scores(self.queries[q], self.tree.vectors[rows])
        changed = np.unique(q)
        q = np.concatenate([np.repeat(changed, self.k), q])
        scores = np.concatenate([self.scores[changed].ravel(), scores])
        ids = np.concatenate([self.found[changed].ravel(), self.tree.ids[rows]])
        order = np.lexsort([ids, -scores, q])
        first = np.searchsorted(q[order], changed)
        best = order[(first[:, None] + np.arange(self.k)).ravel()]
        self.scores[changed] = scores[best].reshape(-1, self.k)
        self.found[changed] = ids[best].reshape(-1, self.k)


def matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) % max(1, len(column)):
        raise ValueError("vectors differ in length")
    return flat.reshape(len(column), -1)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding, square) of the vectors that take part."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(good)
    rows = rows.where(F.exists("embedding", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumn("square", square)


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = NEIGHBOURS,
    factor: float = FACTOR,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of every row that ``is_query`` selects."""
    rows = cut_lineage(usable(vectors))
    size = F.size("embedding")
    facts = rows.agg(
        F.count(F.lit(1)), F.count_if(is_query), F.max("square"), F.min(size), F.max(size)
    ).first()
    total, queries, largest, shortest, longest = facts
    if shortest != longest:
        raise ValueError("vectors differ in length")
    shards, blocks = max(1, -(-total // shard_rows)), max(1, -(-queries // block_rows))
    largest = float(largest or 0.0)
    number = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.array(*[F.lit(i) for i in range(n)]) if n < 64 else F.sequence(F.lit(0), F.lit(n - 1)))
    asked = rows.where(is_query).select("vec_id", "embedding", number(blocks, 1).alias("block"), every(shards).alias("shard"))
    held = rows.select("vec_id", "embedding", number(shards, 2).alias("shard"), every(blocks).alias("block"))

    def run(points: pa.Table, queries: pa.Table) -> pa.Table:
        ids, vectors = points.column("vec_id").to_numpy(), matrix(points.column("embedding"))
        q_ids, q_vectors = queries.column("vec_id").to_numpy(), matrix(queries.column("embedding"))
        if not len(ids) or not len(q_ids):
            empty = np.zeros(0, np.int64)
            return pa.table({"query_id": empty, "vec_id": empty, "score": np.zeros(0)})
        kept = smallest_of_equal(ids, vectors, k + 1)
        search = Search(Tree(ids[kept], vectors[kept], largest), q_ids, q_vectors, k, factor)
        search.run()
        some = np.isfinite(search.scores)
        return pa.table(
            {"query_id": np.repeat(q_ids, some.sum(1)), "vec_id": search.found[some], "score": search.scores[some]}
        )

    keys = ["shard", "block"]
    found = held.groupBy(*keys).cogroup(asked.groupBy(*keys))
    pairs = found.applyInArrow(run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op7_nearest(spark, sf_dir) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, F.col("vec_id") % QUERY_STEP == 0)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, min(embedding)::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
  GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_reduce(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]), lambda a, b: a + b) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""
