"""Nearest neighbours by largest inner product, with collision-counting hashing.

Vectors are lifted by one component so that all have the same length; then the largest inner product
is the smallest distance. Each of ``PROJECTIONS`` random lines gives one sorted array of projections.
A query's window on a line is centred on its own projection; windows grow together, step by step, and
a vector collides on each line whose window holds its place. Vectors that collide on ``THRESHOLD`` of the
lines are verified by their exact inner product; windows grow until these are a share of the vectors, ``SHARE`` up
to 64 dimensions and more in proportion beyond, where projections tell less apart.

Vectors are cut into blocks of ``BLOCK_ROWS``, queries as it suits the number of tasks; each pair of blocks is one
group. What is found depends on the blocks of vectors only. No more vectors than wanted neighbours and one are kept
of those that are equal, since ties go to the smaller id.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part,
nor do rows without vec_id; repeated rows count once; vectors of different lengths are not compared;
of several vectors of one query id the smallest asks. An empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import staged

PROJECTIONS = 128
THRESHOLD = 0.85
SHARE = 0.15
SHARE_DIMENSIONS = 64
STEP = 1.12  # by which windows grow
BLOCK_ROWS = 16_384  # vectors of a block, about; as many queries at most
FEWEST_QUERIES = 256  # of a block
TRIALS = 9  # vectors of a block that tell where windows begin
SEED = 7


class CollisionIndex:
    """Sorted projections of the vectors of a block."""

    def __init__(self, vectors: np.ndarray, wanted: int, seed: int = SEED):
        self.vectors = vectors
        n, d = vectors.shape
        self.wanted = wanted + int(min(1.0, SHARE * max(1.0, d / SHARE_DIMENSIONS)) * n)
        norms = np.linalg.norm(vectors, axis=1)
        self.longest = norms.max()
        lift = np.sqrt(np.maximum(self.longest**2 - norms**2, 0))
        self.lines = np.random.default_rng(seed).standard_normal((d + 1, PROJECTIONS))
        places = np.c_[vectors, lift] @ self.lines
        order = np.argsort(places, axis=0, kind="stable").T
        # the place of each vector in the array of each line
        self.ranks = np.empty((PROJECTIONS, n), np.uint16 if n < 1 << 16 else np.uint32)
        np.put_along_axis(self.ranks, order, np.arange(n, dtype=self.ranks.dtype)[None, :], axis=1)
        # the arrays of all lines in one, each moved out of the way of the others
        self.gap = 4 * (np.abs(places).max() + self.longest * np.abs(self.lines).sum(axis=0).max() + 1)
        self.sorted = (np.sort(places, axis=0).T + self.gap * np.arange(PROJECTIONS)[:, None]).ravel()
        self.first = n * np.arange(PROJECTIONS)
        self.reach = self.gap / 4
        self.begin = self.longest / STEP**40
        trials = vectors[:: max(1, n // TRIALS)]
        self.begin = float(np.median([self._grown(q)[1] for q in trials])) / STEP

    def _grown(self, query: np.ndarray) -> tuple[np.ndarray, float]:
        """Positions of vectors that collide on enough lines, and how far windows reached for it."""
        n, norm = len(self.vectors), np.linalg.norm(query)
        if n <= self.wanted or not norm:
            return np.arange(n), self.reach
        place = (query * (self.longest / norm)) @ self.lines[:-1] + self.gap * np.arange(PROJECTIONS)
        needed, radius, kind = int(np.ceil(THRESHOLD * PROJECTIONS)), self.begin, self.ranks.dtype
        while True:
            reach = min(radius, self.reach)
            low = np.searchsorted(self.sorted, place - reach, side="left") - self.first
            width = np.searchsorted(self.sorted, place + reach, side="right") - self.first - low
            # unsigned, so that places below a window wrap around to beyond it
            inside = (self.ranks - low.astype(kind)[:, None]) < width.astype(kind)[:, None]
            found = np.flatnonzero(inside.sum(axis=0, dtype=np.uint16) >= needed)
            if len(found) >= self.wanted or reach == self.reach:
                return found, radius
            radius *= STEP

    def nearest(self, query: np.ndarray, k: int, ids: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and inner products of the k nearest vectors found, without those with the query's own id."""
        found = self._grown(query)[0]
        found = found[ids[found] != own]
        scores = self.vectors[found] @ query
        best = np.lexsort((ids[found], -scores))[:k]
        return ids[found][best], scores[best]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _cell(k: int):
    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(vectors) or not len(queries):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        order = np.argsort(vectors["vec_id"].to_numpy(), kind="stable")
        ids = vectors["vec_id"].to_numpy()[order]
        index = CollisionIndex(_matrix(vectors["embedding"])[order], k + 1)
        found = [(q, *index.nearest(x, k, ids, q)) for q, x in zip(queries["query_id"].to_pylist(), _matrix(queries["embedding"]), strict=True)]
        return pa.table({
            "query_id": np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64),
            "vec_id": np.concatenate([f[1] for f in found]).astype(np.int64),
            "score": np.concatenate([f[2] for f in found]),
        })

    return search


def usable(vectors: DataFrame) -> DataFrame:
    """Distinct ``(vec_id, embedding)`` that take part in a search."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    named = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(fine & some)
    return named.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").distinct()


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest of ``vectors`` found for each of ``queries``.

    Both have vec_id and embedding; a query's own id is left out of its answer.
    """
    spark = vectors.sparkSession
    equal = Window.partitionBy("embedding").orderBy("vec_id")
    kept = usable(vectors).withColumn("n", F.row_number().over(equal)).where(F.col("n") <= k + 1).drop("n")
    kept = staged(kept.withColumn("d", F.size("embedding")), "vectors")
    asked = usable(queries).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("embedding").alias("embedding"))
    asked = staged(asked.withColumn("d", F.size("embedding")), "queries")
    n_vectors, n_queries = kept.count(), asked.count()
    blocks = max(1, -(-n_vectors // BLOCK_ROWS))
    # as many groups as there are tasks, unless queries would be too few for the sorting of a block
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    query_blocks = max(1, -(-n_queries // BLOCK_ROWS), min(-(-tasks // blocks), n_queries // FEWEST_QUERIES))

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        block = F.pmod(F.xxhash64("embedding"), F.lit(n_own)).cast("int").alias(own)
        return df.select("*", block, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other))

    left = dealt(kept, "block", blocks, "asking", query_blocks).groupBy("d", "block", "asking")
    right = dealt(asked, "asking", query_blocks, "block", blocks).groupBy("d", "block", "asking")
    found = left.cogroup(right).applyInArrow(_cell(k), "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op6(vectors: DataFrame) -> DataFrame:
    """The 20 nearest of all vectors for each whose id is divisible by 20."""
    return nearest_neighbours(vectors, vectors.where("vec_id % 20 = 0"), 20)
