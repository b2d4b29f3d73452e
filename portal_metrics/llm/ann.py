"""Operator 2: nearest neighbours by a block matrix join of int8 tiles.

Query blocks of bounded size meet the candidates block by block.  A tile's int8 product
(exact, in float32 arithmetic on small integers) approximates the inner products;
with x = s*q + r, the error of <x, y> is at most |r_x| |y| + |s_x q_x| |r_y|, from the
measured residual norms.  A pair whose upper bound is under the query's k-th best
lower bound (or k-th best exact score so far) cannot be among the k nearest; all other
pairs are recomputed in double precision, summed in order of the components, and merged
into the query's list of k best.  The result is therefore exact.

Defined results: vectors that are NULL, zero, or hold NULL or non-finite components, and rows without
an id, take no part; a pair of vectors of different length is no pair; rows that repeat both id and
vector are one row; a query never meets a row of its own id; ties go to the smaller id;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portal_metrics.llm import common as C

TOP = 20
#: Queries of a block (bounds what is sent to the executors) and candidates of a task.
QUERY_BLOCK, CANDIDATES = 8192, 16_384
#: Rows and columns of a tile.
TILE = 2048


def _quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 values as float32, scales, norms of the rounded vectors, norms of the residuals)."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None])
    rounded = q * scale[:, None]
    return q.astype(np.float32), scale, np.linalg.norm(rounded, axis=1), np.linalg.norm(x - rounded, axis=1)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of int8 rows; 1,024 components at a time stay exact in float32."""
    out = np.zeros((len(a), len(b)))
    for d in range(0, a.shape[1], 1024):
        out += a[:, d:d + 1024] @ b[:, d:d + 1024].T
    return out


class Queries:
    """A block of queries of one length, with the k best pairs seen so far in the task."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, top: int):
        self.ids, self.x, self.top = ids, x, top
        self.q, self.scale, self.rounded, self.residual = _quantised(x)
        self.norm = self.rounded + self.residual

    def start(self) -> None:
        self.best_score = np.full((len(self.ids), self.top), -np.inf)
        self.best_id = np.full((len(self.ids), self.top), np.iinfo(np.int64).max)

    def meet(self, ids: np.ndarray, x: np.ndarray) -> None:
        q, scale, rounded, residual = _quantised(x)
        for s in range(0, len(self.ids), TILE):
            for c in range(0, len(ids), TILE):
                self._tile(slice(s, s + TILE), ids[c:c + TILE], x[c:c + TILE], q[c:c + TILE], scale[c:c + TILE], rounded[c:c + TILE], residual[c:c + TILE])

    def _tile(self, own, ids, x, q, scale, rounded, residual) -> None:
        near = _product(self.q[own], q) * self.scale[own][:, None] * scale[None, :]
        error = (self.residual[own][:, None] * (rounded + residual)[None, :] + self.rounded[own][:, None] * residual[None, :]) * (1 + 1e-9) + 1e-12
        near[self.ids[own][:, None] == ids[None, :]] = -np.inf
        floor = self.best_score[own][:, -1]
        if len(ids) > self.top:
            lower = near - error
            floor = np.maximum(floor, np.partition(lower, len(ids) - self.top, axis=1)[:, len(ids) - self.top])
        row, col = np.nonzero((near + error >= floor[:, None]) & np.isfinite(near))
        scores = np.empty(len(row))
        for i in range(0, len(row), 16_384):
            pairs = self.x[own][row[i:i + 16_384]] * x[col[i:i + 16_384]]
            scores[i:i + 16_384] = np.add.accumulate(pairs, axis=1)[:, -1]
        # merge: a query's survivors and its k best, ordered by score, then id
        base = own.start or 0
        n = len(self.ids[own])
        row = np.concatenate([row, np.repeat(np.arange(n), self.top)])
        scores = np.concatenate([scores, self.best_score[own].ravel()])
        found = np.concatenate([ids[col], self.best_id[own].ravel()])
        order = np.lexsort((found, -scores, row))
        row, scores, found = row[order], scores[order], found[order]
        rank = np.arange(len(row)) - np.searchsorted(row, np.arange(n))[row]
        keep = rank < self.top
        self.best_score[base + row[keep], rank[keep]] = scores[keep]
        self.best_id[base + row[keep], rank[keep]] = found[keep]


def _vectors(b: pa.RecordBatch) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """length -> (ids, vectors) of a batch."""
    ids, lists = np.asarray(b.column(0)), b.column(1)
    n = lists.value_lengths().to_numpy()
    flat = np.asarray(lists.flatten(), np.float64)
    at = np.concatenate([[0], np.cumsum(n)])
    return {int(d): (ids[n == d], flat[np.repeat(n == d, n)].reshape(-1, int(d))) for d in np.unique(n)} if len(flat) == at[-1] else {}


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col("v")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("id").isNotNull() & v.isNotNull()).where(sound).distinct())


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, top: int = TOP) -> DataFrame:
    """query_id, rank, id, score: the ``top`` largest inner products of the rows whose id ``every`` divides.

    Usable rows are written once.  Blocks of queries run one after another: a block is broadcast, its result written, the
    broadcast dropped, so the driver holds one block however many there are.
    """
    rows = C.saved(usable(vectors, id_col, vector_col).repartition(max(1, math.ceil(vectors.count() / CANDIDATES)), "id"))
    queries = rows.where(F.col("id") % every == 0)
    blocks = math.ceil(queries.count() / QUERY_BLOCK)
    schema = "query_id long, id long, score double"
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id")).alias("rank")
    out = vectors.sparkSession.createDataFrame([], schema).select("query_id", F.lit(0).alias("rank"), "id", "score")
    for k in range(blocks):
        own = defaultdict(list)
        for r in queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k).collect():  # about QUERY_BLOCK rows
            own[len(r["v"])].append((r["id"], r["v"]))
        block = vectors.sparkSession.sparkContext.broadcast(
            {d: Queries(np.array([i for i, _ in x], np.int64), np.array([v for _, v in x], np.float64), top) for d, x in own.items()})

        def work(batches, block=block):
            asked_of = block.value
            for q in asked_of.values():
                q.start()
            for b in batches:
                for d, (ids, x) in _vectors(b).items():
                    if d in asked_of:
                        asked_of[d].meet(ids, x)
            for q in asked_of.values():
                has = np.isfinite(q.best_score)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q.ids, has.sum(axis=1))), pa.array(q.best_id[has]), pa.array(q.best_score[has])],
                                                 ["query_id", "id", "score"])

        found = rows.mapInArrow(work, schema).select("query_id", best, "id", "score").where(F.col("rank") <= top)
        out = out.union(C.saved(found))
        block.unpersist()
    return out


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: 20 nearest rows of every row whose vec_id 20 divides."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumnRenamed("id", "vec_id")


#: Brute force over all pairs of query and row.
OP2_SQL = """
WITH v AS (SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 20
"""
