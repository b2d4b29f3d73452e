"""Operator 12: ranked lexical search by hashed max-sketches.

A batch of queries (a block of items of bounded size) fixes a vocabulary.  One pass over the documents counts, per
task and then by an aggregation, the documents and terms in all and the documents of each term; the weights
follow.  A second pass folds each document's impacts (weight times saturated frequency of each term) into a sketch of
``width`` coordinates, the maximum of the impacts that hash to each.  The sum of a query's coordinates bounds its
score from above, so all bounds of a batch are one matrix product of the sketches and the queries' coordinate counts.
Documents are then scored exactly in descending order of their bounds, query by query, until the bound falls
below the query's k-th best exact score.  Tasks return their best k of each query; they are merged in two
levels (groups of tasks, then all), so no group grows with the corpus as a whole.

All scores are sums of 64-bit integers; bounds are sums of integers in doubles, exact below 2**53, which is far over any
score (a weight is under 32,000 and a frequency factor at most 10**6).  Terms are named by two 64-bit hashes.

Defined results: NULL and empty texts, and texts without terms, have no terms and are in no ranking nor in N;
an item without terms has no rows; equal scores are ordered by doc_id, NULL ids last, rows of one id in any order; each
row of ``items`` is a query of its own, so repeated items repeat their rankings; empty tables give an empty table;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portal_metrics.llm import common as C

K = 50
#: Coordinates of a sketch; items and terms of a block; rows sketched at a time; documents of an item scored at a time.
WIDTH, BLOCK_ITEMS, BLOCK_TERMS, ROWS, ROUND = 1024, 1024, 200_000, 1024, 64
#: Lookups of an exact scoring at a time; tasks whose rankings are merged together first.
LOOKUPS, FAN_IN = 2 << 20, 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LAST = np.iinfo(np.int64).max


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each term of each row, and the terms' per-row offsets.  Terms are runs of ASCII letters and digits and of
    non-ASCII characters; only A-Z are lower-cased."""
    data = _LOWER[data]
    starts, ends, per = C.word_spans(data, offsets)
    out = []
    for base in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        h, down = C.prefix_hash(data, base)
        out.append(C.mix((h[ends] - h[starts]) * down[starts] + (ends - starts).astype(np.uint64)))
    return out[0], out[1], per


class Block:
    """Queries of a batch: the vocabulary and each item's distinct terms as numbers in it."""

    def __init__(self, rows: list):
        self.ids = [r["item_id"] for r in rows]
        both = np.unique(np.array([x for r in rows for x in zip(r["h1"], r["h2"])], np.int64).reshape(-1, 2), axis=0).astype(np.uint64)
        order = np.argsort(both[:, 0], kind="stable")
        self.h1, self.h2 = both[order, 0], both[order, 1]
        if len(np.unique(self.h1)) < len(self.h1):
            raise ValueError("two terms of the items share a 64-bit hash")
        self.per = np.concatenate([[0], np.cumsum([len(r["h1"]) for r in rows])]).astype(np.int64)
        own = np.array([x for r in rows for x in r["h1"]], np.int64).astype(np.uint64)
        self.terms = np.searchsorted(self.h1, own)
        self.size = len(self.h1)

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms in all of each row; sorted (row * vocabulary + term) of the terms that some item holds; their frequencies."""
        h1, h2, per = terms(data, offsets)
        n = np.diff(per)
        if not self.size or not len(h1):
            return n, np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.h1, h1), self.size - 1)
        hit = np.flatnonzero((self.h1[at] == h1) & (self.h2[at] == h2))
        row = np.searchsorted(per, hit, side="right") - 1
        keys, tf = np.unique(row * self.size + at[hit], return_counts=True)
        return n, keys, tf.astype(np.int64)


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, h1, h2, n): the distinct terms of each item that has any."""
    def work(batches):
        for b in batches:
            data, offsets = C.text_bytes(b.column(1))
            h1, h2, per = terms(data, offsets)
            pairs = [np.unique(np.stack([h1[i:j], h2[i:j]], 1), axis=0).astype(np.int64) for i, j in zip(per, per[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([p[:, 0] for p in pairs], pa.list_(pa.int64())),
                                              pa.array([p[:, 1] for p in pairs], pa.list_(pa.int64())), pa.array([len(p) for p in pairs], pa.int64())],
                                             ["item_id", "h1", "h2", "n"])
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, "item_id long, h1 array<long>, h2 array<long>, n long").where("n > 0")


def blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[Block]:
    """The items as blocks of bounded size, one at a time in the driver."""
    table = C.saved(item_terms(items, id_col, text_col).withColumn("dealt", F.monotonically_increasing_id()))
    total = table.agg(F.count("*").alias("items"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    parts = max(math.ceil(total["items"] / BLOCK_ITEMS), math.ceil(total["terms"] / BLOCK_TERMS))
    for i in range(parts):
        rows = table.where(F.pmod(F.xxhash64("dealt"), F.lit(parts)) == i).collect()
        if rows:
            yield Block(rows)


def _chunks(b: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = C.text_bytes(b.column(1))
    for i, j in C.slices(offsets):
        for s in range(i, j, ROWS):
            e = min(s + ROWS, j)
            yield s, e, data[offsets[s]:offsets[e]], offsets[s:e + 1] - offsets[s]


def statistics(rows: DataFrame, shared) -> tuple[int, int, np.ndarray]:
    """N, L and the documents of each term of the block.  rows: (doc_id, text); counted in each task before the shuffle."""
    def work(batches):
        block = shared.value
        df, docs, words = np.zeros(block.size, np.int64), 0, 0
        for b in batches:
            for _, _, data, offsets in _chunks(b):
                n, keys, _ = block.postings(data, offsets)
                docs += int((n > 0).sum())
                words += int(n.sum())
                df += np.bincount(keys % max(block.size, 1), minlength=block.size)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, [-1, -2])), pa.array(np.append(df[some], [docs, words]))], ["term", "n"])

    found = {r["term"]: r["n"] for r in rows.mapInArrow(work, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    df = np.zeros(shared.value.size, np.int64)
    for t, n in found.items():
        if t >= 0:
            df[t] = n
    return found.get(-1, 0), found.get(-2, 0), df


class Search:
    """The best k documents of each item of a block, among those seen so far."""

    def __init__(self, block: Block, weights: np.ndarray, n_docs: int, n_terms: int, k: int, width: int):
        self.block, self.weights, self.n_docs, self.n_terms, self.k, self.width = block, weights, n_docs, n_terms, k, width
        items = len(block.ids)
        self.coordinate = (C.mix(block.h1) % np.uint64(width)).astype(np.int64)
        # how many of an item's terms fall on each coordinate
        self.queries = np.zeros((width, items))
        np.add.at(self.queries, (self.coordinate[block.terms], np.repeat(np.arange(items), np.diff(block.per))), 1)
        self.score = np.zeros((items, k), np.int64)
        self.doc = np.full((items, k), _LAST)

    def impacts(self, n: np.ndarray, keys: np.ndarray, tf: np.ndarray) -> np.ndarray:
        m = np.array([50 + 50 * x * self.n_docs // self.n_terms for x in n.tolist()], np.int64)
        return self.weights[keys % self.block.size] * ((10 ** 9 * tf) // (1000 * tf + 20 * m[keys // self.block.size]))

    def sketches(self, rows: int, keys: np.ndarray, impact: np.ndarray) -> np.ndarray:
        """(rows, width): the largest impact on each coordinate."""
        out = np.zeros(rows * self.width)
        np.maximum.at(out, keys // self.block.size * self.width + self.coordinate[keys % self.block.size], impact.astype(np.float64))
        return out.reshape(rows, self.width)

    def exact(self, row: np.ndarray, item: np.ndarray, keys: np.ndarray, impact: np.ndarray) -> np.ndarray:
        """Scores of (row, item) pairs, some lookups at a time."""
        per, size = self.block.per, self.block.size
        out = np.zeros(len(row), np.int64)
        n = per[item + 1] - per[item]
        cuts = np.concatenate([[0], np.cumsum(n)])
        s = 0
        while s < len(row):
            e = max(s + 1, int(np.searchsorted(cuts, cuts[s] + LOOKUPS, side="right")) - 1)
            own = np.repeat(np.arange(s, e), n[s:e])
            term = self.block.terms[np.arange(cuts[s], cuts[e]) - cuts[own] + per[item[own]]]
            want = row[own] * size + term
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            got = np.where(keys[at] == want, impact[at], 0)
            out[s:e] = np.add.reduceat(got, cuts[s:e] - cuts[s])
            s = e
        return out

    def add(self, docs: np.ndarray, n: np.ndarray, keys: np.ndarray, tf: np.ndarray) -> None:
        """Take documents in: bounds of all, exact scores in descending order of the bounds while they can still enter."""
        if not len(keys):
            return
        impact = self.impacts(n, keys, tf)
        bounds = self.sketches(len(docs), keys, impact) @ self.queries
        take = min(ROUND, len(docs))
        while True:
            least, worst = self.score[:, -1], self.doc[:, -1]
            open_ = (bounds > 0) & ((bounds > least) | ((bounds == least) & (docs[:, None] < worst)))
            items = np.flatnonzero(open_.any(axis=0))
            if not len(items):
                return
            left = np.where(open_[:, items], bounds[:, items], -1.0)
            top = np.argpartition(left, len(docs) - take, axis=0)[len(docs) - take:] if take < len(docs) else np.tile(np.arange(len(docs))[:, None], len(items))
            there = np.take_along_axis(left, top, axis=0) > 0
            r, c = top[there], np.broadcast_to(items, top.shape)[there]
            score = np.zeros(top.shape, np.int64)
            score[there] = self.exact(r, c, keys, impact)
            bounds[r, c] = -1.0
            bounds[:, items] = np.where(open_[:, items], bounds[:, items], -1.0)
            all_score = np.concatenate([self.score[items], score.T], axis=1)
            all_doc = np.concatenate([self.doc[items], np.where(score > 0, docs[top], _LAST).T], axis=1)
            order = np.argsort(all_doc, axis=1, kind="stable")
            order = np.take_along_axis(order, np.argsort(-np.take_along_axis(all_score, order, 1), axis=1, kind="stable"), 1)[:, :self.k]
            self.score[items], self.doc[items] = np.take_along_axis(all_score, order, 1), np.take_along_axis(all_doc, order, 1)


def ranked(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
           item_text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above 0 of each item."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for no, block in enumerate(blocks(items, item_id_col, item_text_col)):
        shared = spark.sparkContext.broadcast(block)
        n_docs, n_terms, df = statistics(rows, shared)
        # (2N + 2) / (2 df + 1) is above 1, so weights are not negative
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        state = spark.sparkContext.broadcast((weights, n_docs, n_terms))

        def work(batches, shared=shared, state=state):
            search = Search(shared.value, *state.value, k, width)
            for b in batches:
                ids = np.asarray(b.column(0).fill_null(_LAST))
                for s, e, data, offsets in _chunks(b):
                    search.add(ids[s:e], *search.block.postings(data, offsets))
            item, place = np.nonzero(search.score)
            doc = search.doc[item, place]
            yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int64)), pa.array([search.block.ids[i] for i in item.tolist()], pa.int64()),
                                              pa.array(doc, mask=doc == _LAST), pa.array(search.score[item, place]),
                                              pa.array(np.full(len(item), TaskContext.get().partitionId() // FAN_IN, np.int64))],
                                             ["item", "item_id", "doc_id", "score", "tasks"])

        if n_docs:
            best = rows.mapInArrow(work, "item long, item_id long, doc_id long, score long, tasks long")
            order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
            rank = F.row_number().over(Window.partitionBy("item", "tasks").orderBy(*order))
            best = best.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")
            best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
            out = out.union(C.saved(best.select("item_id", "rank", "doc_id", "score")))
        shared.unpersist()
        state.unpersist()
    return out


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, rank, doc_id, score): the 50 documents of highest score of every benchmark item."""
    return ranked(C.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT r, translate(unnest(w), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM o GROUP BY r, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
i AS (SELECT item_id, row_number() OVER () AS q, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
it AS (SELECT DISTINCT q, item_id, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT q, item_id, unnest(w) AS t FROM i)),
m AS (SELECT r, doc_id, 100 - 50 + ((50 * len(w) * n_docs) // n_terms) AS m FROM d, c WHERE len(w) > 0),
s AS (SELECT it.q, it.item_id, m.r, m.doc_id,
  CAST(sum(CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df.df + 1))) AS BIGINT) * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * m.m))) AS BIGINT) AS score
  FROM it JOIN df USING (term) JOIN tf USING (term) JOIN m ON m.r = tf.r CROSS JOIN c GROUP BY it.q, it.item_id, m.r, m.doc_id),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50
"""
