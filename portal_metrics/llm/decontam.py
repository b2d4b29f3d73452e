"""Operator 9: benchmark decontamination by size-partitioned MinHash containment.

Test items are partitioned by size into ranges [h/2, h) of word shingles.  For a
range, every document is read as windows of two adjacent blocks of h shingles,
so that a passage as long as an item of the range lies whole in some window
whatever the document's length, and the Jaccard similarity of window and item
is bounded below by t*q / (2h + q - t*q).  The number of hash functions follows from
that bound and the wanted recall (one row per band).  A document that shares a
band value with an item is verified by exact shingle containment over the whole document.

Items are taken in blocks of bounded size (a stated query set against all rows);
a block is what one pass sends to the executors.

Defined results: a row per (document row, item) with containment >= threshold; NULL or
wordless texts, on either side, match nothing; a text of 1 to 4 words has one
shingle, all its words; repeated document rows are reported each, repeated item rows once per item id and text;
empty tables give no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portal_metrics.llm import common as C

THRESHOLD = 0.8
RECALL = 0.999
#: Bounds of one block of test items: items, and shingles on average.
BLOCK_ITEMS, BLOCK_SHINGLES = 20_000, 2_000_000


def _hashes_for(threshold: float, recall: float) -> int:
    lowest = threshold * 0.5 / (2 + 0.5 * (1 - threshold))
    return C.bands_for(lowest, 1, recall)


def item_shingles(items: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(item_id, grams: packed sorted distinct shingles, n: shingles with repeats), without wordless items."""
    def work(batches):
        for b in batches:
            data, offsets = C.text_bytes(b.column(1), lower=True)
            grams, per = C.text_shingles(data, offsets, k)
            sets = [np.unique(grams[s:e]).tobytes() for s, e in zip(per[:-1], per[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary()), pa.array(np.diff(per), pa.int64())],
                                             ["item_id", "grams", "n"])
    kept = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("t")).where("item_id IS NOT NULL").distinct()
    return kept.mapInArrow(work, "item_id long, grams binary, n long").where("n > 0")


class Block:
    """The signatures of one block of items, as sent to the executors."""

    def __init__(self, rows: list, threshold: float, recall: float):
        self.threshold, self.hashes = threshold, _hashes_for(threshold, recall)
        self.ids = np.array([r.item_id for r in rows], np.int64)
        self.sets = [np.frombuffer(r.grams, np.uint64) for r in rows]
        size = np.array([r.n for r in rows], np.int64)
        classes = 1 + np.floor(np.log2(np.maximum(size, 1))).astype(int)
        self.tables: list[tuple[int, list[tuple[np.ndarray, np.ndarray]]]] = []
        for c in np.unique(classes):
            own = np.flatnonzero(classes == c)
            grams = np.concatenate([self.sets[i] for i in own])
            per = np.concatenate([[0], np.cumsum([len(self.sets[i]) for i in own])])
            signature = C.minhashes(grams, per, self.hashes)
            tables = []
            for h in range(self.hashes):
                order = np.argsort(signature[:, h], kind="stable")
                tables.append((signature[order, h], own[order]))
            self.tables.append((1 << int(c), tables))

    def matches(self, grams: np.ndarray, per: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, item, shingles found) of the rows whose shingles are given."""
        found: set[tuple[int, int]] = set()
        n = np.diff(per)
        windows = []
        for half, tables in self.tables:
            blocks = -(-n // half)
            first = np.concatenate([[0], np.cumsum(blocks)])
            row = np.repeat(np.arange(len(n)), blocks)
            starts = per[row] + (np.arange(first[-1]) - first[row]) * half
            last = np.zeros(len(row), bool)
            last[first[1:][blocks > 0] - 1] = True
            windows.append((starts, row, last, tables))
        if not len(grams):
            return []
        for h, a in enumerate(C.seeds(self.hashes)):
            x = grams * a
            for starts, row, last, tables in windows:
                least = np.minimum.reduceat(x, starts)
                pair = np.minimum(least, np.append(least[1:], least[-1]))
                pair[last] = least[last]
                values, items = tables[h]
                lo = np.searchsorted(values, pair, side="left")
                hit = np.flatnonzero(values[np.minimum(lo, len(values) - 1)] == pair)
                for i, s, e in zip(row[hit], lo[hit], np.searchsorted(values, pair[hit], side="right"), strict=True):
                    found.update((int(i), int(j)) for j in items[s:e])
        out, at, own = [], -1, None
        for i, j in sorted(found):
            if i != at:
                at, own = i, np.unique(grams[per[i]:per[i + 1]])
            item = self.sets[j]
            pos = np.minimum(np.searchsorted(own, item), len(own) - 1)
            both = int((own[pos] == item).sum())
            if both / len(item) >= self.threshold:
                out.append((i, j, both))
        return out


def blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", threshold: float = THRESHOLD,
           recall: float = RECALL, k: int = C.SHINGLE) -> list:
    """The items as broadcast blocks of bounded size."""
    spark = items.sparkSession
    table = C.saved(item_shingles(items, id_col, text_col, k))
    total = table.agg(F.count("*").alias("items"), F.coalesce(F.sum("n"), F.lit(0)).alias("grams")).first()
    parts = max(math.ceil(total["items"] / BLOCK_ITEMS), math.ceil(total["grams"] / BLOCK_SHINGLES))
    out = []
    for i in range(parts):
        rows = table.where(F.pmod(F.xxhash64("item_id", "grams"), F.lit(parts)) == i).collect()
        if rows:
            out.append(spark.sparkContext.broadcast(Block(rows, threshold, recall)))
    return out


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD,
               recall: float = RECALL, k: int = C.SHINGLE) -> DataFrame:
    """(doc id, item_id, n_item, n_found, containment) of the documents that contain an item."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, n_item long, n_found long, containment double"
    out = None
    for shared in blocks(items, item_id_col, item_text_col, threshold, recall, k):
        def work(batches, shared=shared):
            block = shared.value
            for b in batches:
                data, offsets = C.text_bytes(b.column(1), lower=True)
                ids, found = [], []
                for i, j in C.slices(offsets):
                    grams, per = C.text_shingles(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k)
                    m = block.matches(grams, per)
                    ids += [i + x[0] for x in m]
                    found += m
                items_ = [x[1] for x in found]
                n = np.array([len(block.sets[x]) for x in items_], np.int64)
                both = np.array([x[2] for x in found], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(ids, pa.int64())), pa.array(block.ids[items_] if items_ else [], pa.int64()),
                     pa.array(n), pa.array(both), pa.array(both / np.maximum(n, 1))],
                    ["doc_id", "item_id", "n_item", "n_found", "containment"])
        part = rows.mapInArrow(work, schema)
        out = part if out is None else out.union(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", threshold: float = THRESHOLD, recall: float = RECALL,
                  k: int = C.SHINGLE) -> DataFrame:
    """``docs`` without the rows that contain a test item: a filter inside the scan, no shuffle."""
    for shared in blocks(items, item_id_col, item_text_col, threshold, recall, k):
        def work(batches, shared=shared):
            for b in batches:
                data, offsets = C.text_bytes(b.column(b.schema.get_field_index(text_col)), lower=True)
                keep = np.ones(b.num_rows, bool)
                for i, j in C.slices(offsets):
                    grams, per = C.text_shingles(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k)
                    keep[[i + x[0] for x in shared.value.matches(grams, per)]] = False
                yield b.filter(pa.array(keep))
        docs = docs.mapInArrow(work, docs.schema)
    return docs


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, n_item, n_found, containment): every document that holds 80 % of a benchmark item's shingles."""
    return find_leaks(C.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: The same containment by exact set comparison of every document and item (no MinHash).
OP9_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(lower(text), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM documents),
i AS (SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
dg AS (SELECT DISTINCT r, doc_id, g FROM (SELECT r, doc_id, unnest(CASE WHEN len(w) >= 5
  THEN list_transform(range(1, len(w) - 3), lambda p: array_to_string(w[p:p + 4], ' ')) ELSE [array_to_string(w, ' ')] END) AS g FROM d WHERE len(w) > 0)),
ig AS (SELECT DISTINCT item_id, g FROM (SELECT item_id, unnest(CASE WHEN len(w) >= 5
  THEN list_transform(range(1, len(w) - 3), lambda p: array_to_string(w[p:p + 4], ' ')) ELSE [array_to_string(w, ' ')] END) AS g FROM i WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS n_item FROM ig GROUP BY item_id)
SELECT dg.doc_id, ig.item_id, n.n_item, count(*) AS n_found, count(*) / n.n_item AS containment
FROM dg JOIN ig USING (g) JOIN n ON n.item_id = ig.item_id
GROUP BY dg.r, dg.doc_id, ig.item_id, n.n_item HAVING count(*) / n.n_item >= 0.8
"""
