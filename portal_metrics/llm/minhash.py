"""MinHash banding, candidate groups and exact verification, shared by operators 4 and 10.

A *unit* is a document or a line of one.  Units with the same set of shingles
are one node (its id is the 64-bit digest of the set, checked against a second
one); nodes that share a band key are linked to the first node of the bucket,
and the components of these links are the candidate groups.  In a group every
pair is verified on the full shingle sets: the group is dealt into blocks of
about BLOCK nodes and a task compares two blocks by a matrix product, so
neither a pair nor a group is ever a row or a task of its own size.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portal_metrics.llm import common as C
from portal_metrics.llm.graph import components

#: Nodes of a block; a task verifies two blocks.
BLOCK = 256
#: Shingles compared in one matrix product.
COLUMNS = 8192

#: (bytes, row offsets) -> (unit starts, unit ends, units per row as offsets)
Splitter = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def whole_rows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return offsets[:-1], offsets[1:], np.arange(len(offsets))


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lines of each row, without their line breaks."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    per = np.searchsorted(breaks, offsets) + np.arange(len(offsets))
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    ends[per[1:] - 1] = offsets[1:]
    return starts, ends, per


def unit_sets(data: np.ndarray, offsets: np.ndarray, split: Splitter, k: int):
    """(sorted distinct shingles of all units, their per-unit offsets, units per row as offsets)."""
    starts, ends, per = split(data, offsets)
    edges = np.empty(2 * len(starts), np.int64)
    edges[0::2], edges[1::2] = starts, ends
    grams, g = C.text_shingles(data, np.append(edges, len(data)), k)
    n = np.diff(g)[0::2]
    unit = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((grams, unit))
    grams, unit = grams[order], unit[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (unit[1:] != unit[:-1])
    grams, unit = grams[fresh], unit[fresh]
    return grams, np.searchsorted(unit, np.arange(len(starts) + 1)), per


def digests(grams: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set."""
    out = []
    for salt in (1, 2):
        total = np.zeros(len(grams) + 1, np.uint64)
        np.cumsum(C.mix(grams ^ C.seeds(2)[salt - 1]), out=total[1:])
        out.append(C.mix(total[per[1:]] - total[per[:-1]] + np.diff(per).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, known): rows without an id go by a hash of their text and are not ``known``."""
    own = F.col(id_col).cast("long")
    return docs.select(F.coalesce(own, F.xxhash64(text_col)).alias("doc_id"), F.col(text_col).alias("text"), own.isNotNull().alias("known"))


def signatures(docs: DataFrame, split: Splitter, rows: int, bands: int, least: int = 1, k: int = C.SHINGLE) -> DataFrame:
    """(doc_id, known, unit, id, check, n, bands): every unit with at least ``least`` shingles; bands: packed band keys.

    docs: (doc_id, text, known), see ``keyed``.
    """
    def work(batches):
        for b in batches:
            data, offsets = C.text_bytes(b.column(1), lower=True)
            for i, j in C.slices(offsets):
                grams, per, units = unit_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], split, k)
                n = np.diff(per)
                keep = np.flatnonzero(n >= least)
                row = np.repeat(np.arange(j - i), np.diff(units))
                one, two = digests(grams, per)
                keys = C.band_keys(C.minhashes(grams, per, rows * bands)[keep], rows)
                packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * bands), len(keep), [None, pa.py_buffer(np.ascontiguousarray(keys))])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i).take(pa.array(row[keep])), b.column(2).slice(i).take(pa.array(row[keep])),
                     pa.array((np.arange(len(row)) - units[row])[keep].astype(np.int32)), pa.array(one[keep]), pa.array(two[keep]), pa.array(n[keep].astype(np.int32)), packed.cast(pa.binary())],
                    ["doc_id", "known", "unit", "id", "check", "n", "bands"])
    return docs.mapInArrow(work, "doc_id long, known boolean, unit int, id long, check long, n int, bands binary")


def bucket_links(nodes: DataFrame) -> DataFrame:
    """(a, b): every node of a band bucket and the bucket's first node.

    Buckets are first linked inside an Arrow batch, so that a hot key sends one row a
    batch; then across batches, as a stream over sorted rows (nothing is gathered).
    """
    def spread(batches):
        for b in batches:
            if not b.num_rows:
                continue
            ids = np.asarray(b.column(0))
            keys = np.stack([np.frombuffer(x, np.int64) for x in b.column(1).to_pylist()])
            flat, owner = keys.ravel(), np.repeat(ids, keys.shape[1])
            order = np.lexsort((owner, flat))
            flat, owner = flat[order], owner[order]
            first = np.ones(len(flat), bool)
            first[1:] = flat[1:] != flat[:-1]
            hub = owner[np.flatnonzero(first)[np.cumsum(first) - 1]]
            # a linked node travels under a key of its own, only the hub under the bucket's
            key = np.where(first, flat, C.mix(owner.view(np.uint64) ^ flat.view(np.uint64)).view(np.int64))
            keep = first | (hub != owner)
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (key, hub, owner)], ["key", "a", "b"])

    def link(batches):
        key = hub = None
        for b in batches:
            if not b.num_rows:
                continue
            keys, a, other = (np.asarray(b.column(i)) for i in range(3))
            first = np.ones(len(keys), bool)
            first[1:] = keys[1:] != keys[:-1]
            hubs = a[np.flatnonzero(first)[np.cumsum(first) - 1]]
            if keys[0] == key:
                hubs[:np.flatnonzero(np.append(first[1:], True))[0] + 1] = hub
            key, hub = keys[-1], hubs[-1]
            keep = hubs != other
            yield pa.RecordBatch.from_arrays([pa.array(hubs[keep]), pa.array(other[keep])], ["a", "b"])

    rows = nodes.select("id", "bands").mapInArrow(spread, "key long, a long, b long")
    return rows.repartition("key").sortWithinPartitions("key", "a", "b").mapInArrow(link, "a long, b long").distinct()


def similar(sets: list[np.ndarray], threshold: float, split_at: int | None = None) -> np.ndarray:
    """Boolean matrix of the pairs with Jaccard >= threshold; with ``split_at`` only those across it."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    if m == 2:
        both = np.array([[0, len(np.intersect1d(sets[0], sets[1], assume_unique=True))]] * 2)
        both[1] = both[0][::-1]
    else:
        flat, owner = np.concatenate(sets), np.repeat(np.arange(m), sizes)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        new = np.ones(len(flat), bool)
        new[1:] = flat[1:] != flat[:-1]
        column = np.cumsum(new) - 1
        shared = np.bincount(column) > 1
        keep = shared[column]
        column, owner = (np.cumsum(shared) - 1)[column[keep]], owner[keep]
        both = np.zeros((m, m))
        for c in range(0, int(shared.sum()), COLUMNS):
            lo, hi = np.searchsorted(column, [c, c + COLUMNS])
            x = np.zeros((m, min(COLUMNS, column[-1] + 1 - c)), np.float32)
            x[owner[lo:hi], column[lo:hi] - c] = 1
            both += x @ x.T
    union = sizes[:, None] + sizes[None, :] - both
    out = both / np.maximum(union, 1) >= threshold
    np.fill_diagonal(out, False)
    if split_at is not None:
        out[:split_at, :split_at] = False
        out[split_at:, split_at:] = False
    return out


def _roots(pairs: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Least id of each node's component in a small symmetric matrix."""
    label = ids.copy()
    while True:
        best = np.where(pairs, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(label, best)
        if (new == label).all():
            return label
        label = new


def verified(nodes: DataFrame, groups: DataFrame, docs: DataFrame, split: Splitter, threshold: float, k: int = C.SHINGLE) -> DataFrame:
    """(id, links, root): nodes with a verified partner, once a tile.

    nodes: (id, check, doc_id, unit, copies), doc_id and unit one holder of the node; groups: (id, root).
    links counts partners with their copies; the (id, root) of a tile connect its verified pairs.
    """
    sized = groups.join(groups.groupBy("root").agg(F.count("*").alias("size")), "root")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    members = sized.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    wanted = (nodes.join(members.hint("shuffle_hash"), "id").groupBy("doc_id")
              .agg(F.collect_list(F.struct("unit", "id", "check", "copies", "root", "blocks", "block")).alias("wanted")))

    def fetch(batches):
        for b in batches:
            data, offsets = C.text_bytes(b.column(0), lower=True)
            rows = b.column(1).to_pylist()
            for i, j in C.slices(offsets):
                grams, per, units = unit_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], split, k)
                one, two = digests(grams, per)
                out = []
                for r in range(i, j):
                    for w in rows[r]:
                        u = units[r - i] + w["unit"]
                        # a document id may be held by rows of different text: the digest says which one is meant
                        if u < units[r - i + 1] and one[u] == w["id"] and two[u] == w["check"]:
                            out.append((w["root"], w["id"], w["copies"], w["blocks"], w["block"], grams[per[u]:per[u + 1]].tobytes()))
                cols = list(zip(*out, strict=True)) or [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)],
                                                 ["root", "id", "copies", "blocks", "block", "grams"])

    texts = (docs.join(wanted.hint("shuffle_hash"), "doc_id").select("text", "wanted")
             .mapInArrow(fetch, "root long, id long, copies long, blocks int, block int, grams binary"))
    dealt = (texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("root", F.least("block", "other").alias("t1"), F.greatest("block", "other").alias("t2"), "block", "id", "copies", "grams"))

    def verify(batches):
        for t in C.runs(batches, ["root", "t1", "t2"]):
            root, t1, t2, block, id_, copies = (t.column(i).to_numpy() for i in range(6))
            grams = t.column(6)
            cut = np.flatnonzero((root[1:] != root[:-1]) | (t1[1:] != t1[:-1]) | (t2[1:] != t2[:-1])) + 1
            out = []
            for s, e in zip(np.append(0, cut), np.append(cut, len(root)), strict=True):
                own = np.arange(s, e)[np.append(True, id_[s + 1:e] != id_[s:e - 1])]  # a repeated row counts once
                if len(own) < 2:
                    continue
                sets = [np.frombuffer(grams[int(i)].as_py(), np.uint64) for i in own]
                at = int((block[own] == t1[s]).sum()) if t1[s] != t2[s] else None
                pairs = similar(sets, threshold, at)
                has = pairs.any(axis=1)
                links = (pairs * copies[own][None, :]).sum(axis=1)
                out.append((id_[own][has], links[has], _roots(pairs, id_[own])[has]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["id", "links", "root"])

    return (dealt.repartition("root", "t1", "t2").sortWithinPartitions("root", "t1", "t2", "block", "id")
            .mapInArrow(verify, "id long, links long, root long"))


def near_classes(nodes: DataFrame, docs: DataFrame, split: Splitter, threshold: float, k: int = C.SHINGLE) -> DataFrame:
    """(id, root, links) of the nodes that have a verified partner.

    nodes: a saved table (id, check, doc_id, unit, copies, bands).
    """
    groups = C.saved(components(bucket_links(nodes)))
    tiles = C.saved(verified(nodes.drop("bands", "n"), groups, docs, split, threshold, k))
    links = tiles.groupBy("id").agg(F.sum("links").alias("links"))
    return components(tiles.select(F.col("id").alias("a"), F.col("root").alias("b"))).join(links, "id")
