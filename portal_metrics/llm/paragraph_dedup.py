"""Operator 4: substring dedup by paragraph MinHash banding.

A paragraph is a line of a text with at least LEAST five-word shingles.  Lines are banded by MinHash, tuned
for the recall at the threshold; colliding lines are joined and verified by exact
Jaccard on their full shingle sets (``minhash``), and linked lines form components.
A passage may also be repeated inside longer, otherwise different lines, or over lines that are wrapped otherwise: there the words
of a text, whatever its line breaks, are cut at content-defined points (a word whose three-word hash is the least within
RADIUS words on either side), so a shared passage is cut alike wherever it stands; equal pieces
of at least PIECE words (by their 128-bit digest) form classes too.  A run of 51 words holds no whole piece in 0.04 % of
cases (random words).  A line with less than a cut in LONG words, as a repeated phrase makes, is a piece itself.
Of each class the part in the least document, and there the first, stays; all others are repeats.

Result, one row per document: doc_id, n_paragraphs, n_repeated (paragraphs and pieces that go),
repeated (``line n`` or the word range ``first-end``, end
exclusive, comma-joined), classes (sorted list of the doc_ids that
keep the classes of the document's repeated or kept parts), so documents that share a passage share an entry.

Defined results: NULL, empty and short texts have no paragraphs and no classes; repeated rows repeat
each other's paragraphs; rows of one doc_id count as one document; rows without an id count as one document for each
text, hold and lose repeats like others, and stand in ``classes`` by the hash of their text, but only where no document with an
id holds the part; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portal_metrics.llm import common as C
from portal_metrics.llm.minhash import keyed, lines, near_classes, signatures

THRESHOLD, ROWS, RECALL = 0.8, 3, 0.99
#: Fewest shingles of a paragraph (10 words) and fewest words of a piece.
LEAST, PIECE = 6, 6
RADIUS = 4
#: Words for a cut at least; a line with fewer cuts is a piece of its own.
LONG = 4 * RADIUS + 2


def _least_within(x: np.ndarray, radius: int) -> np.ndarray:
    """Where a value is less than all others within the radius (the first of equal ones)."""
    n = len(x)
    if not n:
        return np.zeros(0, bool)
    top = np.uint64(np.iinfo(np.uint64).max)
    padded = np.concatenate([np.full(radius, top), x, np.full(radius, top)])
    out = np.ones(n, bool)
    for d in range(1, radius + 1):
        out &= (x < padded[radius - d:radius - d + n]) & (x <= padded[radius + d:radius + d + n])
    return out


def pieces_of(docs: DataFrame) -> DataFrame:
    """(doc_id, known, first, last, id, check): word range and digests of the content-defined pieces of texts."""
    def work(batches):
        for b in batches:
            data, offsets = C.text_bytes(b.column(1), lower=True)
            for i, j in C.slices(offsets):
                own, rows = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                words, per, at, _ = C.word_hashes(own, rows)
                n = len(words)
                if not n:
                    continue
                row = np.repeat(np.arange(len(per) - 1), np.diff(per))
                after = np.concatenate([words, np.zeros(2, np.uint64)])
                three = C.mix(words * C._GRAM[0] + after[1:n + 1] * C._GRAM[1] + after[2:n + 2] * C._GRAM[2])
                # a cut is three words of one text
                cut = _least_within(three, RADIUS) & (np.arange(n) + 3 <= per[1:][row])
                edges = np.union1d(np.flatnonzero(cut), per[:-1][np.diff(per) > 0])
                stops = np.append(edges[1:], n)
                starts, ends, _ = lines(own, rows)
                first, last = np.searchsorted(at, starts), np.searchsorted(at, ends)
                cuts = np.concatenate([[0], np.cumsum(cut)])
                flat = (cuts[last] - cuts[first]) * LONG < (last - first) - LONG + 1
                edges, stops = np.concatenate([edges, first[flat]]), np.concatenate([stops, last[flat]])
                keep = stops - edges >= PIECE
                edges, stops = edges[keep], stops[keep]
                row = row[edges]
                found = []
                for x in (words, C.mix(words)):
                    total = np.zeros(n + 1, np.uint64)
                    np.cumsum(x * _weights(n), out=total[1:])
                    found.append(C.mix((total[stops] - total[edges]) * _inverse(n)[edges] + (stops - edges).astype(np.uint64)).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i).take(pa.array(row)), b.column(2).slice(i).take(pa.array(row)), pa.array((edges - per[row]).astype(np.int32)),
                     pa.array((stops - per[row]).astype(np.int32)), pa.array(found[0]), pa.array(found[1])], ["doc_id", "known", "first", "last", "id", "check"])
    return docs.mapInArrow(work, "doc_id long, known boolean, first int, last int, id long, check long")


_W = C._Powers(0xD1342543DE82EF95)


def _weights(n: int) -> np.ndarray:
    return _W.get(n + 1)[0][:n]


def _inverse(n: int) -> np.ndarray:
    return _W.get(n + 1)[1][:n + 1]


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
            rows: int = ROWS, recall: float = RECALL, least: int = LEAST, k: int = C.SHINGLE) -> tuple[DataFrame, DataFrame]:
    """(parts, lines): parts (doc_id, known, unit or null, first, last, keeper, keeps) of every class of two or more; lines (doc_id, n).

    A document without an id goes by a hash of its text (known: false).
    """
    docs = keyed(docs, id_col, text_col)
    bands = C.bands_for(threshold, rows, recall)
    signed = C.saved(signatures(docs, lines, rows, bands, least=least, k=k))

    def first_of(part):
        return F.min(F.struct((~F.col("known")).alias("late"), "doc_id", part))

    nodes = C.saved(signed.groupBy("id", "check").agg(first_of("unit").alias("h"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
                    .select("id", "check", "h.late", "h.doc_id", "h.unit", "copies", "bands"))
    near = near_classes(nodes, docs, lines, threshold, k)
    named = nodes.select("id", "late", "doc_id", "unit", "copies").join(near.select("id", "root"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    classes = named.groupBy("root").agg(F.min(F.struct("late", "doc_id", "unit")).alias("keeper"), F.sum("copies").alias("members")).where("members > 1")
    member = named.select("id", "root").join(classes, "root").select("id", "keeper")

    def kept(part):
        return (F.struct((~F.col("known")).alias("late"), "doc_id", part) == F.col("keeper")).alias("keeps")

    line = signed.select("doc_id", "known", "unit", "id").join(member, "id").select("doc_id", "known", "unit", F.col("keeper.doc_id").alias("keeper"), kept("unit"))
    pieces = C.saved(pieces_of(docs))
    shared = (pieces.groupBy("id", "check").agg(first_of("first").alias("keeper"), F.count("*").alias("members")).where("members > 1"))
    piece = pieces.join(shared, ["id", "check"]).select("doc_id", "known", "first", "last", F.col("keeper.doc_id").alias("keeper"), kept("first"))
    none = F.lit(None).cast("int")
    parts = line.select("doc_id", "known", "unit", none.alias("first"), none.alias("last"), "keeper", "keeps").unionByName(
        piece.select("doc_id", "known", none.alias("unit"), "first", "last", "keeper", "keeps"))
    return parts, signed.groupBy("doc_id", "known").agg(F.count("*").alias("n_paragraphs"))


def op4_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_paragraphs, n_repeated, repeated, classes of every document."""
    return paragraph_repeats(C.documents(spark, sf_dir))


def paragraph_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bounds) -> DataFrame:
    """doc_id, n_paragraphs, n_repeated, repeated, classes of every document."""
    parts, counted = repeats(docs, id_col, text_col, **bounds)
    name = F.when(F.col("unit").isNotNull(), F.concat(F.lit("line "), "unit")).otherwise(F.concat_ws("-", "first", "last"))
    key = ["doc_id", "known"]
    gone = parts.groupBy(*key).agg(
        F.count(F.when(~F.col("keeps"), 1)).alias("n_repeated"),
        F.array_join(F.array_sort(F.collect_set(F.when(~F.col("keeps"), name))), ",").alias("repeated"),
        F.array_sort(F.collect_set("keeper")).alias("classes"))
    return (keyed(docs, id_col, text_col).select(*key).distinct().join(counted, key, "left").join(gone, key, "left")
            .select(F.when(F.col("known"), F.col("doc_id")).alias("doc_id"), F.coalesce("n_paragraphs", F.lit(0)).alias("n_paragraphs"),
                    F.coalesce("n_repeated", F.lit(0)).alias("n_repeated"), F.coalesce("repeated", F.lit("")).alias("repeated"),
                    F.coalesce("classes", F.array().cast("array<long>")).alias("classes")))
