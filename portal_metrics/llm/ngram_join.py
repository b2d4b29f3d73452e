"""Operator 10: n-gram Jaccard join by MinHash banding.

Documents are sets of five-word shingles.  Bands and rows are chosen for a target
recall at the threshold, rows are shuffled on band hashes, and pairs are verified
on the full shingle sets (see ``minhash``).  Documents with the same set are one
node with a number of copies, so copies are never expanded into pairs.

Result, one row per document row: doc_id, class_id (least doc_id of the documents
connected by links, itself included), n_links (documents with Jaccard >= threshold,
copies included, itself excluded).

Defined results: a document of 1 to 4 words has one shingle, all its words; a NULL, empty
or wordless text has no shingles, no links and its own class; repeated rows are copies of
each other; rows without an id are linked and counted like others, and their class_id is NULL only if no row of their
class has an id; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portal_metrics.llm import common as C
from portal_metrics.llm.minhash import keyed, near_classes, signatures, whole_rows

THRESHOLD = 0.8
ROWS = 5
RECALL = 0.9995


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    rows: int = ROWS, recall: float = RECALL, k: int = C.SHINGLE) -> DataFrame:
    """(doc_id, class_id, n_links) of every row of ``docs``."""
    docs = keyed(docs, id_col, text_col)
    bands = C.bands_for(threshold, rows, recall)
    signed = C.saved(signatures(docs, whole_rows, rows, bands, least=0, k=k))
    # one node per distinct set: copies are counted map-side
    nodes = C.saved(signed.where("n > 0").groupBy("id", "check")
                    .agg(F.min("doc_id").alias("doc_id"), F.min(F.when(F.col("known"), F.col("doc_id"))).alias("least"), F.first("unit").alias("unit"), F.count("*").alias("copies"), F.first("bands").alias("bands")))
    near = near_classes(nodes, docs, whole_rows, threshold, k)
    named = nodes.select("id", "least", "copies").join(near, "id", "left").withColumn("root", F.coalesce("root", "id"))
    classes = named.join(named.groupBy("root").agg(F.min("least").alias("class_id")), "root")
    classes = classes.select("id", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    own = F.when(F.col("known"), F.col("doc_id")).alias("doc_id")
    return signed.select(own, F.when(F.col("n") > 0, F.col("id")).alias("id")).join(classes, "id", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_per_class(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is its class's.  Ids name rows: see ``first_rows`` where they repeat or are NULL."""
    first = classes.where("doc_id = class_id").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(first.hint("shuffle_hash"), id_col, "left_semi").select(*docs.columns)


def first_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bounds) -> DataFrame:
    """One row of each class of ``docs``: of least id (NULL last), whatever ids repeat; rows without words are classes of their own."""
    key = "_row"
    while key in docs.columns:
        key += "_"
    rows = C.saved(docs.withColumn(key, F.monotonically_increasing_id()))
    classes = C.saved(jaccard_classes(rows, key, text_col, **bounds).select(F.col("doc_id").alias(key), "class_id"))
    named = classes.join(rows.select(key, F.col(id_col).alias("id")), key)
    first = named.groupBy("class_id").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", F.col(key).alias("row"))).alias("h")).select("h.row")
    return one_per_class(rows, first.select(F.col("row").alias("doc_id"), F.col("row").alias("class_id")), key).select(*docs.columns)


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, class_id, n_links) of every document."""
    return jaccard_classes(C.documents(spark, sf_dir))


#: The same by comparing the full shingle sets of all documents that share a shingle.
OP10_SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM documents),
g AS MATERIALIZED (SELECT DISTINCT doc_id, hash(g) AS g FROM (SELECT doc_id, unnest(CASE WHEN len(w) >= 5
  THEN list_transform(range(1, len(w) - 3), lambda p: array_to_string(w[p:p + 4], ' ')) ELSE [array_to_string(w, ' ')] END) AS g FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE shared / (na.n + nb.n - shared) >= 0.8),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, least(d.doc_id, coalesce((SELECT min(b) FROM r WHERE r.a = d.doc_id), d.doc_id)) AS class_id,
       (SELECT count(*) FROM e WHERE e.a = d.doc_id) AS n_links
FROM d
"""
