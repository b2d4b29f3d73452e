"""Corpus pipeline: five stages over ``documents``, each one of the operators of ``portal_metrics.llm``.

1. toxicity: documents that the clause grammar rejects (score >= 0.7) go.
2. ngram_jaccard: of each group of documents linked by five-word shingles at Jaccard >= 0.8, one row stays, of the least doc_id.
3. decontamination: documents that hold 80 % of a benchmark item's shingles go.
4. pii: personal data is replaced by its kind in brackets; n_chars follows the text.
5. byte_bpe: the kept columns with the packed token ids, their number and the digest of what they decode to.

A stage's result is written as Parquet and read back as the next one's documents.
Stages take every row their predecessor kept; empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portal_metrics.llm import bpe, common, decontam, ngram_join, pii, toxicity

#: Rank file of the last stage.
RANKS = "byte_bpe_50k.tiktoken"


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, out="_toxicity").where(F.col("_toxicity") < toxicity.THRESHOLD).select(*docs.columns)


def ngram_jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.first_rows(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.masked(docs)


def byte_bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.broadcast_ranks(spark, public_tokenizers.path(RANKS))
    encoded = bpe.encode_decode(docs, ranks)
    return encoded.withColumns({"n_tokens": bpe.n_tokens(), "decoded_sha256": F.sha2("decoded", 256)}).drop("decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("ngram_jaccard", ngram_jaccard_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("byte_bpe", byte_bpe_stage),
]

#: A learned score and byte-pair merges have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = common.documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = common.saved(stage(spark, docs, sf_dir))
    return docs
