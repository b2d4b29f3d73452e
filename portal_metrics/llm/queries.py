"""The registered queries of the operators: one ``opN_<name>`` each, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from portal_metrics.llm.align import op13_cross_tokenizer
from portal_metrics.llm.ann import OP2_SQL, op2_nearest_neighbours
from portal_metrics.llm.bpe import op7_byte_bpe
from portal_metrics.llm.decontam import OP9_SQL, op9_decontamination
from portal_metrics.llm.lexical import OP12_SQL, op12_lexical_search
from portal_metrics.llm.ngram_join import OP10_SQL, op10_ngram_jaccard
from portal_metrics.llm.paragraph_dedup import op4_paragraph_dedup
from portal_metrics.llm.pii import op5_pii
from portal_metrics.llm.secrets import op6_secrets
from portal_metrics.llm.suffix_dedup import op1_suffix_dedup
from portal_metrics.llm.toxicity import op3_toxicity
from portal_metrics.llm.urls import OP8_SQL, op8_url_filter
from portal_metrics.llm.warc import OP11_SQL, op11_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_nearest_neighbours": op2_nearest_neighbours,
    "op3_toxicity": op3_toxicity,
    "op4_paragraph_dedup": op4_paragraph_dedup,
    "op5_pii": op5_pii,
    "op6_secrets": op6_secrets,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_url_filter": op8_url_filter,
    "op9_decontamination": op9_decontamination,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_warc": op11_warc,
    "op12_lexical_search": op12_lexical_search,
    "op13_cross_tokenizer": op13_cross_tokenizer,
}

ORACLE_SQL: dict[str, str] = {
    "op2_nearest_neighbours": OP2_SQL,
    "op8_url_filter": OP8_SQL,
    "op9_decontamination": OP9_SQL,
    "op10_ngram_jaccard": OP10_SQL,
    "op11_warc": OP11_SQL,
    "op12_lexical_search": OP12_SQL,
}
