"""Incremental loading of arriving extracts (STR-1).

Drop folders receive CSV extracts of the fact, of pages and of employees.
Structured Streaming picks up new files (one per micro-batch, because the
merges are defined per extract), checks their header, and hands each batch
to the same storage merges as the batch load: range replace for the fact,
upsert for the dimensions.  ``trigger(availableNow=True)`` processes what
has arrived and stops.

The stream's checkpoint records which files a batch holds, the store's
commit which batch it applied and a digest of its rows.  A batch that is
replayed after a crash between the two is known by its record and left
out, so every extract is merged exactly once, rows without a day included.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EMPLOYEE_COLUMNS, EMPLOYEE_SCHEMA, FACT_COLUMNS, PAGE_COLUMNS, PAGE_SCHEMA
from ..sources.csv import known_pages
from ..sources.store import StarStore

RAW_FACT_SCHEMA = T.StructType([T.StructField(src, T.StringType(), True) for _, _, src in FACT_COLUMNS])


def _raw_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(src, T.StringType(), True) for _, _, src in columns])


def _typed(raw: DataFrame, columns=FACT_COLUMNS) -> DataFrame:
    return raw.select(*[F.col(f"`{src}`").try_cast(dt).alias(t) for t, dt, src in columns])


def batch_digest(rows: DataFrame) -> str:
    """A digest of a batch's rows, whatever their order: their number and two sums of row hashes."""
    h = F.xxhash64(*rows.columns)
    r = rows.agg(F.count("*").alias("n"), F.sum(h.cast("decimal(38,0)")).alias("a"), F.sum(F.hash(*rows.columns, h).cast("decimal(38,0)")).alias("b")).first()
    return f"{r['n']}:{r['a']}:{r['b']}"


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps as long as its checkpoint: batch numbers only mean something together with it."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0])["id"]


def _once(store: StarStore, name: str, checkpoint: str, columns, merge):
    """foreachBatch function that merges a batch unless the store has it."""
    def _apply(batch: DataFrame, batch_id: int) -> None:
        source = f"{name}:{_stream_id(store.spark, checkpoint)}"
        inc = _typed(batch, columns).persist()
        try:
            digest = batch_digest(inc)
            if not store.applied(source, batch_id, digest):
                merge(inc, (source, batch_id, digest))
        finally:
            inc.unpersist()
    return _apply


def merge_batch(store: StarStore, checkpoint: str):
    def merge(inc: DataFrame, batch: tuple) -> None:
        s = inc.agg(F.min("visitdatekey").alias("lo"), F.max("visitdatekey").alias("hi")).first()
        if s["lo"] is not None:
            store.replace_fact_range(inc, s["lo"], s["hi"], batch)
    return _once(store, "fact", checkpoint, FACT_COLUMNS, merge)


def merge_pages(store: StarStore, checkpoint: str):
    return _once(store, "page_inventory", checkpoint, PAGE_COLUMNS, lambda inc, batch: store.upsert_dimension(
        "page_inventory", known_pages(inc), "marketingpageid", PAGE_SCHEMA, batch))


def merge_employees(store: StarStore, checkpoint: str):
    return _once(store, "employee_contact", checkpoint, EMPLOYEE_COLUMNS, lambda inc, batch: store.upsert_dimension(
        "employee_contact", inc, "contactid", EMPLOYEE_SCHEMA, batch))


def _stream(spark: SparkSession, drop_dir: str, store: StarStore, columns, name: str, merge, checkpoint, available_now):
    """The header must carry the canonical source names in order:
    ``enforceSchema=false`` makes Spark check it and fail loudly otherwise."""
    checkpoint = checkpoint or f"{store.root}/_checkpoints/{name}"
    src = (spark.readStream.schema(_raw_schema(columns)).option("header", True).option("multiLine", columns is not FACT_COLUMNS)
           .option("enforceSchema", False).option("quote", '"').option("escape", '"').option("maxFilesPerTrigger", 1).csv(drop_dir))
    w = src.writeStream.foreachBatch(merge(store, checkpoint)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_fact_extracts(spark: SparkSession, drop_dir: str, store: StarStore,
                         checkpoint: str | None = None, available_now: bool = True):
    """Start the stream of fact extracts; returns the StreamingQuery."""
    return _stream(spark, drop_dir, store, FACT_COLUMNS, "fact-extracts", merge_batch, checkpoint, available_now)


def stream_page_extracts(spark: SparkSession, drop_dir: str, store: StarStore,
                         checkpoint: str | None = None, available_now: bool = True):
    """Start the stream of page inventory extracts."""
    return _stream(spark, drop_dir, store, PAGE_COLUMNS, "page-extracts", merge_pages, checkpoint, available_now)


def stream_employee_extracts(spark: SparkSession, drop_dir: str, store: StarStore,
                             checkpoint: str | None = None, available_now: bool = True):
    """Start the stream of employee extracts (headers without the table prefix)."""
    return _stream(spark, drop_dir, store, EMPLOYEE_COLUMNS, "employee-extracts", merge_employees, checkpoint, available_now)
