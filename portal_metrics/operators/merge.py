"""Merge semantics of the incremental load (MRG-2..6), as lazy DataFrames.

These functions define *what* the merged table is.  ``sources.store``
applies them to stored Parquet tables so that only the touched visit
months (fact) are rewritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """MRG-5: an empty table of the declared schema (first incremental load)."""
    return spark.createDataFrame([], schema)


def key_range(incoming: DataFrame, key: str = "visitdatekey"):
    """(min, max) of the extract's key as scalar-subquery Columns."""
    b = incoming.agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    return b.select("lo").scalar(), b.select("hi").scalar()


def replace_range(current: DataFrame, incoming: DataFrame, key: str = "visitdatekey",
                  lo=None, hi=None) -> DataFrame:
    """MRG-2: delete every stored row with lo <= key <= hi (the extract's own
    range), then insert all extract rows.  Days inside the range that the
    extract lacks vanish; rows with a NULL key are never deleted.  An empty
    extract (lo, hi NULL) deletes nothing."""
    if lo is None or hi is None:
        lo, hi = key_range(incoming, key)
    k = F.col(key)
    keep = k.isNull() | ~F.coalesce(k.between(lo, hi), F.lit(False))
    return current.filter(keep).unionByName(incoming.select(*current.columns))


def upsert(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """MRG-3 / MRG-4: drop stored rows whose key appears in the extract, insert
    every extract row (its duplicates too).  A NULL stored key never matches,
    so such rows are kept and accumulate (SQL ``IN`` semantics)."""
    keys = incoming.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
    return current.join(keys, key, "left_anti").unionByName(incoming.select(*current.columns))


def load_audit(table: str, current: DataFrame, incoming: DataFrame, merged: DataFrame,
               key: str | None = "visitdatekey") -> DataFrame:
    """MRG-6: rows before, extract rows, extract key range, rows after, as
    one lazy row (each number is a scalar subquery)."""
    spark = current.sparkSession
    row = spark.range(1).select(
        F.lit(table).alias("table"),
        current.select(F.count(F.lit(1))).scalar().alias("rows_before"),
        incoming.select(F.count(F.lit(1))).scalar().alias("incoming_rows"),
        merged.select(F.count(F.lit(1))).scalar().alias("rows_after"))
    if key:
        lo, hi = key_range(incoming, key)
        row = row.withColumn("min_key", lo).withColumn("max_key", hi)
    return row
