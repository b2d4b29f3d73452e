"""Optional sources (SRC-4, SRC-7): a missing path yields None, not an error."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path (file or folder, any Hadoop file system) exists."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def optional_parquet(spark: SparkSession, path: str | None) -> DataFrame | None:
    if not path or not path_exists(spark, path):
        return None
    return spark.read.parquet(path)


def optional_source(spark: SparkSession, path: str | None, reader) -> DataFrame | None:
    """``reader(spark, path)`` when the path exists, else None (SRC-4)."""
    if not path or not path_exists(spark, path):
        return None
    return reader(spark, path)
