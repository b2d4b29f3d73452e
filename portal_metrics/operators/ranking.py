"""Ranks and medians without a task that holds all rows (WIN-2, AGG-20).

* ``dense_ranks``: the distinct values of a column are cut into ranges at approximate quantiles; each range is
  numbered by itself, and ranges are offset by the number of distinct values before them (one row a range, broadcast).
  Rows meet their rank by an equality join on the value, whose type Spark picks; rows of one frequent value are never sorted
  together.
* ``exact_median``: selection by histogram refinement.  A round counts the values of ``bins`` equal bins between the least and the
  largest value left, and goes on with the values of the bin that holds the wanted rank, until they are all equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of a ranking; bins of a round of a selection.
RANGES, BINS = 256, 1024


def _ranked_values(values: DataFrame, value: str, out: str, ranges: int) -> DataFrame:
    """(value, out): dense rank of each of the distinct ``values``, highest first, NULL last."""
    # at most ``ranges`` values in the driver
    cuts = values.select(F.percentile_approx(value, [i / ranges for i in range(1, ranges)], 10_000)).first()[0] or []
    above = F.filter(F.array(*[F.lit(c) for c in sorted(set(cuts))]), lambda c: c > F.col(value))
    # range 0 holds what is not below the highest cut; NULL comes after all
    no = F.when(F.col(value).isNull(), F.lit(ranges)).otherwise(F.size(above))
    dealt = values.select(value, no.alias("_range"))
    w = Window.partitionBy("_range").orderBy(F.col(value).desc_nulls_last())
    local = dealt.withColumn("_own", F.row_number().over(w))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = dealt.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    # one row a range
    return local.join(F.broadcast(offsets), "_range").select(value, (F.col("_own") + F.col("_before")).cast("int").alias(out))


def dense_ranks(df: DataFrame, ranks: dict[str, str], ranges: int = RANGES) -> DataFrame:
    """``df`` (a stored table: it is read once a column and once for the joins) with a dense rank, highest value first
    and NULL last, for each {numeric column: rank column}."""
    for value, out in ranks.items():
        ranked = _ranked_values(df.select(value).distinct(), value, out, ranges).withColumnRenamed(value, "_value")
        df = df.join(ranked, df[value].eqNullSafe(ranked["_value"]), "left").drop("_value")
    return df


def _at(values: DataFrame, rank: int, lo: float, hi: float, bins: int) -> float:
    while lo < hi:
        no = F.least(F.floor((F.col("v") - lo) / (hi - lo) * bins), F.lit(bins - 1))
        # the bins' own least and largest values bound the next round, so no bound is rounded
        for b in (values.where(F.col("v").between(lo, hi)).groupBy(no.alias("b"))
                  .agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("b").collect()):
            if rank < b["n"]:
                lo, hi = b["lo"], b["hi"]
                break
            rank -= b["n"]
    return lo


def exact_median(df: DataFrame, column: str, bins: int = BINS) -> float | None:
    """The median of a numeric column of a stored table, NULLs left out; None without values."""
    values = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    n, least, most = values.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if not n:
        return None
    a = _at(values, (n - 1) // 2, least, most, bins)
    b = a if n % 2 else _at(values, n // 2, least, most, bins)
    return a * 0.5 + b * 0.5
