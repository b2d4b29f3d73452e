"""Quick searches of the notebook (FIL-18..20)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import contains_ci


def search_websites(pages: DataFrame, keyword: str) -> DataFrame:
    """FIL-18: distinct site names containing ``keyword`` (case-insensitive)."""
    return (pages.where(contains_ci("websitename", keyword)).select("websitename").distinct()
            .orderBy(F.col("websitename").asc_nulls_last()))


def search_pages(pages: DataFrame, pattern: str, limit: int = 50) -> DataFrame:
    """FIL-19: pages whose full URL contains ``pattern``; top 50 by site, name."""
    return (pages.where(contains_ci("fullpageurl", pattern))
            .select("pagename", "websitename", "fullpageurl")
            .orderBy(*[F.col(c).asc_nulls_last() for c in ("websitename", "pagename", "fullpageurl")])
            .limit(limit))


def date_range(fact: DataFrame) -> DataFrame:
    """FIL-20: earliest and latest day key and the number of distinct days."""
    return fact.agg(F.min("visitdatekey").alias("earliest_date"), F.max("visitdatekey").alias("latest_date"),
                    F.count_distinct("visitdatekey").alias("total_days"))
