"""Exact unique visitors at every grain from one stored aggregate (QRY-2..5).

Visitors get dense numbers from 1.  A day's visitors are bitmaps over these numbers, one per day and bucket of 32,768
numbers; the visitors of a week, month or quarter are the union of its days' bitmaps, so each fact row is read once for
all grains, and a coarser grain reads only days x buckets.

Dense numbers keep buckets full: V visitors have V / 32,768 of them, 4 KB each and day at most.  A day with few visitors of a
bucket still stores its whole bitmap, which Parquet's encoding and compression shrink.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions.filters import NO_FILTERS, Filters
from ..model import StarModel
from ..session import written

#: Ranges in which visitors are numbered side by side.
RANGES = 256
#: The calendar column that names a period of each grain.
GRAINS = {"day": "date", "week": "year_week", "month": "year_month", "quarter": "year_quarter"}


def dense_numbers(values: DataFrame, column: str, out: str, ranges: int = RANGES) -> DataFrame:
    """The distinct non-NULL values of a column, numbered from 1 without gaps: by hash range, then offset by the ranges before."""
    dealt = values.select(column).where(F.col(column).isNotNull()).distinct().withColumn("_range", F.pmod(F.xxhash64(column), F.lit(ranges)))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(column))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = dealt.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    # one row a range
    return dealt.withColumn("_own", own).join(F.broadcast(offsets), "_range").select(column, (F.col("_own") + F.col("_before")).alias(out))


@dataclasses.dataclass(frozen=True)
class VisitorBitmaps:
    """The stored aggregate: day sums, day bitmaps, and the calendar they roll up by."""

    days: DataFrame          # visitdatekey, views, visits, likes, comments
    bitmaps: DataFrame       # visitdatekey, bucket, visitors (bitmap)
    dim_date: DataFrame

    @classmethod
    def of(cls, model: StarModel, filters: Filters = NO_FILTERS, ranges: int = RANGES) -> "VisitorBitmaps":
        """One pass over the fact: it is reduced to a row per (day, visitor), which is written; the rest reads that."""
        w = model.wide(filters, page="left")
        per = written(w.groupBy("visitdatekey", "viewingcontactid").agg(
            M.views().alias("views"), M.visits().alias("visits"), M.likes().alias("likes"), M.comments().alias("comments")), "day_visitors")
        numbers = dense_numbers(per, "viewingcontactid", "_no", ranges)
        bitmaps = (per.select("visitdatekey", "viewingcontactid").join(numbers, "viewingcontactid")
                   .groupBy("visitdatekey", F.bitmap_bucket_number("_no").alias("bucket"))
                   .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_no")).alias("visitors")))
        days = per.groupBy("visitdatekey").agg(*[F.sum(c).alias(c) for c in ("views", "visits", "likes", "comments")])
        return cls(written(days, "visitor_days"), written(bitmaps, "visitor_bitmaps"), model.dim_date)

    def _by(self, rows: DataFrame, period: Column) -> DataFrame:
        """Rows of days inside the calendar (M6), with their period."""
        d = F.broadcast(self.dim_date.select("datekey", "date", period.alias("period")))
        return rows.join(d, rows["visitdatekey"] == d["datekey"], "inner")

    def report(self, grain: str) -> DataFrame:
        """QRY-2..5: per period of the grain, exact unique visitors and the base sums."""
        period = F.col(GRAINS[grain]).cast("string")
        sums = self._by(self.days, period).groupBy("period").agg(
            F.min("date").alias("period_start"), F.sum("views").alias("total_views"), F.sum("visits").alias("total_visits"),
            F.sum("likes").alias("likes"), F.sum("comments").alias("comments"), F.count("*").alias("days"))
        whole = self._by(self.bitmaps, period).groupBy("period", "bucket").agg(F.bitmap_or_agg("visitors").alias("visitors"))
        uv = whole.groupBy("period").agg(F.sum(F.bitmap_count("visitors")).alias("unique_visitors"))
        # a row per period of the calendar
        out = sums.join(F.broadcast(uv), "period", "left")
        return out.select(F.lit(grain).alias("grain"), "period", "period_start", F.coalesce("unique_visitors", F.lit(0).cast("long")).alias("unique_visitors"),
                          "total_views", "total_visits", "likes", "comments", (F.col("likes") + F.col("comments")).alias("engagements"), "days")

    def all_grains(self) -> DataFrame:
        """The reports of all grains, one below the other."""
        first, *rest = (self.report(g) for g in GRAINS)
        for r in rest:
            first = first.unionByName(r)
        return first
