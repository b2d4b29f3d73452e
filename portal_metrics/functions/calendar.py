"""Generated calendar dimension (DIM-1..10).

The spine is produced with ``spark.range`` (parallel, no single-row
explode) and every attribute is a built-in date expression, so the whole
table is one codegen stage.  Its size is fixed by the range (6,940 rows
for the default 2022-01-01 .. 2040-12-31), which is what makes it safe to
broadcast into every fact join.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_START = "2022-01-01"
DEFAULT_END = "2040-12-31"


def _to_date(x) -> _dt.date:
    if isinstance(x, _dt.datetime):
        return x.date()
    if isinstance(x, _dt.date):
        return x
    return _dt.date.fromisoformat(str(x))


def _pad2(col: Column) -> Column:
    return F.lpad(col.cast("string"), 2, "0")


def calendar_columns(d: Column) -> list[Column]:
    """The 24 calendar attributes of a date column, in stored order."""
    year, month, day = F.year(d), F.month(d), F.dayofmonth(d)
    quarter = F.quarter(d)
    iso_dow = F.weekday(d) + 1                      # 1 = Monday .. 7 = Sunday
    week = F.weekofyear(d)                          # ISO week number
    iso_year = F.year(F.date_add(d, 3 - F.weekday(d)))   # year of that week's Thursday
    month_end = d == F.last_day(d)
    return [
        (year * 10000 + month * 100 + day).cast("long").alias("datekey"),
        d.alias("date"),
        year.alias("year"),
        quarter.alias("quarter"),
        F.concat(F.lit("Q"), quarter.cast("string")).alias("quarter_name"),
        F.concat(F.lit("Q"), quarter.cast("string"), F.lit(" "), year.cast("string")).alias("year_quarter"),
        month.alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        F.concat(year.cast("string"), F.lit("-"), _pad2(month)).alias("year_month"),
        week.alias("week_number"),
        F.concat(iso_year.cast("string"), F.lit("-W"), _pad2(week)).alias("year_week"),
        day.alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        iso_dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_short"),
        iso_dow.isin(6, 7).alias("is_weekend"),
        (day == 1).alias("is_month_start"),
        month_end.alias("is_month_end"),
        (month.isin(1, 4, 7, 10) & (day == 1)).alias("is_quarter_start"),
        (month.isin(3, 6, 9, 12) & month_end).alias("is_quarter_end"),
        ((month == 1) & (day == 1)).alias("is_year_start"),
        ((month == 12) & (day == 31)).alias("is_year_end"),
    ]


def date_dim(spark: SparkSession, start=DEFAULT_START, end=DEFAULT_END) -> DataFrame:
    """Every day of [start, end] with its calendar attributes (DIM-1..9)."""
    s, e = _to_date(start), _to_date(end)
    n = (e - s).days + 1
    if n <= 0:
        raise ValueError(f"empty calendar range {s}..{e}")
    spine = spark.range(0, n).select(F.date_add(F.lit(s), F.col("id").cast("int")).alias("d"))
    return spine.select(*calendar_columns(F.col("d")))


def calendar_summary(dim: DataFrame) -> DataFrame:
    """rows, first and last date of a calendar (DIM-10)."""
    return dim.agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("min_date"),
                   F.max("date").alias("max_date"))


def calendar_days(start, end) -> int:
    """Row count of a calendar range, known without running a job."""
    return (_to_date(end) - _to_date(start)).days + 1


def date_dim_spanning(df: DataFrame, col: str) -> DataFrame:
    """Calendar covering the [min, max] dates of ``col`` in ``df``.

    The bounds come from one aggregate; the spine is exploded from that
    single row, so its size is the number of days spanned (bounded by the
    data's date range, not its row count)."""
    b = df.agg(F.min(F.to_date(F.col(col))).alias("lo"), F.max(F.to_date(F.col(col))).alias("hi"))
    spine = b.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d"))
    return spine.select(*calendar_columns(F.col("d")))
