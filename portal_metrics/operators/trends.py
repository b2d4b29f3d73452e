"""Time-series operators (WIN-1, WIN-3..5).

* ``moving_average``: a row frame over an already daily/periodic result.
* ``period_change``: previous period by a self-join on the *shifted
  period key*, not ``lag`` -- a missing month must compare with nothing,
  not with the month before it.
* ``rolling_distinct``: distinct visitors over a sliding window of
  months, by an interval sweep: an active month covers a run of report
  months, a visitor's runs are united, and only their ends move on.
* ``cumulative_reach``: running count of first-time visitors per month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def moving_average(df: DataFrame, value: str, order: str, n: int = 7, out: str | None = None,
                   by=()) -> DataFrame:
    """WIN-1: mean of the current and n-1 previous rows; NULL before n rows.

    Unpartitioned (``by`` empty) it runs over a daily series, whose size
    is bounded by the calendar.
    """
    out = out or f"{value}_ma{n}"
    w = Window.partitionBy(*by).orderBy(F.col(order)).rowsBetween(-(n - 1), 0)
    return df.withColumn(out, F.when(F.count(F.lit(1)).over(w) == n, F.avg(value).over(w)))


def shift_period(col: Column, grain: str, n: int) -> Column:
    """Start of the period n periods earlier (grain: day/week/month/quarter/year)."""
    if grain == "day":
        return F.date_sub(col, n)
    if grain == "week":
        return F.date_sub(col, 7 * n)
    if grain == "month":
        return F.add_months(col, -n)
    if grain == "quarter":
        return F.add_months(col, -3 * n)
    if grain == "year":
        return F.add_months(col, -12 * n)
    raise ValueError(grain)


def period_start(date: Column, grain: str) -> Column:
    if grain == "day":
        return date
    if grain == "week":
        return F.date_sub(date, F.weekday(date))          # ISO Monday
    return F.trunc(date, {"month": "MM", "quarter": "quarter", "year": "year"}[grain])


def null_safe_left(left: DataFrame, right: DataFrame, keys, plain=()) -> DataFrame:
    """Left join on ``keys`` where NULL meets NULL (segments may be NULL), and on the never-NULL columns ``plain``."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_r_{k}")
    for k in plain:
        renamed = renamed.withColumnRenamed(k, f"_r_{k}")
    on = F.lit(True)
    for k in plain:
        on = on & (left[k] == renamed[f"_r_{k}"])
    for k in keys:
        on = on & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, on, "left").drop(*[f"_r_{k}" for k in [*keys, *plain]])


def period_change(df: DataFrame, period: str, value: str, grain: str = "month", n: int = 1,
                  by=(), prev_out: str | None = None, change_out: str | None = None,
                  zero_when_missing: bool = True) -> DataFrame:
    """WIN-3 / MEA-13: value of the period n periods earlier and the change in %.

    ``period`` holds each row's period start date.  Change is
    (cur - prev) / prev * 100, 0 when prev is 0 or absent (DIVIDE(..,0)),
    or NULL then when ``zero_when_missing`` is False.
    """
    prev_out = prev_out or f"prev_{value}"
    change_out = change_out or f"{value}_change_pct"
    by = list(by)
    prev = df.select(*[F.col(b) for b in by], F.col(period).alias("_p_period"),
                     F.col(value).alias(prev_out))
    cur = df.withColumn("_p_period", shift_period(F.col(period), grain, n))
    j = null_safe_left(cur, prev, by, ["_p_period"]).drop("_p_period")
    ch = F.try_divide((F.col(value) - F.col(prev_out)).cast("double") * F.lit(100.0),
                      F.col(prev_out).cast("double"))
    return j.withColumn(change_out, F.coalesce(ch, F.lit(0.0)) if zero_when_missing else ch)


def _month_no(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def rolling_distinct(visits: DataFrame, who: str, day: str, months: int = 6,
                     out: str = "rolling_uv", by=()) -> DataFrame:
    """WIN-4 / MEA-14: distinct ``who`` over the ``months`` months ending at
    each report month's last day, i.e. days d with
    add_months(last_day(m), -months) < d <= last_day(m), for months with data.

    ``visits`` holds (by..., who, day DATE), read once.  The last day of an
    active month decides which report months it covers: its own and the
    next ``months`` - 1, and one more if that month is too short to start
    its window at this month's end.  A visitor's active months (bounded by
    the calendar) are united into runs; a run leaves +1 where it opens and
    -1 after it closes, summed per month before they are shuffled, and a
    running sum over the months gives the counts.  Active months without
    an end of a run, and those of NULL visitors, only mark months with data.
    """
    by = list(by)
    active = visits.groupBy(*by, who, _month_no(F.col(day)).alias("_m")).agg(F.max(day).alias("_last"))
    window_start = F.add_months(F.last_day(F.add_months(F.trunc("_last", "MM"), months)), -months)
    end = F.col("_m") + F.when(F.col("_last") > window_start, months).otherwise(months - 1)
    runs = (active.withColumn("_end", end).groupBy(*by, who)
            .agg(F.array_sort(F.collect_list(F.struct("_m", "_end"))).alias("_s")))

    def ends(x, i):
        # runs that touch are one; ends grow with the months, so neighbours decide
        opens = (i == 0) | (x["_m"] > F.get("_s", i - 1)["_end"] + 1)
        closes = (i == F.size("_s") - 1) | (F.get("_s", i + 1)["_m"] > x["_end"] + 1)
        known = F.col(who).isNotNull()
        mark = F.struct(x["_m"].alias("_m"), F.when(opens & known, 1).otherwise(0).alias("_d"), F.lit(True).alias("_mark"))
        close = F.struct((x["_end"] + 1).alias("_m"), F.lit(-1).alias("_d"), F.lit(False).alias("_mark"))
        return F.when(closes & known, F.array(mark, close)).otherwise(F.array(mark))

    steps = runs.select(*by, F.explode(F.flatten(F.transform("_s", ends))).alias("_e")).select(*by, "_e.*")
    per = steps.groupBy(*by, "_m").agg(F.sum("_d").alias("_d"), F.bool_or("_mark").alias("_mark"))
    # a row per month (and group)
    w = Window.partitionBy(*by).orderBy("_m").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    month = F.make_date(F.floor(F.col("_m") / 12), F.col("_m") % 12 + 1, F.lit(1))
    return (per.withColumn(out, F.sum("_d").over(w)).where("_mark")
            .select(*by, month.alias("month"), out))


def cumulative_reach(visits: DataFrame, who: str, day: str, out: str = "cumulative_uv",
                     by=()) -> DataFrame:
    """WIN-5: per month and day, distinct visitors seen since the month began."""
    by = list(by)
    month = F.trunc(F.col(day), "MM")
    first = (visits.where(F.col(who).isNotNull())
             .groupBy(*by, month.alias("month"), who).agg(F.min(day).alias("_first")))
    new = first.groupBy(*by, "month", F.col("_first").alias(day)).agg(F.count(F.lit(1)).alias("new_visitors"))
    days = visits.select(*by, month.alias("month"), F.col(day)).distinct()
    d = null_safe_left(days, new, by, ["month", day]).fillna(0, subset=["new_visitors"])
    w = (Window.partitionBy(*by, "month").orderBy(day)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return d.withColumn(out, F.sum("new_visitors").over(w))


def rolling_distinct_approx(visits: DataFrame, who: str, day: str, months: int = 6,
                            out: str = "rolling_uv", lg_config_k: int = 12, by=()) -> DataFrame:
    """WIN-4 approximate: one HLL sketch of visitors per day (a row per day,
    bounded by the calendar), each day's sketch sent to the report months
    whose window holds it, sketches unioned per month.  Relative error is
    about 1.04 / sqrt(2^lg_config_k) (1.6 % at k = 12)."""
    by = list(by)
    daily = (visits.where(F.col(who).isNotNull()).groupBy(*by, F.col(day).alias("_d"))
             .agg(F.hll_sketch_agg(F.col(who), lg_config_k).alias("_sk")))
    cand = daily.select(*by, "_d", "_sk", F.explode(F.sequence(F.lit(0), F.lit(months))).alias("_k"))
    cand = cand.withColumn("month", F.add_months(F.trunc(F.col("_d"), "MM"), F.col("_k")))
    end = F.last_day(F.col("month"))
    inwin = cand.where((F.col("_d") <= end) & (F.col("_d") > F.add_months(end, -months)))
    res = inwin.groupBy(*by, "month").agg(F.hll_sketch_estimate(F.hll_union_agg("_sk")).alias(out))
    report_months = visits.select(*by, F.trunc(F.col(day), "MM").alias("month")).distinct()
    return null_safe_left(report_months, res, by, ["month"]).fillna(0, subset=[out])
