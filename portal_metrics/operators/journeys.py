"""Visitor journeys over time-stamped page events (ASK-18).

The fact table has only a day key, so journeys need an event table
(user, ts, page).  Sessions split on inactivity > ``gap_minutes``.

Skew: one user may own a large share of all events, even of one hour, so
no window is ever partitioned by user, or by user and hour, alone.  Events
are windowed per (user, time bucket); a bucket is an hour, or a slice of
an hour in which the user has more than ``hot_rows`` events (slices end
at approximate quantiles of its times, so they hold about equally many).
What crosses a bucket edge is carried by small per-bucket summaries
(first and last timestamp, count, session starts, first L-1 events) that
are windowed per user -- one row per bucket, not per event:

1. within a bucket: ``lag`` of the timestamp (in-bucket gaps), row number;
2. per bucket (one row): first/last timestamp and in-bucket starts; a
   ``lag`` over the user's buckets decides whether the bucket's first
   event starts a session, and a running sum of starts gives the bucket's
   session offset -- joined back once;
3. paths of length L: ``lead`` inside the bucket, and the heads (first
   L-1 events) of the next L-1 buckets for rows near the bucket's end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_B = "_bucket"
#: Events of a user's hour that stay one bucket; slices of a larger one.
HOT_ROWS, SLICES = 100_000, 256


def _epoch_seconds(df: DataFrame, ts: str):
    t = df.schema[ts].dataType.simpleString()
    epoch = F.lit("1970-01-01 00:00:00").cast(t)
    return F.timestamp_diff("MICROSECOND", epoch, F.col(ts))


def _bucketed(e: DataFrame, user: str, bucket_seconds: int, hot_rows: int) -> DataFrame:
    """``e`` with its bucket: (hour, slice).  Events of one user at one microsecond are never parted."""
    hour = F.floor(F.col("_t") / F.lit(bucket_seconds * 1_000_000))
    e = e.withColumn("_hour", hour)
    hot = e.groupBy(user, "_hour").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select(user, "_hour")
    cuts = (e.select(user, "_hour", "_t").join(hot, [user, "_hour"], "left_semi").groupBy(user, "_hour")
            .agg(F.percentile_approx("_t", [i / SLICES for i in range(1, SLICES)], 10_000).alias("_cuts")))
    e = e.join(cuts, [user, "_hour"], "left")
    part = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(F.size(F.filter("_cuts", lambda c: c < F.col("_t"))))
    return e.withColumn(_B, F.struct(F.col("_hour").alias("hour"), part.alias("slice"))).drop("_hour", "_cuts")


def sessionize(events: DataFrame, user: str = "user_id", ts: str = "ts", gap_minutes: int = 30,
               bucket_seconds: int = 3600, tiebreak: str | None = "event_id",
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds ``session_no`` (1, 2, ... per user), ``session_start`` and the
    helper columns ``_t`` (epoch micros), ``_rn``/``_cnt`` (row and size in
    the bucket) and ``_bucket``.

    One window pass per (user, bucket) gives in-bucket gaps; one row per
    bucket then carries its first/last time, count and in-bucket session
    starts, from which a window over the user's buckets derives whether the
    bucket's first event starts a session and the bucket's session offset.
    A single join brings that back to the events."""
    gap = int(gap_minutes) * 60 * 1_000_000
    e = _bucketed(events.withColumn("_t", _epoch_seconds(events, ts)), user, bucket_seconds, hot_rows)
    order = [F.col("_t")] + ([F.col(tiebreak)] if tiebreak else [])
    wb = Window.partitionBy(user, _B).orderBy(*order)
    e = (e.withColumn("_rn", F.row_number().over(wb))
          .withColumn("_inner", (F.col("_t") - F.lag("_t").over(wb)) > F.lit(gap)))

    bs = e.groupBy(user, _B).agg(F.min("_t").alias("_bmin"), F.max("_t").alias("_bmax"),
                                 F.count(F.lit(1)).alias("_cnt"), F.count_if("_inner").alias("_n_inner"))
    wu = Window.partitionBy(user).orderBy(_B)
    prev_max = F.lag("_bmax").over(wu)
    bs = bs.withColumn("_first", prev_max.isNull() | ((F.col("_bmin") - prev_max) > F.lit(gap)))
    bs = bs.withColumn("_starts", F.col("_n_inner") + F.col("_first").cast("long"))
    bs = bs.withColumn("_offset", F.sum("_starts").over(
        wu.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_starts"))
    e = e.join(bs.select(user, _B, "_first", "_cnt", "_offset"), [user, _B])
    e = e.withColumn("session_start", F.when(F.col("_rn") == 1, F.col("_first"))
                     .otherwise(F.coalesce(F.col("_inner"), F.lit(False))))
    run = F.sum(F.col("session_start").cast("long")).over(
        wb.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (e.withColumn("session_no", (F.col("_offset") + run).cast("long"))
             .drop("_inner", "_first", "_offset"))


def sessions(sess: DataFrame, user: str = "user_id", ts: str = "ts", page: str = "page") -> DataFrame:
    """One row per session: events, distinct pages, first and last time.
    (Per-session groupBy: partial aggregation, a hot session is combined
    map-side.)"""
    return sess.groupBy(user, "session_no").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct(page).alias("pages"),
        F.min(ts).alias("session_start_ts"), F.max(ts).alias("session_end_ts"))


def session_depth(sess: DataFrame, user: str = "user_id", ts: str = "ts", page: str = "page") -> DataFrame:
    """Distribution of session depth (events per session)."""
    s = sessions(sess, user, ts, page)
    return s.groupBy(F.col("events").alias("depth")).agg(F.count(F.lit(1)).alias("sessions"))


def paths(sess: DataFrame, length: int = 2, user: str = "user_id", page: str = "page",
          tiebreak: str | None = "event_id") -> DataFrame:
    """Every run of ``length`` consecutive events inside one session:
    columns user, session_no, step_1 .. step_<length>."""
    if length < 2:
        raise ValueError("length must be >= 2")
    L = length
    order = [F.col("_t")] + ([F.col(tiebreak)] if tiebreak else [])
    wb = Window.partitionBy(user, _B).orderBy(*order)
    ev = F.struct(F.col(page).alias("p"), F.col("session_no").alias("s"))
    heads = (sess.where(F.col("_rn") <= L - 1)
             .groupBy(user, _B)
             .agg(F.array_sort(F.collect_list(F.struct(F.col("_rn").alias("r"), ev.alias("e")))).alias("_h")))
    heads = heads.withColumn("_h", F.transform("_h", lambda x: x["e"]))
    wu = Window.partitionBy(user).orderBy(_B)
    empty = F.array().cast(heads.schema["_h"].dataType)
    nxt = F.concat(*[F.coalesce(F.lead("_h", k).over(wu), empty) for k in range(1, L)])
    heads = heads.select(user, _B, F.slice(nxt, 1, L - 1).alias("_next"))
    s = sess.join(heads, [user, _B], "left")
    out = [F.col(user), F.col("session_no"), F.col(page).alias("step_1")]
    ok = F.lit(True)
    for k in range(1, L):
        inside = F.col("_rn") + k <= F.col("_cnt")
        idx = (F.col("_rn") + k - F.col("_cnt")).cast("int")
        carried = F.when(~inside & (F.size("_next") >= idx), F.element_at("_next", idx))
        step = F.when(inside, F.lead(ev, k).over(wb)).otherwise(carried)
        s = s.withColumn(f"_s{k}", step)
        ok = ok & F.col(f"_s{k}").isNotNull() & (F.col(f"_s{k}.s") == F.col("session_no"))
        out.append(F.col(f"_s{k}.p").alias(f"step_{k + 1}"))
    return s.where(ok).select(*out)


def next_page_counts(sess: DataFrame, user: str = "user_id", page: str = "page") -> DataFrame:
    """Page -> next page within a session, with counts."""
    p = paths(sess, 2, user, page)
    return p.groupBy(F.col("step_1").alias("page"), F.col("step_2").alias("next_page")).agg(
        F.count(F.lit(1)).alias("transitions"))


def common_paths(sess: DataFrame, length: int = 3, k: int = 20, user: str = "user_id",
                 page: str = "page") -> DataFrame:
    """The k most common page sequences of ``length`` steps (ties by path)."""
    p = paths(sess, length, user, page)
    steps = [f"step_{i}" for i in range(1, length + 1)]
    g = p.groupBy(*steps).agg(F.count(F.lit(1)).alias("occurrences"))
    return g.orderBy(F.desc("occurrences"), *[F.col(s).asc_nulls_last() for s in steps]).limit(k)
