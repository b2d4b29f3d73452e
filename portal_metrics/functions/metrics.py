"""Metric building blocks as JVM-side Column expressions (AGG-*, FIL-15..17, FUN-*).

Every aggregate here is a built-in Spark expression, so reports keep
whole-stage codegen and map-side partial aggregation.  Column names
follow the stored star schema.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VIEWER = "viewingcontactid"
PAGE = "marketingpageid"
DAY = "visitdatekey"


def c(name_or_col) -> Column:
    return F.col(name_or_col) if isinstance(name_or_col, str) else name_or_col


# ---------------------------------------------------------------- predicates
def is_like(col: str = "marketingpageidliked") -> Column:
    """A like is a non-NULL, non-empty liked-page id (rule M2, FIL-15)."""
    x = F.col(col)
    return x.isNotNull() & (x != F.lit(""))


def is_engaged() -> Column:
    """Row shows engagement: a like or at least one comment (FIL-16)."""
    return is_like() | (F.coalesce(F.col("comments"), F.lit(0)) > 0)


def label(col, default: str = "Unknown") -> Column:
    """COALESCE(attr, default) after a left join (FIL-17)."""
    return F.coalesce(c(col), F.lit(default))


def contains_ci(col, text: str) -> Column:
    """Literal, case-insensitive 'contains' (no LIKE wildcards) (FIL-3..5)."""
    return F.lower(c(col)).contains(text.lower())


def truncate_label(col, keep: int = 40, limit: int = 43) -> Column:
    """First ``keep`` characters + '...' when longer than ``limit`` (FUN-8)."""
    x = c(col)
    return F.when(F.length(x) > limit, F.concat(F.substring(x, 1, keep), F.lit("..."))).otherwise(x)


# ------------------------------------------------------------------- ratios
def ratio_null(num, den) -> Column:
    """num / den as double; NULL when den is 0 or NULL (SQL NULLIF form)."""
    return F.try_divide(c(num).cast("double"), c(den).cast("double"))


def ratio_zero(num, den) -> Column:
    """DIVIDE(num, den, 0): 0 when den is 0 or NULL (measure form, FUN-9)."""
    return F.coalesce(ratio_null(num, den), F.lit(0.0))


def pct_null(num, den, digits: int | None = None) -> Column:
    """num * 100 / den, NULL on zero; optionally rounded."""
    x = F.try_divide(c(num).cast("double") * F.lit(100.0), c(den).cast("double"))
    return F.round(x, digits) if digits is not None else x


def pct_zero(num, den) -> Column:
    return F.coalesce(pct_null(num, den), F.lit(0.0))


# -------------------------------------------------------------- aggregates
def rows() -> Column:                      # AGG-1
    return F.count(F.lit(1))


def uv() -> Column:                        # AGG-2, MEA-1
    return F.count_distinct(F.col(VIEWER))


def views() -> Column:                     # AGG-3
    return F.sum("views")


def visits() -> Column:                    # AGG-3
    return F.sum("visits")


def likes() -> Column:                     # AGG-4 (SQL form: NULL on empty input)
    return F.sum(F.when(is_like(), F.lit(1)).otherwise(F.lit(0))).cast("long")


def likes_count() -> Column:               # MEA-4 (measure form: 0 on empty input)
    return F.count_if(is_like())


def comments() -> Column:                  # AGG-5
    return F.sum("comments")


def engagements() -> Column:               # AGG-6: NULL when every comment is NULL
    return likes() + comments()


def engagements_zero() -> Column:          # MEA-6: blanks count as 0
    return likes_count() + F.coalesce(comments(), F.lit(0).cast("long"))


def engagement_rate(digits: int | None = 3) -> Column:   # AGG-7
    return pct_null(engagements(), views(), digits)


def engagement_rate_zero() -> Column:      # MEA-7
    return pct_zero(engagements_zero(), views())


def pages() -> Column:                     # AGG-8
    return F.count_distinct(F.col(PAGE))


def days() -> Column:                      # AGG-9
    return F.count_distinct(F.col(DAY))


def per_visitor(total: Column, digits: int) -> Column:   # AGG-13..15
    return F.round(ratio_null(total, uv()), digits)


def base_metrics(uv_name: str = "unique_visitors") -> list[Column]:
    """uv, views, visits, likes, comments, engagements (the reports' core)."""
    return [
        uv().alias(uv_name),
        views().alias("total_views"),
        visits().alias("total_visits"),
        likes().alias("likes"),
        comments().alias("comments"),
        engagements().alias("engagements"),
    ]


# Named metric catalogue used by the generic report (ASK-1).
METRICS = {
    "rows": rows,
    "uv": uv,
    "views": views,
    "visits": visits,
    "likes": likes,
    "comments": comments,
    "engagements": engagements,
    "engagement_rate": lambda: engagement_rate(3),
    "pages": pages,
    "days": days,
    "avg_duration": lambda: F.round(F.avg("durationavg"), 1),
    "views_per_visitor": lambda: per_visitor(views(), 2),
    "like_to_view_pct": lambda: pct_null(likes(), views(), 3),
    "comments_per_page": lambda: F.round(ratio_null(comments(), pages()), 3),
}


def metric(name: str) -> Column:
    return METRICS[name]().alias(name)
