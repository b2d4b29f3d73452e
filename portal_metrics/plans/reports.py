"""The notebook's named reports (QRY-1..28), the documented SQL patterns
(DOC-1..5) and the generic slice-and-dice report (ASK-1).

Every report is ``name(model, filters=NO_FILTERS, **params) -> DataFrame``:
a lazy group-by over ``StarModel.wide``.  Nothing is collected; sorting
is kept where the reference sorts, and each LIMIT gets the group key as
tie-breaker so top-k output is deterministic (M11).

Reports grouped by employee attributes aggregate the fact per visitor
*before* joining employees (eager aggregation): the shuffle join then
moves one row per visitor instead of every page view, and a hot or NULL
visitor is already a single pre-aggregated row.  Sums are re-summed after
the join, so the fan-out of duplicate employee keys (M8) is the same as
joining raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions.filters import NO_FILTERS, Filters
from ..model import StarModel, bounded_broadcast, dealt, fits_broadcast, tasks_for
from ..operators.reshape import pivot_matrix, top_k
from ..schemas import DATE_COLUMNS, EMPLOYEE_COLUMNS, PAGE_COLUMNS

_DATE_COLS = {n for n, _ in DATE_COLUMNS}
_EMP_COLS = {n for n, _, _ in EMPLOYEE_COLUMNS}
_PAGE_COLS = {n for n, _, _ in PAGE_COLUMNS} - {"marketingpageid"}


def _asc(*cols):
    return [F.col(x).asc_nulls_last() if isinstance(x, str) else x for x in cols]


# ------------------------------------------------------- page-grouped plans
# name -> (aggregate over joined fact rows, aggregate over rows with partial sums, given their number of visitors)
_GROUP_METRICS = {
    "rows": (M.rows, lambda uv: F.sum("rows")),
    "uv": (M.uv, lambda uv: uv),
    "views": (M.views, lambda uv: F.sum("views")),
    "visits": (M.visits, lambda uv: F.sum("visits")),
    "likes": (M.likes, lambda uv: F.sum("likes")),
    "comments": (M.comments, lambda uv: F.sum("comments")),
    "engagements": (M.engagements, lambda uv: F.sum("likes") + F.sum("comments")),
    "pages": (M.pages, lambda uv: F.count_distinct("marketingpageid")),
    "rate2": (lambda: M.engagement_rate(2),
              lambda uv: M.pct_null(F.sum("likes") + F.sum("comments"), F.sum("views"), 2)),
    "rate3": (lambda: M.engagement_rate(3),
              lambda uv: M.pct_null(F.sum("likes") + F.sum("comments"), F.sum("views"), 3)),
    "views_per_visitor": (lambda: M.per_visitor(M.views(), 2),
                          lambda uv: F.round(M.ratio_null(F.sum("views"), uv), 2)),
    "avg_duration": (lambda: F.round(F.avg("durationavg"), 1),
                     lambda uv: F.round(F.try_divide(F.sum("davg_sum"), F.sum("davg_n").cast("double")), 1)),
    "likes0": (M.likes_count, lambda uv: F.coalesce(F.sum("likes"), F.lit(0).cast("long"))),
    "comments0": (lambda: F.coalesce(M.comments(), F.lit(0).cast("long")),
                  lambda uv: F.coalesce(F.sum("comments"), F.lit(0).cast("long"))),
    "engagements0": (M.engagements_zero,
                     lambda uv: F.coalesce(F.sum("likes"), F.lit(0).cast("long"))
                     + F.coalesce(F.sum("comments"), F.lit(0).cast("long"))),
    "rate0": (M.engagement_rate_zero,
              lambda uv: M.pct_zero(F.coalesce(F.sum("likes"), F.lit(0).cast("long"))
                                    + F.coalesce(F.sum("comments"), F.lit(0).cast("long")), F.sum("views"))),
}
_PARTIAL_SUMS = ("rows", "views", "visits", "likes", "comments", "davg_sum", "davg_n")


def _page_filter_parts(filters: Filters):
    """(fact-only filters, predicate on page columns or None)."""
    fact_eq = tuple((k, v) for k, v in filters.equals if k not in _PAGE_COLS)
    page_eq = tuple((k, v) for k, v in filters.equals if k in _PAGE_COLS)
    fact_only = Filters(date_from=filters.date_from, date_to=filters.date_to, equals=fact_eq)
    page_only = Filters(website=filters.website, page_url=filters.page_url, page_name=filters.page_name,
                        equals=page_eq)
    return fact_only, page_only.predicate()


def page_visitors(model: StarModel, filters: Filters = NO_FILTERS, keys=(), date=None) -> DataFrame:
    """Fact rows pre-aggregated per (page, visitor, keys), over large inputs in tasks sized by input.
    There, rows without a visitor, which a hot page may have many of, are one row per day, so no task gets all of them."""
    w = model.wide(filters, page=None, date=date)
    apart = []
    if n := tasks_for(model.fact):
        apart = ["_anon_day"]
        w = dealt(w.withColumn("_anon_day", F.when(F.col("viewingcontactid").isNull(), F.col("visitdatekey"))), n,
                  "marketingpageid", "viewingcontactid", *apart)
    return w.groupBy("marketingpageid", "viewingcontactid", *apart, *keys).agg(
        M.rows().alias("rows"), M.views().alias("views"), M.visits().alias("visits"),
        M.likes().alias("likes"), M.comments().alias("comments"),
        F.sum("durationavg").alias("davg_sum"), F.count("durationavg").alias("davg_n")).drop("_anon_day")


def page_partials(model: StarModel, filters: Filters = NO_FILTERS, keys=(), date=None, per_page: bool = False) -> DataFrame:
    """Fact rows pre-aggregated per (page, visitor, keys), then joined to the
    page inventory: the plan for page-grouped reports.  The fact is shuffled once, already reduced (and a
    hot page's rows are spread over its visitors), before the page join.
    Page filters apply after the join, so orphans drop out as in M7.

    ``per_page`` goes on to one row per (page, keys), with its number of visitors as ``uv``, before the join: reports
    grouped by the page id need no visitor beside the page's wide attributes.  Other reports meet the attributes in
    small tasks of (page, visitor, keys) rows, apart from the task that made the rows; a task that joins large tables
    hashes its pages and streams the rows, so its memory follows the inventory (and AQE splits a hot page)."""
    fact_only, page_pred = _page_filter_parts(filters)
    per = page_visitors(model, fact_only, keys, date)
    if per_page:
        # a (page, visitor, keys) group is one row where it has a visitor, so visitors are counted, not told apart again
        per = per.groupBy("marketingpageid", *keys).agg(
            F.count("viewingcontactid").alias("uv"), *[F.sum(c).alias(c) for c in _PARTIAL_SUMS])
        j = per.join(model.page_inventory, "marketingpageid", "left")
    elif n := tasks_for(model.fact):
        pages = model.page_inventory if fits_broadcast(model.page_inventory) else model.page_inventory.hint("shuffle_hash")
        j = dealt(per, n, "marketingpageid", "viewingcontactid", *keys).join(bounded_broadcast(pages), "marketingpageid", "left")
    else:
        j = per.join(model.page_inventory, "marketingpageid", "left")
    return j.filter(page_pred) if page_pred is not None else j


def page_grouped(model: StarModel, filters: Filters, keys: list, metrics: list, fact_keys=(),
                 date=None, per_page: bool = False) -> DataFrame:
    """Group by page attributes (``keys`` are Columns over the joined star)
    with named re-aggregatable metrics [(alias, name)], from (page, visitor)
    rows: one plan at every size, in which Spark picks the type of the
    page join.  ``per_page``: the page id and all ``fact_keys`` are among the keys, so rows of whole pages do
    (repeated inventory rows repeat sums, not visitors)."""
    if filters.uses_employee():
        w = model.wide(filters, page="left", date=date)
        return w.groupBy(*keys).agg(*[_GROUP_METRICS[n][0]().alias(a) for a, n in metrics])
    j = page_partials(model, filters, keys=fact_keys, date=date, per_page=per_page)
    uv = F.max("uv") if per_page else F.count_distinct("viewingcontactid")
    return j.groupBy(*keys).agg(*[_GROUP_METRICS[n][1](uv).alias(a) for a, n in metrics])


_BASE = [("unique_visitors", "uv"), ("total_views", "views"), ("total_visits", "visits"),
         ("likes", "likes"), ("comments", "comments"), ("engagements", "engagements")]


# ------------------------------------------------------------------ QRY-1..5
def summary(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """QRY-1: one row of dataset totals."""
    w = model.wide(filters, page="left")
    return w.agg(
        M.rows().alias("total_rows"),
        M.days().alias("days_covered"),
        F.min("visitdatekey").alias("first_date"),
        F.max("visitdatekey").alias("last_date"),
        M.pages().alias("unique_pages"),
        M.uv().alias("total_unique_visitors"),
        M.views().alias("total_views"),
        M.visits().alias("total_visits"),
        M.likes().alias("total_likes"),
        M.comments().alias("total_comments"),
        M.engagements().alias("total_engagements"),
    )


def daily_uv(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """QRY-2: base metrics per calendar day (calendar inner join, M6)."""
    w = model.wide(filters, page="left", date="inner")
    return (w.groupBy("date", "day_name", "is_weekend").agg(*M.base_metrics())
            .orderBy("date"))


def _period_uv(model, filters, keys, start_name, days_name):
    w = model.wide(filters, page="left", date="inner")
    out = w.groupBy(*keys).agg(
        F.min("date").alias(start_name), *M.base_metrics(),
        F.count_distinct("date").alias(days_name))
    return out.orderBy(start_name)


def weekly_uv(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """QRY-3: ISO weeks; UV counted across the week, not summed from days."""
    return _period_uv(model, filters, ["year_week"], "week_start", "days_in_week")


def monthly_uv(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """QRY-4: calendar months."""
    return _period_uv(model, filters, ["year_month", "month_name"], "month_start", "days_in_month")


def quarterly_uv(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """QRY-5: calendar quarters."""
    return _period_uv(model, filters, ["year_quarter"], "quarter_start", "days_in_quarter")


# ----------------------------------------------------------------- QRY-6..15
def uv_by_website(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """QRY-6."""
    g = page_grouped(model, filters, [M.label("websitename").alias("website")],
                     _BASE + [("pages_viewed", "pages")])
    return g.orderBy(F.desc("unique_visitors"), *_asc("website"))


def uv_by_theme(model: StarModel, filters: Filters = NO_FILTERS, limit: int = 20) -> DataFrame:
    """QRY-7: top themes by UV."""
    g = page_grouped(model, filters, [M.label("theme").alias("theme")], [
        ("unique_visitors", "uv"), ("total_views", "views"), ("likes", "likes"), ("comments", "comments"),
        ("engagements", "engagements"), ("pages_in_theme", "pages")])
    return top_k(g, [F.desc("unique_visitors")], ["theme"], limit)


def daily_engagement(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """QRY-8: likes, comments and engagement rate per day."""
    w = model.wide(filters, page="left", date="inner")
    return (w.groupBy("date", "day_name", "is_weekend").agg(
        M.likes().alias("likes"), M.comments().alias("comments"),
        M.engagements().alias("total_engagements"), M.views().alias("views"),
        M.engagement_rate(3).alias("engagement_rate_pct")).orderBy("date"))


_PAGE_KEY4 = ["marketingpageid", "pagename", "websitename"]


def top_engaged_pages(model: StarModel, filters: Filters = NO_FILTERS, limit: int = 25) -> DataFrame:
    """QRY-9: pages with engagement > 0, most engaged first."""
    keys = _PAGE_KEY4 + ["theme"]
    g = page_grouped(model, filters, [F.col(k) for k in keys], [
        ("likes", "likes"), ("comments", "comments"), ("total_engagements", "engagements"),
        ("total_views", "views"), ("unique_visitors", "uv"), ("engagement_rate_pct", "rate2")], per_page=True)
    g = g.filter(F.col("total_engagements") > 0)
    return top_k(g, [F.desc("total_engagements")], keys, limit)


def engagement_by_contenttype(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """QRY-10."""
    g = page_grouped(model, filters, [M.label("contenttype").alias("content_type")], [
        ("likes", "likes"), ("comments", "comments"), ("total_engagements", "engagements"),
        ("total_views", "views"), ("unique_visitors", "uv"), ("engagement_rate_pct", "rate3")])
    return g.orderBy(F.desc_nulls_last("total_engagements"), *_asc("content_type"))


def top_pages_by_views(model: StarModel, filters: Filters = NO_FILTERS, limit: int = 25) -> DataFrame:
    """QRY-11."""
    keys = _PAGE_KEY4 + ["fullpageurl"]
    g = page_grouped(model, filters, [F.col(k) for k in keys], [
        ("total_views", "views"), ("total_visits", "visits"), ("unique_visitors", "uv"),
        ("likes", "likes"), ("comments", "comments"), ("avg_duration_sec", "avg_duration")], per_page=True)
    return top_k(g, [F.desc_nulls_last("total_views")], keys, limit)


def top_pages_by_uv(model: StarModel, filters: Filters = NO_FILTERS, limit: int = 25) -> DataFrame:
    """QRY-12."""
    keys = _PAGE_KEY4 + ["fullpageurl"]
    g = page_grouped(model, filters, [F.col(k) for k in keys], [
        ("unique_visitors", "uv"), ("total_views", "views"), ("views_per_visitor", "views_per_visitor"),
        ("likes", "likes"), ("comments", "comments")], per_page=True)
    return top_k(g, [F.desc("unique_visitors")], keys, limit)


def referrer_analysis(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """QRY-13: traffic per referrer channel."""
    w = model.wide(filters, page="left")
    return (w.groupBy("referrerapplicationid")
            .agg(*M.base_metrics(), M.pages().alias("pages_visited"))
            .orderBy(F.desc("unique_visitors"), *_asc("referrerapplicationid")))


def overall_engagement(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """QRY-14: one row of totals and per-visitor ratios (NULL with no visitor)."""
    w = model.wide(filters, page="left")
    return w.agg(
        M.uv().alias("total_uv"), M.views().alias("total_views"), M.visits().alias("total_visits"),
        M.likes().alias("total_likes"), M.comments().alias("total_comments"),
        M.engagements().alias("total_engagements"),
        M.per_visitor(M.views(), 2).alias("views_per_visitor"),
        M.per_visitor(M.visits(), 2).alias("visits_per_visitor"),
        M.per_visitor(M.likes(), 4).alias("likes_per_visitor"),
        M.per_visitor(M.comments(), 4).alias("comments_per_visitor"),
        M.per_visitor(M.engagements(), 4).alias("engagements_per_visitor"),
        M.engagement_rate(3).alias("engagement_rate_pct"),
        F.round(M.ratio_null(F.sum("durationsum"), M.visits()), 1).alias("avg_duration_per_visit"),
    )


def rows_per_website(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """QRY-15: data volume per site."""
    g = page_grouped(model, filters, [M.label("websitename").alias("website")], [
        ("row_count", "rows"), ("total_views", "views"), ("unique_visitors", "uv")])
    return g.orderBy(F.desc("row_count"), *_asc("website"))


# ---------------------------------------------------------------- QRY-16..20
def daily_uv_chart(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    w = model.wide(filters, page="left", date="inner")
    return w.groupBy("date").agg(M.uv().alias("unique_visitors"), M.views().alias("views"))


def daily_uv_ma7(model: StarModel, filters: Filters = NO_FILTERS, window: int = 7) -> DataFrame:
    """QRY-16: daily UV with a 7-row moving average (NULL until 7 rows)."""
    from ..operators.trends import moving_average
    return moving_average(daily_uv_chart(model, filters), "unique_visitors", "date",
                          window, out="uv_ma7").orderBy("date")


def peak_day(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """QRY-17: the day with the most visitors (earliest on ties)."""
    from ..operators.reshape import arg_extremes
    return arg_extremes(daily_uv_chart(model, filters), "unique_visitors", "date")


def top15_pages_chart(model: StarModel, filters: Filters = NO_FILTERS, limit: int = 15) -> DataFrame:
    """QRY-18: top pages by UV with a display label cut at 43 chars."""
    g = page_grouped(model, filters, [F.coalesce("pagename", "marketingpageid").alias("page")], [
        ("unique_visitors", "uv"), ("total_views", "views")])
    return top_k(g, [F.desc("unique_visitors")], ["page"], limit).withColumn(
        "page_short", M.truncate_label("page"))


def uv_by_website_chart(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """QRY-19: UV per site plus the (double-counting) sum of site UVs."""
    g = page_grouped(model, filters, [M.label("websitename").alias("website")], [
        ("unique_visitors", "uv"), ("total_views", "views")])
    # one row per site: the un-partitioned window runs over a small result
    return g.withColumn("sum_of_site_uv", F.sum("unique_visitors").over(Window.partitionBy())) \
            .orderBy(F.desc("unique_visitors"), *_asc("website"))


def engagement_chart(model: StarModel, filters: Filters = NO_FILTERS, limit: int = 15) -> DataFrame:
    """QRY-20."""
    g = page_grouped(model, filters, [M.label("contenttype").alias("content_type")], [
        ("likes", "likes"), ("comments", "comments"), ("total_engagements", "engagements")])
    g = g.filter(F.col("total_engagements") > 0)
    return top_k(g, [F.desc("total_engagements")], ["content_type"], limit)


# ---------------------------------------------------------------- QRY-21..28
def _split_employee_filters(filters: Filters):
    emp = tuple((k, v) for k, v in filters.equals if k in _EMP_COLS)
    rest = filters.replace(equals=tuple((k, v) for k, v in filters.equals if k not in _EMP_COLS))
    pred = None
    for k, vals in emp:
        p = F.col(k).isin(list(vals))
        pred = p if pred is None else pred & p
    return rest, pred


def visitor_partials(model: StarModel, filters: Filters = NO_FILTERS, keys=(), date=None,
                     distinct=(), page: str | None = "left", how: str = "left") -> DataFrame:
    """Fact rows pre-aggregated per (keys, visitor), then joined to employees.

    Carries partial sums (views, visits, likes, comments, durationsum,
    rows) and, for each name in ``distinct``, the per-visitor distinct
    count of that column.  ``how`` is the employee join type; employee
    filters apply after the join.  Unused partial sums are pruned by
    Catalyst, so distinct-only callers pay for the visitor key alone.
    """
    rest, emp_pred = _split_employee_filters(filters)
    w = model.wide(rest, page=page, date=date)
    aggs = [M.views().alias("views"), M.visits().alias("visits"), M.likes().alias("likes"),
            M.comments().alias("comments"), F.sum("durationsum").alias("durationsum"),
            M.rows().alias("rows")]
    aggs += [F.count_distinct(x).alias(f"n_{x}") for x in distinct]
    per = w.groupBy(*keys, "viewingcontactid").agg(*aggs)
    e = model.employees()
    j = per.join(e, per["viewingcontactid"] == e["contactid"], how)
    return j.filter(emp_pred) if emp_pred is not None else j


def _employee_metrics(rate_digits=3) -> list[Column]:
    likes, comments, views = F.sum("likes"), F.sum("comments"), F.sum("views")
    eng = likes + comments
    return [
        F.count_distinct("viewingcontactid").alias("unique_visitors"),
        views.alias("total_views"), F.sum("visits").alias("total_visits"),
        likes.alias("likes"), comments.alias("comments"), eng.alias("engagements"),
        M.pct_null(eng, views, rate_digits).alias("engagement_rate_pct"),
    ]


def uv_by_region(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """QRY-21."""
    j = visitor_partials(model, filters)
    return (j.groupBy(M.label("employeeregion").alias("region")).agg(*_employee_metrics())
            .orderBy(F.desc("unique_visitors"), *_asc("region")))


def uv_by_division(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """QRY-22."""
    j = visitor_partials(model, filters)
    return (j.groupBy(M.label("employeebusinessdivision").alias("business_division"))
            .agg(*_employee_metrics())
            .orderBy(F.desc("unique_visitors"), *_asc("business_division")))


def region_x_division(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """QRY-23."""
    j = visitor_partials(model, filters)
    return (j.groupBy(M.label("employeeregion").alias("region"),
                      M.label("employeebusinessdivision").alias("business_division"))
            .agg(F.count_distinct("viewingcontactid").alias("unique_visitors"),
                 F.sum("views").alias("total_views"),
                 (F.sum("likes") + F.sum("comments")).alias("engagements"))
            .orderBy(*_asc("region"), F.desc("unique_visitors"), *_asc("business_division")))


def region_division_matrix(model: StarModel, filters: Filters = NO_FILTERS, regions=None) -> DataFrame:
    """QRY-24: QRY-23 pivoted (division x region UV), 0-filled, with Total."""
    rxd = region_x_division(model, filters)
    m = pivot_matrix(rxd, "business_division", "region", "unique_visitors", agg="sum",
                     values=regions, fill=0, total="Total")
    return m.orderBy(F.desc("Total"), *_asc("business_division"))


def top_visitors(model: StarModel, filters: Filters = NO_FILTERS, limit: int = 50) -> DataFrame:
    """QRY-25: most active visitors, shown by division/region/class only."""
    j = visitor_partials(model, filters, distinct=("marketingpageid", "visitdatekey"))
    raw = ["employeebusinessdivision", "employeeregion", "employeeclass"]
    g = j.groupBy("viewingcontactid", *raw).agg(
        F.max("n_marketingpageid").alias("pages_visited"),
        F.sum("views").alias("total_views"), F.sum("visits").alias("total_visits"),
        F.sum("likes").alias("likes"), F.sum("comments").alias("comments"),
        F.max("n_visitdatekey").alias("days_active"))
    top = top_k(g, [F.desc_nulls_last("total_views")], ["viewingcontactid"] + raw, limit)
    return top.select(
        M.label("employeebusinessdivision").alias("business_division"),
        M.label("employeeregion").alias("region"),
        M.label("employeeclass").alias("employee_class"),
        "pages_visited", "total_views", "total_visits", "likes", "comments", "days_active")


def monthly_uv_by_region(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """QRY-26."""
    j = visitor_partials(model, filters, keys=("year_month",), date="inner")
    return (j.groupBy("year_month", M.label("employeeregion").alias("region"))
            .agg(F.count_distinct("viewingcontactid").alias("unique_visitors"),
                 F.sum("views").alias("total_views"))
            .orderBy("year_month", F.desc("unique_visitors"), *_asc("region")))


def monthly_region_matrix(model: StarModel, filters: Filters = NO_FILTERS, regions=None) -> DataFrame:
    """QRY-27: QRY-26 pivoted, months x regions, mean of one value per cell."""
    mr = monthly_uv_by_region(model, filters)
    return pivot_matrix(mr, "year_month", "region", "unique_visitors", agg="avg",
                        values=regions, fill=0.0).orderBy("year_month")


def employee_count(model: StarModel) -> DataFrame:
    """QRY-28: rows in employee_contact."""
    return model.employee_contact.agg(M.rows().alias("employee_count"))


# ------------------------------------------------------------------ DOC-1..5
def doc_uv_by_region(model: StarModel, date_from, date_to) -> DataFrame:
    """DOC-1: raw region (NULL kept) for a day range."""
    j = visitor_partials(model, Filters(date_from=date_from, date_to=date_to), page=None)
    return (j.groupBy("employeeregion").agg(F.count_distinct("viewingcontactid").alias("unique_visitors"))
            .orderBy(F.desc("unique_visitors"), *_asc("employeeregion")))


def doc_views_by_website_month(model: StarModel) -> DataFrame:
    """DOC-2: inner joins to pages and calendar."""
    w = model.wide(NO_FILTERS, page="inner", date="inner")
    return (w.groupBy("websitename", "year_month").agg(
        M.views().alias("total_views"), M.uv().alias("unique_visitors"))
        .orderBy("year_month", F.desc("total_views"), *_asc("websitename")))


def doc_top_pages(model: StarModel, limit: int = 20) -> DataFrame:
    """DOC-3: top (pagename, websitename) by views."""
    w = model.wide(NO_FILTERS, page="inner")
    g = w.groupBy("pagename", "websitename").agg(
        M.views().alias("total_views"), M.uv().alias("unique_visitors"),
        M.likes().alias("likes"), M.comments().alias("comments"))
    return top_k(g, [F.desc_nulls_last("total_views")], ["pagename", "websitename"], limit)


def doc_traffic_by_channel(model: StarModel) -> DataFrame:
    """DOC-4."""
    return (model.fact.groupBy(F.col("referrerapplicationid").alias("channel"))
            .agg(M.uv().alias("unique_visitors"), M.views().alias("total_views"))
            .orderBy(F.desc("unique_visitors"), *_asc("channel")))


def doc_class_distribution(model: StarModel, date_from, date_to) -> DataFrame:
    """DOC-5."""
    j = visitor_partials(model, Filters(date_from=date_from, date_to=date_to), page=None)
    return (j.groupBy("employeeclass").agg(F.count_distinct("viewingcontactid").alias("unique_visitors"))
            .orderBy(F.desc("unique_visitors"), *_asc("employeeclass")))


# ---------------------------------------------------------------------- ASK-1
# metrics that can be rebuilt from per-visitor partial sums (see visitor_partials)
_PARTIAL_METRICS = {
    "rows": lambda: F.sum("rows"),
    "uv": lambda: F.count_distinct("viewingcontactid"),
    "views": lambda: F.sum("views"),
    "visits": lambda: F.sum("visits"),
    "likes": lambda: F.sum("likes"),
    "comments": lambda: F.sum("comments"),
    "engagements": lambda: F.sum("likes") + F.sum("comments"),
    "engagement_rate": lambda: M.pct_null(F.sum("likes") + F.sum("comments"), F.sum("views"), 3),
}


def report(model: StarModel, by, metrics=("uv", "views"), filters: Filters = NO_FILTERS,
           order_by=None, limit: int | None = None, label_unknown: bool = True,
           eager: bool = True) -> DataFrame:
    """Generic slice-and-dice: group by any star columns, any named metrics.

    Page and employee attributes are labelled 'Unknown' when unmatched;
    the calendar is joined (inner) only when a calendar column is asked for.
    Grouped by employee attributes with re-aggregatable metrics, the fact
    is first reduced per visitor (``eager``), as in QRY-21..27.
    """
    by = [by] if isinstance(by, str) else list(by)
    metrics = list(metrics)
    need_date = any(b in _DATE_COLS for b in by)
    need_emp = any(b in _EMP_COLS for b in by) or filters.uses_employee()
    keys = [M.label(b).alias(b) if label_unknown and (b in _PAGE_COLS or b in _EMP_COLS)
            else F.col(b) for b in by]
    as_group = {"engagement_rate": "rate3"}
    if eager and need_emp and all(m in _PARTIAL_METRICS for m in metrics):
        raw = [b for b in by if b not in _EMP_COLS]
        j = visitor_partials(model, filters, keys=raw, date="inner" if need_date else None)
        g = j.groupBy(*keys).agg(*[_PARTIAL_METRICS[m]().alias(m) for m in metrics])
    elif (eager and any(b in _PAGE_COLS for b in by)
          and all(as_group.get(m, m) in _GROUP_METRICS for m in metrics)):
        fact_keys = [b for b in by if b not in _PAGE_COLS]
        g = page_grouped(model, filters, keys, [(m, as_group.get(m, m)) for m in metrics],
                         fact_keys=fact_keys, date="inner" if need_date else None)
    else:
        w = model.wide(filters, page="left", date="inner" if need_date else None,
                       employee="left" if need_emp else None)
        g = w.groupBy(*keys).agg(*[M.metric(m) for m in metrics])
    order = order_by or [F.desc_nulls_last(metrics[0])]
    order = [F.desc_nulls_last(o) if isinstance(o, str) else o for o in order]
    if limit:
        return top_k(g, order, by, limit)
    return g.orderBy(*order, *_asc(*by))
