"""Named measures (MEA-1..38): ``measure(model, by=[...], filters) -> DataFrame``.

A measure returns the ``by`` columns plus its value column(s); ``by=[]``
gives one row.  The BI semantics are mapped as follows:

* CALCULATE(m, cond)   -> a conditional aggregate (``when`` inside the agg)
* ALL / ALLEXCEPT      -> the same aggregate at a coarser grain, joined back
* iterators (SUMMARIZE / AVERAGEX) -> two-level aggregation, per visitor or
  per day first; the inner level is a regular partial+final aggregation,
  so a hot visitor or day is combined map-side before any shuffle.
* DIVIDE(a, b, 0)      -> ``ratio_zero`` (0 on a zero or missing divisor)

Grouping columns from page or employee attributes are labelled 'Unknown'
when unmatched, as in the reports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions.filters import NO_FILTERS, Filters
from ..model import StarModel, dealt, tasks_for
from ..operators.ranking import dense_ranks
from ..operators.trends import null_safe_left, period_change, rolling_distinct, rolling_distinct_approx
from ..schemas import DATE_COLUMNS, EMPLOYEE_COLUMNS, PAGE_COLUMNS
from ..session import written

_DATE_COLS = {n for n, _ in DATE_COLUMNS}
_EMP_COLS = {n for n, _, _ in EMPLOYEE_COLUMNS}
_PAGE_COLS = {n for n, _, _ in PAGE_COLUMNS} - {"marketingpageid"}

DEFAULT_TOTAL_EMPLOYEES = 75000        # fixed value: the guide's placeholder workforce size
REACH_TARGET_PCT = 80.0                # fixed value: KPI target
LEADERSHIP_CATEGORIES = ("Strategy", "Culture", "Thought leadership")   # fixed values


def _by(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by or [])


def wide_for(model: StarModel, by, filters: Filters = NO_FILTERS, need=(),
             distinct_only: bool = False) -> DataFrame:
    """The star joined just enough for ``by`` + ``need`` columns.

    The page LEFT join is kept by default because duplicate page keys fan
    out sums (M8).  Measures made only of distinct counts are immune to
    that fan-out, so with ``distinct_only`` the join is dropped unless a
    page column is grouped on or filtered."""
    cols = set(_by(by)) | set(need)
    date = "inner" if cols & _DATE_COLS else None
    emp = "left" if (cols & _EMP_COLS) or filters.uses_employee() else None
    page = None if distinct_only and not (cols & _PAGE_COLS) else "left"
    if distinct_only and emp:
        # only (columns, visitor) pairs matter: reduce the fact to distinct
        # pairs before the employee join, then apply employee filters
        from .reports import _split_employee_filters
        rest, emp_pred = _split_employee_filters(filters)
        w = model.wide(rest, page=page, date=date)
        keep = sorted(c for c in cols if c not in _EMP_COLS) + ["viewingcontactid"]
        per = w.select(*keep).distinct()
        e = model.employees()
        j = per.join(e, per["viewingcontactid"] == e["contactid"], "left")
        return j.filter(emp_pred) if emp_pred is not None else j
    return model.wide(filters, page=page, date=date, employee=emp)


def _keys(by) -> list[Column]:
    return [M.label(b).alias(b) if (b in _PAGE_COLS or b in _EMP_COLS) else F.col(b) for b in _by(by)]


def _agg(model, by, filters, cols: list[Column], need=()) -> DataFrame:
    w = wide_for(model, by, filters, need)
    keys = _keys(by)
    return w.groupBy(*keys).agg(*cols) if keys else w.agg(*cols)


# ---------------------------------------------------------------- MEA-1..7
def core_measures(model: StarModel, by=(), filters: Filters = NO_FILTERS) -> DataFrame:
    """MEA-1..7: UV, Total Views, Total Visits, Likes, Comments,
    Engagements (blank = 0) and Engagement Rate (DIVIDE(..,0) * 100).

    By employee attributes, the fact is reduced per visitor first."""
    names = _by(by)
    if any(b in _EMP_COLS for b in names) or filters.uses_employee():
        raw = [b for b in names if b not in _EMP_COLS]
        v = _visitors(model, filters, keys=tuple(F.col(b) for b in raw),
                      date="inner" if set(names) & _DATE_COLS else None)
        z = F.lit(0).cast("long")
        lk, cm, vw = F.coalesce(F.sum("likes"), z), F.sum("comments"), F.sum("views")
        eng = lk + F.coalesce(cm, z)
        cols = [F.count_distinct("viewingcontactid").alias("uv"), vw.alias("total_views"),
                F.sum("visits").alias("total_visits"), lk.alias("likes"), cm.alias("comments"),
                eng.alias("engagements"), M.pct_zero(eng, vw).alias("engagement_rate")]
        keys = _keys(names)
        return v.groupBy(*keys).agg(*cols) if keys else v.agg(*cols)
    return _agg(model, by, filters, [
        M.uv().alias("uv"), M.views().alias("total_views"), M.visits().alias("total_visits"),
        M.likes_count().alias("likes"), M.comments().alias("comments"),
        M.engagements_zero().alias("engagements"), M.engagement_rate_zero().alias("engagement_rate"),
    ])


# --------------------------------------------------------------- MEA-8..14
def total_employees(model: StarModel, fixed: int | None = None) -> Column:
    """MEA-8: a fixed workforce size, or the employee table's distinct ids."""
    if fixed is not None or model.employee_contact is None:
        return F.lit(int(fixed if fixed is not None else DEFAULT_TOTAL_EMPLOYEES)).cast("long")
    return model.employee_contact.select(F.count_distinct("contactid")).scalar()


def reach_rate(model: StarModel, by=(), filters: Filters = NO_FILTERS,
               employees: int | None = None) -> DataFrame:
    """MEA-9 (and MEA-38 Message Penetration): UV / Total Employees * 100."""
    w = wide_for(model, by, filters, distinct_only=True)
    keys = _keys(by)
    g = w.groupBy(*keys).agg(M.uv().alias("uv")) if keys else w.agg(M.uv().alias("uv"))
    tot = total_employees(model, employees)
    return g.withColumn("total_employees", tot).withColumn(
        "reach_rate", M.pct_zero(F.col("uv"), F.col("total_employees")))


def daily_average_uv(model: StarModel, by=(), filters: Filters = NO_FILTERS) -> DataFrame:
    """MEA-10: mean of daily UV over the days that have visits."""
    w = wide_for(model, by, filters, need=("date",), distinct_only=True)
    keys = _keys(by)
    daily = w.groupBy(*keys, "date").agg(M.uv().alias("_uv"))
    names = _by(by)
    out = daily.groupBy(*names).agg(F.avg("_uv").alias("daily_average_uv")) if names \
        else daily.agg(F.avg("_uv").alias("daily_average_uv"))
    return out


def reach_by_segment(model: StarModel, segment: str = "employeeregion",
                     filters: Filters = NO_FILTERS) -> DataFrame:
    """MEA-11 / MEA-12 (JOIN-9): UV of a segment / its employees * 100.

    Segments come from the employee table, so segments without any
    viewer stay listed with reach 0 (ASK-16).  The population ignores the
    report filters (ALLEXCEPT on the segment column).
    """
    pop = (model.employee_contact.groupBy(M.label(segment).alias(segment))
           .agg(F.count_distinct("contactid").alias("employees")))
    # visitors are reduced to one row each before the employee join
    v = _visitors(model, filters, how="inner")
    seen = v.groupBy(M.label(segment).alias(segment)).agg(F.count_distinct("viewingcontactid").alias("uv"))
    j = pop.join(seen, segment, "left").fillna(0, subset=["uv"])
    return j.withColumn("reach_rate", M.pct_zero(F.col("uv"), F.col("employees")))


def _visitors(model: StarModel, filters: Filters, keys=(), how: str = "left", page: str | None = "left",
              date=None) -> DataFrame:
    """Fact pre-aggregated per (keys, visitor) and joined to employees."""
    from .reports import visitor_partials
    return visitor_partials(model, filters, keys=keys, date=date, page=page, how=how)


def monthly_uv(model: StarModel, by=(), filters: Filters = NO_FILTERS) -> DataFrame:
    w = wide_for(model, by, filters, need=("date", "year_month"), distinct_only=True)
    return w.groupBy(*_keys(by), "year_month", F.trunc("date", "MM").alias("month_start")) \
            .agg(M.uv().alias("uv"))


def reach_mom_change(model: StarModel, by=(), filters: Filters = NO_FILTERS) -> DataFrame:
    """MEA-13: (UV - previous month UV) / previous month UV * 100; 0 when the
    previous month is absent or 0.  Previous = the calendar month before,
    found by joining on the shifted month key (a gap month compares with
    nothing, not with the month before the gap)."""
    m = monthly_uv(model, by, filters)
    return period_change(m, "month_start", "uv", "month", 1, by=_by(by),
                         prev_out="prev_month_uv", change_out="mom_change_pct")


def reach_trend_6m(model: StarModel, filters: Filters = NO_FILTERS, months: int = 6,
                   by=(), approx: bool = False) -> DataFrame:
    """MEA-14: per month with data, UV over the 6 months ending at the
    month's last day (DATESINPERIOD(date, MAX(date), -6, MONTH)).
    ``approx=True`` uses daily HLL sketches instead of exact distincts."""
    names = _by(by)
    w = wide_for(model, names, filters, need=("date",), distinct_only=True)
    visits = w.select(*_keys(names), "viewingcontactid", "date")
    fn = rolling_distinct_approx if approx else rolling_distinct
    return fn(visits, "viewingcontactid", "date", months, out="uv_6m", by=names)


# -------------------------------------------------------------- MEA-15..24
def _page_partials_apply(by, filters) -> bool:
    """Whether (page, visitor) rows carry what a measure needs: no employee column is involved."""
    return not (set(_by(by)) & _EMP_COLS) and not filters.uses_employee()


def _per_visitor(model, by, filters, flags: dict[str, Column], need=("contenttype",),
                 partial_flags: dict[str, Column] | None = None):
    """Per (by, visitor): max of each boolean flag and distinct pages.

    ``partial_flags`` are the same flags over ``page_partials`` rows (sums
    per page and visitor)."""
    keys = _keys(by)
    if partial_flags is not None and _page_partials_apply(by, filters):
        from .reports import page_partials
        names = _by(by)
        j = page_partials(model, filters, keys=[b for b in names if b not in _PAGE_COLS],
                          date="inner" if set(names) & _DATE_COLS else None)
        return j.groupBy(*keys, "viewingcontactid").agg(
            *[F.max(c).alias(n) for n, c in partial_flags.items()],
            F.count_distinct("marketingpageid").alias("_pages"))
    names = _by(by)
    if (set(names) & _EMP_COLS) or filters.uses_employee():
        # flags are per row (page/fact attributes): max them per (fact keys,
        # visitor) first, join employees to one row per visitor, re-max
        from .reports import _split_employee_filters
        rest, emp_pred = _split_employee_filters(filters)
        raw = [b for b in names if b not in _EMP_COLS]
        base = model.wide(rest, page="left", date="inner" if set(raw) & _DATE_COLS else None)
        per = base.groupBy(*_keys(raw), "viewingcontactid").agg(
            *[F.max(c).alias(n) for n, c in flags.items()],
            F.count_distinct("marketingpageid").alias("_pages"))
        e = model.employees()
        j = per.join(e, per["viewingcontactid"] == e["contactid"], "left")
        if emp_pred is not None:
            j = j.filter(emp_pred)
        ekeys = [F.col(b) for b in raw] + _keys([b for b in names if b in _EMP_COLS])
        return j.groupBy(*ekeys, "viewingcontactid").agg(
            *[F.max(n).alias(n) for n in flags], F.max("_pages").alias("_pages"))
    w = wide_for(model, by, filters, need)
    aggs = [F.max(c).alias(n) for n, c in flags.items()]
    return w.groupBy(*keys, "viewingcontactid").agg(
        *aggs, F.count_distinct("marketingpageid").alias("_pages"))


def _outer(pv: DataFrame, by, cols: list[Column]) -> DataFrame:
    names = _by(by)
    return pv.groupBy(*names).agg(*cols) if names else pv.agg(*cols)


def homepage_article_ctr(model: StarModel, by=(), filters: Filters = NO_FILTERS) -> DataFrame:
    """MEA-15 Homepage Visitors, MEA-16 Article Visitors, MEA-17 CTR:
    visitors with both / homepage visitors * 100."""
    ct = F.col("contenttype")
    flags = {"_hp": F.coalesce(ct == "Homepage", F.lit(False)), "_ar": F.coalesce(ct == "Article", F.lit(False))}
    pv = _per_visitor(model, by, filters, flags, partial_flags=flags)
    pv = pv.where(F.col("viewingcontactid").isNotNull())
    out = _outer(pv, by, [F.count_if("_hp").alias("homepage_visitors"),
                          F.count_if("_ar").alias("article_visitors"),
                          F.count_if(F.col("_hp") & F.col("_ar")).alias("both_visitors")])
    return out.withColumn("homepage_to_article_ctr",
                          M.pct_zero(F.col("both_visitors"), F.col("homepage_visitors")))


def journey_depth(model: StarModel, by=(), filters: Filters = NO_FILTERS, eager: bool = True) -> DataFrame:
    """MEA-18 Multi-Page Visitors, MEA-19 Multi-Page Rate, MEA-20 Avg Pages
    per Visitor (distinct pages / UV, literal), MEA-21 Views per Visitor,
    plus the true mean of pages per visitor.

    By employee attributes (``eager``), the fact is reduced to views per
    (keys, visitor, page) before the employee join."""
    names = _by(by)
    if eager and ((set(names) & _EMP_COLS) or filters.uses_employee()):
        from .reports import _split_employee_filters
        rest, emp_pred = _split_employee_filters(filters)
        raw = [b for b in names if b not in _EMP_COLS]
        base = model.wide(rest, page="left", date="inner" if set(raw) & _DATE_COLS else None)
        part = base.groupBy(*_keys(raw), "viewingcontactid", "marketingpageid").agg(F.sum("views").alias("views"))
        e = model.employees()
        w = part.join(e, part["viewingcontactid"] == e["contactid"], "left")
        if emp_pred is not None:
            w = w.filter(emp_pred)
        keys = [F.col(b) for b in raw] + _keys([b for b in names if b in _EMP_COLS])
    else:
        w = wide_for(model, by, filters)
        keys = _keys(by)
    per = w.groupBy(*keys, "viewingcontactid").agg(
        F.count_distinct("marketingpageid").alias("_pages"), F.sum("views").alias("_views"))
    totals = [M.pages().alias("distinct_pages"), M.views().alias("total_views")]
    seen = per.where(F.col("viewingcontactid").isNotNull())
    inner = [F.count(F.lit(1)).alias("uv"), F.count_if(F.col("_pages") > 1).alias("multi_page_visitors"),
             F.avg("_pages").alias("mean_pages_per_visitor")]
    if names:
        tot = w.groupBy(*keys).agg(*totals)
        j = null_safe_left(tot, seen.groupBy(*names).agg(*inner), names)
    else:   # one row: the totals are scalar subqueries, no join needed
        j = (seen.agg(*inner).withColumn("distinct_pages", w.select(M.pages()).scalar())
             .withColumn("total_views", w.select(M.views()).scalar()))
    j = j.fillna(0, subset=["uv", "multi_page_visitors"])
    return j.select(
        *names, "uv", "multi_page_visitors",
        M.pct_zero(F.col("multi_page_visitors"), F.col("uv")).alias("multi_page_rate"),
        M.ratio_zero(F.col("distinct_pages"), F.col("uv")).alias("avg_pages_per_visitor"),
        M.ratio_zero(F.col("total_views"), F.col("uv")).alias("views_per_visitor"),
        "mean_pages_per_visitor")


def engagement_conversion(model: StarModel, by=(), filters: Filters = NO_FILTERS) -> DataFrame:
    """MEA-22: visitors with at least one engaged row / UV * 100."""
    engaged_partial = (F.col("likes") > 0) | (F.coalesce(F.col("comments"), F.lit(0)) > 0)
    pv = _per_visitor(model, by, filters, {"_eng": M.is_engaged()}, need=(),
                      partial_flags={"_eng": engaged_partial})
    pv = pv.where(F.col("viewingcontactid").isNotNull())
    out = _outer(pv, by, [F.count(F.lit(1)).alias("uv"), F.count_if("_eng").alias("engaged_visitors")])
    return out.withColumn("engagement_conversion", M.pct_zero(F.col("engaged_visitors"), F.col("uv")))


def _conditional_uv_rate(model: StarModel, by, filters: Filters, conds: dict, need=()) -> DataFrame:
    """For each named row condition: UV of matching rows and their
    engagement rate (DIVIDE(..,0)), grouped by ``by``.

    With employee attributes in ``by`` or the filters, the fact is reduced
    per (fact/page keys, visitor) to per-condition partial sums first, and
    employees join one row per visitor."""
    names = _by(by)
    z = F.lit(0).cast("long")
    if _page_partials_apply(names, filters):
        from .reports import page_partials
        w = page_partials(model, filters, keys=[k for k in dict.fromkeys([*names, *need]) if k not in _PAGE_COLS],
                          date="inner" if set(names) & _DATE_COLS else None)
        cols = []
        for n, cond in conds.items():
            cond = F.coalesce(cond, F.lit(False))
            lk, cm = (F.coalesce(F.sum(F.when(cond, F.col(c))), z) for c in ("likes", "comments"))
            cols += [F.count_distinct(F.when(cond, F.col("viewingcontactid"))).alias(f"{n}_uv"),
                     M.pct_zero(lk + cm, F.sum(F.when(cond, F.col("views")))).alias(f"{n}_engagement_rate")]
        keys = _keys(names)
        return w.groupBy(*keys).agg(*cols) if keys else w.agg(*cols)
    from .reports import _split_employee_filters
    rest, emp_pred = _split_employee_filters(filters)
    raw = [b for b in names if b not in _EMP_COLS]
    w = model.wide(rest, page="left", date="inner" if set(raw) & _DATE_COLS else None)
    parts = []
    for n, cond in conds.items():
        cond = F.coalesce(cond, F.lit(False))
        parts += [F.count_if(cond & M.is_like()).alias(f"_l_{n}"),
                  F.sum(F.when(cond, F.col("comments"))).alias(f"_c_{n}"),
                  F.sum(F.when(cond, F.col("views"))).alias(f"_v_{n}"),
                  F.max(cond).alias(f"_a_{n}")]
    per = w.groupBy(*_keys(raw), "viewingcontactid").agg(*parts)
    e = model.employees()
    j = per.join(e, per["viewingcontactid"] == e["contactid"], "left")
    if emp_pred is not None:
        j = j.filter(emp_pred)
    cols = []
    for n in conds:
        lk = F.coalesce(F.sum(f"_l_{n}"), z)
        cm = F.coalesce(F.sum(f"_c_{n}"), z)
        cols += [F.count_distinct(F.when(F.col(f"_a_{n}"), F.col("viewingcontactid"))).alias(f"{n}_uv"),
                 M.pct_zero(lk + cm, F.sum(f"_v_{n}")).alias(f"{n}_engagement_rate")]
    keys = [F.col(b) for b in raw] + _keys([b for b in names if b in _EMP_COLS])
    return j.groupBy(*keys).agg(*cols) if keys else j.agg(*cols)


def channel_measures(model: StarModel, by=(), filters: Filters = NO_FILTERS,
                     channels=("Email", "Intranet")) -> DataFrame:
    """MEA-23 Email UV / Intranet UV, MEA-24 Email / Intranet Engagement Rate."""
    ref = F.col("referrerapplicationid")
    return _conditional_uv_rate(model, by, filters, {ch.lower(): ref == ch for ch in channels}, need=("referrerapplicationid",))


# -------------------------------------------------------------- MEA-25..30
def page_ranks(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """MEA-25: dense rank of page names by views, UV and engagements.

    The page-name aggregate is written once; ranks are found by ranges of
    distinct values (``operators.ranking``), never by a sort of all pages in
    one task."""
    w = model.wide(filters, page="inner")
    g = w.groupBy("pagename").agg(M.views().alias("total_views"), M.uv().alias("uv"),
                                  M.engagements_zero().alias("engagements"))
    return dense_ranks(written(g, "page_ranks"), {"total_views": "rank_by_views", "uv": "rank_by_uv",
                                                  "engagements": "rank_by_engagement"})


def _uv_and_rate(uv: Column | None = None) -> list[Column]:
    """UV and Engagement Rate (DIVIDE(..,0)) of rows with partial sums; ``uv``: the count of visitors, where rows tell them apart."""
    z = F.lit(0).cast("long")
    return [(F.count_distinct("viewingcontactid") if uv is None else uv).alias("uv"),
            M.pct_zero(F.coalesce(F.sum("likes"), z) + F.coalesce(F.sum("comments"), z), F.sum("views")).alias("engagement_rate")]


def _partials(model: StarModel, names, filters: Filters) -> DataFrame:
    """Rows with partial sums that carry the columns ``names``: per (page, visitor), or per visitor joined to employees."""
    date = "inner" if set(names) & _DATE_COLS else None
    if _page_partials_apply(names, filters):
        from .reports import page_partials
        return page_partials(model, filters, keys=[n for n in names if n not in _PAGE_COLS], date=date)
    return _visitors(model, filters, keys=tuple(b for b in names if b not in _EMP_COLS), date=date)


def attribute_context(model: StarModel, attribute: str = "theme", detail: str = "pagename",
                      filters: Filters = NO_FILTERS) -> DataFrame:
    """MEA-26 / MEA-27: on each (attribute, detail) row, the UV and the
    engagement rate of the attribute's whole group (ALLEXCEPT).

    Both levels come from one pass over the fact: its rows are dealt by (attribute, visitor), which brings the rows of
    a visitor's fine and coarse groups together, so tasks sized by input reduce them to a row per (group, visitor)
    and visitors are counted, not told apart again.  Rows without a visitor are dealt by page.  The result, a row per
    group, is written and read twice."""
    names = [attribute, detail]
    rows = _partials(model, names, filters).withColumns({f"_{n}": k for n, k in zip(names, _keys(names))})
    a, d = (f"_{n}" for n in names)
    anon = F.col("marketingpageid") if "marketingpageid" in rows.columns else F.lit(None)
    rows = dealt(rows.withColumn("_anon", F.when(F.col("viewingcontactid").isNull(), anon)), tasks_for(model.fact), a, "viewingcontactid", "_anon")
    both = rows.withColumn("_level", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(d, F.when(F.col("_level") == 0, F.col(d)))
    per = both.groupBy("_level", a, d, "viewingcontactid", "_anon").agg(*[F.sum(c).alias(c) for c in ("views", "likes", "comments")])
    levels = written(per.groupBy("_level", a, d).agg(*_uv_and_rate(F.count("viewingcontactid"))), "context")
    fine = levels.where("_level = 0").select(F.col(a).alias(attribute), F.col(d).alias(detail), "uv", "engagement_rate")
    coarse = levels.where("_level > 0").select(F.col(a).alias(attribute), F.col("uv").alias(f"{attribute}_uv"),
                                               F.col("engagement_rate").alias(f"{attribute}_engagement_rate"))
    return null_safe_left(fine, coarse, [attribute])


def performance_vs_avg(model: StarModel, by=("pagename",), filters: Filters = NO_FILTERS) -> DataFrame:
    """MEA-28 Avg Engagement Rate (over all pages, non-page filters kept),
    MEA-29 Performance vs Avg, MEA-30 Engagement Variance.

    By page columns, the fact is read once: reduced to (page, visitor) rows, which are written; the average reads them as they
    are, the groups with the inventory and its filters."""
    page_free = Filters(date_from=filters.date_from, date_to=filters.date_to,
                        equals=tuple((k, v) for k, v in filters.equals if k not in _PAGE_COLS and k != "marketingpageid"))
    names = _by(by)
    if set(names) <= _PAGE_COLS and not filters.uses_employee():
        from .reports import _page_filter_parts
        per = written(model.wide(page_free, page=None).groupBy("marketingpageid", "viewingcontactid").agg(
            M.views().alias("views"), M.likes().alias("likes"), M.comments().alias("comments")), "page_visitors")
        _, page_pred = _page_filter_parts(filters)
        on_page = [F.col(k).isin(list(v)) for k, v in filters.equals if k == "marketingpageid"]
        rows = per.join(model.page_inventory, "marketingpageid", "left")
        for cond in [*on_page, *([page_pred] if page_pred is not None else [])]:
            rows = rows.where(cond)
        avg = per.select(_uv_and_rate()[1]).scalar()
    else:
        rows = _partials(model, names, filters)
        avg = _partials(model, (), page_free).select(_uv_and_rate()[1]).scalar()
    g = rows.groupBy(*_keys(names)).agg(_uv_and_rate()[1])
    return (g.withColumn("avg_engagement_rate", avg)
            .withColumn("performance_vs_avg",
                        F.when(F.col("engagement_rate") > F.col("avg_engagement_rate"), F.lit("Above Average"))
                         .otherwise(F.lit("Below Average")))
            .withColumn("engagement_variance", F.col("engagement_rate") - F.col("avg_engagement_rate")))


# -------------------------------------------------------------- MEA-31..38
def division_reach_for_content(model: StarModel, filters: Filters = NO_FILTERS,
                               segment: str = "employeebusinessdivision") -> DataFrame:
    """MEA-31: viewers of the selected content, counted per division."""
    viewers = (model.wide(filters, page="left").select("viewingcontactid")
               .where(F.col("viewingcontactid").isNotNull()).distinct())
    e = model.employees()
    j = viewers.join(e, viewers["viewingcontactid"] == e["contactid"], "left")
    return j.groupBy(M.label(segment).alias(segment)).agg(
        F.count_distinct("viewingcontactid").alias("content_viewers"))


def all_segments(model: StarModel, segment: str) -> Column:
    """All values of an employee attribute, as a sorted array (bounded by the attribute)."""
    return (model.employee_contact.where(F.col(segment).isNotNull())
            .select(F.array_sort(F.collect_set(segment))).scalar())


def segments_not_reached(model: StarModel, filters: Filters = NO_FILTERS,
                         segment: str = "employeebusinessdivision", by=()) -> DataFrame:
    """MEA-32 (count) and SET-3 (list): segments with no viewer of the
    content; with ``by``, of each group of it (a page, a category, a channel)."""
    names = _by(by)
    if not names:
        allseg = model.employee_contact.select(segment).where(F.col(segment).isNotNull()).distinct()
        v = _visitors(model, filters, how="inner")
        seen = v.select(segment).where(F.col(segment).isNotNull()).distinct()
        return allseg.join(seen, segment, "left_anti")
    v = _visitors(model, filters, keys=tuple(_keys(names)))
    seen = v.groupBy(*names).agg(F.collect_set(segment).alias("_seen"))
    return seen.select(*names, F.explode(F.array_except(all_segments(model, segment), "_seen")).alias(segment))


def coverage(model: StarModel, filters: Filters = NO_FILTERS,
             employees: int | None = None, by=()) -> DataFrame:
    """MEA-32 count, MEA-36 Division Coverage %, MEA-37 Region Coverage %,
    MEA-38 Message Penetration, in one row or per group of content."""
    e = model.employee_contact
    names = _by(by)
    tot_div = e.select(F.count_distinct("employeebusinessdivision")).scalar()
    tot_reg = e.select(F.count_distinct("employeeregion")).scalar()
    # the three distinct counts are taken in small tasks, apart from the sorts of the employee join
    w = dealt(_visitors(model, filters, keys=tuple(_keys(names))), tasks_for(model.fact), *names, "viewingcontactid")
    cols = [F.count_distinct("viewingcontactid").alias("uv"),
            F.count_distinct("employeebusinessdivision").alias("divisions_reached"),
            F.count_distinct("employeeregion").alias("regions_reached")]
    g = w.groupBy(*names).agg(*cols) if names else w.agg(*cols)
    g = (g.withColumn("total_divisions", tot_div).withColumn("total_regions", tot_reg)
         .withColumn("total_employees", total_employees(model, employees)))
    return g.select(
        *names, "uv", "divisions_reached", "total_divisions",
        (F.col("total_divisions") - F.col("divisions_reached")).alias("divisions_not_reached"),
        M.pct_zero(F.col("divisions_reached"), F.col("total_divisions")).alias("division_coverage_pct"),
        "regions_reached", "total_regions",
        M.pct_zero(F.col("regions_reached"), F.col("total_regions")).alias("region_coverage_pct"),
        "total_employees",
        M.pct_zero(F.col("uv"), F.col("total_employees")).alias("message_penetration_pct"))


def target_match(model: StarModel, by=("targetregion",), filters: Filters = NO_FILTERS,
                 target: str = "targetregion", attribute: str = "employeeregion",
                 global_value: str | None = "Global") -> DataFrame:
    """MEA-33 / ASK-17: visitors whose attribute equals the page's target
    / UV * 100; a 'Global' target counts as 100."""
    raw = [b for b in _by(by) if b not in _EMP_COLS]
    w = _visitors(model, filters, keys=tuple(dict.fromkeys(raw + [target])))
    keys = _keys(by)
    match = F.count_distinct(F.when(F.col(attribute) == F.col(target), F.col("viewingcontactid")))
    g = w.groupBy(*keys).agg(F.count_distinct("viewingcontactid").alias("uv"), match.alias("matching_visitors"),
                             F.max(F.col(target)).alias("_t"), F.min(F.col(target)).alias("_t0"))
    rate = M.pct_zero(F.col("matching_visitors"), F.col("uv"))
    if global_value is not None:
        single_global = (F.col("_t") == global_value) & (F.col("_t0") == global_value)
        rate = F.when(single_global, F.lit(100.0)).otherwise(rate)
    return g.withColumn("target_match_rate", rate).drop("_t", "_t0")


def category_measures(model: StarModel, by=(), filters: Filters = NO_FILTERS,
                      strategy: str = "Strategy", leadership=LEADERSHIP_CATEGORIES) -> DataFrame:
    """MEA-34 Strategy Content UV / Engagement Rate, MEA-35 Leadership
    Comms UV / Engagement Rate."""
    nc = F.col("newscategory")
    return _conditional_uv_rate(model, by, filters, {"strategy": nc == strategy,
                                                     "leadership": nc.isin(list(leadership))},
                                need=("newscategory",))
