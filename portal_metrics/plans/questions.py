"""Operators implied by the question catalogue (ASK-2..17, ASK-19, ASK-20).

ASK-1 (generic report) lives in ``reports.report``; ASK-18 (journeys) in
``operators.journeys``.  Comparisons of several periods or filter sets
are done in *one* pass: each fact row is tagged with the periods / sides
it belongs to (conditional aggregates, or a join to a small broadcast list
of periods), instead of one scan per period.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions.filters import NO_FILTERS, Filters, period_bounds, to_daykey
from ..model import StarModel
from ..operators.reshape import arg_extremes, share_of_total, top_k
from ..operators.trends import period_change, period_start
from . import measures as MS
from . import reports as R

GRAIN_KEYS = {"day": "date", "week": "year_week", "month": "year_month",
              "quarter": "year_quarter", "year": "year"}


def _cond_metrics(pred: Column, suffix: str) -> list[Column]:
    """uv, views, visits, likes, comments, engagements, rate on rows matching ``pred``."""
    p = F.coalesce(pred, F.lit(False))
    lk = F.count_if(p & M.is_like())
    cm = F.coalesce(F.sum(F.when(p, F.col("comments"))), F.lit(0).cast("long"))
    vw = F.coalesce(F.sum(F.when(p, F.col("views"))), F.lit(0).cast("long"))
    return [
        F.count_distinct(F.when(p, F.col("viewingcontactid"))).alias(f"uv{suffix}"),
        vw.alias(f"views{suffix}"),
        F.coalesce(F.sum(F.when(p, F.col("visits"))), F.lit(0).cast("long")).alias(f"visits{suffix}"),
        lk.alias(f"likes{suffix}"), cm.alias(f"comments{suffix}"),
        (lk + cm).alias(f"engagements{suffix}"),
        M.pct_zero(lk + cm, vw).alias(f"engagement_rate{suffix}"),
    ]


COMPARE_METRICS = ["uv", "views", "visits", "likes", "comments", "engagements", "engagement_rate"]


def _compare_rows(one: DataFrame, a: str, b: str) -> DataFrame:
    """One wide row of _a/_b metrics -> one row per metric with delta and %."""
    rows = one.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(f"{m}_a").cast("double").alias(a),
                 F.col(f"{m}_b").cast("double").alias(b)) for m in COMPARE_METRICS])).alias("r")).select("r.*")
    return (rows.withColumn("delta", F.col(b) - F.col(a))
                .withColumn("change_pct", F.try_divide((F.col(b) - F.col(a)) * F.lit(100.0), F.col(a))))


# -------------------------------------------------------------- ASK-2, ASK-12
def _within(filters: Filters, lo: int, hi: int | None) -> Filters:
    """``filters`` with its own day range cut to [lo, hi]."""
    own_from, own_to = (to_daykey(x) if x is not None else None for x in (filters.date_from, filters.date_to))
    return filters.replace(date_from=lo if own_from is None else max(lo, own_from),
                           date_to=own_to if hi is None else hi if own_to is None else min(hi, own_to))


def period_compare(model: StarModel, period_a, period_b, filters: Filters = NO_FILTERS) -> DataFrame:
    """ASK-2: metrics of period A vs period B ((from, to) day keys or dates);
    B is reported as the change from A.  One scan, restricted to A u B."""
    (a0, a1), (b0, b1) = [(to_daykey(x), to_daykey(y)) for x, y in (period_a, period_b)]
    lo, hi = min(a0, b0), max(a1, b1)
    w = model.wide(_within(filters, lo, hi), page="left")
    d = F.col("visitdatekey")
    one = w.agg(*_cond_metrics(d.between(a0, a1), "_a"), *_cond_metrics(d.between(b0, b1), "_b"))
    return _compare_rows(one, "period_a", "period_b")


def _side(f: Filters):
    """(row-level predicate on fact/page columns, employee-level predicate)."""
    from .reports import _split_employee_filters
    rest, emp = _split_employee_filters(f)
    p = rest.predicate()
    return (p if p is not None else F.lit(True)), emp


def ab_compare(model: StarModel, filters_a: Filters, filters_b: Filters,
               base: Filters = NO_FILTERS) -> DataFrame:
    """ASK-12: the same metrics under two filter sets, side by side (one scan).

    Without employee conditions it is one conditional aggregation.  With
    them, each side's partial sums are built per visitor first, the
    employees are joined to one row per visitor, and the employee part of
    each side is applied there (re-summed, so key fan-out is unchanged)."""
    emp = filters_a.uses_employee() or filters_b.uses_employee() or base.uses_employee()
    if not emp:
        w = model.wide(base, page="left")
        pa, pb = _side(filters_a)[0], _side(filters_b)[0]
        one = w.where(pa | pb).agg(*_cond_metrics(pa, "_a"), *_cond_metrics(pb, "_b"))
        return _compare_rows(one, "side_a", "side_b")
    from .reports import _split_employee_filters
    base_rest, base_emp = _split_employee_filters(base)
    (pa, ea), (pb, eb) = _side(filters_a), _side(filters_b)
    w = model.wide(base_rest, page="left")
    parts = []
    for sfx, p in (("_a", pa), ("_b", pb)):
        p = F.coalesce(p, F.lit(False))
        parts += [F.sum(F.when(p, F.col("views"))).alias(f"v{sfx}"), F.sum(F.when(p, F.col("visits"))).alias(f"n{sfx}"),
                  F.count_if(p & M.is_like()).alias(f"l{sfx}"), F.sum(F.when(p, F.col("comments"))).alias(f"c{sfx}"),
                  F.max(p).alias(f"any{sfx}")]
    per = w.where(pa | pb).groupBy("viewingcontactid").agg(*parts)
    e = model.employees()
    j = per.join(e, per["viewingcontactid"] == e["contactid"], "left")
    if base_emp is not None:
        j = j.where(base_emp)
    cols = []
    for sfx, ep in (("_a", ea), ("_b", eb)):
        ok = F.coalesce(ep, F.lit(False)) if ep is not None else F.lit(True)
        z = F.lit(0).cast("long")
        vw = F.coalesce(F.sum(F.when(ok, F.col(f"v{sfx}"))), z)
        lk = F.coalesce(F.sum(F.when(ok, F.col(f"l{sfx}"))), z)
        cm = F.coalesce(F.sum(F.when(ok, F.col(f"c{sfx}"))), z)
        cols += [F.count_distinct(F.when(ok & F.col(f"any{sfx}"), F.col("viewingcontactid"))).alias(f"uv{sfx}"),
                 vw.alias(f"views{sfx}"), F.coalesce(F.sum(F.when(ok, F.col(f"n{sfx}"))), z).alias(f"visits{sfx}"),
                 lk.alias(f"likes{sfx}"), cm.alias(f"comments{sfx}"), (lk + cm).alias(f"engagements{sfx}"),
                 M.pct_zero(lk + cm, vw).alias(f"engagement_rate{sfx}")]
    return _compare_rows(j.agg(*cols), "side_a", "side_b")


# ------------------------------------------------------------- ASK-3, 4, 10
def _period_frame(model, filters, grain, by, metrics: list[str]):
    """Metrics per (by, period start).  With employee attributes in ``by``
    (or in the filters) and re-aggregatable metrics, the fact is reduced
    per (period, visitor) before the employee join."""
    from .reports import _PARTIAL_METRICS, visitor_partials
    need_emp = any(b in MS._EMP_COLS for b in by) or filters.uses_employee()
    keys = MS._keys(by)
    ps = period_start(F.col("date"), grain).alias("period_start")
    if need_emp and all(m in _PARTIAL_METRICS for m in metrics):
        raw = [F.col(b) for b in by if b not in MS._EMP_COLS]
        j = visitor_partials(model, filters, keys=(*raw, ps), date="inner")
        return j.groupBy(*keys, "period_start").agg(*[_PARTIAL_METRICS[m]().alias(m) for m in metrics])
    w = model.wide(filters, page="left", date="inner", employee="left" if need_emp else None)
    return w.groupBy(*keys, ps).agg(*[M.metric(m) for m in metrics])


def growth(model: StarModel, by=("referrerapplicationid",), metric: str = "uv", grain: str = "month",
           n: int = 1, filters: Filters = NO_FILTERS) -> DataFrame:
    """ASK-3: per segment and period, the metric, its value n periods
    earlier and the growth in % (NULL when there is no earlier value)."""
    by = list(by)
    g = _period_frame(model, filters, grain, by, [metric])
    return period_change(g, "period_start", metric, grain, n, by=by, prev_out=f"prev_{metric}",
                         change_out="growth_pct", zero_when_missing=False)


def fastest_growing(model: StarModel, by=("referrerapplicationid",), metric: str = "uv",
                    grain: str = "month", k: int = 5, filters: Filters = NO_FILTERS) -> DataFrame:
    """ASK-3: segments ranked by growth in the latest period."""
    g = growth(model, by, metric, grain, 1, filters)
    last = g.select(F.max("period_start")).scalar()
    return top_k(g.where(F.col("period_start") == last), [F.desc_nulls_last("growth_pct")], list(by), k)


def trend(model: StarModel, grain: str = "month", n_periods: int = 6, as_of=None,
          metrics=("uv", "views", "engagements"), by=(), filters: Filters = NO_FILTERS) -> DataFrame:
    """ASK-4: the last n periods ending with the period of ``as_of``."""
    if as_of is not None:
        end = period_bounds({"day": "today", "week": "this_week", "month": "this_month",
                             "quarter": "this_quarter", "year": "this_year"}[grain], as_of)[1]
        first = period_bounds({"day": "today", "week": "this_week", "month": "this_month",
                               "quarter": "this_quarter", "year": "this_year"}[grain], as_of)[0]
        import datetime as _dt
        if grain == "day":
            start = first - _dt.timedelta(days=n_periods - 1)
        elif grain == "week":
            start = first - _dt.timedelta(days=7 * (n_periods - 1))
        else:
            months = {"month": 1, "quarter": 3, "year": 12}[grain] * (n_periods - 1)
            m = first.month - 1 - months
            start = _dt.date(first.year + m // 12, m % 12 + 1, 1)
        filters = filters.replace(date_from=to_daykey(start), date_to=to_daykey(end))
    g = _period_frame(model, filters, grain, list(by), list(metrics))
    if as_of is None:   # the last n periods that have data
        last = g.select("period_start").distinct().orderBy(F.desc("period_start")).limit(n_periods)
        g = g.join(last, "period_start", "left_semi")
    return g.orderBy("period_start", *by)


def peak_period(model: StarModel, grain: str = "day", metric: str = "uv",
                filters: Filters = NO_FILTERS) -> DataFrame:
    """ASK-10: busiest (and quietest) period by any metric, earliest on ties."""
    g = _period_frame(model, filters, grain, [], [metric])
    return arg_extremes(g, metric, "period_start")


# ------------------------------------------------------------ ASK-5..9, 11
def _pages(model, filters, by=()):
    """Per page and group of fact columns ``by``."""
    return R.page_grouped(model, filters, [F.col("marketingpageid"), M.label("pagename").alias("pagename"), *[F.col(b) for b in by]], [
        ("total_views", "views"), ("uv", "uv"), ("likes", "likes0"), ("comments", "comments0"), ("engagements", "engagements0")],
        fact_keys=by, per_page=True)


def zero_engagement_pages(model: StarModel, filters: Filters = NO_FILTERS, by=()) -> DataFrame:
    """ASK-5: pages viewed but never liked or commented (in a group of ``by``, e.g. through a channel)."""
    return _pages(model, filters, by).where(F.col("engagements") == 0)


def ignored_pages(model: StarModel, filters: Filters = NO_FILTERS, by: str | None = None) -> DataFrame:
    """ASK-6: inventory pages with no view in the filtered period; with
    ``by`` (a fact column of few values, e.g. the channel), the values through
    which each page had none.  The fact side is reduced to distinct ids before it
    meets the inventory."""
    inv = model.page_inventory
    if filters.website or filters.page_url or filters.page_name or filters.uses_page():
        inv = filters.replace(date_from=None, date_to=None,
                              equals=tuple((k, v) for k, v in filters.equals
                                           if k in MS._PAGE_COLS)).apply(inv)
    cols = ["marketingpageid", "pagename", "websitename", "contenttype"]
    if by is None:
        seen = model.wide(filters, page=None).select("marketingpageid").distinct()
        return inv.join(seen, "marketingpageid", "left_anti").select(*cols)
    w = model.wide(filters, page=None)
    seen = w.groupBy("marketingpageid").agg(F.collect_set(by).alias("_seen"))
    every = w.select(F.array_sort(F.collect_set(by))).scalar()
    none = F.array_except(every, F.coalesce("_seen", F.array().cast("array<string>")))
    return inv.join(seen, "marketingpageid", "left").select(*cols, F.explode(none).alias(by))


def comments_without_likes(model: StarModel, filters: Filters = NO_FILTERS, by=()) -> DataFrame:
    """ASK-7: pages with comments but no like (in a group of ``by``)."""
    return _pages(model, filters, by).where((F.col("comments") > 0) & (F.col("likes") == 0))


def top_by_ratio(model: StarModel, filters: Filters = NO_FILTERS, min_views: int = 100,
                 k: int = 20) -> DataFrame:
    """ASK-8 / AGG-21 / FIL-13: like-to-view ratio and comments per page,
    only pages above a minimum volume (HAVING views > n)."""
    p = _pages(model, filters).where(F.col("total_views") > min_views)
    p = p.withColumn("like_to_view_pct", M.pct_zero(F.col("likes"), F.col("total_views")))
    return top_k(p, [F.desc("like_to_view_pct")], ["marketingpageid"], k)


def comments_per_page(model: StarModel, by: str = "contenttype", filters: Filters = NO_FILTERS) -> DataFrame:
    """AGG-21: comments per article of each group of pages: comments, pages viewed, and their ratio."""
    g = R.page_grouped(model, filters, [M.label(by).alias(by)], [("comments", "comments0"), ("pages", "pages"), ("total_views", "views")])
    return g.withColumn("comments_per_page", M.ratio_zero(F.col("comments"), F.col("pages")))


def day_of_week_profile(model: StarModel, filters: Filters = NO_FILTERS, weekend: bool = False) -> DataFrame:
    """ASK-9: per ISO weekday (or weekend vs weekday): days, total views,
    UV across those days, and the mean daily UV and views."""
    w = model.wide(filters, page="left", date="inner")
    keys = ["is_weekend"] if weekend else ["day_of_week", "day_name"]
    daily = w.groupBy(*keys, "date").agg(M.uv().alias("_uv"), M.views().alias("_views"))
    per = daily.groupBy(*keys).agg(F.count(F.lit(1)).alias("days"),
                                   F.avg("_uv").alias("avg_daily_uv"), F.avg("_views").alias("avg_daily_views"))
    tot = w.groupBy(*keys).agg(M.uv().alias("uv"), M.views().alias("total_views"))
    return per.join(tot, keys)


def segment_share(model: StarModel, segment: str = "employeeclass", metric: str = "uv",
                  filters: Filters = NO_FILTERS) -> DataFrame:
    """ASK-11: each segment's metric as % of the segment total."""
    g = MS._agg(model, [segment], filters, [M.metric(metric)])
    return share_of_total(g, metric, "share_pct", 2)


# ------------------------------------------------------------ ASK-13..17
def benchmark_page(model: StarModel, page_id: str, group: str = "contenttype",
                   filters: Filters = NO_FILTERS) -> DataFrame:
    """ASK-13: one page vs the pages of its group and vs all pages.

    Rates of the group and of all pages are ratios of sums (the group's
    engagements / views, as MEA-27/28 define them); views and UV are the
    mean per page."""
    pp = model.wide(filters, page="left").groupBy("marketingpageid", M.label(group).alias(group)).agg(
        M.uv().alias("uv"), M.views().alias("total_views"), M.engagements_zero().alias("engagements"))
    me = pp.where(F.col("marketingpageid") == page_id)
    same = pp.join(me.select(group).distinct(), group, "left_semi")
    cols = [M.pct_zero(F.sum("engagements"), F.sum("total_views")).alias("engagement_rate"),
            F.avg("total_views").alias("total_views"), F.avg("uv").alias("uv"),
            F.count(F.lit(1)).alias("pages")]
    page = me.select(F.lit("page").alias("level"),
                     M.pct_zero(F.col("engagements"), F.col("total_views")).alias("engagement_rate"),
                     F.col("total_views").cast("double"), F.col("uv").cast("double"),
                     F.lit(1).cast("long").alias("pages"))
    return (page.unionByName(same.agg(*cols).select(F.lit("group").alias("level"), "engagement_rate",
                                                    "total_views", "uv", "pages"))
                .unionByName(pp.agg(*cols).select(F.lit("all").alias("level"), "engagement_rate",
                                                  "total_views", "uv", "pages")))


def co_visit(model: StarModel, filter_a: Filters, filter_b: Filters, base: Filters = NO_FILTERS,
             by=()) -> DataFrame:
    """ASK-14: visitors who saw A, who saw B, who saw both, and the share of
    A's visitors who also saw B (and the drop-off).

    Flags are maxed per visitor on the fact (page/fact parts of A and B);
    employee attributes -- in ``by`` or in the filters -- are joined to
    that one-row-per-visitor result and the flags re-maxed, never joined
    to raw page views."""
    from .reports import _split_employee_filters
    by = list(by)
    base_rest, base_emp = _split_employee_filters(base)
    (pa, ea), (pb, eb) = _side(filter_a), _side(filter_b)
    emp_by = [b for b in by if b in MS._EMP_COLS]
    fact_by = [b for b in by if b not in MS._EMP_COLS]
    w = model.wide(base_rest, page="left").where(F.col("viewingcontactid").isNotNull())
    per = w.groupBy(*MS._keys(fact_by), "viewingcontactid").agg(
        F.max(F.coalesce(pa, F.lit(False))).alias("_a"), F.max(F.coalesce(pb, F.lit(False))).alias("_b"))
    if emp_by or any(x is not None for x in (ea, eb, base_emp)):
        e = model.employees()
        j = per.join(e, per["viewingcontactid"] == e["contactid"], "left")
        if base_emp is not None:
            j = j.where(base_emp)
        a = F.col("_a") & (F.coalesce(ea, F.lit(False)) if ea is not None else F.lit(True))
        b = F.col("_b") & (F.coalesce(eb, F.lit(False)) if eb is not None else F.lit(True))
        per = j.groupBy(*[F.col(x) for x in fact_by], *MS._keys(emp_by), "viewingcontactid").agg(
            F.max(a).alias("_a"), F.max(b).alias("_b"))
    cols = [F.count_if("_a").alias("visitors_a"), F.count_if("_b").alias("visitors_b"),
            F.count_if(F.col("_a") & F.col("_b")).alias("visitors_both")]
    out = per.groupBy(*by).agg(*cols) if by else per.agg(*cols)
    return (out.withColumn("a_to_b_pct", M.pct_zero(F.col("visitors_both"), F.col("visitors_a")))
               .withColumn("drop_off_pct", F.lit(100.0) - F.col("a_to_b_pct")))


def content_engagers(model: StarModel, content: Filters, by=()) -> DataFrame:
    """ASK-15: viewers of the content who engaged with it (MEA-22 under a filter)."""
    return MS.engagement_conversion(model, by, content)


def reach_gap(model: StarModel, segment: str = "employeebusinessdivision",
              filters: Filters = NO_FILTERS) -> DataFrame:
    """ASK-16: segments by reach rate, lowest first, zero-viewer segments
    kept; with the segment's engagement rate (0 when no view)."""
    r = MS.reach_by_segment(model, segment, filters)
    v = MS._visitors(model, filters, how="inner")
    eng = v.groupBy(M.label(segment).alias(segment)).agg(M.pct_zero(
        F.sum("likes") + F.coalesce(F.sum("comments"), F.lit(0).cast("long")), F.sum("views")).alias("engagement_rate"))
    out = r.join(eng, segment, "left").fillna(0.0, subset=["engagement_rate"])
    return out.orderBy(F.asc("reach_rate"), F.col(segment).asc_nulls_last())


def target_audience_match(model: StarModel, kind: str = "region", by=None,
                          filters: Filters = NO_FILTERS) -> DataFrame:
    """ASK-17: targetregion vs employeeregion, or targetorganization vs
    employeebusinessdivision."""
    if kind == "region":
        return MS.target_match(model, by or ("targetregion",), filters, "targetregion", "employeeregion", "Global")
    return MS.target_match(model, by or ("targetorganization",), filters, "targetorganization",
                           "employeebusinessdivision", None)


# ---------------------------------------------------------- ASK-19, ASK-20
def page_lookup(model: StarModel, name: str, filters: Filters = NO_FILTERS) -> dict:
    """ASK-19: metrics of pages whose name contains ``name`` plus their
    viewers by region, division and channel."""
    f = filters.replace(page_name=name)
    return {
        "pages": _pages(model, f),
        "by_region": MS.core_measures(model, ["employeeregion"], f),
        "by_division": MS.core_measures(model, ["employeebusinessdivision"], f),
        "by_channel": MS.core_measures(model, ["referrerapplicationid"], f),
    }


def elementary_segments(periods: dict) -> tuple[list[int], list[tuple[str, int, int, list[int]]]]:
    """Cuts of the day-key axis at all ends of the periods, and for each period (name, from, to) the segments it is made of.

    Segment i holds the keys from cut i-1 up to before cut i; a segment lies wholly inside or outside of each period."""
    named = [(n, to_daykey(a), to_daykey(b) if b is not None else 99991231) for n, (a, b) in periods.items()]
    cuts = sorted({k for _, lo, hi in named for k in (lo, hi + 1)})
    return cuts, [(n, lo, hi, [i + 1 for i, c in enumerate(cuts) if lo <= c <= hi]) for n, lo, hi in named]


def period_summary(model: StarModel, periods: dict, filters: Filters = NO_FILTERS) -> DataFrame:
    """ASK-20: one row of key metrics per named period {name: (from, to)}; periods may overlap.

    The ends of all periods cut the days into disjoint segments.  The fact is reduced to a row per (segment, visitor) in one
    scan; only these rows are expanded to the periods that hold their segment, by an equality join with the list of
    (segment, period), which the request bounds."""
    spark: SparkSession = model.spark
    cuts, named = elementary_segments(periods)
    lo = min(r[1] for r in named)
    hi = max(r[2] for r in named)
    held = spark.createDataFrame([(i, n, a, b) for n, a, b, own in named for i in own],
                                 "_segment int, period string, day_from long, day_to long")
    w = model.wide(_within(filters, lo, hi if hi != 99991231 else None), page="left")
    segment = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c <= F.col("visitdatekey")))
    per = w.groupBy(segment.alias("_segment"), "viewingcontactid").agg(
        M.views().alias("views"), M.visits().alias("visits"), M.likes_count().alias("likes"), M.comments().alias("comments"))
    j = per.join(F.broadcast(held), "_segment")
    z = F.lit(0).cast("long")
    likes, comments = F.sum("likes"), F.coalesce(F.sum("comments"), z)
    return j.groupBy("period", "day_from", "day_to").agg(
        M.uv().alias("uv"), F.sum("views").alias("total_views"), F.sum("visits").alias("total_visits"),
        likes.alias("likes"), comments.alias("comments"), (likes + comments).alias("engagements"),
        M.pct_zero(likes + comments, F.sum("views")).alias("engagement_rate"))


def named_periods(as_of, kinds=("today", "this_week", "last_week", "this_month", "last_month",
                                "this_quarter", "last_quarter", "this_year", "last_n_days")) -> dict:
    """FIL-7..12: {kind: (from_day, to_day)} relative to ``as_of``."""
    out = {}
    for k in kinds:
        lo, hi = period_bounds(k, as_of, 30 if k == "last_n_days" else None)
        out[k] = (lo, hi)
    return out


# ------------------------------------------------------------------ JOIN-8
def viewer_set(model: StarModel, content: Filters) -> DataFrame:
    """Distinct visitors of the selected content (TREATAS source set)."""
    return (model.wide(content, page="left").select("viewingcontactid")
            .where(F.col("viewingcontactid").isNotNull()).distinct())


def also_viewed(model: StarModel, content: Filters, by=("contenttype",),
                filters: Filters = NO_FILTERS) -> DataFrame:
    """JOIN-8: everything the viewers of ``content`` viewed, by ``by``.

    The fact is restricted with a LEFT SEMI join on the viewer set; no
    broadcast hint is given because the set grows with the data -- AQE
    broadcasts it at runtime when the measured set is small, and splits a
    hot visitor's partition otherwise."""
    viewers = viewer_set(model, content)
    w = model.wide(filters, page="left").join(viewers, "viewingcontactid", "left_semi")
    keys = MS._keys(by)
    return w.groupBy(*keys).agg(M.uv().alias("uv"), M.views().alias("total_views"))
