"""Dashboard data sets (DSH-1..17): the data behind each specified visual.

Each returns a lazy DataFrame (or, for composite pages, a dict of them).
Global thresholds (totals, the list of all divisions) enter as scalar
subqueries, so no row is joined pairwise and nothing is collected; exact
medians come from ``operators.ranking``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions.filters import NO_FILTERS, Filters
from ..model import StarModel, bounded_broadcast
from ..operators.ranking import exact_median
from ..operators.reshape import pivot_matrix, share_of_total, top_k
from ..session import written
from . import measures as MS
from . import reports as R

STRATEGIC_CATEGORIES = ("Strategy", "Culture")      # fixed values: the dashboard's pre-selection
BANDS = ((90.0, "green"), (70.0, "yellow"))          # fixed values: gauge colours (> 90, 70-90, < 70)


def _strategic(filters: Filters, categories) -> Filters:
    return filters.replace(equals={"newscategory": list(categories)})


# ----------------------------------------------------------------- DSH-1..3
def executive_cards(model: StarModel, filters: Filters = NO_FILTERS, employees: int | None = None) -> DataFrame:
    """DSH-1 cards: UV, Reach Rate, Engagement Rate and the latest month's
    MoM change, in one row."""
    core = MS.core_measures(model, (), filters).select("uv", "engagement_rate")
    mom = MS.reach_mom_change(model, (), filters)
    last = mom.agg(F.max_by(F.struct("year_month", "uv", "mom_change_pct"), F.col("month_start")).alias("m"))
    tot = MS.total_employees(model, employees)
    return (core.withColumn("total_employees", tot)
            .withColumn("reach_rate", M.pct_zero(F.col("uv"), F.col("total_employees")))
            .withColumn("latest_month", last.select("m.year_month").scalar())
            .withColumn("latest_month_uv", last.select("m.uv").scalar())
            .withColumn("mom_change_pct", last.select("m.mom_change_pct").scalar()))


def executive_summary(model: StarModel, filters: Filters = NO_FILTERS, top: int = 10) -> dict:
    """DSH-1: the cards plus daily trend, region and division bars and the
    top pages by UV with their engagement rate."""
    return {
        "cards": executive_cards(model, filters),
        "daily_trend": R.daily_uv_ma7(model, filters),
        "by_region": R.uv_by_region(model, filters),
        "by_division": R.uv_by_division(model, filters),
        "top_pages": top_pages_with_rate(model, filters, top),
    }


def top_pages_with_rate(model: StarModel, filters: Filters = NO_FILTERS, k: int = 10) -> DataFrame:
    """DSH-1: the pages most visitors saw, with their engagement rate."""
    g = R.page_grouped(model, filters, [F.col("marketingpageid"), F.col("pagename")], [("uv", "uv"), ("engagement_rate", "rate0")],
                       per_page=True)
    return top_k(g, [F.desc("uv")], ["marketingpageid", "pagename"], k)


def reach_vs_target(model: StarModel, filters: Filters = NO_FILTERS,
                    target: float = MS.REACH_TARGET_PCT) -> DataFrame:
    """DSH-2: reach per division and per region against the 80 % target."""
    parts = []
    for kind, seg in (("division", "employeebusinessdivision"), ("region", "employeeregion")):
        r = MS.reach_by_segment(model, seg, filters)
        parts.append(r.select(F.lit(kind).alias("segment_type"), F.col(seg).alias("segment"),
                              "employees", "uv", "reach_rate"))
    u = parts[0].unionByName(parts[1])
    return (u.withColumn("target_pct", F.lit(float(target)))
            .withColumn("gap_pct", F.lit(float(target)) - F.col("reach_rate"))
            .withColumn("target_met", F.col("reach_rate") >= F.lit(float(target))))


def monthly_reach_by_region(model: StarModel, filters: Filters = NO_FILTERS,
                            segment: str = "employeeregion") -> DataFrame:
    """DSH-3: month x region reach rate (UV of the region's employees in the
    month / the region's employees)."""
    pop = (model.employee_contact.groupBy(M.label(segment).alias(segment))
           .agg(F.count_distinct("contactid").alias("employees")))
    j = R.visitor_partials(model, filters, keys=("year_month",), date="inner")
    seen = (j.where(F.col("contactid").isNotNull())
            .groupBy("year_month", M.label(segment).alias(segment))
            .agg(F.count_distinct("viewingcontactid").alias("uv")))
    r = seen.join(bounded_broadcast(pop), segment, "left")
    return r.withColumn("reach_rate", M.pct_zero(F.col("uv"), F.col("employees")))


# ---------------------------------------------------------------- DSH-4..6
def page_performance(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """Per page: UV, views, engagements (blank = 0), engagement rate."""
    return R.page_grouped(model, filters, [F.col("marketingpageid"), M.label("pagename").alias("pagename"),
                                           M.label("websitename").alias("websitename")], [
        ("uv", "uv"), ("total_views", "views"), ("engagements", "engagements0"), ("engagement_rate", "rate0")],
        per_page=True)


def content_cards(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """DSH-4: pages viewed, overall engagement rate, pages with engagement
    > 0 and the top page's UV."""
    pp = page_performance(model, filters)
    cards = pp.agg(F.count(F.lit(1)).alias("pages_viewed"),
                   F.count_if(F.col("engagements") > 0).alias("pages_with_engagement"),
                   F.max("uv").alias("top_page_uv"))
    overall = model.wide(filters, page="left").select(M.engagement_rate_zero()).scalar()
    return cards.withColumn("overall_engagement_rate", overall)


def content_quadrants(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """DSH-5: each page placed against the median UV and median engagement
    rate of all pages (exact, by selection over the written page table)."""
    pp = written(page_performance(model, filters), "page_performance")
    med_uv, med_rate = (F.lit(exact_median(pp, c)).cast("double") for c in ("uv", "engagement_rate"))
    hi_r = F.col("uv") > F.col("median_uv")
    hi_e = F.col("engagement_rate") > F.col("median_engagement_rate")
    return (pp.withColumn("median_uv", med_uv).withColumn("median_engagement_rate", med_rate)
            .withColumn("quadrant",
                        F.when(hi_r & hi_e, F.lit("high reach, high engagement"))
                         .when(hi_r, F.lit("high reach, low engagement"))
                         .when(hi_e, F.lit("low reach, high engagement"))
                         .otherwise(F.lit("low reach, low engagement"))))


def content_table(model: StarModel, filters: Filters = NO_FILTERS, min_views: int = 10,
                  k: int = 50) -> DataFrame:
    """DSH-6: page table, views > 10, top 50 by UV."""
    pp = page_performance(model, filters).where(F.col("total_views") > min_views)
    return top_k(pp, [F.desc("uv")], ["marketingpageid"], k)


# ---------------------------------------------------------------- DSH-7..9
def funnel(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """DSH-7: Homepage visitors > Article viewers > Engaged (independent
    stages, as specified) with % of the first stage and drop-off."""
    ct, v = F.col("contenttype"), F.col("viewingcontactid")
    if MS._page_partials_apply((), filters):
        w = R.page_partials(model, filters)            # (page, visitor) rows
        engaged = (F.col("likes") > 0) | (F.coalesce(F.col("comments"), F.lit(0)) > 0)
    else:
        w = model.wide(filters, page="left")
        engaged = M.is_engaged()
    one = w.agg(F.count_distinct(F.when(ct == "Homepage", v)).alias("s1"),
                F.count_distinct(F.when(ct == "Article", v)).alias("s2"),
                F.count_distinct(F.when(engaged, v)).alias("s3"))
    rows = one.select(F.explode(F.array(
        F.struct(F.lit(1).alias("stage_order"), F.lit("Homepage visitors").alias("stage"), F.col("s1").alias("visitors")),
        F.struct(F.lit(2).alias("stage_order"), F.lit("Article viewers").alias("stage"), F.col("s2").alias("visitors")),
        F.struct(F.lit(3).alias("stage_order"), F.lit("Engaged").alias("stage"), F.col("s3").alias("visitors")),
    )).alias("r")).select("r.*")
    w3 = Window.orderBy("stage_order")          # three rows
    first = F.first("visitors").over(w3.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    prev = F.lag("visitors").over(w3)
    return (rows.withColumn("pct_of_first", M.pct_zero(F.col("visitors"), first))
                .withColumn("drop_off_pct", F.when(prev.isNull(), F.lit(0.0))
                            .otherwise(M.pct_zero(prev - F.col("visitors"), prev))))


def channel_mix(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """DSH-8: UV per channel and its share of the channel total."""
    w = model.wide(filters, page="left")
    g = w.groupBy(F.col("referrerapplicationid").alias("channel")).agg(M.uv().alias("uv"))
    return share_of_total(g, "uv", "share_pct", 2)


def channel_table(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """DSH-9: channel, UV, views, views per visitor, engagement rate."""
    w = model.wide(filters, page="left")
    return w.groupBy(F.col("referrerapplicationid").alias("channel")).agg(
        M.uv().alias("uv"), M.views().alias("total_views"),
        M.ratio_zero(M.views(), M.uv()).alias("views_per_visitor"),
        M.engagement_rate_zero().alias("engagement_rate"))


# --------------------------------------------------------------- DSH-10..17
def band(col) -> F.Column:
    hi, mid = BANDS
    return (F.when(col > hi[0], F.lit(hi[1])).when(col >= mid[0], F.lit(mid[1])).otherwise(F.lit("red")))


def coverage_gauges(model: StarModel, filters: Filters = NO_FILTERS, employees: int | None = None, by=()) -> DataFrame:
    """DSH-10: division / region coverage and penetration with colour bands,
    of all content or of each group of it."""
    c = MS.coverage(model, filters, employees, by)
    return (c.withColumn("division_band", band(F.col("division_coverage_pct")))
             .withColumn("region_band", band(F.col("region_coverage_pct")))
             .withColumn("penetration_band", band(F.col("message_penetration_pct"))))


def gap_matrix(model: StarModel, filters: Filters = NO_FILTERS, categories=STRATEGIC_CATEGORIES,
               segment: str = "employeebusinessdivision", divisions=None) -> DataFrame:
    """DSH-11: strategic page x division UV, 0-filled, with the number of
    divisions at 0 (the red cells).  Built as a pivot (no page x division
    spine); strategic pages nobody viewed are added by a left join from the
    inventory and show 0 everywhere."""
    f = _strategic(filters, categories)
    v = MS._visitors(model, f, keys=("marketingpageid",), how="inner", page="inner")
    cells = v.groupBy("marketingpageid", segment).agg(F.count_distinct("viewingcontactid").alias("uv"))
    if divisions is None:
        divisions = sorted(r[0] for r in model.employee_contact.where(F.col(segment).isNotNull())
                           .select(segment).distinct().collect())   # bounded: one row per division
    m = pivot_matrix(cells, "marketingpageid", segment, "uv", "sum", values=divisions, fill=0)
    pages = model.page_inventory.where(F.col("newscategory").isin(list(categories)))
    of_pages = tuple((k, v) for k, v in f.equals if k in model.page_inventory.columns)
    if f.website or f.page_url or f.page_name or of_pages:
        pages = f.replace(date_from=None, date_to=None, equals=of_pages).apply(pages)
    pages = pages.select("marketingpageid", "pagename")
    out = pages.join(m, "marketingpageid", "left").fillna(0, subset=list(divisions))
    zero = sum((F.when(F.col(f"`{d}`") == 0, 1).otherwise(0) for d in divisions), F.lit(0))
    return out.withColumn("gap_divisions", zero.cast("int"))


def missing_divisions(model: StarModel, filters: Filters = NO_FILTERS, categories=STRATEGIC_CATEGORIES,
                      segment: str = "employeebusinessdivision") -> DataFrame:
    """DSH-12 / SET-3: strategic pages not reaching every division, with the
    divisions reached and missing (sorted arrays)."""
    f = _strategic(filters, categories)
    v = MS._visitors(model, f, keys=("marketingpageid", "pagename"), how="inner", page="inner")
    reached = v.where(F.col(segment).isNotNull()).groupBy("marketingpageid", "pagename").agg(
        F.array_sort(F.collect_set(segment)).alias("divisions_reached"))
    allv = MS.all_segments(model, segment)
    missing = F.array_except(allv, F.col("divisions_reached"))
    return (reached.where(F.size(missing) > 0)
            .select("marketingpageid", "pagename",
                    F.size("divisions_reached").cast("long").alias("divisions_reached"),
                    F.array_join(F.col("divisions_reached"), ", ").alias("reached"),
                    F.array_join(missing, ", ").alias("divisions_missing")))


def strategic_vs_general(model: StarModel, filters: Filters = NO_FILTERS,
                         categories=STRATEGIC_CATEGORIES) -> DataFrame:
    """DSH-13: engagement rate of strategic content vs all content."""
    on = F.col("newscategory").isin(list(categories))
    return MS._conditional_uv_rate(model, (), filters, {"strategic": on, "all": F.lit(True)}, need=("newscategory",)).select(
        "strategic_engagement_rate", "all_engagement_rate")


def theme_engagement_split(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """DSH-14: likes vs comments per theme."""
    return R.page_grouped(model, filters, [M.label("theme").alias("theme")], [("likes", "likes0"), ("comments", "comments0")])


def theme_topic_tree(model: StarModel, filters: Filters = NO_FILTERS) -> DataFrame:
    """DSH-15 / AGG-18: pages and views by theme > topic with subtotals
    (rollup; level 0 = theme+topic, 1 = theme subtotal, 3 = grand total)."""
    w = model.wide(filters, page="inner")
    return w.rollup("theme", "topic").agg(
        F.grouping_id().cast("int").alias("level"),
        M.pages().alias("pages"), M.views().alias("total_views"))


def uv_by_attribute(model: StarModel, attribute: str = "newscategory",
                    filters: Filters = NO_FILTERS) -> DataFrame:
    """DSH-16: UV, views and engagement rate by a page attribute."""
    return R.page_grouped(model, filters, [M.label(attribute).alias(attribute)], [
        ("uv", "uv"), ("total_views", "views"), ("engagement_rate", "rate0")])


def low_reach_strategic_pages(model: StarModel, filters: Filters = NO_FILTERS,
                              categories=STRATEGIC_CATEGORIES, target: float = MS.REACH_TARGET_PCT,
                              employees: int | None = None) -> DataFrame:
    """DSH-17: strategic pages whose penetration (UV / employees) < target."""
    f = _strategic(filters, categories)
    w = model.wide(f, page="inner")
    g = w.groupBy("marketingpageid", "pagename").agg(M.uv().alias("uv"))
    g = g.withColumn("total_employees", MS.total_employees(model, employees))
    g = g.withColumn("message_penetration_pct", M.pct_zero(F.col("uv"), F.col("total_employees")))
    return g.where(F.col("message_penetration_pct") < F.lit(float(target)))
