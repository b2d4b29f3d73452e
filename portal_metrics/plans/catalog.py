"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each entry builds the star from the driver's tables (``tpch_star``) and
runs one operator of SURVEY §2 over the whole tables.  Names carry the
inventory id (qry04 = QRY-4, mea17 = MEA-17, ...).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.filters import Filters
from ..sources.tpch_star import star_from_tpch
from . import reports as R

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        CATALOG[name] = fn
        return fn
    return deco


def _star(spark, sf_dir):
    return star_from_tpch(spark, sf_dir)


# name -> (model) -> DataFrame for every query that only needs a StarModel;
# the bench runs these against a stored star as well.
MODEL_QUERIES: dict[str, Callable] = {}


def _model_query(name, fn, **kw):
    MODEL_QUERIES[name] = lambda model: fn(model, **kw)
    CATALOG[name] = lambda spark, sf_dir: fn(_star(spark, sf_dir), **kw)


# --------------------------------------------------------------- QRY-1..28
for _name, _fn in [
    ("qry01_summary", R.summary),
    ("qry02_daily_uv", R.daily_uv),
    ("qry03_weekly_uv", R.weekly_uv),
    ("qry04_monthly_uv", R.monthly_uv),
    ("qry05_quarterly_uv", R.quarterly_uv),
    ("qry06_uv_by_website", R.uv_by_website),
    ("qry07_uv_by_theme", R.uv_by_theme),
    ("qry08_daily_engagement", R.daily_engagement),
    ("qry09_top_engaged_pages", R.top_engaged_pages),
    ("qry10_engagement_by_contenttype", R.engagement_by_contenttype),
    ("qry11_top_pages_by_views", R.top_pages_by_views),
    ("qry12_top_pages_by_uv", R.top_pages_by_uv),
    ("qry13_referrer_analysis", R.referrer_analysis),
    ("qry14_overall_engagement", R.overall_engagement),
    ("qry15_rows_per_website", R.rows_per_website),
    ("qry16_daily_uv_ma7", R.daily_uv_ma7),
    ("qry17_peak_day", R.peak_day),
    ("qry18_top15_pages_chart", R.top15_pages_chart),
    ("qry19_uv_by_website_chart", R.uv_by_website_chart),
    ("qry20_engagement_chart", R.engagement_chart),
    ("qry21_uv_by_region", R.uv_by_region),
    ("qry22_uv_by_division", R.uv_by_division),
    ("qry23_region_x_division", R.region_x_division),
    ("qry24_region_division_matrix", R.region_division_matrix),
    ("qry25_top_visitors", R.top_visitors),
    ("qry26_monthly_uv_by_region", R.monthly_uv_by_region),
    ("qry27_monthly_region_matrix", R.monthly_region_matrix),
    ("qry28_employee_count", R.employee_count),
]:
    _model_query(_name, _fn)

from ..operators.visitor_bitmaps import VisitorBitmaps  # noqa: E402

_model_query("qry02_05_uv_all_grains", lambda model: VisitorBitmaps.of(model).all_grains())

# ---------------------------------------------------------------- DOC-1..5
DOC_FROM, DOC_TO = 19960101, 19961231
_model_query("doc1_uv_by_region_range", R.doc_uv_by_region, date_from=DOC_FROM, date_to=DOC_TO)
_model_query("doc2_views_by_website_month", R.doc_views_by_website_month)
_model_query("doc3_top_pages", R.doc_top_pages)
_model_query("doc4_traffic_by_channel", R.doc_traffic_by_channel)
_model_query("doc5_class_distribution", R.doc_class_distribution, date_from=DOC_FROM, date_to=DOC_TO)

# ---------------------------------------------------------------- MEA-1..38
from . import measures as MS  # noqa: E402

STRATEGY = Filters(equals={"newscategory": ["Strategy"]})
_model_query("mea01_07_core_by_contenttype", MS.core_measures, by=["contenttype"])
_model_query("mea08_09_reach_rate_by_month", MS.reach_rate, by=["year_month"])
_model_query("mea10_daily_average_uv_by_channel", MS.daily_average_uv, by=["referrerapplicationid"])
_model_query("mea11_reach_by_region", MS.reach_by_segment, segment="employeeregion")
_model_query("mea12_reach_by_division", MS.reach_by_segment, segment="employeebusinessdivision")
_model_query("mea13_reach_mom_change", MS.reach_mom_change)
_model_query("mea14_reach_trend_6m", MS.reach_trend_6m)
_model_query("mea15_17_homepage_article_ctr", MS.homepage_article_ctr, by=["referrerapplicationid"])
_model_query("mea18_21_journey_depth", MS.journey_depth, by=["referrerapplicationid"])
_model_query("mea22_engagement_conversion", MS.engagement_conversion, by=["contenttype"])
_model_query("mea23_24_channel_measures", MS.channel_measures, by=["contenttype"])
_model_query("mea25_page_ranks", MS.page_ranks)
_model_query("mea26_27_theme_context", MS.attribute_context, attribute="theme", detail="pagename")
for _attribute in ("newscategory", "contenttype", "websitename"):
    _model_query(f"mea26_27_{_attribute}_context", MS.attribute_context, attribute=_attribute, detail="pagename")
_model_query("mea28_30_performance_vs_avg", MS.performance_vs_avg, by=["pagename"])
_model_query("mea31_division_reach_for_content", MS.division_reach_for_content, filters=STRATEGY)
_model_query("mea32_divisions_not_reached", MS.segments_not_reached, by=["marketingpageid"])
_model_query("mea33_target_region_match", MS.target_match, by=["targetregion"])
_model_query("mea34_35_category_measures", MS.category_measures, by=["referrerapplicationid"])
_model_query("mea36_38_coverage", MS.coverage, by=["marketingpageid"])

# ------------------------------------------------------------- VAL, DIM, FIL
from ..functions import calendar as CAL  # noqa: E402
from ..operators import quality as Q  # noqa: E402
from ..schemas import FACT_KEY  # noqa: E402
from ..sources.tpch_star import journey_events, read_table  # noqa: E402
from . import search as SR  # noqa: E402

_q = lambda name: (lambda f: CATALOG.__setitem__(name, f))

_q("val1_duplicate_page_ids")(lambda s, d: Q.duplicate_keys(_star(s, d).page_inventory, ["marketingpageid"]))
_q("val1_duplicate_page_names")(lambda s, d: Q.duplicate_keys(_star(s, d).page_inventory, ["pagename"]))
_q("val2_duplicate_fact_keys")(lambda s, d: Q.duplicate_keys(_star(s, d).fact, FACT_KEY))
_q("val3_4_fact_key_stats")(lambda s, d: Q.key_stats(_star(s, d).fact, FACT_KEY))
_q("val5_orphan_pages")(lambda s, d: Q.orphans(_star(s, d).fact, _star(s, d).page_inventory, "marketingpageid"))
_q("val6_quality_summary")(lambda s, d: Q.quality_summary(_star(s, d)))
_q("val7_unmatched_visitors")(lambda s, d: Q.unmatched_visitors(_star(s, d).fact, _star(s, d).employee_contact))

_q("dim1_9_calendar_span")(lambda s, d: CAL.date_dim_spanning(read_table(s, d, "orders"), "o_orderdate"))
_q("dim10_calendar_summary")(lambda s, d: CAL.calendar_summary(
    CAL.date_dim_spanning(read_table(s, d, "orders"), "o_orderdate")))

FIL_SITE = Filters(date_from=19960101, date_to=19971231, website="brand#1")
FIL_URL = Filters(page_url="/promo/")
FIL_EQ = Filters(page_name="ring", equals={"contenttype": ["Homepage", "Article"],
                                           "employeeregion": ["ASIA", "EUROPE"]})
AS_OF = "2000-06-15"
_model_query("fil01_03_filtered_monthly", R.monthly_uv, filters=FIL_SITE)
_model_query("fil04_url_top_pages", R.top_pages_by_views, filters=FIL_URL)
_model_query("fil05_06_equals_region", R.uv_by_region, filters=FIL_EQ)
FIL_WEEKEND = Filters(equals={"is_weekend": [True], "year": [1995, 1996], "quarter": [1, 4]})
_model_query("fil06_weekend_filter", R.referrer_analysis, filters=FIL_WEEKEND)
_q("fil18_search_websites")(lambda s, d: SR.search_websites(_star(s, d).page_inventory, "#1"))
_q("fil19_search_pages")(lambda s, d: SR.search_pages(_star(s, d).page_inventory, "/promo/", 50))
_q("fil20_date_range")(lambda s, d: SR.date_range(_star(s, d).fact))

# ---------------------------------------------------------------- DSH-1..17
from . import dashboards as DS  # noqa: E402

_model_query("dsh01_executive_cards", DS.executive_cards)
_model_query("dsh01_top_pages", DS.top_pages_with_rate)
_model_query("dsh02_reach_vs_target", DS.reach_vs_target)
_model_query("dsh03_monthly_reach_by_region", DS.monthly_reach_by_region)
_model_query("dsh04_content_cards", DS.content_cards)
_model_query("dsh05_content_quadrants", DS.content_quadrants)
_model_query("dsh06_content_table", DS.content_table)
_model_query("dsh07_funnel", DS.funnel)
_model_query("dsh08_channel_mix", DS.channel_mix)
_model_query("dsh09_channel_table", DS.channel_table)
_model_query("dsh10_coverage_gauges", DS.coverage_gauges, by=["newscategory", "referrerapplicationid"])
_model_query("dsh11_gap_matrix", DS.gap_matrix)
_model_query("dsh12_missing_divisions", DS.missing_divisions)
_model_query("dsh13_strategic_vs_general", DS.strategic_vs_general)
_model_query("dsh14_theme_engagement_split", DS.theme_engagement_split)
_model_query("dsh15_theme_topic_tree", DS.theme_topic_tree)
_model_query("dsh16_uv_by_newscategory", DS.uv_by_attribute, attribute="newscategory")
_model_query("dsh17_low_reach_strategic_pages", DS.low_reach_strategic_pages)

# ---------------------------------------------------------------- ASK-1..20
from . import questions as QS  # noqa: E402

_model_query("ask01_generic_report", R.report, by=["contenttype", "referrerapplicationid"],
             metrics=("uv", "views", "engagement_rate"))
_model_query("ask02_period_compare", QS.period_compare, period_a=(19970101, 19970331),
             period_b=(19970401, 19970630))
_model_query("ask03_growth_by_channel", QS.growth, by=("referrerapplicationid",), metric="uv", grain="month")
_model_query("ask03_fastest_growing_sites", QS.fastest_growing, by=("websitename",), metric="views",
             grain="quarter", k=5)
_model_query("ask04_trend_last6_months", QS.trend, grain="month", n_periods=6, as_of=AS_OF)
_model_query("ask05_zero_engagement_pages", QS.zero_engagement_pages, by=["referrerapplicationid"])
_model_query("ask06_ignored_pages", QS.ignored_pages, by="referrerapplicationid")
_model_query("ask07_comments_without_likes", QS.comments_without_likes, by=["referrerapplicationid"])
_model_query("agg21_comments_per_page", QS.comments_per_page)
_model_query("ask08_top_by_ratio", QS.top_by_ratio, min_views=100, k=20)
_model_query("ask09_day_of_week_profile", QS.day_of_week_profile)
_model_query("ask09_weekend_profile", QS.day_of_week_profile, weekend=True)
_model_query("ask10_peak_month", QS.peak_period, grain="month", metric="uv")
_model_query("ask11_segment_share", QS.segment_share, segment="employeeclass", metric="uv")
_model_query("ask12_ab_compare", QS.ab_compare, filters_a=Filters(equals={"newscategory": ["Culture"]}),
             filters_b=Filters(equals={"newscategory": ["Strategy"]}))
_model_query("ask13_benchmark_page", QS.benchmark_page, page_id="1", group="contenttype")
_model_query("ask14_co_visit", QS.co_visit, filter_a=Filters(equals={"contenttype": ["Homepage"]}),
             filter_b=Filters(equals={"contenttype": ["Article"]}), by=("referrerapplicationid",))
_model_query("ask15_content_engagers", QS.content_engagers, content=STRATEGY, by=("contenttype",))
_model_query("ask16_reach_gap", QS.reach_gap, segment="employeebusinessdivision")
_model_query("ask17_target_org_match", QS.target_audience_match, kind="organization")
_q("ask19_page_lookup")(lambda s, d: QS.page_lookup(_star(s, d), "ring")["pages"])
_q("ask19_page_lookup_by_region")(lambda s, d: QS.page_lookup(_star(s, d), "ring")["by_region"])
_q("ask20_period_summary")(lambda s, d: QS.period_summary(_star(s, d), QS.named_periods(AS_OF)))

# ----------------------------------------------------------- ASK-18 journeys
from ..operators import journeys as J  # noqa: E402


def _sessions(s, d):
    return J.sessionize(journey_events(s, d), "user_id", "ts", gap_minutes=30)


_q("ask18_sessions")(lambda s, d: J.sessions(_sessions(s, d)))
_q("ask18_session_depth")(lambda s, d: J.session_depth(_sessions(s, d)))
_q("ask18_next_page")(lambda s, d: J.next_page_counts(_sessions(s, d)))
_q("ask18_common_paths3")(lambda s, d: J.common_paths(_sessions(s, d), 3, 20))

# -------------------------------------------------------------- WIN, SRT
from ..operators import reshape as RS  # noqa: E402
from ..operators import trends as TR  # noqa: E402


def _cumulative(s, d):
    w = _star(s, d).wide(page="left", date="inner")
    return TR.cumulative_reach(w.select("viewingcontactid", "date"), "viewingcontactid", "date")


_q("win5_cumulative_reach")(_cumulative)
_q("srt3_daily_engagement_tail30")(lambda s, d: RS.tail(R.daily_engagement(_star(s, d)), 30, "date"))
_q("srt4_top_pages_per_site")(lambda s, d: RS.top_k_per_group(
    DS.page_performance(_star(s, d)), "websitename", [F.desc("uv")], 3, tie_keys=["marketingpageid"]))

# ------------------------------------------------------------ MRG-2..6
from ..operators import merge as MG  # noqa: E402
from ..sources.tpch_star import employees_from_tpch, pages_from_tpch  # noqa: E402

EXTRACT_FROM, EXTRACT_TO, EXTRACT_GAP = 19980101, 19980331, 19980215


def fact_extract(star):
    """A 90-day re-export: corrected views, one day missing from the file."""
    f = star.fact
    return (f.where(F.col("visitdatekey").between(EXTRACT_FROM, EXTRACT_TO)
                    & (F.col("visitdatekey") != EXTRACT_GAP))
            .withColumn("views", F.col("views") + 1))


def page_extract(spark, sf_dir, cur):
    """New pages (parts missing from the inventory) + renamed articles."""
    new = pages_from_tpch(spark, sf_dir, all_parts=True).join(cur.select("marketingpageid"), "marketingpageid",
                                                              "left_anti")
    upd = cur.where(F.col("contenttype") == "Article").withColumn("pagename", F.upper("pagename"))
    return new.unionByName(upd)


def employee_extract(spark, sf_dir, cur):
    """New hires (customers missing from the table) + reclassified ASIA staff."""
    new = employees_from_tpch(spark, sf_dir, all_customers=True).join(cur.select("contactid"), "contactid",
                                                                       "left_anti")
    upd = cur.where(F.col("employeeregion") == "ASIA").withColumn("employeeclass", F.lit("Employee"))
    return new.unionByName(upd)


def _mrg2(s, d):
    st = _star(s, d)
    return MG.replace_range(st.fact, fact_extract(st))


def _mrg6(s, d):
    st = _star(s, d)
    inc = fact_extract(st)
    return MG.load_audit("fact", st.fact, inc, MG.replace_range(st.fact, inc))


def _mrg3(s, d):
    cur = _star(s, d).page_inventory
    return MG.upsert(cur, page_extract(s, d, cur), "marketingpageid")


def _mrg4(s, d):
    cur = _star(s, d).employee_contact
    return MG.upsert(cur, employee_extract(s, d, cur), "contactid")


CATALOG["mrg2_replace_range"] = _mrg2
CATALOG["mrg3_upsert_pages"] = _mrg3
CATALOG["mrg4_upsert_employees"] = _mrg4
CATALOG["mrg6_load_audit"] = _mrg6

# --------------------------- load path on storage (SRC-1..6, SNK-1..3, MRG-1..4, MRG-7, STR-1)
from . import load_path as LP  # noqa: E402

CATALOG.update(LP.QUERIES)

# approximate variant (no SQL twin: sketch estimates are engine-specific)
_model_query("mea14_reach_trend_6m_approx", MS.reach_trend_6m, approx=True)
_model_query("join8_viewer_set_semi_join", QS.also_viewed, content=STRATEGY, by=("contenttype",))
