"""Reports and measures on the hand-written star (FIXTURES.md §3)."""

from pyspark.sql import functions as F

from portal_metrics.plans import measures as MS
from portal_metrics.plans import reports as R
from tests.fixtures import FACT_ROWS, fixture_model


def test_summary_semantics(spark):
    m = fixture_model(spark)
    s = R.summary(m).first()
    assert s["total_rows"] == 7
    assert s["total_unique_visitors"] == 4          # NULL visitor ignored (M1)
    assert s["total_likes"] == 2                    # '' and NULL are not likes (M2)
    assert s["total_comments"] == 3
    assert s["total_engagements"] == 5
    assert s["first_date"] == 20211231              # outside the calendar, still in totals (M6)


def test_calendar_inner_join_drops_outside_days(spark):
    m = fixture_model(spark)
    mon = {r["year_month"]: r for r in R.monthly_uv(m).collect()}
    assert set(mon) == {"2025-01", "2025-02"}
    assert mon["2025-02"]["unique_visitors"] == 1 and mon["2025-02"]["total_views"] == 8


def test_engagement_null_vs_zero(spark):
    rows = [(20250101, "Email", "p1", 0, "u1", "F", 1, 1.0, 1.0, None, None)]
    m = fixture_model(spark, fact_rows=rows)
    r = R.overall_engagement(m).first()
    assert r["total_comments"] is None and r["total_engagements"] is None   # AGG-6 NULL
    assert r["engagement_rate_pct"] is None                                # NULLIF on 0 views
    c = MS.core_measures(m).first()
    assert c["engagements"] == 0 and c["engagement_rate"] == 0.0          # measure form: blank = 0


def test_region_report_labels_unknown(spark):
    m = fixture_model(spark)
    reg = {r["region"]: r for r in R.uv_by_region(m).collect()}
    assert reg["EMEA"]["unique_visitors"] == 2
    assert reg["Unknown"]["unique_visitors"] == 1       # u4 unmatched; NULL visitor not counted
    assert sum(r["total_views"] for r in reg.values()) == sum(x[3] for x in FACT_ROWS)


def test_top_visitors_null_group(spark):
    m = fixture_model(spark)
    tv = R.top_visitors(m).collect()
    assert len(tv) == 5                                  # u1, u2, u3, u4 and the NULL-visitor group
    assert tv[0]["total_views"] == 8                     # u3


def test_pivot_total_is_row_sum(spark):
    m = fixture_model(spark)
    p = R.region_division_matrix(m)
    cells = [c for c in p.columns if c not in ("business_division", "Total")]
    for r in p.collect():
        assert r["Total"] == sum(r[c] for c in cells)


def test_reach_segments_keep_zero_viewers(spark):
    m = fixture_model(spark)
    r = {x["employeeregion"]: x for x in MS.reach_by_segment(m, "employeeregion").collect()}
    assert r["AMER"]["uv"] == 0 and r["AMER"]["reach_rate"] == 0.0
    assert r["EMEA"]["reach_rate"] == 100.0


def test_mom_gap_month_compares_with_nothing(spark):
    rows = [(20250110, "Email", "p1", 1, "u1", "F", 1, 1.0, 1.0, 0, None),
            (20250310, "Email", "p1", 1, "u1", "F", 1, 1.0, 1.0, 0, None),
            (20250311, "Email", "p1", 1, "u2", "F", 1, 1.0, 1.0, 0, None)]
    m = fixture_model(spark, fact_rows=rows)
    mom = {r["year_month"]: r for r in MS.reach_mom_change(m).collect()}
    assert mom["2025-03"]["prev_month_uv"] is None and mom["2025-03"]["mom_change_pct"] == 0.0


def test_moving_average_needs_seven_rows(spark):
    rows = [(20250100 + d, "Email", "p1", 1, f"u{d % 3}", "F", 1, 1.0, 1.0, 0, None) for d in (1, 2, 3, 5, 6, 7, 8, 9)]
    m = fixture_model(spark, fact_rows=rows)
    ma = R.daily_uv_ma7(m).collect()
    assert [r["uv_ma7"] is None for r in ma] == [True] * 6 + [False] * 2
    assert abs(ma[6]["uv_ma7"] - sum(r["unique_visitors"] for r in ma[:7]) / 7) < 1e-12


def test_truncate_label(spark):
    from portal_metrics.functions.metrics import truncate_label
    df = spark.createDataFrame([("a" * 43,), ("b" * 44,)], "page string")
    out = [r[0] for r in df.select(truncate_label("page")).collect()]
    assert out == ["a" * 43, "b" * 40 + "..."]


def test_uv_not_additive_property(spark, star):
    tot = R.summary(star).first()["total_unique_visitors"]
    parts = [r["unique_visitors"] for r in R.uv_by_website(star).collect()]
    assert max(parts) <= tot <= sum(parts)
    mon = R.monthly_uv(star).agg(F.sum("total_views")).first()[0]
    cal = star.wide(date="inner").agg(F.sum("views")).first()[0]
    assert mon == cal


def test_share_sums_to_100(spark, star):
    from portal_metrics.plans.dashboards import channel_mix
    s = sum(r["share_pct"] for r in channel_mix(star).collect())
    assert abs(s - 100.0) < 0.05


def test_rolling_distinct_approx_close_to_exact(spark, star):
    exact = {r["month"]: r["uv_6m"] for r in MS.reach_trend_6m(star).collect()}
    approx = {r["month"]: r["uv_6m"] for r in MS.reach_trend_6m(star, approx=True).collect()}
    assert exact.keys() == approx.keys()
    for m, v in exact.items():
        assert abs(approx[m] - v) <= max(2, 0.05 * v), (m, v, approx[m])


def test_generic_report_eager_equals_raw_join(spark, star):
    by = ["employeeregion", "year_month", "contenttype"]
    mets = ["uv", "views", "likes", "comments", "engagements", "engagement_rate", "rows"]
    a = sorted(tuple(r) for r in R.report(star, by, mets).collect())
    b = sorted(tuple(r) for r in R.report(star, by, mets, eager=False).collect())
    assert a == b and len(a) > 0


def test_growth_by_employee_attribute_matches_raw(spark, star):
    from portal_metrics.plans import questions as Q
    from pyspark.sql import functions as F
    g = Q.growth(star, by=("employeeregion",), metric="views", grain="quarter")
    raw = (star.wide(page="left", date="inner", employee="left")
           .groupBy(F.coalesce("employeeregion", F.lit("Unknown")).alias("employeeregion"),
                    F.trunc("date", "quarter").alias("period_start"))
           .agg(F.sum("views").alias("views")))
    a = sorted((r["employeeregion"], r["period_start"], r["views"]) for r in g.collect())
    b = sorted((r["employeeregion"], r["period_start"], r["views"]) for r in raw.collect())
    assert a == b


def _raw_ab(star, fa, fb):
    from pyspark.sql import functions as F
    from portal_metrics.plans.questions import _compare_rows, _cond_metrics
    w = star.wide(page="left", employee="left")
    pa, pb = fa.predicate(), fb.predicate()
    return _compare_rows(w.where(pa | pb).agg(*_cond_metrics(pa, "_a"), *_cond_metrics(pb, "_b")), "side_a", "side_b")


def test_ab_compare_with_employee_sides_matches_raw_join(spark, star):
    from portal_metrics.functions.filters import Filters
    from portal_metrics.plans import questions as Q
    fa = Filters(equals={"employeeregion": ["ASIA"], "contenttype": ["Article"]})
    fb = Filters(equals={"employeeregion": ["EUROPE"]})
    a = sorted(tuple(r) for r in Q.ab_compare(star, fa, fb).collect())
    b = sorted(tuple(r) for r in _raw_ab(star, fa, fb).collect())
    assert a == b


def test_co_visit_with_employee_by_matches_raw_join(spark, star):
    from pyspark.sql import functions as F
    from portal_metrics.functions.filters import Filters
    from portal_metrics.plans import questions as Q
    fa = Filters(equals={"contenttype": ["Homepage"]})
    fb = Filters(equals={"contenttype": ["Article"], "employeeclass": ["Employee"]})
    got = {r["employeeregion"]: (r["visitors_a"], r["visitors_b"], r["visitors_both"])
           for r in Q.co_visit(star, fa, fb, by=("employeeregion",)).collect()}
    w = star.wide(page="left", employee="left").where(F.col("viewingcontactid").isNotNull())
    per = w.groupBy(F.coalesce("employeeregion", F.lit("Unknown")).alias("r"), "viewingcontactid").agg(
        F.max(F.coalesce(fa.predicate(), F.lit(False))).alias("a"),
        F.max(F.coalesce(fb.predicate(), F.lit(False))).alias("b"))
    exp = {r["r"]: (r["x"], r["y"], r["z"]) for r in per.groupBy("r").agg(
        F.count_if("a").alias("x"), F.count_if("b").alias("y"), F.count_if(F.col("a") & F.col("b")).alias("z")).collect()}
    assert got == exp


def test_distinct_measures_by_employee_match_raw_join(spark, star):
    from pyspark.sql import functions as F
    from portal_metrics.functions.filters import Filters
    f = Filters(equals={"employeeclass": ["Employee", "Intern"]})
    raw = star.wide(f, page="left", date="inner", employee="left")
    reg = F.coalesce("employeeregion", F.lit("Unknown")).alias("employeeregion")
    daily = raw.groupBy(reg, "date").agg(F.count_distinct("viewingcontactid").alias("u"))
    exp = {r[0]: r[1] for r in daily.groupBy("employeeregion").agg(F.avg("u")).collect()}
    got = {r["employeeregion"]: r["daily_average_uv"]
           for r in MS.daily_average_uv(star, ["employeeregion"], f).collect()}
    assert got.keys() == exp.keys() and all(abs(got[k] - exp[k]) < 1e-9 for k in got)
    mon = raw.groupBy(reg, "year_month").agg(F.count_distinct("viewingcontactid").alias("uv"))
    exp_m = sorted((r[0], r[1], r[2]) for r in mon.collect())
    got_m = sorted((r["employeeregion"], r["year_month"], r["uv"])
                   for r in MS.reach_mom_change(star, ["employeeregion"], f).collect())
    assert got_m == exp_m
    tr = {(r["employeeregion"], r["month"]): r["uv_6m"] for r in MS.reach_trend_6m(star, f, by=["employeeregion"]).collect()}
    v = raw.select(reg, "viewingcontactid", "date").where(F.col("viewingcontactid").isNotNull()).collect()
    import datetime as dt
    for (region, month), n in list(tr.items())[:40]:
        end = (month.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
        m = end.month - 6
        start = dt.date(end.year + (m - 1) // 12, (m - 1) % 12 + 1, 1)
        import calendar
        start = start.replace(day=min(end.day, calendar.monthrange(start.year, start.month)[1]))
        assert n == len({r[1] for r in v if r[0] == region and start < r[2] <= end}), (region, month)


def test_conditional_measures_by_employee_match_raw_join(spark, star):
    from pyspark.sql import functions as F
    from portal_metrics.plans.measures import _agg
    from portal_metrics.functions import metrics as Mx
    by = ["employeeregion", "contenttype"]
    got = sorted(map(tuple, MS.channel_measures(star, by).select(
        "employeeregion", "contenttype", "email_uv", "email_engagement_rate", "intranet_uv",
        "intranet_engagement_rate").collect()))
    cols = []
    for ch in ("Email", "Intranet"):
        on = F.coalesce(F.col("referrerapplicationid") == ch, F.lit(False))
        lk = F.count_if(on & Mx.is_like())
        cm = F.coalesce(F.sum(F.when(on, F.col("comments"))), F.lit(0).cast("long"))
        cols += [F.count_distinct(F.when(on, F.col("viewingcontactid"))).alias(f"{ch.lower()}_uv"),
                 Mx.pct_zero(lk + cm, F.sum(F.when(on, F.col("views")))).alias(f"{ch.lower()}_engagement_rate")]
    exp = sorted(map(tuple, _agg(star, by, MS.NO_FILTERS, cols).select(
        "employeeregion", "contenttype", "email_uv", "email_engagement_rate", "intranet_uv",
        "intranet_engagement_rate").collect()))
    assert got == exp and len(got) > 0


def test_journey_depth_by_employee_eager_equals_raw(spark, star):
    from portal_metrics.functions.filters import Filters
    f = Filters(equals={"employeeclass": ["Employee"]})
    for by, flt in ((["employeeregion"], Filters()), (["employeeregion", "referrerapplicationid"], f)):
        a = sorted(map(tuple, MS.journey_depth(star, by, flt).select(*by, "uv", "multi_page_visitors",
                   "avg_pages_per_visitor", "views_per_visitor", "mean_pages_per_visitor").collect()))
        b = sorted(map(tuple, MS.journey_depth(star, by, flt, eager=False).select(*by, "uv", "multi_page_visitors",
                   "avg_pages_per_visitor", "views_per_visitor", "mean_pages_per_visitor").collect()))
        assert a == b and len(a) > 0


def test_visitor_flags_by_employee_match_raw_join(spark, star):
    from pyspark.sql import functions as F
    got = sorted(map(tuple, MS.homepage_article_ctr(star, ["employeeregion"]).select(
        "employeeregion", "homepage_visitors", "article_visitors", "both_visitors").collect()))
    w = star.wide(page="left", employee="left").where(F.col("viewingcontactid").isNotNull())
    ct = F.col("contenttype")
    pv = w.groupBy(F.coalesce("employeeregion", F.lit("Unknown")).alias("employeeregion"), "viewingcontactid").agg(
        F.max(F.coalesce(ct == "Homepage", F.lit(False))).alias("h"),
        F.max(F.coalesce(ct == "Article", F.lit(False))).alias("a"))
    exp = sorted(map(tuple, pv.groupBy("employeeregion").agg(
        F.count_if("h"), F.count_if("a"), F.count_if(F.col("h") & F.col("a"))).collect()))
    assert got == exp


def test_context_and_benchmark_by_employee_match_raw_join(spark, star):
    from pyspark.sql import functions as F
    from portal_metrics.functions import metrics as Mx
    from portal_metrics.functions.filters import Filters
    f = Filters(equals={"employeeclass": ["Employee"]})
    got = sorted(map(tuple, MS.attribute_context(star, "employeeregion", "contenttype", f).select(
        "employeeregion", "contenttype", "uv", "engagement_rate", "employeeregion_uv",
        "employeeregion_engagement_rate").collect()))
    w = star.wide(f, page="left", employee="left")
    a = F.coalesce("employeeregion", F.lit("Unknown")).alias("employeeregion")
    fine = w.groupBy(a, F.coalesce("contenttype", F.lit("Unknown")).alias("contenttype")).agg(
        Mx.uv().alias("uv"), Mx.engagement_rate_zero().alias("engagement_rate"))
    coarse = w.groupBy(a).agg(Mx.uv().alias("employeeregion_uv"),
                              Mx.engagement_rate_zero().alias("employeeregion_engagement_rate"))
    exp = sorted(map(tuple, fine.join(coarse, "employeeregion", "left").select(
        "employeeregion", "contenttype", "uv", "engagement_rate", "employeeregion_uv",
        "employeeregion_engagement_rate").collect()))
    assert got == exp
    pv = MS.performance_vs_avg(star, ["employeeregion"], f).collect()
    avg = w.select(Mx.engagement_rate_zero()).first()[0]
    assert all(r["avg_engagement_rate"] == avg for r in pv) and len(pv) > 0
