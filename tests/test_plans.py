"""Plan checks: broadcasts where the size is bounded, pushed filters and
partition pruning, no Python UDF anywhere, one exchange per group-by."""

from portal_metrics.functions.filters import Filters
from portal_metrics.plans import catalog, reports


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dimension_joins_broadcast(spark, star):
    p = _plan(reports.monthly_uv(star))
    assert "BroadcastHashJoin" in p
    assert "SortMergeJoin" not in p


def test_date_filter_pushed_to_scan(spark, star):
    df = reports.summary(star, Filters(date_from=19960101, date_to=19961231))
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in p and "IsNotNull(o_orderdate)" in p


def test_partition_pruning_on_stored_fact(spark, star, tmp_path):
    from portal_metrics.model import StarModel
    from portal_metrics.sources.store import StarStore
    st = StarStore(spark, str(tmp_path / "s"))
    st.full_refresh_fact(star.fact)
    m = StarModel(st.fact(), star.page_inventory, star.dim_date, star.employee_contact)
    p = _plan(reports.summary(m, Filters(date_from=19960101, date_to=19960331)))
    assert "PartitionFilters: [isnotnull(visit_month" in p and "visit_month#" in p


def test_no_python_udfs(spark):
    from tests.conftest import SF_SMALL
    for name, fn in catalog.CATALOG.items():
        p = _plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_bounded_broadcast_respects_limit(spark, star):
    from portal_metrics.model import bounded_broadcast, plan_size_bytes
    pages = star.page_inventory
    assert plan_size_bytes(pages) > 0
    hinted = bounded_broadcast(pages, max_bytes=1)
    assert "broadcast" not in hinted._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" in bounded_broadcast(pages)._jdf.queryExecution().logical().toString().lower()


def test_validated_unique_page_keys_drop_unused_join(spark, star):
    m = star.with_unique_page_keys()
    p = m.wide(page="left").groupBy("visitdatekey").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in p
    for fn in (reports.monthly_uv, reports.uv_by_website, reports.uv_by_region, reports.summary):
        assert sorted(map(tuple, fn(m).collect())) == sorted(map(tuple, fn(star).collect())), fn.__name__


def test_duplicate_page_keys_keep_the_join(spark):
    from tests.fixtures import PAGE_ROWS, fixture_model
    m = fixture_model(spark, pages=PAGE_ROWS + [PAGE_ROWS[0]])
    assert m.with_unique_page_keys() is m


def test_page_partials_path_equals_broadcast_path(spark, star):
    """Beyond the broadcast size check, page-grouped reports pre-aggregate the
    fact per (page, visitor) before the page join; results must not change."""
    from portal_metrics.plans import dashboards, measures
    fns = [reports.uv_by_website, reports.uv_by_theme, reports.top_engaged_pages,
           reports.engagement_by_contenttype, reports.top_pages_by_views, reports.top_pages_by_uv,
           reports.rows_per_website, reports.top15_pages_chart, reports.uv_by_website_chart,
           reports.engagement_chart, dashboards.page_performance, dashboards.funnel,
           lambda m, f: measures.homepage_article_ctr(m, ["referrerapplicationid"], f),
           lambda m, f: measures.engagement_conversion(m, ["contenttype"], f)]
    for f in (Filters(), Filters(date_from=19960101, date_to=19971231, website="brand#1",
                                 equals={"referrerapplicationid": ["Email"]})):
        base = {i: sorted(map(tuple, fn(star, f).collect())) for i, fn in enumerate(fns)}
        spark.conf.set("portal_metrics.broadcast.maxBytes", "0")
        try:
            import re
            from portal_metrics.model import fits_broadcast
            assert not fits_broadcast(star.page_inventory)
            plan = reports.uv_by_website(star, f)._jdf.queryExecution().optimizedPlan().toString()
            # the fact is aggregated per (page, visitor) below the page join
            assert re.search(r"Aggregate \[marketingpageid#\d+, viewingcontactid#\d+\]", plan), plan
            for i, fn in enumerate(fns):
                assert sorted(map(tuple, fn(star, f).collect())) == base[i], (i, fn)
        finally:
            spark.conf.unset("portal_metrics.broadcast.maxBytes")


def test_generic_report_page_partials(spark, star):
    by, mets = ["contenttype", "referrerapplicationid", "year_month"], ["uv", "views", "engagement_rate", "pages"]
    base = sorted(map(tuple, reports.report(star, by, mets).collect()))
    spark.conf.set("portal_metrics.broadcast.maxBytes", "0")
    try:
        assert sorted(map(tuple, reports.report(star, by, mets).collect())) == base
    finally:
        spark.conf.unset("portal_metrics.broadcast.maxBytes")
