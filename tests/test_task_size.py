"""Tasks of large joins and aggregates: their number follows the input's size, and wide attributes meet reduced rows."""

import re

import pytest

from portal_metrics import model as MD
from portal_metrics.sources import tpch_star as TS
from tests.conftest import SF_SMALL


@pytest.fixture()
def small_tasks(spark, monkeypatch):
    """The inputs of the smallest tables count as large: nothing is broadcast by size, a task reads few bytes."""
    monkeypatch.setattr(MD, "TASK_BYTES", 4096)
    monkeypatch.setattr(MD, "LEAST_TASKS", 1)
    monkeypatch.setattr(MD, "MOST_TASKS", 7)
    spark.conf.set("portal_metrics.broadcast.maxBytes", "0")
    yield MD.StarModel(TS.fact_from_tpch(spark, SF_SMALL), TS.pages_from_tpch(spark, SF_SMALL), TS.date_dim(spark, TS.CAL_START, TS.CAL_END),
                       TS.employees_from_tpch(spark, SF_SMALL))
    spark.conf.unset("portal_metrics.broadcast.maxBytes")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows(df):
    return sorted(map(repr, df.collect()))


def test_fact_join_in_tasks_by_size(star, small_tasks):
    p = plan(small_tasks.fact)
    assert re.search(r"RepartitionByExpression \[l_orderkey#\d+L?\], 7", p) and re.search(r"RepartitionByExpression \[o_orderkey#\d+L?\], 7", p), p
    assert rows(small_tasks.fact) == rows(star.fact)


def test_input_of_unknown_size_is_left_to_spark(spark):
    from tests.fixtures import fixture_model
    assert MD.tasks_for(fixture_model(spark).fact) is None


def test_page_reports_join_one_row_per_page(star):
    """Reports grouped by the page id count a page's visitors before its wide attributes are joined."""
    from portal_metrics.plans import dashboards as DS
    from portal_metrics.plans import questions as QS
    from portal_metrics.plans import reports as R
    for fn in (R.top_pages_by_uv, R.top_engaged_pages, R.top_pages_by_views, DS.page_performance, DS.top_pages_with_rate, lambda m: QS._pages(m, MD.NO_FILTERS)):
        p = plan(fn(star))
        below = p[p.index("LeftOuter"):]
        assert re.search(r"Aggregate \[marketingpageid#\d+\],", below), p
        assert "viewingcontactid" not in p[:p.index("LeftOuter")], p


def test_page_reports_with_repeated_and_missing_keys(spark):
    """Repeated inventory rows repeat sums and not visitors, also under another name; NULL pages and visitors are groups."""
    from portal_metrics.plans import dashboards as DS
    from portal_metrics.plans import questions as QS
    from tests.fixtures import FACT_ROWS, PAGE_ROWS, fixture_model
    m = fixture_model(spark, FACT_ROWS + [(20250103, "Email", None, 6, "u1", "F", 1, 1.0, 1.0, 1, None)],
                      pages=PAGE_ROWS + [PAGE_ROWS[0], dict(PAGE_ROWS[1], pagename="Other name")])
    got = {(r["marketingpageid"], r["pagename"]): (r["uv"], r["total_views"], r["engagements"]) for r in DS.page_performance(m).collect()}
    assert got == {("p1", "CEO message"): (2, 18, 4), ("p2", "Q3 results"): (2, 11, 3), ("p2", "Other name"): (2, 11, 3),
                   ("p9", "Unknown"): (0, 2, 0), (None, "Unknown"): (1, 6, 1)}
    by = {(r["marketingpageid"], r["referrerapplicationid"], r["pagename"]): (r["uv"], r["total_views"]) for r in QS._pages(m, MD.NO_FILTERS, ["referrerapplicationid"]).collect()}
    assert by[("p1", "Email", "CEO message")] == (2, 18) and by[("p1", "Intranet", "CEO message")] == (1, 0) and len(by) == 8


def test_attribute_reports_in_tasks_by_size(star, small_tasks):
    from portal_metrics.plans import measures as MS
    from portal_metrics.plans import reports as R
    p = plan(R.uv_by_website(small_tasks))
    assert re.search(r"RepartitionByExpression \[marketingpageid#\d+, viewingcontactid#\d+\], 7", p), p
    for fn in (R.uv_by_website, R.uv_by_theme, lambda m: MS.attribute_context(m, "theme")):
        assert rows(fn(small_tasks)) == rows(fn(star))


def test_coverage_counts_in_tasks_by_size(star, small_tasks):
    from portal_metrics.plans import measures as MS
    p = plan(MS.coverage(small_tasks, by=["marketingpageid"]))
    assert re.search(r"RepartitionByExpression \[marketingpageid#\d+, viewingcontactid#\d+\], 7", p), p
    for by in ((), ["marketingpageid"], ["newscategory"]):
        assert rows(MS.coverage(small_tasks, by=by)) == rows(MS.coverage(star, by=by))


def shuffles(df):
    """What the exchanges of a plan deal by, the last one first."""
    return re.findall(r"Exchange hashpartitioning\(([^)]*), (\d+)\)", re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString()))


def test_context_counts_visitors_in_tasks_by_size(small_tasks, monkeypatch):
    """Both levels count visitors in one stage of tasks set by size, after one shuffle of the (page, visitor) rows."""
    from portal_metrics.plans import measures as MS
    for attribute in ("contenttype", "theme", "newscategory", "websitename"):
        seen = []
        monkeypatch.setattr(MS, "written", lambda df, name, seen=seen: seen.append(df) or df)
        MS.attribute_context(small_tasks, attribute)
        assert "Expand" not in plan(seen[0])
        by = shuffles(seen[0])
        assert by[0][0] == f"_level, _{attribute}, _pagename" and by[1] == (f"_{attribute}, viewingcontactid, _anon", "7"), by
        # the other shuffles of rows that hold a visitor are sized, too; the page join leaves a hot page to AQE
        assert {n for keys, n in by if "viewingcontactid" in keys or "orderkey" in keys} == {"7"}, by
        assert "ShuffledHashJoin" in seen[0]._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("tasks", [None, 5])
def test_context_of_rows_without_visitor_or_page(spark, monkeypatch, tasks):
    """Rows without a visitor are no visitor however they are dealt; repeated pages repeat sums; NULL details are a group."""
    from portal_metrics.plans import measures as MS
    from portal_metrics.plans import reports as R
    from tests.fixtures import FACT_ROWS, PAGE_ROWS, fixture_model
    for module in (MS, R):
        monkeypatch.setattr(module, "tasks_for", lambda *dfs: tasks)
    none = [(20250101 + i % 9, "Email", page, 2, None, "F", 1, 1.0, 1.0, 1, None) for i in range(40) for page in ("p1", "p2", None)]
    m = fixture_model(spark, [*FACT_ROWS, *none, (20250103, "Email", None, 6, "u1", "F", 1, 1.0, 1.0, 1, None)],
                      pages=[*PAGE_ROWS, PAGE_ROWS[0], dict(PAGE_ROWS[1], pagename="Other name")])
    w = [r.asDict() for r in m.fact.join(m.page_inventory, "marketingpageid", "left").collect()]
    for attribute, detail in (("contenttype", "pagename"), ("theme", "marketingpageid")):
        label = lambda r, c: r[c] if c == "marketingpageid" else r[c] or "Unknown"

        def value(rows):
            views = sum(r["views"] for r in rows)
            liked = sum(r["marketingpageidliked"] not in (None, "") for r in rows)
            return len({r["viewingcontactid"] for r in rows} - {None}), 100 * (liked + sum(r["comments"] or 0 for r in rows)) / views if views else 0.0

        want = set()
        for a, d in {(label(r, attribute), label(r, detail)) for r in w}:
            fine = value([r for r in w if (label(r, attribute), label(r, detail)) == (a, d)])
            want.add((a, d, *fine, *value([r for r in w if label(r, attribute) == a])))
        got = MS.attribute_context(m, attribute, detail).collect()
        assert len(got) == len(want)
        assert {(r[0], r[1], r[2], pytest.approx(r[3]), r[4], pytest.approx(r[5])) == x for r in got for x in want if r[:2] == x[:2]} == {True}
