"""Interval sweep, distributed ranks and medians, visitor bitmaps, calendar predicates and period segments, against brute force."""
import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from portal_metrics.functions.calendar import calendar_columns
from portal_metrics.functions.filters import Filters
from portal_metrics.model import StarModel
from portal_metrics.operators.ranking import dense_ranks, exact_median
from portal_metrics.operators.trends import rolling_distinct
from portal_metrics.operators.visitor_bitmaps import VisitorBitmaps, dense_numbers
from portal_metrics.plans import measures, questions, reports
from portal_metrics.sources.store import StarStore
from tests.fixtures import fixture_model


def _plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


# ------------------------------------------------------------------ WIN-4
def add_months(d, n):
    m = d.year * 12 + d.month - 1 + n
    last = [31, 29 if m // 12 % 4 == 0 and (m // 12 % 100 or m // 12 % 400 == 0) else 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31][m % 12]
    return dt.date(m // 12, m % 12 + 1, min(d.day, last))


def last_day(d):
    return add_months(d.replace(day=1), 1) - dt.timedelta(days=1)


@pytest.mark.parametrize("months", [1, 2, 6])
def test_rolling_sweep_is_the_distinct_count(spark, months):
    rng = random.Random(months)
    day0 = dt.date(2023, 5, 1)
    rows = [(rng.choice(["a", None]), rng.choice(["v1", "v2", "v3", "v4", None]), day0 + dt.timedelta(days=rng.randrange(900))) for _ in range(120)]
    rows += [("a", "m", d) for d in (dt.date(2023, 8, 28), dt.date(2024, 8, 29), dt.date(2023, 8, 31), dt.date(2024, 2, 29), dt.date(2024, 12, 31))]
    got = rolling_distinct(spark.createDataFrame(rows, "g string, who string, day date"), "who", "day", months, by=["g"]).collect()
    want = []
    for g, m in {(g, d.replace(day=1)) for g, _, d in rows}:
        end = last_day(m)
        want.append((g, m, len({w for h, w, d in rows if h == g and w and add_months(end, -months) < d <= end})))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_rolling_sweep_reads_the_fact_once(star):
    p = _plan(measures.reach_trend_6m(star), "optimizedPlan")
    assert p.count("l_quantity") <= 2 and p.count("Relation [l_orderkey") == 1


# ------------------------------------------------------------- WIN-2, AGG-20
@pytest.mark.parametrize("ranges", [1, 3, 256])
def test_dense_ranks(spark, ranges):
    rng = random.Random(ranges)
    rows = [(i, rng.choice([None, 0, 0, 0, rng.randrange(40)]), rng.choice([None, 1.5, rng.random()])) for i in range(400)]
    got = dense_ranks(spark.createDataFrame(rows, "id int, a int, b double"), {"a": "ra", "b": "rb"}, ranges).collect()
    for col, out in ((1, "ra"), (2, "rb")):
        order = sorted({r[col] for r in rows}, key=lambda x: (x is None, -(x or 0)))
        assert {r["id"]: r[out] for r in got} == {r[0]: order.index(r[col]) + 1 for r in rows}
    assert dense_ranks(spark.createDataFrame([], "a int"), {"a": "ra"}, ranges).collect() == []


def test_page_ranks_have_no_global_window(star):
    p = _plan(measures.page_ranks(star), "optimizedPlan")
    windows = [line for line in p.splitlines() if "Window [" in line]
    # those without a partition are sums of one row a range
    assert windows and all("_range#" in line for line in windows)


@pytest.mark.parametrize("values", [[], [None], [3.0], [1.0, 2.0], [5.0] * 9, [0.0] * 50 + [1e-300, 1e300], [-1.0, None, 7.5, 2.25], [float(i % 17) / 7 for i in range(500)]])
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    got = exact_median(df, "v", bins=4)
    known = [v for v in values if v is not None]
    assert got == (statistics.median(known) if known else None)
    assert got == df.select(F.median("v")).first()[0]


# ---------------------------------------------------------------- QRY-2..5
def test_dense_numbers(spark):
    got = dense_numbers(spark.createDataFrame([(f"v{i % 70}",) for i in range(200)] + [(None,)], "v string"), "v", "n", ranges=5).collect()
    assert sorted(r["n"] for r in got) == list(range(1, 71)) and len({r["v"] for r in got}) == 70


def test_bitmap_reports_are_the_plain_ones(star, spark):
    for model in (star, fixture_model(spark)):
        b = VisitorBitmaps.of(model)
        for grain, fn, key, start in (("day", reports.daily_uv, "date", "date"), ("week", reports.weekly_uv, "year_week", "week_start"),
                                      ("month", reports.monthly_uv, "year_month", "month_start"), ("quarter", reports.quarterly_uv, "year_quarter", "quarter_start")):
            cols = ["unique_visitors", "total_views", "total_visits", "likes", "comments", "engagements"]
            got = b.report(grain).select("period", "period_start", *cols).collect()
            want = fn(model).select(F.col(key).cast("string"), F.col(start).alias("s"), *cols).collect()
            assert sorted(map(tuple, got)) == sorted(map(tuple, want)), grain


# ------------------------------------------------------------------- FIL-6
CONDITIONS = [{"is_weekend": [True]}, {"year": [1996, 1998]}, {"year_month": ["1995-02", "1997-12"]}, {"year_quarter": ["Q1 1996"]}, {"quarter": [4]}, {"month_name": ["May"]},
              {"day_of_week": [1], "year": [1997]}, {"year_week": ["1996-W01"]}, {"date": [dt.date(1996, 5, 3)]}, {"datekey": [19960503]}, {"is_quarter_end": [True]},
              {"quarter_name": ["Q2"], "contenttype": ["Homepage"]}]


@pytest.mark.parametrize("equals", CONDITIONS, ids=str)
def test_calendar_conditions_need_no_calendar(star, equals):
    f = Filters(equals=equals)
    cal = {k: v for k, v in equals.items() if k != "contenttype"}
    joined = star.fact.join(star.dim_date, F.col("visitdatekey") == F.col("datekey"))
    for k, v in cal.items():
        joined = joined.where(F.col(k).isin(v))
    joined = joined.join(star.page_inventory, "marketingpageid", "left")
    if "contenttype" in equals:
        joined = joined.where(F.col("contenttype").isin(equals["contenttype"]))
    want = joined.agg(F.count("*"), F.sum("views")).first()
    w = star.wide(f, page="left")
    assert w.agg(F.count("*"), F.sum("views")).first() == want and want[0] >= 0
    assert "datekey" not in w.columns


def test_calendar_conditions_prune_months(spark, star, tmp_path):
    store = StarStore(spark, str(tmp_path / "s"))
    store.full_refresh_fact(star.fact)
    m = StarModel(store.fact(), star.page_inventory, star.dim_date, star.employee_contact)
    f = Filters(equals={"is_weekend": [True], "quarter": [1], "year": [1996]})
    df = reports.referrer_analysis(m, f)
    p = _plan(df)
    scan = next(line for line in p.splitlines() if "PartitionFilters" in line and "visit_month" in line)
    assert "PartitionFilters: [" in scan and "quarter" in scan.split("PartitionFilters")[1] and "GreaterThanOrEqual(visitdatekey,19960101)" in scan
    assert len(m.fact.where(f.fact_predicate(m.fact.columns)).inputFiles()) >= 1
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, reports.referrer_analysis(star, f).collect()))


def test_bad_day_keys_meet_no_calendar_condition(spark):
    model = fixture_model(spark, fact_rows=[(k, "Email", "p1", 1, "u1", "F", 1, 1.0, 1.0, 0, None) for k in (20250230, None, 7, 20250104)])
    assert model.wide(Filters(equals={"is_weekend": [True]}), page=None).count() == 1
    assert model.wide(Filters(equals={"is_weekend": [True, False]}), page=None).count() == 1


# ------------------------------------------------------------------ ASK-20
def test_overlapping_periods(spark, star):
    periods = {"all": (19900101, None), "y96": (19960101, 19961231), "q": (19960401, 19960630), "day": (19960501, 19960501), "y96_97": (19960101, 19971231), "none": (20300101, 20301231)}
    df = questions.period_summary(star, periods)
    got = {r["period"]: (r["uv"], r["total_views"], r["likes"], r["comments"]) for r in df.collect()}
    for name, (lo, hi) in periods.items():
        s = star.wide(Filters(date_from=lo, date_to=hi), page="left").agg(
            F.count_distinct("viewingcontactid"), F.sum("views"), F.count_if((F.col("marketingpageidliked") != "")), F.sum("comments")).first()
        assert got.get(name) == (tuple(s) if s[1] is not None else None), name
    p = _plan(df)
    assert "NestedLoop" not in p and "Cartesian" not in p


def test_calendar_columns_are_named_in_stored_order(spark):
    from portal_metrics.schemas import DATE_COLUMNS
    df = spark.sql("SELECT DATE'2024-02-29' AS d").select(*calendar_columns(F.col("d")))
    assert df.columns == [n for n, _ in DATE_COLUMNS]
