"""Skewed input: one visitor owns a third of all rows, NULL visitors another
third, and one page gets most views.  The per-visitor pre-aggregation and
the exploded rolling window must still give the brute-force answers."""

import datetime as dt
import random

import pandas as pd

from portal_metrics.plans import measures as MS
from portal_metrics.plans import reports as R
from tests.fixtures import EMP_ROWS, PAGE_ROWS, fixture_model


def _rows(n=3000, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        day = dt.date(2025, 1, 1) + dt.timedelta(days=rnd.randrange(300))
        key = day.year * 10000 + day.month * 100 + day.day
        who = "u1" if i % 3 == 0 else (None if i % 3 == 1 else rnd.choice(["u2", "u3", "u4", "u5", "u9"]))
        page = "p1" if rnd.random() < 0.8 else rnd.choice(["p2", "p9"])
        out.append((key, rnd.choice(["Email", "Intranet"]), page, rnd.randrange(5), who, "F", 1,
                    1.0, 1.0, rnd.choice([0, 1, None]), rnd.choice([None, "", page])))
    return out


def _pdf(rows):
    cols = ["visitdatekey", "ref", "page", "views", "who", "flag", "visits", "ds", "da", "comments", "liked"]
    df = pd.DataFrame(rows, columns=cols)
    emp = pd.DataFrame(EMP_ROWS).rename(columns={"contactid": "who"})
    return df.merge(emp, on="who", how="left")


def test_region_report_under_skew(spark):
    rows = _rows()
    m = fixture_model(spark, fact_rows=rows)
    got = {r["region"]: (r["unique_visitors"], r["total_views"]) for r in R.uv_by_region(m).collect()}
    pdf = _pdf(rows)
    pdf["region"] = pdf["employeeregion"].fillna("Unknown")
    exp = {k: (int(g["who"].nunique()), int(g["views"].sum())) for k, g in pdf.groupby("region", dropna=False)}
    assert got == exp


def test_top_visitors_under_skew(spark):
    rows = _rows()
    m = fixture_model(spark, fact_rows=rows)
    top = R.top_visitors(m).collect()
    pdf = _pdf(rows)
    hot = pdf[pdf.who == "u1"]
    nulls = pdf[pdf.who.isna()]
    by_views = sorted([(int(hot.views.sum()), int(hot.page.nunique()), int(hot.visitdatekey.nunique())),
                       (int(nulls.views.sum()), int(nulls.page.nunique()), int(nulls.visitdatekey.nunique()))],
                      reverse=True)
    assert [(r["total_views"], r["pages_visited"], r["days_active"]) for r in top[:2]] == by_views


def test_reach_and_rolling_under_skew(spark):
    rows = _rows()
    m = fixture_model(spark, fact_rows=rows)
    reach = {r["employeeregion"]: r["uv"] for r in MS.reach_by_segment(m, "employeeregion").collect()}
    assert reach == {"EMEA": 2, "APAC": 1, "AMER": 1}
    pdf = _pdf(rows)
    pdf["date"] = pd.to_datetime(pdf.visitdatekey.astype(str))
    got = {r["month"]: r["uv_6m"] for r in MS.reach_trend_6m(m).collect()}
    for month, v in got.items():
        end = (pd.Timestamp(month) + pd.offsets.MonthEnd(0))
        start = end - pd.DateOffset(months=6)
        win = pdf[(pdf.date <= end) & (pdf.date > start)]
        assert v == win.who.dropna().nunique(), month
