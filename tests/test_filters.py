import datetime as dt

from pyspark.sql import functions as F

from portal_metrics.functions.filters import Filters, period_bounds, relative_period, to_daykey
from tests.fixtures import fixture_model


def test_daykeys():
    assert to_daykey("2025-10-01") == 20251001
    assert to_daykey("20251001") == 20251001
    assert to_daykey(dt.date(2025, 1, 2)) == 20250102
    assert to_daykey(None) is None and to_daykey("") is None


def test_period_bounds():
    a = "2025-06-15"   # a Sunday
    assert period_bounds("today", a) == (dt.date(2025, 6, 15),) * 2
    assert period_bounds("this_week", a) == (dt.date(2025, 6, 9), dt.date(2025, 6, 15))
    assert period_bounds("last_month", a) == (dt.date(2025, 5, 1), dt.date(2025, 5, 31))
    assert period_bounds("this_quarter", a) == (dt.date(2025, 4, 1), dt.date(2025, 6, 30))
    assert period_bounds("last_quarter", "2025-02-01") == (dt.date(2024, 10, 1), dt.date(2024, 12, 31))
    assert period_bounds("last_n_days", a, 30) == (dt.date(2025, 5, 16), None)
    assert period_bounds("quarter", a, value="Q3 2024") == (dt.date(2024, 7, 1), dt.date(2024, 9, 30))
    f = relative_period("this_month", a)
    assert (f.day_from, f.day_to) == (20250601, 20250630)


def test_contains_is_literal(spark):
    m = fixture_model(spark)
    pages = m.page_inventory
    # '%' and '_' are plain characters, not wildcards; case-insensitive
    assert Filters(website="100%_S").apply(pages).count() == 1
    assert Filters(website="0%x").apply(pages).count() == 0
    assert Filters(website="HR's").apply(pages).count() == 0
    assert Filters(page_url="/HR/").apply(pages).count() == 1


def test_page_filter_drops_orphans_and_date_range(spark):
    m = fixture_model(spark)
    w = m.wide(Filters(website="site"))
    assert w.where(F.col("marketingpageid") == "p9").count() == 0     # M7
    w2 = m.wide(Filters(date_from=20250101, date_to="20250102"))
    assert w2.count() == 4
    w3 = m.wide(Filters(equals={"referrerapplicationid": ["Email"], "contenttype": ["Article"]}))
    assert w3.count() == 2
