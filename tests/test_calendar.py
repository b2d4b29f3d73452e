import datetime as dt

from portal_metrics.functions.calendar import calendar_summary, date_dim
from portal_metrics.schemas import DATE_SCHEMA


def test_default_range_rows_and_schema(spark):
    d = date_dim(spark)
    s = calendar_summary(d).first()
    assert s["rows"] == 6940
    assert s["min_date"] == dt.date(2022, 1, 1) and s["max_date"] == dt.date(2040, 12, 31)
    assert [f.name for f in d.schema.fields] == [f.name for f in DATE_SCHEMA.fields]
    assert [f.dataType for f in d.schema.fields] == [f.dataType for f in DATE_SCHEMA.fields]


def test_edge_days(spark):
    d = {r["date"]: r for r in date_dim(spark, "2024-01-01", "2027-01-03").collect()}
    leap = d[dt.date(2024, 2, 29)]
    assert leap["is_month_end"] and leap["datekey"] == 20240229 and leap["month_name"] == "February"
    assert d[dt.date(2024, 12, 30)]["year_week"] == "2025-W01"
    ye = d[dt.date(2026, 12, 31)]
    assert ye["year_week"] == "2026-W53" and ye["is_year_end"] and ye["is_quarter_end"]
    ys = d[dt.date(2027, 1, 1)]
    assert ys["year_week"] == "2026-W53" and ys["is_year_start"] and ys["day_of_year"] == 1
    sun = d[dt.date(2025, 3, 30)]
    assert sun["day_of_week"] == 7 and sun["is_weekend"] and sun["day_name"] == "Sunday" and sun["day_short"] == "Sun"
    qe = d[dt.date(2025, 3, 31)]
    assert qe["is_quarter_end"] and qe["quarter_name"] == "Q1" and qe["year_quarter"] == "Q1 2025"
    assert d[dt.date(2025, 4, 1)]["is_quarter_start"]
    assert d[dt.date(2025, 3, 1)]["year_month"] == "2025-03" and d[dt.date(2025, 3, 1)]["month_short"] == "Mar"
