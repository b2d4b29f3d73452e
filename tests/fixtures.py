"""Hand-written star rows (FIXTURES.md §3 edge cases)."""

from portal_metrics.functions.calendar import date_dim
from portal_metrics.model import StarModel
from portal_metrics.schemas import EMPLOYEE_SCHEMA, FACT_SCHEMA, PAGE_SCHEMA

# (visitdatekey, referrer, page, views, visitor, flag, visits, dsum, davg, comments, liked)
FACT_ROWS = [
    (20250101, "Email", "p1", 5, "u1", "F", 1, 10.0, 2.0, 1, "p1"),
    (20250101, "Intranet", "p2", 3, "u2", "F", 1, 6.0, 2.0, None, ""),
    (20250102, "Intranet", "p1", 0, "u1", "F", 1, 0.0, 0.0, None, None),
    (20250102, "Other", "p9", 2, None, "F", 2, 4.0, 2.0, 0, None),       # orphan page, NULL visitor
    (20250201, "Email", "p2", 7, "u3", "F", 3, 9.0, 3.0, 2, "p2"),
    (20250201, "Email", "p2", 1, "u3", "F", 1, 1.0, 1.0, 0, None),        # duplicate fact key
    (20211231, "Email", "p1", 4, "u4", "F", 1, 2.0, 2.0, 0, None),        # day outside calendar
]
PAGE_ROWS = [
    dict(marketingpageid="p1", websitename="HR Site", pagename="CEO message", fullpageurl="https://x/hr/ceo",
         theme="Leadership", topic="CEO", contenttype="Homepage", newscategory="Strategy", targetregion="EMEA"),
    dict(marketingpageid="p2", websitename="Sales 100%_site", pagename="Q3 results", fullpageurl="https://x/sales/q3",
         theme="Finance", topic="Results", contenttype="Article", newscategory="Culture", targetregion="Global"),
]
EMP_ROWS = [
    dict(contactid="u1", employeeregion="EMEA", employeebusinessdivision="Retail", employeeclass="Employee"),
    dict(contactid="u2", employeeregion="APAC", employeebusinessdivision="Retail", employeeclass="Contractor"),
    dict(contactid="u3", employeeregion="EMEA", employeebusinessdivision="Wholesale", employeeclass="Employee"),
    dict(contactid="u5", employeeregion="AMER", employeebusinessdivision="Markets", employeeclass="Employee"),
]


def _rows(dicts, schema):
    names = [f.name for f in schema.fields]
    return [tuple(d.get(n) for n in names) for d in dicts]


def fixture_model(spark, fact_rows=FACT_ROWS, pages=PAGE_ROWS, emps=EMP_ROWS):
    fact = spark.createDataFrame(fact_rows, FACT_SCHEMA)
    pg = spark.createDataFrame(_rows(pages, PAGE_SCHEMA), PAGE_SCHEMA)
    em = spark.createDataFrame(_rows(emps, EMPLOYEE_SCHEMA), EMPLOYEE_SCHEMA) if emps is not None else None
    return StarModel(fact, pg, date_dim(spark, "2025-01-01", "2025-12-31"), em)
