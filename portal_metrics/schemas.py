"""Declared schemas of the star tables and CSV header maps.

Column names, order and types are fixed values that the loaders, the
stored tables and the exported Parquet files must all agree on.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D = T.StringType(), T.LongType(), T.DoubleType()

# --- fixed values: fact columns in stored order, with the CSV header each
# one is read from (headers are matched case-insensitively) ---
FACT_COLUMNS = [
    ("visitdatekey", L, "fact_visitdatekey"),
    ("referrerapplicationid", S, "fact_referrerapplicationid"),
    ("marketingpageid", S, "fact_marketingPageId"),
    ("views", L, "fact_views"),
    ("viewingcontactid", S, "fact_viewingcontactid"),
    ("flag", S, "fact_flag"),
    ("visits", L, "fact_visits"),
    ("durationsum", D, "fact_durationsum"),
    ("durationavg", D, "fact_durationavg"),
    ("comments", L, "fact_comments"),
    ("marketingpageidliked", S, "fact_marketingPageIdliked"),
]

# --- fixed values: page inventory columns and their CSV headers ---
PAGE_COLUMNS = [
    ("websitename", S, "websitename"),
    ("websiteurl", S, "websiteurl"),
    ("owningbusinessunit", S, "owningbusinessunit"),
    ("pagename", S, "pagename"),
    ("fullpageurl", S, "fullpageurl"),
    ("sourcesystempageid", S, "sourcesystempageid"),
    ("marketingpageid", S, "marketingpageid"),
    ("theme", S, "theme"),
    ("topic", S, "topic"),
    ("pageurl", S, "pageurl"),
    ("exclude", S, "exclude"),
    ("sitename", S, "Site name"),
    ("theme_normalized", S, "theme - Copy"),
    ("topic_normalized", S, "topic - Copy"),
    ("template", S, "template"),
    ("contenttype", S, "contentType"),
    ("pagelanguage", S, "pageLanguage"),
    ("newscategory", S, "newsCategory"),
    ("targetregion", S, "targetRegion"),
    ("targetorganization", S, "targetOrganization"),
    ("cnt", L, "cnt"),
]

# --- fixed values: employee attributes; the CSV header is either the
# plain name or employee_contact[<name>] ---
EMPLOYEE_SOURCE_NAMES = [
    "contactID", "employeebusinessdivision", "employeeCategory", "employeeClass",
    "employeeCluster", "employeeFamily", "employeeFunction", "employeeGCRSCountry",
    "employeeRank", "employeeregion", "employeeRole", "employeeWorkCountry",
    "OU_LVL_1", "OU_LVL_2", "OU_LVL_3", "OU_LVL_4", "OU_LVL_5",
]
EMPLOYEE_COLUMNS = [(n.lower(), S, n) for n in EMPLOYEE_SOURCE_NAMES]


def struct(cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t, _ in cols])


FACT_SCHEMA = struct(FACT_COLUMNS)
PAGE_SCHEMA = struct(PAGE_COLUMNS)
EMPLOYEE_SCHEMA = struct(EMPLOYEE_COLUMNS)

# --- fixed values: calendar columns in stored order ---
DATE_COLUMNS = [
    ("datekey", L), ("date", T.DateType()), ("year", T.IntegerType()),
    ("quarter", T.IntegerType()), ("quarter_name", S), ("year_quarter", S),
    ("month", T.IntegerType()), ("month_name", S), ("month_short", S), ("year_month", S),
    ("week_number", T.IntegerType()), ("year_week", S), ("day_of_month", T.IntegerType()),
    ("day_of_year", T.IntegerType()), ("day_of_week", T.IntegerType()), ("day_name", S),
    ("day_short", S), ("is_weekend", T.BooleanType()), ("is_month_start", T.BooleanType()),
    ("is_month_end", T.BooleanType()), ("is_quarter_start", T.BooleanType()),
    ("is_quarter_end", T.BooleanType()), ("is_year_start", T.BooleanType()),
    ("is_year_end", T.BooleanType()),
]
DATE_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in DATE_COLUMNS])

# Keys as checked by the quality report (reported, never enforced).
FACT_KEY = ["visitdatekey", "marketingpageid", "viewingcontactid", "referrerapplicationid"]
PAGE_KEY = ["marketingpageid"]
EMPLOYEE_KEY = ["contactid"]
DATE_KEY = ["datekey"]

# Partition column of the stored fact table: visit month as yyyymm.
FACT_PARTITION = "visit_month"
