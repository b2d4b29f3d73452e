"""DuckDB twins of the registered queries (the correctness oracle).

``ADAPTER`` is the SQL form of ``sources.tpch_star`` (same mapping, same
fixed values); every twin is ``WITH <adapter>, <own CTEs> SELECT ...``
over the driver's pre-registered views.  Hygiene rules: SUM(BIGINT) is
cast back to BIGINT (DuckDB widens it), calendar parts to INTEGER,
divisors go through NULLIF, and each LIMIT has the group key as
tie-breaker.
"""

from __future__ import annotations

#: Names in calendar order (fixed values).
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def calendar_of(days: str) -> str:
    """Calendar rows of a query of day numbers ``n`` (days since 1970-01-01, a Thursday), by arithmetic on the number.

    A day's week is that of its Thursday; a day ends or begins a period where tomorrow's or yesterday's period is another."""
    def period(day):
        return f"date_part('year', {day}) * 12 + date_part('month', {day}) - 1"

    def at(n):
        return f"(DATE '1970-01-01' + CAST({n} AS INTEGER))"

    def other(a, b, months):
        return f"({a}) // {months} <> ({b}) // {months}"

    columns = {
        "datekey": "CAST(year_no * 10000 + month_no * 100 + day_no AS BIGINT)", "date": "today", "year": "CAST(year_no AS INTEGER)",
        "quarter": "CAST(quarter_no AS INTEGER)", "quarter_name": "format('Q{}', quarter_no)", "year_quarter": "format('Q{} {}', quarter_no, year_no)",
        "month": "CAST(month_no AS INTEGER)", "month_name": f"list_extract({MONTHS}, month_no)", "month_short": f"left(list_extract({MONTHS}, month_no), 3)",
        "year_month": "format('{}-{:02d}', year_no, month_no)", "week_number": "CAST(week_no AS INTEGER)", "year_week": "format('{}-W{:02d}', week_year, week_no)",
        "day_of_month": "CAST(day_no AS INTEGER)", "day_of_year": "CAST(n - first_of_year + 1 AS INTEGER)", "day_of_week": "CAST(weekday_no + 1 AS INTEGER)",
        "day_name": f"list_extract({WEEKDAYS}, weekday_no + 1)", "day_short": f"left(list_extract({WEEKDAYS}, weekday_no + 1), 3)", "is_weekend": "weekday_no > 4",
        **{f"is_{name}_{edge}": other("this_month", month, size) for name, size in (("month", 1), ("quarter", 3), ("year", 12))
           for edge, month in (("start", "month_before"), ("end", "month_after"))},
    }
    return f"""
  SELECT {', '.join(f'{v} AS {k}' for k, v in columns.items())}
  FROM (SELECT *, CAST(this_month // 12 AS BIGINT) AS year_no, CAST(this_month % 12 + 1 AS BIGINT) AS month_no, CAST(this_month % 12 // 3 + 1 AS BIGINT) AS quarter_no,
               (thursday - first_of_week_year) // 7 + 1 AS week_no
        FROM (SELECT *, date_diff('day', DATE '1970-01-01', make_date(week_year, 1, 1)) AS first_of_week_year
              FROM (SELECT n, {at('n')} AS today, (n + 3) % 7 AS weekday_no, n - (n + 3) % 7 + 3 AS thursday,
                           CAST(date_part('year', {at('n - (n + 3) % 7 + 3')}) AS BIGINT) AS week_year, date_part('day', {at('n')}) AS day_no,
                           date_diff('day', DATE '1970-01-01', make_date(CAST(date_part('year', {at('n')}) AS BIGINT), 1, 1)) AS first_of_year,
                           {period(at('n'))} AS this_month, {period(at('n - 1'))} AS month_before, {period(at('n + 1'))} AS month_after
                    FROM ({days}) numbers) days_) weeks) parts"""


ADAPTER = """
fact AS (
  SELECT CAST(year(o.o_orderdate) * 10000 + month(o.o_orderdate) * 100 + day(o.o_orderdate) AS BIGINT) AS visitdatekey,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Email'
              WHEN o.o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'Intranet'
              ELSE 'Other' END AS referrerapplicationid,
         CAST(l.l_partkey AS VARCHAR) AS marketingpageid,
         CAST(l.l_quantity AS BIGINT) AS views,
         CASE WHEN o.o_custkey % 97 = 0 THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END AS viewingcontactid,
         l.l_linestatus AS flag,
         CAST(l.l_linenumber AS BIGINT) AS visits,
         CAST(l.l_quantity AS DOUBLE) * CAST(0.5 AS DOUBLE) AS durationsum,
         CAST(l.l_linenumber AS DOUBLE) * CAST(0.25 AS DOUBLE) AS durationavg,
         CASE WHEN l.l_returnflag = 'A' THEN CAST(l.l_linenumber % 3 AS BIGINT)
              WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'F' THEN NULL
              ELSE CAST(0 AS BIGINT) END AS comments,
         CASE WHEN l.l_returnflag = 'R' THEN CAST(l.l_partkey AS VARCHAR)
              WHEN l.l_returnflag = 'A' THEN '' ELSE NULL END AS marketingpageidliked
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
page_all AS (
  SELECT p_brand AS websitename,
         'https://portal.example.com/' || lower(p_brand) AS websiteurl,
         p_type AS owningbusinessunit,
         p_name AS pagename,
         'https://portal.example.com/' || lower(p_brand) || '/' || lower(p_type) || '/' || CAST(p_partkey AS VARCHAR) AS fullpageurl,
         'SRC-' || CAST(p_partkey AS VARCHAR) AS sourcesystempageid,
         CAST(p_partkey AS VARCHAR) AS marketingpageid,
         split_part(p_name, ' ', 1) AS theme,
         split_part(p_name, ' ', 2) AS topic,
         '/' || lower(p_type) || '/' || CAST(p_partkey AS VARCHAR) AS pageurl,
         CASE WHEN p_size % 10 = 0 THEN 'Yes' ELSE 'No' END AS exclude,
         p_brand AS sitename,
         upper(split_part(p_name, ' ', 1)) AS theme_normalized,
         upper(split_part(p_name, ' ', 2)) AS topic_normalized,
         CASE p_size % 3 WHEN 0 THEN 'News' WHEN 1 THEN 'Landing' ELSE 'Article page' END AS template,
         CASE WHEN p_type = 'ECONOMY' THEN 'Homepage' WHEN p_type = 'PROMO' THEN 'Article' ELSE p_type END AS contenttype,
         CASE p_size % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'de' WHEN 2 THEN 'fr' ELSE 'es' END AS pagelanguage,
         CASE p_size % 5 WHEN 0 THEN 'Strategy' WHEN 1 THEN 'Culture' WHEN 2 THEN 'Thought leadership'
                         WHEN 3 THEN 'Digital' ELSE 'Operational' END AS newscategory,
         CASE p_size % 6 WHEN 0 THEN 'AFRICA' WHEN 1 THEN 'AMERICA' WHEN 2 THEN 'ASIA' WHEN 3 THEN 'EUROPE'
                         WHEN 4 THEN 'MIDDLE EAST' ELSE 'Global' END AS targetregion,
         CASE p_size % 5 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING' WHEN 2 THEN 'FURNITURE'
                         WHEN 3 THEN 'HOUSEHOLD' ELSE 'MACHINERY' END AS targetorganization,
         CAST(1 AS BIGINT) AS cnt
  FROM part
),
page_inventory AS (SELECT * FROM page_all WHERE CAST(marketingpageid AS BIGINT) % 20 <> 0),
emp_all AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS contactid,
         c.c_mktsegment AS employeebusinessdivision,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'Staff' ELSE 'Management' END AS employeecategory,
         CASE c.c_custkey % 3 WHEN 0 THEN 'Employee' WHEN 1 THEN 'Contractor' ELSE 'Intern' END AS employeeclass,
         'Cluster ' || CAST(c.c_custkey % 4 AS VARCHAR) AS employeecluster,
         CAST(NULL AS VARCHAR) AS employeefamily,
         CAST(NULL AS VARCHAR) AS employeefunction,
         g.n_name AS employeegcrscountry,
         'R' || CAST(c.c_custkey % 6 AS VARCHAR) AS employeerank,
         g.r_name AS employeeregion,
         CAST(NULL AS VARCHAR) AS employeerole,
         g.n_name AS employeeworkcountry,
         'Company' AS ou_lvl_1,
         c.c_mktsegment AS ou_lvl_2,
         g.r_name AS ou_lvl_3,
         CAST(NULL AS VARCHAR) AS ou_lvl_4,
         CAST(NULL AS VARCHAR) AS ou_lvl_5
  FROM customer c
  LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) g
         ON c.c_nationkey = g.n_nationkey
),
employee_contact AS (SELECT * FROM emp_all WHERE CAST(contactid AS BIGINT) % 25 <> 0),
dim_date AS (""" + calendar_of("SELECT n FROM range(9131, 11688) days(n)") + """
)"""

# ------------------------------------------------------------ SQL fragments
#: The measures of a group of page views, by their definitions in SURVEY 1.3 (a like names a page; NULL comments do not count).
MEASURES = {
    "rows": "COUNT(*)", "uv": "COUNT(DISTINCT f.viewingcontactid)", "pages": "COUNT(DISTINCT f.marketingpageid)", "days": "COUNT(DISTINCT f.visitdatekey)",
    "views": "CAST(SUM(f.views) AS BIGINT)", "visits": "CAST(SUM(f.visits) AS BIGINT)", "likes": "COUNT(*) FILTER (f.marketingpageidliked <> '')",
    "comments": "CAST(SUM(f.comments) AS BIGINT)", "first_day": "MIN(f.visitdatekey)", "last_day": "MAX(f.visitdatekey)", "seconds": "ROUND(AVG(f.durationavg), 1)",
}
MEASURES["engaged"] = f"({MEASURES['likes']} + {MEASURES['comments']})"
LIKES, COMMENTS, ENG, VIEWS, VISITS, UV = (MEASURES[k] for k in ("likes", "comments", "engaged", "views", "visits", "uv"))


def rate(digits=3, eng=ENG, views=VIEWS):
    return f"ROUND(CAST({eng} AS DOUBLE) * 100.0 / NULLIF(CAST({views} AS DOUBLE), 0), {digits})"


def per_visitor(total, digits):
    return f"ROUND(CAST({total} AS DOUBLE) / NULLIF(CAST({UV} AS DOUBLE), 0), {digits})"


for _n in (2, 3):
    MEASURES[f"rate{_n}"] = rate(_n)
for _k in ("views", "visits", "likes", "comments", "engaged"):
    for _n in (2, 4):
        MEASURES[f"{_k}_each{_n}"] = per_visitor(MEASURES[_k], _n)


def measured(spec: str) -> str:
    """``column=measure`` words as a SELECT list."""
    return ", ".join(f"{MEASURES[m]} AS {c}" for c, m in (w.split("=") for w in spec.split()))


BASE = measured("unique_visitors=uv total_views=views total_visits=visits likes=likes comments=comments engagements=engaged")

FROM_P = "FROM fact f LEFT JOIN page_inventory p ON f.marketingpageid = p.marketingpageid"
FROM_DP = ("FROM fact f JOIN dim_date d ON f.visitdatekey = d.datekey "
           "LEFT JOIN page_inventory p ON f.marketingpageid = p.marketingpageid")
FROM_PE = FROM_P + " LEFT JOIN employee_contact e ON f.viewingcontactid = e.contactid"
FROM_DPE = FROM_DP + " LEFT JOIN employee_contact e ON f.viewingcontactid = e.contactid"


def q(body: str, ctes: str = "") -> str:
    return "WITH " + ADAPTER + (",\n" + ctes if ctes else "") + "\n" + body


def known(column: str) -> str:
    return f"COALESCE({column}, 'Unknown')"


CORE = "unique_visitors=uv total_views=views total_visits=visits likes=likes comments=comments engagements=engaged"


def report(source: str, keys: dict[str, str], spec: str, top: tuple[int, str] | None = None, only: str | None = None) -> str:
    """A twin: measures by keys {column: expression}; ``top`` (k, column): the k groups with most of it, ties by the keys; ``only``: a
    condition on a group."""
    select = ", ".join([*(f"{v} AS {k}" for k, v in keys.items()), measured(spec)])
    body = f"SELECT {select} {source}" + (f" GROUP BY {', '.join(keys.values())}" if keys else "") + (f" HAVING {only}" if only else "")
    return q(body + (f" ORDER BY {top[1]} DESC, {', '.join(keys.values())} LIMIT {top[0]}" if top else ""))


SQL: dict[str, str] = {}

# ------------------------------------------------------------------ QRY-1..5
SQL["qry01_summary"] = report(FROM_P, {}, "total_rows=rows days_covered=days first_date=first_day last_date=last_day unique_pages=pages total_unique_visitors=uv "
                              "total_views=views total_visits=visits total_likes=likes total_comments=comments total_engagements=engaged")
DAY = {c: f"d.{c}" for c in ("date", "day_name", "is_weekend")}
SQL["qry02_daily_uv"] = report(FROM_DP, DAY, CORE)


def _period(key_cols, start, days):
    MEASURES["first_date"], MEASURES["dates"] = "MIN(d.date)", "COUNT(DISTINCT d.date)"
    return report(FROM_DP, {k: f"d.{k}" for k in key_cols}, f"{start}=first_date {CORE} {days}=dates")


SQL["qry03_weekly_uv"] = _period(["year_week"], "week_start", "days_in_week")
SQL["qry04_monthly_uv"] = _period(["year_month", "month_name"], "month_start", "days_in_month")
SQL["qry05_quarterly_uv"] = _period(["year_quarter"], "quarter_start", "days_in_quarter")

SQL["qry02_05_uv_all_grains"] = q("\nUNION ALL ".join(f"""
SELECT '{grain}' AS grain, CAST(d.{key} AS VARCHAR) AS period, MIN(d.date) AS period_start, {BASE},
       COUNT(DISTINCT d.date) AS days
{FROM_DP} GROUP BY d.{key}""" for grain, key in [("day", "date"), ("week", "year_week"), ("month", "year_month"), ("quarter", "year_quarter")]))

# ----------------------------------------------------------------- QRY-6..15
PAGE = {"marketingpageid": "f.marketingpageid", "pagename": "p.pagename", "websitename": "p.websitename"}
URL, THEME = {**PAGE, "fullpageurl": "p.fullpageurl"}, {**PAGE, "theme": "p.theme"}
SITE, KIND, CHANNEL = {"website": known("p.websitename")}, {"content_type": known("p.contenttype")}, {"referrerapplicationid": "f.referrerapplicationid"}
ENGAGED = "likes=likes comments=comments total_engagements=engaged"
SQL["qry06_uv_by_website"] = report(FROM_P, SITE, CORE + " pages_viewed=pages")
SQL["qry07_uv_by_theme"] = report(FROM_P, {"theme": known("p.theme")}, "unique_visitors=uv total_views=views likes=likes comments=comments engagements=engaged pages_in_theme=pages",
                                  top=(20, "unique_visitors"))
SQL["qry08_daily_engagement"] = report(FROM_DP, DAY, ENGAGED + " views=views engagement_rate_pct=rate3")
SQL["qry09_top_engaged_pages"] = report(FROM_P, THEME, ENGAGED + " total_views=views unique_visitors=uv engagement_rate_pct=rate2", top=(25, "total_engagements"), only=f"{ENG} > 0")
SQL["qry10_engagement_by_contenttype"] = report(FROM_P, KIND, ENGAGED + " total_views=views unique_visitors=uv engagement_rate_pct=rate3")
SQL["qry11_top_pages_by_views"] = report(FROM_P, URL, "total_views=views total_visits=visits unique_visitors=uv likes=likes comments=comments avg_duration_sec=seconds", top=(25, "total_views"))
SQL["qry12_top_pages_by_uv"] = report(FROM_P, URL, "unique_visitors=uv total_views=views views_per_visitor=views_each2 likes=likes comments=comments", top=(25, "unique_visitors"))
SQL["qry13_referrer_analysis"] = report(FROM_P, CHANNEL, CORE + " pages_visited=pages")
SQL["fil06_weekend_filter"] = report(FROM_DP + " WHERE d.is_weekend AND d.year IN (1995, 1996) AND d.quarter IN (1, 4)", CHANNEL, CORE + " pages_visited=pages")
MEASURES["visit_seconds"] = f"ROUND(SUM(f.durationsum) / NULLIF(CAST({VISITS} AS DOUBLE), 0), 1)"
SQL["qry14_overall_engagement"] = report(FROM_P, {}, "total_uv=uv " + " ".join(f"total_{c}={m}" for c, m in (
    ("views", "views"), ("visits", "visits"), ("likes", "likes"), ("comments", "comments"), ("engagements", "engaged")))
    + " views_per_visitor=views_each2 visits_per_visitor=visits_each2 likes_per_visitor=likes_each4 comments_per_visitor=comments_each4 "
      "engagements_per_visitor=engaged_each4 engagement_rate_pct=rate3 avg_duration_per_visit=visit_seconds")
SQL["qry15_rows_per_website"] = report(FROM_P, SITE, "row_count=rows total_views=views unique_visitors=uv")

# ---------------------------------------------------------------- QRY-16..20
DAILY_CHART = f"""daily AS (
  SELECT d.date, {UV} AS unique_visitors, {VIEWS} AS views {FROM_DP} GROUP BY d.date)"""

SQL["qry16_daily_uv_ma7"] = q("""
SELECT date, unique_visitors, views,
       CASE WHEN COUNT(*) OVER w = 7 THEN AVG(unique_visitors) OVER w END AS uv_ma7
FROM daily WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""", DAILY_CHART)

SQL["qry17_peak_day"] = q("""
SELECT AVG(unique_visitors) AS mean_unique_visitors, MIN(unique_visitors) AS min_unique_visitors,
       MAX(unique_visitors) AS max_unique_visitors, CAST(SUM(unique_visitors) AS BIGINT) AS sum_unique_visitors,
       (SELECT date FROM daily ORDER BY unique_visitors, date LIMIT 1) AS date_at_min,
       (SELECT date FROM daily ORDER BY unique_visitors DESC, date LIMIT 1) AS date_at_max
FROM daily""", DAILY_CHART)

SQL["qry18_top15_pages_chart"] = q(f"""
SELECT page, unique_visitors, total_views,
       CASE WHEN length(page) > 43 THEN substring(page, 1, 40) || '...' ELSE page END AS page_short
FROM (SELECT COALESCE(p.pagename, f.marketingpageid) AS page, {UV} AS unique_visitors, {VIEWS} AS total_views
      {FROM_P} GROUP BY COALESCE(p.pagename, f.marketingpageid)
      ORDER BY unique_visitors DESC, page LIMIT 15) t""")

SQL["qry19_uv_by_website_chart"] = q(f"""
SELECT website, unique_visitors, total_views, CAST(SUM(unique_visitors) OVER () AS BIGINT) AS sum_of_site_uv
FROM (SELECT COALESCE(p.websitename, 'Unknown') AS website, {UV} AS unique_visitors, {VIEWS} AS total_views
      {FROM_P} GROUP BY COALESCE(p.websitename, 'Unknown')) t""")

SQL["qry20_engagement_chart"] = report(FROM_P, KIND, ENGAGED, top=(15, "total_engagements"), only=f"{ENG} > 0")

# ---------------------------------------------------------------- QRY-21..28
SQL["qry21_uv_by_region"] = report(FROM_PE, {"region": known("e.employeeregion")}, CORE + " engagement_rate_pct=rate3")
SQL["qry22_uv_by_division"] = report(FROM_PE, {"business_division": known("e.employeebusinessdivision")}, CORE + " engagement_rate_pct=rate3")

RXD = f"""rxd AS (
  SELECT COALESCE(e.employeeregion, 'Unknown') AS region,
         COALESCE(e.employeebusinessdivision, 'Unknown') AS business_division,
         {UV} AS unique_visitors, {VIEWS} AS total_views, {ENG} AS engagements
  {FROM_PE} GROUP BY 1, 2)"""
SQL["qry23_region_x_division"] = q("SELECT * FROM rxd", RXD)

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "Unknown"]


def _pivot_cells(value, agg, fill, names=REGIONS, cast="BIGINT"):
    cells = [f"COALESCE(CAST({agg}(CASE WHEN region = '{r}' THEN {value} END) AS {cast}), {fill}) AS \"{r}\""
             for r in names]
    return cells


SQL["qry24_region_division_matrix"] = q(
    "SELECT business_division, " + ", ".join(_pivot_cells("unique_visitors", "SUM", 0)) + ", "
    + " + ".join(f"COALESCE(CAST(SUM(CASE WHEN region = '{r}' THEN unique_visitors END) AS BIGINT), 0)"
                 for r in REGIONS) + " AS \"Total\" FROM rxd GROUP BY business_division", RXD)

ATTRIBUTES = {"business_division": "employeebusinessdivision", "region": "employeeregion", "employee_class": "employeeclass"}
_raw = ", ".join(f"e.{c}" for c in ATTRIBUTES.values())
SQL["qry25_top_visitors"] = q(f"""
SELECT {', '.join(f"{known(c)} AS {k}" for k, c in ATTRIBUTES.items())}, pages_visited, total_views, total_visits, likes, comments, days_active
FROM (SELECT f.viewingcontactid, {_raw}, {measured("pages_visited=pages total_views=views total_visits=visits likes=likes comments=comments days_active=days")}
      {FROM_PE} GROUP BY f.viewingcontactid, {_raw}) visitors
ORDER BY total_views DESC NULLS LAST, {', '.join(f'{c} NULLS LAST' for c in ['viewingcontactid', *ATTRIBUTES.values()])} LIMIT 50""")

MR = f"""mr AS (
  SELECT d.year_month, COALESCE(e.employeeregion, 'Unknown') AS region, {UV} AS unique_visitors,
         {VIEWS} AS total_views
  {FROM_DPE} GROUP BY d.year_month, COALESCE(e.employeeregion, 'Unknown'))"""
SQL["qry26_monthly_uv_by_region"] = q("SELECT * FROM mr", MR)
SQL["qry27_monthly_region_matrix"] = q(
    "SELECT year_month, " + ", ".join(_pivot_cells("unique_visitors", "AVG", "0.0", cast="DOUBLE"))
    + " FROM mr GROUP BY year_month", MR)

SQL["qry28_employee_count"] = q("SELECT COUNT(*) AS employee_count FROM employee_contact")

# ------------------------------------------------------------------ DOC-1..5
DOC_FROM, DOC_TO = 19960101, 19961231

FROM_E = f"FROM fact f LEFT JOIN employee_contact e ON f.viewingcontactid = e.contactid WHERE f.visitdatekey BETWEEN {DOC_FROM} AND {DOC_TO}"
FROM_IP = "FROM fact f JOIN page_inventory p ON f.marketingpageid = p.marketingpageid"
SQL["doc1_uv_by_region_range"] = report(FROM_E, {"employeeregion": "e.employeeregion"}, "unique_visitors=uv")
SQL["doc2_views_by_website_month"] = report(FROM_IP + " JOIN dim_date d ON f.visitdatekey = d.datekey", {"websitename": "p.websitename", "year_month": "d.year_month"},
                                            "total_views=views unique_visitors=uv")
SQL["doc3_top_pages"] = report(FROM_IP, {"pagename": "p.pagename", "websitename": "p.websitename"}, "total_views=views unique_visitors=uv likes=likes comments=comments",
                               top=(20, "total_views"))
SQL["doc4_traffic_by_channel"] = report("FROM fact f", {"channel": "f.referrerapplicationid"}, "unique_visitors=uv total_views=views")
SQL["doc5_class_distribution"] = report(FROM_E, {"employeeclass": "e.employeeclass"}, "unique_visitors=uv")
