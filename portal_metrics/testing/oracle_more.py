"""DuckDB twins: quality, calendar, filters, dashboards, questions, windows."""

from __future__ import annotations

from . import oracle_sql
from .oracle_measures import ENG0, EMP_TOTAL, LIKE_ROW, LIKES_N, RATE0, coverage, pct0, ratio0
from .oracle_sql import (BASE, COMMENTS, ENG, FROM_DP, FROM_P, FROM_PE, LIKES, URL, UV, VIEWS, VISITS,
                         calendar_of, q, rate, report)

SQL: dict[str, str] = {}

FKEY = ["visitdatekey", "marketingpageid", "viewingcontactid", "referrerapplicationid"]

# ------------------------------------------------------------------ VAL-1..7
SQL["val1_duplicate_page_ids"] = q("""
SELECT marketingpageid, COUNT(*) AS cnt FROM page_inventory GROUP BY 1 HAVING COUNT(*) > 1
ORDER BY cnt DESC, marketingpageid NULLS LAST LIMIT 10""")
SQL["val1_duplicate_page_names"] = q("""
SELECT pagename, COUNT(*) AS cnt FROM page_inventory GROUP BY 1 HAVING COUNT(*) > 1
ORDER BY cnt DESC, pagename NULLS LAST LIMIT 10""")
SQL["val2_duplicate_fact_keys"] = q(f"""
SELECT {', '.join(FKEY)}, COUNT(*) AS cnt FROM fact GROUP BY {', '.join(FKEY)} HAVING COUNT(*) > 1
ORDER BY cnt DESC, {', '.join(k + ' NULLS LAST' for k in FKEY)} LIMIT 10""")
KEYSTATS = f"""ks AS (SELECT COUNT(*) AS unique_keys, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS total_rows,
  COUNT_IF(n > 1) AS duplicate_key_groups FROM (SELECT COUNT(*) AS n FROM fact GROUP BY {', '.join(FKEY)}) g)"""
SQL["val3_4_fact_key_stats"] = q("SELECT * FROM ks", KEYSTATS)
ORPH = """orph AS (SELECT COUNT(DISTINCT f.marketingpageid) AS orphaned_keys, COUNT(*) AS orphaned_rows
  FROM fact f LEFT JOIN (SELECT DISTINCT marketingpageid FROM page_inventory WHERE marketingpageid IS NOT NULL) p
  ON f.marketingpageid = p.marketingpageid WHERE p.marketingpageid IS NULL)"""
SQL["val5_orphan_pages"] = q("SELECT * FROM orph", ORPH)
SQL["val6_quality_summary"] = q("""
SELECT ks.duplicate_key_groups AS fact_duplicate_keys, ks.unique_keys AS fact_unique_keys, ks.total_rows AS fact_rows,
       pk.dup AS page_duplicate_ids, pk.uniq AS page_unique_ids, orph.orphaned_keys, orph.orphaned_rows,
       (pk.dup = 0 AND ks.duplicate_key_groups = 0) AS valid
FROM ks, orph, (SELECT COUNT_IF(n > 1) AS dup, COUNT(*) AS uniq
                FROM (SELECT COUNT(*) AS n FROM page_inventory GROUP BY marketingpageid) g) pk""",
                                  KEYSTATS + ",\n" + ORPH)
SQL["val7_unmatched_visitors"] = q("""
SELECT COUNT(DISTINCT f.viewingcontactid) AS unmatched_visitors, COUNT(*) AS unmatched_rows
FROM fact f LEFT JOIN employee_contact e ON f.viewingcontactid = e.contactid
WHERE f.viewingcontactid IS NOT NULL AND e.contactid IS NULL""")

# ------------------------------------------------------------------ DIM-1..10
SPAN = """SELECT unnest(range(date_diff('day', DATE '1970-01-01', MIN(CAST(o_orderdate AS DATE))),
  date_diff('day', DATE '1970-01-01', MAX(CAST(o_orderdate AS DATE))) + 1)) AS n FROM orders"""
SQL["dim1_9_calendar_span"] = q(calendar_of(SPAN))
SQL["dim10_calendar_summary"] = q(f"SELECT COUNT(*) AS rows, MIN(date) AS min_date, MAX(date) AS max_date FROM ({calendar_of(SPAN)}) c")

# ---------------------------------------------------------------------- FIL
SQL["fil01_03_filtered_monthly"] = q(f"""
SELECT MIN(d.date) AS month_start, d.year_month, d.month_name, {BASE}, COUNT(DISTINCT d.date) AS days_in_month
{FROM_DP} WHERE f.visitdatekey >= 19960101 AND f.visitdatekey <= 19971231
  AND contains(lower(p.websitename), 'brand#1')
GROUP BY d.year_month, d.month_name""")
SQL["fil04_url_top_pages"] = report(FROM_P + " WHERE contains(lower(p.fullpageurl), '/promo/')", URL, "total_views=views total_visits=visits unique_visitors=uv likes=likes "
                                    "comments=comments avg_duration_sec=seconds", top=(25, "total_views"))
SQL["fil05_06_equals_region"] = q(f"""
SELECT COALESCE(e.employeeregion, 'Unknown') AS region, {BASE}, {rate(3)} AS engagement_rate_pct
{FROM_PE} WHERE contains(lower(p.pagename), 'ring') AND p.contenttype IN ('Homepage', 'Article')
  AND e.employeeregion IN ('ASIA', 'EUROPE')
GROUP BY COALESCE(e.employeeregion, 'Unknown')""")
SQL["fil18_search_websites"] = q("""
SELECT DISTINCT websitename FROM page_inventory WHERE contains(lower(websitename), '#1')""")
SQL["fil19_search_pages"] = q("""
SELECT pagename, websitename, fullpageurl FROM page_inventory WHERE contains(lower(fullpageurl), '/promo/')
ORDER BY websitename NULLS LAST, pagename NULLS LAST, fullpageurl NULLS LAST LIMIT 50""")
SQL["fil20_date_range"] = q("""
SELECT MIN(visitdatekey) AS earliest_date, MAX(visitdatekey) AS latest_date,
       COUNT(DISTINCT visitdatekey) AS total_days FROM fact""")

# ---------------------------------------------------------------------- DSH
MONTHLY = f"""m AS (SELECT d.year_month, CAST(date_trunc('month', d.date) AS DATE) AS month_start, {UV} AS uv
  {FROM_DP} GROUP BY 1, 2),
mom AS (SELECT c.year_month, c.month_start, c.uv,
  COALESCE(CAST(c.uv - p.uv AS DOUBLE) * 100.0 / NULLIF(CAST(p.uv AS DOUBLE), 0), 0.0) AS mom_change_pct
  FROM m c LEFT JOIN m p ON p.month_start = CAST(c.month_start - INTERVAL 1 MONTH AS DATE))"""
SQL["dsh01_top_pages"] = q(f"""
SELECT f.marketingpageid, p.pagename, {UV} AS uv, {RATE0} AS engagement_rate
{FROM_P} GROUP BY f.marketingpageid, p.pagename ORDER BY uv DESC, f.marketingpageid, p.pagename LIMIT 10""")
SQL["dsh01_executive_cards"] = q(f"""
SELECT core.uv, core.engagement_rate, {EMP_TOTAL} AS total_employees,
       {pct0('core.uv', EMP_TOTAL)} AS reach_rate,
       last.year_month AS latest_month, last.uv AS latest_month_uv, last.mom_change_pct
FROM (SELECT {UV} AS uv, {RATE0} AS engagement_rate {FROM_P}) core,
     (SELECT * FROM mom ORDER BY month_start DESC LIMIT 1) last""", MONTHLY)


def _reach(seg):
    return f"""SELECT pop.{seg} AS segment, pop.employees, COALESCE(seen.uv, 0) AS uv,
       {pct0('COALESCE(seen.uv, 0)', 'pop.employees')} AS reach_rate
FROM (SELECT COALESCE({seg}, 'Unknown') AS {seg}, COUNT(DISTINCT contactid) AS employees
      FROM employee_contact GROUP BY 1) pop
LEFT JOIN (SELECT COALESCE(e.{seg}, 'Unknown') AS {seg}, {UV} AS uv
           FROM fact f LEFT JOIN page_inventory p ON f.marketingpageid = p.marketingpageid
           JOIN employee_contact e ON f.viewingcontactid = e.contactid GROUP BY 1) seen
  ON pop.{seg} = seen.{seg}"""


SQL["dsh02_reach_vs_target"] = q(f"""
SELECT segment_type, segment, employees, uv, reach_rate, CAST(80.0 AS DOUBLE) AS target_pct, 80.0 - reach_rate AS gap_pct,
       reach_rate >= 80.0 AS target_met
FROM (SELECT 'division' AS segment_type, * FROM ({_reach('employeebusinessdivision')}) a
      UNION ALL SELECT 'region' AS segment_type, * FROM ({_reach('employeeregion')}) b) u""")
SQL["dsh03_monthly_reach_by_region"] = q(f"""
SELECT s.year_month, s.employeeregion, s.uv, pop.employees, {pct0('s.uv', 'pop.employees')} AS reach_rate
FROM (SELECT d.year_month, COALESCE(e.employeeregion, 'Unknown') AS employeeregion, {UV} AS uv
      {FROM_DP} JOIN employee_contact e ON f.viewingcontactid = e.contactid GROUP BY 1, 2) s
LEFT JOIN (SELECT COALESCE(employeeregion, 'Unknown') AS employeeregion, COUNT(DISTINCT contactid) AS employees
           FROM employee_contact GROUP BY 1) pop ON s.employeeregion = pop.employeeregion""")

PP = f"""pp AS (SELECT f.marketingpageid, COALESCE(p.pagename, 'Unknown') AS pagename,
  COALESCE(p.websitename, 'Unknown') AS websitename, {UV} AS uv, {VIEWS} AS total_views,
  {ENG0} AS engagements, {RATE0} AS engagement_rate {FROM_P} GROUP BY 1, 2, 3)"""
SQL["dsh04_content_cards"] = q(f"""
SELECT COUNT(*) AS pages_viewed, COUNT_IF(engagements > 0) AS pages_with_engagement, MAX(uv) AS top_page_uv,
       (SELECT {RATE0} {FROM_P}) AS overall_engagement_rate FROM pp""", PP)
SQL["dsh05_content_quadrants"] = q("""
SELECT pp.*, mu AS median_uv, mr AS median_engagement_rate,
       CASE WHEN uv > mu AND engagement_rate > mr THEN 'high reach, high engagement'
            WHEN uv > mu THEN 'high reach, low engagement'
            WHEN engagement_rate > mr THEN 'low reach, high engagement'
            ELSE 'low reach, low engagement' END AS quadrant
FROM pp, (SELECT quantile_cont(uv, 0.5) AS mu, quantile_cont(engagement_rate, 0.5) AS mr FROM pp) med""", PP)
SQL["dsh06_content_table"] = q("""
SELECT * FROM pp WHERE total_views > 10 ORDER BY uv DESC, marketingpageid LIMIT 50""", PP)
SQL["dsh07_funnel"] = q(f"""
SELECT stage_order, stage, visitors,
       {pct0('visitors', 'FIRST_VALUE(visitors) OVER (ORDER BY stage_order)')} AS pct_of_first,
       CASE WHEN LAG(visitors) OVER (ORDER BY stage_order) IS NULL THEN 0.0
            ELSE {pct0('LAG(visitors) OVER (ORDER BY stage_order) - visitors', 'LAG(visitors) OVER (ORDER BY stage_order)')}
       END AS drop_off_pct
FROM (SELECT 1 AS stage_order, 'Homepage visitors' AS stage, s1 AS visitors FROM one
      UNION ALL SELECT 2, 'Article viewers', s2 FROM one
      UNION ALL SELECT 3, 'Engaged', s3 FROM one) r""", f"""one AS (
  SELECT COUNT(DISTINCT CASE WHEN p.contenttype = 'Homepage' THEN f.viewingcontactid END) AS s1,
         COUNT(DISTINCT CASE WHEN p.contenttype = 'Article' THEN f.viewingcontactid END) AS s2,
         COUNT(DISTINCT CASE WHEN {LIKE_ROW} OR COALESCE(f.comments, 0) > 0 THEN f.viewingcontactid END) AS s3
  {FROM_P})""")
SQL["dsh08_channel_mix"] = q(f"""
SELECT channel, uv, ROUND(CAST(uv AS DOUBLE) * 100.0 / NULLIF(CAST(SUM(uv) OVER () AS DOUBLE), 0), 2) AS share_pct
FROM (SELECT f.referrerapplicationid AS channel, {UV} AS uv {FROM_P} GROUP BY 1) g""")
SQL["dsh09_channel_table"] = q(f"""
SELECT f.referrerapplicationid AS channel, {UV} AS uv, {VIEWS} AS total_views,
       {ratio0(VIEWS, UV)} AS views_per_visitor, {RATE0} AS engagement_rate
{FROM_P} GROUP BY 1""")


def band(x):
    return f"CASE WHEN {x} > 90.0 THEN 'green' WHEN {x} >= 70.0 THEN 'yellow' ELSE 'red' END"


SQL["dsh10_coverage_gauges"] = q(f"""
SELECT *, {band('division_coverage_pct')} AS division_band, {band('region_coverage_pct')} AS region_band,
       {band('message_penetration_pct')} AS penetration_band
FROM ({coverage({"newscategory": "COALESCE(p.newscategory, 'Unknown')", "referrerapplicationid": "f.referrerapplicationid"})}) c""")

DIVS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
STRATEGIC = "p.newscategory IN ('Strategy', 'Culture')"
CELLS = f"""cells AS (SELECT f.marketingpageid, e.employeebusinessdivision AS division, {UV} AS uv
  FROM fact f JOIN page_inventory p ON f.marketingpageid = p.marketingpageid
  JOIN employee_contact e ON f.viewingcontactid = e.contactid WHERE {STRATEGIC} GROUP BY 1, 2)"""
_cell = [f"COALESCE(m.\"{d}\", 0) AS \"{d}\"" for d in DIVS]
SQL["dsh11_gap_matrix"] = q(f"""
SELECT sp.marketingpageid, sp.pagename, {', '.join(_cell)},
       CAST({' + '.join(f'CASE WHEN COALESCE(m."{d}", 0) = 0 THEN 1 ELSE 0 END' for d in DIVS)} AS INTEGER) AS gap_divisions
FROM (SELECT marketingpageid, pagename FROM page_inventory WHERE newscategory IN ('Strategy', 'Culture')) sp
LEFT JOIN (SELECT marketingpageid, {', '.join(f"CAST(SUM(CASE WHEN division = '{d}' THEN uv END) AS BIGINT) AS \"{d}\"" for d in DIVS)}
           FROM cells GROUP BY marketingpageid) m ON sp.marketingpageid = m.marketingpageid""", CELLS)
SQL["dsh12_missing_divisions"] = q(f"""
SELECT marketingpageid, pagename, CAST(len(reached) AS BIGINT) AS divisions_reached,
       array_to_string(reached, ', ') AS reached,
       array_to_string(list_sort(list_filter(alld, lambda x: NOT list_contains(reached, x))), ', ') AS divisions_missing
FROM (SELECT f.marketingpageid, p.pagename, list_sort(list(DISTINCT e.employeebusinessdivision)) AS reached
      FROM fact f JOIN page_inventory p ON f.marketingpageid = p.marketingpageid
      JOIN employee_contact e ON f.viewingcontactid = e.contactid
      WHERE {STRATEGIC} AND e.employeebusinessdivision IS NOT NULL GROUP BY 1, 2) r,
     (SELECT list_sort(list(DISTINCT employeebusinessdivision)) AS alld FROM employee_contact
      WHERE employeebusinessdivision IS NOT NULL) a
WHERE len(list_filter(alld, lambda x: NOT list_contains(reached, x))) > 0""")
_on = "COALESCE(p.newscategory IN ('Strategy', 'Culture'), false)"
SQL["dsh13_strategic_vs_general"] = q(f"""
SELECT {pct0(f'(COUNT_IF({_on} AND {LIKE_ROW}) + COALESCE(CAST(SUM(CASE WHEN {_on} THEN f.comments END) AS BIGINT), 0))',
             f'CAST(SUM(CASE WHEN {_on} THEN f.views END) AS BIGINT)')} AS strategic_engagement_rate,
       {RATE0} AS all_engagement_rate
{FROM_P}""")
SQL["dsh14_theme_engagement_split"] = q(f"""
SELECT COALESCE(p.theme, 'Unknown') AS theme, {LIKES_N} AS likes, COALESCE({COMMENTS}, 0) AS comments
{FROM_P} GROUP BY 1""")
SQL["dsh15_theme_topic_tree"] = q(f"""
SELECT p.theme, p.topic, CAST(GROUPING_ID(p.theme, p.topic) AS INTEGER) AS level,
       COUNT(DISTINCT f.marketingpageid) AS pages, {VIEWS} AS total_views
FROM fact f JOIN page_inventory p ON f.marketingpageid = p.marketingpageid
GROUP BY ROLLUP (p.theme, p.topic)""")
SQL["dsh16_uv_by_newscategory"] = q(f"""
SELECT COALESCE(p.newscategory, 'Unknown') AS newscategory, {UV} AS uv, {VIEWS} AS total_views,
       {RATE0} AS engagement_rate {FROM_P} GROUP BY 1""")
SQL["dsh17_low_reach_strategic_pages"] = q(f"""
SELECT * FROM (SELECT f.marketingpageid, p.pagename, {UV} AS uv, {EMP_TOTAL} AS total_employees,
                      {pct0(UV, EMP_TOTAL)} AS message_penetration_pct
               FROM fact f JOIN page_inventory p ON f.marketingpageid = p.marketingpageid
               WHERE p.newscategory IN ('Strategy', 'Culture') GROUP BY 1, 2) t
WHERE message_penetration_pct < 80.0""")

# ---------------------------------------------------------------------- ASK
SQL["ask01_generic_report"] = q(f"""
SELECT COALESCE(p.contenttype, 'Unknown') AS contenttype, f.referrerapplicationid, {UV} AS uv,
       {VIEWS} AS views, {rate(3)} AS engagement_rate
{FROM_P} GROUP BY 1, 2""")


def cond_metrics(pred, sfx):
    p = f"COALESCE({pred}, false)"
    lk = f"COUNT_IF({p} AND {LIKE_ROW})"
    cm = f"COALESCE(CAST(SUM(CASE WHEN {p} THEN f.comments END) AS BIGINT), 0)"
    vw = f"COALESCE(CAST(SUM(CASE WHEN {p} THEN f.views END) AS BIGINT), 0)"
    vs = f"COALESCE(CAST(SUM(CASE WHEN {p} THEN f.visits END) AS BIGINT), 0)"
    return (f"COUNT(DISTINCT CASE WHEN {p} THEN f.viewingcontactid END) AS uv{sfx}, {vw} AS views{sfx}, "
            f"{vs} AS visits{sfx}, {lk} AS likes{sfx}, {cm} AS comments{sfx}, ({lk} + {cm}) AS engagements{sfx}, "
            f"{pct0(f'({lk} + {cm})', vw)} AS engagement_rate{sfx}")


CMP = ["uv", "views", "visits", "likes", "comments", "engagements", "engagement_rate"]


def compare_rows(one_sql, a, b):
    parts = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST({m}_a AS DOUBLE) AS {a}, CAST({m}_b AS DOUBLE) AS {b} FROM one" for m in CMP)
    return q(f"""SELECT metric, {a}, {b}, {b} - {a} AS delta, ({b} - {a}) * 100.0 / NULLIF({a}, 0) AS change_pct
FROM ({parts}) r""", f"one AS ({one_sql})")


SQL["ask02_period_compare"] = compare_rows(
    f"SELECT {cond_metrics('f.visitdatekey BETWEEN 19970101 AND 19970331', '_a')}, "
    f"{cond_metrics('f.visitdatekey BETWEEN 19970401 AND 19970630', '_b')} {FROM_P} "
    "WHERE f.visitdatekey >= 19970101 AND f.visitdatekey <= 19970630", "period_a", "period_b")
SQL["ask12_ab_compare"] = compare_rows(
    f"SELECT {cond_metrics(chr(112) + '.newscategory IN (' + chr(39) + 'Culture' + chr(39) + ')', '_a')}, "
    f"{cond_metrics(chr(112) + '.newscategory IN (' + chr(39) + 'Strategy' + chr(39) + ')', '_b')} {FROM_P} "
    "WHERE p.newscategory IN ('Culture') OR p.newscategory IN ('Strategy')", "side_a", "side_b")

GROWTH = f"""g AS (SELECT f.referrerapplicationid, CAST(date_trunc('month', d.date) AS DATE) AS period_start,
  {UV} AS uv {FROM_DP} GROUP BY 1, 2)"""
SQL["ask03_growth_by_channel"] = q("""
SELECT c.referrerapplicationid, c.period_start, c.uv, p.uv AS prev_uv,
       CAST(c.uv - p.uv AS DOUBLE) * 100.0 / NULLIF(CAST(p.uv AS DOUBLE), 0) AS growth_pct
FROM g c LEFT JOIN g p ON p.referrerapplicationid = c.referrerapplicationid
  AND p.period_start = CAST(c.period_start - INTERVAL 1 MONTH AS DATE)""", GROWTH)
QG = f"""g AS (SELECT COALESCE(p.websitename, 'Unknown') AS websitename,
  CAST(date_trunc('quarter', d.date) AS DATE) AS period_start, {VIEWS} AS views {FROM_DP} GROUP BY 1, 2),
gr AS (SELECT c.websitename, c.period_start, c.views, p.views AS prev_views,
  CAST(c.views - p.views AS DOUBLE) * 100.0 / NULLIF(CAST(p.views AS DOUBLE), 0) AS growth_pct
  FROM g c LEFT JOIN g p ON p.websitename = c.websitename
  AND p.period_start = CAST(c.period_start - INTERVAL 3 MONTH AS DATE))"""
SQL["ask03_fastest_growing_sites"] = q("""
SELECT * FROM gr WHERE period_start = (SELECT MAX(period_start) FROM gr)
ORDER BY growth_pct DESC NULLS LAST, websitename LIMIT 5""", QG)
SQL["ask04_trend_last6_months"] = q(f"""
SELECT CAST(date_trunc('month', d.date) AS DATE) AS period_start, {UV} AS uv, {VIEWS} AS views,
       {ENG} AS engagements
{FROM_DP} WHERE f.visitdatekey >= 20000101 AND f.visitdatekey <= 20000630 GROUP BY 1""")

PAGES = f"""pg AS (SELECT f.marketingpageid, COALESCE(p.pagename, 'Unknown') AS pagename, {VIEWS} AS total_views,
  {UV} AS uv, {LIKES_N} AS likes, COALESCE({COMMENTS}, 0) AS comments, {ENG0} AS engagements
  {FROM_P} WHERE {{where}} GROUP BY 1, 2)"""
BY_CHANNEL = PAGES.replace("pg AS (SELECT ", "pg AS (SELECT f.referrerapplicationid, ").replace("GROUP BY 1, 2", "GROUP BY ALL").format(where="true")
SQL["ask05_zero_engagement_pages"] = q("SELECT * FROM pg WHERE engagements = 0", BY_CHANNEL)
SQL["ask06_ignored_pages"] = q("""
SELECT p.marketingpageid, p.pagename, p.websitename, p.contenttype, c.referrerapplicationid
FROM page_inventory p, (SELECT DISTINCT referrerapplicationid FROM fact) c
WHERE NOT EXISTS (SELECT 1 FROM fact f WHERE f.marketingpageid = p.marketingpageid AND f.referrerapplicationid = c.referrerapplicationid)""")
SQL["ask07_comments_without_likes"] = q("SELECT * FROM pg WHERE comments > 0 AND likes = 0", BY_CHANNEL)
SQL["agg21_comments_per_page"] = q(f"""
SELECT *, {ratio0('comments', 'pages')} AS comments_per_page
FROM (SELECT COALESCE(p.contenttype, 'Unknown') AS contenttype, COALESCE({COMMENTS}, 0) AS comments, COUNT(DISTINCT f.marketingpageid) AS pages, {VIEWS} AS total_views
      {FROM_P} GROUP BY 1) t""")
SQL["ask08_top_by_ratio"] = q(f"""
SELECT *, {pct0('likes', 'total_views')} AS like_to_view_pct FROM pg WHERE total_views > 100
ORDER BY like_to_view_pct DESC, marketingpageid LIMIT 20""", PAGES.format(where="true"))


def dow(keys):
    k = ", ".join(f"d.{x}" for x in keys)
    kk = ", ".join(keys)
    return q(f"""
SELECT per.*, tot.uv, tot.total_views FROM
  (SELECT {kk}, COUNT(*) AS days, AVG(uv) AS avg_daily_uv, AVG(v) AS avg_daily_views
   FROM (SELECT {k}, d.date, {UV} AS uv, {VIEWS} AS v {FROM_DP} GROUP BY {k}, d.date) dd GROUP BY {kk}) per
JOIN (SELECT {k}, {UV} AS uv, {VIEWS} AS total_views {FROM_DP} GROUP BY {k}) tot USING ({kk})""")


SQL["ask09_day_of_week_profile"] = dow(["day_of_week", "day_name"])
SQL["ask09_weekend_profile"] = dow(["is_weekend"])
SQL["ask10_peak_month"] = q("""
SELECT AVG(uv) AS mean_uv, MIN(uv) AS min_uv, MAX(uv) AS max_uv, CAST(SUM(uv) AS BIGINT) AS sum_uv,
       (SELECT period_start FROM pm ORDER BY uv, period_start LIMIT 1) AS period_start_at_min,
       (SELECT period_start FROM pm ORDER BY uv DESC, period_start LIMIT 1) AS period_start_at_max
FROM pm""", f"""pm AS (SELECT CAST(date_trunc('month', d.date) AS DATE) AS period_start, {UV} AS uv
  {FROM_DP} GROUP BY 1)""")
SQL["ask11_segment_share"] = q(f"""
SELECT employeeclass, uv, ROUND(CAST(uv AS DOUBLE) * 100.0 / NULLIF(CAST(SUM(uv) OVER () AS DOUBLE), 0), 2) AS share_pct
FROM (SELECT COALESCE(e.employeeclass, 'Unknown') AS employeeclass, {UV} AS uv {FROM_PE} GROUP BY 1) g""")
BP = f"""bp AS (SELECT f.marketingpageid, COALESCE(p.contenttype, 'Unknown') AS contenttype, {UV} AS uv,
  {VIEWS} AS total_views, {ENG0} AS engagements {FROM_P} GROUP BY 1, 2)"""
SQL["ask13_benchmark_page"] = q(f"""
SELECT 'page' AS level, {pct0('engagements', 'total_views')} AS engagement_rate,
       CAST(total_views AS DOUBLE) AS total_views, CAST(uv AS DOUBLE) AS uv,
       CAST(1 AS BIGINT) AS pages FROM bp WHERE marketingpageid = '1'
UNION ALL
SELECT 'group', {pct0('SUM(engagements)', 'SUM(total_views)')}, AVG(total_views), AVG(uv), COUNT(*) FROM bp
WHERE contenttype IN (SELECT contenttype FROM bp WHERE marketingpageid = '1')
UNION ALL
SELECT 'all', {pct0('SUM(engagements)', 'SUM(total_views)')}, AVG(total_views), AVG(uv), COUNT(*) FROM bp""", BP)
SQL["ask14_co_visit"] = q(f"""
SELECT referrerapplicationid, COUNT_IF(a) AS visitors_a, COUNT_IF(b) AS visitors_b,
       COUNT_IF(a AND b) AS visitors_both, {pct0('COUNT_IF(a AND b)', 'COUNT_IF(a)')} AS a_to_b_pct,
       100.0 - {pct0('COUNT_IF(a AND b)', 'COUNT_IF(a)')} AS drop_off_pct
FROM (SELECT f.referrerapplicationid, f.viewingcontactid,
             MAX(COALESCE(p.contenttype IN ('Homepage'), false)) AS a,
             MAX(COALESCE(p.contenttype IN ('Article'), false)) AS b
      {FROM_P} WHERE f.viewingcontactid IS NOT NULL GROUP BY 1, 2) pv GROUP BY 1""")
SQL["ask15_content_engagers"] = q(f"""
SELECT contenttype, COUNT(*) AS uv, COUNT_IF(eng) AS engaged_visitors,
       {pct0('COUNT_IF(eng)', 'COUNT(*)')} AS engagement_conversion
FROM (SELECT COALESCE(p.contenttype, 'Unknown') AS contenttype, f.viewingcontactid,
             MAX({LIKE_ROW} OR COALESCE(f.comments, 0) > 0) AS eng
      {FROM_P} WHERE f.viewingcontactid IS NOT NULL AND p.newscategory IN ('Strategy') GROUP BY 1, 2) pv
GROUP BY 1""")
SQL["ask16_reach_gap"] = q(f"""
SELECT r.segment AS employeebusinessdivision, r.employees, r.uv, r.reach_rate,
       COALESCE(eng.engagement_rate, 0.0) AS engagement_rate
FROM ({_reach('employeebusinessdivision')}) r
LEFT JOIN (SELECT COALESCE(e.employeebusinessdivision, 'Unknown') AS seg, {RATE0} AS engagement_rate
           FROM fact f LEFT JOIN page_inventory p ON f.marketingpageid = p.marketingpageid
           JOIN employee_contact e ON f.viewingcontactid = e.contactid GROUP BY 1) eng ON r.segment = eng.seg""")
SQL["ask17_target_org_match"] = q(f"""
SELECT COALESCE(p.targetorganization, 'Unknown') AS targetorganization, {UV} AS uv,
       COUNT(DISTINCT CASE WHEN e.employeebusinessdivision = p.targetorganization THEN f.viewingcontactid END)
         AS matching_visitors,
       {pct0('COUNT(DISTINCT CASE WHEN e.employeebusinessdivision = p.targetorganization THEN f.viewingcontactid END)', UV)}
         AS target_match_rate
{FROM_PE} GROUP BY 1""")
SQL["ask19_page_lookup"] = q("SELECT * FROM pg", PAGES.format(where="contains(lower(p.pagename), 'ring')"))
SQL["ask19_page_lookup_by_region"] = q(f"""
SELECT COALESCE(e.employeeregion, 'Unknown') AS employeeregion, {UV} AS uv, {VIEWS} AS total_views,
       {VISITS} AS total_visits, {LIKES_N} AS likes, {COMMENTS} AS comments, {ENG0} AS engagements,
       {RATE0} AS engagement_rate
{FROM_PE} WHERE contains(lower(p.pagename), 'ring') GROUP BY 1""")

# as_of 2000-06-15: fixed expectations of the named periods
PERIODS = [("today", 20000615, 20000615), ("this_week", 20000612, 20000618),
           ("last_week", 20000605, 20000611), ("this_month", 20000601, 20000630),
           ("last_month", 20000501, 20000531), ("this_quarter", 20000401, 20000630),
           ("last_quarter", 20000101, 20000331), ("this_year", 20000101, 20001231),
           ("last_n_days", 20000516, 99991231)]
SQL["ask20_period_summary"] = q(f"""
SELECT pr.period, CAST(pr.day_from AS BIGINT) AS day_from, CAST(pr.day_to AS BIGINT) AS day_to, {UV} AS uv, {VIEWS} AS total_views, {VISITS} AS total_visits,
       {LIKES_N} AS likes, COALESCE({COMMENTS}, 0) AS comments, {ENG0} AS engagements, {RATE0} AS engagement_rate
FROM fact f LEFT JOIN page_inventory p ON f.marketingpageid = p.marketingpageid
JOIN (VALUES {', '.join(f"('{n}', {a}, {b})" for n, a, b in PERIODS)}) pr(period, day_from, day_to)
  ON f.visitdatekey BETWEEN pr.day_from AND pr.day_to
GROUP BY pr.period, pr.day_from, pr.day_to""")

# ---------------------------------------------------------- ASK-18 journeys
EV = """ev AS (SELECT user_id, ts, event_id, json_extract_string(props, '$.k') AS page FROM events),
s0 AS (SELECT *, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts FROM ev),
s1 AS (SELECT *, CASE WHEN prev_ts IS NULL OR ts - prev_ts > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS st FROM s0),
sess AS (SELECT *, CAST(SUM(st) OVER (PARTITION BY user_id ORDER BY ts, event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_no FROM s1),
ss AS (SELECT user_id, session_no, COUNT(*) AS events, COUNT(DISTINCT page) AS pages,
              MIN(ts) AS session_start_ts, MAX(ts) AS session_end_ts FROM sess GROUP BY 1, 2),
nx AS (SELECT page AS step_1,
              LEAD(page, 1) OVER w AS step_2, LEAD(session_no, 1) OVER w AS s2,
              LEAD(page, 2) OVER w AS step_3, LEAD(session_no, 2) OVER w AS s3, session_no
       FROM sess WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""
SQL["ask18_sessions"] = q("SELECT * FROM ss", EV)
SQL["ask18_session_depth"] = q("SELECT events AS depth, COUNT(*) AS sessions FROM ss GROUP BY 1", EV)
SQL["ask18_next_page"] = q("""
SELECT step_1 AS page, step_2 AS next_page, COUNT(*) AS transitions FROM nx
WHERE s2 = session_no GROUP BY 1, 2""", EV)
SQL["ask18_common_paths3"] = q("""
SELECT step_1, step_2, step_3, COUNT(*) AS occurrences FROM nx
WHERE s2 = session_no AND s3 = session_no GROUP BY 1, 2, 3
ORDER BY occurrences DESC, step_1, step_2, step_3 LIMIT 20""", EV)

# --------------------------------------------------------------- WIN, SRT
SQL["win5_cumulative_reach"] = q(f"""
SELECT dd.month, dd.date, COALESCE(n.new_visitors, 0) AS new_visitors,
       CAST(SUM(COALESCE(n.new_visitors, 0)) OVER (PARTITION BY dd.month ORDER BY dd.date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_uv
FROM (SELECT DISTINCT CAST(date_trunc('month', d.date) AS DATE) AS month, d.date {FROM_DP}) dd
LEFT JOIN (SELECT month, first AS date, COUNT(*) AS new_visitors
           FROM (SELECT CAST(date_trunc('month', d.date) AS DATE) AS month, f.viewingcontactid, MIN(d.date) AS first
                 {FROM_DP} WHERE f.viewingcontactid IS NOT NULL GROUP BY 1, 2) fv GROUP BY 1, 2) n
  ON dd.month = n.month AND dd.date = n.date""")
SQL["srt3_daily_engagement_tail30"] = q(f"""
SELECT * FROM (SELECT d.date, d.day_name, d.is_weekend, {LIKES} AS likes, {COMMENTS} AS comments,
       {ENG} AS total_engagements, {VIEWS} AS views, {rate(3)} AS engagement_rate_pct
  {FROM_DP} GROUP BY d.date, d.day_name, d.is_weekend ORDER BY d.date DESC LIMIT 30) t""")
SQL["srt4_top_pages_per_site"] = q("""
SELECT * FROM (SELECT pp.*, CAST(ROW_NUMBER() OVER (PARTITION BY websitename ORDER BY uv DESC, marketingpageid)
                                 AS INTEGER) AS rank FROM pp) r WHERE rank <= 3""", PP)

# ---------------------------------------------------------------- MRG-2..6
EXTRACT = """inc AS (SELECT * REPLACE (views + 1 AS views) FROM fact
  WHERE visitdatekey BETWEEN 19980101 AND 19980331 AND visitdatekey <> 19980215),
b AS (SELECT MIN(visitdatekey) AS lo, MAX(visitdatekey) AS hi FROM inc),
merged AS (SELECT fact.* FROM fact, b
           WHERE fact.visitdatekey IS NULL OR NOT COALESCE(fact.visitdatekey BETWEEN b.lo AND b.hi, false)
           UNION ALL SELECT * FROM inc)"""
SQL["mrg2_replace_range"] = q("SELECT * FROM merged", EXTRACT)
SQL["mrg6_load_audit"] = q("""
SELECT 'fact' AS "table", (SELECT COUNT(*) FROM fact) AS rows_before, (SELECT COUNT(*) FROM inc) AS incoming_rows,
       (SELECT COUNT(*) FROM merged) AS rows_after, (SELECT lo FROM b) AS min_key, (SELECT hi FROM b) AS max_key""",
                           EXTRACT)


def _upsert(cur, allv, key, upd_where, replace):
    return q(f"""
SELECT * FROM {cur} WHERE {key} IS NULL OR {key} NOT IN (SELECT {key} FROM inc WHERE {key} IS NOT NULL)
UNION ALL SELECT * FROM inc""", f"""inc AS (
  SELECT * FROM {allv} WHERE {key} NOT IN (SELECT {key} FROM {cur} WHERE {key} IS NOT NULL)
  UNION ALL SELECT * REPLACE ({replace}) FROM {cur} WHERE {upd_where})""")


SQL["mrg3_upsert_pages"] = _upsert("page_inventory", "page_all", "marketingpageid",
                                   "contenttype = 'Article'", "upper(pagename) AS pagename")
SQL["mrg4_upsert_employees"] = _upsert("employee_contact", "emp_all", "contactid",
                                       "employeeregion = 'ASIA'", "'Employee' AS employeeclass")

# ------------------------------------------------- load path on storage
# an empty CSV field, quoted or not, is NULL
AS_CSV = "* REPLACE (NULLIF(marketingpageidliked, '') AS marketingpageidliked)"
SQL["src1_fact_csv"] = q(f"SELECT {AS_CSV} FROM fact")
SQL["src2_page_csv"] = q("SELECT * REPLACE (pagename || ', \"draft\"' || chr(10) || '2nd line' AS pagename) FROM page_inventory")
SQL["src3_employee_csv"] = q("SELECT * FROM employee_contact")
SQL["mrg1_store_refresh"] = q("SELECT * FROM fact")
SQL["mrg2_store_replace"] = SQL["mrg2_replace_range"]
SQL["mrg3_store_upsert"] = SQL["mrg3_upsert_pages"]
SQL["mrg4_store_upsert"] = SQL["mrg4_upsert_employees"]
SQL["mrg7_load_job"] = q(f"SELECT {AS_CSV} FROM merged", EXTRACT)
SQL["snk1_export_roundtrip"] = q("""
SELECT f.*, p.pagename, e.employeeregion, d.year_month FROM fact f
LEFT JOIN page_inventory p ON f.marketingpageid = p.marketingpageid
LEFT JOIN employee_contact e ON f.viewingcontactid = e.contactid
JOIN dim_date d ON f.visitdatekey = d.datekey""")
SQL["snk3_report_csv"] = oracle_sql.SQL["qry07_uv_by_theme"]
SQL["str1_stream_merge"] = q("SELECT * FROM merged", EXTRACT.replace("UNION ALL SELECT * FROM inc", f"UNION ALL SELECT {AS_CSV} FROM inc"))

SQL["join8_viewer_set_semi_join"] = q(f"""
SELECT COALESCE(p.contenttype, 'Unknown') AS contenttype, {UV} AS uv, {VIEWS} AS total_views
{FROM_P} WHERE f.viewingcontactid IN (
  SELECT DISTINCT f.viewingcontactid {FROM_P} WHERE p.newscategory IN ('Strategy') AND f.viewingcontactid IS NOT NULL)
GROUP BY 1""")
SQL["str1_stream_pages"] = SQL["mrg3_upsert_pages"]
SQL["str1_stream_employees"] = SQL["mrg4_upsert_employees"]
SQL["val2_month_counts"] = q("""
SELECT visitdatekey // 100 AS visit_month, CAST(SUM(n) AS BIGINT) AS rows, COUNT(*) AS keys, COUNT(*) FILTER (n > 1) AS duplicates
FROM (SELECT visitdatekey, marketingpageid, viewingcontactid, referrerapplicationid, COUNT(*) AS n FROM merged GROUP BY ALL) k
GROUP BY visitdatekey // 100""", EXTRACT)
