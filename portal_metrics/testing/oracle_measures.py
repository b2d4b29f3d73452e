"""DuckDB twins of the registered measure queries (MEA-*)."""

from __future__ import annotations

from .oracle_sql import COMMENTS, FROM_DP, FROM_P, FROM_PE, UV, VIEWS, VISITS, q

LIKE_ROW = "(f.marketingpageidliked IS NOT NULL AND f.marketingpageidliked != '')"
LIKES_N = f"COUNT_IF({LIKE_ROW})"
ENG0 = f"({LIKES_N} + COALESCE({COMMENTS}, 0))"


def pct0(num, den):
    return f"COALESCE(CAST({num} AS DOUBLE) * 100.0 / NULLIF(CAST({den} AS DOUBLE), 0), 0.0)"


def ratio0(num, den):
    return f"COALESCE(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0), 0.0)"


RATE0 = pct0(ENG0, VIEWS)
EMP_TOTAL = "(SELECT COUNT(DISTINCT contactid) FROM employee_contact)"

SQL: dict[str, str] = {}

SQL["mea01_07_core_by_contenttype"] = q(f"""
SELECT COALESCE(p.contenttype, 'Unknown') AS contenttype, {UV} AS uv, {VIEWS} AS total_views,
       {VISITS} AS total_visits, {LIKES_N} AS likes, {COMMENTS} AS comments, {ENG0} AS engagements,
       {RATE0} AS engagement_rate
{FROM_P} GROUP BY 1""")

SQL["mea08_09_reach_rate_by_month"] = q(f"""
SELECT year_month, uv, total_employees, {pct0('uv', 'total_employees')} AS reach_rate
FROM (SELECT d.year_month, {UV} AS uv, {EMP_TOTAL} AS total_employees {FROM_DP} GROUP BY d.year_month) t""")

SQL["mea10_daily_average_uv_by_channel"] = q(f"""
SELECT referrerapplicationid, AVG(uv) AS daily_average_uv
FROM (SELECT f.referrerapplicationid, d.date, {UV} AS uv {FROM_DP} GROUP BY 1, 2) t GROUP BY 1""")


def _segment(seg):
    return q(f"""
SELECT pop.{seg}, pop.employees, COALESCE(seen.uv, 0) AS uv,
       {pct0('COALESCE(seen.uv, 0)', 'pop.employees')} AS reach_rate
FROM (SELECT COALESCE({seg}, 'Unknown') AS {seg}, COUNT(DISTINCT contactid) AS employees
      FROM employee_contact GROUP BY 1) pop
LEFT JOIN (SELECT COALESCE(e.{seg}, 'Unknown') AS {seg}, {UV} AS uv
           FROM fact f LEFT JOIN page_inventory p ON f.marketingpageid = p.marketingpageid
           JOIN employee_contact e ON f.viewingcontactid = e.contactid GROUP BY 1) seen
  ON pop.{seg} = seen.{seg}""")


SQL["mea11_reach_by_region"] = _segment("employeeregion")
SQL["mea12_reach_by_division"] = _segment("employeebusinessdivision")

MONTHLY = f"""m AS (SELECT d.year_month, CAST(date_trunc('month', d.date) AS DATE) AS month_start, {UV} AS uv
  {FROM_DP} GROUP BY 1, 2)"""
SQL["mea13_reach_mom_change"] = q("""
SELECT c.year_month, c.month_start, c.uv, p.uv AS prev_month_uv,
       COALESCE(CAST(c.uv - p.uv AS DOUBLE) * 100.0 / NULLIF(CAST(p.uv AS DOUBLE), 0), 0.0) AS mom_change_pct
FROM m c LEFT JOIN m p ON p.month_start = CAST(c.month_start - INTERVAL 1 MONTH AS DATE)""", MONTHLY)

SQL["mea14_reach_trend_6m"] = q("""
SELECT mo.month, COUNT(DISTINCT vd.v) AS uv_6m
FROM months mo LEFT JOIN vd
  ON vd.date <= last_day(mo.month) AND vd.date > CAST(last_day(mo.month) - INTERVAL 6 MONTH AS DATE)
GROUP BY mo.month""", f"""vd AS (SELECT DISTINCT f.viewingcontactid AS v, d.date {FROM_DP}
  WHERE f.viewingcontactid IS NOT NULL),
months AS (SELECT DISTINCT CAST(date_trunc('month', d.date) AS DATE) AS month {FROM_DP})""")

SQL["mea15_17_homepage_article_ctr"] = q(f"""
SELECT referrerapplicationid, COUNT_IF(hp) AS homepage_visitors, COUNT_IF(ar) AS article_visitors,
       COUNT_IF(hp AND ar) AS both_visitors,
       {pct0('COUNT_IF(hp AND ar)', 'COUNT_IF(hp)')} AS homepage_to_article_ctr
FROM (SELECT f.referrerapplicationid, f.viewingcontactid,
             MAX(COALESCE(p.contenttype = 'Homepage', false)) AS hp,
             MAX(COALESCE(p.contenttype = 'Article', false)) AS ar
      {FROM_P} WHERE f.viewingcontactid IS NOT NULL GROUP BY 1, 2) pv
GROUP BY 1""")

SQL["mea18_21_journey_depth"] = q(f"""
SELECT tot.referrerapplicationid, COALESCE(vv.uv, 0) AS uv, COALESCE(vv.multi, 0) AS multi_page_visitors,
       {pct0('COALESCE(vv.multi, 0)', 'COALESCE(vv.uv, 0)')} AS multi_page_rate,
       {ratio0('tot.distinct_pages', 'COALESCE(vv.uv, 0)')} AS avg_pages_per_visitor,
       {ratio0('tot.total_views', 'COALESCE(vv.uv, 0)')} AS views_per_visitor,
       vv.mean_pages AS mean_pages_per_visitor
FROM (SELECT f.referrerapplicationid, COUNT(DISTINCT f.marketingpageid) AS distinct_pages, {VIEWS} AS total_views
      {FROM_P} GROUP BY 1) tot
LEFT JOIN (SELECT r, COUNT(*) AS uv, COUNT_IF(pages > 1) AS multi, AVG(pages) AS mean_pages
           FROM (SELECT f.referrerapplicationid AS r, f.viewingcontactid AS v,
                        COUNT(DISTINCT f.marketingpageid) AS pages
                 {FROM_P} WHERE f.viewingcontactid IS NOT NULL GROUP BY 1, 2) per GROUP BY r) vv
  ON tot.referrerapplicationid = vv.r""")

SQL["mea22_engagement_conversion"] = q(f"""
SELECT contenttype, COUNT(*) AS uv, COUNT_IF(eng) AS engaged_visitors,
       {pct0('COUNT_IF(eng)', 'COUNT(*)')} AS engagement_conversion
FROM (SELECT COALESCE(p.contenttype, 'Unknown') AS contenttype, f.viewingcontactid,
             MAX({LIKE_ROW} OR COALESCE(f.comments, 0) > 0) AS eng
      {FROM_P} WHERE f.viewingcontactid IS NOT NULL GROUP BY 1, 2) pv
GROUP BY 1""")


def _chan(ch):
    on = f"f.referrerapplicationid = '{ch}'"
    lk = f"COUNT_IF({on} AND {LIKE_ROW})"
    cm = f"COALESCE(CAST(SUM(CASE WHEN {on} THEN f.comments END) AS BIGINT), 0)"
    vw = f"CAST(SUM(CASE WHEN {on} THEN f.views END) AS BIGINT)"
    n = ch.lower()
    return (f"COUNT(DISTINCT CASE WHEN {on} THEN f.viewingcontactid END) AS {n}_uv, "
            f"{pct0(f'({lk} + {cm})', vw)} AS {n}_engagement_rate")


SQL["mea23_24_channel_measures"] = q(f"""
SELECT COALESCE(p.contenttype, 'Unknown') AS contenttype, {_chan('Email')}, {_chan('Intranet')}
{FROM_P} GROUP BY 1""")

SQL["mea25_page_ranks"] = q(f"""
SELECT pagename, total_views, uv, engagements,
       CAST(DENSE_RANK() OVER (ORDER BY total_views DESC NULLS LAST) AS INTEGER) AS rank_by_views,
       CAST(DENSE_RANK() OVER (ORDER BY uv DESC NULLS LAST) AS INTEGER) AS rank_by_uv,
       CAST(DENSE_RANK() OVER (ORDER BY engagements DESC NULLS LAST) AS INTEGER) AS rank_by_engagement
FROM (SELECT p.pagename, {VIEWS} AS total_views, {UV} AS uv, {ENG0} AS engagements
      FROM fact f JOIN page_inventory p ON f.marketingpageid = p.marketingpageid GROUP BY p.pagename) t""")

for _a in ("theme", "newscategory", "contenttype", "websitename"):
    SQL[f"mea26_27_{_a}_context"] = q(f"""
SELECT fine.{_a}, fine.pagename, fine.uv, fine.engagement_rate, coarse.{_a}_uv, coarse.{_a}_engagement_rate
FROM (SELECT COALESCE(p.{_a}, 'Unknown') AS {_a}, COALESCE(p.pagename, 'Unknown') AS pagename,
             {UV} AS uv, {RATE0} AS engagement_rate {FROM_P} GROUP BY 1, 2) fine
LEFT JOIN (SELECT COALESCE(p.{_a}, 'Unknown') AS {_a}, {UV} AS {_a}_uv, {RATE0} AS {_a}_engagement_rate
           {FROM_P} GROUP BY 1) coarse ON fine.{_a} = coarse.{_a}""")

SQL["mea28_30_performance_vs_avg"] = q(f"""
SELECT pagename, engagement_rate, avg_rate AS avg_engagement_rate,
       CASE WHEN engagement_rate > avg_rate THEN 'Above Average' ELSE 'Below Average' END AS performance_vs_avg,
       engagement_rate - avg_rate AS engagement_variance
FROM (SELECT COALESCE(p.pagename, 'Unknown') AS pagename, {RATE0} AS engagement_rate {FROM_P} GROUP BY 1) g,
     (SELECT {RATE0} AS avg_rate FROM fact f) a""")

STRATEGY = "p.newscategory IN ('Strategy')"
SQL["mea31_division_reach_for_content"] = q(f"""
SELECT COALESCE(e.employeebusinessdivision, 'Unknown') AS employeebusinessdivision,
       COUNT(DISTINCT v.viewingcontactid) AS content_viewers
FROM (SELECT DISTINCT f.viewingcontactid {FROM_P} WHERE {STRATEGY} AND f.viewingcontactid IS NOT NULL) v
LEFT JOIN employee_contact e ON v.viewingcontactid = e.contactid
GROUP BY 1""")

SQL["mea32_divisions_not_reached"] = q(f"""
SELECT c.marketingpageid, a.employeebusinessdivision
FROM (SELECT DISTINCT marketingpageid FROM fact) c,
     (SELECT DISTINCT employeebusinessdivision FROM employee_contact WHERE employeebusinessdivision IS NOT NULL) a
WHERE NOT EXISTS (SELECT 1 FROM fact f JOIN employee_contact e ON f.viewingcontactid = e.contactid
                  WHERE f.marketingpageid = c.marketingpageid AND e.employeebusinessdivision = a.employeebusinessdivision)""")

SQL["mea33_target_region_match"] = q(f"""
SELECT targetregion, uv, matching_visitors,
       CASE WHEN t_max = 'Global' AND t_min = 'Global' THEN 100.0 ELSE {pct0('matching_visitors', 'uv')} END
         AS target_match_rate
FROM (SELECT COALESCE(p.targetregion, 'Unknown') AS targetregion, {UV} AS uv,
             COUNT(DISTINCT CASE WHEN e.employeeregion = p.targetregion THEN f.viewingcontactid END) AS matching_visitors,
             MAX(p.targetregion) AS t_max, MIN(p.targetregion) AS t_min
      {FROM_PE} GROUP BY 1) g""")


def _cat(name, cond):
    cond = f"COALESCE({cond}, false)"
    lk = f"COUNT_IF({cond} AND {LIKE_ROW})"
    cm = f"COALESCE(CAST(SUM(CASE WHEN {cond} THEN f.comments END) AS BIGINT), 0)"
    vw = f"CAST(SUM(CASE WHEN {cond} THEN f.views END) AS BIGINT)"
    return (f"COUNT(DISTINCT CASE WHEN {cond} THEN f.viewingcontactid END) AS {name}_uv, "
            f"{pct0(f'({lk} + {cm})', vw)} AS {name}_engagement_rate")


SQL["mea34_35_category_measures"] = q(f"""
SELECT f.referrerapplicationid, {_cat('strategy', "p.newscategory = 'Strategy'")},
       {_cat('leadership', "p.newscategory IN ('Strategy', 'Culture', 'Thought leadership')")}
{FROM_P} GROUP BY 1""")

def coverage(keys: dict[str, str]) -> str:
    names = ", ".join(keys)
    return f"""SELECT {names}, uv, divisions_reached, total_divisions, total_divisions - divisions_reached AS divisions_not_reached,
       {pct0('divisions_reached', 'total_divisions')} AS division_coverage_pct,
       regions_reached, total_regions, {pct0('regions_reached', 'total_regions')} AS region_coverage_pct,
       total_employees, {pct0('uv', 'total_employees')} AS message_penetration_pct
FROM (SELECT {', '.join(f'{v} AS {k}' for k, v in keys.items())}, {UV} AS uv, COUNT(DISTINCT e.employeebusinessdivision) AS divisions_reached,
             COUNT(DISTINCT e.employeeregion) AS regions_reached,
             (SELECT COUNT(DISTINCT employeebusinessdivision) FROM employee_contact) AS total_divisions,
             (SELECT COUNT(DISTINCT employeeregion) FROM employee_contact) AS total_regions,
             {EMP_TOTAL} AS total_employees
      {FROM_PE} GROUP BY {', '.join(keys.values())}) t"""


SQL["mea36_38_coverage"] = q(coverage({"marketingpageid": "f.marketingpageid"}))
