"""Star adapter over the driver's TPC-H-like tables.

The driver ships lineitem/orders/part/customer/nation/region, not page
views.  This module derives the star from them with plain DataFrame
expressions, so every report reads the given tables and its work grows
with them.  ``portal_metrics.testing.oracle_sql`` holds the same mapping
as DuckDB SQL; all derived numbers are integers or dyadic fractions so
both engines produce identical values.

Mapping (fixed values):

* fact = lineitem JOIN orders on l_orderkey = o_orderkey
  - visitdatekey = yyyymmdd(o_orderdate)
  - referrerapplicationid = 'Email' for 1-URGENT / 2-HIGH,
    'Intranet' for 3-MEDIUM / 4-NOT SPECIFIED, else 'Other'
  - marketingpageid = l_partkey as text; views = l_quantity; visits = l_linenumber
  - viewingcontactid = o_custkey as text, NULL when o_custkey % 97 = 0
  - flag = l_linestatus; durationsum = l_quantity * 0.5; durationavg = l_linenumber * 0.25
  - comments = l_linenumber % 3 for returnflag 'A'; NULL for 'N' with
    linestatus 'F'; else 0
  - marketingpageidliked = page id for returnflag 'R', '' for 'A', else NULL
* page_inventory = part with p_partkey % 20 <> 0 (5 % of pages are orphans)
* employee_contact = customer JOIN nation JOIN region with c_custkey % 25 <> 0
* dim_date = calendar 1995-01-01 .. 2001-12-31 (spans every fact)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import date_dim
from ..model import StarModel, joined_in_tasks

CAL_START = "1995-01-01"
CAL_END = "2001-12-31"
PORTAL = "https://portal.example.com/"

# --- fixed values used by the mapping ---
NEWS_CATEGORIES = ["Strategy", "Culture", "Thought leadership", "Digital", "Operational"]
TARGET_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "Global"]
TARGET_ORGS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
LANGUAGES = ["en", "de", "fr", "es"]
TEMPLATES = ["News", "Landing", "Article page"]
EMPLOYEE_CLASSES = ["Employee", "Contractor", "Intern"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(idx: Column, values: list[str]) -> Column:
    """values[idx] as a CASE expression."""
    expr = None
    for i, v in enumerate(values):
        expr = (F.when(idx == i, F.lit(v)) if expr is None else expr.when(idx == i, F.lit(v)))
    return expr


def _daykey(ts: Column) -> Column:
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("long")


def fact_from_tpch(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    j = joined_in_tasks(li, o, "l_orderkey", "o_orderkey")
    pid = F.col("l_partkey").cast("string")
    return j.select(
        _daykey(F.col("o_orderdate")).alias("visitdatekey"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("Email"))
         .when(F.col("o_orderpriority").isin("3-MEDIUM", "4-NOT SPECIFIED"), F.lit("Intranet"))
         .otherwise(F.lit("Other")).alias("referrerapplicationid"),
        pid.alias("marketingpageid"),
        F.col("l_quantity").cast("long").alias("views"),
        F.when(F.col("o_custkey") % 97 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("o_custkey").cast("string")).alias("viewingcontactid"),
        F.col("l_linestatus").alias("flag"),
        F.col("l_linenumber").cast("long").alias("visits"),
        (F.col("l_quantity").cast("double") * F.lit(0.5)).alias("durationsum"),
        (F.col("l_linenumber").cast("double") * F.lit(0.25)).alias("durationavg"),
        F.when(F.col("l_returnflag") == "A", (F.col("l_linenumber") % 3).cast("long"))
         .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), F.lit(None).cast("long"))
         .otherwise(F.lit(0).cast("long")).alias("comments"),
        F.when(F.col("l_returnflag") == "R", pid)
         .when(F.col("l_returnflag") == "A", F.lit(""))
         .otherwise(F.lit(None).cast("string")).alias("marketingpageidliked"),
    )


def pages_from_tpch(spark: SparkSession, sf_dir: str, all_parts: bool = False) -> DataFrame:
    """Page inventory; ``all_parts`` also maps the parts left out of it."""
    p = read_table(spark, sf_dir, "part")
    if not all_parts:
        p = p.filter(F.col("p_partkey") % 20 != 0)
    key = F.col("p_partkey").cast("string")
    brand, ptype, size = F.col("p_brand"), F.col("p_type"), F.col("p_size")
    theme = F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))
    topic = F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))
    return p.select(
        brand.alias("websitename"),
        F.concat(F.lit(PORTAL), F.lower(brand)).alias("websiteurl"),
        ptype.alias("owningbusinessunit"),
        F.col("p_name").alias("pagename"),
        F.concat(F.lit(PORTAL), F.lower(brand), F.lit("/"), F.lower(ptype), F.lit("/"), key).alias("fullpageurl"),
        F.concat(F.lit("SRC-"), key).alias("sourcesystempageid"),
        key.alias("marketingpageid"),
        theme.alias("theme"),
        topic.alias("topic"),
        F.concat(F.lit("/"), F.lower(ptype), F.lit("/"), key).alias("pageurl"),
        F.when(size % 10 == 0, F.lit("Yes")).otherwise(F.lit("No")).alias("exclude"),
        brand.alias("sitename"),
        F.upper(theme).alias("theme_normalized"),
        F.upper(topic).alias("topic_normalized"),
        _pick(size % 3, TEMPLATES).alias("template"),
        F.when(ptype == "ECONOMY", F.lit("Homepage")).when(ptype == "PROMO", F.lit("Article"))
         .otherwise(ptype).alias("contenttype"),
        _pick(size % 4, LANGUAGES).alias("pagelanguage"),
        _pick(size % 5, NEWS_CATEGORIES).alias("newscategory"),
        _pick(size % 6, TARGET_REGIONS).alias("targetregion"),
        _pick(size % 5, TARGET_ORGS).alias("targetorganization"),
        F.lit(1).cast("long").alias("cnt"),
    )


def employees_from_tpch(spark: SparkSession, sf_dir: str, all_customers: bool = False) -> DataFrame:
    """Employee contacts; ``all_customers`` also maps those left out of it."""
    cst = read_table(spark, sf_dir, "customer")
    if not all_customers:
        cst = cst.filter(F.col("c_custkey") % 25 != 0)
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    # nation and region are fixed 25- and 5-row tables.
    geo = n.join(F.broadcast(r), n["n_regionkey"] == r["r_regionkey"]).select("n_nationkey", "n_name", "r_name")
    j = cst.join(F.broadcast(geo), cst["c_nationkey"] == geo["n_nationkey"], "left")
    k = F.col("c_custkey")
    none = F.lit(None).cast("string")
    return j.select(
        k.cast("string").alias("contactid"),
        F.col("c_mktsegment").alias("employeebusinessdivision"),
        F.when(k % 2 == 0, F.lit("Staff")).otherwise(F.lit("Management")).alias("employeecategory"),
        _pick(k % 3, EMPLOYEE_CLASSES).alias("employeeclass"),
        F.concat(F.lit("Cluster "), (k % 4).cast("string")).alias("employeecluster"),
        none.alias("employeefamily"),
        none.alias("employeefunction"),
        F.col("n_name").alias("employeegcrscountry"),
        F.concat(F.lit("R"), (k % 6).cast("string")).alias("employeerank"),
        F.col("r_name").alias("employeeregion"),
        none.alias("employeerole"),
        F.col("n_name").alias("employeeworkcountry"),
        F.lit("Company").alias("ou_lvl_1"),
        F.col("c_mktsegment").alias("ou_lvl_2"),
        F.col("r_name").alias("ou_lvl_3"),
        none.alias("ou_lvl_4"),
        none.alias("ou_lvl_5"),
    )


_STAR_CACHE: dict = {}


def star_from_tpch(spark: SparkSession, sf_dir: str, with_employee: bool = True) -> StarModel:
    """The star over the driver's tables.

    The returned DataFrames are lazy, immutable plans; they are built once
    per session and directory and reused (building them costs hundreds of
    driver round trips, reading them costs nothing until an action)."""
    key = (id(spark), sf_dir.rstrip("/"), with_employee)
    hit = _STAR_CACHE.get(key)
    if hit is not None and hit[0] is spark:
        return hit[1]
    model = StarModel(
        fact=fact_from_tpch(spark, sf_dir),
        page_inventory=pages_from_tpch(spark, sf_dir),
        dim_date=date_dim(spark, CAL_START, CAL_END),
        employee_contact=employees_from_tpch(spark, sf_dir) if with_employee else None,
    )
    _STAR_CACHE[key] = (spark, model)
    return model


def journey_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time-stamped page events for journeys (ASK-18): user, ts, page."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id"),
        F.col("user_id").alias("user_id"),
        F.col("ts").alias("ts"),
        F.get_json_object("props", "$.k").alias("page"),
        F.col("event_type"),
    )
