"""Registered queries of the load path: CSV -> store -> export, over the driver's tables.

Each query writes what a source system would deliver (the star as CSV, or as tables) into a new folder under the
shared checkpoint folder, runs the loader or the store on it, and returns what is read back, row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import StarModel
from ..schemas import EMPLOYEE_COLUMNS, EMPLOYEE_SCHEMA, FACT_COLUMNS, FACT_PARTITION, PAGE_COLUMNS, PAGE_SCHEMA
from ..session import scratch_dir
from ..sources.csv import read_employee_csv, read_fact_csv, read_page_csv
from ..sources.store import StarStore, export_parquet, export_report
from ..sources.tpch_star import CAL_END, CAL_START, employees_from_tpch, pages_from_tpch, star_from_tpch
from ..streaming.extracts import stream_employee_extracts, stream_fact_extracts, stream_page_extracts
from . import reports
from .load_job import run_load


def _to_csv(df: DataFrame, path: str, cols, header: str = "{}") -> str:
    """The table as an extract with the source system's headers; quotes inside fields are doubled."""
    out = df.select(*[F.col(target).alias(header.format(source)) for target, _, source in cols])
    out.write.option("header", True).option("escape", '"').csv(path)
    return path


def _stored(spark: SparkSession, sf_dir: str) -> tuple[StarStore, StarModel]:
    store, star = StarStore(spark, scratch_dir(spark, "store")), star_from_tpch(spark, sf_dir)
    store.full_refresh_fact(star.fact)
    return store, star


def _fact(store: StarStore) -> DataFrame:
    return store.fact().drop(FACT_PARTITION)


def fact_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1."""
    return read_fact_csv(spark, _to_csv(star_from_tpch(spark, sf_dir).fact, scratch_dir(spark, "src1"), FACT_COLUMNS))


def page_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-2: names with commas, quotes and line breaks; the pages missing from the inventory come with id 'Unknown'."""
    known = F.col("marketingpageid").cast("long") % 20 != 0
    pages = pages_from_tpch(spark, sf_dir, all_parts=True)
    pages = pages.withColumns({
        "pagename": F.concat("pagename", F.lit(', "draft"\n2nd line')),
        "marketingpageid": F.when(known, F.col("marketingpageid")).otherwise("Unknown")})
    return read_page_csv(spark, _to_csv(pages, scratch_dir(spark, "src2"), PAGE_COLUMNS))


def employee_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-3, headers ``employee_contact[X]``."""
    path = _to_csv(star_from_tpch(spark, sf_dir).employee_contact, scratch_dir(spark, "src3"), EMPLOYEE_COLUMNS,
                   "employee_contact[{}]")
    return read_employee_csv(spark, path)


def store_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRG-1 on storage: the second refresh replaces the first."""
    store, star = _stored(spark, sf_dir)
    store.full_refresh_fact(star.fact)
    return _fact(store)


def store_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRG-2 on storage, the same extract merged twice."""
    from .catalog import EXTRACT_FROM, EXTRACT_TO, fact_extract

    store, star = _stored(spark, sf_dir)
    for _ in range(2):
        store.replace_fact_range(fact_extract(star), EXTRACT_FROM, EXTRACT_TO)
    return _fact(store)


def store_upsert_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRG-3 on storage."""
    from .catalog import page_extract

    store, cur = StarStore(spark, scratch_dir(spark, "store")), star_from_tpch(spark, sf_dir).page_inventory
    store.write_dimension("page_inventory", cur)
    store.upsert_dimension("page_inventory", page_extract(spark, sf_dir, cur), "marketingpageid", PAGE_SCHEMA)
    return store.pages()


def store_upsert_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRG-4 on storage."""
    from .catalog import employee_extract

    store, cur = StarStore(spark, scratch_dir(spark, "store")), star_from_tpch(spark, sf_dir).employee_contact
    store.write_dimension("employee_contact", cur)
    store.upsert_dimension("employee_contact", employee_extract(spark, sf_dir, cur), "contactid", EMPLOYEE_SCHEMA)
    return store.employees()


def load_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRG-7: a full load from CSV, then an incremental one; the fact as it is stored then."""
    from .catalog import fact_extract

    star, d = star_from_tpch(spark, sf_dir), scratch_dir(spark, "load")
    full = _to_csv(star.fact, f"{d}/fact", FACT_COLUMNS)
    extract = _to_csv(fact_extract(star), f"{d}/extract", FACT_COLUMNS)
    pages = _to_csv(star.page_inventory, f"{d}/pages", PAGE_COLUMNS)
    employees = _to_csv(employees_from_tpch(spark, sf_dir), f"{d}/employees", EMPLOYEE_COLUMNS)
    calendar = (CAL_START, CAL_END)
    run_load(spark, full, pages, employees, f"{d}/store", full_refresh=True, export=False, calendar=calendar)
    run_load(spark, extract, pages, employees, f"{d}/store", calendar=calendar, validate_scope="range")
    return StarModel.from_parquet(spark, f"{d}/store/export").fact


def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1 and SRC-6: the four tables exported, read back and joined."""
    out = scratch_dir(spark, "export")
    star = star_from_tpch(spark, sf_dir)
    export_parquet(star, out)
    wide = StarModel.from_parquet(spark, out).wide(page="left", date="inner", employee="left")
    return wide.select(*star.fact.columns, "pagename", "employeeregion", "year_month")


def report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3: a report written as CSV and read back under its schema."""
    out = scratch_dir(spark, "report")
    report = reports.uv_by_theme(star_from_tpch(spark, sf_dir))
    export_report(report, out)
    return spark.read.schema(report.schema).option("header", True).csv(out)


def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-1: extracts of whole months dropped into a folder and merged one by one; a second run finds nothing new."""
    from .catalog import fact_extract

    store, star = _stored(spark, sf_dir)
    extract = fact_extract(star).repartitionByRange(F.floor(F.col("visitdatekey") / 100))
    drop = _to_csv(extract, scratch_dir(spark, "drop"), FACT_COLUMNS)
    for _ in range(2):
        stream_fact_extracts(spark, drop, store).awaitTermination()
    return _fact(store)


def stream_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-1 for pages: an inventory extract dropped into a folder; a second run finds nothing new."""
    from .catalog import page_extract

    store, cur = StarStore(spark, scratch_dir(spark, "store")), star_from_tpch(spark, sf_dir).page_inventory
    store.write_dimension("page_inventory", cur)
    drop = _to_csv(page_extract(spark, sf_dir, cur).coalesce(1), scratch_dir(spark, "drop"), PAGE_COLUMNS)
    for _ in range(2):
        stream_page_extracts(spark, drop, store).awaitTermination()
    return store.pages()


def stream_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-1 for employees."""
    from .catalog import employee_extract

    store, cur = StarStore(spark, scratch_dir(spark, "store")), star_from_tpch(spark, sf_dir).employee_contact
    store.write_dimension("employee_contact", cur)
    drop = _to_csv(employee_extract(spark, sf_dir, cur).coalesce(1), scratch_dir(spark, "drop"), EMPLOYEE_COLUMNS)
    for _ in range(2):
        stream_employee_extracts(spark, drop, store).awaitTermination()
    return store.employees()


def month_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-2..4 by month, as a load keeps them: a range of days is replaced between two checks."""
    from .catalog import EXTRACT_FROM, EXTRACT_TO, fact_extract

    store, star = _stored(spark, sf_dir)
    store.check_months()
    store.replace_fact_range(fact_extract(star), EXTRACT_FROM, EXTRACT_TO)
    rows = [(int(m) if m.isdigit() else None, c["rows"], c["keys"], c["duplicates"]) for m, c in store.check_months().items()]
    return spark.createDataFrame(rows, "visit_month long, rows long, keys long, duplicates long")


QUERIES = {
    "src1_fact_csv": fact_csv,
    "src2_page_csv": page_csv,
    "src3_employee_csv": employee_csv,
    "mrg1_store_refresh": store_refresh,
    "mrg2_store_replace": store_replace,
    "mrg3_store_upsert": store_upsert_pages,
    "mrg4_store_upsert": store_upsert_employees,
    "mrg7_load_job": load_job,
    "snk1_export_roundtrip": export_roundtrip,
    "snk3_report_csv": report_csv,
    "str1_stream_merge": stream_merge,
    "str1_stream_pages": stream_pages,
    "str1_stream_employees": stream_employees,
    "val2_month_counts": month_counts,
}
