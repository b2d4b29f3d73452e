"""The load job (MRG-1, MRG-7): CSV extracts -> stored star -> checks -> export.

``run_load`` is what ``python -m portal_metrics.plans.load_job`` runs.  It
follows the reference's order: fact, pages, optional employees, calendar,
validation, Parquet export (the export runs even when validation warns).
"""

from __future__ import annotations

import argparse
import dataclasses
import logging
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import DEFAULT_END, DEFAULT_START, date_dim
from ..operators.quality import QualityReport, validate, validate_store
from ..schemas import EMPLOYEE_SCHEMA, PAGE_SCHEMA
from ..sources.csv import read_checked_extract
from ..sources.optional import path_exists
from ..sources.store import StarStore, export_parquet

log = logging.getLogger("portal_metrics.load")


@dataclasses.dataclass
class TableAudit:
    table: str
    rows_before: int
    incoming_rows: int
    rows_after: int
    min_key: int | None = None
    max_key: int | None = None
    note: str = ""
    rejected_rows: int = 0


@dataclasses.dataclass
class LoadResult:
    audits: list
    quality: QualityReport | None
    exported: list


def _set_aside(store: StarStore, table: str, rejected) -> int:
    """Write the records that no table can take to ``_rejected/<table>`` of the store; how many there are."""
    path = f"{store.root}/_rejected/{table}/{uuid.uuid4().hex}"
    rejected.write.parquet(path)
    n = store.spark.read.parquet(path).count()
    if n:
        log.warning("%s extract: %s records without the header's number of fields set aside in %s", table, f"{n:,}", path)
    return n


def load_fact(store: StarStore, path: str, full_refresh: bool) -> TableAudit:
    spark = store.spark
    before = store.fact().count()
    inc, rejected = read_checked_extract(spark, "fact", path)
    lost = _set_aside(store, "fact", rejected)
    inc = inc.persist()
    try:
        s = inc.agg(F.count(F.lit(1)).alias("n"), F.min("visitdatekey").alias("lo"),
                    F.max("visitdatekey").alias("hi")).first()
        if full_refresh:
            store.full_refresh_fact(inc)
            note = "full refresh"
        elif s["n"] == 0 or s["lo"] is None:
            note = "empty extract: nothing replaced"
            log.warning("fact extract %s has no dated rows; store unchanged", path)
        else:
            removed = store.replace_fact_range(inc, s["lo"], s["hi"])
            note = f"replaced {s['lo']}..{s['hi']}" + (f"; emptied months {removed}" if removed else "")
    finally:
        inc.unpersist()
    return TableAudit("fact", before, s["n"], store.fact().count(), s["lo"], s["hi"], note, lost)


def load_dimension(store: StarStore, name: str, path: str, key: str, schema, full_refresh: bool) -> TableAudit:
    df, rejected = read_checked_extract(store.spark, name, path)
    lost = _set_aside(store, name, rejected)
    cur = store.dimension(name, schema)
    before = cur.count() if cur is not None else 0
    n = df.count()
    if full_refresh:
        store.write_dimension(name, df)
    else:
        store.upsert_dimension(name, df, key, schema)
    after = store.dimension(name, schema).count()
    return TableAudit(name, before, n, after, note="full refresh" if full_refresh else "upsert", rejected_rows=lost)


def run_load(spark: SparkSession, fact_csv: str, page_csv: str, employee_csv: str | None, out_dir: str,
             full_refresh: bool = False, export: bool = True, export_dir: str | None = None,
             calendar=(DEFAULT_START, DEFAULT_END), check: bool = True,
             validate_scope: str = "all") -> LoadResult:
    """MRG-7: the whole load as one Spark application.

    ``validate_scope='all'`` checks the whole fact (as the reference does);
    ``'range'`` checks only the days the fact extract replaced (see
    ``quality.validate``) -- at scale a few months instead of the table;
    ``'months'`` gives the verdict on the whole table, but counts keys only
    in months that were never checked as they are now (see
    ``quality.validate_store``)."""
    store = StarStore(spark, out_dir)
    audits = [load_fact(store, fact_csv, full_refresh),
              load_dimension(store, "page_inventory", page_csv, "marketingpageid",
                             PAGE_SCHEMA, full_refresh)]
    if employee_csv and path_exists(spark, employee_csv):
        audits.append(load_dimension(store, "employee_contact", employee_csv, "contactid",
                                     EMPLOYEE_SCHEMA, full_refresh))
    else:
        log.info("no employee file at %s; keeping the stored table (if any)", employee_csv)
    store.write_calendar(date_dim(spark, *calendar))
    model = store.model()
    fa = audits[0]
    rng = (fa.min_key, fa.max_key) if validate_scope != "all" and not full_refresh else None
    quality = (validate_store(store, rng) if validate_scope == "months" else validate(model, rng)) if check else None
    if quality is not None:
        for line in quality.lines():
            log.info(line)
    exported = export_parquet(model, export_dir or f"{out_dir.rstrip('/')}/export") if export else []
    return LoadResult(audits, quality, exported)


def main(argv=None):
    ap = argparse.ArgumentParser(description="Load page-view CSV extracts into the star store.")
    ap.add_argument("--fact", required=True)
    ap.add_argument("--inventory", required=True)
    ap.add_argument("--employee", default=None)
    ap.add_argument("--out", required=True, help="store root (shared storage on a cluster)")
    ap.add_argument("--full-refresh", action="store_true")
    ap.add_argument("--no-parquet", action="store_true")
    ap.add_argument("--validate-scope", choices=("all", "range", "months"), default="all",
                    help="check the whole fact, only the days the extract replaced, or months not checked before")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("portal_metrics-load").getOrCreate()
    res = run_load(spark, a.fact, a.inventory, a.employee, a.out, a.full_refresh, not a.no_parquet,
                   validate_scope=a.validate_scope)
    for au in res.audits:
        print(au)


if __name__ == "__main__":
    main()
