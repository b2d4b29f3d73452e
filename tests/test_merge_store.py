"""Merges (MRG-2..6), the Parquet store and the load job."""

import os

from pyspark.sql import functions as F

from portal_metrics.operators.merge import empty_table, load_audit, replace_range, upsert
from portal_metrics.plans.load_job import run_load
from portal_metrics.schemas import FACT_SCHEMA, PAGE_SCHEMA
from portal_metrics.sources.csv import read_employee_csv, read_fact_csv, read_page_csv
from portal_metrics.sources.store import StarStore


def _f(day, page="p1", who="u1", views=1):
    return (day, "Email", page, views, who, "F", 1, 1.0, 1.0, 0, None)


def test_replace_range_missing_day_vanishes_and_null_kept(spark):
    cur = spark.createDataFrame([_f(20251001), _f(20251002), _f(20251003), _f(None), _f(20250930)], FACT_SCHEMA)
    inc = spark.createDataFrame([_f(20251001, views=9), _f(20251003, views=9)], FACT_SCHEMA)
    out = replace_range(cur, inc)
    days = sorted((r[0] or 0, r[1]) for r in out.select("visitdatekey", "views").collect())
    assert days == [(0, 1), (20250930, 1), (20251001, 9), (20251003, 9)]


def test_replace_range_empty_extract_is_noop(spark):
    cur = spark.createDataFrame([_f(20251001), _f(None)], FACT_SCHEMA)
    assert replace_range(cur, empty_table(spark, FACT_SCHEMA)).count() == 2


def test_replace_range_idempotent(spark):
    cur = spark.createDataFrame([_f(20251001), _f(20251005)], FACT_SCHEMA)
    inc = spark.createDataFrame([_f(20251002, views=3), _f(20251004)], FACT_SCHEMA)
    once = replace_range(cur, inc)
    twice = replace_range(once, inc)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_upsert_null_keys_accumulate_and_duplicates_inserted(spark):
    schema = "contactid string, employeeregion string"
    cur = spark.createDataFrame([("u1", "EMEA"), ("u2", "APAC"), (None, "X")], schema)
    inc = spark.createDataFrame([("u1", "AMER"), ("u1", "AMER"), (None, "Y")], schema)
    out = sorted(upsert(cur, inc, "contactid").collect(), key=lambda r: (r[0] or "", r[1]))
    assert [tuple(r) for r in out] == [(None, "X"), (None, "Y"), ("u1", "AMER"), ("u1", "AMER"), ("u2", "APAC")]


def test_load_audit(spark):
    cur = spark.createDataFrame([_f(20251001), _f(20251002)], FACT_SCHEMA)
    inc = spark.createDataFrame([_f(20251002, views=5)], FACT_SCHEMA)
    a = load_audit("fact", cur, inc, replace_range(cur, inc)).first()
    assert (a["rows_before"], a["incoming_rows"], a["rows_after"], a["min_key"], a["max_key"]) == \
        (2, 1, 2, 20251002, 20251002)


FACT_HEADER = ("fact_visitdatekey,fact_referrerapplicationid,fact_marketingPageId,fact_views,fact_viewingcontactid,"
               "fact_flag,fact_visits,fact_durationsum,fact_durationavg,fact_comments,fact_marketingPageIdliked")


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)
    return path


def _fact_csv(path, days):
    lines = [FACT_HEADER] + [f"{d},Email,p1,{v},u1,F,1,1.5,1.5,0,p1" for d, v in days]
    return _write(path, "\n".join(lines) + "\n")


def test_csv_binds_by_name_and_reordered(spark, tmp_path):
    cols = FACT_HEADER.split(",")
    rev = list(reversed(cols))
    row = dict(zip(cols, "20251001,Email,p1,7,u1,F,2,1.5,0.75,3,".split(",")))
    text = ",".join(rev) + "\n" + ",".join(row[c] for c in rev) + "\n"
    df = read_fact_csv(spark, _write(str(tmp_path / "f.csv"), text))
    r = df.first()
    assert r["visitdatekey"] == 20251001 and r["views"] == 7 and r["visits"] == 2 and r["comments"] == 3
    assert r["marketingpageidliked"] is None                # empty CSV field -> NULL
    assert df.schema == FACT_SCHEMA


def test_page_csv_drops_unknown_and_null(spark, tmp_path):
    from portal_metrics.schemas import PAGE_COLUMNS
    hdr = ",".join(src for _, _, src in PAGE_COLUMNS)
    def row(pid):
        vals = ["x"] * len(PAGE_COLUMNS)
        vals[6] = pid
        vals[-1] = "1"
        return ",".join(vals)
    text = "\n".join([hdr, row("p1"), row("Unknown"), row("")]) + "\n"
    df = read_page_csv(spark, _write(str(tmp_path / "p.csv"), text))
    assert [r["marketingpageid"] for r in df.collect()] == ["p1"]
    assert df.schema == PAGE_SCHEMA


def test_employee_csv_both_header_styles(spark, tmp_path):
    from portal_metrics.schemas import EMPLOYEE_SOURCE_NAMES
    a = ",".join(f"employee_contact[{n}]" for n in EMPLOYEE_SOURCE_NAMES) + "\n" + ",".join(["u1"] + ["v"] * 16) + "\n"
    b = ",".join(EMPLOYEE_SOURCE_NAMES) + "\n" + ",".join(["u2"] + ["v"] * 16) + "\n"
    ra = read_employee_csv(spark, _write(str(tmp_path / "a.csv"), a)).first()
    rb = read_employee_csv(spark, _write(str(tmp_path / "b.csv"), b)).first()
    assert ra["contactid"] == "u1" and rb["contactid"] == "u2" and rb["ou_lvl_5"] == "v"


def test_store_range_replace_empties_month(spark, tmp_path):
    store = StarStore(spark, str(tmp_path / "store"))
    first = spark.createDataFrame([_f(d) for d in (20251001, 20251015, 20251110, 20251201, 20251231)] + [_f(None)],
                                  FACT_SCHEMA)
    store.full_refresh_fact(first)
    inc = spark.createDataFrame([_f(20251001, views=4), _f(20251231, views=4)], FACT_SCHEMA)
    removed = store.replace_fact_range(inc, 20251001, 20251231)
    assert removed == [202511]
    got = sorted((r[0] or 0, r[1]) for r in store.fact().select("visitdatekey", "views").collect())
    assert got == [(0, 1), (20251001, 4), (20251231, 4)]
    assert not os.path.exists(str(tmp_path / "store" / "fact" / "visit_month=202511"))


def test_full_refresh_equals_incremental_into_empty(spark, tmp_path):
    fact = _fact_csv(str(tmp_path / "f.csv"), [(20251001, 1), (20251002, 2)])
    hdr_p = ",".join(src for _, _, src in __import__("portal_metrics.schemas", fromlist=["x"]).PAGE_COLUMNS)
    pages = _write(str(tmp_path / "p.csv"), hdr_p + "\n" + ",".join(["s", "u", "b", "n", "f", "x", "p1"] + ["t"] * 13 + ["1"]) + "\n")
    a = run_load(spark, fact, pages, str(tmp_path / "missing.csv"), str(tmp_path / "a"), full_refresh=True, export=False)
    b = run_load(spark, fact, pages, None, str(tmp_path / "b"), full_refresh=False, export=True)
    sa = StarStore(spark, str(tmp_path / "a")).fact().drop("visit_month")
    sb = StarStore(spark, str(tmp_path / "b")).fact().drop("visit_month")
    assert sorted(sa.collect()) == sorted(sb.collect())
    assert b.quality.valid and len(b.exported) == 3          # no employee table -> 3 files
    assert a.audits[0].rows_after == 2


def test_incremental_load_twice_is_idempotent(spark, tmp_path):
    fact = _fact_csv(str(tmp_path / "f.csv"), [(20251001, 1), (20251003, 2)])
    hdr_p = ",".join(src for _, _, src in __import__("portal_metrics.schemas", fromlist=["x"]).PAGE_COLUMNS)
    pages = _write(str(tmp_path / "p.csv"), hdr_p + "\n" + ",".join(["s", "u", "b", "n", "f", "x", "p1"] + ["t"] * 13 + ["1"]) + "\n")
    root = str(tmp_path / "s")
    run_load(spark, fact, pages, None, root, export=False)
    r = run_load(spark, fact, pages, None, root, export=False)
    assert r.audits[0].rows_before == r.audits[0].rows_after == 2
    assert r.audits[1].rows_after == 1                       # page upsert replaced, not duplicated


def test_infer_mode_ends_in_declared_schema(spark, tmp_path):
    path = _fact_csv(str(tmp_path / "f.csv"), [(20251001, 3)])
    df = read_fact_csv(spark, path, infer=True)
    assert df.schema == FACT_SCHEMA and df.first()["views"] == 3


def test_export_report_csv_roundtrip(spark, tmp_path):
    from portal_metrics.plans.reports import summary
    from portal_metrics.sources.store import export_report
    from tests.fixtures import fixture_model
    out = str(tmp_path / "rep")
    export_report(summary(fixture_model(spark)), out)
    back = spark.read.option("header", True).csv(out).first()
    assert back["total_rows"] == "7"


def test_range_scoped_validation(spark, tmp_path):
    """A duplicate key inside the replaced range is caught by the range check;
    the verdict equals the whole-table check."""
    hdr_p = ",".join(src for _, _, src in __import__("portal_metrics.schemas", fromlist=["x"]).PAGE_COLUMNS)
    pages = _write(str(tmp_path / "p.csv"), hdr_p + "\n" + ",".join(["s", "u", "b", "n", "f", "x", "p1"] + ["t"] * 13 + ["1"]) + "\n")
    root = str(tmp_path / "s")
    run_load(spark, _fact_csv(str(tmp_path / "a.csv"), [(20250901, 1), (20250902, 1)]), pages, None, root,
             export=False)
    dup = _fact_csv(str(tmp_path / "b.csv"), [(20251001, 1), (20251001, 2)])      # same 4-column key twice
    r = run_load(spark, dup, pages, None, root, export=False, validate_scope="range")
    assert not r.quality.valid and r.quality.fact_duplicate_groups == 1 and r.quality.fact_rows == 2
    from portal_metrics.operators.quality import validate
    full = validate(StarStore(spark, root).model())
    assert full.valid == r.quality.valid and full.fact_duplicate_groups == 1 and full.fact_rows == 4


def test_load_job_command_line(spark, tmp_path, capsys):
    from portal_metrics.plans.load_job import main
    from portal_metrics.schemas import EMPLOYEE_SOURCE_NAMES, PAGE_COLUMNS
    fact = _fact_csv(str(tmp_path / "f.csv"), [(20251001, 1), (20251002, 2)])
    pages = _write(str(tmp_path / "p.csv"), ",".join(src for _, _, src in PAGE_COLUMNS) + "\n"
                   + ",".join(["s", "u", "b", "n", "f", "x", "p1"] + ["t"] * 13 + ["1"]) + "\n")
    emp = _write(str(tmp_path / "e.csv"), ",".join(f"employee_contact[{n}]" for n in EMPLOYEE_SOURCE_NAMES)
                 + "\n" + ",".join(["u1"] + ["v"] * 16) + "\n")
    out = str(tmp_path / "store")
    main(["--fact", fact, "--inventory", pages, "--employee", emp, "--out", out])
    printed = capsys.readouterr().out
    assert "table='fact'" in printed and "table='employee_contact'" in printed
    m = StarStore(spark, out).model()
    assert m.fact.count() == 2 and m.employee_contact.count() == 1
    assert os.path.exists(os.path.join(out, "export", "employee_contact.parquet"))
