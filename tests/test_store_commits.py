"""Versioned store, batch ledger of the streams, month counts and set-aside records."""
import json
import os

import pytest
from pyspark.sql import functions as F

from portal_metrics.operators.quality import validate, validate_store
from portal_metrics.plans.load_job import run_load
from portal_metrics.schemas import EMPLOYEE_SOURCE_NAMES, FACT_SCHEMA, PAGE_COLUMNS, PAGE_SCHEMA
from portal_metrics.sources import store as store_module
from portal_metrics.sources.store import Conflict, StarStore
from portal_metrics.streaming import extracts
from tests.test_merge_store import FACT_HEADER, _f, _fact_csv, _write

PAGE_HEADER = ",".join(src for _, _, src in PAGE_COLUMNS)


def rows_of(df):
    return sorted((r["visitdatekey"] or 0, r["views"]) for r in df.select("visitdatekey", "views").collect())


def fact(spark, days, **kw):
    return spark.createDataFrame([_f(d, **kw) for d in days], FACT_SCHEMA)


def page_line(pid, name="n"):
    return ",".join(["s", "u", "b", name, "f", "x", pid] + ["t"] * 13 + ["1"])


class Crash(Exception):
    pass


@pytest.mark.parametrize("at", ["_publish", "_write_months"])
def test_a_crash_leaves_the_old_table(spark, tmp_path, monkeypatch, at):
    s = StarStore(spark, str(tmp_path / "s"))
    s.full_refresh_fact(fact(spark, [20251001, 20251101, None]))
    s.write_dimension("page_inventory", spark.createDataFrame([], PAGE_SCHEMA))
    before, state = rows_of(s.fact()), s.state()
    real = getattr(StarStore, at)

    def broken(self, *a):
        if at == "_write_months":
            real(self, *a)          # the files are there, the load dies before it goes on
        raise Crash

    monkeypatch.setattr(StarStore, at, broken)
    for load in (lambda: s.full_refresh_fact(fact(spark, [20240101])), lambda: s.replace_fact_range(fact(spark, [20251001], views=9), 20251001, 20251031),
                 *([lambda: s.write_dimension("page_inventory", spark.createDataFrame([], PAGE_SCHEMA))] if at == "_publish" else [])):
        with pytest.raises(Crash):
            load()
        assert rows_of(StarStore(spark, s.root).fact()) == before and s.state() == state
    monkeypatch.setattr(StarStore, at, real)
    s.replace_fact_range(fact(spark, [20251001], views=9), 20251001, 20251031)
    assert rows_of(s.fact()) == [(0, 1), (20251001, 9), (20251101, 1)]


def test_readers_keep_their_version(spark, tmp_path):
    s = StarStore(spark, str(tmp_path / "s"))
    s.full_refresh_fact(fact(spark, [20251001, 20251101]))
    old = s.fact()
    s.replace_fact_range(fact(spark, [20251001], views=5), 20251001, 20251001)
    assert rows_of(old) == [(20251001, 1), (20251101, 1)] and rows_of(s.fact()) == [(20251001, 5), (20251101, 1)]
    generations = s.state()["fact"]
    assert generations["202511"] < generations["202510"]          # the other month was not written again


def test_two_loads_of_a_month_conflict_and_others_do_not(spark, tmp_path, monkeypatch):
    s = StarStore(spark, str(tmp_path / "s"))
    s.full_refresh_fact(fact(spark, [20251001, 20251101]))
    real = StarStore._write_months

    def meanwhile(days):
        def write(self, rows):
            monkeypatch.setattr(StarStore, "_write_months", real)
            out = real(self, rows)
            StarStore(spark, s.root).replace_fact_range(fact(spark, days, views=7), days[0], days[-1])
            return out
        return write

    monkeypatch.setattr(StarStore, "_write_months", meanwhile([20251101]))
    s.replace_fact_range(fact(spark, [20251001], views=3), 20251001, 20251001)
    assert rows_of(s.fact()) == [(20251001, 3), (20251101, 7)]
    monkeypatch.setattr(StarStore, "_write_months", meanwhile([20251001]))
    with pytest.raises(Conflict):
        s.replace_fact_range(fact(spark, [20251001], views=4), 20251001, 20251001)
    assert rows_of(s.fact()) == [(20251001, 7), (20251101, 7)]


def test_vacuum_removes_what_no_recent_commit_names(spark, tmp_path):
    s = StarStore(spark, str(tmp_path / "s"))
    for v in range(3):
        s.full_refresh_fact(fact(spark, [20251001, 20251101], views=v))
        s.write_dimension("page_inventory", spark.createDataFrame([], PAGE_SCHEMA))
    s.replace_fact_range(fact(spark, [20251001], views=8), 20251001, 20251001)
    gone = s.vacuum(keep=1)
    assert rows_of(s.fact()) == [(20251001, 8), (20251101, 2)] and len(s._commit_numbers()) == 1
    assert sorted(os.listdir(f"{s.root}/fact")) == ["g=000003", "g=000004"] and os.listdir(f"{s.root}/page_inventory") == ["v=000003"]
    assert f"{s.root}/fact/g=000003/visit_month=202510" in gone
    s.full_refresh_fact(fact(spark, [20260101]))
    assert rows_of(s.fact()) == [(20260101, 1)]


def test_unique_page_ids_are_recorded_and_drop_the_unread_join(spark, tmp_path, star):
    from portal_metrics.plans import reports
    s = StarStore(spark, str(tmp_path / "s"))
    s.full_refresh_fact(star.fact)
    pages = star.page_inventory
    for inventory, unique in ((pages, True), (pages.unionByName(pages.limit(1)), False)):
        s.write_dimension("page_inventory", inventory)
        assert s.state()["unique"] == {"page_inventory": unique}
        model = s.model()
        plan = reports.summary(model)._jdf.queryExecution().optimizedPlan().toString()
        assert ("LeftOuter" not in plan) == unique
        assert model.page_inventory.count() == inventory.count()
        want = star if unique else type(star)(star.fact, inventory, star.dim_date, star.employee_contact)
        assert reports.summary(model).first() == reports.summary(want).first()


# ------------------------------------------------------------------ STR-1
def run(spark, fn, drop, store, ck):
    q = fn(spark, str(drop), store, checkpoint=str(ck))
    q.awaitTermination(180)
    assert q.exception() is None


@pytest.fixture
def drops(tmp_path):
    out = {}
    for name in ("fact", "pages", "employees"):
        out[name] = tmp_path / name
        out[name].mkdir()
    _write(str(out["fact"] / "a.csv"), FACT_HEADER + "\n20251001,Email,p1,4,u1,F,1,1.5,1.5,0,p1\n,Email,p1,2,u2,F,1,1.5,1.5,0,\n")
    _write(str(out["pages"] / "a.csv"), "\n".join([PAGE_HEADER, page_line("p1"), page_line("Unknown"), page_line("p2", '"two\nlines, ""q"""')]) + "\n")
    _write(str(out["employees"] / "a.csv"), ",".join(EMPLOYEE_SOURCE_NAMES) + "\n" + ",".join(["u1"] + ["v"] * 16) + "\n")
    return out


STREAMS = {"fact": extracts.stream_fact_extracts, "pages": extracts.stream_page_extracts, "employees": extracts.stream_employee_extracts}


def test_streams_of_all_tables_merge_each_extract_once(spark, tmp_path, drops):
    s = StarStore(spark, str(tmp_path / "s"))
    for name, fn in STREAMS.items():
        for _ in range(2):
            run(spark, fn, drops[name], s, tmp_path / f"ck-{name}")
    assert rows_of(s.fact()) == [(0, 2), (20251001, 4)]
    assert {r["marketingpageid"]: r["pagename"] for r in s.pages().collect()} == {"p1": "n", "p2": 'two\nlines, "q"'} and s.employees().count() == 1
    _write(str(drops["pages"] / "b.csv"), PAGE_HEADER + "\n" + page_line("p1", "new") + "\n")
    run(spark, STREAMS["pages"], drops["pages"], s, tmp_path / "ck-pages")
    assert {r["marketingpageid"]: r["pagename"] for r in s.pages().collect()}["p1"] == "new" and s.pages().count() == 2


@pytest.mark.parametrize("name", list(STREAMS))
def test_a_batch_replayed_after_a_crash_changes_nothing(spark, tmp_path, drops, name):
    """The stream dies after the store's commit and before its own: Spark runs the batch again."""
    s, ck = StarStore(spark, str(tmp_path / "s")), tmp_path / "ck"
    run(spark, STREAMS[name], drops[name], s, ck)
    state = s.state()
    assert list(state["applied"].values())[0][0] == 0
    os.remove(ck / "commits" / "0")
    if os.path.exists(ck / "commits" / ".0.crc"):
        os.remove(ck / "commits" / ".0.crc")
    run(spark, STREAMS[name], drops[name], s, ck)
    assert s.state() == state and json.loads((ck / "metadata").read_text())["id"] in list(state["applied"])[0]


def test_a_new_checkpoint_is_a_new_stream(spark, tmp_path, drops):
    s = StarStore(spark, str(tmp_path / "s"))
    run(spark, STREAMS["fact"], drops["fact"], s, tmp_path / "ck1")
    run(spark, STREAMS["fact"], drops["fact"], s, tmp_path / "ck2")
    assert rows_of(s.fact()) == [(0, 2), (0, 2), (20251001, 4)] and len(s.state()["applied"]) == 2


# ------------------------------------------------------------- VAL-2, VAL-6
def test_month_counts_give_the_whole_verdict(spark, tmp_path, monkeypatch):
    s = StarStore(spark, str(tmp_path / "s"))
    s.full_refresh_fact(fact(spark, [20251001, 20251101, 20251101, 20251201, None, None]))
    s.write_dimension("page_inventory", spark.createDataFrame([], PAGE_SCHEMA))
    read = []
    real = StarStore._months
    monkeypatch.setattr(StarStore, "_months", lambda self, months: (read.append(set(months)), real(self, months))[1])

    def same():
        full, by_month = validate(s.model()), validate_store(s)
        assert (full.valid, full.fact_duplicate_groups, full.fact_unique_keys, full.fact_rows, full.fact_duplicates, full.orphaned_rows) == (
            by_month.valid, by_month.fact_duplicate_groups, by_month.fact_unique_keys, by_month.fact_rows, by_month.fact_duplicates, by_month.orphaned_rows)
        return by_month

    assert same().fact_duplicate_groups == 2
    s.replace_fact_range(fact(spark, [20251102, 20251103]), 20251101, 20251130)
    read.clear()
    s.check_months()
    assert read == [{"202511", store_module.NO_MONTH}]
    read.clear()
    s.check_months()
    assert read == []
    assert same().fact_duplicate_groups == 1


def test_load_job_checks_by_month(spark, tmp_path):
    pages = _write(str(tmp_path / "p.csv"), PAGE_HEADER + "\n" + page_line("p1") + "\n")
    root = str(tmp_path / "s")
    run_load(spark, _fact_csv(str(tmp_path / "a.csv"), [(20250901, 1), (20250902, 1)]), pages, None, root, export=False, validate_scope="months")
    r = run_load(spark, _fact_csv(str(tmp_path / "b.csv"), [(20251001, 1), (20251001, 2)]), pages, None, root, export=False, validate_scope="months")
    assert not r.quality.valid and r.quality.fact_rows == 4 and r.quality.fact_duplicate_groups == 1 and set(StarStore(spark, root).state()["checked"]) == {"202509", "202510"}


# ------------------------------------------------------------------- SRC-1..3
def test_records_of_another_width_are_set_aside_and_counted(spark, tmp_path):
    good = "20251001,Email,p1,4,u1,F,1,1.5,1.5,0,p1"
    f = _write(str(tmp_path / "f.csv"), "\n".join([FACT_HEADER, good, "20251002,Email,p1", good + ",extra,fields", "20251003,Email,p1,x,u1,F,1,1.5,1.5,0,", ""]))
    p = _write(str(tmp_path / "p.csv"), "\n".join([PAGE_HEADER, page_line("p1", '"a\nb, c"'), "short,row", page_line("p2")]) + "\n")
    e = _write(str(tmp_path / "e.csv"), "\n".join([",".join(EMPLOYEE_SOURCE_NAMES), ",".join(["u1"] + ["v"] * 16), ",".join(["u2"] + ["v"] * 20)]) + "\n")
    r = run_load(spark, f, p, e, str(tmp_path / "s"), export=False)
    assert [(a.table, a.rows_after, a.rejected_rows) for a in r.audits] == [("fact", 2, 2), ("page_inventory", 2, 1), ("employee_contact", 1, 1)]
    s = StarStore(spark, str(tmp_path / "s"))
    assert rows_of(s.fact().where(F.col("views").isNotNull())) == [(20251001, 4)]          # a wrong number is NULL, the record stays
    aside = spark.read.parquet(f"{s.root}/_rejected/fact/*").collect()
    assert sorted(x[0] for x in aside) == sorted(["20251002,Email,p1", good + ",extra,fields"])
