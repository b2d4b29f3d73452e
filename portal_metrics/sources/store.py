"""Persistent star tables on Parquet (SNK-1, SNK-2, MRG-1..2 physical side).

Layout under ``root``::

    fact/g=000001/visit_month=YYYYMM/part-*.parquet   (a generation holds the months that one load wrote)
    page_inventory/v=000001/ ...                      (versioned)
    employee_contact/v=000001/ ...
    dim_date/v=000001/ ...
    _commits/000001.json                              (what a reader sees; written last, never changed)

A load writes whole months, or whole dimension versions, into new folders and then one small commit file that names, for each
month, its generation, for each dimension its version, the batches applied so far, the key counts of checked months, and
whether page ids are unique.
Readers take the newest commit.  A load that fails before its commit leaves nothing that a reader sees, and a commit that
another writer took first is tried again on the new state, or refused where both wrote the same months.  Folders that
no recent commit names are removed by ``vacuum``.
"""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import date_dim
from ..model import StarModel
from ..operators.merge import empty_table, upsert
from ..operators.quality import key_stats
from ..schemas import EMPLOYEE_SCHEMA, FACT_KEY, FACT_PARTITION, FACT_SCHEMA, PAGE_KEY, PAGE_SCHEMA

#: Folder name of rows without a month, and their key in a commit.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
_EMPTY = {"fact": {}, "versions": {}, "applied": {}, "checked": {}, "unique": {}}
#: Dimensions whose keys are checked when they are written.
_CHECKED_KEYS = {"page_inventory": PAGE_KEY}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _delete(spark, path) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _list_dirs(spark, path) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def with_visit_month(fact: DataFrame) -> DataFrame:
    return fact.withColumn(FACT_PARTITION, (F.col("visitdatekey") / 100).cast("long"))


def files_per_month(spark: SparkSession) -> int | None:
    v = spark.conf.get("portal_metrics.fact.filesPerMonth", None)
    return max(1, int(v)) if v else None


def _month_layout(df: DataFrame, k: int) -> DataFrame:
    """Cluster rows by visit month, each month split over ``k`` tasks by a
    deterministic hash of (visitor, page): a hot month becomes k files
    written in parallel, not one task, and a retried task rewrites the
    same rows (no random salt)."""
    salt = F.pmod(F.xxhash64("viewingcontactid", "marketingpageid", "visitdatekey"), F.lit(k))
    return df.repartition(F.col(FACT_PARTITION), salt)


def write_fact(df: DataFrame, path: str, k: int | None = None) -> None:
    """Months are written by as many tasks as their bytes ask for (AQE splits and joins rebalanced partitions),
    or by ``k`` where a number of files is set."""
    k = k or files_per_month(df.sparkSession)
    laid_out = _month_layout(df, k) if k else df.hint("rebalance", FACT_PARTITION)
    laid_out.write.mode("overwrite").partitionBy(FACT_PARTITION).parquet(path)


class Conflict(RuntimeError):
    """Another load committed the same months first."""


class StarStore:
    """The analytic tables kept between loads (SNK-2)."""

    _lock = threading.RLock()

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ------------------------------------------------------------ commits
    @property
    def fact_path(self) -> str:
        return f"{self.root}/fact"

    def _commit_numbers(self) -> list[int]:
        fs, p = _fs(self.spark, f"{self.root}/_commits")
        names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _read_commit(self, number: int) -> dict:
        fs, p = _fs(self.spark, f"{self.root}/_commits/{number:06d}.json")
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def state(self) -> dict:
        """The newest commit: {"fact": {month: generation}, "versions": {table: version}, "applied": {source: batch},
        "checked": {month: key counts}}."""
        n = self._commit_numbers()
        return self._read_commit(n[-1]) if n else json.loads(json.dumps(_EMPTY))

    def _publish(self, number: int, state: dict) -> bool:
        """Make ``state`` commit ``number``; False if that number is taken."""
        fs, final = _fs(self.spark, f"{self.root}/_commits/{number:06d}.json")
        _, temp = _fs(self.spark, f"{self.root}/_commits/_{number:06d}-{uuid.uuid4().hex}")
        out = fs.create(temp, False)
        out.write(json.dumps(state, sort_keys=True).encode())
        out.close()
        if not fs.exists(final) and fs.rename(temp, final):
            return True
        fs.delete(temp, False)
        return False

    def _commit(self, change) -> None:
        """Publish the newest state as ``change`` leaves it."""
        with self._lock:
            while True:
                n = self._commit_numbers()
                state = self.state()
                change(state)
                if self._publish((n[-1] if n else 0) + 1, state):
                    return

    # ------------------------------------------------------------ reads
    def _months(self, months: dict[str, int]) -> DataFrame:
        """The fact rows of {month: generation}."""
        if not months:
            return with_visit_month(empty_table(self.spark, FACT_SCHEMA))
        paths = [f"{self.fact_path}/g={g:06d}/{FACT_PARTITION}={m}" for m, g in sorted(months.items())]
        schema = T.StructType([*FACT_SCHEMA.fields, T.StructField(FACT_PARTITION, T.LongType()), T.StructField("g", T.LongType())])
        return self.spark.read.schema(schema).option("basePath", self.fact_path).parquet(*paths).drop("g")

    def fact(self) -> DataFrame:
        return self._months(self.state()["fact"])

    def months(self, months: list[str]) -> DataFrame:
        """The fact rows of some months, by their keys in a commit."""
        fact = self.state()["fact"]
        return self._months({m: fact[m] for m in months})

    def dimension(self, name: str, schema) -> DataFrame | None:
        v = self.state()["versions"].get(name)
        return self.spark.read.parquet(f"{self.root}/{name}/v={v:06d}") if v else None

    def pages(self) -> DataFrame:
        p = self.dimension("page_inventory", PAGE_SCHEMA)
        return p if p is not None else empty_table(self.spark, PAGE_SCHEMA)

    def employees(self) -> DataFrame | None:
        return self.dimension("employee_contact", EMPLOYEE_SCHEMA)

    def model(self) -> StarModel:
        """The star; page ids that were unique when they were written let Spark drop the page join of reports that read no page
        column (``StarModel.with_unique_page_keys``)."""
        dates = self.dimension("dim_date", None)
        pages = self.pages().dropDuplicates(PAGE_KEY) if self.state().get("unique", {}).get("page_inventory") else self.pages()
        return StarModel(self.fact(), pages, dates if dates is not None else date_dim(self.spark), self.employees())

    # ------------------------------------------------------------ writes
    def _next_folder(self, name: str, letter: str) -> int:
        """A number that no folder has, left-overs of failed loads included."""
        return max([int(d[2:]) for d in _list_dirs(self.spark, f"{self.root}/{name}") if d.startswith(f"{letter}=")], default=0) + 1

    def _write_months(self, rows: DataFrame) -> tuple[int, list[str]]:
        """A new generation with these rows: its number and months."""
        with self._lock:
            g = self._next_folder("fact", "g")
            fs, p = _fs(self.spark, f"{self.fact_path}/g={g:06d}")
            fs.mkdirs(p)
        write_fact(rows, f"{self.fact_path}/g={g:06d}")
        prefix = f"{FACT_PARTITION}="
        return g, [d[len(prefix):] for d in _list_dirs(self.spark, f"{self.fact_path}/g={g:06d}") if d.startswith(prefix)]

    @staticmethod
    def _apply(state: dict, batch: tuple | None) -> None:
        if batch is not None:
            source, number, digest = batch
            state["applied"][source] = [number, digest]

    def applied(self, source: str, number: int, digest: str) -> bool:
        """Whether this batch of a source is in the store: its number was committed, with this content or a later one."""
        last = self.state()["applied"].get(source)
        return last is not None and (number < last[0] or (number == last[0] and digest == last[1]))

    def write_dimension(self, name: str, df: DataFrame, batch: tuple | None = None) -> str:
        with self._lock:
            v = self._next_folder(name, "v")
            path = f"{self.root}/{name}/v={v:06d}"
            fs, p = _fs(self.spark, path)
            fs.mkdirs(p)
        df.write.mode("overwrite").parquet(path)
        unique = None
        if name in _CHECKED_KEYS:
            unique = not key_stats(self.spark.read.schema(df.schema).parquet(path), _CHECKED_KEYS[name]).first()["duplicate_key_groups"]

        def change(state):
            state["versions"][name] = v
            if unique is not None:
                state.setdefault("unique", {})[name] = unique
            self._apply(state, batch)

        self._commit(change)
        return path

    def write_calendar(self, dates: DataFrame) -> None:
        self.write_dimension("dim_date", dates)

    def full_refresh_fact(self, incoming: DataFrame, batch: tuple | None = None) -> None:
        """MRG-1 for the fact: the stored table becomes the extract."""
        g, months = self._write_months(with_visit_month(incoming))

        def change(state):
            state["fact"], state["checked"] = dict.fromkeys(months, g), {}
            self._apply(state, batch)

        self._commit(change)

    def replace_fact_range(self, incoming: DataFrame, lo: int, hi: int, batch: tuple | None = None) -> list[int]:
        """MRG-2 on storage: a new generation of the visit months lo//100 .. hi//100; ``batch`` (source, number,
        digest) is recorded with it.

        Rows without a day are kept and the extract's are added to them, as in the lazy form: a batch that is
        merged again adds them again unless it is known by its record.  Returns the months that ended up empty."""
        old = self.state()["fact"]
        touched = {m: g for m, g in old.items() if m == NO_MONTH or lo // 100 <= int(m) <= hi // 100}
        cur = self._months(touched)
        keep = cur.where(F.col("visitdatekey").isNull() | ~F.col("visitdatekey").between(lo, hi))
        g, months = self._write_months(keep.unionByName(with_visit_month(incoming).select(*keep.columns)))

        def change(state):
            for m in {*touched, *months}:
                if state["fact"].get(m) != old.get(m):
                    raise Conflict(f"month {m} was committed by another load")
                state["fact"].pop(m, None)
                state["checked"].pop(m, None)
            state["fact"].update(dict.fromkeys(months, g))
            self._apply(state, batch)

        self._commit(change)
        return sorted(int(m) for m in touched if m not in months and m != NO_MONTH)

    def upsert_dimension(self, name: str, incoming: DataFrame, key: str, schema, batch: tuple | None = None) -> str:
        """MRG-3 / MRG-4 on storage: a new version = upsert(current, incoming)."""
        cur = self.dimension(name, schema)
        cur = cur if cur is not None else empty_table(self.spark, schema)
        return self.write_dimension(name, upsert(cur, incoming, key), batch)

    # ------------------------------------------------------------ upkeep
    def check_months(self) -> dict[str, dict]:
        """VAL-2..4 by month: {month: {"rows", "keys", "duplicates"}} of every month.  The fact key holds the day, so equal keys
        share a month; only months without counts of their present generation are read, and their counts are committed."""
        state = self.state()
        due = {m: g for m, g in state["fact"].items() if m not in state["checked"]}
        if due:
            per_key = self._months(due).groupBy(F.col(FACT_PARTITION).cast("string").alias("month"), *FACT_KEY).agg(F.count("*").alias("n"))
            counts = per_key.groupBy("month").agg(F.sum("n").alias("rows"), F.count("*").alias("keys"), F.count_if(F.col("n") > 1).alias("duplicates"))
            # a row a month
            found = {r["month"] or NO_MONTH: {"rows": r["rows"], "keys": r["keys"], "duplicates": r["duplicates"]} for r in counts.collect()}

            def change(state):
                state["checked"].update({m: c for m, c in found.items() if state["fact"].get(m) == due[m]})

            self._commit(change)
        checked = self.state()["checked"]
        return {m: checked[m] for m in state["fact"] if m in checked}

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove what none of the last ``keep`` commits names; the removed folders and commits.  Not to be run beside a load."""
        numbers = self._commit_numbers()
        states = [self._read_commit(n) for n in numbers[-keep:]]
        months = {(int(g), m) for s in states for m, g in s["fact"].items()}
        generations = {g for g, _ in months}
        gone = []
        for d in _list_dirs(self.spark, self.fact_path):
            g = int(d[2:])
            if g not in generations:
                gone.append(f"{self.fact_path}/{d}")
            else:
                gone += [f"{self.fact_path}/{d}/{m}" for m in _list_dirs(self.spark, f"{self.fact_path}/{d}")
                         if m.startswith(FACT_PARTITION) and (g, m.split("=", 1)[1]) not in months]
        for name in ("page_inventory", "employee_contact", "dim_date"):
            named = {s["versions"].get(name) for s in states}
            gone += [f"{self.root}/{name}/{d}" for d in _list_dirs(self.spark, f"{self.root}/{name}") if int(d[2:]) not in named]
        gone += [f"{self.root}/_commits/{n:06d}.json" for n in numbers[:-keep]]
        for path in gone:
            _delete(self.spark, path)
        return gone


def export_parquet(model: StarModel, out_dir: str) -> list[str]:
    """SNK-1: one Snappy Parquet dataset per table; employee only if present."""
    base = out_dir.rstrip("/")
    tables = [("fact", model.fact.drop(FACT_PARTITION) if FACT_PARTITION in model.fact.columns else model.fact),
              ("page_inventory", model.page_inventory), ("dim_date", model.dim_date)]
    if model.employee_contact is not None:
        tables.insert(2, ("employee_contact", model.employee_contact))
    written = []
    for name, df in tables:
        path = f"{base}/{name}.parquet"
        df.write.mode("overwrite").option("compression", "snappy").parquet(path)
        written.append(path)
    return written


def export_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """SNK-3: write a report as CSV (with header) or Parquet."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(fmt)


def materialize_star(model: StarModel, root: str) -> StarModel:
    """Write a star (e.g. one derived from other tables) as a store and
    return the model that reads it back: month-partitioned fact, versioned
    dimensions, calendar.  Cuts the lineage to the source tables.

    The four writes are independent Spark jobs and are submitted from
    driver threads so the small dimension writes overlap the fact write."""
    from concurrent.futures import ThreadPoolExecutor

    store = StarStore(model.spark, root)
    fact = model.fact.drop(FACT_PARTITION) if FACT_PARTITION in model.fact.columns else model.fact
    jobs = [lambda: store.full_refresh_fact(fact),
            lambda: store.write_dimension("page_inventory", model.page_inventory),
            lambda: store.write_calendar(model.dim_date)]
    if model.employee_contact is not None:
        jobs.append(lambda: store.write_dimension("employee_contact", model.employee_contact))
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        for fut in [pool.submit(j) for j in jobs]:
            fut.result()
    return store.model()
