"""The star model: one fact and three dimensions held as lazy DataFrames.

``wide()`` is the single place where the star is joined (JOIN-1..5).  The
join types follow the reference exactly (page LEFT, calendar INNER,
employee LEFT) because they change results (rules M5..M8).

Join strategy, for 100 TB of fact rows:

* the calendar is generated from a date range, so its size is known
  before any job runs: it is always broadcast;
* page inventory and employee contacts are broadcast only when the
  optimizer's size estimate of the (pruned) side is under a limit
  (``bounded_broadcast``); beyond it the join stays a shuffle join and
  AQE may still demote it at runtime from measured stage sizes, and
  splits skewed partitions (a hot page or a NULL visitor).
"""

from __future__ import annotations

import dataclasses
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.filters import NO_FILTERS, Filters
from .schemas import FACT_PARTITION

DEFAULT_BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def plan_size_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a DataFrame's optimized plan (no job)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # pragma: no cover - e.g. Spark Connect
        return None


def byte_size(text: str) -> int:
    """Bytes of a Spark size setting: ``-1``, ``1024``, ``64MB``, ``10485760b``, ``1g``."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([kmgtp]?)i?b?\s*", text.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def broadcast_limit(spark: SparkSession) -> int:
    """Byte limit for an explicit broadcast; -1 when broadcasts are disabled."""
    if byte_size(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")) < 0:
        return -1
    v = spark.conf.get("portal_metrics.broadcast.maxBytes", None)
    return byte_size(v) if v else DEFAULT_BROADCAST_MAX_BYTES


def broadcast_inflation(spark: SparkSession) -> float:
    """Catalyst sizes a Parquet scan by its compressed file bytes; in memory
    the rows are several times larger, so the estimate is scaled up."""
    return float(spark.conf.get("portal_metrics.broadcast.inflation", None) or 4.0)


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """The size check behind every explicit broadcast."""
    spark = df.sparkSession
    limit = max_bytes if max_bytes is not None else broadcast_limit(spark)
    if limit < 0:
        return False
    size = plan_size_bytes(df)
    return size is not None and size * broadcast_inflation(spark) <= limit


def bounded_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Broadcast hint only when the size estimate is known and, inflated to
    in-memory size, under the limit.  Otherwise the join is left to the
    planner (shuffle join; AQE may still broadcast from measured sizes)."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


#: Input bytes of a task of the stages that aggregate the fact; fewest tasks that are set here, and most.
TASK_BYTES, LEAST_TASKS, MOST_TASKS = 8 * 1024 * 1024, 16, 4096


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of the tables that ``df`` reads (a join's own estimate is the product of its sides); None where one is unknown."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
        unknown = int(str(df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes()))
    except Exception:  # pragma: no cover - e.g. Spark Connect
        return None
    return None if any(x >= unknown for x in sizes) else sum(sizes)


def tasks_for(*dfs: DataFrame) -> int | None:
    """Tasks that read TASK_BYTES of the inputs each; None where AQE's own sizes do (small or unknown inputs).

    AQE joins shuffle partitions up to 64 MB of compressed rows; hash maps and sorts of a task hold ten to
    forty times that.  A number of partitions set by size keeps a task small at every size."""
    sizes = [input_bytes(x) for x in dfs]
    n = 0 if None in sizes else -(-sum(sizes) // TASK_BYTES)
    return min(n, MOST_TASKS) if n >= LEAST_TASKS else None


def dealt(df: DataFrame, n: int | None, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to ``n`` tasks.  The keys must tell (nearly) all rows apart, so no task gets many."""
    return df.repartition(n, *keys) if n else df


def joined_in_tasks(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner join of two tables by keys that no few values of dominate: a small right side is broadcast, large tables
    are joined in ``tasks_for`` tasks."""
    n = None if fits_broadcast(right) else tasks_for(left, right)
    left, right = dealt(left, n, left_key), dealt(right, n, right_key)
    return left.join(bounded_broadcast(right), left[left_key] == right[right_key], "inner")


@dataclasses.dataclass
class StarModel:
    fact: DataFrame
    page_inventory: DataFrame
    dim_date: DataFrame
    employee_contact: DataFrame | None = None

    @property
    def spark(self) -> SparkSession:
        return self.fact.sparkSession

    @property
    def has_employee(self) -> bool:          # SRC-7
        return self.employee_contact is not None

    # ------------------------------------------------------------------ joins
    def pages(self) -> DataFrame:
        return bounded_broadcast(self.page_inventory)

    def calendar(self) -> DataFrame:
        # Size fixed by the generated range -> always safe to broadcast.
        return F.broadcast(self.dim_date)

    def employees(self) -> DataFrame:
        if self.employee_contact is None:
            raise ValueError("the model has no employee_contact table")
        return bounded_broadcast(self.employee_contact)

    def wide(self, filters: Filters | None = NO_FILTERS, page: str | None = "left",
             date: str | None = None, employee: str | None = None) -> DataFrame:
        """Fact joined to the requested dimensions, then filtered.

        Filters run after the joins, as in the reference: a filter on a page
        column drops orphan fact rows (M7).  Catalyst still pushes the
        fact-only parts (day range, partition bounds) down to the scan.
        """
        filters = filters or NO_FILTERS
        f = self.fact
        fp = filters.fact_predicate(f.columns)
        if fp is not None:
            f = f.filter(fp)
        if filters.uses_page() and page is None:
            page = "left"
        if filters.uses_employee() and employee is None:
            employee = "left"
        if page:
            f = f.join(self.pages(), "marketingpageid", page)
        if date:
            d = self.calendar()
            f = f.join(d, f["visitdatekey"] == d["datekey"], date)
        if employee:
            e = self.employees()
            f = f.join(e, f["viewingcontactid"] == e["contactid"], employee)
        p = filters.predicate(None)
        if p is not None:
            f = f.filter(p)
        return f

    # ---------------------------------------------------------------- storage
    @classmethod
    def from_parquet(cls, spark: SparkSession, path: str) -> "StarModel":
        """Read the four exported tables (SRC-6); employee is optional."""
        from .sources.optional import optional_parquet
        base = path.rstrip("/")
        fact = spark.read.parquet(f"{base}/fact.parquet")
        pages = spark.read.parquet(f"{base}/page_inventory.parquet")
        dates = spark.read.parquet(f"{base}/dim_date.parquet")
        emp = optional_parquet(spark, f"{base}/employee_contact.parquet")
        return cls(fact, pages, dates, emp)

    def with_unique_page_keys(self) -> "StarModel":
        """Declare page ids unique -- only after checking it (one aggregate
        over the page inventory, dimension-sized).

        The inventory is then expressed as ``dropDuplicates`` on its key,
        a no-op for unique keys that tells Catalyst the join side is
        distinct: reports that read no page column lose the page LEFT join
        entirely (outer-join elimination), the others keep it.  With
        duplicated ids the model is returned unchanged, so their fan-out
        (rule M8) is preserved and the quality report still shows them."""
        from .operators.quality import key_stats
        dup = key_stats(self.page_inventory, ["marketingpageid"]).first()["duplicate_key_groups"]
        if dup:
            return self
        return dataclasses.replace(self, page_inventory=self.page_inventory.dropDuplicates(["marketingpageid"]))

    def fact_columns(self) -> list[str]:
        return [c for c in self.fact.columns if c != FACT_PARTITION]
