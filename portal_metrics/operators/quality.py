"""Data-quality checks (VAL-1..7).

Keys are reported, never enforced (the reference warns and goes on).  All
checks are distributed aggregations; only their bounded results (top-10
lists, one-row counts) ever reach the driver, and only in ``validate``.
Orphan checks aggregate the fact by key *before* the anti join, so the
join sees one row per distinct key instead of every fact row.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FACT_KEY, PAGE_KEY


def duplicate_keys(df: DataFrame, keys, limit: int | None = 10) -> DataFrame:
    """VAL-1 / VAL-2: key groups seen more than once, most frequent first."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    d = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)
    d = d.orderBy(F.desc("cnt"), *[F.col(k).asc_nulls_last() for k in keys])
    return d.limit(limit) if limit else d


def key_stats(df: DataFrame, keys) -> DataFrame:
    """VAL-3 + VAL-4 in one two-level aggregation: distinct key tuples
    (NULLs are a value, as in SELECT DISTINCT), total rows and the number
    of key groups that occur more than once."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.count(F.lit(1)).alias("unique_keys"),
                 F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total_rows"),
                 F.count_if(F.col("_n") > 1).alias("duplicate_key_groups"))


def duplicate_key_count(df: DataFrame, keys) -> DataFrame:
    """VAL-3: number of duplicated key groups."""
    return key_stats(df, keys).select("duplicate_key_groups")


def unique_key_count(df: DataFrame, keys) -> DataFrame:
    """VAL-4: distinct key tuples vs total rows."""
    return key_stats(df, keys).select("unique_keys", "total_rows")


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None,
            rows_name: str = "orphaned_rows", keys_name: str = "orphaned_keys") -> DataFrame:
    """VAL-5 / VAL-7: fact rows (and distinct keys) without a dimension row.

    NULL keys never match, so they count as orphan rows but not as keys
    (COUNT(DISTINCT) ignores NULL), like the SQL LEFT JOIN ... IS NULL form.
    """
    dim_key = dim_key or fact_key
    per_key = fact.groupBy(F.col(fact_key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    dk = dim.select(F.col(dim_key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    lost = per_key.join(dk, "_k", "left_anti")
    return lost.agg(F.count_distinct("_k").alias(keys_name),
                    F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias(rows_name))


def unmatched_visitors(fact: DataFrame, employees: DataFrame) -> DataFrame:
    """VAL-7: fact visitors missing from employee_contact (NULL ids excluded)."""
    f = fact.where(F.col("viewingcontactid").isNotNull())
    return orphans(f, employees, "viewingcontactid", "contactid",
                   rows_name="unmatched_rows", keys_name="unmatched_visitors")


def day_range_fact(model, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """The fact restricted to a day range (and its visit months, so the
    stored table is partition-pruned); the whole fact when no range."""
    from ..functions.filters import Filters
    if lo is None or hi is None:
        return model.fact
    return Filters(date_from=lo, date_to=hi).apply(model.fact)


def quality_summary(model, fact: DataFrame | None = None) -> DataFrame:
    """VAL-6 as one lazy row: duplicates, unique keys, orphans and the verdict
    (valid iff no duplicate page id and no duplicate fact key)."""
    pages = key_stats(model.page_inventory, PAGE_KEY)
    fact = model.fact if fact is None else fact
    facts = key_stats(fact, FACT_KEY)
    orph = orphans(fact, model.page_inventory, "marketingpageid")
    row = facts.select(
        F.col("duplicate_key_groups").alias("fact_duplicate_keys"),
        F.col("unique_keys").alias("fact_unique_keys"),
        F.col("total_rows").alias("fact_rows"))
    row = (row.withColumn("page_duplicate_ids", pages.select("duplicate_key_groups").scalar())
              .withColumn("page_unique_ids", pages.select("unique_keys").scalar())
              .withColumn("orphaned_keys", orph.select("orphaned_keys").scalar())
              .withColumn("orphaned_rows", orph.select("orphaned_rows").scalar()))
    return row.withColumn("valid", (F.col("page_duplicate_ids") == 0) & (F.col("fact_duplicate_keys") == 0))


@dataclasses.dataclass
class QualityReport:
    valid: bool
    page_duplicates: list
    fact_duplicates: list
    fact_duplicate_groups: int
    fact_unique_keys: int
    fact_rows: int
    orphaned_keys: int
    orphaned_rows: int
    unmatched_visitors: int | None = None

    def lines(self) -> list[str]:
        out = []
        if self.page_duplicates:
            out.append(f"page ids stored more than once: {len(self.page_duplicates)} shown")
            out += [f"  {r[0]}: {r[1]} rows" for r in self.page_duplicates]
        if self.fact_duplicates:
            out.append(f"page views: {self.fact_duplicate_groups:,} duplicate composite keys")
            out += [f"  {tuple(r[:-1])} -> {r[-1]} rows" for r in self.fact_duplicates[:5]]
        else:
            out.append(f"page views: no duplicates among {self.fact_rows:,} rows "
                       f"({self.fact_unique_keys:,} keys)")
        if self.orphaned_keys:
            out.append(f"page views without a page: {self.orphaned_rows:,} rows "
                       f"of {self.orphaned_keys:,} pages")
        return out


def validate(model, day_range: tuple | None = None) -> QualityReport:
    """VAL-6: run the checks; only bounded results are collected.

    ``day_range`` (lo, hi) restricts the fact checks to those days.  The
    fact key contains the day, so every duplicate group lies wholly inside
    or outside a day range: after a range-replace load into a store that
    was valid, checking the replaced range gives the same duplicate verdict
    as checking the whole table, at the cost of the extract's months only.
    Orphan and unmatched counts are then those of the range."""
    fact = day_range_fact(model, *(day_range or (None, None)))
    s = quality_summary(model, fact).first()
    pd_ = [tuple(r) for r in duplicate_keys(model.page_inventory, PAGE_KEY, 10).collect()]
    fd = [tuple(r) for r in duplicate_keys(fact, FACT_KEY, 10).collect()]
    un = None
    if model.employee_contact is not None:
        un = unmatched_visitors(fact, model.employee_contact).first()["unmatched_visitors"]
    return QualityReport(valid=bool(s["valid"]), page_duplicates=pd_, fact_duplicates=fd,
                         fact_duplicate_groups=s["fact_duplicate_keys"], fact_unique_keys=s["fact_unique_keys"],
                         fact_rows=s["fact_rows"], orphaned_keys=s["orphaned_keys"],
                         orphaned_rows=s["orphaned_rows"], unmatched_visitors=un)


def validate_store(store, day_range: tuple | None = None) -> QualityReport:
    """VAL-6 for a store, by month: keys are counted only in months that have no counts of their present rows
    (``StarStore.check_months``), the rest is summed, so the duplicate verdict, rows and unique keys are those
    of the whole fact.  Duplicates are listed from the months that have some.  Orphan and unmatched counts are those of ``day_range``
    (the whole fact without one)."""
    counts = store.check_months()
    model = store.model()
    pages = key_stats(model.page_inventory, PAGE_KEY).first()
    pd_ = [tuple(r) for r in duplicate_keys(model.page_inventory, PAGE_KEY, 10).collect()] if pages["duplicate_key_groups"] else []
    doubled = store.months([m for m, c in counts.items() if c["duplicates"]])
    fd = [tuple(r) for r in duplicate_keys(doubled, FACT_KEY, 10).collect()]
    fact = day_range_fact(model, *(day_range or (None, None)))
    orph = orphans(fact, model.page_inventory, "marketingpageid").first()
    un = unmatched_visitors(fact, model.employee_contact).first()["unmatched_visitors"] if model.employee_contact is not None else None
    total = {k: sum(c[k] for c in counts.values()) for k in ("rows", "keys", "duplicates")}
    return QualityReport(valid=not total["duplicates"] and not pages["duplicate_key_groups"], page_duplicates=pd_, fact_duplicates=fd,
                         fact_duplicate_groups=total["duplicates"], fact_unique_keys=total["keys"], fact_rows=total["rows"],
                         orphaned_keys=orph["orphaned_keys"], orphaned_rows=orph["orphaned_rows"], unmatched_visitors=un)
