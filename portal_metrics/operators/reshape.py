"""Sort / top-k / pivot / share operators (SRT-1..4, RSH-1..2, AGG-16..20).

All of them run on already-aggregated frames.  Top-k uses ``orderBy +
limit`` (planned as TakeOrderedAndProject: each task keeps k rows, the
driver merges k x tasks); top-k per group uses ``row_number <= k``, which
Spark plans with a partial WindowGroupLimit before the shuffle, so even a
hot group sends at most k rows per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def tie_break(keys) -> list[Column]:
    return [F.col(k).asc_nulls_last() if isinstance(k, str) else k for k in keys]


def top_k(df: DataFrame, order: list, tie_keys: list, k: int) -> DataFrame:
    """SRT-2: sort + LIMIT k with the group key as tie-breaker (M11)."""
    return df.orderBy(*_cols(order), *tie_break(tie_keys)).limit(k)


def tail(df: DataFrame, n: int, order_col: str) -> DataFrame:
    """SRT-3: the last n rows of a frame ordered by ``order_col``."""
    return df.orderBy(F.col(order_col).desc_nulls_first()).limit(n).orderBy(F.col(order_col).asc_nulls_last())


def top_k_per_group(df: DataFrame, group, order: list, k: int, tie_keys=(),
                    rank_col: str = "rank") -> DataFrame:
    """SRT-4: top k rows per group (row_number, ties broken by ``tie_keys``)."""
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*_cols(order), *tie_break(tie_keys))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def share_of_total(df: DataFrame, value: str, out: str = "share_pct", digits: int | None = 2) -> DataFrame:
    """AGG-19 / WIN-6: value as % of its column total.

    The total is a scalar subquery (one row, one value), so no row is
    moved to a single task and nothing is joined pairwise.
    """
    total = df.select(F.sum(value).cast("double")).scalar()
    x = F.try_divide(F.col(value).cast("double") * F.lit(100.0), total)
    return df.withColumn(out, F.round(x, digits) if digits is not None else x)


def arg_extremes(df: DataFrame, value: str, label: str) -> DataFrame:
    """AGG-16/17: mean, min, max, sum of ``value`` and the label at min and
    at max (the smallest label on ties, like the first row of a sorted frame)."""
    v = F.col(value)
    return df.agg(
        F.avg(v).alias(f"mean_{value}"),
        F.min(v).alias(f"min_{value}"),
        F.max(v).alias(f"max_{value}"),
        F.sum(v).alias(f"sum_{value}"),
        F.min_by(F.col(label), F.struct(v, F.col(label))).alias(f"{label}_at_min"),
        F.min_by(F.col(label), F.struct(-v, F.col(label))).alias(f"{label}_at_max"),
    )


def pivot_matrix(df: DataFrame, index, columns: str, value: str, agg: str = "sum",
                 values=None, fill=0, total: str | None = None) -> DataFrame:
    """RSH-1/2: one row per ``index``, one column per value of ``columns``.

    ``values`` fixes the column set; when None Spark finds the distinct
    values first (one small job over the aggregated input, sorted).
    Missing cells get ``fill``; ``total`` adds the row sum.
    """
    index = [index] if isinstance(index, str) else list(index)
    fn = {"sum": F.sum, "avg": F.avg, "mean": F.avg, "max": F.max, "min": F.min,
          "first": F.first}[agg]
    g = df.groupBy(*index)
    p = (g.pivot(columns, list(values)) if values is not None else g.pivot(columns)).agg(fn(value))
    cell_cols = [c for c in p.columns if c not in index]
    if fill is not None:
        p = p.fillna(fill, subset=cell_cols) if cell_cols else p
    if total and cell_cols:
        p = p.withColumn(total, reduce(lambda a, b: a + b, [F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in cell_cols]))
    return p
