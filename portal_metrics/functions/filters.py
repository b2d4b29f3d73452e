"""The common filter set (FIL-1..13) as Column predicates.

The reference pasted user text into SQL ``LIKE '%x%'``; here every text
filter is a literal, case-insensitive ``contains`` on a Column, so there
is no quoting and no wildcard surprise.  Day-key bounds stay plain long
comparisons so they reach the Parquet scan as pushed filters, and on a
stored fact they also become ``visit_month`` partition bounds.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DATE_COLUMNS, EMPLOYEE_COLUMNS, FACT_COLUMNS, FACT_PARTITION, PAGE_COLUMNS
from .calendar import calendar_columns
from .metrics import contains_ci

_PAGE_COLS = {n for n, _, _ in PAGE_COLUMNS} - {"marketingpageid"}
_EMP_COLS = {n for n, _, _ in EMPLOYEE_COLUMNS}
_FACT_COLS = {n for n, _, _ in FACT_COLUMNS}
_CALENDAR = [n for n, _ in DATE_COLUMNS]
#: Calendar columns that are the same on all days of a month.
_OF_MONTH = {"year", "quarter", "quarter_name", "year_quarter", "month", "month_name", "month_short", "year_month"}


def _calendar_of(day: Column) -> dict[str, Column]:
    """The calendar columns of a day, by name."""
    return dict(zip(_CALENDAR, calendar_columns(day), strict=True))


def _key_range(column: str, value) -> tuple[int, int] | None:
    """First and last day key of a named year, quarter, month or day; None for columns that recur."""
    if column in ("date", "datekey"):
        k = to_daykey(value)
        return k, k
    if column == "year":
        return int(value) * 10000 + 101, int(value) * 10000 + 1231
    if column == "year_month":
        k = int(str(value).replace("-", "")) * 100
        return k + 1, k + 31
    if column == "year_quarter":
        quarter, year = str(value).lstrip("Q").split()
        k = int(year) * 10000 + (3 * int(quarter) - 2) * 100
        return k + 1, k + 231
    return None


def to_daykey(x) -> int | None:
    """Day key yyyymmdd from an int, 'yyyymmdd', 'yyyy-mm-dd' or a date."""
    if x is None or x == "":
        return None
    if isinstance(x, _dt.datetime):
        x = x.date()
    if isinstance(x, _dt.date):
        return x.year * 10000 + x.month * 100 + x.day
    if isinstance(x, int):
        return x
    s = str(x).strip()
    if "-" in s:
        d = _dt.date.fromisoformat(s)
        return d.year * 10000 + d.month * 100 + d.day
    return int(s)


def daykey_to_date(k: int) -> _dt.date:
    return _dt.date(k // 10000, (k // 100) % 100, k % 100)


@dataclasses.dataclass(frozen=True)
class Filters:
    """AND of the active filters; None or '' means inactive (FIL-1)."""

    date_from: object = None          # FIL-2
    date_to: object = None            # FIL-2
    website: str | None = None        # FIL-3: websitename contains
    page_url: str | None = None       # FIL-4: fullpageurl contains
    page_name: str | None = None      # FIL-5: pagename contains
    equals: tuple = ()                # FIL-6: ((column, (v1, v2, ...)), ...)

    def __post_init__(self):
        eq = self.equals
        if isinstance(eq, dict):
            eq = tuple((k, tuple(v) if isinstance(v, (list, tuple, set)) else (v,))
                       for k, v in sorted(eq.items()))
            object.__setattr__(self, "equals", eq)

    # ---------------------------------------------------------------- helpers
    def replace(self, **kw) -> "Filters":
        if "equals" in kw and isinstance(kw["equals"], dict):
            merged = dict(self.equals)
            merged.update(kw["equals"])
            kw["equals"] = merged
        return dataclasses.replace(self, **kw)

    @property
    def day_from(self) -> int | None:
        return to_daykey(self.date_from)

    @property
    def day_to(self) -> int | None:
        return to_daykey(self.date_to)

    def columns(self) -> set[str]:
        cols = set()
        if self.day_from is not None or self.day_to is not None:
            cols.add("visitdatekey")
        if self.website:
            cols.add("websitename")
        if self.page_url:
            cols.add("fullpageurl")
        if self.page_name:
            cols.add("pagename")
        cols.update(k for k, _ in self.equals)
        return cols

    def uses_page(self) -> bool:
        return bool(self.columns() & _PAGE_COLS)

    def uses_employee(self) -> bool:
        return bool(self.columns() & _EMP_COLS)

    # --------------------------------------------------------------- calendar
    def calendar_predicate(self, columns=None) -> Column | None:
        """FIL-6 on calendar columns, compiled to the fact's day key: no calendar is joined.

        A calendar column is a function of the day, so its condition is put on the day that the key names (a key
        that is no day meets none).  Conditions that name whole years, quarters, months or days also become day-key
        ranges, which reach the scan, and those that hold for whole months a condition on the month partition."""
        named = [(k, v) for k, v in self.equals if k in _CALENDAR]
        if not named:
            return None
        of_day = _calendar_of(F.try_to_date(F.col("visitdatekey").cast("string"), "yyyyMMdd"))
        conds = []
        for k, vals in named:
            runs = [r for r in (_key_range(k, v) for v in vals) if r]
            if len(runs) == len(vals):
                conds.append(reduce(lambda a, b: a | b, [F.col("visitdatekey").between(lo, hi) for lo, hi in runs]))
            conds.append(of_day[k].isin(list(vals)))
            if columns is not None and FACT_PARTITION in columns and k in _OF_MONTH:
                first = F.try_to_date(F.concat(F.col(FACT_PARTITION).cast("string"), F.lit("01")), "yyyyMMdd")
                conds.append(_calendar_of(first)[k].isin(list(vals)))
        return reduce(lambda a, b: a & b, conds)

    # -------------------------------------------------------------- predicate
    def fact_predicate(self, columns=None) -> Column | None:
        """Only the parts that touch fact columns (safe to apply pre-join)."""
        conds = []
        lo, hi = self.day_from, self.day_to
        if lo is not None:
            conds.append(F.col("visitdatekey") >= F.lit(lo))
        if hi is not None:
            conds.append(F.col("visitdatekey") <= F.lit(hi))
        if columns is not None and FACT_PARTITION in columns:
            if lo is not None:
                conds.append(F.col(FACT_PARTITION) >= F.lit(lo // 100))
            if hi is not None:
                conds.append(F.col(FACT_PARTITION) <= F.lit(hi // 100))
        for k, vals in self.equals:
            if k in _FACT_COLS:
                conds.append(F.col(k).isin(list(vals)))
        cal = self.calendar_predicate(columns)
        if cal is not None:
            conds.append(cal)
        return reduce(lambda a, b: a & b, conds) if conds else None

    def predicate(self, columns=None) -> Column | None:
        conds = []
        fp = self.fact_predicate(columns)
        if fp is not None:
            conds.append(fp)
        if self.website:
            conds.append(contains_ci("websitename", self.website))
        if self.page_url:
            conds.append(contains_ci("fullpageurl", self.page_url))
        if self.page_name:
            conds.append(contains_ci("pagename", self.page_name))
        for k, vals in self.equals:
            if k not in _FACT_COLS and k not in _CALENDAR:
                conds.append(F.col(k).isin(list(vals)))
        return reduce(lambda a, b: a & b, conds) if conds else None

    def apply(self, df: DataFrame) -> DataFrame:
        p = self.predicate(df.columns)
        return df if p is None else df.filter(p)


NO_FILTERS = Filters()


# ------------------------------------------------------------ relative periods
def _month_add(d: _dt.date, n: int) -> _dt.date:
    m = d.month - 1 + n
    return _dt.date(d.year + m // 12, m % 12 + 1, 1)


def period_bounds(kind: str, as_of, n: int | None = None, value: str | None = None):
    """(first_day, last_day) of a named period relative to ``as_of`` (FIL-7..12).

    ``last_day`` is None for 'last_n_days' (the source has no upper bound).
    """
    a = daykey_to_date(to_daykey(as_of))
    if kind == "today":
        return a, a
    if kind in ("this_week", "last_week"):
        mon = a - _dt.timedelta(days=a.weekday())
        if kind == "last_week":
            mon -= _dt.timedelta(days=7)
        return mon, mon + _dt.timedelta(days=6)
    if kind in ("this_month", "last_month"):
        first = _dt.date(a.year, a.month, 1)
        if kind == "last_month":
            first = _month_add(first, -1)
        return first, _month_add(first, 1) - _dt.timedelta(days=1)
    if kind in ("this_quarter", "last_quarter"):
        first = _dt.date(a.year, 3 * ((a.month - 1) // 3) + 1, 1)
        if kind == "last_quarter":
            first = _month_add(first, -3)
        return first, _month_add(first, 3) - _dt.timedelta(days=1)
    if kind in ("this_year", "last_year"):
        y = a.year - (1 if kind == "last_year" else 0)
        return _dt.date(y, 1, 1), _dt.date(y, 12, 31)
    if kind == "last_n_days":
        return a - _dt.timedelta(days=n if n is not None else 30), None
    if kind == "month":                          # value 'YYYY-MM'
        y, m = (int(x) for x in value.split("-"))
        first = _dt.date(y, m, 1)
        return first, _month_add(first, 1) - _dt.timedelta(days=1)
    if kind == "quarter":                        # value 'Q3 2025' or 'Q3' (year of as_of)
        parts = value.split()
        q = int(parts[0].lstrip("Qq"))
        y = int(parts[1]) if len(parts) > 1 else a.year
        first = _dt.date(y, 3 * (q - 1) + 1, 1)
        return first, _month_add(first, 3) - _dt.timedelta(days=1)
    raise ValueError(f"unknown period {kind!r}")


def relative_period(kind: str, as_of, n: int | None = None, value: str | None = None,
                    base: Filters = NO_FILTERS) -> Filters:
    """``base`` with its date range replaced by a named period."""
    lo, hi = period_bounds(kind, as_of, n, value)
    return base.replace(date_from=to_daykey(lo), date_to=to_daykey(hi) if hi else None)
