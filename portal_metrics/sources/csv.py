"""CSV extract readers (SRC-1..5).

Columns are bound **by header name** (case-insensitive), as the
reference's ``SELECT fact_visitdatekey AS visitdatekey ...`` does -- a
declared CSV schema would bind by position and silently swap reordered
columns.  Every column is read as text and converted with ``try_cast``
to the declared type, so a dirty value becomes NULL instead of failing
the job (ANSI casts would raise).  An empty field, quoted or not, is NULL.

``read_checked`` also parts the records that do not have the header's
number of fields, whose values would be shifted or missing: the load
writes them to a side table and counts them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EMPLOYEE_COLUMNS, FACT_COLUMNS, PAGE_COLUMNS


def _raw(spark: SparkSession, path: str, infer: bool = False, multi_line: bool = False) -> DataFrame:
    """Quoted fields may hold commas and doubled quotes; with ``multi_line`` also line breaks
    (such a file is not split, so only the dimension files are read that way)."""
    r = (spark.read.option("header", True).option("mode", "PERMISSIVE")
         .option("quote", '"').option("escape", '"').option("multiLine", multi_line))
    if infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def _bind(raw: DataFrame, cols, aliases: dict | None = None, required: bool = True) -> DataFrame:
    """Select target columns by (case-insensitive) source header name."""
    by_lower = {c.lower(): c for c in raw.columns}
    out, missing = [], []
    for target, dtype, source in cols:
        cands = [source] + list((aliases or {}).get(target, []))
        hit = next((by_lower[c.lower()] for c in cands if c.lower() in by_lower), None)
        if hit is None:
            missing.append(source)
            out.append(F.lit(None).cast(dtype).alias(target))
        else:
            out.append(F.col(f"`{hit}`").try_cast(dtype).alias(target))
    if missing and required:
        raise ValueError(f"CSV is missing columns: {missing}")
    return raw.select(*out)


REJECT = "_rejected_record"


def read_checked(spark: SparkSession, path: str, cols, aliases: dict | None = None,
                 multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of a CSV extract: rejected holds the text of the records with another number of fields than the
    header, one column ``_rejected_record``."""
    header = _raw(spark, path, multi_line=multi_line).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header] + [T.StructField(REJECT, T.StringType())])
    # all columns are parsed, whatever is read later: fields are counted on whole records
    raw = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECT)
           .option("columnPruning", False).option("quote", '"').option("escape", '"').option("multiLine", multi_line).csv(path))
    rejected = raw.where(F.col(REJECT).isNotNull()).select(F.coalesce(REJECT, *[F.col(f"`{c}`") for c in header]).alias(REJECT))
    # Spark refuses queries that read nothing but the record column, as a count of the rows would
    whole = F.col(REJECT).isNull() & (F.length(F.coalesce(F.col(f"`{header[0]}`"), F.lit(""))) >= 0)
    return _bind(raw.where(whole), cols, aliases), rejected


def read_fact_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """SRC-1: the page-view fact extract (``fact_*`` headers)."""
    return _bind(_raw(spark, path, infer), FACT_COLUMNS)


def read_page_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """SRC-2: page inventory; rows with page id 'Unknown' or NULL are dropped
    (``!=`` is NULL-rejecting, as in SQL)."""
    return known_pages(_bind(_raw(spark, path, infer, multi_line=True), PAGE_COLUMNS))


def known_pages(pages: DataFrame) -> DataFrame:
    """Pages with an id other than 'Unknown'."""
    return pages.filter(F.col("marketingpageid") != F.lit("Unknown"))


_EMPLOYEE_ALIASES = {t: [src] for t, _, src in EMPLOYEE_COLUMNS}
_EMPLOYEE_SOURCE = [(t, d, f"employee_contact[{src}]") for t, d, src in EMPLOYEE_COLUMNS]


def read_employee_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """SRC-3: employee contacts; headers either ``employee_contact[X]`` or plain X."""
    return _bind(_raw(spark, path, infer, multi_line=True), _EMPLOYEE_SOURCE, _EMPLOYEE_ALIASES)


def read_checked_extract(spark: SparkSession, table: str, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of the extract of a table: fact, page_inventory or employee_contact."""
    if table == "fact":
        return read_checked(spark, path, FACT_COLUMNS)
    if table == "page_inventory":
        rows, rejected = read_checked(spark, path, PAGE_COLUMNS, multi_line=True)
        return known_pages(rows), rejected
    return read_checked(spark, path, _EMPLOYEE_SOURCE, _EMPLOYEE_ALIASES, multi_line=True)
