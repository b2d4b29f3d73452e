"""Driver contract: entry() and every registered query run; oracle spot checks."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "unique_visitors" in df.columns


def test_every_query_runs_and_has_unique_columns(spark):
    qs = E.queries()
    assert len(qs) >= 100
    for name, fn in qs.items():
        df = fn(spark, SF_SMALL)
        assert len(set(df.columns)) == len(df.columns), name
        df.limit(1).collect()


def test_oracle_keys_are_registered():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["qry04_monthly_uv", "qry25_top_visitors", "mea14_reach_trend_6m",
                                  "mea15_17_homepage_article_ctr",
                                  "dsh11_gap_matrix", "ask18_next_page", "val6_quality_summary"])
def test_oracle_spot(spark, name):
    import sys, os
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from oracle_check import TABLES, compare
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    err = compare([tuple(r) for r in df.collect()], df.columns, res.fetchall(), [d[0] for d in res.description])
    assert err is None, err


def test_oracle_column_types_match(spark):
    """Spark and DuckDB agree on every column's type, not only its values."""
    m = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
         "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
              "labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sqls = E.oracle_sql()
    bad = []
    for name, fn in E.queries().items():
        if name not in sqls:
            continue
        st = {f.name: f.dataType.simpleString() for f in fn(spark, SF_SMALL).schema.fields}
        rel = con.sql(sqls[name])
        for c, t in zip(rel.columns, rel.types):
            if m.get(str(t), str(t)) != st.get(c):
                bad.append((name, c, st.get(c), str(t)))
    assert not bad, bad[:10]
