"""Every registered query runs and equals its DuckDB oracle (sf0.001)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.oracle_check import TABLES, norm
from tests.conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["observation_date", "yield_2y", "yield_10y", "spread_2s10s", "hy_spread",
                          "vix", "stress_score", "curve_status", "stress_level"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def duck_type(dt) -> str:
    """Spark type -> the DuckDB type name it must equal."""
    from pyspark.sql import types as T
    simple = {T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.DoubleType: "DOUBLE",
              T.StringType: "VARCHAR", T.DateType: "DATE", T.BooleanType: "BOOLEAN"}
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    return simple.get(type(dt), dt.simpleString())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows, cols = df.collect(), df.columns
    if name not in ORACLE:
        return
    rel = duck.execute(ORACLE[name])
    drows, dcols = rel.fetchall(), [d[0] for d in rel.description]
    assert sorted(cols) == sorted(dcols)
    dtypes = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {ORACLE[name]}").fetchall()}
    assert {f.name: duck_type(f.dataType) for f in df.schema.fields} == dtypes
    assert len(rows) == len(drows)
    so = sorted(range(len(cols)), key=lambda i: cols[i])
    do = sorted(range(len(dcols)), key=lambda i: dcols[i])
    assert sorted(tuple(norm(r[i]) for i in so) for r in rows) == \
        sorted(tuple(norm(r[i]) for i in do) for r in drows)
