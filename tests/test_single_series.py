"""The single-series form (``series=['DGS10']``) equals the source queries'
literal shape: one series selected by WHERE, windows ordered by date with no
PARTITION BY (DuckDB, sf0.01)."""

import duckdb
import pytest

from curvelake.operators import aggregates as A
from curvelake.operators import series as W
from curvelake.plans.oracle import BINDINGS
from scripts.oracle_check import norm
from tests.conftest import SF_CHECK

ONE = ["DGS10"]
D10 = "SELECT * FROM obs WHERE series_id = 'DGS10'"
AVG7 = ("CAST(SUM(value) OVER (ORDER BY observation_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE)"
        " / COUNT(value) OVER (ORDER BY observation_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)")

CASES = {
    "lag_change": (lambda o: W.lag_change(o, ONE).drop("series_id"), f"""
        SELECT observation_date, value, prev_value, value - prev_value AS daily_change,
               CASE WHEN prev_value IS NULL THEN 'N/A' WHEN value > prev_value THEN 'positive'
                    WHEN value < prev_value THEN 'negative' ELSE 'zero' END AS direction
        FROM (SELECT observation_date, value, LAG(value) OVER (ORDER BY observation_date) AS prev_value
              FROM ({D10}) d) t"""),
    "moving_avg_full": (lambda o: W.moving_avg_full(o, ONE).drop("series_id"), f"""
        SELECT observation_date, value, avg_7d FROM (
          SELECT observation_date, value, {AVG7} AS avg_7d,
                 COUNT(*) OVER (ORDER BY observation_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS n
          FROM ({D10}) d) t WHERE n = 7"""),
    "below_moving_avg": (lambda o: W.below_moving_avg(o, ONE).drop("series_id"), f"""
        SELECT observation_date, value, {AVG7} AS seven_day_ma,
               CASE WHEN value < {AVG7} THEN 1 ELSE 0 END AS flag FROM ({D10}) d"""),
    "moving_stddev": (lambda o: W.moving_stddev(o, ONE).drop("series_id"), f"""
        SELECT observation_date, value,
               ROUND(CAST(STDDEV_SAMP(value) OVER (ORDER BY observation_date
                     ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS DOUBLE), 6) AS moving_stddev
        FROM ({D10}) d"""),
    "quartile": (lambda o: W.quartile(o, ONE).drop("series_id"), f"""
        SELECT value, observation_date,
               CAST(NTILE(4) OVER (ORDER BY value, observation_date) AS BIGINT) AS quartile FROM ({D10}) d"""),
    "rising_flag": (lambda o: W.rising_flag(o, ONE).drop("series_id"), f"""
        SELECT observation_date, value,
               COALESCE(CASE WHEN value > LAG(value) OVER (ORDER BY observation_date) THEN 1 ELSE 0 END, 0) AS flag
        FROM ({D10}) d"""),
    "next_value": (lambda o: W.next_value(o, ONE).drop("series_id"), f"""
        SELECT observation_date, value, LEAD(value) OVER (ORDER BY observation_date) AS next_val FROM ({D10}) d"""),
    "date_gaps": (lambda o: W.date_gaps(o, ONE).drop("series_id"), f"""
        SELECT observation_date AS next_date, prev_date, CAST(observation_date - prev_date AS BIGINT) AS gap_days
        FROM (SELECT observation_date, LAG(observation_date) OVER (ORDER BY observation_date) AS prev_date
              FROM ({D10}) d) t
        WHERE observation_date - prev_date > 1 AND prev_date IS NOT NULL"""),
    "repeated_values": (lambda o: W.repeated_values(o, ONE).drop("series_id"), f"""
        SELECT observation_date AS next_date, prev_date, value FROM (
          SELECT observation_date, value, LAG(value) OVER (ORDER BY observation_date) AS prev_value,
                 LAG(observation_date) OVER (ORDER BY observation_date) AS prev_date FROM ({D10}) d) t
        WHERE value = prev_value"""),
    "number_rows": (lambda o: W.number_rows(o, ONE).drop("series_id"), f"""
        SELECT observation_date, value,
               CAST(ROW_NUMBER() OVER (ORDER BY observation_date) AS BIGINT) AS row_num FROM ({D10}) d"""),
    "grouping_sets": (lambda o: A.grouping_sets(o, ONE).drop("series_id"), f"""
        SELECT year, month, CAST(SUM(value) AS DOUBLE) / COUNT(value) AS avg_yield
        FROM (SELECT CAST(EXTRACT(YEAR FROM observation_date) AS BIGINT) AS year,
                     CAST(EXTRACT(MONTH FROM observation_date) AS BIGINT) AS month, value FROM ({D10}) d) t
        GROUP BY GROUPING SETS ((year, month), (year), ())"""),
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{SF_CHECK}/lineitem.parquet')")
    con.execute(f"CREATE VIEW obs AS {BINDINGS['obs']}")
    return con


@pytest.mark.parametrize("name", sorted(CASES))
def test_single_series_form(spark, duck, name):
    from curvelake.sources.tables import observations

    fn, sql = CASES[name]
    df = fn(observations(spark, SF_CHECK))
    rows, cols = df.collect(), df.columns
    rel = duck.execute(sql)
    drows, dcols = rel.fetchall(), [d[0] for d in rel.description]
    assert sorted(cols) == sorted(dcols)
    so = sorted(range(len(cols)), key=lambda i: cols[i])
    do = sorted(range(len(dcols)), key=lambda i: dcols[i])
    assert sorted(tuple(norm(r[i]) for i in so) for r in rows) == \
        sorted(tuple(norm(r[i]) for i in do) for r in drows)
    assert len(rows) > 0
