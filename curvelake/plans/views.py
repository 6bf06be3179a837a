"""SQL access: silver, config and the gold views by name.

``register_warehouse`` declares the schemas ``silver``, ``reference``, ``staging`` and ``gold``
over a warehouse, so that ``spark.sql('SELECT * FROM gold.daily_snapshot')`` works as in the
source system.  ``register_views`` does the same for DataFrames, as temporary views.  Views are
lazy: each query is planned from silver, and Catalyst pushes outer filters into their bodies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curvelake import jobs
from curvelake import schemas as S
from curvelake.operators import gold
from curvelake.sinks.writers import current_version

SILVER = ("silver_treasury_yields", "silver_sec_filings", "reference_sec_companies")
GOLD = ("gold_yield_curve", "gold_full_yield_curve", "gold_credit_stress",
        "gold_company_filings_summary", "gold_daily_snapshot")


def register_views(spark: SparkSession, observations: DataFrame, filings: DataFrame,
                   companies: DataFrame) -> list[str]:
    """Create or replace the silver and gold temp views; returns their names."""
    observations.createOrReplaceTempView("silver_treasury_yields")
    filings.createOrReplaceTempView("silver_sec_filings")
    companies.createOrReplaceTempView("reference_sec_companies")
    obs = spark.table("silver_treasury_yields")
    gold.yield_curve(obs).createOrReplaceTempView("gold_yield_curve")
    gold.full_yield_curve(obs).createOrReplaceTempView("gold_full_yield_curve")
    gold.credit_stress(obs).createOrReplaceTempView("gold_credit_stress")
    gold.filings_summary(spark.table("silver_sec_filings"),
                         spark.table("reference_sec_companies")).createOrReplaceTempView(
        "gold_company_filings_summary")
    gold.daily_snapshot(obs).createOrReplaceTempView("gold_daily_snapshot")
    return list(SILVER + GOLD)


def _pivoted(columns: dict[str, str], where: str = "TRUE") -> str:
    """One row per date with a column per series (``columns``: name -> series id)."""
    named = ", ".join(f"'{sid}' AS {name}" for name, sid in columns.items())
    return (f"SELECT * FROM (SELECT observation_date, series_id, value FROM staging.stg_treasury_yields WHERE {where}) "
            f"PIVOT (MAX(value) FOR series_id IN ({named}))")


def _view_sql() -> dict[str, str]:
    """Bodies in the order they depend on each other."""
    score = "CAST(4 * COALESCE(hy_spread, 0) + COALESCE(vix, 0) AS DECIMAL(18,4)) * 0.025BD"
    return {
        "staging.stg_treasury_yields": "SELECT observation_date, series_id, value FROM silver.treasury_yields",
        "gold.yield_curve_d10": "SELECT * FROM staging.stg_treasury_yields WHERE series_id = 'DGS10'",
        "gold.yield_curve": f"SELECT *, yield_10y - yield_2y AS spread_2s10s FROM ({_pivoted(S.YIELD_CURVE_TENORS)})",
        "gold.full_yield_curve": "SELECT *, yield_10y - yield_2y AS spread_2s10s, yield_10y - yield_3m AS spread_3m10y "
                                 f"FROM ({_pivoted(S.FULL_CURVE_TENORS, "startswith(series_id, 'DGS')")})",
        "gold.credit_stress": f"SELECT *, CAST(ROUND({score}, 2) AS DECIMAL(18,2)) AS stress_score FROM ({_pivoted(S.STRESS_LEGS)})",
        "gold.company_filings_summary": """
            WITH per_company AS (
              SELECT cik, LTRIM('0', cik) AS bare, COUNT(*) AS total_filings,
                     COUNT_IF(filing_type = '10-K') AS annual_reports, COUNT_IF(filing_type = '10-Q') AS quarterly_reports,
                     COUNT_IF(filing_type = '8-K') AS current_reports,
                     MIN(filing_date) AS earliest_filing, MAX(filing_date) AS latest_filing
              FROM silver.sec_filings GROUP BY cik)
            SELECT ticker, name AS company_name, p.cik, total_filings, annual_reports, quarterly_reports, current_reports,
                   earliest_filing, latest_filing
            FROM per_company p JOIN reference.sec_companies c ON bare = c.cik""",
        "gold.daily_snapshot": """
            SELECT observation_date, yield_2y, yield_10y, spread_2s10s, hy_spread, vix, stress_score,
                   IF(spread_2s10s < 0, 'INVERTED', IF(spread_2s10s < 0.25BD, 'FLAT', 'NORMAL')) AS curve_status,
                   IF(stress_score > 1.5BD, 'HIGH', IF(stress_score > 0.8BD, 'ELEVATED', 'LOW')) AS stress_level
            FROM gold.full_yield_curve LEFT JOIN gold.credit_stress USING (observation_date)""",
    }


def register_warehouse(spark: SparkSession, wh: jobs.Warehouse) -> list[str]:
    """Declare the warehouse's tables and views under their qualified names; returns these.

    Config views show the version that is current now; register again after a change."""
    for schema in ("silver", "reference", "staging", "gold"):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    obs, fil = jobs.create_tables(spark, wh)
    bodies = {"silver.treasury_yields": f"SELECT * FROM default.{obs}", "silver.sec_filings": f"SELECT * FROM default.{fil}"}
    for name, root in (("reference.fred_series", wh.series), ("reference.sec_companies", wh.companies)):
        if version := current_version(spark, root):
            bodies[name] = f"SELECT * FROM parquet.`{root.rstrip('/')}/{version}`"
    bodies |= _view_sql()
    if "reference.sec_companies" not in bodies:
        del bodies["gold.company_filings_summary"]
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {body}")
    return list(bodies)
