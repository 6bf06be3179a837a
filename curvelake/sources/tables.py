"""Scans of the given parquet tables and their binding to the engine's tables.

The engine's tables are ``observations`` (long time series, unique on
``(observation_date, series_id)``), ``filings``, ``companies`` and ``series``.
The driver's test data is TPC-H shaped, so each engine table is *derived*
from it by Spark — its size grows with the input:

* observations: ``lineitem`` grouped by (ship date, ``l_partkey % 18``); the
  bucket names one of the 18 tracked series (seed order); value is
  ``max(l_quantity)`` scaled per series.
* observations_wide: the same with one series per part key (bench scale).
* filings: ``orders`` left-joined to ``customer``.
* companies: ``customer`` (un-padded cik).
* series: the seed list.

The DuckDB text of the same bindings lives in ``curvelake.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvelake import schemas as S
from curvelake.functions.exprs import literal_rows, zfill


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _scaled_value(series_id: F.Column, q: F.Column) -> F.Column:
    return (F.when(series_id == "VIXCLS", q)
            .when(series_id == "BAMLH0A0HYM2", q / 5)
            .otherwise(q / 10)).cast(S.VALUE_TYPE)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(observation_date DATE, series_id STRING, value DECIMAL(10,4))."""
    li = table(spark, sf_dir, "lineitem")
    n = len(S.SERIES_IDS)
    ids = F.array(*[F.lit(s) for s in S.SERIES_IDS])
    # group on the integer bucket (cheap hashing); name it after the aggregate
    g = (li.groupBy(F.to_date("l_shipdate").alias("observation_date"),
                    (F.col("l_partkey") % n).alias("bucket"))
         .agg(F.max("l_quantity").alias("q")))
    sid = F.element_at(ids, (F.col("bucket") + 1).cast("int"))
    return g.select("observation_date", sid.alias("series_id"),
                    _scaled_value(sid, F.col("q")).alias("value"))


def observations_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series per part key: the bench-scale binding."""
    li = table(spark, sf_dir, "lineitem")
    g = (li.groupBy(F.to_date("l_shipdate").alias("observation_date"), "l_partkey")
         .agg(F.max("l_quantity").alias("q")))
    return g.select("observation_date",
                    F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("series_id"),
                    (F.col("q") / 10).cast(S.VALUE_TYPE).alias("value"))


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(accession_number, cik (10-digit padded), company_name, filing_type, filing_date)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    cik = zfill(F.col("o_custkey").cast("string"), S.CIK_WIDTH)
    return j.select(
        F.concat(cik, F.lit("-"), zfill(F.col("o_orderkey").cast("string"), 6)).alias("accession_number"),
        cik.alias("cik"),
        F.col("c_name").alias("company_name"),
        (F.when(F.col("o_orderstatus") == "F", F.lit(S.FORM_ANNUAL))
         .when(F.col("o_orderstatus") == "O", F.lit(S.FORM_QUARTERLY))
         .otherwise(F.lit(S.FORM_CURRENT))).alias("filing_type"),
        F.to_date("o_orderdate").alias("filing_date"),
    )


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cik un-padded, ticker, name, is_active); accounts in debit are inactive."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("cik"),
        F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("ticker"),
        F.col("c_name").alias("name"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
    )


# Series deactivated in the binding (discontinued indicator).
INACTIVE_SERIES = ["TEDRATE"]


def series(spark: SparkSession) -> DataFrame:
    """The tracked-series configuration table (seed list)."""
    rows = [(sid, name, cat, sid not in INACTIVE_SERIES) for sid, name, cat in S.SERIES_SEED]
    return literal_rows(spark, rows, S.SERIES)
